"""Token alignment, token counts and source divergence against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from lodestone.llm import alignment, divergence, token_counts
from lodestone.llm import queries as llm

SIGNS = "ab'srelvtdm 1 2\n\t .,-=é日 ñ▁́"
HAND = [
    None, "", " ", "   ", "a", " a", "it's we're I'LL 're 've'll ''s", "x  y\n\n z", "\n", "<|endoftext|>", "a<|endoftext|> b",
    "<s> </s> <unk> <0x0A>", "日本語 é ßx", "𝒳 👩‍👩‍👧 ﬁ", "tab\tx\r\n", "a\x00b", "▁x", "e \n ", "a 　 b", "a" * 3000, "=" * 4001,
]


def random_texts(n, seed=5):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(SIGNS) for _ in range(rng.randrange(60))) for _ in range(n)]
    wide = [(0x20, 0xD800), (0xE000, 0x110000)]
    return texts + ["".join(chr(rng.randrange(*rng.choice(wide))) for _ in range(12)) for _ in range(n // 4)]


@pytest.fixture(scope="module")
def library():
    first = Tokenizer.from_file(token_counts.vocabulary_path())
    return first, SentencePieceProcessor(model_file=token_counts.vocabulary_path(alignment.SECOND))


def table(spark, texts, **extra):
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)


# --- op12 ---


def test_machine_counts_as_the_library(library):
    with open(token_counts.vocabulary_path(), encoding="utf-8") as file:
        machine = token_counts.Machine(file.read())
    texts = [t or "" for t in HAND] + random_texts(2000)
    want = [len(e.ids) for e in library[0].encode_batch(texts, add_special_tokens=False)]
    assert [machine.count(t) for t in texts] == want
    # every prefix, by the sums of transitions
    text = "it's a 'really' odd<|endoftext|>  one:\n\n\t== 3.14159é日"
    parts = [text[:n] for n in range(len(text))]
    assert [machine.run(machine.start(), p)[1] for p in parts] == [len(library[0].encode(p).ids) for p in parts]


@pytest.mark.parametrize("chunk", [5, 64, 65_536])
def test_token_counts_do_not_depend_on_chunks(spark, library, chunk):
    rng = random.Random(chunk)
    giant = ["".join(rng.choice("abe=") for _ in range(1500)), "= " * 800, "日" * 700, "ab<|endoftext|>" * 90, "a" * 2000, " \n" * 300]
    texts = HAND + giant + giant[:1] + (random_texts(60) if chunk > 5 else [])
    rows = token_counts.token_counts(table(spark, texts), chunk=chunk, limit=100).collect()
    want = [len(library[0].encode(t or "", add_special_tokens=False).ids) for t in texts]
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts)
    assert [got[i].n_tokens for i in range(len(texts))] == want
    assert [got[i].n_bytes for i in range(len(texts))] == [len((t or "").encode()) for t in texts]
    assert all(r.over_limit == (r.n_tokens > 100) for r in rows)


def test_token_counts_rerun_chunks_with_unknown_entries(spark, library, monkeypatch):
    # without any context a chunk's map lacks its true entry states, so they are run again
    monkeypatch.setattr(token_counts, "CONTEXT", 1)
    monkeypatch.setattr(token_counts, "BLOCK", 3)
    rng = random.Random(1)
    texts = ["".join(rng.choice("aeinrst") for _ in range(300)), "ab " * 100]
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(table(spark, texts), chunk=30).collect()}
    assert got == {i: len(library[0].encode(t).ids) for i, t in enumerate(texts)}


def test_token_counts_of_the_tables(spark, sf, library):
    rows = llm.QUERIES["op12_token_counts"](spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(library[0].encode(t or "").ids) for i, t in texts.items()}
    assert llm.QUERIES["op12_token_counts"](spark, sf).columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_token_counts_of_nothing(spark):
    assert token_counts.token_counts(table(spark, ["x"]).limit(0)).collect() == []


# --- op11 ---


def brute_alignment(library, texts):
    """Rows of the contract from whole encodings and their decoded bytes only."""
    first, second = library
    code = token_counts.byte_of_character()
    raw = {i: bytes(map(code.get, t)) for t, i in first.get_vocab(False).items()}

    def piece(i):
        name = second.id_to_piece(i)
        return bytes([int(name[3:-1], 16)]) if second.is_byte(i) else name.replace("▁", " ").encode()

    linked, out = {}, {}
    for key, text in texts.items():
        out[key] = (0, 0, 0, 0, 0, 0, "")
        if not text:
            continue
        first.encode_special_tokens = True
        a = first.encode(" " + text, add_special_tokens=False).ids
        first.encode_special_tokens = False
        b = second.encode(text)
        ends = []
        for ids, of in ((a, raw.get), (b, piece)):
            ends.append(np.cumsum([len(of(i)) for i in ids]).tolist())
            if b"".join(map(of, ids)) != (" " + text).encode():
                ends = None
                break
        if not ends:
            continue
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, pairs, start = [], Counter(), 0
        for cut in cuts:
            x = [i for i, e in zip(a, ends[0]) if start < e <= cut]
            y = [i for i, e in zip(b, ends[1]) if start < e <= cut]
            groups.append((x, y))
            pairs.update((i, j) for i in x for j in y)
            start = cut
        names = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        linked[key] = pairs
        out[key] = (len(a), len(b), len(groups), pairs.total(), 0, 0, hashlib.sha256(names.encode()).hexdigest())
    counts = Counter(p for pairs in linked.values() for p in pairs)
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    for key, pairs in linked.items():
        n_best = sum(n for p, n in pairs.items() if counts[p] == best[p[0]])
        row = out[key]
        out[key] = (*row[:4], n_best, sum(n * counts[p] for p, n in pairs.items()), row[6])
    return out


@pytest.mark.parametrize("share", [1e-6, 3e-3, 1.0])
def test_alignment(spark, library, monkeypatch, share):
    # with larger shares more pairs, or all of them, are joined by shuffle
    monkeypatch.setattr(alignment, "PAIR_SHARE", share)
    texts = HAND[:-2] + ["a" * 500] + random_texts(120) + ["twice the same", "twice the same"]
    rows = alignment.align(table(spark, texts)).collect()
    want = brute_alignment(library, dict(enumerate(texts)))
    assert len(rows) == len(texts)
    assert {r.doc_id: tuple(r)[1:] for r in rows} == want


def test_alignment_of_the_tables(spark, sf, library):
    df = llm.QUERIES["op11_tokenizer_alignment"](spark, sf)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {r.doc_id: tuple(r)[1:] for r in df.collect()} == brute_alignment(library, texts)


def test_alignment_remembers_little(library, monkeypatch):
    files = open(token_counts.vocabulary_path(alignment.FIRST)).read(), open(token_counts.vocabulary_path(alignment.SECOND), "rb").read()
    monkeypatch.setattr(alignment, "REMEMBERED", 10)
    small, texts = alignment.Aligner(files), random_texts(100)
    one = [f and ";".join(x[4] for x in f) for t in texts for f in small.align([t])]
    assert len(small.known) <= 60
    monkeypatch.setattr(alignment, "REMEMBERED", 10_000)
    assert one == [f and ";".join(x[4] for x in f) for f in alignment.Aligner(files).align(texts)]


def test_alignment_of_nothing(spark):
    assert alignment.align(table(spark, ["x"]).limit(0)).collect() == []


def test_links_of_a_large_group():
    a, b = [1, 2, 1] * 20, [7] * 30 + [8] * 10
    pairs, times = alignment.links([(a, b), ([1], [7])])
    want = Counter((x, y) for x in a for y in b) + Counter([(1, 7)])
    assert dict(zip(pairs.tolist(), times.tolist())) == {x << 32 | y: n for (x, y), n in want.items()}


# --- op13 ---


def brute_divergence(docs, least=3, top=200):
    kept, groups = {}, defaultdict(Counter)
    for lang, source, text in docs:
        upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(upper, upper.lower())))
        groups[lang or "", source or ""].update(terms)
        kept.setdefault(lang or "", Counter()).update(set(terms))
    out = []
    for lang, df in kept.items():
        terms = sorted(t for t, n in df.items() if n >= least)
        v = len(terms)
        mine = {s: c for (x, s), c in groups.items() if x == lang}

        def shares(count):
            n = sum(count[t] for t in terms)
            return {t: 1 + 10**9 * (count[t] + 1) // (n + v) for t in terms}

        p = {s: shares(c) for s, c in mine.items()}
        q = shares(sum(mine.values(), Counter()))
        f = lambda x, y: (x - y) ** 2 // y
        for s in mine:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in terms), o) for o in mine if o != s]
            above = [(-f(p[s][t], q[t]), t) for t in terms if mine[s][t] and p[s][t] > q[t]]
            for part, rows in (("pair", pairs), ("term", above)):
                rows.sort(key=lambda r: (r[0], r[1].encode()))
                out += [(lang, s, part, t, -x, i) for i, (x, t) in enumerate(rows, 1) if part == "pair" or i <= top]
    return sorted(out)


def test_divergence(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TILE", 2)  # several tiles of sources
    monkeypatch.setattr(divergence, "SPAN", 1)
    monkeypatch.setattr(divergence, "HELD", 50)
    monkeypatch.setattr(divergence, "SLICE", 40)
    rng = random.Random(3)
    words = ["the", "The", "of", "Éa", "éa", "日本", "x1y", "don't", *(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300))]
    docs = [(rng.choice(["en", "en", "fr"]), rng.choice("abcde"), " ".join(rng.choices(words, weights=range(len(words), 0, -1), k=60))) for _ in range(90)]
    docs += docs[:5] + [(None, None, None), (None, "a", ""), ("en", "empty", "12 34"), ("xx", "a", "rare words only"), ("xx", "b", "others")]
    df = spark.createDataFrame([(i, *d, 0) for i, d in enumerate(docs)], "doc_id long, lang string, source string, text string, rank int")
    got = sorted(tuple(r) for r in divergence.audit(df.repartition(4)).collect())
    assert got == brute_divergence(docs)
    got = sorted(tuple(r) for r in divergence.audit(df.repartition(4), least=1, top=7).collect())
    assert got == brute_divergence(docs, 1, 7)


def test_divergence_of_nothing(spark):
    df = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.audit(df).collect() == []
