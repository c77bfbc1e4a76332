"""What operators store and hold."""

import random
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from lodestone import session
from lodestone.llm import alignment, lm, suffix_dedup


def test_a_rare_bigram_is_stored_in_a_few_bytes(spark, folder, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: folder)
    draw = random.Random(7)
    words = [f"{draw.getrandbits(64):x}" for _ in range(5_000)]
    rows = [(i, " ".join(draw.choices(words, k=1_000))) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    assert lm.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), labels).count() == 60
    assert sum(p.stat().st_size for p in Path(folder).rglob("*.parquet")) < 12 * 60_000


def test_lm_counts_over_all_chunks(spark, monkeypatch):
    rows = [(i if i != 3 else None, t) for i, t in enumerate(["a b a", "b a b", "", "a b", None, "c", "a b a", "é b\x85a"])]
    documents = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    labels = spark.createDataFrame([(0, 1), (1, 0), (5, 1), (5, 1), (None, 1), (99, 1)], "doc_id long, quality int")

    def found():
        out = lm.score(documents, labels).collect()
        return sorted(out, key=lambda r: tuple((x is None, x) for x in r))

    whole = found()
    monkeypatch.setattr(lm, "HELD", 2)  # many chunks and slots
    for one, other in zip(whole, found(), strict=True):
        assert one[:2] == other[:2]
        assert one[2:] == pytest.approx(other[2:], abs=1e-12)
    assert [r.score for r in whole if not r.n_tokens] == [None, None]


def test_windows_of_a_part_are_named_in_bounded_memory():
    draw = np.random.default_rng(3)
    data = draw.integers(97, 123, 2_000_000).astype(np.uint8)
    n = 1_000
    table = {"ord": [0], "rk": [0], "start": [0], "data": [data.tobytes()]}
    table |= {"firsts": [np.arange(0, n * 1_900, 1_900).tobytes()], "lasts": [np.arange(0, n * 1_900, 1_900).tobytes()]}
    suffix_dedup._POWERS.clear()
    tracemalloc.start()
    found = suffix_dedup.window_entries(pa.table(table))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found.a) == n
    at = np.arange(0, n * 1_900, 1_900)
    assert (np.sort(suffix_dedup.identifiers(data, at, at + suffix_dedup.LENGTH)) == found.a).all()
    assert most < 32 * len(data)  # each array of 64-bit numbers for every byte takes 8 times its bytes
    assert all(len(p) <= suffix_dedup.KEPT_POWERS for p in suffix_dedup._POWERS.values())


def test_segments_of_single_bytes_need_no_spans_of_the_library():
    with open(alignment.vocabulary_path(alignment.FIRST), encoding="utf-8") as one, open(alignment.vocabulary_path(alignment.SECOND), "rb") as other:
        aligner = alignment.Aligner((one.read(), other.read()))
    draw = random.Random(5)
    segments = list({" " + "".join(draw.choices("abcdeXYZ019_.-/\t", k=draw.randint(1, 30))) + "z" for _ in range(3_000)})
    segments += [" </s>", " <unk>", " <|endoftext|>x", " a\x00b", " <0x41>", " a\r\nb", " é", " naïve", " 日本x"]
    want = {s: aligner.alone(s) for s in segments}
    library, asked = aligner.second, []

    class Second:
        def encode(self, text, **options):
            asked.extend([text] * (options.get("return_type") == "proto"))
            return library.encode(text, **options)

    aligner.second = Second()
    found = aligner.solve(segments)

    def plain(x):
        return x and (*x[:5], [c.tolist() for c in alignment.of_text([x[5]], [x[6]])])

    assert {s: plain(x) for s, x in found.items()} == {s: plain(x) for s, x in want.items()}
    assert asked and not any(map(str.isascii, asked))


def test_segments_are_put_together_from_units():
    with open(alignment.vocabulary_path(alignment.FIRST), encoding="utf-8") as one, open(alignment.vocabulary_path(alignment.SECOND), "rb") as other:
        files = one.read(), other.read()
    aligner, library, lengths = alignment.Aligner(files), alignment.Aligner(files), []
    draw = random.Random(7)
    words = ["die", "Größe", "ñandú", "x1", "don't", "\u017fa", "日本", "ﬁ", "e\u0301", "a\u2581b"]
    signs = [".", ",", "$$$", ".\n", "!!\n", "\n", ".com", "|", "'s", "\r\n", "\n\n", "</s>", "-", "²", "\u00a0"]
    segments = list({" " + "".join(draw.choice(words) + draw.choice(signs) for _ in range(draw.randint(1, 3))) + draw.choice(["", "End"]) for _ in range(2_000)})
    want = {s: library.alone(s) for s in segments}
    many = aligner.many
    aligner.many = lambda some: lengths.append(sum(map(len, some))) or many(some)

    def plain(x):
        return x and (*x[:5], [c.tolist() for c in alignment.of_text([x[5]], [x[6]])])

    half = len(segments) // 2
    found = aligner.solve(segments[:half]) | aligner.solve(segments[half:])  # the second finds units of the first
    assert {s: plain(x) for s, x in found.items()} == {s: plain(x) for s, x in want.items()}
    assert None in want.values() and sum(want[s] is not None for s in segments) > 500
    texts = ["a" + "".join(draw.choices(segments, k=20)) for _ in range(50)]
    whole = [w if (w := library.alone(" " + t)) is None else w[:5] for t in texts]
    parts = [f and (*map(sum, zip(*[x[:4] for x in f])), ";".join(x[4] for x in f)) for f in aligner.align(texts)]
    assert parts == whole
    # words with different signs are the same units
    lengths.clear()
    aligner.solve([f" wort{a}{b}" for a in (",", ".", "!!", "|", "&&&", ";") for b in ("", "\nEs", "\nOf", "\nTh")])
    assert sum(lengths) < 80
