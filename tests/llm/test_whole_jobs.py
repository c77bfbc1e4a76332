"""Parts of the job that earlier versions left out."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodestone.llm import common, lm, near, pieces, queries, simhash

SF = "/root/testdata/sf0.1"


def signed(prints):
    return [p - 2**64 if p >= 2**63 else p for p in prints]


def within(prints, bits):
    """Pairs of places, by comparing all with all."""
    unsigned = np.array(prints, np.int64).view(np.uint64)
    for i, p in enumerate(unsigned):
        for j in np.nonzero(np.bitwise_count(unsigned[:i] ^ p) <= bits)[0]:
            yield i, int(j)


def least_ids(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_simhash_links_over_the_sign_bit(spark):
    rng = random.Random(4)
    few = [rng.getrandbits(63) for _ in range(40)]
    few += [p ^ 1 << 63 ^ 1 << a ^ 1 << b for p in few for a, b in [rng.sample(range(63), 2)]]
    hot = rng.getrandbits(63)  # enough at one anchor to be compared by forest()
    hot = [hot ^ 1 << a for a in range(31)] + [hot ^ 1 << 63 ^ 1 << a for a in range(31)]
    prints = signed([*few, *hot])
    rows = spark.createDataFrame(list(enumerate(prints)), "doc_id long, print long")
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(rows).join(rows, "print").collect()}
    assert found == least_ids(range(len(prints)), within(prints, 3))
    a = np.array([5, 0, -1], np.int64)
    assert simhash.distances(a, a ^ np.int64(-(2**63) + 3)).tolist() == [3, 3, 3]
    near, homes = np.array([1, -(2**63) + 2], np.int64), np.ones(2, bool)
    assert simhash.forest(near, homes) == ([1], [-(2**63) + 2])


def test_op4_at_a_larger_size_against_brute_force(spark):
    out = queries.QUERIES["op4_simhash"](spark, SF).collect()
    prints = {r.doc_id: int(r.fingerprint, 16) for r in out}
    first = {}
    for i in sorted(prints):
        first.setdefault(prints[i], i)
    distinct = list(first)
    links = [(first[distinct[i]], first[distinct[j]]) for i, j in within(signed(distinct), 3)]
    least = least_ids(first.values(), links)
    assert {r.doc_id: r.component_id for r in out} == {i: least[first[p]] for i, p in prints.items()}


def word_sets(text):
    words = text.encode().lower().split()
    size = min(5, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def jaccard_links(rows):
    sets = [(i, word_sets(t or "")) for i, t in rows]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 5 * len(a & b) >= 4 * len(a | b):
                yield i, j


@pytest.mark.parametrize("block", [2, 512])
def test_pipeline_drops_near_copies_by_jaccard(spark, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK", block)
    docs = spark.read.parquet(SF.replace("0.1", "0.01") + "/documents.parquet").select("doc_id", "text")
    rng = random.Random(7)
    chain = [[rng.choice("abcdefgh") + str(rng.randrange(99)) for _ in range(60)]]
    for _ in range(8):  # each like the one before, the ends unlike
        chain.append([*chain[-1][4:], *(rng.choice("xyz") + str(rng.randrange(99)) for _ in range(4))])
    more = [(10_000 + i, " ".join(w)) for i, w in enumerate(chain)] + [(20_000, None), (20_001, " "), (20_002, "a b"), (20_003, "A  b"), (20_004, "a c")]
    docs = docs.unionAll(spark.createDataFrame(more, docs.schema))
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    least = least_ids([i for i, _ in rows], jaccard_links(rows))
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert kept == set(least.values())
    assert {10_000, 20_000, 20_002, 20_004} <= kept and not kept & {10_008, 20_001, 20_003}


def test_pipeline_links_near_copies_at_anchors(spark):
    words = [f"w{i}" for i in range(4_000)]
    texts = [words, [*words[:-1], "other"], words[:2_000], ["w", *words[1:2_000]], [f"v{i}" for i in range(300)], ["a"], ["b"]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    sets = near.signatures(docs)
    place = {r.print: r.doc_id for r in sets.collect()}
    bits = {r.doc_id: np.uint64(r.bits % 2**64) for r in sets.collect()}
    assert all(np.bitwise_count(bits[a] ^ bits[b]) <= simhash.THRESHOLD for a, b in [(0, 1), (2, 3)])
    blind = sets.withColumn("bands", F.array().cast("array<long>"))  # no min-hashes: the anchors alone
    assert {tuple(sorted((place[r.a], place[r.b]))) for r in near.near_links(blind).collect()} == {(0, 1), (2, 3)}


def test_lm_knows_every_word_at_a_larger_size(spark):
    sf = SF.replace("0.1", "0.01")
    texts = {r.doc_id: lm.tokens(r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").collect()}
    single, pair, before = ([Counter(), Counter()] for _ in range(3))
    for i, t in texts.items():
        for model in (0, 1) if i in good else (1,):
            single[model].update(t)
            pair[model].update(zip(["^", *t], t))
            before[model].update(["^", *t][: len(t)])
    size = len(single[1]) + 2
    assert size > 60_000
    n = [sum(c.values()) for c in single]

    def loss(model, t):
        p = [0.7 * pair[model][a, b] / max(before[model][a], 1) + 0.3 * (single[model][b] + 1) / (n[model] + size) for a, b in zip(["^", *t], t)]
        return -np.log(p).mean()

    out = {r.doc_id: r for r in queries.QUERIES["op7_cross_entropy_difference"](spark, sf).collect()}
    assert len(out) == len(texts)
    for i, t in texts.items():
        if t:
            assert [out[i].n_tokens, out[i].target_loss, out[i].background_loss] == pytest.approx([len(t), loss(0, t), loss(1, t)], abs=1e-9)


def test_a_task_gives_its_memory_back(spark):
    def resident():
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * 4_096 >> 20

    kept = []

    def task(batches):
        held = []
        for size in batches:
            for i in range(size):
                held.append(bytes(600))
                if i % 5_000 == 0:  # what is still used lies between what is free
                    kept.append(bytes(600))
            yield len(held)

    before = resident()
    assert list(common.lean(task)(iter([200_000, 200_000]))) == [200_000, 400_000]
    assert resident() - before < 60  # of some 240 MB
    assert common.lean(task).__wrapped__ is task
    for made in (pieces.encoder(pieces.vocabulary()), pieces.decoder(pieces.vocabulary())):
        assert hasattr(made.func, "__wrapped__")
