"""Removal of repeated 50-byte strings by bucket-pointer refinement over sampled suffixes.

The suffixes of all texts fall into buckets by their first ``GRAM`` bytes, and buckets are refined
by the identifiers of what follows, only while they hold more than one document:

1. The bucket of a 50-byte window is its least hashed ``GRAM``-gram, so equal windows share it
   wherever they stand, and one suffix stands for a run of windows with the same bucket. Buckets
   of one document are done.
2. The others are refined by the identifier of the whole string that the run covers. A run whose
   string also stands in a smaller document is removed at once, all its windows together.
3. Buckets that still hold different strings are refined window by window, for the smallest
   document of each string.

In each round documents ask in parts: a part sends every distinct (bucket, identifier) with its
smallest document once, sorted tasks merge the parts, and the answers go back to the parts, so a
passage that a third of all documents share costs one entry per part. Only runs of shared buckets
are carried on, a fraction of the text. The first question sends 48 bits of a bucket, which can only
let too many pass; identifiers of refined buckets have 128 bits.

Of documents with the same text, all but the smallest are removed as a whole, without any of this,
if they have 50 bytes. Null texts are empty. Rows that share id and text get the same result. A
null id counts as larger than all others, and null ids as equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import give_back, lean, parts, small_batches, stored, text_of
from lodestone.operators.topk import join_counted

LENGTH = 50
GRAM = 32
#: Bytes of a bucket identifier in the first question, which is only a filter.
SHORT = 6
#: Bytes of text a part holds, about.
PART_BYTES = 16 << 20
#: Bytes of a part whose windows are named at once, and powers that are kept.
BLOCK = 1 << 18
KEPT_POWERS = 1 << 20
#: Largest table of removed spans sent to every task.
SPAN_BYTES = 32 << 20
LAST = (1 << 63) - 1

U = np.uint64
_RANDOM = np.random.default_rng(50)
TABLE = _RANDOM.integers(0, 1 << 63, (2, 256), dtype=U)
BASE = (U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F))
INVERSE = tuple(U(pow(int(b), -1, 1 << 64)) for b in BASE)

TEXT = "part long, rk long, ord long, z binary"
ENTRY = "part long, slot long, a binary, b binary, o binary, m binary"
ANSWER = "part long, slot long, least binary, many binary"
REGION = "part long, rk long, ord long, start long, data binary, keys binary, firsts binary, lasts binary"
OPEN = "part long, rk long, ord long, start long, data binary, spans binary, firsts binary, lasts binary"
SPANS = "rk long, spans binary"


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers, kept for the next call unless they are very many."""
    known = _POWERS.get(int(base))
    if known is None or len(known) < n:
        known = np.concatenate([[U(1)], np.cumprod(np.full(max(n, 1 << 16), base, U))])
        if len(known) <= KEPT_POWERS:
            _POWERS[int(base)] = known
    return known[:n]


def identifiers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit identifiers of the strings ``data[start:end]``."""
    n = len(data)
    sums = np.zeros(n + 1, U)
    np.cumsum(TABLE[which][data] * powers(BASE[which], n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(INVERSE[which], n + 1)[starts] + (ends - starts).astype(U))


def runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the runs of windows of a text, with the first and last window of each run."""
    h, size = TABLE[0][data], 1
    while size < GRAM:
        h = mix(h[:-size] * BASE[0] + h[size:])
        size *= 2
    wide, n = LENGTH - GRAM + 1, 1
    least = h
    while 2 * n <= wide:
        least = np.minimum(least[:-n], least[n:])
        n *= 2
    least = np.minimum(least[: len(h) - wide + 1], least[wide - n : len(h) - n + 1])
    firsts = np.nonzero(np.concatenate([[True], least[1:] != least[:-1]]))[0]
    return least[firsts], firsts, np.concatenate([firsts[1:], [len(least)]]) - 1


def merged(spans: np.ndarray) -> np.ndarray:
    """Rows of (start, end) as maximal runs; spans that touch are one."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    return np.stack([spans[new, 0], reach[np.concatenate([np.nonzero(new)[0][1:] - 1, [len(spans) - 1]])]], axis=1)


def batch(columns: list, shape: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in shape.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def table_of(rows: list[tuple], shape: str) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in shape.split(", ")]
    return pa.Table.from_batches([batch(columns, shape)])


class Entries:
    """What a part asks: distinct (a, b) in order, with the smallest document, dealt into slots by ``a``."""

    def __init__(self, a: np.ndarray, b: np.ndarray, o: np.ndarray):
        order = np.lexsort((o, b, a))
        a, b, o = a[order], b[order], o[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        self.place = np.empty(len(a), np.int64)
        self.place[order] = np.cumsum(new) - 1
        self.a, self.b, self.o = a[new], b[new], o[new]

    def slots(self, n: int) -> Iterator[tuple[int, np.ndarray]]:
        slot = (mix(self.a) % U(n)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        for part in np.split(order, np.nonzero(np.diff(slot[order]))[0] + 1) if len(order) else []:
            yield int(slot[part[0]]), part

    def answers(self, told: pa.Table, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Per entry as given: the smallest document of (a, b), and whether ``a`` has other members."""
        least, many = np.full(len(self.a), LAST), np.zeros(len(self.a), bool)
        rows = {s: i for i, s in enumerate(told["slot"].to_pylist())}
        for slot, at in self.slots(n):
            i = rows[slot]
            many[at] = np.unpackbits(np.frombuffer(told["many"][i].as_py(), np.uint8))[: len(at)].astype(bool)
            if (raw := told["least"][i].as_py()) is not None:
                least[at] = unsqueezed(raw)
        return least[self.place], many[self.place]


def squeezed(values: np.ndarray) -> bytes:
    return len(values).to_bytes(8, "little") + pa.Codec("zstd").compress(values.tobytes(), asbytes=True)


def unsqueezed(raw: bytes) -> np.ndarray:
    return np.frombuffer(pa.Codec("zstd").decompress(raw[8:], 8 * int.from_bytes(raw[:8], "little")), np.int64)


def cut_short(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SHORT].tobytes()


def made_long(raw: bytes) -> np.ndarray:
    short = np.frombuffer(raw, np.uint8).reshape(-1, SHORT)
    return np.pad(short, ((0, 0), (0, 8 - SHORT))).view("<u8").ravel()


def answer(table: pa.Table) -> pa.Table:
    """Merge what all parts ask of one slot."""
    rows = table.to_pylist()
    plain = rows[0]["b"] is None
    a = [made_long(r["a"]) if plain else np.frombuffer(r["a"], U) for r in rows]
    sizes, a = [len(x) for x in a], np.concatenate(a)
    many, least = np.empty(len(a), bool), None
    if plain:  # a bucket that two parts send has several documents
        order = np.argsort(a, kind="stable")
        head = np.concatenate([[True], a[order][1:] != a[order][:-1]])
        heads, m = np.nonzero(head)[0], np.concatenate([np.frombuffer(r["m"], bool) for r in rows])
        several = (np.diff([*heads, len(a)]) > 1) | np.logical_or.reduceat(m[order], heads)
    else:
        b, o = np.concatenate([np.frombuffer(r["b"], U) for r in rows]), np.concatenate([unsqueezed(r["o"]) for r in rows])
        order = np.lexsort((o, b, a))
        head = np.concatenate([[True], a[order][1:] != a[order][:-1]])
        kind = head | np.concatenate([[True], b[order][1:] != b[order][:-1]])
        several = np.add.reduceat(kind, np.nonzero(head)[0]) > 1
        least = np.empty(len(a), np.int64)
        least[order] = o[order][kind][np.cumsum(kind) - 1]
    many[order] = several[np.cumsum(head) - 1]
    out = []
    for r, start, n in zip(rows, np.cumsum([0, *sizes]), sizes):
        at = slice(start, start + n)
        out.append((r["part"], r["slot"], None if plain else squeezed(least[at]), np.packbits(many[at]).tobytes()))
    return table_of(out, ANSWER)


def asked(rows: DataFrame, entries, slots: int) -> DataFrame:
    """Entries of every part of ``rows``, merged and answered. ``entries`` maps a part's table to ``Entries``."""

    def send(key: tuple, table: pa.Table) -> pa.Table:
        found, part = entries(table), key[0].as_py()
        out = []
        for slot, at in found.slots(slots):
            if isinstance(found, Buckets):
                out.append((part, slot, cut_short(found.a[at]), None, None, found.several[at].tobytes()))
            else:
                out.append((part, slot, found.a[at].tobytes(), found.b[at].tobytes(), squeezed(found.o[at]), None))
        del found
        give_back()
        return table_of(out, ENTRY)

    def tell(table: pa.Table) -> pa.Table:
        out = answer(table)
        give_back()
        return out

    return rows.groupBy("part").applyInArrow(send, ENTRY).groupBy("slot").applyInArrow(tell, ANSWER)


class Buckets(Entries):
    """The first question: distinct buckets, and whether several documents of the part hold them.

    ``owners`` do not fall; buckets are cut to ``SHORT`` bytes.
    """

    def __init__(self, keys: np.ndarray, owners: np.ndarray):
        keys = keys >> U(64 - 8 * SHORT)
        order = np.argsort(keys, kind="stable")
        keys, owners = keys[order], owners[order]
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        self.place = np.empty(len(keys), np.int64)
        self.place[order] = np.cumsum(new) - 1
        self.a, heads = keys[new], np.nonzero(new)[0]
        self.several = owners[heads] != owners[np.concatenate([heads[1:] - 1, [len(owners) - 1]])]


def part_runs(table: pa.Table) -> tuple[list, Buckets]:
    """The texts of a part with their runs, and the buckets of all."""
    codec, docs = pa.Codec("zstd"), []
    for rk, order, z in zip(table["rk"].to_pylist(), table["ord"].to_pylist(), table["z"].to_pylist()):
        data = np.frombuffer(codec.decompress(z[8:], int.from_bytes(z[:8], "little")), np.uint8)
        docs.append((rk, order, data, *runs(data)))
    docs.sort(key=lambda d: (d[1], d[0]))
    keys = np.concatenate([d[3] for d in docs])
    # documents are numbered within the part; rows of one id are one document
    number = np.cumsum([0] + [a[1] != b[1] for a, b in zip(docs, docs[1:])])
    return docs, Buckets(keys, np.repeat(number, [len(d[3]) for d in docs]))


def regions(docs: list, shared: np.ndarray, part: int) -> Iterator[tuple]:
    """Runs of windows with shared buckets that follow each other, with their bytes."""
    start = 0
    for rk, order, data, keys, firsts, lasts in docs:
        held = shared[start : start + len(keys)]
        start += len(keys)
        edge = np.diff(np.concatenate([[0], held.astype(np.int8), [0]]))
        for i, j in zip(np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]):
            begin, end = int(firsts[i]), int(lasts[j - 1]) + LENGTH
            yield (
                part, rk, order, begin, data[begin:end].tobytes(), keys[i:j].tobytes(),
                (firsts[i:j] - begin).tobytes(), (lasts[i:j] - begin).tobytes(),
            )


def _arrays(table: pa.Table, names: str, kind: type = np.int64) -> list[list[np.ndarray]]:
    return [[np.frombuffer(x, np.uint8 if n == "data" else U if n == "keys" else kind) for x in table[n].to_pylist()] for n in names.split()]


def in_order(table: pa.Table) -> pa.Table:
    return table.sort_by([("ord", "ascending"), ("rk", "ascending"), ("start", "ascending")])


def run_entries(table: pa.Table) -> Entries:
    """The second question: buckets with the identifier of all bytes of the run."""
    table = in_order(table)
    data, keys, firsts, lasts = _arrays(table, "data keys firsts lasts")
    names = [identifiers(d, f, l + LENGTH) for d, f, l in zip(data, firsts, lasts)]
    owners = np.repeat(np.array(table["ord"].to_pylist(), np.int64), [len(k) for k in keys])
    return Entries(np.concatenate(keys), np.concatenate(names), owners)


def window_entries(table: pa.Table) -> Entries:
    """The third question: two identifiers of every window that is still open."""
    table = in_order(table)
    data, firsts, lasts = _arrays(table, "data firsts lasts")
    sizes = [len(d) for d in data]
    # the regions of a part as one text: no window reaches over the end of its region
    begin = np.repeat(np.cumsum([0, *sizes[:-1]]), [len(f) for f in firsts])
    firsts, lasts, data = np.concatenate(firsts) + begin, np.concatenate(lasts) + begin, np.concatenate(data)
    at = open_windows(firsts, lasts)
    whose = np.searchsorted(np.cumsum(sizes), at, side="right")
    owners = np.array(table["ord"].to_pylist(), np.int64)[whose]
    return Entries(window_identifiers(data, at), window_identifiers(data, at, 1), owners)


def window_identifiers(data: np.ndarray, at: np.ndarray, which: int = 0) -> np.ndarray:
    """``identifiers`` of the windows that start at ``at``, which rises, block by block: they don't depend on the place."""
    edges = np.searchsorted(at, np.arange(0, len(data) + BLOCK, BLOCK))
    names = [np.empty(0, U)]
    for begin, i, j in zip(range(0, len(data), BLOCK), edges, edges[1:]):
        if i < j:
            starts = at[i:j] - begin
            names.append(identifiers(data[begin : begin + BLOCK + LENGTH], starts, starts + LENGTH, which))
    return np.concatenate(names)


def open_windows(firsts: np.ndarray, lasts: np.ndarray) -> np.ndarray:
    n = lasts - firsts + 1
    return np.repeat(firsts - (np.cumsum(n) - n), n) + np.arange(n.sum())


def removed_spans(texts: DataFrame, slots: int) -> DataFrame:
    """``rk`` and the removed (start, end) of every text that has some; see ``TEXT``."""

    def find(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows:
            return table_of([], REGION)
        docs, asked_for = part_runs(table)
        return table_of(list(regions(docs, asked_for.answers(told, slots)[1], key[0].as_py())), REGION)

    def settle(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows:
            return table_of([], OPEN)
        least, many = run_entries(table).answers(told, slots)
        table, out, start = in_order(table), [], 0
        rows = zip(table["rk"].to_pylist(), table["ord"].to_pylist(), table["start"].to_pylist())
        for (rk, order, begin), d, f, l in zip(rows, *_arrays(table, "data firsts lasts")):
            at = slice(start, start + len(f))
            start += len(f)
            gone = least[at] < order
            still = ~gone & many[at]
            if gone.any() or still.any():
                spans = merged(np.stack([f[gone], l[gone] + LENGTH], axis=1) + begin)
                data = d.tobytes() if still.any() else b""
                out.append((key[0].as_py(), rk, order, begin, data, spans.tobytes(), f[still].tobytes(), l[still].tobytes()))
        return table_of(out, OPEN)

    def finish(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        if not table.num_rows:
            return table_of([], SPANS)
        least, _ = window_entries(table).answers(told, slots)
        table, out, start = in_order(table), [], 0
        rows = zip(table["rk"].to_pylist(), table["ord"].to_pylist(), table["start"].to_pylist())
        for (rk, order, begin), f, l in zip(rows, *_arrays(table, "firsts lasts")):
            at = open_windows(f, l)
            at = at[least[start : start + len(at)] < order] + begin
            start += int((l - f + 1).sum())
            if len(at):
                out.append((rk, merged(np.stack([at, at + LENGTH], axis=1)).tobytes()))
        return table_of(out, SPANS)

    def paired(rows: DataFrame, entries, shape: str, step) -> DataFrame:
        answers = asked(rows, entries, slots)

        def take(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
            out = step(key, table, told)
            give_back()
            return out

        return rows.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(take, shape)

    shared = stored(paired(texts, lambda t: part_runs(t)[1], REGION, find), "regions")
    settled = stored(paired(shared, run_entries, OPEN, settle), "settled")
    left = settled.where("length(firsts) > 0").drop("spans")
    last = paired(left, window_entries, SPANS, finish)
    return settled.where("length(spans) > 0").select("rk", "spans").unionAll(last)


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec = pa.Codec("zstd")
    for b in batches:
        z = [len(raw).to_bytes(8, "little") + codec.compress(raw, asbytes=True) for raw in b.column("raw").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("part"), b.column("rk"), b.column("ord"), pa.array(z, pa.binary())], ["part", "rk", "ord", "z"])


def cut(raw: bytes, copy: bool, spans: list[bytes] | None) -> dict:
    """What is left of a text."""
    if copy and len(raw) >= LENGTH:
        gone = np.array([[0, len(raw)]])
    else:
        gone = merged(np.concatenate([np.empty((0, 2), np.int64), *[np.frombuffer(s, np.int64).reshape(-1, 2) for s in spans or []]]))
    digest, at = hashlib.sha256(), 0
    for start, end in gone.tolist():
        digest.update(raw[at:start])
        at = end
    digest.update(raw[at:])
    n = int((gone[:, 1] - gone[:, 0]).sum())
    return {"n_bytes": len(raw), "n_removed": n, "n_spans": len(gone), "kept_sha256": digest.hexdigest()}


def deduplicate(documents: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``."""
    spark = documents.sparkSession
    small_batches(spark)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    rows = rows.withColumns({"ord": F.coalesce("doc_id", F.lit(LAST)), "sha": F.sha2("text", 256)})
    rows = rows.withColumn("rk", F.xxhash64("ord", "sha"))
    groups = rows.groupBy("sha").agg(F.min("ord").alias("least"), F.max("ord").alias("most"))
    groups = stored(groups.where("least < most").drop("most"), "copies")
    rows = join_counted(rows, groups, "sha", "left")
    rows = rows.withColumn("copy", F.coalesce(F.col("ord") > F.col("least"), F.lit(False)))
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(parts(spark), -(-size // PART_BYTES))
    texts = rows.where(~F.col("copy") & (F.octet_length("text") >= LENGTH))
    texts = texts.select(F.pmod("rk", F.lit(n)).alias("part"), "rk", "ord", F.col("text").cast("binary").alias("raw"))
    texts = texts.mapInArrow(lean(packed), TEXT)
    spans = removed_spans(texts, n).groupBy("rk").agg(F.collect_list("spans").alias("spans"))
    spans = stored(spans, "spans")
    weight = F.aggregate("spans", F.lit(0).cast("long"), lambda t, s: t + F.octet_length(s) + 16)
    small = (spans.agg(F.sum(weight)).first()[0] or 0) <= SPAN_BYTES
    rows = rows.select("doc_id", "text", "copy", "rk").join(F.broadcast(spans) if small else spans, "rk", "left")

    @F.arrow_udf("struct<n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept_sha256:string>")
    def cutting(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
        for texts, copies, lists in batches:
            yield pa.array([cut(t.encode(), c, s) for t, c, s in zip(texts.to_pylist(), copies.to_pylist(), lists.to_pylist())], kind)

    return rows.select("doc_id", cutting("text", "copy", "spans").alias("r")).select("doc_id", "r.*")
