"""Positions, the write path, schemas, chunks, the catalog, sessions, lineage, collections."""

import random
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodestone.collection import Collection, CollectionSpec
from lodestone.functions.ids import ID_TYPE, int_id, string_id, unset_id
from lodestone.operators.catalog import (
    decode_cursor,
    document_catalog,
    encode_cursor,
    get_original_files,
    get_originals,
    list_documents_keyset,
    paged_listing,
)
from lodestone.operators.chunk import chunk_table_rows, chunk_text
from lodestone.operators.lineage import cleanup_unused, delete_source, newest_runs, source_references, unused_sources
from lodestone.operators.ordering import preceding_rows, row_position, running_total
from lodestone.operators.retrieval import aggregate_citations, chunk_vectors, resolve_inline_citations, retrieve_context
from lodestone.operators.schema import MetadataSchema, enforce_metadata_schema, schema_merge, schema_replace, union_versions
from lodestone.operators.sessions import append_messages, conversation_history, delete_sessions, list_messages, session_rollup
from lodestone.operators.sparse import build_sparse_index
from lodestone.operators.topk import rows_of, with_rows
from lodestone.operators.write import add_texts, assign_text_ids, delete_vectors, insert_vectors, prepare_texts, split_by_dim


@pytest.fixture(scope="module")
def uneven(spark):
    """Groups of very different size; one holds most rows, and order values have gaps."""
    rng = random.Random(3)
    data = [(g, o, rng.randint(0, 3)) for g, n in (("hot", 400), ("a", 7), ("b", 1)) for o in rng.sample(range(900), n)]
    return spark.createDataFrame(data, "g string, o bigint, v bigint")


@pytest.mark.parametrize("width", [1, 8, 64, 65_536])
def test_running_total_matches_plain_sum(uneven, width):
    got = {(r["g"], r["o"]): r["t"] for r in running_total(uneven, ["g"], "o", F.col("v"), "t", width).collect()}
    data = sorted(tuple(r) for r in uneven.collect())
    totals = {}
    for g, o, v in data:
        totals[g] = totals.get(g, 0) + v
        assert got[(g, o)] == totals[g]
    assert len(got) == len(data)


@pytest.mark.parametrize("width", [5, 64])
def test_positions(uneven, width):
    got = sorted((r["g"], r["o"], r["p"]) for r in row_position(uneven, ["g"], "o", "p", width).collect())
    seen = {}
    for g, _, p in got:
        assert p == seen.get(g, 0)
        seen[g] = p + 1


@pytest.mark.parametrize("width", [3, 10, 65_536])
def test_preceding_rows_cross_ranges(uneven, width):
    got = preceding_rows(uneven, ["g"], "o", 3, F.col("o"), "h", width).collect()
    by_group = {}
    for r in sorted(got, key=lambda r: (r["g"], r["o"])):
        before = by_group.setdefault(r["g"], [])
        assert r["h"] == before[-3:]
        before.append(r["o"])
    assert sum(map(len, by_group.values())) == uneven.count()


def test_rows_of_large_and_small_key_lists(spark):
    wide = spark.range(100).withColumn("x", F.col("id") * 2)
    keys = spark.createDataFrame([(3,), (3,), (50,), (200,)], "id bigint")
    assert rows(rows_of(wide, keys, "id")) == rows(rows_of(wide, keys, "id", max_rows=1)) == [(3, 6), (50, 100)]
    assert with_rows(keys, wide, how="left").where("x IS NULL").count() == 1


def batch(spark, data):
    df = spark.createDataFrame(data, "kind string, i bigint, s string, values array<float>, m string, position bigint")
    made = F.when(F.col("kind") == "int", int_id(F.col("i"))).when(F.col("kind") == "str", string_id(F.col("s"))).otherwise(unset_id())
    return df.select(made.alias("id"), "values", F.create_map(F.lit("m"), "m").alias("metadata"), "position")


def empty(spark):
    kind = f"id {ID_TYPE}, values array<float>, metadata map<string,string>, seq bigint, position bigint"
    return spark.createDataFrame([], kind)


def shown(df):
    return rows(df, "id.kind", F.coalesce("id.s", F.col("id.i").cast("string")), F.col("metadata")["m"])


def test_upsert_rules(spark):
    one = [1.0, 0.0]
    first = batch(spark, [("int", 42, None, one, "a", 0), ("str", None, "42", one, "b", 1), ("int", 42, None, one, "c", 2), ("str", None, "", one, "e", 3)])
    table = insert_vectors(empty(spark), first, 2, 0)
    assert shown(table) == [("int", "42", "c"), ("str", "", "e"), ("str", "42", "b")]
    second = batch(spark, [("int", 42, None, one, "new", 0), ("int", 7, None, [1.0], "short", 1), (None, None, None, one, "auto", 2)])
    table = insert_vectors(table, second, 2, 1)
    got = shown(table)
    assert ("int", "42", "new") in got and all(m != "short" for _, _, m in got) and len(got) == 4
    assert shown(insert_vectors(table, second, 2, 1)) == got  # a replay changes nothing
    assert split_by_dim(second, 2)[1].count() == 1


def test_delete_is_typed(spark):
    one = [1.0, 0.0]
    table = insert_vectors(empty(spark), batch(spark, [("int", 42, None, one, "a", 0), ("str", None, "doc-1", one, "b", 1), ("str", None, "42", one, "c", 2)]), 2, 0)
    ids = batch(spark, [("str", None, "doc-1", None, None, 0), ("int", 42, None, None, None, 1), ("int", 99, None, None, None, 2)])
    assert shown(delete_vectors(table, ids)) == [("str", "42", "c")]


def test_generated_text_ids_count_places(spark):
    docs = spark.createDataFrame([(100, "one", 5), (None, "two", 6)], "i bigint, text string, position bigint")
    named = assign_text_ids(docs.select(int_id(F.col("i")).alias("id"), "text", "position"))
    assert rows(named, "id.kind", "id.s", "id.i") == [("int", None, 100), ("str", "text-2", None)]


def test_add_texts_keeps_present_text(spark):
    docs = spark.createDataFrame([("one", None, 0), ("two", {"text": None}, 1), ("three", {"k": "v"}, 2)], "text string, metadata map<string,string>, position bigint")
    made = add_texts(empty(spark), docs.withColumn("id", unset_id()), 0)
    got = {r["id"]["s"]: r["metadata"] for r in made.collect()}
    assert got == {"text-1": {"text": "one"}, "text-2": {"text": None}, "text-3": {"k": "v", "text": "three"}}
    assert made.where(F.size("values") == 64).count() == 3


def test_schema_types(spark):
    data = [(1, '{"u": 4294967295, "f": 1.5, "i": 7, "d": "1e308", "s": "x", "free": 1}'), (2, '{"u": -1}'), (3, '{"f": "3.5e39"}'),
            (4, '{"i": 2147483648}'), (5, '{"u": null}'), (6, '{"d": "nan"}'), (7, "{}")]
    df = spark.createDataFrame(data, "id int, m string").select("id", F.parse_json("m").alias("metadata"))
    schema = MetadataSchema((("u", "u32"), ("f", "f32"), ("i", "i32"), ("d", "f64"), ("s", "string")))
    good, bad = enforce_metadata_schema(df, schema)
    assert rows(good, "id", "u", "f", "i", "d", "s") == [(1, 4294967295, 1.5, 7, 1e308, "x"), (5, *[None] * 5), (7, *[None] * 5)]
    assert rows(bad, "id", "errors") == [(2, ["u"]), (3, ["f"]), (4, ["i"]), (6, ["d"])]
    assert rows(good.where("id = 1"), F.try_variant_get("metadata", "$.free", "int")) == [(1,)]


def test_schema_changes(spark):
    schema = MetadataSchema((("a", "i64"),))
    assert schema.merge([("b", "string"), ("a", "i32")]) == MetadataSchema((("a", "i32"), ("b", "string")), 2)
    assert schema.replace([]).fields == () and schema.replace([]).version == 2
    with pytest.raises(ValueError):
        MetadataSchema((("a", "u64"),))
    df = spark.createDataFrame([(1, 5, '{"b": "x"}'), (2, 2**40, "{}")], "id int, a bigint, m string")
    df = df.select("id", F.parse_json("m").alias("metadata"), "a")
    merged, new = schema_merge(df, schema, [("a", "i32"), ("b", "string")])
    assert merged.columns == ["id", "metadata", "a", "b"] and new.version == 2
    assert rows(merged, "id", "a", "b") == [(1, 5, "x"), (2, None, None)]
    gone, _ = schema_replace(merged, new, [])
    assert gone.columns == ["id", "metadata"]
    assert union_versions([merged.drop("b"), merged]).count() == 4


@pytest.mark.parametrize("old, new", [("f32", "i32"), ("f64", "i64"), ("f64", "u32")])
def test_retyping_to_whole_numbers_keeps_values_that_fit(spark, old, new):
    kind = {"f32": "float", "f64": "double"}[old]
    values = [1.0, 2.0, 2.5, None, float("nan"), float("inf"), 1e30]
    df = spark.createDataFrame(list(enumerate(values)), f"id int, a {kind}")
    schema = MetadataSchema((("a", old),))
    want = [1, 2, None, None, None, None, None]
    merged, _ = schema_merge(df, schema, [("a", new)])
    assert [a for _, a in rows(merged, "id", "a")] == want
    replaced, _ = schema_replace(df, schema, [("a", new)])
    assert [a for _, a in rows(replaced, "id", "a")] == want


def test_chunks(spark):
    text = " ".join(str(i) for i in range(23))
    df = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "a  b\nc")], "doc_id int, text string")
    got = {(r["doc_id"], r["chunk_index"]): r["text"] for r in chunk_text(df, 10, 8).collect()}
    assert got[(2, 0)] == got[(3, 0)] == "" and got[(4, 0)] == "a b c"
    assert sorted(i for d, i in got if d == 1) == [0, 1, 2]
    assert got[(1, 1)].split() == [str(i) for i in range(8, 18)] and got[(1, 2)].split()[-1] == "22"
    with pytest.raises(ValueError):
        chunk_text(df, 5, 6)


def test_windows_of_a_text_do_not_each_carry_its_words(spark):
    texts = [" ".join(f"w{i}" for i in range(n)) for n in (1, 119, 120, 121, 220, 221, 5_000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    chunks = chunk_text(df)
    node, seen = chunks._jdf.queryExecution().optimizedPlan(), []
    while not node.children().isEmpty():
        if node.nodeName() in ("Generate", "Filter"):
            seen.append((node.nodeName(), "__w" in node.output().mkString(",")))
        node = node.children().head()
    assert seen == [("Generate", False)]  # nor does a filter below cut the texts a second time
    got = rows(chunks, "doc_id", "chunk_index", "text")
    starts = [(d, t.split(), range(0, max(len(t.split()) - 120, 0) + 100, 100)) for d, t in enumerate(texts)]
    assert got == sorted(((d, i, " ".join(w[at : at + 120])) for d, w, ats in starts for i, at in enumerate(ats)), key=repr)


def test_table_chunks(spark):
    df = spark.createDataFrame([("s", i * 10, f"n{i}" if i else None) for i in range(7)], "sheet string, k bigint, name string")
    got = rows(chunk_table_rows(df, "sheet", "k", ["k", "name"], 3), "row_start", "row_end", "text")
    assert [(a, b) for a, b, _ in got] == [(1, 3), (4, 6), (7, 7)]
    assert got[0][2].split("\n")[0] == '{"k":0,"name":null}'


def test_catalog_status(spark):
    docs = spark.createDataFrame([(1, "s", "a.pdf", b"\x00\x01\xff", 1), (2, "s", "b", None, 2), (3, "s", "c.txt", b"", 1)], "doc_id int, source string, file_name string, content binary, version int")
    chunks = spark.createDataFrame([(1,), (1,), (3,)], "doc_id int")
    got = {r["doc_id"]: r for r in document_catalog(docs, chunks, chunks.where("doc_id = 1")).collect()}
    assert [got[i]["status"] for i in (1, 2, 3)] == ["ready", "failed", "processing"]
    assert got[1]["size_bytes"] == 3 and got[1]["mime_type"] == "application/pdf" and not got[2]["download_available"]


def test_keyset_pages_cover_everything(spark):
    same = datetime(2024, 1, 1)
    data = [(i, same if i % 3 else datetime(2024, 1, 2, 0, 0, 0, i), "ready" if i % 2 else "failed") for i in range(25)]
    catalog = spark.createDataFrame(data, "id int, created_at timestamp, status string")
    seen, cursor = [], ""
    while True:
        page = list_documents_keyset(catalog, 4, cursor, "ready").collect()
        seen += [r["id"] for r in page]
        cursor = page[0]["next_cursor"] if page else ""
        if not cursor:
            break
    assert seen == [i for _, i in sorted((c, i) for i, c, s in data if s == "ready")]
    assert decode_cursor(encode_cursor(datetime(2024, 1, 2, 0, 0, 0, 7), "a|b")) == (1704153600000007, "a|b")


def test_paged_listing(spark):
    page = paged_listing(spark.range(120), "id", 0, 100)
    assert [tuple(r) for r in page.collect()] == [(i, 120) for i in range(100, 120)]
    assert paged_listing(spark.range(120), "id", -1, 0).count() == 50


def test_originals(spark, folder):
    raw = bytes([0x00, 0x01, 0xFF, 0x56, 0x41])
    docs = spark.createDataFrame([(1, raw), (2, None), (3, b"x")], "doc_id int, content binary")
    ids = spark.createDataFrame([(1,), (2,), (9,)], "doc_id int")
    assert rows(get_originals(docs, ids)) == [(1, bytearray(raw))]
    with open(f"{folder}/a.bin", "wb") as f:
        f.write(raw)
    paths = spark.createDataFrame([(1, f"file:{folder}/a.bin")], "doc_id int, path string")
    assert rows(get_original_files(spark, paths, ids, folder)) == [(1, bytearray(raw))]


@pytest.fixture(scope="module")
def messages(spark):
    data = [(1, 0, "system", "s"), (1, 1, "user", "q1"), (1, 2, "assistant", "a1"), (1, 3, "user", "q2"), (2, 5, "user", "x" * 100), (3, 0, "system", "only")]
    return spark.createDataFrame(data, "conv_id int, turn bigint, role string, text string")


def test_sessions(spark, messages):
    history = {(r["conv_id"], r["turn"]): [m["content"] for m in r["history"]] for r in conversation_history(messages, 2).collect()}
    assert history == {(1, 1): ["s"], (1, 3): ["q1", "a1"], (2, 5): []}
    rolled = {r["conv_id"]: r for r in session_rollup(messages).collect()}
    assert rolled[1]["title"] == "q1" and len(rolled[2]["title"]) == 80 and rolled[3]["title"] is None
    assert [r["conv_id"] for r in session_rollup(messages, 2).orderBy("conv_id").collect()] == [1, 2]
    assert rows(list_messages(messages, 2).where("conv_id = 1"), "turn") == [(0,), (1,)]
    assert list_messages(messages, 0).count() == messages.count()
    assert rows(list_messages(messages, 2000), "place") == rows(list_messages(messages, 50), "place")
    assert delete_sessions(messages, messages.where("conv_id = 1")).count() == 2
    new = spark.createDataFrame([(1, 9, "user", "n2"), (1, 4, "user", "n1"), (7, 0, "user", "first")], "conv_id int, position bigint, role string, text string")
    all_rows = append_messages(messages, new)
    assert rows(all_rows.where("text IN ('n1', 'n2', 'first')"), "conv_id", "turn", "text") == [(1, 4, "n1"), (1, 5, "n2"), (7, 0, "first")]


def test_context_and_citations(spark):
    docs = spark.createDataFrame([(1, "red fox jumps", "s1"), (2, "blue fish swims", "s2"), (3, "red red fox", "s1")], "doc_id int, text string, source string")
    chunks = chunk_vectors(chunk_text(docs).withColumns({"page": F.lit(1), "sheet_name": F.lit("sh")}))
    asks = spark.createDataFrame([(1, "red fox")], "query_id int, query_text string")
    context = retrieve_context(asks, chunks, 2)
    assert [r["doc_id"] for r in context.orderBy("rank").collect()] == [3, 1] or context.count() == 2
    assert retrieve_context(asks, chunks).count() == 3
    index = build_sparse_index(chunks.select("id", "text"))
    assert {r["doc_id"] for r in retrieve_context(asks, chunks, 2, index).collect()} == {1, 3}
    cited = aggregate_citations(context)
    first = cited.where("citation = 1").first()
    assert first["chunk_count"] == 1 and first["pages"] == [1] and first["sheet_names"] == ["sh"] and first["chunks"][0]["rank"] == 1
    answers = spark.createDataFrame([(1, "as [2] and [1] say, [7] [x]")], "query_id int, answer string")
    marks = rows(resolve_inline_citations(answers, cited), "mark", "citation", "doc_id")
    assert [m[:2] for m in marks] == [(0, 2), (1, 1), (2, 7)] and marks[2][2] is None
    assert aggregate_citations(context, include_sources=False) is None


def test_lineage(spark):
    sources = spark.createDataFrame([(i, f"s{i}", "web") for i in range(4)], "source_id int, name string, type string")
    schedules = spark.createDataFrame([(0, 1, "n", True), (0, 2, "n", True), (1, 3, "n", False)], "source_id int, schedule_id int, name string, active boolean")
    jobs = spark.createDataFrame([(1, 1, False), (2, 2, True)], "source_id int, job_id int, in_flight boolean")
    refs = source_references(sources, schedules, jobs)
    assert rows(refs) == [(0, 2, 0, True), (1, 0, 0, False), (2, 0, 1, True), (3, 0, 0, False)]
    assert rows(unused_sources(sources, schedules, jobs), "source_id") == [(3,)]  # source 1 has finished rows only
    kept, deleted = cleanup_unused(sources, schedules, jobs, force=spark.createDataFrame([(0,)], "source_id int"))
    assert rows(deleted, "source_id") == [(0,), (3,)] and kept.count() == 2
    ids = spark.createDataFrame([(0,), (3,)], "source_id int")
    left, refused = delete_source(sources, refs, ids)
    assert left.count() == 3 and rows(refused) == [(0,)]
    left, refused = delete_source(sources, refs, ids, force=True)
    assert left.count() == 2 and refused.count() == 0
    runs = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2))], "source_id int, started_at timestamp")
    assert rows(newest_runs(runs, 1), "source_id") == [(2,)]


def test_collection_defaults():
    assert CollectionSpec("docs").with_defaults().dim == 2560
    assert CollectionSpec("docs").with_defaults().metric == "cosine"
    assert CollectionSpec("d", provider="openai", model="text-embedding-3-large").with_defaults().dim == 3072
    assert CollectionSpec("d", provider="openai", model="unknown", dim=512).with_defaults().dim == 512
    with pytest.raises(ValueError):
        CollectionSpec("d", provider="openai", model="unknown").with_defaults()
    with pytest.raises(ValueError):
        CollectionSpec("d", metric="hamming").with_defaults()


def test_collection_end_to_end(spark, folder):
    spec = CollectionSpec("docs", provider="local", model="hashing", schema=MetadataSchema((("price", "f32"),)))
    made = Collection.create(spark, folder + "/docs", spec)
    assert made.records().count() == 0
    docs = spark.createDataFrame([("red fox", {"lang": "en"}, 0), ("blue fish", {"lang": "de"}, 1)], "text string, metadata map<string,string>, position bigint")
    assert made.add_texts(docs.withColumn("id", unset_id())) == (2, 2)
    assert made.add_texts(docs.limit(1).withColumn("id", int_id(F.lit(42)))) == (1, 1)
    opened = Collection.open(spark, folder + "/docs")
    assert opened.spec == made.spec and opened.spec.dim == 64
    asks = spark.createDataFrame([(1, "red fox")], "query_id int, query_text string")
    hits = opened.search(asks, 5, filters={"lang": "en"})
    assert rows(hits, "id.kind", "score") == [("int", 1.0), ("str", 1.0)]
    assert "metadata" in hits.columns and "embedding" not in hits.columns
    full = opened.search(asks, 5, hybrid=True, alpha=0.7, rerank=True, include_documents=True, include_embeddings=True)
    best = full.where("rank = 1").first()
    assert (best["score"], best["doc_value"], len(best["embedding"])) == (1.0, "red fox", 64)
    assert "metadata" not in opened.search(asks, 5, include_metadata=False, rerank={"enabled": False}).columns
    ids = spark.createDataFrame([(0,)], "x int").select(int_id(F.lit(42)).alias("id"))
    assert opened.delete(ids) == 1 and opened.delete(ids) == 0
    assert opened.records().count() == 2
    opened.compact()
    assert opened.records().count() == 2 and opened.delete(ids) == 0
    assert opened.add_texts(docs.withColumn("id", unset_id())) == (2, 2)
    assert opened.records().count() == 2  # text-1 and text-2 again
    opened.compact()
    assert opened.records().count() == 2
    opened.update_schema([("tag", "string")])
    again = Collection.open(spark, folder + "/docs")
    assert again.spec.schema.version == 2 and [n for n, _ in again.spec.schema.fields] == ["price", "tag"]
    with pytest.raises(Exception):
        Collection.create(spark, folder + "/docs", spec)
    again.drop()
    with pytest.raises(Exception):
        Collection.open(spark, folder + "/docs")


def test_prepared_texts_need_no_metadata(spark):
    docs = spark.createDataFrame([("one", None, 3)], "text string, metadata map<string,string>, position bigint")
    assert rows(prepare_texts(docs.withColumn("id", unset_id())), "id.s", "metadata") == [("text-1", {"text": "one"})]
