"""Files, scopes, sync, web pages, threads, streams."""

import datetime
import os
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodestone.plans import registry
from lodestone.plans.answers import stream_lines
from lodestone.sources.files import FileReader, scan_object_files, write_object_files
from lodestone.sources.records import profile_columns, profile_source, profile_values, sample_source, scope_filter, thread_documents
from lodestone.sources.sync import apply_sync, content_hash, latest_version, sync_full, sync_incremental, to_load
from lodestone.sources.web import parse_selector, web_crawl_frontier, web_extract_content, web_page_assets
from lodestone.streaming.events import stream_answer_text, stream_event_assembly, stream_events
from lodestone.streaming.ingest import ingest_batch, ingested_catalog, ingested_vectors, stream_ingest


@pytest.fixture
def tree(folder):
    os.makedirs(f"{folder}/in/sub")
    for name, content in {"a.pdf": b"\x00\x01\xff\x56\x41", "b.txt": b"hello", "sub/c.txt": b"x" * 2_000_000, "d.bin": b"1", "README": b"r"}.items():
        with open(f"{folder}/in/{name}", "wb") as f:
            f.write(content)
    return f"{folder}/in"


def test_scan_files(spark, tree):
    assert scan_object_files(spark, tree).count() == 5
    assert rows(scan_object_files(spark, tree, ["*.txt", "*.pdf"]), "name") == [("a.pdf",), ("b.txt",), ("c.txt",)]
    assert rows(scan_object_files(spark, tree, ["*.txt"], max_file_size_mb=1), "name", "size_bytes") == [("b.txt", 5)]
    assert rows(scan_object_files(spark, tree, allowed_content_types=["text/plain"], max_file_size_mb=1), "name", "content_type") == [("b.txt", "text/plain; charset=utf-8")]
    assert [r["name"] for r in scan_object_files(spark, tree, max_files_per_job=2).orderBy("path").collect()] == ["README", "a.pdf"]
    kept = scan_object_files(spark, tree, ["*.pdf"], max_files_per_job=1, with_content=True).first()
    assert bytes(kept["content"]) == b"\x00\x01\xff\x56\x41"
    first = scan_object_files(spark, tree, max_files_per_job=2, with_content=True)
    assert rows(first, "name", "content") == [("README", b"r"), ("a.pdf", b"\x00\x01\xff\x56\x41")]
    with pytest.raises(Exception, match="nowhere"):
        scan_object_files(spark, f"{tree}/nowhere").count()


def test_scan_keeps_empty_and_hidden_files_and_pushes_predicates(spark, folder):
    data = [("a/.hidden", "x"), ("a/_b.TXT", None), ("c.txt", "y" * 100), ("c.txt", "z"), ("d e%20.md", "é")]
    table = spark.createDataFrame(data, "path string, content string")
    written = write_object_files(table, f"{folder}/t")
    assert rows(written) == [("a/.hidden", 1), ("a/_b.TXT", 0), ("c.txt", 100), ("d e%20.md", 2)]
    for root in (f"{folder}/t", f"file://{folder}/t", f"file:{folder}/t/"):
        files = scan_object_files(spark, root, with_content=True)
        assert rows(files, "name", "size_bytes", "content") == [(".hidden", 1, b"x"), ("_b.TXT", 0, b""), ("c.txt", 100, b"y" * 100), ("d e%20.md", 2, "é".encode())]
        assert rows(scan_object_files(spark, root, ["*.TXT", ".*"]), "name") == [(".hidden",), ("_b.TXT",)]
    asked = files.where("size_bytes > 0 AND content_type LIKE 'text/%' AND name IN ('c.txt', '_b.TXT') AND modified > '2020-01-01'")
    assert rows(asked, "name") == [("c.txt",)]
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("PushedFilters", "").split("BatchScan")[0]
    assert scan_object_files(spark, f"{folder}/t", allowed_content_types=["text/none"]).count() == 0
    with pytest.raises(Exception, match="no path below"):
        write_object_files(spark.createDataFrame([("../x", "")], "path string, content string"), f"{folder}/t").count()


def test_files_are_packed_by_bytes(spark, folder):
    data = [(f"{i:02}", "x" * (2_000_000 if i == 3 else 10)) for i in range(12)]
    write_object_files(spark.createDataFrame(data, "path string, content string"), f"{folder}/t").count()
    reader = FileReader({"path": f"{folder}/t", "content": "true", "partitionBytes": str(4 << 20)})
    parts = [[row[1] for row in p.files] for p in reader.partitions()]
    assert parts == [["00", "01", "02"], ["03", "04"], ["05", "06", "07"], ["08", "09", "10"], ["11"]]
    assert [[r[1] for r in p.files] for p in FileReader({"path": f"{folder}/t"}).partitions()] == [[p for p, _ in data]]


def test_scope(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, space string")
    assert scope_filter(df, "space", None).count() == scope_filter(df, "space", []).count() == 3
    assert rows(scope_filter(df, "space", ["a"]), "id") == [(1,)]
    listed = spark.createDataFrame([("b",), ("b",)], "s string")
    assert rows(scope_filter(df, "space", listed), "id") == [(2,)]


def test_sample_and_profile(spark):
    df = spark.createDataFrame([(1, "x"), (1, " "), (None, "long text"), (2, None)], "id int, text string")
    assert sample_source(df, "id", 2).count() == 2
    ids = spark.range(50)
    assert rows(sample_source(ids.repartition(3), "id", 9)) == rows(sample_source(ids, "id", 9))
    assert sample_source(df, "id", 2, enabled=False).count() == 4
    got = {r["check_name"]: (r["n"], r["passed"], r["message"]) for r in profile_source(df, "id", "text", 5).collect()}
    assert got == {"records": (4, True, ""), "null_id": (1, False, "null_id: 1"), "empty_text": (2, False, "empty_text: 2"),
                   "duplicate_id": (1, False, "duplicate_id: 1"), "oversize": (1, False, "oversize: 1")}
    assert profile_columns(df) == [("id", "int"), ("text", "string")]


def test_profile_of_values(spark):
    texts = ["1", "-2.5e3", ".5", "TRUE", "2026-01-02", "2026-01-02T03:04:05Z", "x", "", "12\n", None, "1" * 30]
    data = [(i, t, float(i), b"\x01", [1]) for i, t in enumerate(texts)]
    table = spark.createDataFrame(data, "ID int, `a.b` string, x double, raw binary, list array<int>")
    got = {r["column_name"]: r for r in profile_values(table.repartition(5), {"a.B": "float", "id": "integer"}).collect()}
    assert sorted(got) == ["a.b", "id", "raw", "x"]
    r = got["a.b"]
    assert (r.n, r.n_null, r.n_whole, r.n_number, r.n_boolean, r.n_time, r.n_text) == (11, 1, 1, 3, 1, 2, 3)
    assert (r.n_misfit, r.passed, r.message, r.longest) == (6, False, "a.b: 6 not float", 30)
    assert got["id"].passed and (got["id"].min_value, got["id"].max_value) == ("0", "10") and got["id"].approx_distinct == 11
    assert got["raw"].samples == ["01"] and got["x"].n_number == 11
    again = {r["column_name"]: r for r in profile_values(table, {"a.b": "float", "id": "integer"}).collect()}
    assert again == got and set(r.samples) <= set(texts)
    empty = profile_values(table.limit(0)).where("column_name = 'x'").first()
    assert (empty.n, empty.samples, empty.min_value, empty.longest, empty.passed) == (0, [], None, 0, True)
    with pytest.raises(ValueError, match="lacks"):
        profile_values(table, {"none": "float"})


@pytest.fixture
def synced(spark):
    snapshot = spark.createDataFrame([("a", "1"), ("b", "2 v2"), ("n", "new")], "external_id string, content string")
    old = spark.createDataFrame([("a", "1"), ("b", "2"), ("gone", "3")], "external_id string, content string")
    return snapshot, content_hash(old).withColumn("version", F.lit(4))


def test_sync(synced):
    snapshot, catalog = synced
    partial = sync_incremental(snapshot, catalog)
    assert rows(partial, "external_id", "action", "version") == [("a", "unchanged", 4), ("b", "changed", 5), ("n", "new", 1)]
    full = sync_full(snapshot, catalog)
    assert ("gone", "deleted", 4) in rows(full, "external_id", "action", "version")
    assert rows(to_load(snapshot, partial), "external_id", "content") == [("b", "2 v2"), ("n", "new")]
    after = apply_sync(catalog, full)
    assert {r["action"] for r in sync_full(snapshot, after).collect()} == {"unchanged"}  # a second run does nothing
    assert apply_sync(catalog, partial).count() == 4
    assert rows(latest_version(catalog.unionByName(catalog.withColumn("version", F.lit(9)))), "version") == [(9,)] * 3


def test_frontier(spark):
    edges = spark.createDataFrame([("http://a/1", "http://a/2"), ("http://a/2", "http://a/1"), ("http://a/2", "http://a/3"), ("http://a/1", "http://b/9"), ("http://a/3", "http://a/4")], "src string, dst string")
    start = spark.createDataFrame([("http://a/1",)], "url string")
    everything = [("http://a/1", 0), ("http://a/2", 1), ("http://a/3", 2), ("http://a/4", 3), ("http://b/9", 1)]
    assert rows(web_crawl_frontier(edges, start)) == everything
    assert rows(web_crawl_frontier(edges, start, 1)) == [e for e in everything if e[1] <= 1]
    assert rows(web_crawl_frontier(edges, start, allowed_domains=["a"])) == [e for e in everything if "/b/" not in e[0]]
    assert rows(web_crawl_frontier(edges, start, max_pages=2)) == everything[:2]
    assert web_crawl_frontier(edges, start.limit(0)).count() == 0


HTML = """<html><head><title>The &amp; Title</title><link rel="stylesheet" href="/s.css"><script src="/x.js">if (1 < 2) {}</script></head>
<body><nav>menu</nav><main id="m" class="wide big"><h1>Head</h1><p>One <b>b</b>old<br>next</p><div class="ad">buy</div></main>
<article>Story<p>two</article><img src="i.png"><a href="/doc.pdf?x=1">d</a><a href="/page">p</a></body></html>"""


def test_extract(spark):
    pages = spark.createDataFrame([("http://h/p/", HTML), ("http://h/q", "<p>plain<style>x</style>"), ("http://h/r", None), ("http://h/s", "<body>just body</body>")], "url string, html string")
    got = {r["url"]: (r["title"], r["content"]) for r in web_extract_content(pages).collect()}
    assert got["http://h/p/"] == ("The & Title", "Story\ntwo")
    assert got["http://h/s"] == ("", "just body") and got["http://h/r"] == ("", "")
    chosen = web_extract_content(pages, "main.wide#m p, h1", "h1", [".ad"]).where("url = 'http://h/p/'").first()
    assert (chosen["title"], chosen["content"]) == ("Head", "Head\nOne bold\nnext")
    with pytest.raises(ValueError):
        parse_selector("a > b")
    assets = [tuple(r) for r in web_page_assets(pages).orderBy("position").collect()]
    assert [(a[2], a[4]) for a in assets] == [("link", "http://h/s.css"), ("script", "http://h/x.js"), ("img", "http://h/p/i.png"), ("a", "http://h/doc.pdf?x=1")]
    assert web_page_assets(pages, max_assets_per_page=2).count() == 2
    assert web_page_assets(pages, include_assets=False).count() == 0
    assert web_page_assets(pages, all_links=True).count() == 5


def test_long_thread_becomes_parts(spark):
    df = spark.createDataFrame([(1, i, "u", f"m{i}") for i in range(10)] + [(2, 3, "u", "only")], "t int, n bigint, role string, text string")
    whole = rows(thread_documents(df, "t", "n", F.col("text")), "t", "part", "messages")
    assert whole == [(1, 0, 10), (2, 0, 1)]
    parts = thread_documents(df, "t", "n", F.col("text"), part_size=4).where("t = 1").orderBy("part").collect()
    assert [p["messages"] for p in parts] == [4, 4, 2]
    assert "\n".join(p["text"] for p in parts) == "\n".join(f"m{i}" for i in range(10))
    heads = thread_documents(df, "t", "n", F.col("text"), include_comments=False)
    assert rows(heads, "t", "text") == [(1, "m0"), (2, "only")]


EDGES = [
    ("two events", ["event: message", 'data: {"chunk_type":"text","content":"hi"}', "", 'data: {"chunk_type":"done"}', ""], [("message", "text", "hi"), ("", "done", "")]),
    ("last name wins", ["event: a", "event: b", "data: x", ""], [("b", "", "")]),
    ("name is forgotten", ["event: a", "", "data: x", ""], [("", "", "")]),
    ("open end", [": c", "data: {", 'data: "content": "z"}'], [("", "", "z")]),
    ("json name, any case", ["event: a", 'data: {"EVENT":"j","Content":"c"}', ""], [("j", "", "c")]),
    ("not a string", ['data: {"content": 5, "chunk_type": "text"}', ""], [("", "text", "")]),
    ("returns and other fields", ["id: 1\r", "retry: 5\r", "data:  y  \r", "\r"], [("", "", "")]),
    ("no data at all", ["event: a", ":x", "", ""], []),
    ("json list", ["data: [1]", ""], [("", "", "")]),
]


def line_table(spark, cases):
    data = [(i, n, line) for i, (_, lines, _) in enumerate(cases) for n, line in enumerate(lines)]
    return spark.createDataFrame(data, "stream_id bigint, line_no bigint, line string")


def by_stream(events):
    out = {}
    for r in events.orderBy("stream_id", "event_no").collect():
        assert r["event_no"] == len(out.setdefault(r["stream_id"], []))
        out[r["stream_id"]].append((r["event"], r["chunk_type"], r["content"]))
    return out


def test_event_rules(spark):
    got = by_stream(stream_event_assembly(line_table(spark, EDGES)))
    for i, (name, _, want) in enumerate(EDGES):
        assert got.get(i, []) == want, name


def test_raw_joins_data_lines(spark):
    events = stream_event_assembly(line_table(spark, [("x", ["data: a", "data:b ", ""], None)]))
    assert rows(events, "raw") == [("a\nb",)]


def test_answers(spark):
    data = [(1, i, "text", str(i)) for i in range(5)] + [(1, 5, "done", ""), (2, 0, "status", "s")]
    events = spark.createDataFrame(data, "stream_id int, event_no bigint, chunk_type string, content string")
    assert rows(stream_answer_text(events)) == [(1, 0, "01234", True), (2, 0, "", False)]
    assert rows(stream_answer_text(events, 2).where("stream_id = 1"), "part", "answer") == [(0, "01"), (1, "23"), (2, "4")]


def run_stream(spark, lines_dir, folder, schema):
    lines = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(lines_dir)
    query = (
        stream_events(lines).writeStream.format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).outputMode("append").start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def test_streaming_events_equal_batch(spark, sf, folder):
    """Lines arrive in several micro-batches that cut events apart, out of order."""
    lines = stream_lines(spark, sf)
    dense = lines.groupBy("stream_id").agg(F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("l"))
    dense = dense.select("stream_id", F.posexplode("l").alias("line_no", "x")).select("stream_id", F.col("line_no").cast("bigint"), "x.line")
    ends = dense.groupBy("stream_id").agg((F.max("line_no") + 1).alias("line_no"), F.lit(None).cast("string").alias("line"))
    for part in range(3):
        chosen = dense.unionByName(ends).where(F.pmod(F.xxhash64("stream_id", "line_no"), F.lit(3)) == part)
        chosen.coalesce(1).write.parquet(f"{folder}/lines", mode="append")
        time.sleep(0.01)
    got = run_stream(spark, f"{folder}/lines", folder, "stream_id bigint, line_no bigint, line string")
    want = stream_event_assembly(dense)
    columns = ["stream_id", "event_no", "event", "raw", "chunk_type", "content"]
    assert rows(got, *columns) == rows(want, *columns)


def test_silent_streams_end_and_repeats_emit_nothing(spark, folder):
    """A stream without an end, one replayed after its end, one with a gap."""

    def at(minute):
        return datetime.datetime(2026, 1, 1, 0, 0) + datetime.timedelta(minutes=minute)

    clock = [(99, i, f"data: {i}", at(m)) for i, m in enumerate((0, 1, 2, 20, 40, 55))]
    ended = [(1, 0, "event: a"), (1, 1, "data: x"), (1, 2, None)]
    batches = [
        [clock[0], *[(*r, at(0)) for r in ended], (2, 0, "data: open", at(0)), (3, 0, "data: p", at(0)), (3, 3, "data: r", at(0)), (3, 2, "", at(0))],
        [clock[1], *[(*r, at(1)) for r in ended], (2, 1, "data: still", at(1))],  # a replay within the horizon
        [clock[2]],
        [clock[3]],  # streams 2 and 3 have been silent for ten minutes
        [clock[4], (3, 1, "data: q", at(24)), (3, 1, "data: q", at(29))],  # stream 3 is remembered still
        [clock[5], *[(*r, at(54)) for r in ended]],  # stream 1 no longer
    ]
    for batch in batches:
        kind = "stream_id bigint, line_no bigint, line string, ts timestamp"
        spark.createDataFrame(batch, kind).coalesce(1).write.parquet(f"{folder}/lines", mode="append")
        time.sleep(0.05)
    lines = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{folder}/lines")
    events = stream_events(lines, "ts", "1 minute", idle_seconds=600, horizon_seconds=1_200)
    writer = events.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp")
    query = writer.trigger(availableNow=True).outputMode("append").start()
    assert query.awaitTermination(120)
    got = rows(spark.read.parquet(f"{folder}/out").where("stream_id < 99"), "stream_id", "event_no", "event", "raw")
    assert got == [(1, 0, "a", "x"), (1, 0, "a", "x"), (2, 0, "", "open\nstill"), (3, 0, "", "p"), (3, 1, "", "r")]
    held = spark.read.format("statestore").option("stateVarName", "due").load(f"{folder}/cp").selectExpr("key.stream_id", "value.ended")
    assert rows(held) == [(1, True), (99, False)]


def test_stream_ingest_incremental(spark, folder):
    def put(data):
        spark.createDataFrame(data, "external_id string, content string").coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def run():
        stream = spark.readStream.schema("external_id string, content string").parquet(f"{folder}/in")
        stream_ingest(stream, f"{folder}/t").awaitTermination()

    put([("a", "one two"), ("b", "three")])
    run()
    assert rows(ingested_catalog(spark, f"{folder}/t"), "external_id", "version") == [("a", 1), ("b", 1)]
    put([("a", "one two"), ("b", "three changed"), ("c", "new"), ("c", "new")])
    run()
    assert rows(ingested_catalog(spark, f"{folder}/t"), "external_id", "version") == [("a", 1), ("b", 2), ("c", 1)]
    vectors = rows(ingested_vectors(spark, f"{folder}/t"), "external_id", "version", "chunk_index", "text")
    assert vectors == [("a", 1, 0, "one two"), ("b", 2, 0, "three changed"), ("c", 1, 0, "new")]
    # Replaying the last batch rewrites the same rows.
    again = spark.createDataFrame([("a", "one two"), ("b", "three changed"), ("c", "new")], "external_id string, content string")
    ingest_batch(again, 1, f"{folder}/t")
    assert rows(ingested_vectors(spark, f"{folder}/t"), "external_id", "version", "chunk_index", "text") == vectors


def test_stream_ingest_reads_a_table_of_several_files(spark, folder):
    texts = [(i, f"text number {i}", "en", "web", 13) for i in range(6)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, lang string, source string, n_chars int")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    got = rows(registry.QUERIES["stream_ingest"](spark, folder), "external_id", "chunk_index", "dim")
    assert got == [(str(i), 0, 64) for i in range(6)]
