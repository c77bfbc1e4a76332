"""Sources, sync, chunking, the catalog and continuous ingestion."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.scalars import (
    default_source_name,
    first_nonempty_id,
    mime_from_extension,
    slug,
)
from lodestone.operators.catalog import (
    document_catalog,
    encode_cursor,
    get_originals,
    list_documents_keyset,
    paged_listing,
)
from lodestone.operators.chunk import chunk_table_rows, chunk_text
from lodestone.plans.base import query, table, text_table
from lodestone.session import scratch_path
from lodestone.sources.files import scan_object_files, write_object_files
from lodestone.sources.records import (
    ACCEPTS,
    KINDS,
    profile_source,
    profile_values,
    sample_source,
    scope_filter,
    thread_documents,
)
from lodestone.sources.sync import sync_full, sync_incremental
from lodestone.sources.web import page_links, web_crawl_frontier, web_extract_content, web_page_assets
from lodestone.streaming.ingest import ingested_vectors, stream_ingest
from lodestone.streaming.source_runs import ingest_source, runs, source_catalog, source_vectors

SQL_SLUG = "coalesce(nullif(trim(regexp_replace(lower({0}), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'source')"


@query("slug", f"SELECT doc_id, {SQL_SLUG.format('text')} AS slug FROM documents")
def _slug(spark: SparkSession, folder: str) -> DataFrame:
    return text_table(spark, folder, "documents").select("doc_id", slug(F.col("text")).alias("slug"))


SQL_HOST = "regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)"


@query(
    "default_source_name",
    f"""SELECT 'web' AS type, page_id AS id, 'web-' || {SQL_SLUG.format(SQL_HOST)} AS name FROM pages
UNION ALL SELECT 's3', s_suppkey, 's3-' || {SQL_SLUG.format('s_name')} FROM supplier
UNION ALL SELECT 'jira', n_nationkey, CASE WHEN n_regionkey = 0 THEN 'jira' ELSE 'jira-' || {SQL_SLUG.format('n_name')} END FROM nation
UNION ALL SELECT 'gdrive', r_regionkey, 'gdrive-source' FROM region
UNION ALL SELECT 'confluence', c_custkey, CASE WHEN c_acctbal < 0 THEN c_name ELSE 'confluence-' || {SQL_SLUG.format('c_mktsegment')} END FROM customer""",
)
def _default_source_name(spark: SparkSession, folder: str) -> DataFrame:
    def rows(name: str, kind: str, id_col: str, explicit: object = "", **options: object) -> DataFrame:
        given = explicit if not isinstance(explicit, str) else F.lit(explicit)
        named = default_source_name(F.lit(kind), given, **options)
        return table(spark, folder, name).select(
            F.lit(kind).alias("type"), F.col(id_col).cast("bigint").alias("id"), named.alias("name")
        )

    parts = [
        rows("pages", "web", "page_id", url=F.col("url")),
        rows("supplier", "s3", "s_suppkey", bucket=F.col("s_name")),
        rows("nation", "jira", "n_nationkey", project=F.when(F.col("n_regionkey") != 0, F.col("n_name"))),
        rows("region", "gdrive", "r_regionkey", drive=F.lit(""), folder=F.lit("")),
        rows(
            "customer", "confluence", "c_custkey",
            F.when(F.col("c_acctbal") < 0, F.col("c_name")).otherwise(""), space=F.col("c_mktsegment"),
        ),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


@query(
    "first_nonempty_id",
    """SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_name WHEN c_nationkey < 12 THEN 'n' || c_nationkey
  WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS resolved_id FROM customer""",
)
def _first_nonempty_id(spark: SparkSession, folder: str) -> DataFrame:
    resolved = first_nonempty_id(
        F.when(F.col("c_acctbal") > 0, F.col("c_name")).otherwise(""),
        F.when(F.col("c_nationkey") < 12, F.concat(F.lit("n"), "c_nationkey")),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).otherwise(""),
    )
    return table(spark, folder, "customer").select("c_custkey", resolved.alias("resolved_id"))


EXTENSIONS = {"en": "PDF", "fr": "txt", "es": "html"}


def file_names() -> Column:
    ext = F.create_map(*[F.lit(x) for pair in EXTENSIONS.items() for x in pair])
    suffix = F.coalesce(F.concat(F.lit("."), F.try_element_at(ext, F.col("lang"))), F.lit(""))
    return F.concat(F.col("source"), F.lit("/v1.2/"), F.col("doc_id"), suffix)


SQL_FILE = "source || '/v1.2/' || doc_id || CASE lang WHEN 'en' THEN '.PDF' WHEN 'fr' THEN '.txt' WHEN 'es' THEN '.html' ELSE '' END"
SQL_MIME = """CASE lang WHEN 'en' THEN 'application/pdf' WHEN 'fr' THEN 'text/plain; charset=utf-8'
  WHEN 'es' THEN 'text/html; charset=utf-8' ELSE 'application/octet-stream' END"""


@query("mime_from_extension", f"SELECT doc_id, {SQL_FILE} AS file_name, {SQL_MIME} AS mime_type FROM documents")
def _mime_from_extension(spark: SparkSession, folder: str) -> DataFrame:
    named = table(spark, folder, "documents").select("doc_id", file_names().alias("file_name"))
    return named.withColumn("mime_type", mime_from_extension(F.col("file_name")))


# One file per document: those in German have hidden names, those in Spanish are not asked for.
SQL_OBJECT = f"source || '/' || CASE lang WHEN 'de' THEN '_' ELSE '' END || doc_id || CASE lang WHEN 'en' THEN '.PDF' WHEN 'fr' THEN '.txt' WHEN 'es' THEN '.html' ELSE '' END"


@query(
    "scan_object_files",
    f"""SELECT {SQL_OBJECT} AS path, regexp_extract({SQL_OBJECT}, '[^/]*$') AS name, strlen(coalesce(text, ''))::BIGINT AS size_bytes,
  {SQL_MIME} AS content_type, sha256(coalesce(text, '')) AS content_hash FROM documents
WHERE lang IS DISTINCT FROM 'es' AND strlen(coalesce(text, '')) <= 1048576""",
)
def _scan_object_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    ext = F.create_map(*[F.lit(x) for x in ("en", ".PDF", "fr", ".txt", "es", ".html")])
    hidden = F.when(F.col("lang") == "de", "_").otherwise("")
    suffix = F.coalesce(F.try_element_at(ext, F.col("lang")), F.lit(""))
    path = F.concat(F.col("source"), F.lit("/"), hidden, F.col("doc_id"), suffix)
    root = scratch_path(spark, "objects")
    write_object_files(docs.select(path.alias("path"), F.col("text").alias("content")), root).agg(F.count("*")).first()
    files = scan_object_files(
        spark,
        root,
        ["*.PDF", "*.txt", "*[0-9]"],
        max_file_size_mb=1,
        allowed_content_types=["text/plain", "application/pdf", "application/octet-stream"],
        with_content=True,
    )
    below = F.array_join(F.slice(F.split("path", "/"), -2, 2), "/")
    return files.select(below.alias("path"), "name", "size_bytes", "content_type", F.sha2("content", 256).alias("content_hash"))


@query(
    "scope_filter",
    "SELECT doc_id, lang, source FROM documents WHERE lang IN ('en', 'de') AND doc_id IN (SELECT doc_id FROM labels WHERE toxic = 0)",
)
def _scope_filter(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source")
    safe = table(spark, folder, "labels").where("toxic = 0").select("doc_id")
    return scope_filter(scope_filter(scope_filter(docs, "lang", ["en", "de"]), "doc_id", safe), "source", [])


# The catalog holds the labelled documents, the toxic ones with their text blanked, and every
# benchmark passage; the snapshot is all documents.
SQL_SYNC = """ca AS (SELECT 'doc-' || doc_id AS external_id, sha256(CASE WHEN toxic = 1 THEN '' ELSE text END) AS h, 1 + quality AS v
  FROM documents JOIN labels USING (doc_id) UNION ALL SELECT 'item-' || item_id, sha256(text), 1 FROM benchmark),
sn AS (SELECT 'doc-' || doc_id AS external_id, sha256(text) AS h FROM documents)"""
SQL_DIFF = """SELECT external_id, CASE WHEN ca.v IS NULL THEN 'new' WHEN sn.h IS NULL THEN 'deleted'
    WHEN sn.h = ca.h THEN 'unchanged' ELSE 'changed' END AS action,
  CASE WHEN ca.v IS NULL THEN 1 WHEN sn.h <> ca.h THEN ca.v + 1 ELSE ca.v END AS version, coalesce(sn.h, ca.h) AS content_hash
FROM sn {0} JOIN ca USING (external_id)"""


def sync_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    known = docs.join(table(spark, folder, "labels"), "doc_id").select(
        F.concat(F.lit("doc-"), "doc_id").alias("external_id"),
        F.sha2(F.when(F.col("toxic") == 1, "").otherwise(F.col("text")), 256).alias("content_hash"),
        (F.col("quality") + 1).alias("version"),
    )
    gone = table(spark, folder, "benchmark").select(
        F.concat(F.lit("item-"), "item_id").alias("external_id"),
        F.sha2("text", 256).alias("content_hash"),
        F.lit(1).alias("version"),
    )
    snapshot = docs.select(F.concat(F.lit("doc-"), "doc_id").alias("external_id"), F.col("text").alias("content"))
    return snapshot, known.unionByName(gone)


@query("sync_incremental", f"WITH {SQL_SYNC} {SQL_DIFF.format('LEFT')}")
def _sync_incremental(spark: SparkSession, folder: str) -> DataFrame:
    return sync_incremental(*sync_tables(spark, folder))


@query("sync_full", f"WITH {SQL_SYNC} {SQL_DIFF.format('FULL OUTER')}")
def _sync_full(spark: SparkSession, folder: str) -> DataFrame:
    return sync_full(*sync_tables(spark, folder))


# Links name a word; the page a word leads to is the first by url whose title starts with it.
SQL_GRAPH = """li AS (SELECT url, lower(unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*?href=["'']/([^"''#]+)', 1))) AS word FROM pages),
la AS (SELECT lower(regexp_extract(html, '<title>([^\\s<]+)', 1)) AS word, min(url) AS dst FROM pages GROUP BY 1),
ed AS (SELECT DISTINCT url AS src, dst FROM li JOIN la USING (word)),
st AS (SELECT min(url) AS url FROM pages GROUP BY regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1))"""


def link_graph(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    pages = table(spark, folder, "pages")
    word = F.lower(F.regexp_extract("html", r"<title>([^\s<]+)", 1))
    landing = pages.select("url", word.alias("word")).groupBy("word").agg(F.min("url").alias("dst"))
    links = page_links(pages).select("url", F.lower(F.regexp_replace("href", "^/", "")).alias("word"))
    edges = links.join(landing, "word").select(F.col("url").alias("src"), "dst")
    host = F.regexp_extract("url", "^[a-z]+://([^/:?#]+)", 1)
    start = pages.groupBy(host.alias("host")).agg(F.min("url").alias("url")).select("url")
    return edges, start


@query(
    "web_crawl_frontier",
    f"""WITH RECURSIVE {SQL_GRAPH},
w(url, depth) AS (SELECT url, 0 FROM st UNION SELECT dst, depth + 1 FROM w JOIN ed ON src = url WHERE depth < 4)
SELECT url, min(depth) AS depth FROM w GROUP BY url""",
)
def _web_crawl_frontier(spark: SparkSession, folder: str) -> DataFrame:
    edges, start = link_graph(spark, folder)
    return web_crawl_frontier(edges, start, max_depth=4)


SQL_CONTENT = r"""WITH p AS (SELECT url, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS t,
  regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS a FROM pages),
b AS (SELECT url, t, regexp_replace(regexp_replace(a, '</?(h1|h2|h3|p|br|div|ul|ol|li|table|tr|td|th|section|pre)( [^>]*)?>', chr(10), 'g'),
  '</?[a-z][^>]*>|<!--.*?-->', '', 'g') AS c FROM p),
e AS (SELECT url, list_transform([t, c], lambda s: regexp_replace(replace(replace(replace(replace(replace(replace(s,
  '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&copy;', '©'), '&amp;?', '&', 'g')) AS d FROM b)
SELECT url, trim(regexp_replace(d[1], '\s+', ' ', 'g')) AS title, array_to_string(list_filter(list_transform(
  string_split(d[2], chr(10)), lambda l: trim(regexp_replace(l, '\s+', ' ', 'g'))), lambda l: l <> ''), chr(10)) AS content FROM e"""


@query("web_extract_content", SQL_CONTENT)
def _web_extract_content(spark: SparkSession, folder: str) -> DataFrame:
    return web_extract_content(text_table(spark, folder, "pages"), exclude=["footer", ".ad"])


@query(
    "web_page_assets",
    """SELECT url, (unnest(generate_series(1, len(h))) - 1)::INTEGER AS position, 'a' AS tag, unnest(h) AS target
FROM (SELECT url, regexp_extract_all(html, '<a\\s[^>]*?href=["'']([^"'']+)', 1) AS h FROM pages)""",
)
def _web_page_assets(spark: SparkSession, folder: str) -> DataFrame:
    assets = web_page_assets(text_table(spark, folder, "pages"), all_links=True)
    return assets.select("url", "position", "tag", "target")


@query(
    "thread_documents",
    """SELECT conv_id, 0 AS part, count(*) AS messages, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS text
FROM conversations GROUP BY conv_id""",
)
def _thread_documents(spark: SparkSession, folder: str) -> DataFrame:
    line = F.concat("role", F.lit(": "), "text")
    return thread_documents(table(spark, folder, "conversations"), "conv_id", "turn", line)


@query(
    "thread_documents_heads",
    """SELECT conv_id, 0 AS part, 1 AS messages, arg_min(role || ': ' || text, turn) AS text FROM conversations GROUP BY conv_id""",
)
def _thread_documents_heads(spark: SparkSession, folder: str) -> DataFrame:
    line = F.concat("role", F.lit(": "), "text")
    return thread_documents(table(spark, folder, "conversations"), "conv_id", "turn", line, include_comments=False)


@query("sample_source", "SELECT c_custkey, c_name FROM customer ORDER BY md5(c_custkey::VARCHAR), c_custkey LIMIT 100")
def _sample_source(spark: SparkSession, folder: str) -> DataFrame:
    return sample_source(table(spark, folder, "customer"), "c_custkey", 100).select("c_custkey", "c_name")


@query(
    "profile_source",
    """WITH r AS (SELECT source AS id, text FROM documents),
t AS (SELECT count(*) AS records, count(*) FILTER (id IS NULL) AS null_id, count(*) FILTER (text IS NULL OR trim(text, ' ') = '') AS empty_text,
  count(id) - count(DISTINCT id) AS duplicate_id, count(*) FILTER (strlen(text) > 50000) AS oversize FROM r)
SELECT check_name, n, ok AS passed, CASE WHEN ok THEN '' ELSE check_name || ': ' || n END AS message
FROM (SELECT *, CASE WHEN check_name = 'records' THEN n > 0 ELSE n = 0 END AS ok FROM (UNPIVOT t ON COLUMNS(*) INTO NAME check_name VALUE n))""",
)
def _profile_source(spark: SparkSession, folder: str) -> DataFrame:
    return profile_source(table(spark, folder, "documents"), "source", "text", 50_000)


# The first run of digits of a text with the letters behind it; such a one is not a number.
SQL_FACTS = {"doc_id": "integer", "lang": "string", "source": "string", "n_chars": "integer", "figure": "integer", "day": "datetime"}


def _sql_profile() -> str:
    kinds = [f"WHEN regexp_full_match(t, '{p}') THEN '{k}'" for k, p in KINDS.items()]
    parts = []
    for name, declared in SQL_FACTS.items():
        bad = [k for k in (*KINDS, "text") if k not in ACCEPTS[declared]]
        misfit = f"count(*) FILTER (k IN ({', '.join(repr(k) for k in bad)}))" if bad else "0"
        counts = ", ".join(f"count(*) FILTER (k = '{k}') AS n_{k}" for k in (*KINDS, "text"))
        picks = ", ".join(f"arg_min(t, md5('{i}:' || t))" for i in range(3))
        parts.append(
            f"""SELECT *, n_misfit = 0 AS passed, CASE WHEN n_misfit > 0 THEN '{name}: ' || n_misfit || ' not {declared}' ELSE '' END AS message FROM (
SELECT '{name}' AS column_name, '{"bigint" if name in ("doc_id", "n_chars") else "string"}' AS data_type, count(*) AS n, count(*) - count(v) AS n_null, {counts},
  min(v)::VARCHAR AS min_value, max(v)::VARCHAR AS max_value, coalesce(max(length(t)), 0)::INTEGER AS longest,
  array_to_string(list_sort(list_distinct([{picks}])), '|') AS samples, '{declared}' AS declared, {misfit}::BIGINT AS n_misfit
FROM (SELECT *, CASE WHEN t IS NULL THEN NULL {' '.join(kinds)} ELSE 'text' END AS k FROM (SELECT {name} AS v, {name}::VARCHAR AS t FROM r)))"""
        )
    return """WITH r AS (SELECT doc_id::BIGINT AS doc_id, lang, source, n_chars::BIGINT AS n_chars, nullif(regexp_extract(text, '[0-9]+[a-z]*'), '') AS figure,
  nullif(regexp_extract(text, '[0-9]+-[0-9]+-[0-9]+'), '') AS day FROM documents)
""" + "\nUNION ALL ".join(parts)


@query("profile_values", _sql_profile())
def _profile_values(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        F.col("doc_id").cast("bigint").alias("Doc_ID"),
        "lang",
        "source",
        F.col("n_chars").cast("bigint").alias(" n_chars "),
        F.nullif(F.regexp_extract("text", "[0-9]+[a-z]*", 0), F.lit("")).alias("figure"),
        F.nullif(F.regexp_extract("text", "[0-9]+-[0-9]+-[0-9]+", 0), F.lit("")).alias("day"),
    )
    found = profile_values(docs, SQL_FACTS).drop("approx_distinct")
    return found.withColumn("samples", F.array_join(F.array_sort("samples"), "|"))


SQL_CHUNKS = """wd AS (SELECT doc_id, string_split(trim(regexp_replace(text, '\\s+', ' ', 'g'), ' '), ' ') AS w FROM documents),
ch AS (SELECT doc_id, i::INTEGER AS chunk_index, array_to_string(w[i * 100 + 1 : i * 100 + 120], ' ') AS text
  FROM (SELECT doc_id, w, unnest(range(ceil(greatest(len(w) - 120, 0) / 100)::BIGINT + 1)) AS i FROM wd))"""


@query("chunk_text", f"WITH {SQL_CHUNKS} SELECT doc_id, chunk_index, text FROM ch")
def _chunk_text(spark: SparkSession, folder: str) -> DataFrame:
    return chunk_text(text_table(spark, folder, "documents", "doc_id", "text"))


@query(
    "chunk_table_rows",
    """WITH p AS (SELECT p_brand, p_partkey, p_name, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n FROM part)
SELECT p_brand AS sheet_name, (n - 1) // 20 AS chunk_index, min(n) AS row_start, max(n) AS row_end,
  string_agg('{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '","p_size":' || p_size || '}', chr(10) ORDER BY n) AS text,
  'p_partkey,p_name,p_size' AS column_names
FROM p GROUP BY ALL""",
)
def _chunk_table_rows(spark: SparkSession, folder: str) -> DataFrame:
    chunks = chunk_table_rows(table(spark, folder, "part"), "p_brand", "p_partkey", ["p_partkey", "p_name", "p_size"])
    return chunks.withColumn("column_names", F.array_join("column_names", ","))


@query(
    "document_catalog",
    f"""WITH {SQL_CHUNKS}, cc AS (SELECT doc_id, count(*) AS c FROM ch GROUP BY 1)
SELECT doc_id, source, {SQL_FILE} AS file_name, {SQL_MIME} AS mime_type, strlen(text) AS size_bytes, sha256(text) AS content_hash,
  1 AS version, TRUE AS download_available, CASE WHEN toxic = 1 THEN 0 ELSE c END AS chunk_count,
  CASE WHEN quality IS NULL OR toxic = 1 THEN 0 ELSE c END AS embeddings_count,
  CASE WHEN toxic = 1 THEN 'failed' WHEN quality IS NULL THEN 'processing' ELSE 'ready' END AS status
FROM documents JOIN cc USING (doc_id) LEFT JOIN labels USING (doc_id)""",
)
def _document_catalog(spark: SparkSession, folder: str) -> DataFrame:
    # Toxic documents were refused before chunking; only labelled ones have their vectors yet.
    docs = text_table(spark, folder, "documents")
    labels = table(spark, folder, "labels")
    described = docs.select(
        "doc_id", "source", file_names().alias("file_name"), F.col("text").cast("binary").alias("content"), F.lit(1).alias("version")
    )
    accepted = docs.join(labels.where("toxic = 1"), "doc_id", "left_anti")
    chunks = chunk_text(accepted.select("doc_id", "text")).select("doc_id")
    vectors = chunks.join(labels.select("doc_id"), "doc_id", "left_semi")
    return document_catalog(described, chunks, vectors)


@query(
    "list_documents_keyset",
    """WITH f AS (SELECT o_orderkey AS id, o_orderdate AS created_at, o_orderstatus AS status FROM orders WHERE o_orderstatus = 'F'
  AND (o_orderdate > TIMESTAMP '1996-06-30' OR (o_orderdate = TIMESTAMP '1996-06-30' AND o_orderkey > 100))),
pg AS (SELECT *, row_number() OVER (ORDER BY created_at, id) AS n FROM f ORDER BY created_at, id LIMIT 101)
SELECT id, epoch_us(created_at) AS created_us, status,
  (SELECT CASE WHEN count(*) > 100 THEN max(CASE WHEN n = 100 THEN to_base64(encode(epoch_us(created_at) || '|' || id)) END) ELSE '' END FROM pg) AS next_cursor
FROM pg WHERE n <= 100""",
)
def _list_documents_keyset(spark: SparkSession, folder: str) -> DataFrame:
    from datetime import datetime

    catalog = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("created_at"), F.col("o_orderstatus").alias("status")
    )
    page = list_documents_keyset(catalog, 100, encode_cursor(datetime(1996, 6, 30), 100), "F")
    micros = F.unix_micros(F.col("created_at").cast("timestamp"))
    return page.select("id", micros.alias("created_us"), "status", "next_cursor")


@query(
    "paged_listing",
    "SELECT c_custkey, c_name, (SELECT count(*) FROM customer) AS total FROM customer ORDER BY c_custkey LIMIT 50 OFFSET 100",
)
def _paged_listing(spark: SparkSession, folder: str) -> DataFrame:
    return paged_listing(table(spark, folder, "customer").select("c_custkey", "c_name"), "c_custkey", 50, 100)


@query(
    "get_originals",
    "SELECT doc_id, strlen(text) AS size_bytes, sha256(text) AS content_hash FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
)
def _get_originals(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", F.col("text").cast("binary").alias("content"))
    found = get_originals(docs, table(spark, folder, "labels"))
    return found.select("doc_id", F.octet_length("content").alias("size_bytes"), F.sha2("content", 256).alias("content_hash"))


@query(
    "stream_ingest",
    f"WITH {SQL_CHUNKS} SELECT doc_id::VARCHAR AS external_id, 1 AS version, chunk_index, md5(text) AS text_hash, 64 AS dim FROM ch",
)
def _stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    schema = table(spark, folder, "documents").schema
    # The table is a file or a folder of files. Only as a pattern may a stream's path be a file, and a filter
    # on file names would miss those in a folder.
    stream = spark.readStream.schema(schema).parquet(f"{folder}/documents.parque[t]")
    source = stream.select(F.col("doc_id").cast("string").alias("external_id"), F.col("text").alias("content"))
    path = scratch_path(spark, "ingest")
    stream_ingest(source, path).awaitTermination()
    return ingested_vectors(spark, path).select(
        "external_id", "version", "chunk_index", F.md5("text").alias("text_hash"), F.size("values").alias("dim")
    )


# A source in two runs: documents without every tenth, then without every eleventh, some of them changed.
SQL_RUNS = """r1 AS (SELECT doc_id, text FROM documents WHERE doc_id % 10 <> 0),
r2 AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN text || ' v2' ELSE text END AS text FROM documents WHERE doc_id % 11 <> 0),
nw AS (SELECT coalesce(r2.doc_id, r1.doc_id) AS doc_id, coalesce(r2.text, r1.text) AS text, r1.doc_id IS NOT NULL AS had,
  r2.doc_id IS NOT NULL AS seen, coalesce(r1.text <> r2.text, FALSE) AS changed FROM r1 FULL OUTER JOIN r2 USING (doc_id)),
""" + SQL_CHUNKS.replace("FROM documents", "FROM nw") + ", cc AS (SELECT doc_id, count(*) FILTER (text <> '') AS c FROM ch GROUP BY 1)"


def _sql_catalog(where: str) -> str:
    return f"""WITH {SQL_RUNS} SELECT doc_id::VARCHAR AS external_id, CASE WHEN changed THEN 2 ELSE 1 END AS version, sha256(text) AS content_hash,
  strlen(text) AS size_bytes, c AS chunk_count, CASE WHEN c > 0 THEN 'ready' ELSE 'failed' END AS status,
  CASE WHEN had THEN 1 ELSE 2 END AS created_day, CASE WHEN had AND NOT changed THEN 1 ELSE 2 END AS updated_day
FROM nw JOIN cc USING (doc_id) WHERE {where}"""


def two_runs(spark: SparkSession, folder: str, mode: str) -> str:
    """A dataset after two runs; the second is repeated, which changes nothing."""
    docs = text_table(spark, folder, "documents").select(F.col("doc_id"), F.col("text").alias("content"))
    docs = docs.withColumn("external_id", F.col("doc_id").cast("string"))
    later = docs.withColumn("content", F.when(F.col("doc_id") % 7 == 0, F.concat("content", F.lit(" v2"))).otherwise(F.col("content")))
    path = scratch_path(spark, "source")
    ingest_source(docs.where("doc_id % 10 <> 0"), path, "docs", mode, at=datetime(2024, 1, 1, tzinfo=timezone.utc))
    for _ in range(2):
        ingest_source(later.where("doc_id % 11 <> 0"), path, "docs", mode, run=1, at=datetime(2024, 1, 2, tzinfo=timezone.utc))
    return path


def _catalog_of(spark: SparkSession, path: str) -> DataFrame:
    return source_catalog(spark, path).select(
        "external_id", "version", "content_hash", "size_bytes", "chunk_count", "status",
        F.dayofmonth("created_at").alias("created_day"), F.dayofmonth("updated_at").alias("updated_day"),
    )


@query("ingest_source_full", _sql_catalog("seen"))
def _ingest_source_full(spark: SparkSession, folder: str) -> DataFrame:
    return _catalog_of(spark, two_runs(spark, folder, "full"))


@query("ingest_source_incremental", _sql_catalog("TRUE"))
def _ingest_source_incremental(spark: SparkSession, folder: str) -> DataFrame:
    return _catalog_of(spark, two_runs(spark, folder, "incremental"))


@query(
    "ingest_source_vectors",
    f"WITH {SQL_RUNS} SELECT doc_id::VARCHAR AS external_id, CASE WHEN changed THEN 2 ELSE 1 END AS version, chunk_index, md5(ch.text) AS text_hash, "
    "64 AS dim FROM ch JOIN nw USING (doc_id) WHERE seen AND ch.text <> ''",
)
def _ingest_source_vectors(spark: SparkSession, folder: str) -> DataFrame:
    found = source_vectors(spark, two_runs(spark, folder, "full"))
    return found.select("external_id", "version", "chunk_index", F.md5("text").alias("text_hash"), F.size("values").alias("dim"))


@query(
    "ingest_source_runs",
    f"""WITH {SQL_RUNS} SELECT 0 AS run, count(*) FILTER (had) AS documents_new, 0::BIGINT AS documents_changed, 0::BIGINT AS documents_deleted,
  0::BIGINT AS documents_unchanged, 'completed' AS status FROM nw
UNION ALL SELECT 1, count(*) FILTER (NOT had), count(*) FILTER (changed), count(*) FILTER (NOT seen), count(*) FILTER (had AND seen AND NOT changed),
  'completed' FROM nw""",
)
def _ingest_source_runs(spark: SparkSession, folder: str) -> DataFrame:
    kinds = [f"documents_{k}" for k in ("new", "changed", "deleted", "unchanged")]
    return runs(spark, two_runs(spark, folder, "full")).select(F.col("run").cast("int").alias("run"), *kinds, "status")


# The second page of 20 documents of that catalog, by key.
@query(
    "ingest_source_page",
    f"""WITH {SQL_RUNS}, p AS (SELECT md5('docs|' || doc_id) AS id, doc_id::VARCHAR AS external_id,
  row_number() OVER (ORDER BY CASE WHEN had THEN 1 ELSE 2 END, md5('docs|' || doc_id)) AS n FROM nw WHERE seen)
SELECT id, external_id FROM p WHERE n BETWEEN 21 AND 40""",
)
def _ingest_source_page(spark: SparkSession, folder: str) -> DataFrame:
    catalog = source_catalog(spark, two_runs(spark, folder, "full"))
    cursor = list_documents_keyset(catalog, 20).first()["next_cursor"]
    return list_documents_keyset(catalog, 20, cursor).select("id", "external_id")
