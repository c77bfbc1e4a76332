"""Retrieval, citations, sessions, answer streams, lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.operators.chunk import chunk_text
from lodestone.operators.lineage import (
    cleanup_unused,
    ingest_run_metrics,
    schedule_references,
    source_references,
    unused_sources,
)
from lodestone.operators.retrieval import (
    aggregate_citations,
    chunk_vectors,
    resolve_inline_citations,
    retrieve_context,
)
from lodestone.operators.sessions import append_messages, conversation_history, list_messages, session_rollup
from lodestone.plans.base import query, sql_cosine, sql_embedding, sql_top, table, text_table
from lodestone.plans.ingest import SQL_CHUNKS
from lodestone.plans.search import text_queries
from lodestone.streaming.events import stream_answer_text, stream_event_assembly

SQL_CHUNK_HITS = sql_top(f"SELECT item_id AS query_id, id, {sql_cosine('bq.v', 'cv.v')} AS score FROM bq, cv", 5)
# A page holds ten chunks.
SQL_CONTEXT = f"""{SQL_CHUNKS}, ck AS (SELECT struct_pack(doc_id, chunk_index) AS id, text FROM ch),
{sql_embedding('bq', 'benchmark', 'item_id', 'text')}, {sql_embedding('cv', 'ck', 'id', 'text')},
cx AS (SELECT query_id, rank, h.id.doc_id AS doc_id, h.id.chunk_index AS chunk_index, score, ck.text AS text, source,
  h.id.chunk_index // 10 AS page FROM ({SQL_CHUNK_HITS}) h JOIN ck ON ck.id = h.id JOIN documents d ON d.doc_id = h.id.doc_id)"""


def context(spark: SparkSession, folder: str) -> DataFrame:
    docs = text_table(spark, folder, "documents", "doc_id", "text", "source")
    chunks = chunk_text(docs).withColumn("page", F.floor(F.col("chunk_index") / 10).cast("int"))
    return retrieve_context(text_queries(spark, folder), chunk_vectors(chunks))


@query("retrieve_context", f"WITH {SQL_CONTEXT} SELECT * FROM cx")
def _retrieve_context(spark: SparkSession, folder: str) -> DataFrame:
    return context(spark, folder).drop("id")


SQL_CITATIONS = f"""{SQL_CONTEXT}, ci AS (SELECT query_id, doc_id, source, max(score) AS relevance, count(*) AS chunk_count,
  left(arg_min(text, (-score, chunk_index)), 200) AS preview,
  array_to_string(list_sort(list(DISTINCT page)), ',') AS pages,
  string_agg(rank || ':' || chunk_index, ',' ORDER BY rank) AS chunks FROM cx GROUP BY ALL),
cn AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY relevance DESC, doc_id) AS citation FROM ci)"""


@query("aggregate_citations", f"WITH {SQL_CITATIONS} SELECT * FROM cn")
def _aggregate_citations(spark: SparkSession, folder: str) -> DataFrame:
    citations = aggregate_citations(context(spark, folder))
    places = F.transform("chunks", lambda c: F.concat(c["rank"].cast("string"), F.lit(":"), c["chunk_index"].cast("string")))
    return citations.withColumn("chunks", F.array_join(places, ",")).withColumn(
        "pages", F.array_join(F.transform("pages", lambda p: p.cast("string")), ",")
    )


@query(
    "resolve_inline_citations",
    f"""WITH {SQL_CITATIONS}, an AS (SELECT item_id AS query_id, text || ' see [1] and [3], not [x], [12345678901] or [9].' AS answer FROM benchmark),
mk AS (SELECT query_id, (unnest(generate_series(1, len(m))) - 1)::INTEGER AS mark, try_cast(unnest(m) AS INTEGER) AS citation
  FROM (SELECT query_id, regexp_extract_all(answer, '\\[(\\d+)\\]', 1) AS m FROM an))
SELECT mk.query_id, mark, mk.citation, doc_id FROM mk LEFT JOIN cn ON cn.query_id = mk.query_id AND cn.citation = mk.citation""",
)
def _resolve_inline_citations(spark: SparkSession, folder: str) -> DataFrame:
    answers = text_queries(spark, folder).select(
        "query_id", F.concat("query_text", F.lit(" see [1] and [3], not [x], [12345678901] or [9].")).alias("answer")
    )
    return resolve_inline_citations(answers, aggregate_citations(context(spark, folder)))


@query(
    "conversation_history",
    """SELECT conv_id, turn, text, history FROM (SELECT conv_id, turn, role, text,
  coalesce(string_agg(role || ': ' || text, chr(10)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), '') AS history
  FROM conversations) WHERE role = 'user'""",
)
def _conversation_history(spark: SparkSession, folder: str) -> DataFrame:
    framed = conversation_history(table(spark, folder, "conversations"), 3)
    lines = F.transform("history", lambda m: F.concat(m["role"], F.lit(": "), m["content"]))
    return framed.withColumn("history", F.array_join(lines, "\n"))


@query(
    "session_rollup",
    """SELECT conv_id, left(arg_min(text, turn) FILTER (role = 'user'), 80) AS title, count(*) AS message_count,
  min(turn) AS first_turn, max(turn) AS last_turn FROM conversations GROUP BY conv_id""",
)
def _session_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return session_rollup(table(spark, folder, "conversations"))


@query(
    "list_messages",
    """SELECT conv_id, turn, role, text, place FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place
  FROM conversations) WHERE place <= 3""",
)
def _list_messages(spark: SparkSession, folder: str) -> DataFrame:
    return list_messages(table(spark, folder, "conversations"), 3)


@query(
    "append_messages",
    """WITH nw AS (SELECT conv_id + 50 AS conv_id, turn AS position, role, text FROM conversations),
l AS (SELECT conv_id, max(turn) AS m FROM conversations GROUP BY 1)
SELECT conv_id, turn, role, text FROM conversations UNION ALL
SELECT conv_id, coalesce(m + 1, 0) + row_number() OVER (PARTITION BY conv_id ORDER BY position) - 1, role, text FROM nw LEFT JOIN l USING (conv_id)""",
)
def _append_messages(spark: SparkSession, folder: str) -> DataFrame:
    # Every message is sent again to the session 50 further on, many of which are new.
    messages = table(spark, folder, "conversations")
    new = messages.select((F.col("conv_id") + 50).alias("conv_id"), F.col("turn").alias("position"), "role", "text")
    return append_messages(messages, new)


# Lines of one answer stream per conversation: assistant turns are text events with a comment
# before, user turns status events over two data lines, system turns a name without data, and
# a last event stays open.
SQL_LINES = r"""tx AS (SELECT conv_id, turn, role, regexp_replace(text, '[^\p{L}\p{N} .,]', ' ', 'g') AS t FROM conversations),
pa AS (SELECT conv_id, turn, CASE role
  WHEN 'assistant' THEN [': keep-alive', 'event: message', 'data: {"chunk_type":"text","content":"' || t || '"}', '']
  WHEN 'user' THEN ['id: 7', 'data: {"chunk_type":"status",', 'data:"content":"' || len(t) || '"}  ', chr(13)]
  ELSE ['event: ping', '', '', ''] END AS ls FROM tx),
lf AS (SELECT conv_id AS stream_id, turn * 4 + i AS line_no, ls[i + 1] AS line FROM (SELECT *, unnest(range(4)) AS i FROM pa)
  UNION ALL SELECT conv_id, max(turn) * 4 + 4, 'data: {"chunk_type":"done","Event":"end"}' FROM pa GROUP BY conv_id),
cl AS (SELECT stream_id, line_no, regexp_replace(line, '\r$', '') AS line FROM lf),
nb AS (SELECT *, sum((line = '')::INTEGER) OVER (PARTITION BY stream_id ORDER BY line_no) - (line = '')::INTEGER AS block FROM cl),
bl AS (SELECT stream_id, block,
  string_agg(trim(substr(line, 6)), chr(10) ORDER BY line_no) FILTER (starts_with(line, 'data:')) AS raw,
  arg_max(trim(substr(line, 7)), line_no) FILTER (starts_with(line, 'event:')) AS event FROM nb GROUP BY ALL),
ev AS (SELECT stream_id, row_number() OVER (PARTITION BY stream_id ORDER BY block) - 1 AS event_no,
  coalesce(json_extract_string(raw, '$.Event'), event, '') AS event, raw,
  coalesce(json_extract_string(raw, '$.chunk_type'), '') AS chunk_type, coalesce(json_extract_string(raw, '$.content'), '') AS content
  FROM bl WHERE raw IS NOT NULL)"""


def stream_lines(spark: SparkSession, folder: str) -> DataFrame:
    said = table(spark, folder, "conversations").withColumn("t", F.regexp_replace("text", r"[^\p{L}\p{N} .,]", " "))
    lines = (
        F.when(
            F.col("role") == "assistant",
            F.array(
                F.lit(": keep-alive"),
                F.lit("event: message"),
                F.concat(F.lit('data: {"chunk_type":"text","content":"'), "t", F.lit('"}')),
                F.lit(""),
            ),
        )
        .when(
            F.col("role") == "user",
            F.array(
                F.lit("id: 7"),
                F.lit('data: {"chunk_type":"status",'),
                F.concat(F.lit('data:"content":"'), F.length("t"), F.lit('"}  ')),
                F.lit("\r"),
            ),
        )
        .otherwise(F.array(F.lit("event: ping"), F.lit(""), F.lit(""), F.lit("")))
    )
    body = said.select("conv_id", "turn", F.posexplode(lines).alias("i", "line")).select(
        F.col("conv_id").alias("stream_id"), (F.col("turn") * 4 + F.col("i")).alias("line_no"), "line"
    )
    tail = said.groupBy(F.col("conv_id").alias("stream_id")).agg(
        (F.max("turn") * 4 + 4).alias("line_no"), F.lit('data: {"chunk_type":"done","Event":"end"}').alias("line")
    )
    return body.unionByName(tail)


@query("stream_event_assembly", f"WITH {SQL_LINES} SELECT * FROM ev")
def _stream_event_assembly(spark: SparkSession, folder: str) -> DataFrame:
    return stream_event_assembly(stream_lines(spark, folder))


@query(
    "stream_answer_text",
    f"""WITH {SQL_LINES} SELECT stream_id, 0 AS part,
  coalesce(string_agg(content, '' ORDER BY event_no) FILTER (chunk_type = 'text'), '') AS answer,
  max(chunk_type = 'done') AS finished FROM ev GROUP BY stream_id""",
)
def _stream_answer_text(spark: SparkSession, folder: str) -> DataFrame:
    return stream_answer_text(stream_event_assembly(stream_lines(spark, folder)))


@query(
    "ingest_run_metrics",
    """WITH g AS (SELECT user_id AS source_id, count(*) FILTER (event_type <> 'error') AS documents_processed,
  count(*) FILTER (event_type = 'error') AS failures, coalesce(sum(json_extract(props, '$.k')::BIGINT) FILTER (event_type <> 'error'), 0)::BIGINT AS vectors_inserted,
  (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6::DOUBLE AS processing_seconds, epoch_us(min(ts)) AS started_us, 70 AS expected FROM events GROUP BY user_id)
SELECT source_id, documents_processed, failures, vectors_inserted, processing_seconds, started_us, p AS progress_percentage,
  CASE WHEN p < 100 THEN 'processing' WHEN documents_processed = 0 THEN 'failed' ELSE 'completed' END AS status
FROM (SELECT *, round(least(100.0::DOUBLE, 100.0::DOUBLE * (documents_processed + failures) / expected), 6) AS p FROM g)""",
)
def _ingest_run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    log = table(spark, folder, "events").select(
        F.col("user_id").alias("source_id"),
        "ts",
        F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("outcome"),
        F.get_json_object("props", "$.k").cast("bigint").alias("vectors"),
        F.lit(70).alias("expected"),
    )
    metrics = ingest_run_metrics(log)
    return metrics.withColumn("started_us", F.unix_micros(F.col("started_at").cast("timestamp"))).drop("started_at")


def customer_sources(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customers as sources; open orders as active schedules, pending ones as jobs in flight."""
    sources = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("source_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("type")
    )
    orders = table(spark, folder, "orders")
    schedules = orders.select(
        F.col("o_custkey").alias("source_id"),
        F.col("o_orderkey").alias("schedule_id"),
        F.col("o_orderpriority").alias("name"),
        (F.col("o_orderstatus") == "O").alias("active"),
    )
    jobs = orders.select(
        F.col("o_custkey").alias("source_id"),
        F.col("o_orderkey").alias("job_id"),
        (F.col("o_orderstatus") == "P").alias("in_flight"),
    )
    return sources, schedules, jobs


@query(
    "source_references",
    """SELECT c_custkey AS source_id, count(*) FILTER (o_orderstatus = 'O') AS schedule_count,
  count(*) FILTER (o_orderstatus = 'P') AS active_job_count, count(*) FILTER (o_orderstatus IN ('O', 'P')) > 0 AS in_use
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""",
)
def _source_references(spark: SparkSession, folder: str) -> DataFrame:
    return source_references(*customer_sources(spark, folder))


@query(
    "schedule_references",
    "SELECT o_custkey AS source_id, o_orderkey AS schedule_id, o_orderpriority AS name FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'O'",
)
def _schedule_references(spark: SparkSession, folder: str) -> DataFrame:
    sources, schedules, _ = customer_sources(spark, folder)
    return schedule_references(sources, schedules)


def labelled_documents(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Documents as sources, and the labels that refer to them."""
    columns = [F.col("doc_id").alias("source_id"), F.col("source").alias("name"), F.col("lang").alias("type")]
    return table(spark, folder, "documents").select(*columns), table(spark, folder, "labels").select(F.col("doc_id").alias("source_id"))


@query(
    "unused_sources",
    """SELECT doc_id AS source_id, source AS name, lang AS type FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def _unused_sources(spark: SparkSession, folder: str) -> DataFrame:
    sources, labelled = labelled_documents(spark, folder)
    return unused_sources(sources, labelled)


@query(
    "cleanup_unused",
    """SELECT doc_id AS source_id, source AS name, lang AS type,
  CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 0) THEN 'kept' ELSE 'deleted' END AS outcome FROM documents""",
)
def _cleanup_unused(spark: SparkSession, folder: str) -> DataFrame:
    sources, labelled = labelled_documents(spark, folder)
    forced = table(spark, folder, "labels").where("toxic = 1").select(F.col("doc_id").alias("source_id"))
    kept, deleted = cleanup_unused(sources, labelled, force=forced)
    columns = ["source_id", "name", "type"]
    return kept.select(*columns, F.lit("kept").alias("outcome")).unionByName(
        deleted.select(*columns, F.lit("deleted").alias("outcome"))
    )
