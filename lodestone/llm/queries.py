"""The registered queries of this folder over the test tables, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import (
    alignment,
    decontaminate,
    divergence,
    hnsw,
    lm,
    pieces,
    quality,
    secrets,
    simhash,
    suffix_dedup,
    token_counts,
    toxicity,
    warc,
)
from lodestone.session import scratch_path

QUERIES = {}
SQL = {}


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sql_spans(rule: secrets.Rule, place: int) -> str:
    """Spans of one rule in DuckDB: pieces that end with a match, and the running sums of their lengths."""
    pattern = f"(?s)(.*?)({rule.regex}|\\z)".replace("'", "''")
    groups = ", ".join(f"regexp_extract_all(t, '{pattern}', {g}) AS g{i}" for i, g in enumerate((0, 2, 2 + rule.group)))
    return f"""SELECT r, {place} AS place, '{rule.kind}' AS kind, e - len(m) AS b, e FROM (
  SELECT r, m, v, sum(len(p)) OVER (PARTITION BY r ORDER BY i) AS e FROM (
    SELECT r, unnest(g0) AS p, unnest(g1) AS m, unnest(g2) AS v, generate_subscripts(g0, 1) AS i
    FROM (SELECT r, {groups} FROM d WHERE regexp_matches(t, '{rule.regex.replace("'", "''")}'))))
  WHERE len(m) > 0 AND len(v) >= {rule.least}"""


def sql_secrets() -> str:
    spans = " UNION ALL ".join(sql_spans(r, i) for i, r in enumerate(secrets.RULES))
    count = lambda kind: f"coalesce(count(*) FILTER (kind = '{kind}'), 0) AS n_{kind}"
    text = "kind || ':' || b::BIGINT || ':' || e::BIGINT"
    base = f"coalesce(string_agg({text}, ',' ORDER BY b, place) FILTER (place < {len(secrets.BASE)}), '')"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
s AS ({spans})
SELECT doc_id, {", ".join(count(r.kind) for r in secrets.BASE)}, sha256({base}) AS base_sha256,
  coalesce(string_agg({text}, ',' ORDER BY b, place), '') AS spans
FROM d LEFT JOIN s USING (r) GROUP BY r, doc_id"""


@query("op1_secret_scan", sql_secrets())
def _secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents").select("doc_id", "text"))
    kinds = [r.kind for r in secrets.BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select(
        "doc_id",
        *[secrets.count_of(F.col("spans"), k).alias(f"n_{k}") for k in kinds],
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


SQL_WARC = """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha256(h) AS payload_digest FROM p),
g AS (SELECT payload_digest, min(page_id) AS least FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN least IS NULL OR page_id IS NOT DISTINCT FROM least THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM least THEN least END AS refers_to
FROM d LEFT JOIN g USING (payload_digest)"""


@query("op2_warc", SQL_WARC)
def _warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive(table(spark, folder, "pages"), scratch_path(spark, "warc"))


@query("op3_suffix_dedup")
def _suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.deduplicate(table(spark, folder, "documents"))


@query("op4_simhash")
def _simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.simhash(table(spark, folder, "documents"))
    digits = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query("op5_decontaminate")
def _decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.leaks(documents, table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        (F.size("matches") > 0).alias("contaminated"),
        F.size("matches").cast("long").alias("n_items"),
        F.col("matches.item_id").alias("item_ids"),
        F.col("matches.distance").alias("distances"),
    )


@query("op6_importance_resampling")
def _importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return quality.resample(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op7_cross_entropy_difference")
def _cross_entropy_difference(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op8_hnsw")
def _hnsw(spark: SparkSession, folder: str) -> DataFrame:
    return hnsw.near_duplicates(table(spark, folder, "embeddings"))


@query("op9_sentencepiece")
def _sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    encoded = pieces.encode(table(spark, folder, "documents").select("doc_id", "text")).drop("text")
    decoded = pieces.decode(encoded)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op10_toxicity")
def _toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.toxicity(documents, table(spark, folder, "labels"))
    return scored.select(
        "doc_id",
        toxicity.in_test_fold().alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query("op11_tokenizer_alignment")
def _tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(table(spark, folder, "documents").select("doc_id", "text"))


@query("op12_token_counts")
def _token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents").select("doc_id", "text"))


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SQL_DIVERGENCE = rf"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(t) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY ALL HAVING count(DISTINCT r) >= {divergence.LEAST}),
l AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY ALL),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
s AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL),
g AS (SELECT lang, source, coalesce(s.n, 0)::HUGEINT AS gn, l.v::HUGEINT AS v, l.n::HUGEINT AS ln
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN s USING (lang, source) LEFT JOIN l USING (lang)),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + ({divergence.UNIT}::HUGEINT * (coalesce(c.n, 0) + 1)) // (gn + v) AS p,
  1 + ({divergence.UNIT}::HUGEINT * (total + 1)) // (ln + v) AS q
  FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)) WHERE part = 'pair' OR rank <= {divergence.TOP}"""


@query("op13_source_divergence", SQL_DIVERGENCE)
def _source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))
