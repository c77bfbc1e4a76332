"""Ids, metadata, schemas, embedding and the write path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.ids import id_from_json, id_text, id_to_json, int_id, string_id, unset_id
from lodestone.functions.maps import merge_maps, set_if_absent
from lodestone.operators.embed import embed_texts
from lodestone.operators.schema import (
    MetadataSchema,
    check_metadata_schema,
    enforce_metadata_schema,
    misfits,
    schema_merge,
    schema_replace,
)
from lodestone.operators.write import (
    add_texts,
    assign_text_ids,
    delete_vectors,
    deleted_count,
    insert_vectors,
    write_collection,
)
from lodestone.plans.base import query, sql_embedding, table, text_table
from lodestone.session import scratch_path


def flat(df: DataFrame) -> DataFrame:
    return df.withColumns({"kind": F.col("id.kind"), "id_text": id_text(F.col("id"))}).drop("id")


# Id literals: odd labels are numbers, even ones strings, label 9 numbers beyond 64 bits, label 0 unset.
SQL_ID_JSON = """CASE WHEN label = 0 THEN 'null' WHEN label = 9 THEN vec_id || '00000000000000000000.5'
  WHEN label % 2 = 1 THEN vec_id::VARCHAR ELSE '"' || vec_id || '"' END"""


@query(
    "typed_vector_id",
    f"""SELECT vec_id, CASE WHEN label = 0 THEN NULL WHEN label = 9 THEN 'num' WHEN label % 2 = 1 THEN 'int' ELSE 'str' END AS kind,
  CASE WHEN label = 9 OR (label <> 0 AND label % 2 = 0) THEN trim({SQL_ID_JSON}, '"') END AS s,
  CASE WHEN label <> 9 AND label % 2 = 1 THEN vec_id END AS i,
  CASE WHEN label = 0 THEN '' ELSE trim({SQL_ID_JSON}, '"') END AS id_text, {SQL_ID_JSON} AS json
FROM embeddings""",
)
def _typed_vector_id(spark: SparkSession, folder: str) -> DataFrame:
    digits = F.col("vec_id").cast("string")
    literal = (
        F.when(F.col("label") == 0, "null")
        .when(F.col("label") == 9, F.concat(digits, F.lit("00000000000000000000.5")))
        .when(F.col("label") % 2 == 1, digits)
        .otherwise(F.concat(F.lit('"'), digits, F.lit('"')))
    )
    typed = table(spark, folder, "embeddings").select("vec_id", id_from_json(literal).alias("id"))
    return typed.select(
        "vec_id", "id.kind", "id.s", "id.i", id_text(F.col("id")).alias("id_text"), id_to_json(F.col("id")).alias("json")
    )


def mixed_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings under integer ids for even and string ids for odd numbers, as batch 0."""
    rows = table(spark, folder, "embeddings")
    vec = F.col("vec_id")
    return rows.select(
        F.when(vec % 2 == 0, int_id(vec)).otherwise(string_id(vec.cast("string"))).alias("id"),
        F.col("embedding").alias("values"),
        F.create_map(F.lit("label"), F.col("label").cast("string")).alias("metadata"),
        F.lit(0).cast("bigint").alias("seq"),
        vec.alias("position"),
    )


SQL_MIXED = """mx AS (SELECT CASE WHEN vec_id % 2 = 0 THEN 'int' ELSE 'str' END AS kind, vec_id::VARCHAR AS id_text,
  label::VARCHAR AS label, 0 AS seq, vec_id AS position FROM embeddings)"""


@query(
    "insert_vectors",
    f"""WITH {SQL_MIXED},
nb AS (SELECT 'int' AS kind, doc_id::VARCHAR AS id_text, 'q' || quality AS label, 1 AS seq, doc_id AS position FROM labels WHERE toxic = 0
  UNION ALL SELECT 'str', md5('1|' || (1000000000 + item_id)), 'unset', 1, 1000000000 + item_id FROM benchmark),
al AS (SELECT * FROM mx UNION ALL SELECT * FROM nb)
SELECT kind, id_text, label, seq FROM (SELECT *, row_number() OVER (PARTITION BY kind, id_text ORDER BY seq DESC, position DESC) AS r FROM al) WHERE r = 1""",
)
def _insert_vectors(spark: SparkSession, folder: str) -> DataFrame:
    # Batch 1: a 64-value vector per labelled document that is not toxic, a 32-value one
    # (rejected) per toxic document, and one record without an id per benchmark passage.
    unit = F.array_repeat(F.lit(0.125).cast("float"), 64)
    labelled = table(spark, folder, "labels").select(
        int_id(F.col("doc_id")).alias("id"),
        F.when(F.col("toxic") == 0, unit).otherwise(F.slice(unit, 1, 32)).alias("values"),
        F.create_map(F.lit("label"), F.concat(F.lit("q"), "quality")).alias("metadata"),
        F.col("doc_id").alias("position"),
    )
    unnamed = table(spark, folder, "benchmark").select(
        unset_id().alias("id"),
        unit.alias("values"),
        F.create_map(F.lit("label"), F.lit("unset")).alias("metadata"),
        (F.col("item_id") + 1_000_000_000).alias("position"),
    )
    merged = insert_vectors(mixed_vectors(spark, folder), labelled.unionByName(unnamed), 64, batch_id=1)
    return flat(merged.select("id", F.col("metadata")["label"].alias("label"), "seq"))


@query(
    "assign_text_ids",
    """SELECT position, CASE WHEN lang = 'en' THEN 'int' ELSE 'str' END AS kind,
  CASE WHEN lang = 'en' THEN position::VARCHAR ELSE 'text-' || row_number() OVER (ORDER BY position) END AS id_text
FROM (SELECT doc_id AS position, lang FROM documents)""",
)
def _assign_text_ids(spark: SparkSession, folder: str) -> DataFrame:
    given = F.when(F.col("lang") == "en", int_id(F.col("doc_id")))
    batch = table(spark, folder, "documents").select(given.alias("id"), F.col("doc_id").alias("position"))
    return flat(assign_text_ids(batch))


SQL_DELETE_LIST = "SELECT 'int' AS kind, doc_id::VARCHAR AS id_text FROM labels UNION SELECT 'str', item_id::VARCHAR FROM benchmark"


def delete_list(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents by number and benchmark items by text; many match no record of that kind."""
    numbers = table(spark, folder, "labels").select(int_id(F.col("doc_id")).alias("id"))
    names = table(spark, folder, "benchmark").select(string_id(F.col("item_id").cast("string")).alias("id"))
    return numbers.unionByName(names)


@query(
    "delete_vectors",
    f"WITH {SQL_MIXED}, rm AS ({SQL_DELETE_LIST}) SELECT kind, id_text, label FROM mx ANTI JOIN rm USING (kind, id_text)",
)
def _delete_vectors(spark: SparkSession, folder: str) -> DataFrame:
    left = delete_vectors(mixed_vectors(spark, folder), delete_list(spark, folder))
    return flat(left.select("id", F.col("metadata")["label"].alias("label")))


@query(
    "deleted_count",
    f"WITH {SQL_MIXED}, rm AS ({SQL_DELETE_LIST}) SELECT count(*) AS deleted FROM mx SEMI JOIN rm USING (kind, id_text)",
)
def _deleted_count(spark: SparkSession, folder: str) -> DataFrame:
    return deleted_count(mixed_vectors(spark, folder), delete_list(spark, folder))


@query(
    "embed_texts",
    f"""WITH {sql_embedding('dv', 'documents', 'doc_id', 'text')}
SELECT doc_id, bucket, round(weight, 6) AS weight FROM (
  SELECT doc_id, unnest(range(64)) AS bucket, unnest(v) AS weight FROM dv) WHERE weight <> 0""",
)
def _embed_texts(spark: SparkSession, folder: str) -> DataFrame:
    embedded = embed_texts(text_table(spark, folder, "documents"))
    long = embedded.select("doc_id", F.posexplode("values").alias("bucket", "weight"))
    return long.where(F.col("weight") != 0).withColumn("weight", F.round(F.col("weight").cast("double"), 6))


@query(
    "add_texts",
    f"""WITH {sql_embedding('dv', 'documents', 'doc_id', 'text')},
p AS (SELECT doc_id, lang, text, row_number() OVER (ORDER BY doc_id) AS n FROM documents)
SELECT CASE WHEN lang = 'en' THEN 'int' ELSE 'str' END AS kind, CASE WHEN lang = 'en' THEN doc_id::VARCHAR ELSE 'text-' || n END AS id_text,
  CASE WHEN lang = 'fr' THEN 'kept' ELSE text END AS text, len(list_filter(v, lambda x: x <> 0)) AS filled
FROM p JOIN dv USING (doc_id)""",
)
def _add_texts(spark: SparkSession, folder: str) -> DataFrame:
    docs = text_table(spark, folder, "documents")
    batch = docs.select(
        F.when(F.col("lang") == "en", int_id(F.col("doc_id"))).alias("id"),
        "text",
        F.when(F.col("lang") == "fr", F.create_map(F.lit("text"), F.lit("kept")))
        .when(F.col("lang") == "es", F.create_map(F.lit("lang"), F.lit("es")))
        .alias("metadata"),
        F.col("doc_id").alias("position"),
    )
    kind = "id struct<kind:string,s:string,i:bigint>, values array<float>, metadata map<string,string>, seq bigint, position bigint"
    merged = add_texts(spark.createDataFrame([], kind), batch, batch_id=0)
    filled = F.size(F.filter("values", lambda x: x != 0))
    return flat(merged.select("id", F.col("metadata")["text"].alias("text"), filled.alias("filled")))


@query(
    "merge_metadata",
    """SELECT doc_id, source, 'x' || coalesce(quality, -1) AS lang,
  CASE WHEN quality IS NULL THEN 'absent' ELSE 'q' || quality END AS quality, 4 AS entries
FROM documents LEFT JOIN labels USING (doc_id)""",
)
def _merge_metadata(spark: SparkSession, folder: str) -> DataFrame:
    joined = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    base = F.create_map(F.lit("source"), F.col("source"), F.lit("lang"), F.col("lang"))
    marked = F.concat(F.lit("x"), F.coalesce("quality", F.lit(-1)))
    extra = F.create_map(F.lit("lang"), marked, F.lit("origin"), F.lit("table"))
    graded = F.when(F.col("quality").isNotNull(), F.create_map(F.lit("quality"), F.concat(F.lit("q"), "quality")))
    merged = merge_maps(merge_maps(base, extra), graded)
    full = joined.select("doc_id", set_if_absent(merged, "quality", F.lit("absent")).alias("m"))
    return full.select(
        "doc_id", F.col("m")["source"].alias("source"), F.col("m")["lang"].alias("lang"),
        F.col("m")["quality"].alias("quality"), F.size("m").alias("entries"),
    )


def loose_events(spark: SparkSession, folder: str) -> DataFrame:
    """Event properties as a variant; errors carry text where a number belongs, purchases a number too large."""
    props = (
        F.when(F.col("event_type") == "error", F.lit('{"k": "x", "note": "bad"}'))
        .when(F.col("value") > 90, F.lit('{"k": 4294967296}'))
        .otherwise(F.col("props"))
    )
    return text_table(spark, folder, "events").select("event_id", F.parse_json(props).alias("metadata"))


SQL_LOOSE = """ev AS (SELECT event_id, CASE WHEN event_type = 'error' THEN '{"k": "x", "note": "bad"}'
  WHEN value > 90 THEN '{"k": 4294967296}' ELSE props END AS p FROM events),
ca AS (SELECT event_id, json_extract_string(p, '$.k') AS raw, try_cast(json_extract_string(p, '$.k') AS BIGINT) AS k,
  json_extract_string(p, '$.note') AS note FROM ev)"""
SCHEMA = MetadataSchema((("k", "u32"), ("note", "string")))


@query(
    "enforce_metadata_schema",
    f"""WITH {SQL_LOOSE} SELECT event_id, CASE WHEN ok THEN k END AS k, CASE WHEN ok THEN note END AS note,
  CASE WHEN ok THEN '' ELSE 'k' END AS errors
FROM (SELECT *, raw IS NULL OR coalesce(k BETWEEN 0 AND 4294967295, FALSE) AS ok FROM ca)""",
)
def _enforce_metadata_schema(spark: SparkSession, folder: str) -> DataFrame:
    checked = check_metadata_schema(loose_events(spark, folder), SCHEMA)
    fine = F.size("errors") == 0
    return checked.select(
        "event_id",
        F.when(fine, F.col("k")).alias("k"),
        F.when(fine, F.col("note")).alias("note"),
        F.array_join("errors", ",").alias("errors"),
    )


def declared_events(spark: SparkSession, folder: str) -> tuple[DataFrame, MetadataSchema]:
    schema = MetadataSchema((("k", "i64"),))
    accepted, _ = enforce_metadata_schema(loose_events(spark, folder), schema)
    return accepted, schema


@query(
    "schema_merge",
    f"""WITH {SQL_LOOSE} SELECT event_id, CASE WHEN k BETWEEN -2147483648 AND 2147483647 THEN k::INTEGER END AS k, note, 2 AS schema_version
FROM ca WHERE raw IS NULL OR k IS NOT NULL""",
)
def _schema_merge(spark: SparkSession, folder: str) -> DataFrame:
    rows, schema = declared_events(spark, folder)
    merged, schema = schema_merge(rows, schema, [("k", "i32"), ("note", "string")])
    return merged.select("event_id", "k", "note", F.lit(schema.version).alias("schema_version"))


@query(
    "schema_replace",
    f"""WITH {SQL_LOOSE} SELECT event_id, note, json_extract_string(p, '$.k') AS loose_k, 2 AS schema_version
FROM ca JOIN ev USING (event_id) WHERE raw IS NULL OR k IS NOT NULL""",
)
def _schema_replace(spark: SparkSession, folder: str) -> DataFrame:
    rows, schema = declared_events(spark, folder)
    replaced, schema = schema_replace(rows, schema, [("note", "string")])
    loose = F.try_variant_get("metadata", "$.k", "string")
    return replaced.select("event_id", "note", loose.alias("loose_k"), F.lit(schema.version).alias("schema_version"))


# The field declared loosely becomes a whole number of 32 bits; what does not fit is listed.
@query(
    "schema_retype",
    f"""WITH {SQL_LOOSE} SELECT event_id, CASE WHEN k BETWEEN -2147483648 AND 2147483647 THEN k::INTEGER END AS k, 2 AS schema_version,
  CASE WHEN raw IS NOT NULL AND NOT coalesce(k BETWEEN -2147483648 AND 2147483647, FALSE) THEN raw END AS misfit FROM ca""",
)
def _schema_retype(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.try_variant_get("metadata", "$.k", "string")
    rows = loose_events(spark, folder).withColumn("k", raw)
    retyped, schema = schema_merge(rows, MetadataSchema((("k", "string"),)), [("k", "i32")])
    odd = misfits(rows, ["event_id"], {"k": F.col("k")}, schema).select("event_id", F.col("value").alias("misfit"))
    return retyped.select("event_id", "k", F.lit(schema.version).alias("schema_version")).join(odd, "event_id", "left")


@query(
    "write_collection",
    "SELECT vec_id AS id, label AS cell, len(embedding) AS dim, round(list_sum(embedding::DOUBLE[]), 6) AS total FROM embeddings",
)
def _write_collection(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("values"), F.col("label").alias("cell")
    )
    path = scratch_path(spark, "collection")
    write_collection(rows, path, partition_by="cell")
    total = F.aggregate("values", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return spark.read.parquet(path).select("id", "cell", F.size("values").alias("dim"), F.round(total, 6).alias("total"))
