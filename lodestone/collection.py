"""A collection of vectors: a folder of Parquet batches and a one-row description."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.ids import ID_TYPE
from lodestone.functions.vectors import METRICS
from lodestone.operators.dense import DEFAULT_TOP_K, vector_search
from lodestone.operators.embed import infer_dim
from lodestone.operators.filters import filter_advanced, filter_equality
from lodestone.operators.schema import FIELD_TYPES, MetadataSchema, cast_field, misfits
from lodestone.operators.search import hybrid_search, result_projection, text_search
from lodestone.operators.search import rerank as rerank_hits
from lodestone.operators.sparse import build_sparse_index
from lodestone.operators.topk import without_rows_of
from lodestone.operators.write import assign_record_ids, latest_per_id, prepare_texts

DEFAULT_PROVIDER = "default"
DEFAULT_MODEL = "embedding-4b"
DEFAULT_METRIC = "cosine"

ROWS = (
    f"id {ID_TYPE}, values array<float>, metadata map<string,string>, position bigint, deleted boolean,"
    " reason string, seq bigint"
)


@dataclass(frozen=True)
class CollectionSpec:
    """What a collection holds. Only the name is required.

    The dimension is inferred from the embedding model where that is known.
    """

    name: str
    dim: int = 0
    metric: str = ""
    hybrid: bool = False
    provider: str = ""
    model: str = ""
    tuning: Mapping[str, object] = field(default_factory=dict)
    metadata: Mapping[str, object] = field(default_factory=dict)
    schema: MetadataSchema = field(default_factory=MetadataSchema)

    def with_defaults(self) -> "CollectionSpec":
        provider, model = self.provider or DEFAULT_PROVIDER, self.model or DEFAULT_MODEL
        metric = self.metric or DEFAULT_METRIC
        if metric not in METRICS:
            raise ValueError(f"unknown metric {metric!r}, expected one of {METRICS}")
        dim = self.dim or infer_dim(provider, model)
        if not dim:
            raise ValueError(f"cannot infer the dimension of {provider}/{model}; give it")
        return replace(self, provider=provider, model=model, metric=metric, dim=dim)


class Collection:
    """A handle on the collection at ``path``.

    Inserts and deletes append a batch under a sequence number; reading takes the newest row
    of each id. Repeating a call with the same ``seq`` rewrites the same batch; a new batch must
    follow the last compacted one. Of two writers that take the same next number one fails.

    The base stores each declared field as a typed column beside the metadata, so that filters on it
    reach the statistics of the Parquet files; a change of the schema writes a base with the new columns.
    """

    def __init__(self, spark: SparkSession, path: str, spec: CollectionSpec):
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec

    @classmethod
    def create(cls, spark: SparkSession, path: str, spec: CollectionSpec) -> "Collection":
        collection = cls(spark, path, spec.with_defaults())
        collection._write_spec("errorifexists")
        return collection

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> "Collection":
        row = spark.read.text(f"{path.rstrip('/')}/spec").first()
        saved = json.loads(row["value"])
        schema = saved.pop("schema")
        fields = tuple((n, t) for n, t in schema["fields"])
        return cls(spark, path, CollectionSpec(**saved, schema=MetadataSchema(fields, schema["version"])))

    def _write_spec(self, mode: str) -> None:
        row = self.spark.createDataFrame([(json.dumps(asdict(self.spec)),)], "value string")
        row.coalesce(1).write.mode(mode).text(f"{self.path}/spec")

    def update_schema(self, fields: list[tuple[str, str]], mode: str = "merge") -> "Collection":
        """Merge fields into the declared schema, or replace it."""
        if mode not in ("merge", "replace"):
            raise ValueError(f"unknown mode {mode!r}")
        change = self.spec.schema.merge if mode == "merge" else self.spec.schema.replace
        self.spec = replace(self.spec, schema=change(fields))
        self._write_spec("overwrite")
        self.compact()
        return self

    def _stored_fields(self) -> dict[str, str]:
        """The typed column that stores each declared field; the type is part of the name."""
        return {n: f"field_{n}_{k}" for n, k in self.spec.schema.fields}

    def _typed(self, metadata: str = "metadata") -> dict[str, Column]:
        """The stored columns' values, from the text in the metadata."""
        names = self._stored_fields()
        return {names[n]: cast_field(F.try_element_at(F.col(metadata), F.lit(n)), k) for n, k in self.spec.schema.fields}

    def misfits(self) -> DataFrame:
        """``id, field, value, kind`` for each record's text that does not fit the declared type; its column is null."""
        values = {n: F.try_element_at("metadata", F.lit(n)) for n, _ in self.spec.schema.fields}
        return misfits(self.records(), ["id"], values, self.spec.schema)

    def _seqs(self, name: str) -> list[int]:
        """Numbers of the batches below a folder, empty ones included; no file is read."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        folders = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
        return [int(f.removeprefix("seq=")) for f in folders if f.startswith("seq=")]

    def _table(self, name: str) -> DataFrame:
        rows, names = ROWS, self._stored_fields()
        if name == "base":
            rows += ", version int" + "".join(f", `{names[n]}` {FIELD_TYPES[k]}" for n, k in self.spec.schema.fields)
        if not self._seqs(name):
            return self.spark.createDataFrame([], rows)
        return self.spark.read.schema(rows).parquet(f"{self.path}/{name}")

    def _last_seq(self) -> int:
        """Number of the last batch."""
        return max([-1, *self._seqs("rows"), *self._seqs("base")])

    def _claim(self, seq: int | None) -> tuple[int, str]:
        """The number of a batch and how to write it; a replay that is already in the base is ignored."""
        if seq is None:
            return self._last_seq() + 1, "errorifexists"
        upto = self._table("base").agg(F.max("seq")).first()[0]
        if upto is None or seq > upto:
            return seq, "overwrite"
        if seq not in self._seqs("rows"):
            raise ValueError(f"batch {seq} would come before the base compacted at {upto}")
        return seq, "ignore"

    def _append(self, rows: DataFrame, seq: int, mode: str) -> DataFrame:
        """Write a batch and return its rows as stored."""
        columns = ["id", "values", "metadata", "position", "deleted", "reason"]
        if mode != "ignore":
            rows.select(*columns).write.mode(mode).parquet(f"{self.path}/rows/seq={seq}")
        return self._table("rows").where((F.col("seq") == seq) & F.col("reason").isNull())

    def _newest(self, before: int | None = None) -> DataFrame:
        """The newest row of each id: the last compacted base, overlaid by the batches after it.

        Only ids of later batches are matched against the base, which is not shuffled while
        they are few.
        """
        base, batches = self._table("base"), self._table("rows").where(F.col("reason").isNull())
        if before is not None:
            batches = batches.where(F.col("seq") < before)
        last = base.agg(F.max(F.struct("seq", "version"))).first()[0]
        if last is None:
            return latest_per_id(batches).withColumns(self._typed())
        upto = last["seq"]
        base = base.where((F.col("seq") == upto) & (F.col("version") == last["version"])).drop("version")
        if last["version"] != self.spec.schema.version:  # the base of the schema before is still the last one
            base = base.withColumns(self._typed())
        later = latest_per_id(batches.where(F.col("seq") > upto)).withColumns(self._typed())
        return without_rows_of(base, later.select("id"), "id").unionByName(later)

    def records(self) -> DataFrame:
        """Current records: ``id, values, metadata``."""
        return self._current().select("id", "values", "metadata")

    def _current(self) -> DataFrame:
        """Current records with the typed columns of the declared fields."""
        return self._newest().where(~F.col("deleted")).select("id", "values", "metadata", *self._stored_fields().values())

    def rejects(self) -> DataFrame:
        """Inserted rows that are no records, with the ``reason`` and the batch they came in (``seq``)."""
        return self._table("rows").where(F.col("reason").isNotNull()).drop("deleted")

    def compact(self) -> None:
        """Write the current records as a new base, to spare readers the overlay."""
        seq = self._last_seq()
        if seq < 0:
            return
        columns = ["id", "values", "metadata", "position", "deleted"]
        version = self.spec.schema.version
        current = self._newest().where(~F.col("deleted"))
        current = current.select(*columns, *[v.alias(c) for c, v in self._typed().items()])
        if self._table("base").where((F.col("seq") == seq) & (F.col("version") == version)).isEmpty():
            current.write.mode("overwrite").parquet(f"{self.path}/base/seq={seq}/version={version}")

    def insert(self, batch: DataFrame, seq: int | None = None) -> int:
        """Upsert ``id, values, metadata, position``; returns the number of records inserted.

        Rows of another dimension, without a position, or with metadata that does not fit its declared
        type are kept apart, see ``rejects``.
        """
        seq, mode = self._claim(seq)
        fits = F.coalesce(F.size("values") == self.spec.dim, F.lit(False))
        reason = F.when(~fits, f"vector has not {self.spec.dim} values").when(F.col("position").isNull(), "no position")
        for (name, kind), value in zip(self.spec.schema.fields, self._typed().values()):
            text = F.try_element_at("metadata", F.lit(name))
            reason = reason.when(text.isNotNull() & value.isNull(), f"field {name} is no {kind}")
        rows = assign_record_ids(batch.withColumn("reason", reason), F.lit(seq)).withColumns(
            {"deleted": F.lit(False), "values": F.col("values").cast("array<float>")}
        )
        return self._append(rows, seq, mode).select("id").distinct().count()

    def add_texts(self, documents: DataFrame, seq: int | None = None) -> tuple[int, int]:
        """Embed and upsert ``id, text, metadata, position``; returns (inserted, embeddings)."""
        records = prepare_texts(documents, self.spec.provider, self.spec.model, self.spec.dim)
        return self.insert(records, seq), documents.count()

    def delete(self, ids: DataFrame, seq: int | None = None) -> int:
        """Delete the listed typed ids; returns how many there were."""
        seq, mode = self._claim(seq)
        newest = self._newest(before=seq).where(~F.col("deleted"))
        doomed = newest.join(ids.select("id").distinct(), "id", "left_semi")
        tombs = doomed.select(
            "id",
            F.lit(None).cast("array<float>").alias("values"),
            F.lit(None).cast("map<string,string>").alias("metadata"),
            F.lit(0).cast("bigint").alias("position"),
            F.lit(True).alias("deleted"),
            F.lit(None).cast("string").alias("reason"),
        )
        return self._append(tombs, seq, mode).count()

    def search(
        self,
        queries: DataFrame,
        k: int = DEFAULT_TOP_K,
        filters: Mapping[str, object] | None = None,
        advanced_filters: list | None = None,
        hybrid: bool | None = None,
        alpha: float | None = None,
        rerank: bool | Mapping[str, object] = False,
        include_metadata: bool | None = None,
        include_embeddings: bool = False,
        include_documents: bool = False,
    ) -> DataFrame:
        """Top-k of each query (``query_vector`` or ``query_text``) among the records that pass.

        A hybrid collection searches texts both ways unless told otherwise. ``rerank`` is true,
        or a mapping with ``enabled`` and optionally ``provider`` and ``model``. Filters name metadata
        keys, never columns of the records; declared fields compare in their types, by their stored
        columns.
        """
        corpus, spec = self._passing(filters, advanced_filters), self.spec
        model = {"provider": spec.provider, "model": spec.model, "dim": spec.dim}
        corpus = corpus.withColumn("text", F.col("metadata")["text"])
        if "query_vector" in queries.columns:
            if not queries.where(F.size("query_vector") != spec.dim).isEmpty():
                raise ValueError(f"a query vector has not {spec.dim} values")
            hits = vector_search(queries, corpus, k, spec.metric)
        elif spec.hybrid if hybrid is None else hybrid:
            index = build_sparse_index(corpus)
            hits = hybrid_search(queries, corpus, index, k, alpha, metric=spec.metric, **model)
        else:
            hits = text_search(queries, corpus, k, spec.metric, **model)
        asked = {"enabled": rerank} if isinstance(rerank, bool) else dict(rerank)
        if asked.pop("enabled", False):
            hits = rerank_hits(hits, queries, corpus, k, **asked)
        documents = corpus.withColumns({"doc_kind": F.lit("text"), "doc_value": F.col("text")})
        return result_projection(
            hits, documents, "metadata", include_metadata, include_embeddings, include_documents
        )

    def _passing(self, filters: Mapping[str, object] | None = None, advanced_filters: list | None = None) -> DataFrame:
        """Current records that satisfy all filters: ``id, values, metadata``."""
        corpus, fields, columns = self._current(), dict(self.spec.schema.fields), self._stored_fields()
        if filters:
            corpus = filter_equality(corpus, filters, fields=fields, columns=columns)
        if advanced_filters:
            corpus = filter_advanced(corpus, advanced_filters, fields=fields, columns=columns)
        return corpus.select("id", "values", "metadata")

    def drop(self) -> None:
        """Remove the collection and its records."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

