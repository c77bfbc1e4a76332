"""Runs from a source to a dataset: what they change, repeats, broken runs, several sources, streams."""

from datetime import datetime, timedelta, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodestone.operators.catalog import list_documents_keyset
from lodestone.operators.embed import embed_texts
from lodestone.streaming import source_runs
from lodestone.streaming.source_runs import ingest_source, runs, source_catalog, source_vectors, stream_source

DAY = datetime(2024, 1, 1, tzinfo=timezone.utc)


def snapshot(spark, **documents):
    return spark.createDataFrame(list(documents.items()), "external_id string, content string")


def state(spark, path):
    return rows(source_catalog(spark, path), "external_id", "version", "status", "chunk_count")


def test_full_runs_delete_and_documents_return(spark, folder):
    path = folder + "/d"
    assert source_catalog(spark, path).count() == source_vectors(spark, path).count() == 0
    assert ingest_source(snapshot(spark, a="one two", b="three", c=" "), path, "s", "full", at=DAY) == 0
    assert state(spark, path) == [("a", 1, "ready", 1), ("b", 1, "ready", 1), ("c", 1, "failed", 0)]
    assert ingest_source(snapshot(spark, a="one two", c="now"), path, "s", "full", at=DAY + timedelta(1)) == 1
    assert state(spark, path) == [("a", 1, "ready", 1), ("c", 2, "ready", 1)]
    assert ingest_source(snapshot(spark, b="three"), path, "s", "incremental", at=DAY + timedelta(2)) == 2
    assert state(spark, path) == [("a", 1, "ready", 1), ("b", 2, "ready", 1), ("c", 2, "ready", 1)]  # continues its versions
    times = rows(source_catalog(spark, path), "external_id", F.dayofmonth("created_at"), F.dayofmonth("updated_at"))
    assert times == [("a", 1, 1), ("b", 3, 3), ("c", 1, 2)]
    assert rows(source_vectors(spark, path), "external_id", "version", "text") == [("a", 1, "one two"), ("b", 2, "three"), ("c", 2, "now")]
    want = [(0, 3, 0, 0, 0, 1, 2, "completed"), (1, 0, 1, 1, 1, 0, 1, "completed"), (2, 1, 0, 0, 0, 0, 1, "completed")]
    kinds = [f"documents_{k}" for k in ("new", "changed", "deleted", "unchanged")]
    assert rows(runs(spark, path), "run", *kinds, "failures", "vectors_inserted", "status") == want


def test_repeats_and_broken_runs(spark, folder, monkeypatch):
    path = folder + "/d"
    ingest_source(snapshot(spark, a="one", b="two"), path, "s", "full", at=DAY)
    before = state(spark, path), rows(source_vectors(spark, path), "external_id", "text")

    class Broken(Exception):
        pass

    def fail(*_):
        raise Broken

    with monkeypatch.context() as m:  # vectors are written, the catalog is not
        m.setattr(source_runs.F, "count_if", fail)
        with pytest.raises(Broken):
            ingest_source(snapshot(spark, a="changed", c="new"), path, "s", "full")
    assert (state(spark, path), rows(source_vectors(spark, path), "external_id", "text")) == before
    for _ in range(2):  # the same run again, and once more
        assert ingest_source(snapshot(spark, a="changed", c="new"), path, "s", "full", run=1) == 1
        assert state(spark, path) == [("a", 2, "ready", 1), ("c", 1, "ready", 1)]
        assert rows(source_vectors(spark, path), "external_id", "text") == [("a", "changed"), ("c", "new")]
        assert runs(spark, path).count() == 2


def test_sources_do_not_touch_each_other(spark, folder):
    path = folder + "/d"
    ingest_source(snapshot(spark, a="one"), path, "s", "full")
    ingest_source(snapshot(spark, a="other", b="two"), path, "t", "full")
    ingest_source(snapshot(spark, b="two"), path, "s", "full")
    assert rows(source_catalog(spark, path), "source_id", "external_id") == [("s", "b"), ("t", "a"), ("t", "b")]
    assert source_catalog(spark, path).select("id").distinct().count() == 3


def test_metadata_travels_and_counts_as_a_change(spark, folder):
    path = folder + "/d"
    docs = snapshot(spark, a="one", b="two").withColumn("metadata", F.create_map(F.lit("k"), F.col("external_id")))
    ingest_source(docs, path, "s")
    docs = docs.withColumn("metadata", F.when(F.col("external_id") == "a", F.create_map(F.lit("k"), F.lit("z"))).otherwise(F.col("metadata")))
    ingest_source(docs, path, "s")
    found = source_vectors(spark, path)
    assert rows(found, "external_id", "version", F.col("metadata")["k"]) == [("a", 2, "z"), ("b", 1, "b")]
    want = {r["external_id"]: list(r["v"]) for r in embed_texts(docs, "content", "v").collect()}
    assert {r["external_id"]: list(r["values"]) for r in found.collect()} == want


def test_odd_snapshots(spark, folder):
    path = folder + "/d"
    odd = spark.createDataFrame([(None, "x"), ("a", None), ("b", "same"), ("b", "same")], "external_id string, content string")
    ingest_source(odd, path, "s", "full")
    assert state(spark, path) == [("a", 1, "failed", 0), ("b", 1, "ready", 1)]
    ingest_source(odd.limit(0), path, "s", "full")
    assert state(spark, path) == [] and source_vectors(spark, path).count() == 0
    with pytest.raises(ValueError):
        ingest_source(odd, path, "s", "partial")
    with pytest.raises(Exception, match="several contents"):
        ingest_source(snapshot(spark, a="1").union(snapshot(spark, a="2")), path, "s")
    both = snapshot(spark, a="1").withColumn("n", F.lit(2)).union(snapshot(spark, a="2").withColumn("n", F.lit(1)))
    ingest_source(both, path, "s", order="n")
    assert rows(source_vectors(spark, path), "text") == [("1",)]


def test_the_catalog_is_paged(spark, folder):
    path = folder + "/d"
    for day in range(3):
        ingest_source(snapshot(spark, **{f"d{day}{i}": "text" for i in range(4)}), path, "s", at=DAY + timedelta(day))
    catalog, cursor, seen = source_catalog(spark, path), "", []
    while True:
        page = list_documents_keyset(catalog, 5, cursor, status="ready").orderBy("created_at", "id").collect()
        seen += [r["external_id"] for r in page]
        cursor = page[-1]["next_cursor"]
        if not cursor:
            break
    assert sorted(seen) == sorted(f"d{day}{i}" for day in range(3) for i in range(4)) and [s[1] for s in seen] == sorted(s[1] for s in seen)


def test_streams_are_runs(spark, folder):
    source, path = folder + "/in", folder + "/d"
    snapshot(spark, a="one", b="two").write.parquet(source + "/1")
    stream = spark.readStream.schema("external_id string, content string").option("recursiveFileLookup", "true").parquet(source)
    stream_source(stream, path, "s").awaitTermination()
    snapshot(spark, b="two again", c="three").write.parquet(source + "/2")
    stream_source(stream, path, "s").awaitTermination()
    assert state(spark, path) == [("a", 1, "ready", 1), ("b", 2, "ready", 1), ("c", 1, "ready", 1)]
    assert rows(runs(spark, path), "run", "documents_new", "documents_changed") == [(0, 2, 0), (1, 1, 1)]
