"""Null orders, stale batches, clashing names, numbers in text, repeated ids."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodestone.collection import Collection, CollectionSpec
from lodestone.functions.ids import ID_TYPE
from lodestone.operators.catalog import list_documents_keyset
from lodestone.operators.filters import Filter, filter_advanced
from lodestone.operators.ordering import preceding_rows, row_position
from lodestone.operators.schema import MetadataSchema
from lodestone.operators.search import search_all_collections
from lodestone.operators.sessions import session_rollup
from lodestone.streaming.events import assemble_blocks
from lodestone.streaming.ingest import one_per_id

BATCH = f"id {ID_TYPE}, values array<float>, metadata map<string,string>, position bigint"


def test_rows_without_order_come_last(spark):
    df = spark.createDataFrame([("a", 7), ("a", None), ("a", 2), (None, None), (None, 1)], "g string, n bigint")
    assert rows(row_position(df, ["g"], "n", "p"), "g", "n", "p") == rows(
        spark.createDataFrame([("a", 2, 0), ("a", 7, 1), ("a", None, 2), (None, 1, 0), (None, None, 1)], "g string, n bigint, p bigint")
    )
    far = preceding_rows(df.where("g = 'a'"), ["g"], "n", 100_000, F.col("n"), "before")
    assert rows(far, "n", "before") == [(2, []), (7, [2]), (None, [2, 7])]


@pytest.fixture
def collection(spark, folder):
    spec = CollectionSpec("c", dim=2, schema=MetadataSchema((("size", "f32"),)))
    return Collection.create(spark, f"{folder}/c", spec)


def batch(spark, *records):
    data = [(("str", i, None), v, m, p) for i, v, m, p in records]
    return spark.createDataFrame(data, BATCH)


def test_batches_after_a_base(spark, collection):
    first = batch(spark, ("a", [1.0, 0.0], {}, 0))
    assert collection.insert(first, 5) == 1
    collection.compact()
    with pytest.raises(ValueError):
        collection.insert(batch(spark, ("b", [0.0, 1.0], {}, 0)), 3)
    assert collection.insert(first, 5) == 1 and collection.records().count() == 1
    assert collection.insert(batch(spark, ("b", [0.0, 1.0], {}, 0))) == 1
    assert collection.records().count() == 2


def test_rejected_rows_are_kept(spark, collection):
    odd = batch(spark, ("a", [1.0, 0.0], {}, 0), ("b", [1.0], {}, 1), ("c", None, {}, 2), ("d", [1.0, 1.0], {}, None))
    assert collection.insert(odd) == 1 and collection.records().count() == 1
    assert rows(collection.rejects(), F.col("id.s"), "reason") == [
        ("b", "vector has not 2 values"), ("c", "vector has not 2 values"), ("d", "no position"),
    ]
    with pytest.raises(ValueError):
        collection.search(spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "query_id int, query_vector array<float>"))


def test_filters_of_a_collection(spark, collection):
    collection.insert(
        batch(
            spark,
            ("a", [1.0, 0.0], {"size": "9", "n": "9", "id": "x"}, 0),
            ("b", [1.0, 0.0], {"size": "10", "n": "10", "id": "y"}, 1),
            ("c", [1.0, 0.0], {"n": "abc", "values": "z"}, 2),
            ("d", [1.0, 0.0], {"size": "abc", "n": "11"}, 3),  # no record: its declared field is no number
        )
    )
    query = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, query_vector array<float>")

    def found(*filters):
        return rows(collection.search(query, advanced_filters=list(filters)), F.col("id.s"))

    for name in ("size", "n"):
        assert found(Filter(name, "gt", 9.5)) == [("b",)]
        assert found(Filter(name, "between", values=(9, 10))) == [("a",), ("b",)]
        assert found(Filter(name, "ne", 9)) == [("b",), ("c",)]
    assert found(Filter("id", "eq", "x")) == [("a",)] and found(Filter("values", "exists")) == [("c",)]


def test_collections_of_another_dimension(spark):
    query = spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, query_vector array<float>")
    two = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "id int, values array<float>")
    three = spark.createDataFrame([(1, [1.0, 0.0, 0.0])], "id int, values array<float>")
    assert rows(search_all_collections(query, {"a": two, "b": two.limit(0)}), "collection", "id") == [("a", 1)]
    with pytest.raises(ValueError):
        search_all_collections(query, {"a": two, "b": three})


def test_fractions_are_not_cut_off(spark):
    df = spark.createDataFrame([(9,), (10,)], "n int")
    assert rows(filter_advanced(df, [Filter("n", "lt", 9.5)])) == [(9,)]
    assert rows(filter_advanced(df, [Filter("n", "gte", 9.5)])) == [(10,)]


def test_repeated_ids_need_an_order(spark):
    df = spark.createDataFrame([("a", "old", 1), ("a", "new", 2), ("b", None, None), ("b", None, None)], "external_id string, content string, at int")
    assert rows(one_per_id(df, "at")) == [("a", "new", 2), ("b", None, None)]
    assert one_per_id(df.where("external_id = 'b'"), None).count() == 1
    with pytest.raises(Exception, match="no order"):
        one_per_id(df, None).collect()


def test_newest_sessions(spark):
    data = [(1, 0, "user", "long", 10), (1, 1, "user", "x", 20), (1, 2, "user", "y", 30), (2, 0, "user", "new", 40)]
    said = spark.createDataFrame(data, "conv_id int, turn bigint, role string, text string, at int")
    assert rows(session_rollup(said, 1, "at"), "conv_id", "created_at", "updated_at") == [(2, 40, 40)]


def test_pages_hold_documents_without_a_time(spark):
    data = [(1, None), (2, "2024-01-01 00:00:00"), (3, None), (4, "2023-01-01 00:00:00")]
    catalog = spark.createDataFrame(data, "id int, at string").select("id", F.col("at").cast("timestamp").alias("created_at"))
    seen, cursor = [], ""
    while True:
        page = list_documents_keyset(catalog, 1, cursor).collect()
        seen += [r["id"] for r in page]
        cursor = page[0]["next_cursor"]
        if not cursor:
            break
    assert seen == [1, 3, 4, 2]


def test_all_white_space_is_trimmed(spark):
    lines = spark.createDataFrame([(1, 0, "data: a　"), (1, 1, "")], "stream_id int, line_no bigint, line string")
    assert rows(assemble_blocks(lines), "raw") == [("a",)]
