"""Declared metadata: stored as typed columns, pushed down, checked on insert, retyped."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodestone.collection import Collection, CollectionSpec
from lodestone.operators.filters import Filter, filter_advanced
from lodestone.operators.schema import MetadataSchema, check_metadata_schema, misfits

BATCH = "id struct<kind:string,s:string,i:bigint>, values array<float>, metadata map<string,string>, position bigint"


def batch(spark, *records):
    return spark.createDataFrame([(("str", i, None), [1.0, float(n)], m, n) for n, (i, m) in enumerate(records)], BATCH)


@pytest.fixture
def collection(spark, folder):
    spec = CollectionSpec("c", dim=2, schema=MetadataSchema((("size", "i32"), ("metadata", "string"))))
    return Collection.create(spark, f"{folder}/c", spec)


def ids(df):
    return [r[0] for r in rows(df, "id.s")]


def test_filters_reach_the_statistics_of_the_base(spark, collection):
    collection.insert(batch(spark, *[(f"r{i:03}", {"size": str(i), "tag": "x"}) for i in range(50)]))
    collection.compact()
    collection.insert(batch(spark, ("r001", {"size": "40"}), ("late", {"size": "41"}), ("r045", {"size": "1"})))
    passing = collection._passing({"tag": "x"}, [Filter("size", "gt", 39)])
    assert ids(passing) == [f"r{i:03}" for i in range(40, 50) if i != 45]
    assert ids(collection._passing(advanced_filters=[Filter("size", "between", values=(40, 41))])) == ["late", "r001", "r040", "r041"]
    plan = passing._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(field_size_i32)" in plan.split("PushedFilters: [", 1)[1].split("]")[0]
    asks = spark.createDataFrame([(1, [1.0, 41.0])], "query_id int, query_vector array<double>")
    hits = collection.search(asks, 3, advanced_filters=[Filter("size", "gte", 47)])
    assert ids(hits) == ["r047", "r048", "r049"] and "field_size_i32" not in hits.columns


def test_a_field_may_be_named_like_a_column(spark, collection):
    collection.insert(batch(spark, ("a", {"metadata": "m", "id": "b"}), ("b", {"metadata": "n"})))
    for _ in range(2):
        assert ids(collection._passing({"metadata": "m"})) == ["a"] and ids(collection._passing({"id": "b"})) == ["a"]
        collection.compact()
    loose = spark.createDataFrame([(1, '{"id": 7}')], "id int, m string").select("id", F.parse_json("m").alias("metadata"))
    with pytest.raises(ValueError, match="named like"):
        check_metadata_schema(loose, MetadataSchema((("id", "i32"),)))


def test_misfits_are_kept_aside(spark, collection):
    odd = batch(spark, ("a", {"size": "7"}), ("b", {"size": "x"}), ("c", {"size": "4294967296"}), ("d", {}), ("e", None))
    assert collection.insert(odd) == 3
    assert rows(collection.rejects(), "id.s", "reason") == [("b", "field size is no i32"), ("c", "field size is no i32")]
    assert collection.misfits().count() == 0


@pytest.mark.parametrize("compacted", [False, True])
def test_retyping_rewrites_the_base_and_lists_misfits(spark, folder, compacted):
    made = Collection.create(spark, f"{folder}/c", CollectionSpec("c", dim=2, schema=MetadataSchema((("size", "string"),))))
    made.insert(batch(spark, ("a", {"size": "7"}), ("b", {"size": "x"}), ("c", {"size": "2.5"}), ("d", {})))
    if compacted:
        made.compact()
    made.update_schema([("size", "i32")])
    for handle in (made, Collection.open(spark, f"{folder}/c")):
        assert rows(handle.misfits(), "id.s", "field", "value", "kind") == [("b", "size", "x", "i32"), ("c", "size", "2.5", "i32")]
        assert ids(handle._passing(advanced_filters=[Filter("size", "lt", 8)])) == ["a"]
        assert ids(handle._passing(advanced_filters=[Filter("size", "not_exists")])) == ["b", "c", "d"]
    made.update_schema([("size", "f64")])
    assert ids(made._passing(advanced_filters=[Filter("size", "lt", 3)])) == ["c"]
    made.update_schema([], mode="replace")
    assert ids(made._passing(advanced_filters=[Filter("size", "eq", "x")])) == ["b"] and made.records().count() == 4


def test_a_base_of_the_schema_before_is_read_rightly(spark, collection, monkeypatch):
    """The new schema is written, and the process ends before the base is."""
    collection.insert(batch(spark, ("a", {"size": "7", "note": "n"}), ("b", {"size": "9"})))
    collection.compact()
    monkeypatch.setattr(Collection, "compact", lambda self: None)
    collection.update_schema([("size", "f64"), ("note", "string")])
    assert ids(collection._passing({"note": "n"}, [Filter("size", "lt", 7.5)])) == ["a"]


def test_numbers_are_no_nan(spark):
    data = [(i, {"n": v}) for i, v in enumerate(["NaN", "10", "9", "Infinity", "-Infinity", "text"])]
    df = spark.createDataFrame(data, "id int, metadata map<string,string>")
    assert rows(filter_advanced(df, [Filter("n", "gt", 9.5)]), "id") == [(1,)]
    assert rows(filter_advanced(df, [Filter("n", "lt", 9.5)]), "id") == [(2,)]


def test_misfits_of_several_fields(spark):
    df = spark.createDataFrame([(1, "x", "-1"), (2, "3", "4"), (3, None, "5.5")], "id int, a string, b string")
    schema = MetadataSchema((("a", "i32"), ("b", "u32")))
    found = misfits(df, ["id"], {"a": F.col("a"), "b": F.col("b")}, schema)
    assert rows(found) == [(1, "a", "x", "i32"), (1, "b", "-1", "u32"), (3, "b", "5.5", "u32")]
    assert misfits(df, ["id"], {}, MetadataSchema()).count() == 0
