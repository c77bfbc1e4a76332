"""Shapes of physical plans that have to hold at scale."""

import pytest

from lodestone.operators import search
from lodestone.plans import registry

EAGER = {"stream_ingest", "write_collection"}


def plan_of(spark, sf, name):
    return registry.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - EAGER))
def test_no_cross_joins(spark, sf, name):
    plan = plan_of(spark, sf, name)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["vector_search", "text_search", "sparse_search", "list_messages"])
def test_top_k_is_cut_before_the_shuffle(spark, sf, name):
    plan = plan_of(spark, sf, name)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hybrid_ranks_are_cut_before_the_shuffle(spark, sf, monkeypatch):
    """Its lists are materialised on the way, so the plan it returns only reads them."""
    plans, cut = [], search.cut_lineage

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    monkeypatch.setattr(search, "cut_lineage", seen)
    registry.QUERIES["hybrid_search"](spark, sf)
    ranked = [p for p in plans if "row_number()" in p]
    cut_early = [p for p in ranked if "WindowGroupLimit" in p and "Partial" in p]
    assert len(ranked) == 3 and len(cut_early) >= 2  # both lists; the union lies by query already


def test_exact_search_reads_two_columns_and_shuffles_only_hits(spark, sf):
    plan = plan_of(spark, sf, "vector_search")
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in plan
    assert plan.count("Exchange") == 1


def test_filters_reach_the_scan(spark, sf):
    plan = plan_of(spark, sf, "filter_advanced")
    assert "In(lang" in plan and "GreaterThanOrEqual(n_chars" in plan
    assert "text:string" not in plan


def test_scope_list_is_pushed_down(spark, sf):
    assert "In(lang, [de,en])" in plan_of(spark, sf, "scope_filter") or "In(lang, [en,de])" in plan_of(spark, sf, "scope_filter")


def test_listing_and_sampling_take_ordered(spark, sf):
    for name in ("sample_source", "list_documents_keyset"):
        assert "TakeOrderedAndProject" in plan_of(spark, sf, name)
