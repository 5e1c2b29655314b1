"""Physical-plan properties the design relies on."""

import contextlib
import io

import pytest

import __spark_entry__ as entry_mod
from retail_insight.operators import area, category
from retail_insight.operators.visits import filter_visits
from retail_insight.params import VisitFilter
from retail_insight.session import new_work_dir
from retail_insight.sources import testdata as td
from retail_insight.sources.tables import read_table

SF = "/root/testdata/sf0.001"
STREAMS = {"stream_realtime_pipeline", "stream_blacklist_users", "stream_area_top3_ads_json",
           "stream_area_city_ad_counts", "table_overwrite", "kv_upsert", "offline_job_sessions"}


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def canonical(spark):
    """The canonical tables stored as parquet, visits partitioned by date."""
    root = new_work_dir(spark, "plans")
    tables = td.canonical_tables(spark, SF)
    tables["user_visit_action"].write.partitionBy("date").parquet(f"{root}/user_visit_action")
    for name in ("user_info", "product_info", "city_info"):
        tables[name].write.parquet(f"{root}/{name}")
    return {name: read_table(spark, name, f"{root}/{name}") for name in tables}


def test_filters_reach_the_scans(canonical):
    f = VisitFilter("1996-01-01", "2000-12-31", 20, 50)
    p = plan(filter_visits(canonical["user_visit_action"], canonical["user_info"], f))
    assert "PartitionFilters: [isnotnull(date" in p and "1996-01-01" in p
    assert "GreaterThanOrEqual(age,20)" in p and "LessThanOrEqual(age,50)" in p


def test_r1_columns_pruned_and_top_k_planned(canonical):
    v = filter_visits(canonical["user_visit_action"], canonical["user_info"], VisitFilter())
    p = plan(category.top_categories(category.category_counts_wide(category.category_actions(v)), "t"))
    assert "TakeOrderedAndProject" in p
    scan = p[p.index("Scan parquet"):]
    schema = scan[scan.index("ReadSchema"):].splitlines()[0]
    assert "session_id" not in schema and "search_keyword" not in schema


def test_r2_semi_join_is_broadcast_and_window_limited(canonical):
    v = canonical["user_visit_action"]
    top = category.top_categories(category.category_counts_wide(category.category_actions(v)), "t")
    p = plan(category.top_sessions(category.category_session_clicks(v, top), "t"))
    assert "LeftSemi" in p and "BroadcastExchange" in p
    assert "WindowGroupLimit" in p and "Partial" in p


def test_r4_partial_aggregates_and_window_limit(canonical):
    p = plan(area.area_top3_products(canonical["user_visit_action"], canonical["city_info"],
                                     canonical["product_info"]))
    assert p.count("partial_count") >= 1 and "partial_collect_list" in p
    assert "WindowGroupLimit" in p and "Partial" in p
    assert "PushedFilters: [IsNotNull(click_product_id), GreaterThan(click_product_id,0)" in p
    # the remark is collected after the ranked products are known
    assert p.index("LeftSemi") < p.index("partial_collect_list")


@pytest.mark.parametrize("key", sorted(set(entry_mod.queries()) - STREAMS))
def test_no_cartesian_no_python(spark, key):
    p = plan(entry_mod.queries()[key](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in p, bad
