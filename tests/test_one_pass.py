"""R1 and R2 from one aggregate, R5 and R6 from one count of the log: equal results, one scan."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F
from visit_rows import visit

import __spark_entry__ as entry_mod
from retail_insight.operators import ads, category
from retail_insight.schemas import USER_VISIT_ACTION

SF = "/root/testdata/sf0.001"


def final_plan(df):
    df.collect()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue().split("== Initial Plan ==")[0]


def rows_of(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


def test_counts_give_what_the_separate_aggregates_give(spark):
    rows = [visit(session_id=s, click_category_id=c) for s, c in
            [("a", 1), ("a", 1), ("b", 1), (None, 1), ("a", 2), ("c", -1), ("c", None), (None, None)]]
    rows += [visit(session_id="a", click_category_id=-1, order="1,2,2,,"),
             visit(session_id="b", click_category_id=None, pay="9"),
             visit(session_id="b", click_category_id=2, order="7", pay="8")]
    visits = spark.createDataFrame(rows, USER_VISIT_ACTION)
    counts = category.category_session_counts(visits)
    wide = category.category_counts_wide(category.category_actions(visits))
    assert rows_of(category.wide_from_counts(counts)) == rows_of(wide)
    top = category.top_categories(wide, "t", 2)
    assert (rows_of(category.session_clicks_from_counts(counts, top))
            == rows_of(category.category_session_clicks(visits, top)) != [])


@pytest.mark.parametrize("threshold", [1, 2, 3, 100])
def test_counts_are_filtered_as_events_are(spark, threshold):
    log = (spark.range(400).select(
        (F.col("id") % 5).alias("batch_id"), F.concat(F.lit("2020-01-0"), F.col("id") % 2 + 1).alias("day"),
        F.concat(F.lit("r"), F.col("id") % 3).alias("area"), F.concat(F.lit("c"), F.col("id") % 4).alias("city"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 37)).alias("user_id"),
        (F.col("id") % 7).cast("string").alias("ad_id")))
    events = ads.area_city_counts(ads.accepted(log, ads.blacklist(log, threshold)))
    assert rows_of(ads.accepted_counts(log, threshold)) == rows_of(events)


@pytest.mark.parametrize("key,scans", [("category_top10_sessions", 2), ("category_session_clicks", 2),
                                       ("area_city_ad_counts", 1), ("area_top3_ads_json", 1)])
def test_each_table_is_scanned_once(spark, key, scans):
    plan = final_plan(entry_mod.queries()[key](spark, SF))
    tree = plan.split("\n\n(")[0]
    assert tree.count("Scan parquet") == scans
    assert "ReusedExchange" in tree
