"""A user with a third of all rows: results stay whole and exact when the
joins are forced through sort-merge with AQE's skew split."""

import pytest
from visit_rows import visit
from pyspark.sql import functions as F

from retail_insight.operators import ads, category
from retail_insight.operators.visits import filter_visits
from retail_insight.params import VisitFilter
from retail_insight.sources import adlog

FORCED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


@pytest.fixture
def forced_skew(spark):
    old = {k: spark.conf.get(k, None) for k in FORCED}
    for k, v in FORCED.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_user_visits_and_categories(spark, make_visits, make_users, forced_skew):
    rows = [visit(user_id=0, click_category_id=1 + i % 3, session_id=f"h{i % 7}") for i in range(3000)]
    rows += [visit(user_id=u, click_category_id=1 + u % 5, session_id=f"s{u}") for u in range(1, 6001)]
    v = make_visits(rows)
    users = make_users([(u, 30) for u in range(0, 6001)])
    joined = filter_visits(v, users, VisitFilter(start_age=20, end_age=50))
    assert joined.count() == 9000
    wide = {r.category_id: r.click_count
            for r in category.category_counts_wide(category.category_actions(joined)).collect()}
    assert wide == {str(c): 1000 + 1200 for c in (1, 2, 3)} | {"4": 1200, "5": 1200}


def test_hot_user_blacklist_and_accepted(spark, forced_skew):
    t0 = 19_723 * 86_400_000
    rows = [(i % 4, f"{t0 + i} A C 0 1") for i in range(4000)]           # hot user 0
    rows += [(i % 4, f"{t0 + i} A C {1 + i} 2") for i in range(8000)]    # one click each
    lines = spark.createDataFrame(rows, "batch_id long, value string")
    a = adlog.accepted_lines(adlog.parse_ad_log(lines, keep=("batch_id",)))
    bl = ads.blacklist(a, 100)
    assert [(r.user_id, r.listed_batch) for r in bl.collect()] == [("0", 0)]
    acc = ads.accepted(a, bl)
    assert acc.filter(F.col("user_id") == "0").count() == 1000   # batch 0 kept whole
    assert acc.count() == 9000
