from visit_rows import visit

from retail_insight import schemas
from retail_insight.functions.city_share import city_share
from retail_insight.operators import area


def remark(spark, counts):
    df = spark.createDataFrame([("g", c, n) for c, n in counts], "g string, city_name string, n long")
    return city_share(df, ["g"]).first().city_remark


def test_city_share_one_two_three_cities(spark):
    assert remark(spark, [("A", 3)]) == "A:100.0%"
    assert remark(spark, [("A", 1), ("B", 2)]) == "B:66.7%,A:33.3%"
    assert remark(spark, [("A", 1), ("B", 1), ("C", 1)]) == "A:33.3%,B:33.3%,其他:33.4%"


def test_city_share_half_up_rounding(spark):
    # 1/8 = 12.5% stays 12.5; 1/16 = 6.25% rounds half up to 6.3
    assert remark(spark, [("A", 15), ("B", 1)]) == "A:93.8%,B:6.3%"


def _setup(spark, make_visits, clicks, products):
    cities = spark.createDataFrame([(1, "C1", "North")], schemas.CITY_INFO)
    v = make_visits([visit(click_product_id=p, city_id=1) for p, n in clicks for _ in range(n)])
    prods = spark.createDataFrame([(p, f"p{p}", "") for p in products], schemas.PRODUCT_INFO)
    return v, cities, prods


def test_rank_keeps_ties(spark, make_visits):
    v, c, p = _setup(spark, make_visits, [(1, 5), (2, 4), (3, 4), (4, 4), (5, 1)], range(1, 6))
    got = sorted(r.product_name for r in area.area_top3_products(v, c, p).collect())
    assert got == ["p1", "p2", "p3", "p4"]


def test_unknown_product_leaves_gap(spark, make_visits):
    v, c, p = _setup(spark, make_visits, [(1, 5), (2, 4), (3, 3), (4, 2)], [2, 3, 4])
    got = sorted(r.product_name for r in area.area_top3_products(v, c, p).collect())
    assert got == ["p2", "p3"]


def test_non_clicks_are_ignored(spark, make_visits):
    v, c, p = _setup(spark, make_visits, [(0, 3), (-1, 3), (7, 1)], [0, 7])
    got = [(r.product_name, r.clickcount, r.city_remark) for r in area.area_top3_products(v, c, p).collect()]
    assert got == [("p7", 1, "C1:100.0%")]
