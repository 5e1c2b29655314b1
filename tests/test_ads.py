import json

from retail_insight.operators import ads
from retail_insight.sources import adlog

DAY_MS = 86_400_000
T0 = 19_723 * DAY_MS  # 2024-01-01T00:00:00Z


def lines_df(spark, rows):
    """rows: (batch_id, line)"""
    return spark.createDataFrame(rows, "batch_id long, value string")


def parsed(spark, rows):
    return adlog.parse_ad_log(lines_df(spark, rows), keep=("batch_id",))


def line(ts, user, ad, area="North", city="C1"):
    return f"{ts} {area} {city} {user} {ad}"


def test_bad_lines_set_aside_sixth_token_ignored(spark):
    p = parsed(spark, [(0, "1 a b 2"), (0, "x a b 2 3"), (0, "5 a b 2 3 extra"), (0, "")])
    assert [r.value for r in adlog.rejected_lines(p).collect()] != []
    assert sorted(r.value for r in adlog.rejected_lines(p).collect()) == ["", "1 a b 2", "x a b 2 3"]
    good = adlog.accepted_lines(p).collect()
    assert [(g.ts, g.area, g.city, g.user_id, g.ad_id) for g in good] == [(5, "a", "b", "2", "3")]


def test_day_boundary_utc_and_zone(spark):
    p = parsed(spark, [(0, line(T0 - 1, 1, 1)), (0, line(T0, 1, 1))])
    assert sorted(r.day for r in p.collect()) == ["2023-12-31", "2024-01-01"]
    z = adlog.parse_ad_log(lines_df(spark, [(0, line(T0 + 3_600_000, 1, 1))]), tz="America/New_York")
    assert z.first().day == "2023-12-31"


def _flow(spark, rows, threshold=3):
    a = adlog.accepted_lines(parsed(spark, rows))
    bl = ads.blacklist(a, threshold)
    return a, bl, ads.accepted(a, bl)


def test_blacklist_listing_batch_kept_later_dropped(spark):
    rows = [(0, line(T0 + i, 7, 1)) for i in range(2)] + [(1, line(T0 + 10 + i, 7, 1)) for i in range(2)]
    rows += [(2, line(T0 + 20, 7, 1))]
    _, bl, acc = _flow(spark, rows)
    assert [(r.user_id, r.listed_batch) for r in bl.collect()] == [("7", 1)]
    assert acc.count() == 4


def test_blacklist_applies_to_other_ads_and_days(spark):
    rows = [(0, line(T0 + i, 7, 1)) for i in range(3)] + [(1, line(T0 + DAY_MS, 7, 2)), (1, line(T0, 8, 2))]
    _, _, acc = _flow(spark, rows)
    assert sorted((r.user_id, r.ad_id) for r in acc.collect()) == [("7", "1")] * 3 + [("8", "2")]


def test_threshold_counts_per_day_and_ad(spark):
    rows = [(0, line(T0, 7, 1)), (0, line(T0, 7, 1)), (0, line(T0, 7, 2)), (0, line(T0 + DAY_MS, 7, 1))]
    _, bl, _ = _flow(spark, rows)
    assert bl.count() == 0


def test_top_ads_ties_by_id_and_json(spark):
    rows = [(0, line(T0, u, ad)) for ad in (4, 3, 2, 1) for u in (1, 2)] + [(0, line(T0, 9, 5))]
    a = adlog.accepted_lines(parsed(spark, rows))
    per_area = ads.area_counts(ads.area_city_counts(a))
    top = ads.top_ads(per_area)
    assert [(r.ad_id, r.clicks, r.rank) for r in top.orderBy("rank").collect()] == [
        ("1", 2, 1), ("2", 2, 2), ("3", 2, 3)]
    j = ads.top_ads_json(top).first().ads_json
    assert j == '[{"1":2},{"2":2},{"3":2}]'
    assert json.loads(j) == [{"1": 2}, {"2": 2}, {"3": 2}]


def test_area_counts_roll_up_cities(spark):
    rows = [(0, line(T0, 1, 1, city="C1")), (0, line(T0, 2, 1, city="C2")), (0, line(T0, 3, 2, city="C2"))]
    a = adlog.accepted_lines(parsed(spark, rows))
    per_city = {(r.city, r.ad_id): r.clicks for r in ads.area_city_counts(a).collect()}
    assert per_city == {("C1", "1"): 1, ("C2", "1"): 1, ("C2", "2"): 1}
    per_area = {r.ad_id: r.clicks for r in ads.area_counts(ads.area_city_counts(a)).collect()}
    assert per_area == {"1": 2, "2": 1}
