"""City share remark: the replacement of the reference's string UDAF.

For each group, the share of every city is ``round(count / total * 1000) / 10``
percent (half-up rounding, one decimal). The two largest shares are listed as
``city:12.3%``; when the group has more cities, one more part gives the rest,
``100 - share1 - share2`` rounded to one decimal, under the label below. Ties
in count are broken by city name.

The aggregation is two native steps instead of a map-valued UDAF buffer:
counts per (group, city) first, so every shuffle carries at most one row per
city and map task; then one row per group with the total and the cities in
rank order. That second step holds one small struct per city of the group, so
its size is bounded by the city dimension, not by the number of clicks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: label of the remainder part, as in the reference output.
OTHERS_LABEL = "其他"


def _round1(x: Column) -> Column:
    """Half-up rounding to one decimal of a percentage, in double arithmetic."""
    return F.floor(x * 10 + F.lit(0.5)) / 10


def _part(label: Column, share: Column) -> Column:
    return F.concat(label, F.lit(":"), share.cast("string"), F.lit("%"))


def city_share(per_city: DataFrame, keys: Sequence[str], city_col: str = "city_name",
               count_col: str = "n", top: int = 2, others_label: str = OTHERS_LABEL,
               out_col: str = "city_remark", total_col: str | None = None) -> DataFrame:
    """One row per ``keys`` with the remark (and the total, if ``total_col``).

    ``per_city`` has one row per (keys..., city) with the city's count.
    """
    ranked = F.array_sort(F.collect_list(
        F.struct((-F.col(count_col)).alias("neg"), F.col(city_col).alias("city"))))
    agg = per_city.groupBy(*keys).agg(
        F.sum(count_col).alias("_total"),
        F.count(F.lit(1)).alias("_ncity"),
        F.slice(ranked, 1, top).alias("_top"))

    total = F.col("_total")
    shares = F.transform("_top", lambda e: F.struct(
        e["city"].alias("city"),
        (F.floor(-e["neg"] / total * 1000 + F.lit(0.5)) / 10).alias("share")))
    parts = F.transform(shares, lambda s: _part(s["city"], s["share"]))
    rest = F.aggregate(shares, F.lit(100.0), lambda acc, s: acc - s["share"])
    others = F.when(F.col("_ncity") > top, _part(F.lit(others_label), _round1(rest)))
    out = [*keys, F.concat_ws(",", parts, others).alias(out_col)]
    if total_col:
        out.insert(len(keys), total.alias(total_col))
    return agg.select(*out)


# -- the same remark as SQL functions -----------------------------------------
# Their bodies are SQL expressions, which the optimizer inlines: no UDF runs.
_CITIES = "cities ARRAY<STRUCT<city: STRING, n: BIGINT>>"
_FUNCTIONS = {
    "city_shares": f"""({_CITIES}) RETURNS ARRAY<STRUCT<city: STRING, share: DOUBLE>>
      RETURN transform(
        slice(array_sort(transform(cities, c -> struct(-c.n AS neg, c.city AS city))), 1, 2),
        e -> struct(e.city AS city,
                    floor(-e.neg / aggregate(cities, 0L, (t, c) -> t + c.n) * 1000 + 0.5D) / 10 AS share))""",
    "city_ratio": f"""({_CITIES}) RETURNS STRING
      RETURN concat_ws(',',
        transform(city_shares(cities), s -> concat(s.city, ':', cast(s.share AS STRING), '%')),
        CASE WHEN size(cities) > 2 THEN concat('{OTHERS_LABEL}:', cast(
          floor(aggregate(city_shares(cities), 100.0D, (rest, s) -> rest - s.share) * 10 + 0.5D) / 10 AS STRING),
          '%') END)""",
}


def register_city_ratio(spark: SparkSession) -> None:
    """Make ``city_ratio(collect_list(struct(city_name AS city, n)))`` callable from the session's SQL.

    Its argument lists one (city, count) a city of the group, in any order;
    an empty list gives an empty remark.
    """
    for name, body in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
