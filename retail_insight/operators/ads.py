"""R3 (fraud blacklist), R5 (clicks per day/area/city/ad), R6 (top ads per area).

All functions take the parsed ad log (``sources.adlog``) and work on batch
DataFrames; the streaming pipeline calls the same functions per micro-batch.

Blacklist feedback in closed form. With ``b`` the micro-batch an event
arrived in and T the threshold, a user is listed in the first batch where
some (day, user, ad) reaches T clicks counted over batches <= b, and from the
next batch on that user's events are dropped. The drop never affects counts
up to the listing batch, so no recursion is needed:

    n(b, day, user, ad) = count(*)
    cum                 = sum(n) over (partition by day, user, ad order by b)
    listed_batch(user)  = min(b) where cum >= T
    accepted            = events without a listed_batch before their batch
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .topk import top_k

# Fixed value: the reference lists a user at 100 clicks on one ad in one day.
DEFAULT_THRESHOLD = 100
TOP_ADS = 3


def user_day_clicks(ads: DataFrame) -> DataFrame:
    """(day, user_id, ad_id, clicks)."""
    return ads.groupBy("day", "user_id", "ad_id").agg(F.count(F.lit(1)).alias("clicks"))


def blacklist(ads: DataFrame, threshold: int = DEFAULT_THRESHOLD, batch_col: str = "batch_id") -> DataFrame:
    """(user_id, listed_batch): users whose clicks on one ad in one day reached T.

    Events are first counted per (batch, day, user, ad), so the running-sum
    window sees at most one row per batch for a key however hot it is.
    """
    return _listed(ads.groupBy(batch_col, "day", "user_id", "ad_id").agg(F.count(F.lit(1)).alias("n")),
                   threshold, batch_col)


def _listed(per_batch: DataFrame, threshold: int, batch_col: str) -> DataFrame:
    running = F.sum("n").over(Window.partitionBy("day", "user_id", "ad_id").orderBy(batch_col))
    return (per_batch.withColumn("cum", running)
            .filter(F.col("cum") >= threshold)
            .groupBy("user_id").agg(F.min(batch_col).alias("listed_batch")))


def accepted(ads: DataFrame, listed: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """Events not filtered by the blacklist: the listing batch itself is kept.

    Anti join on user with the batch order as extra condition; a hot user is
    split by AQE's skew-join handling rather than landing in one task.
    """
    a, bl = ads.alias("a"), listed.alias("bl")
    cond = (F.col("a.user_id") == F.col("bl.user_id")) & (F.col(f"a.{batch_col}") > F.col("bl.listed_batch"))
    return a.join(bl, cond, "left_anti")


def batch_counts(ads: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """Clicks per (batch, day, area, city, user, ad), ``n``: all that R3, R5 and R6 need of the log.

    Accepted lines always name a user; the filter says so to both readers of
    the counts, whose plans then share one shuffle.
    """
    keys = (batch_col, "day", "area", "city", "user_id", "ad_id")
    return ads.filter(F.col("user_id").isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def accepted_counts(ads: DataFrame, threshold: int = DEFAULT_THRESHOLD, batch_col: str = "batch_id",
                    by: tuple[str, ...] = ()) -> DataFrame:
    """R5 (``by``, day, area, city, ad_id, clicks) straight from the log, blacklist feedback included.

    A user is dropped by batch, so counts per batch and user can be filtered
    in place of events: the log is parsed once, and the join sees a hot
    user's counts only. An outer join with a filter, as an anti join would
    move below the counts and read the log again.
    """
    counts = batch_counts(ads, batch_col)
    per_batch = counts.groupBy(batch_col, "day", "user_id", "ad_id").agg(F.sum("n").alias("n"))
    listed = _listed(per_batch, threshold, batch_col)
    kept = (counts.join(listed, "user_id", "left")
            .filter(F.coalesce(F.col(batch_col) <= F.col("listed_batch"), F.lit(True))))
    return kept.groupBy(*by, "day", "area", "city", "ad_id").agg(F.sum("n").cast("long").alias("clicks"))


def area_city_counts(ads: DataFrame) -> DataFrame:
    """R5: (day, area, city, ad_id, clicks)."""
    return ads.groupBy("day", "area", "city", "ad_id").agg(F.count(F.lit(1)).alias("clicks"))


def area_counts(area_city: DataFrame) -> DataFrame:
    """City totals rolled up to (day, area, ad_id, clicks)."""
    return area_city.groupBy("day", "area", "ad_id").agg(F.sum("clicks").cast("long").alias("clicks"))


def top_ads(per_area: DataFrame, k: int = TOP_ADS) -> DataFrame:
    """Exactly min(k, n) ads per (day, area), by clicks desc then ad id."""
    top = top_k(per_area, ["day", "area"], [F.col("clicks").desc(), F.col("ad_id").asc()], k,
                rank_col="rank", keep_rank=True)
    return top.withColumn("rank", F.col("rank").cast("long"))


def top_ads_json(top: DataFrame) -> DataFrame:
    """(day, area, ads_json) with ads_json like ``[{"2":16},{"4":12}]`` in rank order.

    A group holds at most k rows, so collecting it is bounded.
    """
    ranked = F.array_sort(F.collect_list(F.struct("rank", "ad_id", "clicks")))
    return top.groupBy("day", "area").agg(ranked.alias("_ads")).select(
        "day", "area",
        F.to_json(F.transform("_ads", lambda x: F.create_map(x["ad_id"], x["clicks"]))).alias("ads_json"))
