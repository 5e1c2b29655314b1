"""R4: most clicked products per area, with the city share remark.

Plan: clicks x cities -> counts per (area, product, city) -> clicks per (area,
product) -> rank <= 3 within area (ties kept) -> remark of the ranked products
only -> product names. Every shuffle follows a map-side partial aggregate or a
partial window-group limit, so neither a hot product nor a hot area
concentrates raw rows in one task; the per-city counts' shuffle is reused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.city_share import city_share
from .topk import top_k

TOP_PRODUCTS = 3


def action_city(visits: DataFrame, cities: DataFrame) -> DataFrame:
    """(area, city_name, click_product_id) of every real product click."""
    clicks = visits.filter(F.col("click_product_id") > 0).select("city_id", "click_product_id")
    return clicks.join(cities.select("city_id", "city_name", "area"), "city_id").select(
        "area", "city_name", "click_product_id")


def area_product_city_clicks(actions: DataFrame) -> DataFrame:
    """Clicks per (area, product, city): the pre-aggregate every R4 step reads."""
    return actions.groupBy("area", "click_product_id", "city_name").agg(F.count(F.lit(1)).alias("n"))


def area_product_clicks(actions: DataFrame) -> DataFrame:
    return actions.groupBy("area", "click_product_id").agg(F.count(F.lit(1)).alias("clickcount"))


def area_product_city_remark(actions: DataFrame) -> DataFrame:
    """(area, click_product_id, clickcount, city_remark) for every clicked product."""
    return city_share(area_product_city_clicks(actions), ["area", "click_product_id"],
                      total_col="clickcount")


def area_product_top3(actions: DataFrame, k: int = TOP_PRODUCTS) -> DataFrame:
    """Products ranked <= k by clicks within each area; ties share a rank.

    The remark is built for the ranked products only.
    """
    per_city = area_product_city_clicks(actions)
    totals = per_city.groupBy("area", "click_product_id").agg(F.sum("n").alias("clickcount"))
    top = top_k(totals, ["area"], [F.col("clickcount").desc()], k, with_ties=True).alias("top")
    ranked = per_city.alias("c").join(
        top, F.col("c.area").eqNullSafe(F.col("top.area"))
        & (F.col("c.click_product_id") == F.col("top.click_product_id")), "left_semi")
    return city_share(ranked, ["area", "click_product_id"], total_col="clickcount")


def area_top3_products(visits: DataFrame, cities: DataFrame, products: DataFrame,
                       k: int = TOP_PRODUCTS) -> DataFrame:
    """The R4 result: (area, product_name, clickcount, city_remark).

    Ranking happens before the product join, so a top product missing from
    ``products`` leaves a gap instead of promoting the next one.
    """
    top = area_product_top3(action_city(visits, cities), k)
    return top.join(products.select("product_id", "product_name"),
                    top.click_product_id == products.product_id).select(
        "area", "product_name", "clickcount", "city_remark")
