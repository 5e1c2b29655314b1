"""R1 (top-10 categories) and R2 (top-10 sessions per top category).

A visit counts for exactly one action class, in this precedence: a click
(``click_category_id`` set and not -1), else an order (non-empty order CSV),
else a payment (non-empty pay CSV). Order and pay rows count every non-empty
CSV item, repeats included. Category ids are strings throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.csv_ids import csv_items, has_items
from .topk import top_k

CLICK, ORDER, PAY = "click", "order", "pay"
TOP_CATEGORIES = 10
TOP_SESSIONS = 10


def is_click(visits_click_col: str = "click_category_id") -> Column:
    return F.coalesce(F.col(visits_click_col), F.lit(-1)) != -1


def category_actions(visits: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per (visit, category item): (category_id, action); ``keep`` columns pass through."""
    click, order, pay = is_click(), has_items(F.col("order_category_ids")), has_items(F.col("pay_category_ids"))
    action = F.when(click, CLICK).when(order, ORDER).when(pay, PAY)
    ids = (F.when(click, F.array(F.col("click_category_id").cast("string")))
           .when(order, csv_items(F.col("order_category_ids")))
           .otherwise(csv_items(F.col("pay_category_ids"))))
    classed = visits.select(action.alias("action"), ids.alias("ids"), *keep).filter(F.col("action").isNotNull())
    return classed.select(F.explode("ids").alias("category_id"), "action", *keep)


def category_action_counts(actions: DataFrame) -> DataFrame:
    return actions.groupBy("category_id", "action").agg(F.count(F.lit(1)).alias("action_count"))


def category_counts_wide(actions: DataFrame) -> DataFrame:
    """(category_id, click_count, order_count, pay_count); missing classes are 0.

    A single partial/final hash aggregate straight from the exploded actions.
    """
    def n(kind):
        return F.count(F.when(F.col("action") == kind, 1)).alias(f"{kind}_count")
    return actions.groupBy("category_id").agg(n(CLICK), n(ORDER), n(PAY))


def category_session_counts(visits: DataFrame) -> DataFrame:
    """(category_id, action, session_id, n): the one aggregate that R1 and R2 both follow from.

    Only clicks keep their session, so orders and payments add one row per
    category. Both results read the whole of it (no filter that could move
    below the aggregate), so the plan shuffles it once and reuses it.
    """
    session = F.when(F.col("action") == CLICK, F.col("session_id"))
    return (category_actions(visits, keep=("session_id",)).filter(F.col("category_id").isNotNull())
            .withColumn("session_id", session)
            .groupBy("category_id", "action", "session_id").agg(F.count(F.lit(1)).alias("n")))


def wide_from_counts(counts: DataFrame) -> DataFrame:
    """As :func:`category_counts_wide`, from :func:`category_session_counts`."""
    def n(kind):
        return F.coalesce(F.sum(F.when(F.col("action") == kind, F.col("n"))), F.lit(0)).alias(f"{kind}_count")
    return counts.groupBy("category_id").agg(n(CLICK), n(ORDER), n(PAY))


def session_clicks_from_counts(counts: DataFrame, top: DataFrame) -> DataFrame:
    """As :func:`category_session_clicks`, from :func:`category_session_counts`.

    An inner join: ``top`` holds a category once, and a semi join would move
    below the aggregate and scan the visits again.
    """
    clicks = F.sum(F.when(F.col("action") == CLICK, F.col("n"))).alias("click_count")
    return (counts.groupBy("category_id", "session_id").agg(clicks).filter("click_count > 0")
            .join(top.select("category_id"), "category_id"))


def top_categories(wide: DataFrame, task_id: str, k: int = TOP_CATEGORIES) -> DataFrame:
    """R1: first k by clicks, orders, payments (all desc), then category id.

    Planned as TakeOrderedAndProject: each task keeps its own k best rows.
    """
    return (wide.orderBy(F.col("click_count").desc(), F.col("order_count").desc(),
                         F.col("pay_count").desc(), F.col("category_id").asc())
            .limit(k)
            .select(F.lit(task_id).alias("task_id"), "category_id", "click_count",
                    "order_count", "pay_count"))


def category_session_clicks(visits: DataFrame, top: DataFrame) -> DataFrame:
    """Clicks per (category, session), for real clicks in the top categories.

    ``top`` is small as a rule; the planner picks the semi join from its size.
    """
    clicks = visits.filter(is_click()).select(
        F.col("click_category_id").cast("string").alias("category_id"), "session_id")
    return (clicks.join(top.select("category_id"), "category_id", "left_semi")
            .groupBy("category_id", "session_id").agg(F.count(F.lit(1)).alias("click_count")))


def top_sessions(session_clicks: DataFrame, task_id: str, k: int = TOP_SESSIONS) -> DataFrame:
    """R2: exactly min(k, n) sessions per category, by clicks desc then session id."""
    top = top_k(session_clicks, ["category_id"],
                [F.col("click_count").desc(), F.col("session_id").asc()], k)
    return top.select(F.lit(task_id).alias("task_id"), "category_id", "session_id", "click_count")
