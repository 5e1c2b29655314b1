"""Registered queries: (spark, sf_dir) -> DataFrame over the driver's tables.

Each key has a DuckDB twin in ``retail_insight.oracle.SQL`` unless noted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import oracle as P
from .operators import ads, area, category, visits
from .params import VisitFilter
from .plans.area_count import area_top3_sql
from .plans.offline import run_offline
from .session import new_work_dir, stream_session
from .sinks.kv import KeyedUpsertLog
from .sinks.tables import overwrite_table
from .sources import adlog
from .sources import testdata as td
from .sources.tables import register_views
from .streaming.pipeline import R5_SCHEMA, PipelineConfig, RealtimePipeline
from .streaming.replay import replay
from .streaming.running import running_area_city_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- R4 --------------------------------------------------------------------

def _t(spark, d, name):
    """A canonical input, stored once per application from the driver's tables."""
    return td.stored_table(spark, d, P.N_BATCHES, name)


def _actions(spark, d):
    return area.action_city(_t(spark, d, "user_visit_action"), _t(spark, d, "city_info"))


@register
def action_city(spark, d):
    return _actions(spark, d)


@register
def area_product_clicks(spark, d):
    return area.area_product_clicks(_actions(spark, d))


@register
def area_product_city_remark(spark, d):
    return area.area_product_city_remark(_actions(spark, d))


@register
def area_product_top3(spark, d):
    return area.area_product_top3(_actions(spark, d))


@register
def area_top3_products(spark, d):
    return area.area_top3_products(_t(spark, d, "user_visit_action"), _t(spark, d, "city_info"),
                                   _t(spark, d, "product_info"))


@register
def area_top3_products_sql(spark, d):
    """R4 as SQL text over temp views of the canonical tables."""
    register_views({n: _t(spark, d, n) for n in ("user_visit_action", "city_info", "product_info")})
    return area_top3_sql(spark)


# --- R1 / R2 ---------------------------------------------------------------

def _visits(spark, d, f=None):
    return visits.filter_visits(_t(spark, d, "user_visit_action"), _t(spark, d, "user_info"),
                                f or VisitFilter(P.START_DATE, P.END_DATE, P.START_AGE, P.END_AGE))


def _wide(spark, d):
    return category.category_counts_wide(category.category_actions(_visits(spark, d)))


@register
def visits_filtered(spark, d):
    return _visits(spark, d)


@register
def visits_filtered_open(spark, d):
    return _visits(spark, d, VisitFilter("", "", "", ""))


@register
def category_action_counts(spark, d):
    return category.category_action_counts(category.category_actions(_visits(spark, d)))


@register
def category_counts_wide(spark, d):
    return _wide(spark, d)


@register
def category_top10(spark, d):
    return category.top_categories(_wide(spark, d), P.TASK_ID)


@register
def category_session_clicks(spark, d):
    counts = category.category_session_counts(_visits(spark, d))
    top = category.top_categories(category.wide_from_counts(counts), P.TASK_ID)
    return category.session_clicks_from_counts(counts, top)


@register
def category_top10_sessions(spark, d):
    return category.top_sessions(category_session_clicks(spark, d), P.TASK_ID)


@register
def offline_job_sessions(spark, d):
    """The offline job end to end: R1 written, read back, R2 written."""
    work = new_work_dir(spark, "offline")
    result = run_offline(
        spark, _t(spark, d, "user_visit_action"), _t(spark, d, "user_info"),
        VisitFilter(P.START_DATE, P.END_DATE, P.START_AGE, P.END_AGE),
        write=lambda df, table: overwrite_table(df, path=f"{work}/{table}"),
        read=lambda table: spark.read.parquet(f"{work}/{table}"),
        task_id=P.TASK_ID)
    return result.top_sessions


# --- R3 / R5 / R6, batch form ---------------------------------------------

def _ads(spark, d):
    """Parsed ad log with the micro-batch of arrival."""
    lines = _t(spark, d, "ad_log_lines")
    return adlog.accepted_lines(adlog.parse_ad_log(lines, keep=("event_id", "batch_id")))


def _accepted(spark, d):
    a = _ads(spark, d)
    return ads.accepted(a, ads.blacklist(a, P.THRESHOLD))


@register
def ad_log_parsed(spark, d):
    return _ads(spark, d)


@register
def ad_clicks_user_day(spark, d):
    return ads.user_day_clicks(_ads(spark, d))


@register
def blacklist_users(spark, d):
    return ads.blacklist(_ads(spark, d), P.THRESHOLD)


@register
def ad_log_accepted(spark, d):
    return _accepted(spark, d)


@register
def area_city_ad_counts(spark, d):
    return ads.accepted_counts(_ads(spark, d), P.THRESHOLD)


@register
def area_ad_counts(spark, d):
    return ads.area_counts(area_city_ad_counts(spark, d))


@register
def area_top3_ads(spark, d):
    return ads.top_ads(area_ad_counts(spark, d))


@register
def area_top3_ads_json(spark, d):
    return ads.top_ads_json(area_top3_ads(spark, d))


# --- streams ---------------------------------------------------------------
# A stream run writes its tables under the shared folder; the queries below
# return the resulting tables. One run per (application, sf_dir) serves all
# keys that read it.

_RUNS: dict[tuple, object] = {}


def _run_key(spark, d, name):
    return (spark.sparkContext.applicationId, d, name)


def _pipeline(spark, d) -> RealtimePipeline:
    key = _run_key(spark, d, "pipeline")
    if key not in _RUNS:
        work = new_work_dir(spark, "realtime")
        pipe = RealtimePipeline(spark, f"{work}/tables", PipelineConfig(threshold=P.THRESHOLD)).create()
        lines = _t(spark, d, "ad_log_lines")
        replay(spark, lines, P.N_BATCHES, f"{work}/feed",
               lambda stream, ckpt: pipe.start(stream, ckpt, {"availableNow": True}))
        _RUNS[key] = pipe
    return _RUNS[key]


@register
def stream_realtime_pipeline(spark, d):
    """R5 totals after the stream with blacklist feedback."""
    return _pipeline(spark, d).area_totals(P.N_BATCHES - 1)


@register
def stream_blacklist_users(spark, d):
    return _pipeline(spark, d).blacklist(P.N_BATCHES - 1)


@register
def stream_area_top3_ads_json(spark, d):
    return _pipeline(spark, d).top3_json(P.N_BATCHES - 1)


@register
def stream_area_city_ad_counts(spark, d):
    """Running totals in Spark's state store, over the whole ad log."""
    key = _run_key(spark, d, "running")
    if key not in _RUNS:
        work = new_work_dir(spark, "running")
        sink = KeyedUpsertLog(spark, f"{work}/totals", R5_SCHEMA, ["day", "area", "city", "ad_id"]).create()
        lines = _t(spark, d, "ad_log_lines")
        replay(spark, lines, P.N_BATCHES, f"{work}/feed",
               lambda stream, ckpt: running_area_city_counts(stream, sink, ckpt, {"availableNow": True}),
               stream_spark=stream_session(spark))
        _RUNS[key] = sink
    return _RUNS[key].current(P.N_BATCHES - 1)


# --- sinks -----------------------------------------------------------------

@register
def table_overwrite(spark, d):
    """R4 written twice with overwrite, read back: one copy remains."""
    path = f"{new_work_dir(spark, 'table')}/area_count_info"
    result = area_top3_products(spark, d)
    overwrite_table(result, path=path)
    overwrite_table(result, path=path)
    return spark.read.parquet(path)


@register
def kv_upsert(spark, d):
    """R5 running totals upserted batch by batch, as a stream's sink sees them.

    The totals of every key changed in batch b, through batch b, come from one
    window over per-batch counts and are stored once; each upsert then reads
    its batch's rows. The current value of every key must be its final total.
    """
    work = new_work_dir(spark, "kv")
    keys = ["day", "area", "city", "ad_id"]
    per_batch = ads.accepted_counts(_ads(spark, d), P.THRESHOLD, by=("batch_id",))
    running = F.sum("clicks").over(Window.partitionBy(*keys).orderBy("batch_id"))
    per_batch.select("batch_id", *keys, running.cast("long").alias("clicks")).write.parquet(f"{work}/changes")
    changes = spark.read.parquet(f"{work}/changes")
    sink = KeyedUpsertLog(spark, f"{work}/r5", R5_SCHEMA, keys).create()
    for b in range(P.N_BATCHES):
        sink.upsert(changes.filter(F.col("batch_id") == b), b)
    return sink.current(P.N_BATCHES - 1)
