"""The real-time pipeline (R3 + R5 + R6) as one ``foreachBatch`` function.

Per micro-batch N, all in native Spark SQL:

1. parse the lines and land them in ``parsed/batch_id=N`` with a validity
   flag (bad lines are the side output) and a flag for users listed in
   batches < N, whose events are dropped;
2. add the batch's clicks per (day, user, ad) to the user counters; users
   whose counter for this batch's keys reaches the threshold are listed
   with batch N (they are filtered from batch N+1 on);
3. add the batch's clicks per (day, area, city, ad) to the area counters and
   upsert the new totals of the touched keys (R5);
4. recompute the top ads of every touched (day, area) and upsert their JSON
   (R6).

Every table is partitioned by batch id and written with overwrite of that
partition only, so re-running batch N after a failure rewrites the same
files: the sinks are idempotent and the stream checkpoint gives
exactly-once results.

Two opt-in settings bound a stream that runs for months:
``retain_days`` expires events older than the newest day seen minus N days
(they are not counted, but kept in ``expired()``) and drops those days from
snapshots; ``retire_old_partitions`` empties the
snapshot and delta partitions no read can need any more.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from .. import schemas
from ..operators import ads
from ..sinks import external
from ..sinks.kv import KeyedUpsertLog
from ..sources import adlog
from .totals import BatchTotals

_S = StringType()
USER_KEY = StructType([StructField(c, _S) for c in ("day", "user_id", "ad_id")])
AREA_KEY = StructType([StructField(c, _S) for c in ("day", "area", "city", "ad_id")])
LISTED_KEY = StructType([StructField("user_id", _S)])
R5_SCHEMA = StructType([*AREA_KEY.fields, StructField("clicks", LongType())])
R6_SCHEMA = StructType([StructField(c, _S) for c in ("day", "area", "ads_json")])


def _together(*steps: Callable[[], None]) -> None:
    """Run independent Spark actions from parallel driver threads; the
    scheduler interleaves their tasks. They keep the caller's job group. The first failure is raised."""
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        for future in [pool.submit(inheritable_thread_target(step)) for step in steps]:
            future.result()


@dataclass
class PipelineConfig:
    threshold: int = ads.DEFAULT_THRESHOLD
    top: int = ads.TOP_ADS
    tz: str = "UTC"
    snapshot_every: int = 25
    # None keeps every day's counters forever, as the reference does. With
    # N, an event whose day is more than N days before the newest day the
    # stream has seen is expired (set aside, not counted), and snapshots drop
    # those days, which no later event can update: state stays bounded.
    retain_days: int | None = None
    # A day moves that clock only once it has this many events, so that a few
    # rows with a wrong time cannot expire the real traffic.
    clock_events: int = 3
    # Makes the client of an external key-value store (``sinks.external``) on
    # an executor; each batch's changes are then sent there as well.
    client_factory: Callable[[], object] | None = None
    # Empty snapshot and delta partitions that no read can need any more
    # (see ``BatchLog.retire``): storage then stays about two snapshots
    # plus 2C deltas per table instead of growing with every snapshot.
    retire_old_partitions: bool = False


class RealtimePipeline:
    """State and sinks of the pipeline, all under one shared folder ``root``."""

    def __init__(self, spark: SparkSession, root: str, config: PipelineConfig | None = None):
        self.spark = spark
        self.root = root
        self.cfg = config or PipelineConfig()
        every = self.cfg.snapshot_every
        self.user_clicks = BatchTotals(spark, f"{root}/user_clicks", USER_KEY, "clicks", "sum", every)
        self.listed = BatchTotals(spark, f"{root}/blacklist", LISTED_KEY, "listed_batch", "min", every)
        self.area_clicks = BatchTotals(spark, f"{root}/area_clicks", AREA_KEY, "clicks", "sum", every)
        self.r5 = KeyedUpsertLog(spark, f"{root}/area_city_ad_totals", R5_SCHEMA,
                                 ["day", "area", "city", "ad_id"], every)
        self.r6 = KeyedUpsertLog(spark, f"{root}/area_top3_ads", R6_SCHEMA, ["day", "area"], every)
        # events per day, kept only with retention: one row a day
        self.clock = BatchTotals(spark, f"{root}/clock_days", StructType([StructField("day", _S)]),
                                 "events", "sum", every)
        self.expired_root = f"{root}/expired"
        self.parsed_root = f"{root}/parsed"
        self._parsed_schema = StructType([*schemas.AD_LOG.fields, StructField("value", _S),
                                          StructField("is_valid", BooleanType()),
                                          StructField("blocked", BooleanType())])

    def create(self) -> "RealtimePipeline":
        for t in self._logs():
            t.create()
        self.spark.createDataFrame([], self._parsed_schema).write.mode("overwrite").parquet(
            f"{self.parsed_root}/batch_id=-1")
        self.spark.createDataFrame([], schemas.AD_LOG).write.mode("overwrite").parquet(
            f"{self.expired_root}/batch_id=-1")
        return self

    # -- the micro-batch function -------------------------------------------
    def process(self, lines: DataFrame, batch_id: int) -> None:
        n = int(batch_id)
        # Land the batch once, parsed, with a validity flag and a flag for
        # users listed in earlier batches. Later steps read this table: no
        # cached shuffle output (Spark keeps 200 partitions for those), no
        # lineage back to the source, and bad lines are a filter on it.
        listed_before = self.listed.totals(n - 1).select(
            "user_id", F.lit(True).alias("blocked"))
        flagged = (adlog.parse_ad_log(lines, tz=self.cfg.tz)
                   .join(listed_before, "user_id", "left")
                   .withColumn("blocked", F.coalesce("blocked", F.lit(False))))
        flagged.write.mode("overwrite").parquet(f"{self.parsed_root}/batch_id={n}")
        landed = self.spark.read.schema(self._parsed_schema).parquet(f"{self.parsed_root}/batch_id={n}")
        ok = landed.filter(F.col("is_valid") & ~F.col("blocked")).drop("is_valid", "blocked", "value")
        min_day = None
        if self.cfg.retain_days is not None:
            min_day = self._advance_clock(ok, n)
            ok.filter(F.col("day") < min_day).select(*schemas.AD_LOG.fieldNames()).write.mode("overwrite").parquet(
                f"{self.expired_root}/batch_id={n}")
            ok = ok.filter(F.col("day") >= min_day)
        # The user counters and the area counters only share the landed
        # batch: their jobs are submitted side by side.
        _together(lambda: self._blacklist_step(ok, n, min_day), lambda: self._area_step(ok, n, min_day))
        if self.cfg.client_factory:
            self._send(n)
        if self.cfg.retire_old_partitions and n > 0:
            for t in self._logs():
                t.retire(n - 1)   # batch n - 1 is committed: n is running

    def _logs(self):
        return (self.user_clicks, self.listed, self.area_clicks, self.r5, self.r6, self.clock)

    def _advance_clock(self, ok: DataFrame, n: int) -> str:
        """Count the batch's events per day; return the oldest day still counted."""
        self.clock.write_delta(ok.groupBy("day").agg(F.count(F.lit(1)).alias("events")), n)
        newest = F.to_date(F.max(F.when(F.col("events") >= self.cfg.clock_events, F.col("day"))))
        oldest = F.date_format(F.date_sub(newest, self.cfg.retain_days), "yyyy-MM-dd")
        return self.clock.totals(n).agg(oldest.alias("day")).first().day or "0000-01-01"

    def _blacklist_step(self, ok: DataFrame, n: int, min_day: str | None = None) -> None:
        delta = ads.user_day_clicks(ok)
        self.user_clicks.write_delta(delta, n, min_day)
        touched = self.user_clicks.totals(n, only=self._delta_keys(self.user_clicks, n))
        crossing = (touched.filter(F.col("clicks") >= self.cfg.threshold)
                    .select("user_id").distinct().withColumn("listed_batch", F.lit(n).cast("long")))
        self.listed.write_delta(crossing, n)

    def _area_step(self, ok: DataFrame, n: int, min_day: str | None = None) -> None:
        self.area_clicks.write_delta(ads.area_city_counts(ok), n, min_day)
        keys = self._delta_keys(self.area_clicks, n)
        # Totals of every key in the touched (day, area) groups: R6 ranks
        # them, R5 upserts the touched subset. Each sink re-reads the bounded
        # state (one snapshot + at most C deltas) rather than caching it.
        groups = keys.select("day", "area").distinct()
        in_groups = self.area_clicks.totals(n, only=groups, on=["day", "area"])
        r5 = in_groups.join(keys, list(AREA_KEY.fieldNames()), "left_semi")
        r6 = ads.top_ads_json(ads.top_ads(ads.area_counts(in_groups), self.cfg.top))
        _together(lambda: self.r5.upsert(r5, n, min_day), lambda: self.r6.upsert(r6, n, min_day))

    def _send(self, n: int) -> None:
        """Batch N's changed totals to the external store. All are whole values, so a replay changes nothing."""
        client = self.cfg.client_factory
        clicks = self.user_clicks.totals(n, only=self._delta_keys(self.user_clicks, n))
        external.send_user_clicks(clicks, client)
        external.send_blacklist(self.listed.read("delta", [n]), client)
        external.send_area_city_counts(self.r5.read("delta", [n]), client)
        external.send_top_ads(self.r6.read("delta", [n]), client)

    @staticmethod
    def _delta_keys(totals: BatchTotals, n: int) -> DataFrame:
        """Keys changed by batch N, read back from the partition just written."""
        return totals.read("delta", [n]).select(*totals.keys)

    # -- results --------------------------------------------------------------
    def blacklist(self, upto: int) -> DataFrame:
        return self.listed.totals(upto)

    def area_totals(self, upto: int | None = None) -> DataFrame:
        return self.r5.current(upto)

    def top3_json(self, upto: int | None = None) -> DataFrame:
        return self.r6.current(upto)

    def rejected(self) -> DataFrame:
        """Lines set aside as unparseable, with the batch they came in."""
        schema = StructType([*self._parsed_schema.fields, StructField("batch_id", LongType())])
        landed = self.spark.read.schema(schema).parquet(self.parsed_root)
        return landed.filter(~F.col("is_valid")).select("value", "batch_id")

    def expired(self) -> DataFrame:
        """Events that retention left uncounted, with the batch they came in."""
        schema = StructType([*schemas.AD_LOG.fields, StructField("batch_id", LongType())])
        return self.spark.read.schema(schema).parquet(self.expired_root).filter("batch_id >= 0")

    def start(self, lines: DataFrame, checkpoint: str, trigger: dict | None = None):
        """Run on a streaming DataFrame of lines (``value`` column)."""
        writer = (lines.select("value").writeStream.foreachBatch(self.process)
                  .option("checkpointLocation", checkpoint))
        writer = writer.trigger(**(trigger or {"processingTime": "5 seconds"}))
        return writer.start()
