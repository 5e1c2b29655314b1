"""Per-batch change partitions plus periodic snapshots, folded on read.

Layout under ``root``::

    delta/batch_id=N      the change of batch N
    snapshot/batch_id=S   the fold of all changes through batch S (S a multiple of C)

The state through batch N is the fold of snapshot S = (N // C) * C and the
deltas of batches S+1..N. Those partitions are read by explicit path
(micro-batch ids are consecutive), so a micro-batch lists and reads one
snapshot and at most C delta folders however long the stream has run;
nothing scans the whole table folder. Rewriting partition N (and snapshot N)
is how a replayed batch stays idempotent: the same input gives the same files.

``BatchTotals`` folds by sum or min (counters, first listing batch);
``sinks.kv.KeyedUpsertLog`` folds by latest value per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


class BatchLog:
    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: Sequence[str],
                 snapshot_every: int = 25):
        self.spark = spark
        self.root = root
        self.schema = schema
        self.keys = list(keys)
        self.values = [f for f in schema.fieldNames() if f not in self.keys]
        self.every = snapshot_every
        self.read_schema = StructType([*schema.fields, StructField("batch_id", LongType(), True)])

    def fold(self, rows: DataFrame) -> DataFrame:
        """Rows (keys, values, batch_id) -> one row per key (keys, values)."""
        raise NotImplementedError

    # -- layout -------------------------------------------------------------
    def _path(self, kind: str, batch_id: int) -> str:
        return f"{self.root}/{kind}/batch_id={batch_id}"

    def create(self):
        """Empty partition -1 in both folders, so the first reads find a table."""
        empty = self.spark.createDataFrame([], self.schema)
        for kind in ("delta", "snapshot"):
            empty.write.mode("overwrite").parquet(self._path(kind, -1))
        return self

    def read(self, kind: str, batch_ids) -> DataFrame:
        """The given partitions only (``batch_id`` stays a column)."""
        paths = [self._path(kind, b) for b in batch_ids]
        return (self.spark.read.schema(self.read_schema)
                .option("basePath", f"{self.root}/{kind}").parquet(*paths))

    def read_all(self) -> DataFrame:
        """Every delta partition: for audits, not for per-batch work."""
        return self.spark.read.schema(self.read_schema).parquet(f"{self.root}/delta")

    def _written(self, kind: str) -> list[int]:
        """Batch ids whose partition is complete."""
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{kind}")
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        done = fs.globStatus(jvm.org.apache.hadoop.fs.Path(folder, "batch_id=*/_SUCCESS"))
        return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in done)

    def read_latest(self) -> DataFrame:
        """The newest snapshot and the deltas after it: complete also where
        older partitions are retired."""
        snapshots = self._written("snapshot")
        newest = snapshots[-1] if snapshots else None
        deltas = [b for b in self._written("delta") if newest is None or b > newest]
        if newest is None:
            return self.read("delta", deltas)
        snap = self.read("snapshot", [newest])
        return snap.unionByName(self.read("delta", deltas)) if deltas else snap

    # -- reads --------------------------------------------------------------
    def _snapshot_before(self, batch_id: int) -> int:
        s = (batch_id // self.every) * self.every
        return s if s > 0 else -1

    def _combined(self, upto: int, snapshot: int) -> DataFrame:
        snap = self.read("snapshot", [snapshot])
        if upto <= snapshot:
            return snap
        return snap.unionByName(self.read("delta", range(snapshot + 1, upto + 1)))

    def state(self, upto: int, only: DataFrame | None = None, on: Sequence[str] | None = None) -> DataFrame:
        """State through batch ``upto``; ``only`` restricts to matching keys first."""
        rows = self._combined(upto, self._snapshot_before(upto))
        if only is not None:
            rows = rows.join(only, list(on or self.keys), "left_semi")
        return self.fold(rows)

    # -- writes -------------------------------------------------------------
    def write(self, delta: DataFrame, batch_id: int, min_day: str | None = None) -> None:
        """Write batch N's change; on snapshot batches also the folded state.

        ``min_day`` drops days before it from the snapshot (retention): the
        caller guarantees no later batch updates those days again.
        """
        delta.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(
            self._path("delta", batch_id))
        if batch_id > 0 and batch_id % self.every == 0:
            rows = self._combined(batch_id, self._snapshot_before(batch_id - 1))
            snapshot = self.fold(rows)
            if min_day is not None:
                snapshot = snapshot.filter(F.col("day") >= min_day)
            snapshot.write.mode("overwrite").parquet(self._path("snapshot", batch_id))


    def retire(self, committed: int) -> None:
        """Empty the partitions no read can need once batch ``committed`` is
        committed: the snapshot before the newest one and the deltas that
        the newest snapshot S covers (only batch ``committed + 1`` may still
        be replayed, and it reads snapshot S and later deltas).

        Acts once per snapshot period, when ``committed`` is the snapshot
        batch itself, through Spark's overwrite of each partition path. After
        retiring, read state with ``state(upto)``, not ``read_all``.
        """
        s = self._snapshot_before(committed)
        if s <= 0 or committed != s:
            return
        empty = self.spark.createDataFrame([], self.schema)
        if s - self.every > 0:
            empty.write.mode("overwrite").parquet(self._path("snapshot", s - self.every))
        first = s - self.every + 1 if s > self.every else 0   # the first snapshot covers delta 0 too
        for b in range(first, s + 1):
            empty.write.mode("overwrite").parquet(self._path("delta", b))


class BatchTotals(BatchLog):
    """Counters (sum) or first-seen markers (min) per key."""

    _AGGS = {"sum": F.sum, "min": F.min, "max": F.max}

    def __init__(self, spark: SparkSession, root: str, key_schema: StructType, value: str,
                 agg: str = "sum", snapshot_every: int = 25):
        schema = StructType([*key_schema.fields, StructField(value, LongType(), True)])
        super().__init__(spark, root, schema, key_schema.fieldNames(), snapshot_every)
        self.value = value
        self.agg = self._AGGS[agg]

    def fold(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(self.agg(self.value).cast("long").alias(self.value))

    def totals(self, upto: int, only: DataFrame | None = None, on: Sequence[str] | None = None) -> DataFrame:
        return self.state(upto, only, on)

    def write_delta(self, delta: DataFrame, batch_id: int, min_day: str | None = None) -> None:
        self.write(delta.withColumn(self.value, F.col(self.value).cast("long")), batch_id, min_day)
