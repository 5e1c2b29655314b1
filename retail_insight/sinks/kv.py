"""Keyed upsert for micro-batch output (the hash-set sinks of R5 and R6).

``KeyedUpsertLog`` writes each micro-batch's updated keys to partition
``batch_id=N`` (overwrite, so a replay is idempotent); the current value of a
key is its row from the highest batch. Snapshots every C batches keep the
read of the current state bounded (see ``streaming.totals``). ``write_with``
lets a caller send rows to an external key-value store instead, one client
per partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..streaming.totals import BatchLog


class KeyedUpsertLog(BatchLog):
    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: Sequence[str],
                 snapshot_every: int = 25):
        super().__init__(spark, root, schema, keys, snapshot_every)

    def fold(self, rows: DataFrame) -> DataFrame:
        """Latest value per key (``max_by`` over the batch id: one pass, no sort)."""
        latest = F.max_by(F.struct(*self.values), "batch_id").alias("_v")
        return rows.groupBy(*self.keys).agg(latest).select(*self.keys, "_v.*")

    def upsert(self, updates: DataFrame, batch_id: int, min_day: str | None = None) -> None:
        self.write(updates, batch_id, min_day)

    def current(self, upto: int | None = None) -> DataFrame:
        """Current values as of batch ``upto``, by default of the last batch written."""
        return self.state(upto) if upto is not None else self.fold(self.read_latest())


def write_with(updates: DataFrame, client_factory: Callable[[], object],
               put: Callable[[object, Row], None]) -> None:
    """Send rows to an external store, one client per partition (executors)."""
    def run(rows: Iterable[Row]) -> None:
        client = client_factory()
        try:
            for row in rows:
                put(client, row)
        finally:
            close = getattr(client, "close", None)
            if close:
                close()
    updates.foreachPartition(run)
