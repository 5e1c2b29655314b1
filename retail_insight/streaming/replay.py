"""Drive a streaming query over a batch table, one landing step at a time.

The lines are staged once (partitioned by their arrival batch). For each
batch, its lines are appended to a landing folder as text, then the query
runs with ``availableNow`` from its checkpoint and stops. Every step is thus
a restart from the checkpoint, and each landed batch becomes exactly one
micro-batch, whatever the number of files a parallel write produced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .source import text_lines


def replay(spark: SparkSession, lines: DataFrame, n_batches: int, work: str,
           start: Callable[[DataFrame, str], StreamingQuery],
           steps: range | None = None, stream_spark: SparkSession | None = None) -> str:
    """``lines`` has ``value`` and ``batch_id``; ``start(stream, checkpoint)``
    starts the query with an availableNow trigger. The stream is read through
    ``stream_spark`` when given. Returns the landing folder."""
    staged, landing, checkpoint = f"{work}/staged", f"{work}/landing", f"{work}/checkpoint"
    if steps is None or steps.start == 0:
        lines.select("value", "batch_id").write.mode("overwrite").partitionBy("batch_id").parquet(staged)
    for i in steps or range(n_batches):
        step = spark.read.parquet(staged).filter(F.col("batch_id") == i).select("value")
        step.write.mode("append").text(landing)
        query = start(text_lines(stream_spark or spark, landing), checkpoint)
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    return landing
