"""Real-time job: ad log stream -> blacklist, running totals, top ads."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..session import durable_root
from ..streaming.pipeline import PipelineConfig, RealtimePipeline
from ..streaming.source import DEFAULT_TOPIC, kafka_lines, text_lines


def start_realtime(spark: SparkSession, *, bootstrap_servers: str | None = None,
                   folder: str | None = None, name: str = "realtime",
                   topic: str = DEFAULT_TOPIC, starting_offsets: str = "latest",
                   kafka_options: dict[str, str] | None = None,
                   config: PipelineConfig | None = None,
                   trigger: dict | None = None) -> tuple[RealtimePipeline, StreamingQuery]:
    """Start the pipeline on Kafka (``bootstrap_servers``) or a text folder.

    Tables and the checkpoint live under the cluster's shared folder
    (``spark.checkpoint.dir`` itself, not the per-application subfolder) and
    keep their names across restarts, so a restarted job, which is a new
    application, resumes from its checkpoint.
    """
    root = f"{durable_root(spark)}/retail_insight/{name}"
    # A long-running job keeps storage bounded unless told otherwise.
    pipe = RealtimePipeline(spark, f"{root}/tables", config or PipelineConfig(retire_old_partitions=True))
    pipe.create()   # writes empty first partitions only: safe to repeat, also after a crash half way
    lines = (kafka_lines(spark, bootstrap_servers, topic, starting_offsets, **(kafka_options or {}))
             if bootstrap_servers else text_lines(spark, folder))
    return pipe, pipe.start(lines, f"{root}/checkpoint", trigger)
