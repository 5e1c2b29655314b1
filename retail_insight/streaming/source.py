"""Streaming sources of ad log lines: a Kafka topic or a folder of text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the reference deployment: topic and consumer group.
DEFAULT_TOPIC = "ads_log"
DEFAULT_GROUP = "commerce-consumer-group"


def kafka_lines(spark: SparkSession, bootstrap_servers: str, topic: str = DEFAULT_TOPIC,
                starting_offsets: str = "latest", **options: str) -> DataFrame:
    """Lines from Kafka. Offsets are tracked in the query checkpoint, not by
    consumer auto-commit, so a restart resumes exactly after the last batch;
    Spark names its consumer groups after the original group id. Needs the
    spark-sql-kafka package on the classpath."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets)
              .option("groupIdPrefix", DEFAULT_GROUP))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def text_lines(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines from text files landing in ``folder`` (oldest files first)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(folder)
