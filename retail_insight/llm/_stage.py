"""Written intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import new_work_dir


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh shared folder and read back: cuts the lineage, survives lost executors."""
    path = new_work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
