"""Table sinks: overwrite a catalog table or a parquet folder."""

from __future__ import annotations

from pyspark.sql import DataFrame


def overwrite_table(df: DataFrame, name: str | None = None, path: str | None = None,
                    partition_by: list[str] | None = None) -> None:
    """Replace a table's contents (catalog name, or parquet folder)."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name is not None:
        writer.saveAsTable(name)
    elif path is not None:
        writer.parquet(path)
    else:
        raise ValueError("need a table name or a path")
