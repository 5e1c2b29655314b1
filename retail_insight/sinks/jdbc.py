"""JDBC append for the batch results (R1, R2, R4 tables).

Spark's JDBC writer opens one connection per task and sends inserts in
batches of ``batchsize`` rows inside one transaction per partition, so no
rows pass through the driver. Credentials come from the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Result table names of the reference's MySQL schema.
CATEGORY_TOP10_TABLE = "category_top10"
CATEGORY_SESSIONS_TABLE = "category_top10_session_top10"
AREA_COUNT_TABLE = "area_count_info"


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 batch_size: int = 1000, driver: str | None = None,
                 num_partitions: int | None = None) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    return opts


def append_jdbc(df: DataFrame, url: str, table: str, **kwargs) -> None:
    """Append ``df`` to a JDBC table (created by Spark when missing)."""
    df.write.format("jdbc").options(**jdbc_options(url, table, **kwargs)).mode("append").save()
