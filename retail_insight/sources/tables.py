"""Batch table scans (catalog tables or parquet folders)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import schemas

CANONICAL = {
    "user_visit_action": schemas.USER_VISIT_ACTION,
    "user_info": schemas.USER_INFO,
    "product_info": schemas.PRODUCT_INFO,
    "city_info": schemas.CITY_INFO,
}


def read_table(spark: SparkSession, name: str, location: str | None = None) -> DataFrame:
    """A catalog table by name, or a parquet folder read with its fixed schema.

    The explicit schema skips footer-based inference; Catalyst still prunes
    columns and pushes filters into the scan.
    """
    if location is None:
        return spark.table(name)
    return spark.read.schema(CANONICAL[name]).parquet(location)


def register_views(tables: dict[str, DataFrame]) -> None:
    """Expose DataFrames as temp views for SQL users."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
