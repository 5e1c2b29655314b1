"""Positions of rows inside their groups, however large one group is."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._stage import staged


def ranked(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` with ``pos``, the row's place (from 0) in its group under ``order``, and ``n``, the group's rows.

    The table is dealt by ranges of (group, order) and written, so a group
    of any size spreads over many parts; rows are numbered inside a part and
    the counts of the parts before are added. ``order`` must tell rows apart,
    or equal rows share a part. Nulls sort first; null groups are groups.
    """
    parts = staged(df.repartitionByRange(*group, *order).withColumn("part", F.spark_partition_id()), name)
    by_part = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = (parts.groupBy(*group, "part").agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("base", F.coalesce(F.sum("rows").over(by_part), F.lit(0)))
            .withColumn("n", F.sum("rows").over(Window.partitionBy(*group)))
            .select(*[F.col(c).alias(f"of_{c}") for c in group], F.col("part").alias("of_part"), "base", "n"))
    inside = Window.partitionBy(*group, "part").orderBy(*order)
    same = F.col("part") == F.col("of_part")
    for c in group:
        same &= F.col(c).eqNullSafe(F.col(f"of_{c}"))
    return (parts.withColumn("at", F.row_number().over(inside) - 1).join(base, same)
            .withColumn("pos", F.col("base") + F.col("at"))
            .select(*df.columns, "pos", "n"))
