"""Visit log filtered by date and user age (R1/R2 input)."""

from __future__ import annotations

import operator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import VisitFilter

_OPS = {">=": operator.ge, "<=": operator.le}


def filter_visits(visits: DataFrame, users: DataFrame, f: VisitFilter) -> DataFrame:
    """All visit columns of visits whose user matches; inclusive bounds.

    An inner join, so a user listed twice yields the visit twice. Date bounds
    apply to the visit side and age bounds to the user side before the join,
    so both reach their parquet scans as pushed filters.
    """
    v, u = visits.alias("v"), users.select("user_id", "age").alias("u")
    for col, op, value in f.bounds():
        if col == "date":
            v = v.filter(_OPS[op](F.col("date"), F.lit(value)))
        else:
            u = u.filter(_OPS[op](F.col("age"), F.lit(value)))
    return v.join(u, F.col("v.user_id") == F.col("u.user_id")).select("v.*")
