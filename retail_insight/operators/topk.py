"""Per-group top-k by window function.

A filter ``rank <= k`` / ``row_number <= k`` directly over the window lets
Spark plan a partial WindowGroupLimit before the shuffle, so each map task
ships at most k rows (plus ties for ``rank``) per group: a hot group costs no
more than a cold one downstream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
          with_ties: bool = False, rank_col: str = "rk", keep_rank: bool = False) -> DataFrame:
    """Rows ranked ``<= k`` within each group.

    ``with_ties=False`` (row_number) keeps exactly min(k, n) rows, so ``order``
    should end in a unique tie-break; ``with_ties=True`` (rank) keeps every row
    tied with the k-th.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    fn = F.rank() if with_ties else F.row_number()
    out = df.withColumn(rank_col, fn.over(w)).filter(F.col(rank_col) <= k)
    return out if keep_rank else out.drop(rank_col)
