"""Offline job: top-10 categories (R1), then top-10 sessions in them (R2).

R1 is written first and R2 reads the written top-10 back (at most 10 rows), so R2 never recomputes R1. Both
follow from one count per (category, action, session); only these counts are persisted, with
spill to disk, and they are rebuilt from lineage if an executor is lost.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import category
from ..operators.visits import filter_visits
from ..params import VisitFilter

Writer = Callable[[DataFrame, str], None]


@dataclass
class OfflineResult:
    task_id: str
    top_categories: DataFrame
    top_sessions: DataFrame


def run_offline(spark: SparkSession, visits: DataFrame, users: DataFrame, f: VisitFilter,
                write: Writer, read: Callable[[str], DataFrame], task_id: str | None = None,
                top_categories_table: str = "category_top10",
                top_sessions_table: str = "category_top10_session_top10") -> OfflineResult:
    """Compute and write R1 and R2.

    ``write(df, table)`` stores a result (JDBC append, table overwrite, ...);
    ``read(table)`` reads one back. The task id tags every row of the run.
    """
    task_id = task_id or str(uuid.uuid4())
    counts = category.category_session_counts(filter_visits(visits, users, f)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        top = category.top_categories(category.wide_from_counts(counts), task_id)
        write(top, top_categories_table)
        top_written = read(top_categories_table).filter(F.col("task_id") == task_id)
        sessions = category.top_sessions(category.session_clicks_from_counts(counts, top_written), task_id)
        write(sessions, top_sessions_table)
    finally:
        counts.unpersist()
    own = F.col("task_id") == task_id     # a table may hold other runs' rows
    return OfflineResult(task_id, read(top_categories_table).filter(own), read(top_sessions_table).filter(own))
