"""Id lists stored as comma-separated text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def csv_items(csv: Column) -> Column:
    """Array of the non-empty items of a CSV string (NULL / '' -> empty array).

    Repeated items stay repeated: ``3,3`` yields two items.
    """
    items = F.split(F.coalesce(csv, F.lit("")), ",")
    return F.filter(items, lambda x: F.length(x) > 0)


def has_items(csv: Column) -> Column:
    """True when the CSV is neither NULL nor empty (the reference's guard)."""
    return F.coalesce(F.length(csv) > 0, F.lit(False))
