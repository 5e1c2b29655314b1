"""Calendar day of an epoch-millisecond timestamp, with an explicit zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of_epoch_ms(ts_ms: Column, tz: str = "UTC") -> Column:
    """``yyyy-MM-dd`` of ``ts_ms`` in zone ``tz``, independent of the session zone.

    The value is built as a zone-less local time (TIMESTAMP_NTZ), shifted
    from UTC to ``tz`` when another zone is asked for, then cut to a date.
    """
    local = F.timestamp_add("MILLISECOND", ts_ms, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    if tz.upper() != "UTC":
        local = F.convert_timezone(F.lit("UTC"), F.lit(tz), local)
    return local.cast("date").cast("string")
