"""Parsing of ad-click log lines ``ts_ms area city user_id ad_id``.

Works on a batch or a streaming DataFrame with a string ``value`` column.
A line needs at least five space-separated tokens, none of the first five
empty, and a first token that is a number of milliseconds in the years 0001 to
9999; tokens past the fifth are ignored. Lines failing that are not dropped
silently: ``parse_ad_log`` flags them and ``rejected_lines`` returns them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.days import day_of_epoch_ms

N_FIELDS = 5
# Epoch milliseconds of 0001-01-01 and of the last of 9999-12-31.
MIN_TS, MAX_TS = -62_135_596_800_000, 253_402_300_799_999
_TOKENS = "_tokens"


def _token(i: int) -> Column:
    return F.try_element_at(F.col(_TOKENS), F.lit(i + 1))


def parse_ad_log(lines: DataFrame, value_col: str = "value", tz: str = "UTC",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed ad log with an ``is_valid`` flag; ``keep`` columns pass through."""
    tokens = lines.select(*keep, F.col(value_col).alias("value"),
                          F.split(F.col(value_col), " ").alias(_TOKENS))
    number = _token(0).try_cast("long")
    ts = F.when(number.between(MIN_TS, MAX_TS), number)
    valid = ts.isNotNull()
    for i in range(1, N_FIELDS):
        valid &= F.length(_token(i)) > 0
    return tokens.select(
        *keep, "value",
        ts.alias("ts"),
        _token(1).alias("area"),
        _token(2).alias("city"),
        _token(3).alias("user_id"),
        _token(4).alias("ad_id"),
        day_of_epoch_ms(ts, tz).alias("day"),
        F.coalesce(valid, F.lit(False)).alias("is_valid"))


def accepted_lines(parsed: DataFrame) -> DataFrame:
    return parsed.filter("is_valid").drop("is_valid", "value")


def rejected_lines(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("is_valid")).select("value")
