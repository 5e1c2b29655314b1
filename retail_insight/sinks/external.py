"""Results in an external key-value store with hashes and sets.

A client has ``hset(key, fields)`` (fields: a dict of texts), ``sadd(key,
members)`` and, if it needs one, ``close()``. Each partition opens one client
on its executor and streams its rows; at most ``FIELDS_PER_CALL`` fields are
held before they are sent. Keys and counts are rendered as text. Every value
sent is a whole one, not an increment, so sending a batch again changes
nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

# Key names of the store.
USER_CLICKS_KEY = "user_ads_click:"
BLACKLIST_KEY = "blackList"
AREA_CITY_KEY = "date:area:city:ads"
TOP_ADS_KEY = "area_top3_ads:"
FIELDS_PER_CALL = 1000


def _with_client(client_factory: Callable[[], object], work: Callable[[object, Iterator[Row]], None]):
    def run(rows: Iterator[Row]) -> None:
        client = client_factory()
        try:
            work(client, rows)
        finally:
            close = getattr(client, "close", None)
            if close:
                close()
    return run


def write_hashes(fields: DataFrame, client_factory: Callable[[], object], *, per_call: int = FIELDS_PER_CALL) -> None:
    """Send rows (key, field, value), each key's rows of a partition together."""
    def work(client, rows):
        key, held = None, {}
        for row in rows:
            if held and (row.key != key or len(held) >= per_call):
                client.hset(key, held)
                held = {}
            key = row.key
            held[row.field] = row.value
        if held:
            client.hset(key, held)

    fields.select("key", "field", "value").sortWithinPartitions("key").foreachPartition(_with_client(client_factory, work))


def write_set(members: DataFrame, key: str, client_factory: Callable[[], object], *,
              per_call: int = FIELDS_PER_CALL) -> None:
    """Add the single column of ``members`` to one set."""
    def work(client, rows):
        held = []
        for row in rows:
            held.append(row[0])
            if len(held) >= per_call:
                client.sadd(key, held)
                held = []
        if held:
            client.sadd(key, held)

    members.foreachPartition(_with_client(client_factory, work))


def _text(column: str):
    return F.col(column).cast("string")


def send_user_clicks(clicks: DataFrame, client_factory: Callable[[], object]) -> None:
    """(day, user_id, ad_id, clicks): one hash a day, fields ``user_ad``."""
    write_hashes(clicks.select(F.concat(F.lit(USER_CLICKS_KEY), "day").alias("key"),
                               F.concat_ws("_", "user_id", "ad_id").alias("field"), _text("clicks").alias("value")),
                 client_factory)


def send_blacklist(listed: DataFrame, client_factory: Callable[[], object]) -> None:
    write_set(listed.select(_text("user_id")), BLACKLIST_KEY, client_factory)


def send_area_city_counts(counts: DataFrame, client_factory: Callable[[], object]) -> None:
    """(day, area, city, ad_id, clicks): one hash for all, fields ``day:area:city:ad``."""
    write_hashes(counts.select(F.lit(AREA_CITY_KEY).alias("key"),
                               F.concat_ws(":", "day", "area", "city", "ad_id").alias("field"),
                               _text("clicks").alias("value")), client_factory)


def send_top_ads(top: DataFrame, client_factory: Callable[[], object]) -> None:
    """(day, area, ads_json): one hash a day, sent in one call; a day has one field an area."""
    fields = top.select(F.concat(F.lit(TOP_ADS_KEY), "day").alias("key"), F.col("area").alias("field"),
                        F.col("ads_json").alias("value"))
    write_hashes(fields.repartition("key"), client_factory)
