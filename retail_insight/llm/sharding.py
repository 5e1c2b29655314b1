"""Minimax contiguous sharding of atomic groups.

Equal texts form one group; groups stand in the order of a 64-bit hash of
their text. The smallest shard capacity for which a greedy sweep needs no more
than the wanted number of shards is found by binary search, and the sweep's
cuts are the shards' bounds.

The driver never holds the groups. It sees group sizes summed over ranges of
the hash order, and bounds the sweep from below and above: a cut inside a
range of several groups is known only as far as that range. As long as the
bounds leave several capacities open, the ranges where a cut may fall (a few
for each shard) are split further by one more aggregation.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._stage import staged
from ._text import pick

SHARDS = 16
FIRST_BITS = 10      # ranges of the first aggregation: 2 ** FIRST_BITS
STEP_BITS = 6        # a range is split into 2 ** STEP_BITS
ROWS_PER_BUCKET = 20_000
_HASH_BITS = 64


class _Ranges:
    """Ordered ranges (first hash, bits, groups, size) with running sizes."""

    def __init__(self, rows: list[tuple[int, int, int, int]]):
        self.rows = sorted(rows)
        self.ends, total = [], 0
        for _, _, _, size in self.rows:
            total += size
            self.ends.append(total)
        self.total = total

    def cut(self, start: int, capacity: int, optimist: bool) -> int:
        """Where the sweep that begins at ``start`` cuts: the last end within
        capacity, or as far as a range of several groups may allow."""
        limit = start + capacity
        i = bisect_right(self.ends, limit)
        known = self.ends[i - 1] if i else 0
        if optimist and i < len(self.rows) and self.rows[i][2] > 1:
            return max(known, start, limit)
        return max(known, start)

    def sweep(self, capacity: int, shards: int, optimist: bool) -> list[int] | None:
        """Cuts of the sweep, or None if it needs more shards."""
        at, cuts = 0, []
        for _ in range(shards):
            if at >= self.total:
                break
            nxt = self.cut(at, capacity, optimist)
            if nxt == at:
                return None
            cuts.append(at := nxt)
        return cuts if at >= self.total else None

    def least(self, shards: int, optimist: bool, low: int, high: int) -> int:
        """Binary search for the smallest capacity with a sweep of ``shards``."""
        while low < high:
            mid = (low + high) // 2
            if self.sweep(mid, shards, optimist) is None:
                low = mid + 1
            else:
                high = mid
        return low


def _aggregate(groups: DataFrame, bits: int) -> list[tuple[int, int, int, int]]:
    first = F.shiftleft(F.shiftright("h", _HASH_BITS - bits), _HASH_BITS - bits)
    rows = (groups.groupBy(first.alias("first"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"),
                 F.min("h").alias("least")).collect())
    return [((r["least"] if r["n"] == 1 else r["first"]), bits, r["n"], int(r["size"])) for r in rows]


def minimax_bounds(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """Least capacity, and the first hash of each shard but the first.

    ``groups``: columns h (long, distinct) and size (long, positive).
    """
    rows = _aggregate(groups, FIRST_BITS)
    if not rows:
        return 0, []
    while True:
        ranges = _Ranges(rows)
        whole = sorted((s for _, _, n, s in rows if n == 1), reverse=True)
        low = max(-(-ranges.total // shards), whole[0] if whole else 1)
        least = ranges.least(shards, True, low, ranges.total)
        most = ranges.least(shards, False, least, ranges.total)
        # The pessimist's sweep is real; at equal bounds it is the optimum,
        # and only its own cuts must be exact: they end whole ranges.
        if least == most:
            cuts = ranges.sweep(most, shards, False)
            firsts = [ranges.rows[bisect_right(ranges.ends, c)][0] for c in cuts[:-1]]
            return most, firsts
        early, late = ranges.sweep(most, shards, False), ranges.sweep(most, shards, True)
        slow = _unbounded(ranges, least, shards, False)
        wanted = set()
        for k in range(shards):
            lo = slow[k] if k < len(slow) else ranges.total
            hi = max(late[k] if k < len(late) else ranges.total, early[k] if k < len(early) else ranges.total)
            i, j = bisect_right(ranges.ends, lo), min(bisect_right(ranges.ends, hi), len(ranges.rows) - 1)
            wanted.update(x for x in range(i, j + 1) if ranges.rows[x][2] > 1)
        if not wanted:      # no open range is near a cut: split them all
            wanted = {x for x, r in enumerate(ranges.rows) if r[2] > 1}
        rows = [r for x, r in enumerate(ranges.rows) if x not in wanted]
        by_bits: dict[int, list[int]] = {}
        for x in wanted:
            by_bits.setdefault(ranges.rows[x][1], []).append(ranges.rows[x][0])
        for bits, firsts in by_bits.items():
            prefix = F.shiftleft(F.shiftright("h", _HASH_BITS - bits), _HASH_BITS - bits)
            rows += _aggregate(groups.filter(prefix.isin(firsts)), min(bits + STEP_BITS, _HASH_BITS))


def _unbounded(ranges: _Ranges, capacity: int, shards: int, optimist: bool) -> list[int]:
    """The first cuts of a sweep that may need more shards."""
    at, cuts = 0, []
    for _ in range(shards):
        nxt = ranges.cut(at, capacity, optimist)
        cuts.append(at := nxt)
    return cuts


def shard(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """Every row of ``docs`` with its shard and its place there.

    size is the text's UTF-8 bytes plus 1; a null text counts as empty and
    shares the group of empty texts. Equal texts share a shard. slot counts
    the rows of a shard from 0 without gaps; equal rows take different slots.
    An empty table gives no rows. Other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = staged(pick(docs, id=id_col, text=text_col).select(
        "id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("h")), "sharding")
    groups = rows.groupBy("h").agg(F.sum("size").alias("size"))
    groups = staged(groups, "shard-groups")
    _, firsts = minimax_bounds(groups, shards)
    number = F.lit(0)
    for first in firsts:
        number = number + (F.col("h") >= F.lit(first)).cast("int")
    # Slots: number the rows inside hashed buckets of a shard, then add the
    # sizes of the buckets before. A bucket holds some thousand rows however
    # many rows share a text; the running sum is over bucket counts only.
    buckets = max(1, rows.count() // ROWS_PER_BUCKET)
    placed = (rows.withColumn("shard", number)
              .withColumn("bucket", F.pmod(F.xxhash64("id", "h"), F.lit(buckets)).cast("int")))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = (placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    inside = Window.partitionBy("shard", "bucket").orderBy("id", "h")
    return (placed.withColumn("at", F.row_number().over(inside) - 1)
            .join(counts, ["shard", "bucket"])
            .select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("base") + F.col("at")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
