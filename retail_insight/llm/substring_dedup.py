"""Exact substring dedup by a sparse suffix sort with hash comparisons.

Every window of LENGTH bytes has an anchor: the byte gram in it that comes
first in one order of all grams (grams of frequent cells last, then by hash).
Equal windows have equal anchors at equal places, so it is enough to compare
suffixes that start at anchors. An anchor's context is the union of the
windows it stands for. Equal contexts are settled by their first occurrence;
where one gram has several contexts, their bytes are fetched and sorted, to
the right of the anchor and, reversed, to the left of it, by a merge sort whose
comparisons find the common extension by binary search over prefix polynomial
hashes. Neighbours' extensions are then checked byte by byte, and windows are
equal exactly if they share a class in both sorts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as tx
from ._sketch import cells, frequent_cells
from ._stage import staged

LENGTH = 100
GRAM = 32
SALTS = 64
ROWS_PER_PARTITION = 500_000
CHUNK = 20_000          # contexts sorted at a time; one gram's contexts stay together
_WIDE = 64              # grams that a context's hash is made of
_HASH_BASE = np.uint64(0xD6E8FEB86659FD93)
_ANCHOR = "g long, ctx long, salt int, id long, t long, lo int, off short, len short"


def _grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Polynomial hashes of the 32 and the 64 bytes from each place, by doubling."""
    h, size, base = tx.BYTE_CODE[data], 1, int(_HASH_BASE)
    narrow = None
    while size < _WIDE:
        if size == GRAM:
            narrow = h
        h = h[:len(h) - size] * np.uint64(base) + h[size:] if len(h) > size else h[:0]
        base = base * base % 2**64
        size *= 2
    return tx.mix(narrow), h


def anchors(block: tx.Block, hot: np.ndarray) -> dict[str, np.ndarray]:
    """Each anchor's gram, context hash, text, first window, place and context length."""
    data, offsets = block.data, block.offsets
    gram, wide = _grams(data)
    width = LENGTH - GRAM + 1
    if len(data) < LENGTH:
        none = np.zeros(0, np.int64)
        return {k: none for k in ("g", "ctx", "doc", "lo", "off", "len", "hot")}
    often = hot[cells(gram)]
    rank = (gram >> np.uint64(1)) | (often.astype(np.uint64) << np.uint64(63))
    best = np.arange(len(rank))
    size = 1
    while 2 * size <= width:
        a, b = best[:len(best) - size], best[size:]
        best = np.where(rank[a] <= rank[b], a, b)
        size *= 2
    a, b = best[:len(data) - LENGTH + 1], best[width - size:][:len(data) - LENGTH + 1]
    best = np.where(rank[a] <= rank[b], a, b)
    start = np.arange(len(best))
    doc = np.searchsorted(offsets, start, "right") - 1
    inside = start + LENGTH <= offsets[doc + 1]
    start, doc, best = start[inside], doc[inside], best[inside]
    new = np.ones(len(start), bool)
    new[1:] = (best[1:] != best[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(start)]]) - 1 if len(first) else first
    lo, end, doc, best = start[first], start[last] + LENGTH, doc[first], best[first]
    mid = np.minimum(lo + _WIDE, end - _WIDE)
    ctx = tx.mix(wide[lo] * np.uint64(0x9E3779B97F4A7C15) + wide[mid] * np.uint64(0xC2B2AE3D27D4EB4F)
                 + wide[end - _WIDE] + ((best - lo) * 512 + end - lo).astype(np.uint64))
    return {"g": gram[best].view(np.int64), "ctx": ctx.view(np.int64), "doc": doc, "lo": lo - offsets[doc],
            "off": best - lo, "len": end - lo, "hot": often[best]}


def _anchor_rows(source: DataFrame, hot) -> DataFrame:
    def run(block: tx.Block):
        a = anchors(block, hot.value)
        ids = block.column("id").to_numpy()[a["doc"]]
        return tx.record_batch(g=a["g"], ctx=a["ctx"], salt=np.where(a["hot"].astype(bool), 1 + ids % SALTS, 0).astype(np.int32),
                               id=ids, t=block.column("t").to_numpy()[a["doc"]], lo=a["lo"].astype(np.int32),
                               off=a["off"].astype(np.int16), len=a["len"].astype(np.int16))

    return tx.map_blocks(source, "text", run, _ANCHOR)


def _settle(rows: DataFrame, partitions: int) -> DataFrame:
    """kind 0: contexts that occur earlier; 1: first contexts of a gram that has
    several; 2: first contexts of frequent grams within a salt."""

    def run(batches):
        got = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if not got:
            return
        table = pa.concat_tables(got)
        g, ctx, salt, ids, lo = (table.column(c).to_numpy() for c in ("g", "ctx", "salt", "id", "lo"))
        order = np.lexsort((lo, ids, ctx, salt, g))
        g, ctx, salt, ids, lo = g[order], ctx[order], salt[order], ids[order], lo[order]
        new_g = np.ones(len(g), bool)
        new_g[1:] = (g[1:] != g[:-1]) | (salt[1:] != salt[:-1])
        new_c = new_g.copy()
        new_c[1:] |= ctx[1:] != ctx[:-1]
        first = np.maximum.accumulate(np.where(new_c, np.arange(len(g)), 0))
        earlier = (ids != ids[first]) | (lo != lo[first])       # rows of one place are no copies
        group = np.cumsum(new_g) - 1
        several = np.bincount(group, weights=new_c)[group] > 1
        kind = np.where(earlier, 0, np.where(salt > 0, 2, np.where(new_c & several, 1, -1)))
        keep = (kind >= 0) & (new_c | earlier | (salt == 0))
        out = table.take(pa.array(order[keep])).append_column("kind", pa.array(kind[keep].astype(np.int32)))
        yield from out.to_batches(max_chunksize=50_000)

    return staged(rows.repartition(partitions, "g", "salt").mapInArrow(run, _ANCHOR + ", kind int"), "substring-anchors")


class Suffixes:
    """Byte rows with prefix polynomial hashes; compared by their longest common extension."""

    def __init__(self, rows: np.ndarray, length: np.ndarray):
        self.rows, self.length = rows, length
        self.prefix = np.zeros((rows.shape[0], rows.shape[1] + 1), np.uint64)
        for j in range(rows.shape[1]):
            self.prefix[:, j + 1] = self.prefix[:, j] * _HASH_BASE + tx.BYTE_CODE[rows[:, j]]

    def extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Longest common prefix of rows x and y by binary search over prefix hashes."""
        low, high = np.zeros(len(x), np.int64), np.minimum(self.length[x], self.length[y])
        while (open_ := low < high).any():
            mid = (low + high + 1) // 2
            same = self.prefix[x, mid] == self.prefix[y, mid]
            low = np.where(open_ & same, mid, low)
            high = np.where(open_ & ~same, mid - 1, high)
        return low

    def before(self, x: np.ndarray, y: np.ndarray, equal: np.ndarray) -> np.ndarray:
        """Is row x before row y (or, where ``equal``, the same)?"""
        at = self.extension(x, y)
        at_x, at_y = at >= self.length[x], at >= self.length[y]
        inner = np.minimum(at, self.rows.shape[1] - 1)
        return np.where(at_x | at_y, np.where(at_x & at_y, equal, at_x), self.rows[x, inner] < self.rows[y, inner])

    def sort(self, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Rows of each group (its first row and size, for every row) in order: a
        bottom-up merge sort, each row finding its place in the partner run by binary search."""
        n = len(self.length)
        order, at = np.arange(n), np.arange(n)
        inside, end, w = at - first, first + size, 1
        while n and w < int(size.max()):
            run = inside // w
            begin = np.minimum(first + (run ^ 1) * w, end)
            low, high = begin.copy(), np.minimum(begin + w, end)
            right = (run & 1) == 1
            while (open_ := np.flatnonzero(low < high)).size:
                mid = (low[open_] + high[open_]) // 2
                less = self.before(order[mid], order[open_], right[open_])
                low[open_] = np.where(less, mid + 1, low[open_])
                high[open_] = np.where(less, high[open_], mid)
            place = first + (run // 2) * 2 * w + (inside - run * w) + (low - begin)
            merged = np.empty_like(order)
            merged[place] = order
            order = merged
            w *= 2
        return order

    def ranked(self, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order of :meth:`sort` and its :meth:`neighbours`. Where bytes show that two
        hashes were equal by chance, the rows are sorted by their bytes instead."""
        order = self.sort(first, size)
        common, sound = self.neighbours(order, first)
        if not sound:
            order = np.lexsort((self.length, *self.rows.T[::-1], first))
            common, _ = self.neighbours(order, first)
        return order, common

    def neighbours(self, order: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, bool]:
        """Common prefix of each row in order with the one before it (-1 at a
        group's first), by bytes; and whether the hashes give the same and the order is right."""
        out = np.full(len(order), -1, np.int64)
        k = np.flatnonzero(first != np.arange(len(order)))
        x, y = order[k], order[k - 1]
        by_hash = self.extension(x, y)
        differ = self.rows[x] != self.rows[y]
        true = np.where(differ.any(1), differ.argmax(1), self.rows.shape[1])
        true = np.minimum(true, np.minimum(self.length[x], self.length[y]))
        out[k] = true
        inner = np.minimum(true, self.rows.shape[1] - 1)
        ends = true >= np.minimum(self.length[x], self.length[y])
        after = np.where(ends, self.length[y] <= self.length[x], self.rows[y, inner] < self.rows[x, inner])
        return out, bool((by_hash == true).all() and after.all())


def repeated_windows(g, ids, pos, off, length, contexts: list[bytes]) -> list[np.ndarray]:
    """Windows of contexts that occur earlier: (context, first window, end of the last) of each run.
    ``pos``: place of the anchor in its text; rows of one g are compared."""
    order = np.lexsort((pos, ids, g))
    g, ids, pos, off, length = g[order], ids[order], pos[order], off[order].astype(np.int64), length[order].astype(np.int64)
    n = len(g)
    flat = np.frombuffer(b"".join([contexts[i] for i in order]), np.uint8)
    base = np.cumsum(length) - length
    right_len = length - off
    def matrix(width, size, step):  # bytes from the anchor on, or backwards before it
        cols = np.arange(width)
        have = cols[None, :] < size[:, None]
        index = (base + off)[:, None] + (cols if step > 0 else -1 - cols)[None, :]
        return np.where(have, flat[np.clip(index, 0, max(len(flat) - 1, 0))], 0).astype(np.uint8)

    new = np.ones(n, bool)
    new[1:] = g[1:] != g[:-1]
    starts = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    first, size = starts[group], np.bincount(group)[group]
    right = Suffixes(matrix(LENGTH, right_len, 1), np.minimum(right_len, LENGTH))
    left = Suffixes(matrix(LENGTH - GRAM, off, -1), off)
    classes = []
    for s in (right, left):
        classes.append(s.ranked(first, size))
    repeat = np.zeros((n, LENGTH - GRAM + 1), bool)         # by bytes before the anchor
    for o in range(LENGTH - GRAM + 1):
        who = np.flatnonzero((o <= off) & (o >= off - (length - LENGTH)))
        if not len(who):
            continue
        key = np.zeros(n, np.int64)
        for (by, common), need in zip(classes, (LENGTH - o, o)):
            cls = np.empty(n, np.int64)
            cls[by] = np.cumsum(common < need)
            key = key * (n + 1) + cls
        _, one, inverse = np.unique(key[who], return_index=True, return_inverse=True)
        lead = who[one[inverse]]
        repeat[who, o] = (ids[lead] != ids[who]) | (pos[lead] != pos[who])
    runs = np.zeros((n, repeat.shape[1] + 2), np.int8)
    runs[:, 1:-1] = repeat[:, ::-1]                         # by start of the window
    step = np.diff(runs, axis=1)
    row, begin = np.nonzero(step == 1)
    _, stop = np.nonzero(step == -1)
    top = LENGTH - GRAM
    lo = pos[row] - (top - begin)
    hi = pos[row] - (top - (stop - 1)) + LENGTH
    return [order[row], lo, hi]


def _compare_contexts(requests: DataFrame, source: DataFrame, partitions: int) -> DataFrame:
    """Covered intervals (id, t, lo, hi) among first contexts that share a gram."""
    wanted = requests.groupBy("id", "t").agg(F.collect_list(F.struct("g", "lo", "off", "len")).alias("a"))

    def cut(batches):
        for batch in batches:
            for block in tx.blocks(batch, "text"):
                lists = block.column("a")
                parts = lists.flatten()
                g, lo, off, length = (parts.field(i).to_numpy() for i in range(4))
                n = np.diff(lists.offsets.to_numpy())
                doc = np.repeat(np.arange(block.n), n)
                at = block.offsets[doc] + lo
                raw = block.data.tobytes()
                yield tx.record_batch(g=g, id=block.column("id").to_numpy()[doc], t=block.column("t").to_numpy()[doc],
                                      pos=(lo + off).astype(np.int32), off=off, len=length,
                                      bytes=pa.array([raw[i:j] for i, j in zip(at.tolist(), (at + length).tolist())], pa.binary()))

    def run(batches):
        got = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if not got:
            return
        table = pa.concat_tables(got)
        table = table.take(pa.array(np.argsort(table.column("g").to_numpy(), kind="stable")))
        g = table.column("g").to_numpy()
        lo = 0
        while lo < len(g):
            hi = int(np.searchsorted(g, g[min(lo + CHUNK, len(g)) - 1], "right"))
            part = table.slice(lo, hi - lo)
            col = lambda c: part.column(c).to_numpy()
            which, a, b = repeated_windows(col("g"), col("id"), col("pos").astype(np.int64), col("off"), col("len"),
                                           part.column("bytes").to_pylist())
            yield tx.record_batch(id=col("id")[which], t=col("t")[which], lo=a.astype(np.int32), hi=b.astype(np.int32))
            lo = hi

    rows = source.join(wanted, ["id", "t"]).mapInArrow(
        cut, "g long, id long, t long, pos int, off short, len short, bytes binary")
    return rows.repartition(partitions, "g").mapInArrow(run, "id long, t long, lo int, hi int")


def _covered(source: DataFrame) -> DataFrame:
    """Covered intervals of every text that has any: (id, t, spans)."""
    spark = source.sparkSession
    hot = spark.sparkContext.broadcast(frequent_cells(source, "text", lambda block: _grams(block.data)[0]))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(size) // 33 // ROWS_PER_PARTITION)
    found = _settle(_anchor_rows(source, hot), partitions)
    interval = ("id", "t", "lo", (F.col("lo") + F.col("len")).alias("hi"))
    covered = found.filter("kind = 0").select(*interval)
    # frequent grams: the salts' firsts meet
    often = found.filter("kind = 2")
    place = F.struct("id", "lo")
    firsts = often.groupBy("g", "ctx").agg(F.min(place).alias("first"))
    often = staged(often.join(firsts, ["g", "ctx"]), "substring-frequent")
    covered = covered.unionByName(often.filter(place != F.col("first")).select(*interval))
    leads = often.filter(place == F.col("first")).select("g", "ctx", "id", "t", "lo", "off", "len")
    several = (leads.select("g", "ctx").distinct().groupBy("g").count().filter("count > 1").select("g"))
    requests = (found.filter("kind = 1").select("g", "ctx", "id", "t", "lo", "off", "len")
                .unionByName(leads.join(several, "g", "left_semi").select("g", "ctx", "id", "t", "lo", "off", "len")))
    covered = covered.unionByName(_compare_contexts(requests, source, partitions))
    return staged(covered.groupBy("id", "t").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")), "substring-spans")


def _null_id(c):
    return F.coalesce(c.cast("long"), F.lit(-2**63))


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What is left of every row's text bytes: id, n_bytes, n_removed, n_spans, kept_sha256, kept (binary).

    A byte goes if a string of LENGTH bytes over it also starts earlier (a
    smaller id, or the same id and an earlier start), judged on the input.
    Null texts are empty. A null id counts as smaller than any; ids are
    integers. Rows that share an id stand at one place: a string at the same
    start in both is no copy. An empty table gives no rows. Other columns are
    not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    source = (tx.pick(docs, id=id_col, text=text_col)
              .select(_null_id(F.col("id")).alias("id"), F.xxhash64(text).alias("t"), text.alias("text")))
    spans = _covered(source)

    def run(block: tx.Block):
        rows = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
        for i, cover in enumerate(block.column("spans").to_pylist()):
            data = block.data[block.offsets[i]:block.offsets[i + 1]]
            edge = np.zeros(len(data) + 1, np.int64)
            for s in cover or ():
                edge[s["lo"]] += 1
                edge[s["hi"]] -= 1
            gone = np.cumsum(edge[:-1]) > 0
            left = data[~gone].tobytes()
            rows["n_bytes"].append(len(data))
            rows["n_removed"].append(int(gone.sum()))
            rows["n_spans"].append(int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(data) else 0)
            rows["kept_sha256"].append(hashlib.sha256(left).hexdigest())
            rows["kept"].append(left)
        return tx.record_batch(id=block.column("id"), **{k: pa.array(v, pa.binary()) if k == "kept" else v for k, v in rows.items()})

    out = tx.map_blocks(source.join(spans, ["id", "t"], "left"), "text", run,
                        "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.withColumn("id", F.when(F.col("id") != -2**63, F.col("id"))).withColumnRenamed("id", id_col)
