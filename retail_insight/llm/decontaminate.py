"""Benchmark decontamination with a broadcast set of normalised n-grams.

The benchmark's windows go to every task as a hash set; a task rolls the same
hash over the word windows of each whole text, checks each hit word for word,
and reports or removes the words covered. The benchmark is cut into blocks of
bounded text, one broadcast each, so its size sets the number of passes and
never the memory of a task. Training texts are not shuffled.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType

from . import _text as tx
from ._stage import staged

WINDOW = 13
#: UTF-8 bytes of benchmark text in one broadcast.
BLOCK_TEXT = 8 << 20
_WORD = tx.byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
_BITS = 20


class WindowSet:
    """Windows of benchmark items: hash filter, sorted hashes, and the words with their items."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        self.items = [i for i, _ in items]
        where: dict[int, dict[bytes, set[int]]] = defaultdict(lambda: defaultdict(set))
        hashes: dict[int, list[np.ndarray]] = defaultdict(list)
        for k, (_, text) in enumerate(items):
            data = tx.LOWER[np.frombuffer((text or "").encode(), np.uint8)]
            words = tx.spans(data, np.array([0, len(data)]), _WORD)
            size = min(window, len(words.start))
            if not size:
                continue
            at, key = tx.windows(words.hash, words.doc, size)
            hashes[size].append(key)
            for a in at:
                where[size][_joined(data, words, a, size)].add(k)
        self.where = {s: {w: sorted(v) for w, v in by.items()} for s, by in where.items()}
        self.sorted = {s: np.unique(np.concatenate(v)) for s, v in hashes.items()}
        self.seen = {}
        for s, keys in self.sorted.items():
            self.seen[s] = np.zeros(1 << _BITS, bool)
            self.seen[s][keys >> np.uint64(64 - _BITS)] = True

    def scan(self, data: np.ndarray, words: tx.Spans) -> tuple[np.ndarray, dict[int, set[int]]]:
        """Words covered by verified windows, and the items found in each text."""
        hit = np.zeros(len(words.start), bool)
        found: dict[int, set[int]] = defaultdict(set)
        for size, keys in self.sorted.items():
            at, key = tx.windows(words.hash, words.doc, size)
            near = self.seen[size][key >> np.uint64(64 - _BITS)]
            at, key = at[near], key[near]
            spot = np.searchsorted(keys, key)
            equal = keys[np.minimum(spot, len(keys) - 1)] == key
            for a in at[equal].tolist():
                items = self.where[size].get(_joined(data, words, a, size))
                if items is not None:
                    hit[a:a + size] = True
                    found[int(words.doc[a])].update(items)
        return hit, found


def _joined(data: np.ndarray, words: tx.Spans, at: int, size: int) -> bytes:
    return b" ".join(data[words.start[j]:words.end[j]].tobytes() for j in range(at, at + size))


def _window_sets(bench: DataFrame, item_col: str, text_col: str, window: int, block_text: int):
    """One :class:`WindowSet` for each block of the benchmark, built one after the other."""
    items = tx.pick(bench, item=item_col, text=text_col).filter("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / block_text))
    for b in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == b)
        yield WindowSet([(None if r["item"] is None else str(r["item"]), r["text"]) for r in part.distinct().collect()], window)


def _mark(block: tx.Block, sets: WindowSet, earlier_hits, earlier_items):
    """Word hits and item ids of a block's texts, joined to those of earlier passes."""
    data = tx.LOWER[block.data]
    words = tx.spans(data, block.offsets, _WORD)
    hit, found = sets.scan(data, words)
    items = [{sets.items[k] for k in found.get(i, ())} for i in range(block.n)]
    if earlier_hits is not None:
        first = np.searchsorted(words.doc, np.arange(block.n))
        for i, at in enumerate(earlier_hits):
            hit[first[i] + np.asarray(at, np.int64)] = True
        items = [a | set(b) for a, b in zip(items, earlier_items)]
    return words, hit, items


def _contaminated(n_words: np.ndarray, n_hit: np.ndarray, share: int) -> np.ndarray:
    return (n_hit > 0) & (share * n_hit >= n_words)


def _passes(docs: DataFrame, bench: DataFrame, item_col, bench_text_col, window, block_text, last):
    """Run all blocks but the last as passes that only note hits; ``last(frame, broadcast, noted)``
    makes the result. Notes are written between passes, which cuts the lineage."""
    spark = docs.sparkSession
    frame, pending, noted = docs, None, False
    for sets in _window_sets(bench, item_col, bench_text_col, window, block_text):
        if pending is not None:
            frame = staged(_noted(frame, pending, noted), "decontaminate")
            noted = True
        pending = spark.sparkContext.broadcast(sets)
    return last(frame, pending, noted)


def _noted(frame: DataFrame, sets, noted: bool) -> DataFrame:
    base = [c for c in frame.columns if not (noted and c in ("__hits", "__items"))]

    def run(block: tx.Block):
        words, hit, items = _mark(block, sets.value, *_earlier(block, noted))
        first = np.searchsorted(words.doc, np.arange(block.n + 1))
        at = [np.flatnonzero(hit[first[i]:first[i + 1]]).tolist() for i in range(block.n)]
        columns = [block.column(c) for c in base]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(at, pa.list_(pa.int64())), pa.array([list(x) for x in items], pa.list_(pa.string()))],
            names=[*base, "__hits", "__items"])

    fields = frame.select(*[f"`{c}`" for c in base]).schema
    return tx.map_blocks(frame, "text", run, fields.add("__hits", ArrayType(LongType())).add("__items", ArrayType(StringType())))


def _earlier(block: tx.Block, noted: bool):
    return (block.column("__hits").to_pylist(), block.column("__items").to_pylist()) if noted else (None, None)


def scan_benchmark(docs: DataFrame, bench: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", bench_text_col: str = "text", window: int = WINDOW,
                   share: int = 20, block_text: int = BLOCK_TEXT) -> DataFrame:
    """Benchmark hits of every row of ``docs``.

    ``contaminated``: a word is hit and share * n_hit >= n_words. Null texts
    have no words. Benchmark rows with a null text, or without a word,
    give no window; rows that share an id count as one item. Rows with a null
    id are one item too, which n_items counts and the digest leaves out. An empty
    benchmark leaves every document clean. Other columns are not read.
    """
    source = tx.pick(docs, id=id_col, text=text_col)
    id_type = source.schema["id"].dataType.simpleString()

    def last(frame, sets, noted):
        def run(block: tx.Block):
            words, hit, items = _mark(block, sets.value, *_earlier(block, noted))
            n_words = words.per_doc(block.n)
            n_hit = np.bincount(words.doc[hit], minlength=block.n)
            digest = [hashlib.sha256(",".join(sorted(x - {None})).encode()).hexdigest() for x in items]
            return tx.record_batch(id=block.column("id"), n_words=n_words.astype(np.int64),
                                   n_hit=n_hit.astype(np.int64), n_items=[len(x) for x in items],
                                   items_sha256=digest, contaminated=_contaminated(n_words, n_hit, share))

        return tx.map_blocks(frame, "text", run, f"id {id_type}, n_words long, n_hit long, n_items long, "
                             "items_sha256 string, contaminated boolean")

    found = _passes(source, bench, item_col, bench_text_col, window, block_text, last)
    return found.withColumnRenamed("id", id_col)


def remove_benchmark(docs: DataFrame, bench: DataFrame, *, what: str = "documents", text_col: str = "text",
                     item_col: str = "item_id", bench_text_col: str = "text", window: int = WINDOW,
                     share: int = 20, block_text: int = BLOCK_TEXT) -> DataFrame:
    """``docs`` without contaminated documents, or (``what="spans"``) without the words hit.

    All columns stay, whatever their names; rows repeat as they come, and an
    empty table gives no rows. Null texts have no words and stay. A span runs from its first to its last hit word and
    what lies between them; the text around it is left as it is.
    """
    if what not in ("documents", "spans"):
        raise ValueError(what)
    schema, columns = docs.schema, docs.columns
    others = [c for c in columns if c != text_col]
    # the other columns go as one struct (never an empty one), so no name of theirs can clash
    packed = F.struct(*[F.col(f"`{c}`") for c in others], F.lit(0).alias(tx.fresh(others, "filler")))
    source = docs.select(packed.alias("row"), F.col(f"`{text_col}`").alias("text"))

    def last(frame, sets, noted):
        def run(block: tx.Block):
            words, hit, _ = _mark(block, sets.value, *_earlier(block, noted))
            own = dict(zip(others, block.column("row").flatten())) | {text_col: block.column("text")}
            rows = pa.RecordBatch.from_arrays([own[c] for c in columns], names=columns)
            if what == "documents":
                n_hit = np.bincount(words.doc[hit], minlength=block.n)
                return rows.filter(pa.array(~_contaminated(words.per_doc(block.n), n_hit, share)))
            run_on = hit.copy()     # a hit word whose predecessor is a hit word of the same text
            run_on[1:] &= hit[:-1] & (words.doc[1:] == words.doc[:-1])
            run_on[:1] = False
            start = words.start.copy()
            start[1:][run_on[1:]] = words.end[:-1][run_on[1:]]
            edge = np.zeros(len(block.data) + 1, np.int64)
            np.add.at(edge, start[hit], 1)
            np.add.at(edge, words.end[hit], -1)
            keep = np.cumsum(edge)[:-1] == 0
            texts = [None] * block.n
            for i in np.flatnonzero(np.asarray(block.column("text").is_valid())).tolist():
                part = slice(block.offsets[i], block.offsets[i + 1])
                texts[i] = block.data[part][keep[part]].tobytes().decode()
            at = columns.index(text_col)
            return rows.set_column(at, rows.schema.field(at), pa.array(texts, rows.schema.field(at).type))

        return tx.map_blocks(frame, "text", run, schema)

    return _passes(source, bench, item_col, bench_text_col, window, block_text, last)
