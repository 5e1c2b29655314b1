"""Vectorised text helpers shared by the operators: Arrow blocks, word spans, hashes.

A *block* is a run of rows of one Arrow batch whose texts are laid end to end
in one byte array, so numpy works on a bounded run of bytes at a time, or on
one row. A null text reads as empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A worker holds some 40 bytes of arrays for each byte of a block.
BLOCK_BYTES = 256 << 10


@dataclass
class Block:
    """Rows ``lo:hi`` of an Arrow batch; ``offsets`` are byte offsets of the texts in ``data``."""

    rows: pa.RecordBatch
    data: np.ndarray
    offsets: np.ndarray

    def column(self, name: str) -> pa.Array:
        return self.rows.column(self.rows.schema.get_field_index(name))

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def text_bytes(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def blocks(batch: pa.RecordBatch, text: str, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a batch into blocks of about ``limit`` text bytes, one row at least."""
    if batch.num_rows == 0:
        return
    column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary()).fill_null(b"")
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), len(column))
        yield Block(batch.slice(lo, hi - lo), raw[offsets[lo]:offsets[hi]],
                    offsets[lo:hi + 1] - offsets[lo])
        lo = hi


def pair_blocks(batch: pa.RecordBatch, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch of pairs (a, b, text_a, text_b) so that its texts stay within ``limit``, one pair at least."""
    length = sum(pc.fill_null(pc.binary_length(batch.column(k)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                 for k in (2, 3))
    size = np.concatenate([[0], np.cumsum(length)])
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(size, size[lo] + limit, "right")) - 1)
        yield batch.slice(lo, min(hi, batch.num_rows) - lo)
        lo = hi


def map_blocks(df: DataFrame, text: str, fn: Callable[[Block], pa.RecordBatch], schema,
               limit: int = BLOCK_BYTES) -> DataFrame:
    """``fn`` over every block of ``df``: one record batch out for each block in."""

    def run(batches):
        for batch in batches:
            for block in blocks(batch, text, limit):
                yield fn(block)

    return df.mapInArrow(run, schema)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names; a table's other columns never clash."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def fresh(columns: list[str], name: str) -> str:
    """A column name like ``name`` that no column has, whatever its case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def record_batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))


# -- bytes -------------------------------------------------------------------
def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Boolean table of 256 with the given inclusive byte ranges set."""
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first:last + 1] = True
    return table


SPACE = byte_set((0x20, 0x20), (0x09, 0x0D))
NOT_SPACE = ~SPACE
NOT_NEWLINE = ~byte_set((0x0A, 0x0A))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MULT = np.uint64(0x9E3779B97F4A7C15)
_POW_BITS = 16


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A random word for each byte value and, below, powers of one odd base.
BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _MULT)
_BASE = 0xD6E8FEB86659FD93
_POW = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64),
                                              np.full((1 << _POW_BITS) - 1, _BASE, np.uint64)]))


def powers(at: np.ndarray) -> np.ndarray:
    """The base's power for each exponent (any size)."""
    low = _POW[at & ((1 << _POW_BITS) - 1)]
    high = at >> _POW_BITS
    if len(high) and (top := int(high.max())):
        step = pow(_BASE, 1 << _POW_BITS, 1 << 64)
        big = np.array([pow(step, k, 1 << 64) for k in range(top + 1)], dtype=np.uint64)
        low = low * big[high]
    return low


@dataclass
class Spans:
    """Maximal runs of member bytes, never across texts."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray

    def per_doc(self, n_docs: int) -> np.ndarray:
        return np.bincount(self.doc, minlength=n_docs)


def spans(data: np.ndarray, offsets: np.ndarray, member: np.ndarray, hashed: bool = True) -> Spans:
    """Runs of bytes of ``member`` in each text, with a 64-bit polynomial hash of their bytes."""
    inside = member[data]
    n = len(data)
    edges = offsets[:-1][offsets[:-1] < n]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[edges] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    if not hashed or not len(start):
        return Spans(start, end, doc, np.zeros(len(start), np.uint64))
    length = end - start
    first = np.concatenate([[0], np.cumsum(length)[:-1]])
    at = np.arange(int(length.sum())) - np.repeat(first, length)
    value = BYTE_CODE[data[inside]] * powers(at)
    return Spans(start, end, doc, mix(np.add.reduceat(value, first)))


def windows(hashes: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rolling hash of every ``size`` consecutive words of one text: first words, hashes."""
    m = len(hashes) - size + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(m, np.uint64)
    for j in range(size):
        total = total * np.uint64(_BASE) + hashes[j:j + m]
    at = np.flatnonzero(doc[:m] == doc[size - 1:])
    return at, mix(total[at] + np.uint64(size))


def code_points(data: np.ndarray) -> np.ndarray:
    """Running count of code points: entry i counts those that start before byte i."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def repeated(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: does its key occur at least twice; does it occur earlier."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = np.zeros(len(k), bool)
    same[1:] = k[1:] == k[:-1]
    later = np.zeros(len(k), bool)
    later[order] = same
    any_ = same.copy()
    any_[:-1] |= same[1:]
    twice = np.zeros(len(k), bool)
    twice[order] = any_
    return twice, later
