"""Which hashed items are frequent: counts of all rows in a fixed number of cells. Parity sketches of sets."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as tx

CELL_BITS = 17
#: Longs of a sketch; sets of some 900 items and more always pass it.
SKETCH = 8


def cells(key: np.ndarray, bits: int = CELL_BITS) -> np.ndarray:
    return (key >> np.uint64(64 - bits)).astype(np.int64)


def frequent_cells(df: DataFrame, text: str, keys_of: Callable[[tx.Block], np.ndarray],
                   bits: int = CELL_BITS) -> np.ndarray:
    """Boolean table of 2 ** bits: the cells that hold far more than their share of all keys.

    Every key of every row is counted; each task sends one count a cell, and
    the table that comes to the driver has the same size for any input. A
    cell is frequent above mean + 8 * sqrt(mean) + 64, which keys that occur
    once or a few times do not reach. The flag only serves to put keys in an
    order that all rows share, so a cell marked for another key in it costs
    time and never a result.
    """

    def run(batches):
        total = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for block in tx.blocks(batch, text):
                total += np.bincount(cells(keys_of(block), bits), minlength=1 << bits)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "count"])

    return frequent(df.select(F.col(f"`{text}`")).mapInArrow(run, "cell long, count long"), bits)


def frequent(counts: DataFrame, bits: int = CELL_BITS) -> np.ndarray:
    """The table from the tasks' counts (columns cell, count)."""
    found = counts.groupBy("cell").agg(F.sum("count").alias("n")).toArrow()
    table = np.zeros(1 << bits, np.int64)
    table[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    mean = table.mean()
    return table > mean + 8 * math.sqrt(mean) + 64


def sketch_of(doc: np.ndarray, key: np.ndarray, n: int, longs: int = SKETCH) -> np.ndarray:
    """Parity sketch of each of ``n`` sets: (n, longs) signed longs."""
    bits = np.zeros(n * longs, np.uint64)
    at = tx.mix(key ^ np.uint64(0x632BE59BD9B4E019)) >> np.uint64(32)
    place = at % np.uint64(64 * longs)
    np.bitwise_xor.at(bits, doc * longs + (place >> np.uint64(6)).astype(np.int64),
                      np.uint64(1) << (place & np.uint64(63)))
    return bits.view(np.int64).reshape(n, longs)


def sketches_allow(percent: int, a: str, b: str, bits: tuple[str, ...], sizes: tuple[str, str] = ("n_a", "n_b")):
    """Can two sets reach the threshold, given columns of their sizes and of both sketches?

    common <= (n_a + n_b - differing bits) / 2.
    """
    differ = sum((F.bit_count(F.col(f"{c}_{a}").bitwiseXOR(F.col(f"{c}_{b}"))) for c in bits), F.lit(0))
    total = (F.col(sizes[0]) + F.col(sizes[1])).cast("long")
    return (100 + percent) * (total - differ) >= 2 * percent * total
