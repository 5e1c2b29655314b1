"""What a worker holds besides its Arrow batch, in stages that scan texts and compare pairs."""

import tracemalloc

import numpy as np
import pyarrow as pa
from util import prose

from retail_insight.llm import _text as tx
from retail_insight.llm import ngram_join, quality


def peak(run):
    tracemalloc.start()
    run()
    size = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return size


def test_arrays_of_a_block_are_bounded():
    text = prose(41, 600)
    batch = pa.record_batch([pa.array([text] * (6 * 2**20 // len(text)))], names=["text"])

    def scan(of):
        for block in tx.blocks(batch, "text"):
            of(block)

    assert peak(lambda: scan(lambda b: ngram_join.shingles(b, 5))) < 40 << 20
    assert peak(lambda: scan(lambda b: quality.measure(b, quality.NGRAM_LIMITS))) < 40 << 20


def test_pairs_are_cut_without_reading_the_texts():
    texts = [None, "", "é" * 3000, "x" * 700_000, *["a b c " * 5000] * 200]
    n = len(texts)
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(np.arange(n)), pa.array(texts), pa.array(texts[::-1])],
                                       names=["a", "b", "text_a", "text_b"])
    cut = []
    assert peak(lambda: cut.extend(tx.pair_blocks(batch))) < 1 << 20
    assert pa.Table.from_batches(cut).to_pydict() == batch.to_pydict()
    for rows in cut:
        size = sum(len((x or "").encode()) for k in (2, 3) for x in rows.column(k).to_pylist())
        assert rows.num_rows == 1 or size <= tx.BLOCK_BYTES
