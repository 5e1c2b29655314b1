"""The n-gram join's filters before verification, and column names in its pipeline stage."""

import random

import corpus_pipeline
import numpy as np
import pytest
from util import prose

from retail_insight.llm import ngram_join


@pytest.mark.parametrize("n", [1, 5, 40, 300, 900, 3000])
def test_sketches_never_differ_in_more_bits_than_the_sets_in_tokens(n):
    rng = random.Random(n)
    a = {rng.randrange(2**64) for _ in range(n)}
    for moved in (0, 1, n // 20, n // 7, n // 2, n):
        b = set(sorted(a)[moved:]) | {rng.randrange(2**64) for _ in range(moved)}
        keys = [np.array(sorted(s), np.uint64) for s in (a, b)]
        doc = np.repeat([0, 2], [len(k) for k in keys])          # the text between them is empty
        one, none, two = ngram_join.sketch_of(doc, np.concatenate(keys), 3)
        assert not none.any()
        bits = sum(int(x).bit_count() for x in (one ^ two).view(np.uint64))
        assert bits <= len(a ^ b)
        assert (len(a ^ b) - bits) % 2 == 0


def test_clashing_column_names_stay(spark):
    a, b = prose(31, 90), prose(32, 90)
    rows = [(1, a), (2, a), (2, a), (3, b), (None, a), (4, None)]
    extra = ["__gone", "gone", "GONE_", "__id_and_text", "id_and_text", "several", "count", "component_id", "a.b"]
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in extra)
    docs = spark.createDataFrame([(i, t, *[f"{c} {i}" for c in extra]) for i, t in rows], schema)
    for stage in (lambda d: corpus_pipeline.near_duplicates(spark, d, ""), ngram_join.keep_one_of_each):
        left = stage(docs)
        assert left.schema == docs.schema
        got = sorted((tuple(r) for r in left.collect()), key=repr)
        assert got == sorted([tuple(r) for r in docs.collect() if r.doc_id != 2], key=repr)
