"""Quality classifier: exact gradients, defined edge cases, held-out accuracy."""

import zlib

import numpy as np
import pytest
from util import docs_frame, edge_docs

from retail_insight.llm import quality_mil as q


def test_gradient():
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(k, q.N_FEATURES)).astype(np.float64) for k in (1, 3, 2)]
    y = np.array([1.0, 0.0, 1.0])
    shape = {"w": (q.N_FEATURES, 4), "b": (4,), "v": (4, 3), "u": (4, 3), "a": (3,), "c": (4,), "c0": (1,)}
    m = q.Model(0.0, 1.0, {k: rng.normal(size=s) * 0.3 for k, s in shape.items()})
    x, first, doc = np.concatenate(bags), np.array([0, 1, 4]), np.array([0, 1, 1, 1, 2, 2])

    def loss():
        out = m.forward(x, first, doc)[-1]
        return (-(y * np.log(out) + (1 - y) * np.log(1 - out)).mean()
                + q.DECAY / 2 * ((m.p["w"] ** 2).sum() + (m.p["c"] ** 2).sum()))

    grad = m.gradient(x, first, doc, y)
    for k, v in m.p.items():
        at = tuple(rng.integers(0, s) for s in v.shape)
        old = v[at]
        v[at] = old + 1e-5
        up = loss()
        v[at] = old - 1e-5
        down = loss()
        v[at] = old
        assert grad[k][at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = {r.doc_id: r for r in q.score(docs, q.train(docs, labels)).collect()}
    held = [(got[r.doc_id], r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    assert sum((g.score >= 0.5) == bool(y) for g, y in held) >= 0.9 * len(held)
    assert all(g.predicted == int(g.score >= 0.3) for g in got.values())


def test_edges(spark):
    rows = edge_docs()
    df = docs_frame(spark, rows)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert q.train(df, none) is None
    assert {r.score for r in q.score(df, None).collect()} == {0.5}
    some = spark.createDataFrame([(1, 1), (3, 0), (5, 1), (6, 0), (7, 0), (9, None), (None, 1), (1, 1)], "doc_id long, quality int")
    got = q.score(df, q.train(df, some)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert q.score(docs_frame(spark, []), None).count() == 0
