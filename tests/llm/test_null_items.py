"""Benchmark rows with a null id, against the query's own SQL."""

import hashlib

import pytest
from util import docs_frame, prose, rows_of

from retail_insight.llm import decontaminate
from retail_insight.llm.oracle import SQL


@pytest.mark.parametrize("block_text", [1 << 20, 100])
def test_null_item_is_a_hit(spark, tmp_path, block_text):
    duckdb = pytest.importorskip("duckdb")
    items = [(1, prose(50, 60)), (None, prose(51, 20)), (None, prose(54, 30)), (2, prose(53, 25))]
    docs = [(1, prose(60, 30) + " " + prose(51, 20)), (2, prose(61, 40)), (3, prose(51, 20) + " x " + prose(54, 30) + " " + prose(53, 25))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs_frame(spark, docs, extra=("token",))
    got = rows_of(decontaminate.scan_benchmark(df, bench, block_text=block_text))
    base = duckdb.connect()
    for name, rows in (("documents", docs), ("benchmark", items)):
        base.execute(f"CREATE TABLE {name} ({'doc_id' if name == 'documents' else 'item_id'} BIGINT, text VARCHAR)")
        base.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    assert got == sorted(base.execute(SQL["op5_benchmark_hits"]).fetchall(), key=repr)
    assert [r[5] for r in got] == [True, False, True] and got[0][3:5] == (1, hashlib.sha256(b"").hexdigest())
    left = decontaminate.remove_benchmark(df, bench, block_text=block_text)
    assert [r.doc_id for r in left.collect()] == [2]
