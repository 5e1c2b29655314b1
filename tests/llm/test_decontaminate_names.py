"""Column names of tables that go through ``remove_benchmark``."""

import pytest
from util import prose

from retail_insight.llm import decontaminate


@pytest.mark.parametrize("what", ["documents", "spans"])
@pytest.mark.parametrize("block_text", [1 << 20, 200])
def test_other_text_and_helper_columns_stay(spark, what, block_text):
    items = [prose(50 + k, 30) for k in range(6)]
    bench = spark.createDataFrame([(f"q{k}", t) for k, t in enumerate(items)], "item_id string, text string")
    clean = prose(99, 400, vocabulary=900)
    rows = [(1, clean, "a"), (2, clean + " " + items[3], "b"), (2, clean + " " + items[3], "b"), (None, None, None),
            (4, items[0] + " " + clean, "c"), (5, "", "d")]
    extra = ["__hits", "__items", "row", "filler", "a.b", "Hits"]
    schema = "id long, body string, text string, " + ", ".join(f"`{c}` string" for c in extra)
    docs = spark.createDataFrame([(i, b, t, *[f"{c}{i}" for c in extra]) for i, b, t in rows], schema)
    left = decontaminate.remove_benchmark(docs, bench, what=what, text_col="body", block_text=block_text)
    assert left.schema == docs.schema
    got = sorted((tuple(r) for r in left.collect()), key=repr)
    if what == "documents":
        assert got == sorted((tuple(r) for r in docs.collect() if r.id in (1, None, 5)), key=repr)
    else:
        assert [r[:1] + r[2:] for r in got] == [tuple(r)[:1] + tuple(r)[2:] for r in sorted(docs.collect(), key=lambda r: repr(tuple(r)))]
        body = {r[0]: r[1] for r in got}
        assert body[1] == clean and body[None] is None and body[5] == ""
        assert items[3] not in body[2] and clean in body[2] and items[0] not in body[4]


def test_a_table_of_one_column(spark):
    bench = spark.createDataFrame([("q", prose(50, 30))], "item_id string, text string")
    docs = spark.createDataFrame([(prose(50, 30),), ("clean",), (None,)], "text string")
    left = decontaminate.remove_benchmark(docs, bench)
    assert sorted((r.text for r in left.collect()), key=repr) == ["clean", None]
    assert decontaminate.remove_benchmark(docs.limit(0), bench).collect() == []
