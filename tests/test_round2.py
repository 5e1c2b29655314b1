"""Lines that must not stop a batch, and reads of retired logs."""

import pytest

from retail_insight.sources import adlog
from retail_insight.streaming.pipeline import PipelineConfig, RealtimePipeline


@pytest.mark.parametrize("line", ["9223372036854775807 a b 2 3", "1830000000000000 a b 2 3", "1 a b 2 ", "1  a b 2 3",
                                  "x a b 2 3", "1 a b 2", "", " "])
def test_bad_line_is_set_aside(spark, line):
    parsed = adlog.parse_ad_log(spark.createDataFrame([(line,), ("-5 a b 2 3",)], "value string"))
    assert [(r.is_valid, r.day) for r in parsed.orderBy("ts").collect() if r.value != line] == [(True, "1969-12-31")]
    assert [r.value for r in adlog.rejected_lines(parsed).collect()] == [line]


def test_default_reads_are_complete_after_retirement(spark, tmp_path):
    pipe = RealtimePipeline(spark, str(tmp_path / "t"), PipelineConfig(snapshot_every=2, retire_old_partitions=True))
    pipe.create()
    for n in range(4):
        if n == 2:
            pipe.create()       # a restart keeps what is there
        lines = spark.createDataFrame([(f"{n} area{n} city u{n} 1",), ("9223372036854775807 a b 2 3",)], "value string")
        pipe.process(lines, n)
    for read in (pipe.area_totals, pipe.top3_json):
        assert sorted(map(tuple, read().collect())) == sorted(map(tuple, read(3).collect()))
        assert read().count() == 4
