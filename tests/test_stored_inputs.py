"""Stored inputs: only what a query reads, and visits built by tasks of bounded size."""

import os
import shutil

from retail_insight.sources import testdata as td

SF = "/root/testdata/sf0.001"


def test_ad_log_needs_no_other_table(spark, tmp_path):
    for name in ("events", "nation", "region"):
        shutil.copy(f"{SF}/{name}.parquet", tmp_path)
    lines = td.stored_table(spark, str(tmp_path), 5, "ad_log_lines")
    assert lines.count() == spark.read.parquet(f"{SF}/events.parquet").count()
    (path,) = {os.path.dirname(f) for f in lines.inputFiles()}
    assert os.listdir(os.path.dirname(path.removeprefix("file:"))) == ["ad_log_lines"]
    assert td.stored_table(spark, str(tmp_path), 5, "ad_log_lines").inputFiles() == lines.inputFiles()


def test_tasks_of_visits_grow_with_the_line_items(spark, monkeypatch):
    few = td.user_visit_action(spark, SF)
    n = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    monkeypatch.setattr(td, "ITEMS_PER_TASK", n // 40)
    many = td.user_visit_action(spark, SF)
    assert many.schema == few.schema
    assert sorted(map(repr, many.collect())) == sorted(map(repr, few.collect()))
    assert many.rdd.getNumPartitions() >= 2 * 40    # clicks, and orders with pays
