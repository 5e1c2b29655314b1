from pyspark.sql import functions as F

from retail_insight.operators import ads
from retail_insight.session import new_work_dir
from retail_insight.sinks.kv import KeyedUpsertLog
from retail_insight.sources import adlog
from retail_insight.streaming.pipeline import R5_SCHEMA, PipelineConfig, RealtimePipeline
from retail_insight.streaming.replay import replay
from retail_insight.streaming.running import running_area_city_counts

T0 = 19_723 * 86_400_000
KEYS = ["day", "area", "city", "ad_id"]


def fixture_lines(spark):
    """Six batches; users 1 and 2 cross T=3 at different times; one bad line."""
    rows = []
    for b in range(6):
        for i in range(3):
            rows.append((b, f"{T0 + b * 1000 + i} North C{i % 2} {1 + (b + i) % 3} {1 + i % 2}"))
        rows.append((b, f"{T0 + b} South C9 2 1"))
    rows.append((3, "not a line"))
    return spark.createDataFrame(rows, "batch_id long, value string")


def batch_expected(spark, lines, threshold):
    a = adlog.accepted_lines(adlog.parse_ad_log(lines, keep=("batch_id",)))
    bl = ads.blacklist(a, threshold)
    acc = ads.accepted(a, bl)
    totals = ads.area_city_counts(acc)
    top = ads.top_ads_json(ads.top_ads(ads.area_counts(totals)))
    return bl, totals, top


def rows(df, cols=None):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def run_pipeline(spark, lines, steps_list, threshold=3, snapshot_every=2):
    work = new_work_dir(spark, "test-pipeline")
    pipe = RealtimePipeline(spark, f"{work}/tables", PipelineConfig(threshold=threshold,
                                                                      snapshot_every=snapshot_every)).create()
    for steps in steps_list:
        replay(spark, lines, 6, f"{work}/feed",
               lambda s, c: pipe.start(s, c, {"availableNow": True}), steps=steps)
    return pipe


def test_stream_equals_batch_with_restarts(spark):
    lines = fixture_lines(spark)
    pipe = run_pipeline(spark, lines, [range(0, 2), range(2, 6)])
    bl, totals, top = batch_expected(spark, lines, 3)
    assert rows(pipe.blacklist(5)) == rows(bl)
    assert rows(pipe.area_totals(), KEYS + ["clicks"]) == rows(totals, KEYS + ["clicks"])
    assert rows(pipe.top3_json()) == rows(top)
    # bounded reads (snapshot every 2 batches + later deltas) equal full-log reads
    assert rows(pipe.area_totals(5), KEYS + ["clicks"]) == rows(totals, KEYS + ["clicks"])
    assert rows(pipe.top3_json(5)) == rows(top)
    assert rows(pipe.top3_json(3)) == rows(pipe.r6.fold(pipe.r6.read_all().filter("batch_id <= 3")))
    assert [r.value for r in pipe.rejected().collect()] == ["not a line"]
    assert bl.count() > 0


def test_replayed_batch_is_idempotent(spark):
    lines = fixture_lines(spark)
    work = new_work_dir(spark, "test-replay")
    pipe = RealtimePipeline(spark, f"{work}/tables", PipelineConfig(threshold=3, snapshot_every=2)).create()
    for b in range(6):
        batch = lines.filter(F.col("batch_id") == b).select("value")
        pipe.process(batch, b)
        if b in (1, 2):           # a retried batch: same id, same input
            pipe.process(batch, b)
    bl, totals, top = batch_expected(spark, lines, 3)
    assert rows(pipe.blacklist(5)) == rows(bl)
    assert rows(pipe.area_totals(), KEYS + ["clicks"]) == rows(totals, KEYS + ["clicks"])
    assert rows(pipe.top3_json()) == rows(top)


def test_running_totals_survive_restart(spark):
    lines = fixture_lines(spark)
    work = new_work_dir(spark, "test-running")
    sink = KeyedUpsertLog(spark, f"{work}/totals", R5_SCHEMA, KEYS).create()

    def start(stream, ckpt):
        return running_area_city_counts(stream, sink, ckpt, {"availableNow": True})

    replay(spark, lines, 6, f"{work}/feed", start, steps=range(0, 3))
    replay(spark, lines, 6, f"{work}/feed", start, steps=range(3, 6))
    expected = ads.area_city_counts(adlog.accepted_lines(adlog.parse_ad_log(lines)))
    assert rows(sink.current(), KEYS + ["clicks"]) == rows(expected, KEYS + ["clicks"])


def test_late_event_counts_in_its_own_day(spark):
    day = 86_400_000
    rows = [(0, f"{T0 + day} North C1 1 1"), (1, f"{T0 + day + 5} North C1 1 1"),
            (2, f"{T0 + 5} North C1 2 1")]          # arrives last, belongs to the first day
    lines = spark.createDataFrame(rows, "batch_id long, value string")
    work = new_work_dir(spark, "test-late")
    pipe = RealtimePipeline(spark, f"{work}/tables", PipelineConfig(threshold=100)).create()
    for b in range(3):
        pipe.process(lines.filter(F.col("batch_id") == b).select("value"), b)
    got = {(r.day, r.clicks) for r in pipe.area_totals().collect()}
    assert got == {("2024-01-02", 2), ("2024-01-01", 1)}
    json_by_day = {r.day: r.ads_json for r in pipe.top3_json().collect()}
    assert json_by_day == {"2024-01-01": '[{"1":1}]', "2024-01-02": '[{"1":2}]'}


def test_realtime_job_resumes_from_its_checkpoint(spark):
    import uuid

    from retail_insight.plans.realtime import start_realtime

    lines = fixture_lines(spark)
    folder = f"{new_work_dir(spark, 'test-job')}/landing"
    name = f"test-job-{uuid.uuid4().hex[:8]}"
    cfg = PipelineConfig(threshold=3, snapshot_every=2)
    for b in range(6):
        lines.filter(F.col("batch_id") == b).select("value").write.mode("append").text(folder)
        pipe, query = start_realtime(spark, folder=folder, name=name, config=cfg,
                                     trigger={"availableNow": True})
        query.awaitTermination()
    bl, totals, top = batch_expected(spark, lines, 3)
    assert rows(pipe.blacklist(5)) == rows(bl)
    assert rows(pipe.area_totals(), KEYS + ["clicks"]) == rows(totals, KEYS + ["clicks"])


def test_running_totals_with_retention_drop_only_too_late_events(spark):
    day = 86_400_000
    rows = [(0, f"{T0 + 5} North C1 1 1"), (0, f"{T0 + day + 5} North C1 1 1"),
            (1, f"{T0 + 3 * day} North C1 1 1"),     # moves the watermark past day 1
            (2, f"{T0 + 7} North C1 1 1"),           # day 1 again: later than the watermark
            (2, f"{T0 + 3 * day + 9} North C1 1 1")]
    lines = spark.createDataFrame(rows, "batch_id long, value string")
    work = new_work_dir(spark, "test-retain")
    sink = KeyedUpsertLog(spark, f"{work}/totals", R5_SCHEMA, KEYS).create()

    def start(stream, ckpt):
        return running_area_city_counts(stream, sink, ckpt, {"availableNow": True}, retain="1 day")

    replay(spark, lines, 3, f"{work}/feed", start)
    got = {r.day: r.clicks for r in sink.current().collect()}
    assert got == {"2024-01-01": 1, "2024-01-02": 1, "2024-01-04": 2}


def test_retain_days_expires_old_days_consistently(spark):
    day = 86_400_000
    rows = [(b, f"{T0 + b * day + i} North C1 {i % 3} 1") for b in range(5) for i in range(3)]
    rows += [(4, f"{T0 + 5} North C1 9 1"),              # day 1 on day 5: expired, never counted
             (4, f"{T0 + 3 * day + 7} North C1 9 1"),    # day 4 on day 5: within the window
             (3, f"{T0 + 8} North C1 9 1")]              # day 1 on day 4: expired as well
    lines = spark.createDataFrame(rows, "batch_id long, value string")

    def run(retain):
        work = new_work_dir(spark, "test-retain-days")
        pipe = RealtimePipeline(spark, f"{work}/tables",
                                PipelineConfig(threshold=100, snapshot_every=2, retain_days=retain)).create()
        for b in range(5):
            pipe.process(lines.filter(F.col("batch_id") == b).select("value"), b)
        return pipe

    kept = run(None)
    assert {r.day: r.clicks for r in kept.area_totals(4).collect()}["2024-01-01"] == 5
    bounded = run(1)
    assert sorted({r.day for r in bounded.area_clicks.read("snapshot", [4]).collect()}) == ["2024-01-04", "2024-01-05"]
    assert {r.day: r.clicks for r in bounded.area_totals(4).collect()} == {"2024-01-04": 4, "2024-01-05": 3}
    # an expired event is never counted, in snapshot batches or not
    assert bounded.area_clicks.read("delta", [3, 4]).filter(F.col("day") == "2024-01-01").count() == 0


def test_retired_partitions_leave_bounded_reads_exact(spark):
    lines = fixture_lines(spark)
    work = new_work_dir(spark, "test-retire")
    pipe = RealtimePipeline(spark, f"{work}/tables", PipelineConfig(
        threshold=3, snapshot_every=2, retire_old_partitions=True)).create()
    for b in range(6):
        batch = lines.filter(F.col("batch_id") == b).select("value")
        pipe.process(batch, b)
        if b == 5:
            pipe.process(batch, b)        # the running batch may still be replayed
    bl, totals, top = batch_expected(spark, lines, 3)
    assert rows(pipe.blacklist(5)) == rows(bl)
    assert rows(pipe.area_totals(5), KEYS + ["clicks"]) == rows(totals, KEYS + ["clicks"])
    assert rows(pipe.top3_json(5)) == rows(top)
    # batch 4 was committed when 5 ran: snapshot 2 and deltas 3..4 are empty now
    assert pipe.area_clicks.read("snapshot", [2]).count() == 0
    assert pipe.area_clicks.read("delta", [3, 4]).count() == 0
    assert pipe.area_clicks.read("snapshot", [4]).count() > 0
