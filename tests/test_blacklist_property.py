"""The closed-form blacklist equals a literal batch-by-batch run of the rules.

The simulation is a plain loop over micro-batches, as the original stream
behaves: drop events of listed users, add the batch's clicks to the
(day, user, ad) counters, list every user whose counter reached T.
"""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retail_insight.operators import ads
from retail_insight.session import new_work_dir
from retail_insight.sources import adlog
from retail_insight.streaming.pipeline import PipelineConfig, RealtimePipeline

DAY = 86_400_000
T0 = 19_723 * DAY

event = st.tuples(st.integers(0, 4),   # batch
                  st.integers(0, 1),   # day
                  st.integers(1, 3),   # user
                  st.integers(1, 2))   # ad
events = st.lists(event, min_size=1, max_size=40)


def simulate(evs, threshold):
    counters, listed, accepted = Counter(), {}, []
    for b in sorted({e[0] for e in evs}):
        batch = [e for e in evs if e[0] == b and e[2] not in listed]
        accepted += batch
        for _, day, user, ad in batch:
            counters[(day, user, ad)] += 1
        for (day, user, ad), n in counters.items():
            if n >= threshold and user not in listed:
                listed[user] = b
    return listed, Counter(accepted)


def to_lines(spark, evs):
    rows = [(b, f"{T0 + day * DAY + i} A C {user} {ad}") for i, (b, day, user, ad) in enumerate(evs)]
    return spark.createDataFrame(rows, "batch_id long, value string")


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(evs=events, threshold=st.integers(2, 4))
def test_closed_form_matches_simulation(spark, evs, threshold):
    listed, accepted = simulate(evs, threshold)
    a = adlog.accepted_lines(adlog.parse_ad_log(to_lines(spark, evs), keep=("batch_id",)))
    bl = ads.blacklist(a, threshold)
    assert {int(r.user_id): r.listed_batch for r in bl.collect()} == listed
    got = Counter((r.batch_id, 0 if r.day.endswith("01") else 1, int(r.user_id), int(r.ad_id))
                  for r in ads.accepted(a, bl).collect())
    assert got == accepted


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(evs=events)
def test_pipeline_matches_simulation(spark, evs):
    threshold = 2
    listed, accepted = simulate(evs, threshold)
    lines = to_lines(spark, evs)
    pipe = RealtimePipeline(spark, f"{new_work_dir(spark, 'prop')}/t",
                            PipelineConfig(threshold=threshold, snapshot_every=2)).create()
    batches = sorted({e[0] for e in evs})
    for n, b in enumerate(batches):   # micro-batch ids are consecutive
        pipe.process(lines.filter(F.col("batch_id") == b).select("value"), n)
    got = {int(r.user_id): batches[r.listed_batch] for r in pipe.blacklist(len(batches) - 1).collect()}
    assert got == listed
    totals = Counter()
    for (_, day, _, ad), n in accepted.items():
        totals[(day, ad)] += n
    per_day_ad = Counter()
    for r in pipe.area_totals().collect():
        per_day_ad[(0 if r.day.endswith("01") else 1, int(r.ad_id))] += r.clicks
    assert per_day_ad == totals
