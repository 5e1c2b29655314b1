"""Retention without loss, the external store, and the remark as a SQL function."""

import json

from pyspark.sql import functions as F

from retail_insight.functions.city_share import city_share, register_city_ratio
from retail_insight.plans.area_count import AREA_TOP3_SQL
from retail_insight.session import new_work_dir
from retail_insight.streaming.pipeline import PipelineConfig, RealtimePipeline

DAY = 86_400_000
T0 = 19_723 * DAY


def _pipeline(spark, rows, batches, **config):
    lines = spark.createDataFrame(rows, "batch_id long, value string")
    pipe = RealtimePipeline(spark, f"{new_work_dir(spark, 'test-round3')}/tables",
                            PipelineConfig(snapshot_every=2, **config)).create()
    for b in batches:
        pipe.process(lines.filter(F.col("batch_id") == b).select("value"), b)
    return pipe


def test_one_event_far_ahead_expires_nothing_and_late_ones_are_kept_aside(spark):
    rows = [(b, f"{T0 + b * DAY + i} North C1 {i} 1") for b in range(4) for i in range(3)]
    rows += [(1, f"{T0 + 400 * DAY} North C1 7 1"), (3, f"{T0 + 5} North C1 8 1")]
    pipe = _pipeline(spark, rows, [0, 1, 2, 3, 3], retain_days=1)     # batch 3 is replayed
    late = pipe.expired().collect()
    assert [(r.day, r.user_id, r.batch_id) for r in late] == [("2024-01-01", "8", 3)]
    counted = pipe.area_clicks.read("delta", range(4)).agg(F.sum("clicks")).first()[0]
    assert counted + len(late) == len(rows)
    got = {r.day: r.clicks for r in pipe.area_totals(3).collect()}
    assert got["2024-01-04"] == 3 and got["2025-02-04"] == 1


def _client(folder):
    """A stand-in client that notes its calls in a file of its own; shipped to the workers by value."""
    class Client:
        def __init__(self):
            import os
            import uuid
            self.f = open(os.path.join(folder, uuid.uuid4().hex), "w")

        def note(self, *call):
            import json as j
            self.f.write(j.dumps(call) + "\n")

        def hset(self, key, fields):
            self.note("hset", key, fields)

        def sadd(self, key, members):
            self.note("sadd", key, members)

        def close(self):
            self.f.close()
    return Client


def test_batches_reach_the_external_store(spark, tmp_path):
    def run(name, batches):
        folder = tmp_path / name
        folder.mkdir()
        rows = [(b, f"{T0 + d * DAY + i} {a} C1 {i % 2} {1 + i % 4}") for b in range(2) for d in range(2)
                for i in range(8) for a in ("North", "South")]
        pipe = _pipeline(spark, rows, batches, threshold=8, client_factory=_client(str(folder)))
        hashes, sets, top_calls = {}, {}, []
        for p in folder.iterdir():
            for kind, key, value in map(json.loads, p.read_text().splitlines()):
                if kind == "sadd":
                    sets.setdefault(key, set()).update(value)
                else:
                    top_calls += [key] * key.startswith("area_top3_ads:")
                    for f, v in value.items():
                        hashes.setdefault(key, {})[f] = max(v, hashes.get(key, {}).get(f, v), key=lambda t: (len(t), t))
        return pipe, hashes, sets, top_calls

    pipe, hashes, sets, top_calls = run("once", [0, 1])
    want = {f"{r.day}:{r.area}:{r.city}:{r.ad_id}": str(r.clicks) for r in pipe.area_totals(1).collect()}
    assert hashes["date:area:city:ads"] == want
    assert set(hashes["area_top3_ads:2024-01-01"]) == {"North", "South"}
    assert sorted(top_calls) == sorted(["area_top3_ads:2024-01-01", "area_top3_ads:2024-01-02"] * 2)   # one a day and batch
    assert all(f.split("_")[0] in "01" and v.isdigit() for f, v in hashes["user_ads_click:2024-01-02"].items())
    assert sets["blackList"] == {r.user_id for r in pipe.blacklist(1).collect()} != set()
    assert run("replayed", [0, 1, 1])[1:3] == (hashes, sets)


def test_city_ratio_in_sql_is_the_remark(spark):
    rows = [("A", "p", f"c{i}", n) for i, n in enumerate((5, 9, 9, 1))] + [("B", "p", "x", 3), ("B", "q", "x", 1), ("B", "q", "y", 2)]
    per_city = spark.createDataFrame(rows, "area string, product string, city_name string, n long")
    per_city.createOrReplaceTempView("per_city_rows")
    register_city_ratio(spark)
    got = spark.sql("SELECT area, product, city_ratio(collect_list(struct(city_name AS city, n))) AS city_remark "
                    "FROM per_city_rows GROUP BY area, product")
    assert sorted(got.collect()) == sorted(city_share(per_city, ["area", "product"]).collect())
    assert spark.sql("SELECT city_ratio(array()) AS r").first().r == ""
    assert AREA_TOP3_SQL.index("rk <= 3") < AREA_TOP3_SQL.index("city_ratio(")
