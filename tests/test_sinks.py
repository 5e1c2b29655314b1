from retail_insight.sinks.jdbc import jdbc_options
from retail_insight.sinks.tables import overwrite_table
from retail_insight.session import new_work_dir


def test_jdbc_options_batch_and_credentials():
    opts = jdbc_options("jdbc:mysql://db/shop", "area_count_info", user="u", password="p", batch_size=500)
    assert opts == {"url": "jdbc:mysql://db/shop", "dbtable": "area_count_info", "batchsize": "500",
                    "user": "u", "password": "p"}
    assert "password" not in jdbc_options("jdbc:x", "t")


def test_overwrite_table_replaces_and_partitions(spark):
    path = f"{new_work_dir(spark, 'test-sink')}/t"
    df = spark.createDataFrame([("2019-01-01", 1), ("2019-01-02", 2)], "date string, n long")
    overwrite_table(df, path=path, partition_by=["date"])
    overwrite_table(df.filter("n = 2"), path=path, partition_by=["date"])
    back = spark.read.schema("n long, date string").parquet(path)  # fixed schema, as read_table does
    assert [(r.date, r.n) for r in back.collect()] == [("2019-01-02", 2)]


def test_write_with_one_client_per_partition(spark, tmp_path):
    from retail_insight.sinks.kv import write_with

    class FileClient:
        """Stand-in for a key-value client: appends 'key=value' lines to its own file.
        Defined here so it ships to the Python workers by value."""

        def __init__(self, folder):
            import os
            import uuid
            self.f = open(os.path.join(folder, uuid.uuid4().hex), "w")

        def hset(self, key, value):
            self.f.write(f"{key}={value}\n")

        def close(self):
            self.f.close()

    folder = str(tmp_path)
    df = spark.createDataFrame([(f"k{i}", i) for i in range(100)], "key string, n long").repartition(4)
    write_with(df, lambda: FileClient(folder), lambda c, row: c.hset(row.key, row.n))
    files = list(tmp_path.iterdir())
    lines = sorted(line for p in files for line in p.read_text().splitlines())
    assert len(files) == 4
    assert lines == sorted(f"k{i}={i}" for i in range(100))
