"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes and
# splits skewed shuffle partitions; the session time zone only affects
# helpers that format TIMESTAMP values (the library's own day derivation is
# zone-explicit).
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "retail-insight",
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder, as named by ``spark.checkpoint.dir``.

    Only when the session names none and runs in local mode (tests) is a
    private folder created and registered as the checkpoint directory; on a
    cluster a missing setting is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root is None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
        if configured is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="retail-insight-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def durable_root(spark: SparkSession) -> str:
    """The configured shared folder itself, stable across applications.

    ``shared_root`` is the per-application subfolder Spark creates under
    ``spark.checkpoint.dir``; a job that must find its checkpoint again
    after a restart (a new application) roots its folders here instead.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir: a folder set at run time alone is lost at a restart")
    return configured.rstrip("/") if configured else shared_root(spark)


def new_work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared root."""
    return f"{shared_root(spark)}/retail_insight/{name}-{uuid.uuid4().hex[:12]}"


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session for a stateful stream whose shuffle width fits the cluster.

    A streaming aggregation fixes its number of state partitions from
    ``spark.sql.shuffle.partitions`` at first start (it is then stored in the
    checkpoint). A sibling session shares the SparkContext and sets that
    width to the cluster's parallelism unless told otherwise.
    """
    s = spark.newSession()
    s.conf.set("spark.sql.shuffle.partitions",
               str(state_partitions or spark.sparkContext.defaultParallelism))
    return s
