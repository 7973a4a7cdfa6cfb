"""Session construction and shared-storage locations.

Jobs never invent a machine-local scratch folder: every intermediate table,
stream checkpoint or staged publish lives under the shared folder named by
``spark.checkpoint.dir``.  Only when the session has none (unit tests on a
laptop) do we create one and register it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job wants regardless of scale.  Shuffle width is left to AQE
# (coalescing small partitions, splitting skewed ones) rather than fixed here.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # list partition folders with a bounded number of tasks (default 10000:
    # one task per folder for daily-partitioned tables)
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}


def build_session(master: str | None = None, app: str = "haven",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for lineage cuts and job state.

    Read from the session; set our own only where it is unset (tests).
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not base:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        base = tempfile.mkdtemp(prefix="haven-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def job_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared folder for one job run."""
    return f"{shared_dir(spark)}/haven/{name}-{uuid.uuid4().hex[:12]}"
