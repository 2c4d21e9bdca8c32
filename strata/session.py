"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "strata",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster the submitter configures the session;
    library code only reads settings from it."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder named by the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we read it
    and never override it.  Only when it is unset *and* the master is local
    (tests, bench) do we create a scratch folder under /tmp.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="strata-ckpt-", dir=os.environ.get("STRATA_SCRATCH", "/tmp"))
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")


def materialize(df):
    """Cut lineage by writing ``df`` as a parquet table under the session's
    shared checkpoint folder and reading it back.  Columnar files (unlike a
    serialized RDD checkpoint) keep column pruning and filter pushdown for
    every later reader; a lost executor cannot change the stored rows."""
    spark = df.sparkSession
    path = _table_path(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _table_path(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/strata-tables/{uuid.uuid4().hex}"


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def publish_once(df, codec: str = "zstd"):
    """``materialize`` for the warehouse's large tables: as zstd, and the write's shuffle files are dropped once
    the table stands.  Nothing reads them again, yet they would stay on disk until the driver's JVM collects the plan,
    so that a query's disk would be the sum of all its shuffles and not the largest write's.  Dimensions are written
    as snappy: by their files' size the planner judges whether every task can hold them."""
    spark = df.sparkSession
    path, before = _table_path(spark), spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.mode("overwrite").option("compression", codec).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.parquet(path)
