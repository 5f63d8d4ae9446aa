"""Session construction and cluster-safe checkpoint handling."""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package relies on.  On a cluster the
# submitter's values win for everything except the semantic ones
# (time zone, overwrite mode), which the package needs to be exact.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # years of article files are decided before a file is opened
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "newsgraph",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package's settings."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor
            b = b.config("spark.driver.memory", os.environ.get("NEWSGRAPH_DRIVER_MEMORY", "16g"))
    for k, v in {**DEFAULT_CONF, **SEMANTIC_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    for k, v in SEMANTIC_CONF.items():
        spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  Where it is unset,
    only a plain local session (its driver is its one executor) gets a scratch
    folder of its own; a cluster whose executors could not read it raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="newsgraph-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def materialize(df):
    """Cut lineage of a table that several later joins read: a reliable
    ``checkpoint()`` into the shared checkpoint folder (survives executor
    loss; never a machine-local checkpoint)."""
    from pyspark import StorageLevel
    ensure_checkpoint_dir(df.sparkSession)
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()


def stage_table(df, name: str):
    """Like ``materialize`` for wide tables: written as (compressed) Parquet
    into the shared checkpoint folder and read again, so that later steps read
    only the columns they need."""
    import uuid
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
