"""Session construction and the shared checkpoint folder.

On a cluster the session is created by the platform; we only read
``spark.checkpoint.dir`` from it.  A local folder is set only when the
setting is absent (tests, local benches).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

_LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def get_session(cpus: str | int = "*", shuffle_partitions: int = 8,
                driver_memory: str = "16g", app: str = "tidalrec") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in _LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = (builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    Reads ``spark.checkpoint.dir``; only when it is unset (local runs) a
    scratch folder is created and recorded in the session.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tidalrec-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_costly_lineage(df: DataFrame) -> DataFrame:
    """``cut_lineage`` of rows too costly to compute twice: cached while they are written, released after.

    A cache that the caller holds on ``df`` stays.
    """
    if is_stored(df):
        return cut_lineage(df)
    held = df.persist()
    try:
        return cut_lineage(held)
    finally:
        held.unpersist()


def is_stored(df: DataFrame) -> bool:
    level = df.storageLevel
    return level.useMemory or level.useDisk
