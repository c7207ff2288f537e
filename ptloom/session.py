"""Session helpers.

Library code never builds its own session; it works with whatever session the
caller passes.  ``local_session`` is for tests and the bench only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


# JSON semantics of Python's json.loads: a repeated key is accepted and the last
# value wins (Spark's variant parser rejects duplicates unless this is on).
RECOMMENDED_SQL_CONF = {"spark.sql.variant.allowDuplicateKeys": "true"}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ptloom") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("PTLOOM_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ptloom.scanPartitions", os.environ.get("PTLOOM_SCAN_PARTITIONS", "8"))
        .getOrCreate()
    )
    for k, v in RECOMMENDED_SQL_CONF.items():
        spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only an unconfigured local session gets a fresh scratch folder; on
    a cluster an unset folder is an error, since a driver-local path is not
    shared with the executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="ptloom-ckpt-")
    sc.setCheckpointDir(path)
    return path


def reliable_checkpoint(df):
    """``df.checkpoint(eager=True)`` to the session's checkpoint folder, computing ``df`` once.

    A reliable checkpoint writes the data in a second job after the first
    one computed it; persisting first lets the write reuse the computed
    blocks instead of re-running the lineage.  Never ``localCheckpoint``:
    its blocks die with the executor.
    """
    from pyspark import StorageLevel

    ensure_checkpoint_dir(df.sparkSession)
    p = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return p.checkpoint(eager=True)
    finally:
        p.unpersist()


def ship_package(spark: SparkSession) -> None:
    """The package on the Python workers' path, for functions that run there (a no-op where it is installed)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def stored_table(df):
    """``df`` written once as Parquet to the session's shared checkpoint folder and read from there."""
    import uuid

    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/ptloom-table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
