"""Driver tables (Parquet, one file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# dimension tables stay as scanned (a handful of rows)
DIMENSIONS = {"region", "nation", "supplier"}


#: partitions that a session asks table scans to be dealt into (unset: as the file splits give)
SCAN_PARTITIONS = "spark.ptloom.scanPartitions"


def dealt(df: DataFrame) -> DataFrame:
    """``df`` dealt round-robin into as many partitions as the session asks for, as scanned otherwise.

    For local runs on tables of one row group, where a scan is one task.  The
    number is a setting; nothing is executed or inspected to find it.
    """
    n = df.sparkSession.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(n)) if n else df


class Tables:
    """Lazy accessor: ``Tables(spark, dir).orders`` is a DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            df = read_table(self.spark, self.sf_dir, name)
            return df if name in DIMENSIONS else dealt(df)
        raise AttributeError(name)
