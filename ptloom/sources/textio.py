"""JSONL and CSV scans and sinks (SRC-1 .. SRC-8, SRC-10 .. SRC-12, SRC-14).

Raw text scans keep every line as an opaque string plus its file name, so the
validators can report bad lines instead of failing; the typed fast path uses a
declared schema with FAILFAST.  Sinks write UTF-8 JSON lines (non-ASCII kept,
null fields left out, i.e. absent keys).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ptloom.operators.joins import checked_broadcast
from ptloom.session import ensure_checkpoint_dir, stored_table


#: splits whose offsets are broadcast; beyond them the lines are joined by a shuffle
SPLITS_BROADCAST = 1_000_000


def read_lines(spark: SparkSession, paths: str | list[str], line_numbers: bool = False) -> DataFrame:
    """SRC-1 / SRC-5 / SRC-8: one row per line (``value``) with its ``file`` (full path) and
    ``line_key`` (sha2 of path and text), so that a bad line can be named.

    Several files are one scan (U-5); the path comes from the hidden
    ``_metadata`` column, so files of one name in two folders stay apart.
    ``line_numbers`` adds the 1-based ``line_no`` in the file: a first scan
    counts the lines of each split, a prefix sum over the splits of a file (one row
    for each) gives the lines before it, and the number is that plus the line's place in its split.
    No line is shuffled or sorted.  Both scans must cut the files alike, so the session's
    ``spark.sql.files.minPartitionNum``, where unset, is fixed to its default of now.
    """
    ps = [paths] if isinstance(paths, str) else list(paths)
    if line_numbers and not spark.conf.get("spark.sql.files.minPartitionNum", None):
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    # folders are read as they are: a folder's name is part of the path, not a column
    df = spark.read.option("recursiveFileLookup", "true").text(ps).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_start"))
    if not line_numbers:
        return df.select("value", "file", F.sha2(F.concat_ws("\n", "file", "value"), 256).alias("line_key"))
    df = df.withColumn("_at", F.monotonically_increasing_id())
    splits = df.groupBy("file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    w = Window.partitionBy("file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    before = stored_table(splits.select("file", "_start", "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before")))
    j = df.join(checked_broadcast(before, SPLITS_BROADCAST), ["file", "_start"], "left")
    lost = F.raise_error("the files were cut into other splits by the second scan")
    return j.select("value", "file", F.sha2(F.concat_ws("\n", "file", "value"), 256).alias("line_key"),
                    F.when(F.col("_before").isNull(), lost).otherwise(F.col("_before") + F.col("_at") - F.col("_first") + 1).cast("bigint").alias("line_no"))


def read_jsonl_typed(spark: SparkSession, paths: str | list[str], schema: StructType | str) -> DataFrame:
    """SRC-2: typed JSONL read that fails on the first bad line (FAILFAST)."""
    ps = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(ps)


def missing_paths(spark: SparkSession, paths: list[str]) -> DataFrame:
    """SRC-7: report rows (path, 'file_missing') for paths that do not exist.

    Only file-system metadata is touched, on the driver, through Hadoop's
    FileSystem API (works for any cluster file system).
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    rows = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if not hp.getFileSystem(conf).exists(hp):
            rows.append((p, "file_missing"))
    return spark.createDataFrame(rows, "path string, rule string")


def write_jsonl(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """SRC-6 / SRC-12: JSON lines; with ``partition_by`` one folder per value (e.g. split)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


#: Spark's setting of the folders that a writing task keeps open
OPEN_FOLDERS = "spark.sql.maxConcurrentOutputFileWriters"
#: lines of one compressed file, which is read by one task
LINES_PER_GZIP = 100_000


def write_text_lines(df: DataFrame, value_col: str, path: str, partition_by: list[str] | None = None,
                     mode: str = "overwrite", compression: str | None = None, open_folders: int = 0) -> None:
    """Write already-serialised lines as they are (one ``value`` per line).

    With ``compression`` (a codec that Spark's text scan tells by the file name, as ``gzip``) no file has more than ``LINES_PER_GZIP`` lines.
    Where ``partition_by`` has few values, a task may keep files in ``open_folders`` of them open, so that whole lines are not sorted by
    folder first; the lines of more folders are sorted, and then lose their order."""
    cols = [F.col(value_col).alias("value")] + [F.col(c) for c in (partition_by or [])]
    w = df.select(*cols).write.mode(mode)
    if compression:
        # the texts repeat themselves, which the quickest level finds too
        w = w.option("compression", compression).option("maxRecordsPerFile", LINES_PER_GZIP).option("zlib.compress.level", "BEST_SPEED")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if not open_folders:
        return w.text(path)
    conf = df.sparkSession.conf
    before = conf.get(OPEN_FOLDERS)
    conf.set(OPEN_FOLDERS, str(open_folders))
    try:
        w.text(path)
    finally:
        conf.set(OPEN_FOLDERS, before)


def write_token_shards(ids: DataFrame, path: str, order_col: str = "doc_id", n_shards: int | None = None) -> None:
    """SRC-10: token-id shards as Parquet ``(doc_id, ids array<int>)``, range-partitioned
    on the document id so each shard holds a contiguous id range."""
    n = n_shards or max(1, ids.sparkSession.sparkContext.defaultParallelism)
    ids.repartitionByRange(n, order_col).sortWithinPartitions(order_col).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """SRC-11: a training-curve CSV with a declared schema (no inference)."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def as_text_lines(df: DataFrame, line: "F.Column", keep: list[str] | None = None) -> DataFrame:
    """Serialised records as a ``value`` column, the way a text scan delivers them.

    The text is emitted by a generator (``explode`` of a one-element array):
    predicates on ``value`` (blank-line skipping, validators) then stay above
    it instead of being pushed down with the serialisation inlined into them,
    which would compute every line twice.
    """
    return df.select(*(keep or []), F.explode(F.array(line)).alias("value"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's (shared) checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/ptloom-io/{name}-{uuid.uuid4().hex}"
