"""Operator 7, token counts: separator scan of flat unindexed token files.

A token file is nothing but token ids of fixed width; documents end at an
end-of-document id, and a document may run across blocks and files.  Each
block (``block_tokens`` ids, a byte range of its file, read alone by whichever
task it is dealt to) is searched for the separator at once and gives
its length and the places of its separators.  Two prefix scans, over the
blocks of a file and over files (one row each), give every block the number
of tokens and documents before it and where the document open at its start
began; so each document's start and length follow without reading a block
twice.  Files are ordered by the number in their name, then by path.

``write`` makes such files: one row of token bytes for each document, in the
order of ``order_cols``, with the separator's bytes as the line end.

Cases: a document without tokens counts 0; tokens after the last separator
are a document; no tokens at all give none; repeated and null rows are
documents like any other; extra columns are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ptloom.llm import arrays, rows
from ptloom.session import ensure_checkpoint_dir

EOD = 50256
BLOCK_TOKENS = 1 << 20


def word_ids(docs: DataFrame, order_cols: list[str], *, text_col: str = "text") -> DataFrame:
    """Token bytes of each document: a 16-bit id below the separator's for each word, by its hash."""
    def fn(texts, _):
        out = []
        for lo, hi in arrays.chunks(texts):
            words = arrays.Words(texts[lo:hi], arrays.NOT_SPACE)
            ids = (words.hashes % np.uint64(EOD)).astype("<u2")
            out += [ids[words.first[i]:words.first[i + 1]].tobytes() for i in range(hi - lo)]
        return {"tokens": out}

    got = rows.map_texts(docs, text_col, fn, T.StructType([T.StructField("tokens", T.BinaryType(), False)]), row=order_cols)
    return got.select(*[F.col(f"row.{c}") for c in order_cols], "res.tokens")


def write(tokens: DataFrame, path: str, order_cols: list[str], *, eod: int = EOD) -> str:
    """Flat 16-bit little-endian files of the rows' token bytes in order, each row ended by the separator."""
    n = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    end = int(eod).to_bytes(2, "little").decode("latin-1")
    # ties by a hash: what the range partitioner samples stays small
    (tokens.withColumn("tie", F.xxhash64("tokens")).repartitionByRange(n, *order_cols, "tie").sortWithinPartitions(*order_cols, "tie").select(F.col("tokens").cast("string").alias("value"))
        .write.option("encoding", "ISO-8859-1").option("lineSep", end).text(path))
    return path


_BLOCK = T.StructType([T.StructField("file", T.StringType()), T.StructField("block", T.LongType()), T.StructField("n_tokens", T.LongType()),
                       T.StructField("ends", T.ArrayType(T.LongType(), False))])


#: file systems whose files Python workers read by byte ranges (only ``file`` is tried here); others give whole files
RANGED = ("file", "hdfs", "viewfs", "s3", "gs")


def read_range(path: str, at: int, n: int) -> bytes:
    """``n`` bytes of a file from ``at`` on, or as many as there are."""
    from pyarrow import fs

    system, name = (fs.LocalFileSystem(), "/" + path[5:].lstrip("/")) if path.startswith("file:") else fs.FileSystem.from_uri(path)
    with system.open_input_file(name) as f:
        f.seek(at)
        return f.read(n)


def searched(spark, path: str, *, eod: int = EOD, dtype: str = "<u2", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Per block of the files: ``file``, ``block``, ``n_tokens`` and the places of the separators; a task holds one block at a time."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    size = block_tokens * np.dtype(dtype).itemsize
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    ranged = target.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() in RANGED

    def found(name, block, ids):
        return rows.table(_BLOCK, [(name, block, len(ids), np.flatnonzero(ids == eod))]).to_batches()

    def run(batches):
        for batch in batches:
            for name, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield from found(name, block, np.frombuffer(read_range(name, block * size, size), dtype))

    def whole(batches):
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(data.as_buffer(), dtype)
                for b in range(0, len(ids), block_tokens):
                    yield from found(name, b // block_tokens, ids[b:b + block_tokens])

    if not ranged:
        return files.select("path", "content").mapInArrow(whole, _BLOCK)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = files.where("length > 0").select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / size).cast("long"))).alias("block"))
    return ranges.repartition(n, "path", "block").mapInArrow(run, _BLOCK)


def scan(spark, path: str, *, eod: int = EOD, dtype: str = "<u2", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Per document of the files: ``doc_no``, ``start`` (token number in the stream) and ``n_tokens``."""
    number = F.coalesce(F.try_element_at(F.regexp_extract_all("file", F.lit(r"part-(\d+)"), 1), F.lit(-1)).cast("long"), F.lit(0))
    blocks = searched(spark, path, eod=eod, dtype=dtype, block_tokens=block_tokens).withColumn("number", number)
    # prefix scan inside each file; an end lies after the separator
    before = Window.partitionBy("number", "file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first, docs = F.coalesce(F.sum("n_tokens").over(before), F.lit(0)), F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0))
    local = blocks.withColumn("first", first).withColumn("docs", docs)
    local = local.withColumn("last", F.when(F.size("ends") > 0, F.col("first") + F.element_at("ends", -1) + 1))
    local = local.withColumn("open", F.max("last").over(before))
    # prefix scan over files, of one row each
    total = blocks.groupBy("number", "file").agg(F.sum("n_tokens").alias("tokens"), F.sum(F.size("ends")).alias("docs"))
    ended = local.groupBy("number", "file").agg(F.max("last").alias("last"))
    over = Window.orderBy("number", "file").rowsBetween(Window.unboundedPreceding, -1)
    total = total.join(ended, ["number", "file"]).withColumn("file_first", F.coalesce(F.sum("tokens").over(over), F.lit(0))) \
        .withColumn("file_docs", F.coalesce(F.sum("docs").over(over), F.lit(0)))
    total = total.withColumn("file_open", F.coalesce(F.max(F.col("file_first") + F.col("last")).over(over), F.lit(0)))
    placed = local.join(total.select("number", "file", "file_first", "file_docs", "file_open"), ["number", "file"])
    start = F.col("file_first") + F.col("first")
    ends = F.transform("ends", lambda e: e + start)
    starts = F.concat(F.array(F.coalesce(F.col("file_first") + F.col("open"), F.col("file_open"))), F.transform(ends, lambda e: e + 1))
    docs = placed.select((F.col("file_docs") + F.col("docs")).alias("base"), F.posexplode(F.arrays_zip(F.slice(starts, F.lit(1), F.size("ends")).alias("a"), ends.alias("b"))).alias("i", "d"))
    found = docs.select((F.col("base") + F.col("i")).cast("long").alias("doc_no"), F.col("d.a").alias("start"), (F.col("d.b") - F.col("d.a")).alias("n_tokens"))
    rest = total.agg(F.sum("docs").alias("doc_no"), F.coalesce(F.max(F.col("file_first") + F.col("last")), F.lit(0)).alias("start"), F.sum("tokens").alias("all"))
    tail = rest.where("all > start").select("doc_no", "start", (F.col("all") - F.col("start")).alias("n_tokens"))
    return found.unionByName(tail)


def op7(spark, sf_dir: str) -> DataFrame:
    """Writes the words of all documents as token files to the shared folder, then counts them from the files alone."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    return scan(spark, write(word_ids(docs, ["doc_id"]), path, ["doc_id"]))


ORACLE = r"""
WITH counted AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens FROM documents)
SELECT row_number() OVER w - 1 AS doc_no, (sum(n_tokens + 1) OVER w - n_tokens - 1)::BIGINT AS start, n_tokens
FROM counted WINDOW w AS (ORDER BY doc_id ROWS UNBOUNDED PRECEDING)
"""
