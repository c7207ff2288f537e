"""Spark helpers: per-row passes, and two-sided exchange between cells of documents and buckets of hashes.

A *cell* is a hash-dealt part of the documents, a *bucket* a hash-dealt part
of a key space (anchors, chunk digests, prefix tokens).  A cell sends each
bucket one row with the distinct hashes it holds, packed; the bucket answers
each cell with the hashes that matter.  A key that a third of all documents
hold is one entry per cell at most, so no group grows with the number of
copies, and the two counts follow ``spark.sql.shuffle.partitions``.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: an id that is null sorts after every other one
NULL_ID = np.int64(2**63 - 1)


#: bytes of texts and list items that a task turns into Python objects at a time
SLICE = 4 << 20


def sliced(batches, within: int | None = None):
    """The batches in slices of about ``SLICE`` bytes (one row at least), whatever the sizes of their rows.

    ``within`` names a field of the first column, a struct, that counts too.
    """
    for batch in batches:
        weight = np.zeros(batch.num_rows, np.int64)
        for col in [*batch.columns, *([batch.column(0).flatten()[within].cast(pa.binary())] if within is not None else [])]:
            if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type):
                weight += pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            elif pa.types.is_list(col.type) or pa.types.is_large_list(col.type):
                weight += 8 * pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(weight) - weight) // SLICE
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(edges[:-1], edges[1:]):
            if hi > lo:
                yield batch.slice(lo, hi - lo)


def map_texts(df: DataFrame, text: Column | str, fn: Callable[[list, dict], dict], result: T.StructType,
              row: list[str] | None = None, extra: dict[str, Column] | None = None) -> DataFrame:
    """Narrow pass: ``fn(texts, extra columns)`` gives the result columns of the rows of a batch.

    Returns the columns ``row`` (struct of the input columns named, all by
    default) and ``res`` (struct of ``result``), so an input column may bear
    the name of a result column.  Texts reach ``fn`` as bytes, null as None;
    a text column that is in ``row`` travels once.
    """
    names = row if row is not None else df.columns
    extra = extra or {}
    within = names.index(text) if isinstance(text, str) and text in names and df.schema[text].dataType in (T.StringType(), T.BinaryType()) else None
    text = df[text] if isinstance(text, str) else text
    src = df.select(F.struct(*([df[c] for c in names] or [F.lit(0).alias("_")])).alias("row"),
                    (F.lit(None) if within is not None else text).cast("binary").alias("text"), *[c.alias(f"x_{k}") for k, c in extra.items()])
    keys = list(extra)
    schema = T.StructType([src.schema["row"], T.StructField("res", result, False)])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        kind = to_arrow_schema(schema)
        out = kind.field("res").type
        for batch in sliced(batches, within):
            texts = batch.column(1) if within is None else batch.column(0).flatten()[within].cast(pa.binary())
            got = fn(texts.to_pylist(), {k: batch.column(i + 2).to_pylist() for i, k in enumerate(keys)})
            res = pa.StructArray.from_arrays(
                [x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, f.type) for f, x in ((f, got[f.name]) for f in out)], fields=list(out))
            yield pa.RecordBatch.from_arrays([batch.column(0), res], names=["row", "res"])
        pa.default_memory_pool().release_unused()  # the worker stays, for other stages

    return src.mapInArrow(run, schema)


def parts(df: DataFrame) -> tuple[int, int]:
    """Numbers of cells and buckets: they follow the shuffle partitions, which are sized to the input.

    A cell sends a bucket one row, so there are fewer rows than hashes.
    """
    n = max(4, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return 2 * n, n


def in_cells(df: DataFrame, id_col: str, text_col: str, n: int, row: list[str] | None = None) -> DataFrame:
    """Columns ``cell``, ``row``, ``id`` (long; null as the greatest) and ``text`` (binary; null as empty)."""
    names = row if row is not None else df.columns
    ident = F.coalesce(df[id_col].cast("long"), F.lit(int(NULL_ID)))
    text = F.coalesce(df[text_col].cast("binary"), F.lit(b""))
    return df.select(F.pmod(F.xxhash64(ident, text), F.lit(n)).cast("int").alias("cell"), F.struct(*[df[c] for c in names]).alias("row"),
                     ident.alias("id"), text.alias("text"))


def by_bucket(hashes: np.ndarray, n: int) -> np.ndarray:
    """Bucket of each hash, from its high bits."""
    return ((hashes >> np.uint64(32)) % np.uint64(n)).astype(np.int32)


def packed(bucket: np.ndarray, n: int, columns: list[np.ndarray]) -> list[tuple[int, list[bytes]]]:
    """The columns of each bucket that has rows, as bytes; ``bucket`` holds 0 to n - 1."""
    order = np.argsort(bucket, kind="stable")
    bounds = np.concatenate(([0], np.cumsum(np.bincount(bucket, minlength=n))))
    cols = [c[order] for c in columns]
    return [(b, [c[bounds[b]:bounds[b + 1]].tobytes() for c in cols]) for b in np.flatnonzero(np.diff(bounds)).tolist()]


def joined(blobs: list[bytes], dtype) -> np.ndarray:
    """The packed columns of several rows as one array."""
    return np.frombuffer(b"".join(blobs), dtype)


def table(schema: T.StructType, rows: list[tuple] | None = None, columns: list | None = None) -> pa.Table:
    """An Arrow table of the Spark schema, from rows or from columns."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = to_arrow_schema(schema)
    cols = columns if columns is not None else ([list(x) for x in zip(*rows)] if rows else [[] for _ in kind])
    return pa.Table.from_arrays([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for c, f in zip(cols, kind)], schema=kind)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the session's shared checkpoint folder and read from there."""
    import uuid

    from ptloom.session import ensure_checkpoint_dir

    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
