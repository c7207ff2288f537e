"""Operator 9, sharding: Feistel permutation with cycle walking over global row numbers.

Rows get global numbers 0 .. N-1 in the order of ``order_cols``.  A balanced
Feistel network over the smallest even number of bits that holds N permutes
the numbers; a value of N or more walks on through the network until it
falls below N, so the result is a permutation of 0 .. N-1.  Place p goes to
shard ``p mod shards`` and slot ``p div shards``: shard sizes differ by one
at most, slots are gapless, and both follow from the row number, N and the seed alone.

Cases: null ids come first; rows that agree in every order column are
interchangeable, so their order does not show in the result; an empty table gives none;
input columns are carried in a struct, so they may
have any names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ptloom.operators.ordered import row_number_in_group

ROUNDS = 6
_M31 = np.int64(2**31 - 1)


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    """31-bit round keys by a linear congruential rule."""
    keys, x = [], seed & int(_M31)
    for _ in range(rounds):
        x = (x * 1103515245 + 12345) % 2**31
        keys.append(x)
    return keys


def half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _round(x: np.ndarray, key: int, mask: np.int64) -> np.ndarray:
    x = ((x ^ key) * np.int64(1540483477)) & _M31
    x ^= x >> 15
    x = (x * np.int64(668265263)) & _M31
    return (x ^ (x >> 13)) & mask


def permute(x: np.ndarray, n: int, seed: int, rounds: int = ROUNDS) -> np.ndarray:
    """The place of each row number of a table of ``n`` rows."""
    b = half_bits(n)
    mask, keys = np.int64((1 << b) - 1), round_keys(seed, rounds)
    out = np.array(x, np.int64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> b, out[todo] & mask
        for k in keys:
            left, right = right, left ^ _round(right, k, mask)
        out[todo] = (left << b) | right
        todo = todo[out[todo] >= n]
    return out


def inverse(p: np.ndarray, n: int, seed: int, rounds: int = ROUNDS) -> np.ndarray:
    """The row number at each place: what a reader of shard s, slot t (place t * shards + s) asks for."""
    b = half_bits(n)
    mask, keys = np.int64((1 << b) - 1), round_keys(seed, rounds)
    out = np.array(p, np.int64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> b, out[todo] & mask
        for k in reversed(keys):
            left, right = right ^ _round(left, k, mask), left
        out[todo] = (left << b) | right
        todo = todo[out[todo] >= n]
    return out


PLACE = T.StructType([T.StructField("row_no", T.LongType()), T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])


def shard(df: DataFrame, order_cols: list[str], *, shards: int = 8, seed: int = 42) -> DataFrame:
    """Columns ``row`` (struct of ``df``'s columns) and ``res`` (row_no, shard, slot); keep ``df`` narrow, it is sorted by ``order_cols``."""
    # rows alike in every order column are told apart by where they lie, so that they too are dealt over tasks
    keys = [f"o{i}" for i in range(len(order_cols))]
    src = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), *[df[c].alias(k) for k, c in zip(keys, order_cols)], F.monotonically_increasing_id().alias("at"))
    numbered = row_number_in_group(src, [], [*keys, "at"], out_col="row_no").select("row", F.col("row_no") - 1)
    n = df.count()

    def run(batches):
        for batch in batches:
            number = batch.column(1)
            place = permute(number.to_numpy(zero_copy_only=False), n, seed)
            res = pa.StructArray.from_arrays([number, pa.array((place % shards).astype(np.int32)), pa.array(place // shards)], names=PLACE.names)
            yield pa.RecordBatch.from_arrays([batch.column(0), res], names=["row", "res"])

    return numbered.mapInArrow(run, T.StructType([numbered.schema["row"], T.StructField("res", PLACE)]))


def op9(spark, sf_dir: str) -> DataFrame:
    """Law ``rows``: shards 0 to 7, counts at most one apart."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.coalesce(docs["text"].cast("binary"), F.lit(b""))
    narrow = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    got = shard(narrow, ["doc_id", "size", "text_crc32"])
    return got.select("row.*", F.lit("rows").alias("law"), "res.shard", "res.slot", F.lit(None).cast("int").alias("grown_shard"))


#: round keys and multipliers as above; CRC-32 by its bytewise rule
ORACLE = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)),
sized AS (
  SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295, list_transform(range(size - 1), lambda j: ('0x' || h[2 * j + 1:2 * j + 2])::BIGINT)),
         lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) AS text_crc32 FROM docs, crc_table),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS row_no, count(*) OVER () AS n FROM sized),
par AS (
  SELECT max(n) AS n, greatest(1, (length(ltrim(bin(greatest(max(n) - 1, 1)), '0')) + 1) // 2) AS b FROM numbered),
walk AS (
  SELECT row_no, (row_no >> b) AS l, (row_no & ((1 << b) - 1)) AS r, 0 AS k, b, n FROM (SELECT row_no FROM numbered), par
  UNION ALL
  SELECT row_no, l2, r2, k2, b, n FROM (
    SELECT row_no, b, n, k + 1 AS k2, r AS l2, xor(l, f) AS r2 FROM (
      SELECT *, xor(y, y >> 13) & ((1 << b) - 1) AS f FROM (
        SELECT *, (xor(x, x >> 15) * 668265263) & 2147483647 AS y FROM (
          SELECT *, (xor(r, ({round_keys(42)})[k % {ROUNDS} + 1]) * 1540483477) & 2147483647 AS x FROM walk
          WHERE k % {ROUNDS} <> 0 OR k = 0 OR ((l << b) | r) >= n)))))
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, (p % 8)::INTEGER AS shard, (p // 8)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM numbered JOIN (SELECT row_no, (l << b) | r AS p FROM walk WHERE k > 0 AND k % {ROUNDS} = 0 AND ((l << b) | r) < n) USING (row_no)
"""
