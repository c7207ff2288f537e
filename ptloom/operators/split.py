"""Deterministic splits without leaks (L-1 .. L-6, J-6, U-4).

Everything orders by ``md5(seed|key)``: stable when rows are added, equal on
any cluster layout and reproducible in SQL.  ``rand(seed)`` is never used.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ptloom import constants as K
from ptloom.functions.hashing import ratio_threshold_hex, seeded_hex
from ptloom.operators.ordered import join_null_safe, row_number_in_group
from ptloom.operators.scan import segmented_scan
from ptloom.session import reliable_checkpoint


def seeded_order_key(key_col: str, seed: int = K.SEED) -> F.Column:
    return seeded_hex(F.col(key_col).cast("string"), seed=seed)


def hash_split(df: DataFrame, key_col: str, ratio: float, seed: int = K.SEED,
               out_col: str = "split", names: tuple[str, str] = ("train", "val")) -> DataFrame:
    """L-5: group-safe split — every row of a key lands on the same side. Narrow."""
    h = F.substring(seeded_order_key(key_col, seed), 1, 8)
    return df.withColumn(out_col, F.when(h < F.lit(ratio_threshold_hex(ratio)), names[1]).otherwise(names[0]))


def seeded_shuffle(df: DataFrame, key_col: str, seed: int = K.SEED, pos_col: str | None = None) -> DataFrame:
    """L-1: deterministic permutation (total order md5(seed|key), key).

    ``pos_col`` adds each row's place in it, from 1, by a scan that cuts the order into partitions."""
    d = df.withColumn("_ord", seeded_order_key(key_col, seed))
    if pos_col:
        return segmented_scan(d, [], ["_ord", key_col], ordinal=pos_col).drop("_ord")
    return d.orderBy("_ord", key_col).drop("_ord")


def head(df: DataFrame, order_cols: list[str], n: int) -> DataFrame:
    """L-6 / SRC-14: first n rows by a total order (TakeOrdered: top-n per partition, then merge)."""
    return df.orderBy(*order_cols).limit(n)


def val_count(n: int, ratio: float, rounding: str) -> int:
    """Size of the validation side: max(1, round(n*ratio)) (half-even) or max(1, int(n*ratio))."""
    if not 0 < ratio < 1:
        raise ValueError("ratio must be between 0 and 1")
    x = n * ratio
    return max(1, round(x) if rounding == "half_even" else int(x))


def _boundary(hist: list[tuple[str, int]], k: int) -> tuple[str | None, int]:
    """First bucket where the running count reaches k, and how many rows of it are needed."""
    before = 0
    for bucket, cnt in sorted(hist):
        if before + cnt >= k:
            return bucket, k - before
        before += cnt
    return None, 0


def exact_split(df: DataFrame, key_col: str, ratio: float, rounding: str = "half_even",
                seed: int = K.SEED, out_col: str = "split") -> DataFrame:
    """L-2 / L-3: exactly ``val_count`` rows go to ``val``; the first ones in the
    total order (md5(seed|key), key), as ``row_number() over (order by ..) <= k``.

    No global window: a 4-hex-digit histogram (≤ 65,536 rows) locates the
    boundary bucket, a second histogram inside it narrows to an 8-digit bucket,
    whose few distinct keys are counted to find the tie group.  Rows of the tie
    group (same key) are interchangeable; the needed number of them is taken
    by a skew-safe row number over a checkpointed salt, so even a key holding a
    third of all rows is split across tasks.
    """
    d = df.withColumn("_m", seeded_order_key(key_col, seed))
    # the boundary search reads only (key, md5): persist that narrow projection once
    narrow = d.select(key_col, "_m").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        h1 = [(r[0], r[1]) for r in narrow.groupBy(F.substring("_m", 1, 4)).count().collect()]
        n = sum(c for _, c in h1)
        if n < 2:
            raise ValueError("need at least 2 rows to split")
        k = val_count(n, ratio, rounding)
        p1, need1 = _boundary(h1, k)
        h2 = [(r[0], r[1]) for r in
              narrow.where(F.substring("_m", 1, 4) == p1).groupBy(F.substring("_m", 5, 4)).count().collect()]
        p2, need2 = _boundary(h2, need1)
        b8 = p1 + p2
        keys = narrow.where(F.substring("_m", 1, 8) == b8).groupBy("_m", key_col).count().collect()
    finally:
        narrow.unpersist()
    # null keys come first inside a hash, as everywhere below
    keys = sorted(((r[0], r[1], r[2]) for r in keys), key=lambda x: (x[0], x[1] is not None, x[1] if x[1] is not None else 0))
    m_star, key_star, before = None, None, 0
    for m, key, cnt in keys:
        if before + cnt >= need2:
            m_star, key_star, need_tie, tie_size = m, key, need2 - before, cnt
            break
        before += cnt
    key = F.col(key_col)
    below = F.lit(False) if key_star is None else F.coalesce(key < F.lit(key_star), F.lit(True))
    lt = (F.col("_m") < F.lit(m_star)) | ((F.col("_m") == F.lit(m_star)) & below)
    is_tie = (F.col("_m") == F.lit(m_star)) & key.eqNullSafe(F.lit(key_star))
    if need_tie >= tie_size:  # always so for unique keys: one narrow pass
        return d.withColumn(out_col, F.when(lt | is_tie, "val").otherwise("train")).drop("_m")
    rest = d.where(~is_tie).withColumn(out_col, F.when(lt, "val").otherwise("train"))
    salted = reliable_checkpoint(d.where(is_tie)).withColumn("_salt", F.monotonically_increasing_id())
    tie = row_number_in_group(salted, [], ["_salt"], out_col="_rn").withColumn(
        out_col, F.when(F.col("_rn") <= need_tie, "val").otherwise("train")
    ).drop("_salt", "_rn")
    return rest.unionByName(tie).drop("_m")


def split_check(split_df: DataFrame, input_df: DataFrame, key_col: str, split_col: str = "split") -> DataFrame:
    """J-6 / U-4: sizes, keys on both sides, and rows lost or invented, as
    (metric, value) — a partition gives overlap 0, lost 0, extra 0.

    One group-by of the key counts its rows in the input and on each side
    (multiset semantics; null is a key)."""
    side = F.col(split_col)
    both = input_df.select(F.col(key_col).alias("k"), F.lit(1).alias("i"), F.lit(0).alias("t"), F.lit(0).alias("v"), F.lit(0).alias("o")).unionByName(
        split_df.select(F.col(key_col).alias("k"), F.lit(0).alias("i"), F.coalesce((side == "train").cast("int"), F.lit(0)).alias("t"),
                        F.coalesce((side == "val").cast("int"), F.lit(0)).alias("v"), F.lit(1).alias("o")))
    n = both.groupBy("k").agg(*[F.sum(c).alias(c) for c in "itvo"])
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    m = n.agg(total("t").alias("n_train"), total("v").alias("n_val"), total(((F.col("t") > 0) & (F.col("v") > 0)).cast("int")).alias("n_overlap_keys"),
              total(F.greatest(F.col("i") - F.col("o"), F.lit(0))).alias("n_lost"), total(F.greatest(F.col("o") - F.col("i"), F.lit(0))).alias("n_extra"))
    return m.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in m.columns])).alias("x")).select("x.*")


def contiguous_split(df: DataFrame, group_col: str, order_col: str, length_col: str,
                     ratio: float = 0.9, out_col: str = "split") -> DataFrame:
    """L-4: per group, rows whose preceding cumulative length is below ``ratio`` of
    the group total are train, the rest val (a cut by position, not by hash).

    The running sum is a skew-safe scan; the group totals come from its result,
    so the input is not read again for them, and are one row per group.
    """
    d = df.withColumn("_len", F.coalesce(F.col(length_col), F.lit(0)).cast("bigint"))
    cum = segmented_scan(d, [group_col], [order_col], total={"_before": "_len"})
    totals = cum.groupBy(group_col).agg(F.sum("_len").alias("_total"))
    j = join_null_safe(cum, totals, [group_col])
    return j.withColumn(
        out_col, F.when(F.col("_before") < F.lit(ratio) * F.col("_total"), "train").otherwise("val")
    ).drop("_before", "_total", "_len")


__all__ = [
    "hash_split", "seeded_shuffle", "head", "val_count", "exact_split", "split_check", "contiguous_split",
]
