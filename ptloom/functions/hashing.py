"""Seeded, partition-independent pseudo random numbers (FN-15, L-1, L-5).

Everything is derived from ``md5(concat_ws('|', seed, parts...))`` so that the
same value comes out on any cluster layout and in any SQL engine that has
md5; ``rand(seed)`` is never used because it depends on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SEED = 42


def seeded_hex(*parts: Column | str, seed: int = DEFAULT_SEED) -> Column:
    cols = [F.lit(str(seed))] + [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws("|", *cols))


def hex8_to_long(hexcol: Column, start: int = 1) -> Column:
    """Unsigned value of 8 hex digits starting at 1-based ``start`` (0 .. 2^32-1)."""
    return F.conv(F.substring(hexcol, start, 8), 16, 10).cast("bigint")


def seeded_hash(*parts: Column | str, seed: int = DEFAULT_SEED, start: int = 1) -> Column:
    return hex8_to_long(seeded_hex(*parts, seed=seed), start)


def ratio_threshold_hex(ratio: float) -> str:
    """8 hex digits t such that md5-prefix < t holds for a ``ratio`` share of keys."""
    if not 0.0 <= ratio <= 1.0:
        raise ValueError("ratio must be in [0, 1]")
    v = min(int(ratio * (1 << 32)), (1 << 32) - 1) if ratio < 1.0 else (1 << 32) - 1
    return format(v, "08x")
