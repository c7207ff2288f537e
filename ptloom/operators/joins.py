"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# a side up to this many rows is broadcast; above it the join is left to
# Catalyst (sort-merge or shuffle-hash), so a side that grows with the data
# never ends up copied to every executor
BROADCAST_ROWS = 200_000


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` when it has at most ``max_rows`` rows, else ``df`` as is.

    The check is an action that stops above the limit; use it on small
    narrow tables that are stored or cheap to derive (vocabularies, per-group totals, offsets), not on a large input.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
