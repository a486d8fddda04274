"""Lookup-side helpers: broadcast only behind a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows up to which a lookup table is broadcast; beyond it the join shuffles.
DEFAULT_BROADCAST_ROWS = 100_000


def small_side(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` when it has at most ``max_rows`` rows, else ``df``.

    The check is one count over the lookup table (a registry, a list of
    destinations): cheap, and it bounds what every executor must hold. Over
    the bound Spark plans a shuffle join, and AQE may still broadcast once
    the real size is known.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
