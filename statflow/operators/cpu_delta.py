"""Batch CPU enrichment: snapshots → per-CPU utilisation.

Input: snapshot rows (``hostname``, ``timestamp``, ``cpus`` and the order
columns). Output, one row per snapshot that has a previous snapshot of the
same host: ``hostname, timestamp, time_delta_ms, cpu_metrics``. Rows with no
CPU left keep ``cpu_metrics = []`` (F5, E9).

"Previous" is the previous *snapshot* of the host in arrival order, not the
previous sighting of a CPU: a CPU missing from the immediately preceding
snapshot is skipped even if it appeared earlier.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statflow.functions.counters import host_key, metrics_record
from statflow.operators.previous import offset_bucket, time_bucket, with_previous

# Default arrival order for batch input: time, then a tie-breaker column.
DEFAULT_ORDER = ("timestamp", "src_offset")
# One hour of epoch milliseconds: the default width of the stitching buckets.
DEFAULT_BUCKET_MS = 3_600_000
# Offsets per bucket for broker order (offsets are dense within a partition).
DEFAULT_BUCKET_ROWS = 1 << 20


def default_bucket(order: Sequence[str], bucket_ms: int = DEFAULT_BUCKET_MS) -> Column | str:
    """Bucket for an order: time buckets for ``(timestamp, …)``, offset
    ranges for broker order ``(src_partition, src_offset)``, else sized from
    the data (``"auto"``)."""
    order = list(order)
    if order[0] == "timestamp":
        return time_bucket("timestamp", bucket_ms)
    if order == ["src_partition", "src_offset"]:
        return offset_bucket("src_partition", "src_offset", DEFAULT_BUCKET_ROWS)
    return "auto"


def pair_with_previous(
    snapshots: DataFrame,
    order: Sequence[str] = DEFAULT_ORDER,
    bucket: Column | str | None = None,
    bucket_ms: int = DEFAULT_BUCKET_MS,
) -> DataFrame:
    """Prune to what the delta needs, default the key, attach ``prev``.

    ``bucket``: an explicit bucket column, ``"auto"`` (sized from the data,
    for unknown key skew), or None for time buckets of ``bucket_ms``.

    Only ``timestamp`` and ``cpus`` of the previous snapshot are carried
    (the reference keeps the whole snapshot as state).
    """
    order = list(order)
    keep = ["hostname", "timestamp", "cpus"] + [c for c in order if c not in ("hostname", "timestamp", "cpus")]
    rows = snapshots.select(*[host_key().alias("hostname") if c == "hostname" else F.col(c) for c in keep])
    if bucket is None:
        bucket = default_bucket(order, bucket_ms)
    return with_previous(rows, "hostname", order, ["timestamp", "cpus"], bucket)


def enrich(
    snapshots: DataFrame,
    order: Sequence[str] = DEFAULT_ORDER,
    bucket: Column | str | None = None,
    bucket_ms: int = DEFAULT_BUCKET_MS,
) -> DataFrame:
    """Snapshots → metrics rows ``hostname, timestamp, time_delta_ms, cpu_metrics``."""
    paired = pair_with_previous(snapshots, order, bucket, bucket_ms)
    return paired.where(F.col("prev").isNotNull()).select(F.col("hostname"), *metrics_record("prev"))


def explode_metrics(metrics: DataFrame) -> DataFrame:
    """One row per (snapshot, CPU): the flat form used for SQL comparison."""
    return metrics.select(
        "hostname",
        "timestamp",
        "time_delta_ms",
        F.inline(F.col("cpu_metrics")),
    )


def sink_projection(metrics: DataFrame) -> DataFrame:
    """The strict three-field record the reference emits (drops the host)."""
    return metrics.select("timestamp", "time_delta_ms", "cpu_metrics")
