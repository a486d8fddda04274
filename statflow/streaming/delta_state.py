"""Keyed state for the stream: previous snapshot per host.

Two forms of the same operator: ``applyInPandasWithState`` (default; plans
in ~0.2 s per micro-batch) and ``transformWithStateInPandas`` (``api="tws"``;
its driver-side set-up costs ~1.4 s per micro-batch here).

Only the pairing needs Python: the processor attaches to each snapshot the
previous snapshot of its host (from state, or from the same micro-batch) and
keeps the newest one as state. Deltas and percentages are computed after it
with the native column expressions shared with the batch path, so batch and
stream give the same rows.

State per host: ``timestamp`` and ``cpus`` only (the reference keeps the whole
snapshot). No TTL, as in the reference (A4); pass ``ttl_ms`` to expire idle
hosts. Rows of one host inside a micro-batch may come in several chunks and
in any order after the shuffle, so they are gathered and sorted by the order
columns first (A8).

With ``group_state`` a call of Python serves a bucket of hosts (``BUCKETS``, by a
hash of the name), not one host, since a call costs about as much as hundreds of
rows; the bucket's state lists its hosts. A bucket that gets rows has its state
written anew, so give many millions of hosts more buckets (fixed at the first
start, as the state partitions are). CPU arrays go through Python as one JSON
string each, never as dicts.

Memory: the rows of one bucket and micro-batch are held together in a Python
worker for that sort, some 1.5 kB a row. With a very hot key (all hosts ``unknown``)
bound the micro-batch at the source (``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``),
or use ``delta_runs`` or ``delta_batchwise``, which split a hot key across tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from statflow.functions.counters import host_key, metrics_record
from statflow.schemas import CPU, CPU_COUNTERS

CPU_FIELDS = ("id",) + CPU_COUNTERS
PREV = T.StructType(
    [T.StructField("timestamp", T.LongType(), True), T.StructField("cpus", T.ArrayType(CPU, True), True)]
)


def _seq(x) -> list:
    # Arrow hands arrays over as numpy arrays (no truth value), state as lists.
    return [] if x is None else list(x)


def _as_tuples(cpus) -> list[tuple]:
    out = []
    for c in _seq(cpus):
        if isinstance(c, dict):
            out.append(tuple(c[f] for f in CPU_FIELDS))
        else:
            out.append(tuple(c))
    return out


def _as_dicts(cpus) -> list[dict]:
    return [dict(zip(CPU_FIELDS, tuple(c.values()) if isinstance(c, dict) else tuple(c))) for c in _seq(cpus)]


class PreviousSnapshot(StatefulProcessor):
    """Emit each snapshot with ``prev = struct(timestamp, cpus)`` of the
    previous snapshot of the same host in arrival order (null for the first)."""

    def __init__(self, order: Sequence[str], ttl_ms: int | None = None):
        self.order = list(order)
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("previous", PREV, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True)
        pdf = pdf.sort_values(self.order, kind="stable").reset_index(drop=True)
        if self.state.exists():
            ts, cpus = self.state.get()
            first = {"timestamp": ts, "cpus": _as_dicts(cpus)}
        else:
            first = None
        stamps = pdf["timestamp"].tolist()
        # The CPU arrays pass through as Arrow handed them over; only the one
        # value kept as state is converted.
        cpu_lists = pdf["cpus"].tolist()
        prevs = [first] + [{"timestamp": t, "cpus": c} for t, c in zip(stamps[:-1], cpu_lists[:-1])]
        self.state.update((int(stamps[-1]), _as_tuples(cpu_lists[-1])))
        pdf["prev"] = prevs
        yield pdf

    def close(self) -> None:
        pass


#: Buckets of hosts that share a call of Python and a state row.
BUCKETS = 1 << 14
#: Rows handed back to Spark at once.
CHUNK = 10_000
LAST = "hosts array<string>, timestamps array<long>, cpus array<string>, seen array<long>"
PACKED_PREV = T.StructType(
    [T.StructField("timestamp", T.LongType(), True), T.StructField("cpus", T.StringType(), True)]
)


def bucket_of(*keys: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def pack_cpus(cpus: Column | str) -> Column:
    """A CPU array as one string, for the way through Python."""
    return F.to_json(F.struct((F.col(cpus) if isinstance(cpus, str) else cpus).alias("cpus")))


def unpack_cpus(packed: Column | str) -> Column:
    return F.from_json(packed, T.StructType([T.StructField("cpus", T.ArrayType(CPU, True), True)]))["cpus"]


def unpack_prev(prev: str = "prev") -> Column:
    p = F.col(prev)
    return F.when(p.isNotNull(), F.struct(p["timestamp"].alias("timestamp"), unpack_cpus(p["cpus"]).alias("cpus")))


def longs(column: pd.Series) -> list:
    """A column of longs as Python ints, with None for nulls."""
    return column.tolist() if column.dtype.kind == "i" else [None if pd.isna(x) else int(x) for x in column]


def sorted_rows(chunks, by: list[str]) -> pd.DataFrame:
    rows = pd.concat(list(chunks), ignore_index=True)
    return rows.sort_values(by, kind="stable", ignore_index=True) if len(rows) > 1 else rows


def sequence_starts(*keys: np.ndarray) -> np.ndarray:
    """Which of the rows, sorted by these keys, begin a sequence."""
    starts = np.zeros(len(keys[0]), bool)
    starts[:1] = True
    for k in keys:
        starts[1:] |= k[1:] != k[:-1]
    return starts


def load_last(state) -> dict:
    """host → (timestamp, cpus, seen) of a bucket's state."""
    if not state.exists:
        return {}
    hosts, timestamps, cpus, seen = state.get
    return dict(zip(hosts, zip(timestamps, cpus, seen)))


def save_last(state, last: dict) -> None:
    if last:
        timestamps, cpus, seen = zip(*last.values())
        state.update((list(last), list(timestamps), list(cpus), list(seen)))
    elif state.exists:
        state.remove()


def _pairing_with_group_state(order: list[str], ttl_ms: int | None):
    """The same pairing as ``PreviousSnapshot`` for ``applyInPandasWithState`` and a
    bucket of hosts; a TTL becomes a processing-time timeout that drops idle hosts."""

    def pair(rows: pd.DataFrame, last: dict, now: int) -> pd.DataFrame:
        hosts, stamps, cpus = rows["hostname"].to_numpy(), longs(rows["timestamp"]), rows["cpus"].tolist()
        opens = sequence_starts(hosts)
        prev_stamps, prev_cpus = [None] + stamps[:-1], [None] + cpus[:-1]
        has_prev = ~opens
        for i in np.flatnonzero(opens):
            has_prev[i] = hosts[i] in last
            prev_stamps[i], prev_cpus[i], _ = last.get(hosts[i], (None, None, 0))
        for i in np.flatnonzero(np.append(opens[1:], True)):
            last[hosts[i]] = (stamps[i], cpus[i], now)
        return rows.assign(
            has_prev=has_prev,
            prev_timestamp=pd.Series(prev_stamps, dtype=object),
            prev_cpus=pd.Series(prev_cpus, dtype=object),
        )

    def fn(key, pdfs, state):
        now = state.getCurrentProcessingTimeMs() if ttl_ms else 0
        last = load_last(state)
        before = dict(last)
        rows = None
        if not state.hasTimedOut:
            rows = pair(sorted_rows(pdfs, ["hostname", *order]), last, now)
        if ttl_ms:
            last = {h: s for h, s in last.items() if s[2] + ttl_ms > now}
        if last != before or rows is not None:
            save_last(state, last)
        if ttl_ms and last:
            state.setTimeoutDuration(max(1, min(s[2] for s in last.values()) + ttl_ms - now))
        for at in range(0, 0 if rows is None else len(rows), CHUNK):
            yield rows.iloc[at : at + CHUNK]

    return fn


def paired_stream(
    snapshots: DataFrame,
    order: Sequence[str] = ("src_partition", "src_offset"),
    ttl_ms: int | None = None,
    api: str = "group_state",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Streaming snapshots → rows with ``prev`` (one shuffle, by hostname or bucket
    of hostnames). ``api``: ``group_state`` (applyInPandasWithState) or ``tws``
    (transformWithStateInPandas)."""
    order = list(order)
    extra = [c for c in order if c != "timestamp"]
    pruned = snapshots.select(host_key().alias("hostname"), "timestamp", "cpus", *extra)
    fields = {f.name: f for f in pruned.schema.fields}
    if api == "tws":
        out_schema = T.StructType(
            [fields["hostname"], fields["timestamp"], T.StructField("cpus", T.ArrayType(CPU, True), True)]
            + [fields[c] for c in extra]
            + [T.StructField("prev", PREV, True)]
        )
        return pruned.groupBy("hostname").transformWithStateInPandas(
            statefulProcessor=PreviousSnapshot(order, ttl_ms),
            outputStructType=out_schema,
            outputMode="Append",
            timeMode="None",
        )
    from pyspark.sql.streaming.state import GroupStateTimeout

    out_schema = T.StructType(
        [fields["hostname"], fields["timestamp"], T.StructField("cpus", T.StringType(), True)]
        + [fields[c] for c in extra]
        + [T.StructField("has_prev", T.BooleanType(), False)]
        + [T.StructField(f"prev_{f.name}", f.dataType, True) for f in PACKED_PREV.fields]
    )
    timeout = GroupStateTimeout.ProcessingTimeTimeout if ttl_ms else GroupStateTimeout.NoTimeout
    cols = out_schema.fieldNames()
    fn = _pairing_with_group_state(order, ttl_ms)

    def run(key, pdfs, state):
        for pdf in fn(key, pdfs, state):
            yield pdf[cols]

    packed = pruned.withColumn("cpus", pack_cpus("cpus")).withColumn("bucket", bucket_of("hostname", buckets=buckets))
    paired = packed.groupBy("bucket").applyInPandasWithState(run, out_schema, LAST, "append", timeout)
    prev = F.struct(F.col("prev_timestamp").alias("timestamp"), unpack_cpus("prev_cpus").alias("cpus"))
    return paired.select(
        "hostname", "timestamp", unpack_cpus("cpus").alias("cpus"), *extra, F.when(F.col("has_prev"), prev).alias("prev")
    )


def enrich_stream(
    snapshots: DataFrame,
    order: Sequence[str] = ("src_partition", "src_offset"),
    ttl_ms: int | None = None,
    api: str = "group_state",
) -> DataFrame:
    """Streaming twin of ``cpu_delta.enrich``: same rows, same columns."""
    paired = paired_stream(snapshots, order, ttl_ms, api)
    return paired.where(F.col("prev").isNotNull()).select(F.col("hostname"), *metrics_record("prev"))
