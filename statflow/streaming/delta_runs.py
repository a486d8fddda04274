"""Keyed state in bounded memory: hot hosts split into offset runs.

``delta_state`` gathers a host's rows of one micro-batch in one worker. Here a
group is (partition, run), a run being ``run_rows`` consecutive offsets of a
partition, so no group ever holds more than ``run_rows`` rows, whatever one host
sends, and the runs of a hot host are spread over the tasks. Two chained queries:

1. ``start_runs`` pairs each host's rows inside a run and computes their metrics. A
   host's first and last row of a run in a micro-batch, its edges, have neighbours
   in other runs; they are kept whole. One exactly-once sink writes both kinds,
   split into folders (``part``).
2. ``start_runs_metrics`` unites the metrics with the edges, which a keyed state
   links: a host's first row of a run gets its last row of the run before. Edges
   are at most two rows a host, run and micro-batch, and the state is one snapshot
   per (host, partition), in buckets as in ``delta_state``.

Arrival order is ``(src_partition, src_offset)``, as a broker gives it, and a
host's sequence is kept per partition: a keyed topic has a host in one partition
only, and rows of no host form one sequence per partition. With ``by_partition=False``
a host has one sequence over all partitions, as in ``delta_state``. Offsets should be
dense and, in a partition, unique (a broker's are): with gaps, runs hold fewer rows and
more of them are edges; rows that share offsets share a group.

Defined results: a null partition or offset counts as -1 (such rows of a host are
one run; their hosts are spread over buckets).
Equal offsets are ordered by timestamp. A late snapshot, one with a higher offset
and an older time, gives a negative time delta (E8).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from statflow.functions.counters import host_key, metrics_record
from statflow.schemas import CPU, CPU_METRIC
from statflow.streaming.delta_state import (
    BUCKETS, CHUNK, LAST, PACKED_PREV, PREV, bucket_of, load_last, longs, pack_cpus, save_last, sequence_starts,
    sorted_rows, unpack_cpus, unpack_prev,
)
from statflow.streaming.jobs import _start_metrics_sink, _trigger, state_partitions

#: Offsets in a run. A snapshot of 128 CPUs takes some 80 kB in a worker.
RUN_ROWS = 1024

_SNAPSHOT = [
    T.StructField("hostname", T.StringType(), False),
    T.StructField("src_partition", T.IntegerType(), False),
    T.StructField("src_offset", T.LongType(), False),
    T.StructField("timestamp", T.LongType(), True),
    T.StructField("cpus", T.ArrayType(CPU, True), True),
]
_PLACE = [
    T.StructField("opens", T.BooleanType(), False),  # first of its run: its previous row is elsewhere
    T.StructField("closes", T.BooleanType(), False),  # last of its run: a previous row for another one
    T.StructField("prev", PREV, True),
]
PAIRED = T.StructType(_SNAPSHOT + _PLACE)
#: ``PAIRED`` as it passes through Python: CPU arrays as strings.
_PACKED = T.StructType(
    [T.StructField(f.name, T.StringType() if f.name == "cpus" else f.dataType, f.nullable) for f in (*_SNAPSHOT, *_PLACE[:2])]
    + [T.StructField("prev", PACKED_PREV, True)]
)
_METRICS = T.StructType(
    [
        T.StructField("timestamp", T.LongType(), True),
        T.StructField("time_delta_ms", T.LongType(), True),
        T.StructField("cpu_metrics", T.ArrayType(CPU_METRIC, True), True),
    ]
)
#: The table between the two queries.
RUNS = T.StructType(
    [
        T.StructField("hostname", T.StringType(), True),
        T.StructField("metrics", _METRICS, True),
        T.StructField("edge", T.StructType([*PAIRED.fields[1:]]), True),
        T.StructField("part", T.StringType(), True),
    ]
)
_ORDER = ["src_offset", "timestamp"]


def _pair_run(key, chunks, state):
    """The rows of one run and micro-batch, each host's in a sequence; no state is kept."""
    chunks = list(chunks)
    hosts = [c for c in ("hostname",) if c in chunks[0]]
    rows = sorted_rows(chunks, [*hosts, *_ORDER])
    opens = sequence_starts(rows[hosts[0]].to_numpy() if hosts else np.zeros(len(rows)))
    snapshots = [{"timestamp": t, "cpus": c} for t, c in zip(longs(rows["timestamp"]), rows["cpus"].tolist())]
    prev = [None] + snapshots[:-1]
    for i in np.flatnonzero(opens):
        prev[i] = None
    rows["opens"] = opens
    rows["closes"] = np.append(opens[1:], True)
    rows["prev"] = pd.Series(prev, dtype=object)
    yield rows


def _link(rows: pd.DataFrame, sequences, last: dict) -> pd.DataFrame:
    """Edges in order, with the names of their sequences: a run's first row follows the
    last one that its sequence closed. ``last``: sequence → (timestamp, cpus, 0), kept up."""
    previous = []
    columns = (rows[c].tolist() for c in ("opens", "closes", "cpus", "prev"))
    for name, timestamp, opens, closes, cpus, prev in zip(sequences, longs(rows["timestamp"]), *columns):
        if opens:
            found = last.get(name)
            prev = None if found is None else {"timestamp": found[0], "cpus": found[1]}
        previous.append(prev)
        if closes:
            last[name] = (timestamp, cpus, 0)
    rows["prev"] = pd.Series(previous, dtype=object)
    return rows


def _link_edges(key, chunks, state):
    """Edges of one (host, partition) with a state of its own."""
    last = {0: (*state.get, 0)} if state.exists else {}
    rows = sorted_rows(chunks, [*_ORDER, "closes"])
    rows = _link(rows, [0] * len(rows), last)
    if last:
        state.update(last[0][:2])
    yield rows


def _link_bucket(key, chunks, state):
    """Edges of a bucket of sequences: ``sequence`` names them."""
    last = load_last(state)
    rows = sorted_rows(chunks, ["sequence", "src_partition", *_ORDER, "closes"])
    rows = _link(rows, rows["sequence"].tolist(), last)
    save_last(state, last)
    for at in range(0, len(rows), CHUNK):
        yield rows.iloc[at : at + CHUNK]


def _unpacked(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"cpus": unpack_cpus("cpus"), "prev": unpack_prev()})


def pair_runs(snapshots: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """Streaming snapshots → ``RUNS``: metrics of the rows inside runs, and the runs' edges."""
    has_host = "hostname" in snapshots.columns
    slim = snapshots.select(
        host_key("hostname" if has_host else F.lit(None).cast("string")).alias("hostname"),
        F.coalesce("src_partition", F.lit(-1)).cast("int").alias("src_partition"),
        F.coalesce("src_offset", F.lit(-1)).cast("long").alias("src_offset"),
        "timestamp",
        pack_cpus("cpus").alias("cpus"),
    )
    run = F.floor(F.col("src_offset") / F.lit(run_rows))
    # Rows without an offset are one run; only their hosts can spread them.
    spread = F.when(F.col("src_offset") < 0, bucket_of("hostname")).otherwise(F.lit(0))
    columns = _PACKED.fieldNames()

    def pair(key, chunks, state):
        for rows in _pair_run(key, chunks, state):
            yield rows[columns]

    paired = (
        slim.withColumns({"run": run, "spread": spread})
        .groupBy("src_partition", "run", "spread")
        .applyInPandasWithState(pair, _PACKED, PACKED_PREV, "append", GroupStateTimeout.NoTimeout)
    )
    paired = _unpacked(paired)
    edge = F.col("opens") | F.col("closes")
    return paired.select(
        "hostname",
        F.when(~edge, F.struct(*metrics_record("prev"))).alias("metrics"),
        F.when(edge, F.struct(*columns[1:])).alias("edge"),
        F.when(edge, F.lit("edge")).otherwise(F.lit("inside")).alias("part"),
    )


def metrics_of_runs(runs: DataFrame, by_partition: bool = True, buckets: int = BUCKETS) -> DataFrame:
    """``RUNS`` rows → metrics, the same rows and columns as ``delta_state.enrich_stream``."""
    inside = runs.where(F.col("part") == "inside").select("hostname", "metrics.*")
    edges = runs.where(F.col("part") == "edge").select("hostname", "edge.*")
    columns = _PACKED.fieldNames()

    def link(key, chunks, state):
        for rows in _link_bucket(key, chunks, state):
            yield rows[columns]

    prev = F.col("prev")
    packed_prev = F.when(prev.isNotNull(), F.struct(prev["timestamp"].alias("timestamp"), pack_cpus(prev["cpus"]).alias("cpus")))
    packed = edges.withColumns({"cpus": pack_cpus("cpus"), "prev": packed_prev})
    # No host is mistaken for another: a partition is digits up to the slash.
    sequence = F.concat_ws("/", "src_partition", "hostname") if by_partition else F.col("hostname")
    packed = packed.withColumn("sequence", sequence).withColumn("bucket", bucket_of("sequence", buckets=buckets))
    linked = packed.groupBy("bucket").applyInPandasWithState(link, _PACKED, LAST, "append", GroupStateTimeout.NoTimeout)
    linked = _unpacked(linked.where(F.col("prev").isNotNull()))
    return inside.unionByName(linked.select("hostname", *metrics_record("prev")))


def start_runs(
    snapshots: DataFrame, runs_path: str, checkpoint: str, run_rows: int = RUN_ROWS, trigger: str | None = "availableNow"
) -> StreamingQuery:
    """The first query: snapshots → the table of runs."""
    writer = pair_runs(snapshots, run_rows).writeStream.format("parquet").option("path", runs_path)
    writer = writer.option("checkpointLocation", checkpoint).partitionBy("part").outputMode("append")
    return _trigger(writer, trigger).start()


def start_runs_metrics(
    spark: SparkSession,
    runs_path: str,
    sink_path: str,
    checkpoint: str,
    sink_format: str = "parquet",
    trigger: str | None = "availableNow",
    kafka: dict | None = None,
    by_partition: bool = True,
) -> StreamingQuery:
    """The second query: the table of runs → metrics. It takes whole batches of the
    first one (no limit on files), so that a run's edges come together."""
    runs = spark.readStream.schema(RUNS).parquet(runs_path)
    return _start_metrics_sink(metrics_of_runs(runs, by_partition), sink_path, checkpoint, sink_format, trigger, kafka)


def drain_runs(
    snapshots: DataFrame, runs_path: str, sink_path: str, checkpoint: str, checkpoint2: str, run_rows: int = RUN_ROWS,
    by_partition: bool = True,
) -> None:
    """Both queries over what has arrived, one after the other."""
    spark = snapshots.sparkSession
    with state_partitions(spark, spark.sparkContext.defaultParallelism):
        first = start_runs(snapshots, runs_path, checkpoint, run_rows)
        first.awaitTermination()
        second = start_runs_metrics(spark, runs_path, sink_path, checkpoint2, by_partition=by_partition)
    second.awaitTermination()
