"""The two stream jobs and their sinks.

* ``start_enrichment``: snapshots → keyed previous-snapshot state → metrics,
  written as JSON (K1: Kafka when present, else text files) or Parquet.
* ``start_archive``: metrics JSON → typed rows → Parquet, partitioned by an
  hour bucket (K2, K3).

Every query has its own checkpoint location under the shared checkpoint
folder, so a restart resumes from the last committed batch (file sinks are
exactly-once; the Kafka sink is at-least-once).
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from statflow.operators.metrics_json import metrics_from_json, metrics_to_json, split_good_bad, with_hour_bucket
from statflow.operators.wire import decode_frames, encode_payloads, frame, good_rows, quarantine
from statflow.schemas import SNAPSHOT_ROW
from statflow.session import scratch_path
from statflow.streaming.delta_state import enrich_stream


def _trigger(writer, trigger: str | None):
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


@contextmanager
def state_partitions(spark: SparkSession, n: int | None):
    """Number of state partitions for queries started inside the block.

    A stateful query fixes its partitioning (from ``spark.sql.shuffle.
    partitions``) at its first start and keeps it in the checkpoint, so size
    it to the state and the cluster, not to whatever the session holds."""
    if not n:
        yield
        return
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def start_enrichment(
    snapshots: DataFrame,
    sink_path: str,
    checkpoint: str,
    order: Sequence[str] = ("src_partition", "src_offset"),
    sink_format: str = "parquet",
    trigger: str | None = "availableNow",
    kafka: dict | None = None,
    api: str = "group_state",
    ttl_ms: int | None = None,
) -> StreamingQuery:
    """Run job 1 (keyed state: ``api`` ``group_state`` or ``tws``, see
    ``delta_state``; ``ttl_ms`` drops the state of hosts idle that long). ``sink_format``: ``parquet`` (typed rows, with hostname),
    ``json`` (the reference's three-field JSON text, one per line),
    ``kafka`` (same JSON as the message value; needs ``kafka`` options),
    ``console`` (print, K4) or ``memory`` (table named ``sink_path``)."""
    metrics = enrich_stream(snapshots, order, ttl_ms=ttl_ms, api=api)
    return _start_metrics_sink(metrics, sink_path, checkpoint, sink_format, trigger, kafka)


def _start_metrics_sink(metrics, sink_path, checkpoint, sink_format, trigger, kafka=None) -> StreamingQuery:
    if sink_format in ("console", "memory"):
        writer = metrics_to_json(metrics, with_host=True).writeStream.format(sink_format)
        if sink_format == "memory":
            writer = writer.queryName(sink_path)
        writer = writer.option("checkpointLocation", checkpoint).outputMode("append")
        return _trigger(writer, trigger).start()
    if sink_format == "parquet":
        writer = metrics.writeStream.format("parquet").option("path", sink_path)
    elif sink_format == "json":
        writer = metrics_to_json(metrics).writeStream.format("text").option("path", sink_path)
    elif sink_format == "kafka":
        writer = metrics_to_json(metrics).writeStream.format("kafka")
        for k, v in (kafka or {}).items():
            writer = writer.option(k, v)
    else:
        raise ValueError(f"unknown sink format {sink_format!r}")
    writer = writer.option("checkpointLocation", checkpoint).outputMode("append")
    return _trigger(writer, trigger).start()


def start_archive(
    json_lines: DataFrame,
    archive_path: str,
    checkpoint: str,
    bucket: str = "event",
    trigger: str | None = "availableNow",
) -> StreamingQuery:
    """Run job 2: JSON metrics → Parquet partitioned by ``bucket=yyyy-MM-dd--HH``.

    ``bucket="event"`` derives the hour from the record's timestamp
    (replayable); ``"processing"`` uses the clock, as the reference does.
    """
    rows = metrics_from_json(json_lines)
    typed = with_hour_bucket(rows.where(F.col("reason").isNull()).drop("reason", "value"), bucket)
    writer = (
        typed.writeStream.format("parquet")
        .option("path", archive_path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("bucket")
        .outputMode("append")
    )
    return _trigger(writer, trigger).start()


def start_archive_quarantine(
    json_lines: DataFrame, bad_path: str, checkpoint: str, trigger: str | None = "availableNow"
) -> StreamingQuery:
    """The lines that ``start_archive`` leaves out, with their reason (K8), as
    Parquet. A query of its own, with its own checkpoint and an exactly-once
    file sink, so the archive keeps its layout; it parses the lines again."""
    _, bad = split_good_bad(metrics_from_json(json_lines))
    return _start_quarantine(bad, bad_path, checkpoint, trigger)


def start_wire_quarantine(
    frames: DataFrame, registry: DataFrame, bad_path: str, checkpoint: str, trigger: str | None = "availableNow"
) -> StreamingQuery:
    """The frames that job 1 leaves out, with their reason and position (K8),
    for either engine; like ``start_archive_quarantine``."""
    return _start_quarantine(quarantine(decode_frames(frames, registry)), bad_path, checkpoint, trigger)


def start_faults(faults: DataFrame, path: str, checkpoint: str, trigger: str | None = "availableNow") -> StreamingQuery:
    """Rows that a split set aside → a quarantine table of their own (K8)."""
    return _start_quarantine(faults, path, checkpoint, trigger)


def await_folder(spark: SparkSession, path: str, query: StreamingQuery, poll_s: int = 1) -> None:
    """Wait until ``query`` has committed a first batch to ``path``, so that a reader of it can start."""
    while query.isActive and not (query.lastProgress and query.lastProgress["batchId"] >= 0 and query.lastProgress["sink"]):
        query.awaitTermination(poll_s)
    if query.exception():
        raise query.exception()


def _start_quarantine(bad: DataFrame, path: str, checkpoint: str, trigger: str | None) -> StreamingQuery:
    writer = bad.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return _trigger(writer.outputMode("append"), trigger).start()


def _split_schema(value: T.DataType) -> T.StructType:
    # Rows set aside have no snapshot fields, so all of them may be null.
    fields = [T.StructField(f.name, f.dataType, True) for f in SNAPSHOT_ROW.fields]
    return T.StructType([*fields, T.StructField("value", value, True), T.StructField("reason", T.StringType(), True)])


# What ``split_part`` and ``split_faults`` read back of decoded snapshots.
SNAPSHOT_SPLIT = _split_schema(T.StringType())
WIRE_SPLIT = _split_schema(T.BinaryType())
GOOD = "ok"


def start_split(rows: DataFrame, path: str, checkpoint: str, trigger: str | None = "availableNow") -> StreamingQuery:
    """Rows with a ``reason`` → one Parquet table partitioned by it, ``reason=ok`` for
    good rows (K8). The input is read and decoded once, and good and bad rows are
    committed together by one exactly-once file sink; readers of either part
    prune the other's folders. ``value`` is kept for bad rows only."""
    reason = F.col("reason")
    split = rows.withColumn("value", F.when(reason.isNotNull(), F.col("value"))).withColumn("reason", F.coalesce(reason, F.lit(GOOD)))
    writer = split.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return _trigger(writer.partitionBy("reason").outputMode("append"), trigger).start()


def split_part(spark: SparkSession, path: str, schema: T.StructType, streaming: bool = True) -> DataFrame:
    """The good rows of a split table, as a stream or a table."""
    reader = (spark.readStream if streaming else spark.read).schema(schema)
    return reader.parquet(path).where(F.col("reason") == GOOD).drop("reason", "value")


def split_faults(spark: SparkSession, path: str, schema: T.StructType, streaming: bool = False) -> DataFrame:
    """The rows that were set aside, with their reason."""
    reader = (spark.readStream if streaming else spark.read).schema(schema)
    return reader.parquet(path).where(F.col("reason") != GOOD)


def start_wire_split(
    frames: DataFrame, registry: DataFrame, path: str, checkpoint: str, trigger: str | None = "availableNow"
) -> StreamingQuery:
    """Framed Avro → a split table (``WIRE_SPLIT``): each frame is decoded once."""
    keep = [c for c in ("value", "hostname", "src_partition", "src_offset") if c in frames.columns]
    return start_split(decode_frames(frames, registry, keep=keep), path, checkpoint, trigger)


def await_all(queries: Sequence[StreamingQuery], poll_s: int = 5) -> None:
    """Wait until all queries end; if one fails, stop the others and raise."""
    try:
        waiting = list(queries)
        while waiting:
            waiting = [q for q in waiting if not q.awaitTermination(poll_s)]
    finally:
        for q in queries:
            if q.isActive:
                q.stop()


def start_wire_enrichment(
    frames: DataFrame,
    registry: DataFrame,
    sink_path: str,
    checkpoint: str,
    sink_format: str = "parquet",
    trigger: str | None = "availableNow",
    order: Sequence[str] = ("src_partition", "src_offset"),
    kafka: dict | None = None,
    api: str = "group_state",
) -> StreamingQuery:
    """Job 1 end to end (S3, D1–D4, A1, K1): framed Avro → decode → keyed
    state → metrics. Undecodable messages are dropped from the state path
    here; ``start_wire_quarantine`` beside it keeps them (K8). The Avro record
    has no hostname, so all snapshots share the ``unknown`` key unless the
    frames carry a ``hostname`` column (e.g. from the message key)."""
    keep = [c for c in ("hostname", "src_partition", "src_offset") if c in frames.columns]
    decoded = good_rows(decode_frames(frames, registry, keep=["value", *keep]))
    if "hostname" not in decoded.columns:
        decoded = decoded.withColumn("hostname", F.lit(None).cast("string"))
    metrics = enrich_stream(decoded, order, api=api)
    return _start_metrics_sink(metrics, sink_path, checkpoint, sink_format, trigger, kafka)


def start_decode(
    frames: DataFrame,
    registry: DataFrame,
    good_path: str,
    bad_path: str,
    checkpoint: str,
    trigger: str | None = "availableNow",
) -> StreamingQuery:
    """Decode a frame stream into a snapshot table and a quarantine table
    (D1–D8, K8). Each micro-batch is decoded once (persisted), then written
    to both tables under ``batch_id=<n>``; a replayed batch overwrites its
    own folder, so the two writes stay exactly-once."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        decoded = decode_frames(batch, registry).persist()
        try:
            good_rows(decoded).write.mode("overwrite").parquet(f"{good_path}/batch_id={batch_id}")
            quarantine(decoded).write.mode("overwrite").parquet(f"{bad_path}/batch_id={batch_id}")
        finally:
            decoded.unpersist()

    writer = frames.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def start_publish(
    snapshots: DataFrame,
    schema_json: str,
    schema_id: int,
    sink_path: str,
    checkpoint: str,
    sink_format: str = "parquet",
    trigger: str | None = "availableNow",
    kafka: dict | None = None,
) -> StreamingQuery:
    """The producer side (K5, D7): snapshots → Avro payload → framed
    message, to Kafka (``kafka`` options) or to Parquet frames."""
    from statflow.schemas import SNAPSHOT

    fields = [f.name for f in SNAPSHOT.fields]
    keep = [c for c in ("hostname", "src_partition", "src_offset") if c in snapshots.columns]
    enc = encode_payloads(snapshots.select(*fields, *keep), schema_json, fields)
    frames = enc.select(frame(F.col("payload"), F.lit(schema_id)).alias("value"), *keep)
    if sink_format == "kafka":
        # The host travels as the message key (the record has no host field).
        cols = ([F.col("hostname").alias("key")] if "hostname" in frames.columns else []) + ["value"]
        writer = frames.select(*cols).writeStream.format("kafka")
        for k, v in (kafka or {}).items():
            writer = writer.option(k, v)
    else:
        writer = frames.writeStream.format("parquet").option("path", sink_path)
    writer = writer.option("checkpointLocation", checkpoint).outputMode("append")
    return _trigger(writer, trigger).start()


def start_debug_print(frames: DataFrame, registry: DataFrame, checkpoint: str,
                      trigger: str | None = "availableNow", memory_table: str | None = None) -> StreamingQuery:
    """The debug job (D6, K4): decode and print each record as JSON on the
    console (or into an in-memory table named ``memory_table``)."""
    from statflow.schemas import SNAPSHOT

    decoded = good_rows(decode_frames(frames, registry))
    text = decoded.select(F.to_json(F.struct(*[f.name for f in SNAPSHOT.fields])).alias("value"))
    if memory_table:
        writer = text.writeStream.format("memory").queryName(memory_table)
    else:
        writer = text.writeStream.format("console").option("truncate", False)
    writer = writer.option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def replay(
    spark: SparkSession, snapshots: DataFrame, chunks: int = 3, order=("timestamp", "src_offset"),
    engine: str = "state",
) -> str:
    """Feed a snapshot table to job 1 in ``chunks`` arrivals by time, restarting
    the query from its checkpoint after each one; returns the sink path.
    ``engine``: ``state`` (keyed state via applyInPandasWithState), ``tws``
    (keyed state via transformWithStateInPandas), ``batchwise``
    (``foreachBatch`` + the batch operator) or ``runs`` (keyed state over
    offset runs, ordered by partition and offset whatever ``order`` says).

    Used to check that the stream gives the batch rows, restarts included.
    The chunk bounds come from one tiny aggregate (min and max time).
    """
    from statflow.schemas import SNAPSHOT_ROW

    stage, src, sink, ck, ck2, state = (
        scratch_path(spark, n)
        for n in ("replay-stage", "replay-in", "replay-out", "replay-ck", "replay-ck2", "replay-state")
    )

    def run_once() -> None:
        stream = spark.readStream.schema(SNAPSHOT_ROW).parquet(src)
        if engine == "batchwise":
            from statflow.streaming.delta_batchwise import start_enrichment_batchwise

            start_enrichment_batchwise(stream, sink, state, ck, order).awaitTermination()
        elif engine == "runs":
            from statflow.streaming.delta_runs import drain_runs

            drain_runs(stream, state, sink, ck, ck2)
        else:
            api = "tws" if engine == "tws" else "group_state"
            with state_partitions(spark, spark.sparkContext.defaultParallelism):
                q = start_enrichment(stream, sink, ck, order, api=api)
            q.awaitTermination()

    # Materialise the input once; each arrival is then a pruned range scan.
    snapshots.write.parquet(stage)
    staged = spark.read.schema(SNAPSHOT_ROW).parquet(stage)
    lo, hi = staged.agg(F.min("timestamp"), F.max("timestamp")).first()
    if lo is None:
        staged.write.mode("append").parquet(src)
        run_once()
        return sink
    step = (hi - lo) // chunks + 1
    for i in range(chunks):
        part = staged.where((F.col("timestamp") >= lo + i * step) & (F.col("timestamp") < lo + (i + 1) * step))
        part.write.mode("append").parquet(src)
        run_once()
    return sink


def archive_replay(spark: SparkSession, metrics: DataFrame) -> str:
    """Write metrics as JSON lines (job 1's output format), run job 2 over
    them, and return the archive path."""
    lines, arch, ck = (scratch_path(spark, n) for n in ("archive-in", "archive-out", "archive-ck"))
    metrics_to_json(metrics, with_host=True).write.text(lines)
    json_lines = spark.readStream.schema("value STRING").text(lines)
    start_archive(json_lines, arch, ck).awaitTermination()
    return arch
