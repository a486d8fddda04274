"""Job 1 as a stream without Python: ``foreachBatch`` + the batch operator.

Each micro-batch is joined with the stored last snapshot of every host (the
state), paired with the same bucketed previous-row operator as the batch
path — so a hot key (``unknown``) is split across tasks inside a
micro-batch too, where the keyed-state operator handles one key in one
task — and the new state (last snapshot per host) is written next to the
output.

Exactly-once: output and state of batch ``n`` go to ``…/batch_id=n`` with
overwrite, and batch ``n`` reads the state of batch ``n-1`` (falling back to
the newest older version), so a replayed batch rewrites the same files.
The order must be arrival order (broker offsets, or timestamps that do not
go backwards between micro-batches).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from statflow.functions.counters import host_key, metrics_record
from statflow.operators.cpu_delta import DEFAULT_BUCKET_MS, default_bucket
from statflow.operators.previous import with_previous


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _prune_state(spark: SparkSession, state_path: str, batch_id: int, retain: int) -> None:
    """Remove state versions older than the last ``retain`` (only folders
    named ``batch_id=<k>``); the previous version stays for a replay."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(state_path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("batch_id="):
            k = name.split("=", 1)[1]
            if k.isdigit() and int(k) <= batch_id - retain:
                fs.delete(st.getPath(), True)


def _read_state(spark: SparkSession, state_path: str, batch_id: int, cols: list[str], order: list[str]):
    """Last snapshot per host as of the end of batch ``batch_id - 1``."""
    if batch_id == 0 or not _exists(spark, state_path):
        return None
    last = f"{state_path}/batch_id={batch_id - 1}"
    if _exists(spark, last):
        return spark.read.parquet(last).select(*cols)
    # Gap (a batch that wrote no state): newest version per host among older ones.
    older = spark.read.parquet(state_path).where(F.col("batch_id") < batch_id)
    best = F.max_by(F.struct(*cols), F.struct("batch_id", *order)).alias("s")
    return older.groupBy("hostname").agg(best).select("s.*")


def start_enrichment_batchwise(
    snapshots: DataFrame,
    sink_path: str,
    state_path: str,
    checkpoint: str,
    order: Sequence[str] = ("src_partition", "src_offset"),
    bucket: Column | str | None = None,
    bucket_ms: int = DEFAULT_BUCKET_MS,
    trigger: str | None = "availableNow",
    retain_versions: int = 2,
) -> StreamingQuery:
    """Run job 1 on a snapshot stream; metrics rows go to
    ``sink_path/batch_id=n`` (Parquet, same columns as ``enrich``). The
    last ``retain_versions`` state versions are kept (at least 2)."""
    retain = max(2, retain_versions)
    order = list(order)
    extra = [c for c in order if c != "timestamp"]
    cols = ["hostname", "timestamp", "cpus", *extra]
    pruned = snapshots.select(host_key().alias("hostname"), "timestamp", "cpus", *extra)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("__carry", F.lit(False))
        prev = _read_state(spark, state_path, batch_id, cols, order)
        if prev is not None:
            rows = rows.unionByName(prev.withColumn("__carry", F.lit(True)))
        rows = rows.persist()
        try:
            b = default_bucket(order, bucket_ms) if bucket is None else bucket
            paired = with_previous(rows, "hostname", order, ["timestamp", "cpus", "__carry"], b)
            out = paired.where(~F.col("__carry") & F.col("prev").isNotNull()).select(
                F.col("hostname"), *metrics_record("prev")
            )
            out.write.mode("overwrite").parquet(f"{sink_path}/batch_id={batch_id}")
            newest = F.max_by(F.struct(*cols), F.struct(*order)).alias("s")
            state = rows.groupBy("hostname").agg(newest).select("s.*")
            state.write.mode("overwrite").parquet(f"{state_path}/batch_id={batch_id}")
        finally:
            rows.unpersist()
        _prune_state(spark, state_path, batch_id, retain)

    writer = pruned.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if trigger in (None, "availableNow"):
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()
