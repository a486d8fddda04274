"""Job 2 with files of a bounded size, and one parse for both outputs (K2, K3, K8).

``jobs.start_archive`` writes a file per task and hour, so a batch leaves tasks x
hours files. Here each micro-batch is parsed once and kept while it is used; its
bytes are counted per hour; an hour of ``b`` bytes is given ``floor(b / target)``
files, one at least. The files are numbered hour by hour and dealt in turn over the
tasks of one shuffle, which has at least as many tasks as any hour has files: so a
task writes files of several hours, but one at most of each. So a file holds
between one and two targets (as evenly as a hash deals), and an hour has at most
one smaller file per batch. Lines that can't be read are written from the same parse.

Both outputs are laid out by batch (``bucket=<hour>/batch_id=<n>`` and
``batch_id=<n>``), and a batch that runs again replaces its own folders only.
Buckets are the hours of the records, not of the clock, for that reason.

The plan of a batch is one row per hour that occurs in it: its size follows the
span of time, not the rows. Lines are dealt by a hash of their text and, where the
source has them, partition and offset; equal lines without offsets share a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from statflow.operators.metrics_json import metrics_from_json, split_good_bad, with_hour_bucket
from statflow.streaming.jobs import _trigger

#: JSON bytes a file is made of; Parquet takes a fraction of them.
TARGET_BYTES = 1 << 29
#: JSON bytes that a task writes before more tasks are used, where files are smaller.
TASK_BYTES = 1 << 25


def hour_sizes(rows: DataFrame, target_bytes: int) -> DataFrame:
    """``(bucket, n_bytes, files)``: the bytes of an hour and how many files it gets."""
    sizes = rows.groupBy("bucket").agg(F.sum("n_bytes").alias("n_bytes"))
    files = F.greatest(F.lit(1), F.floor(F.col("n_bytes") / F.lit(target_bytes))).cast("int")
    return sizes.withColumn("files", files)


def file_plan(rows: DataFrame, target_bytes: int) -> DataFrame:
    """``(bucket, files, first)`` for rows with ``bucket`` and ``n_bytes``: how many
    files a bucket gets, and the number of its first one."""
    planned = hour_sizes(rows, target_bytes).select("bucket", "files")
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row an hour
    return planned.withColumn("first", F.coalesce(F.sum("files").over(before), F.lit(0)).cast("int"))


def task_count(most: int, files: int, n_bytes: int, parallelism: int) -> int:
    """How many tasks write ``files`` files of ``n_bytes``, with up to ``most`` of one hour.

    ``most`` at least, so that a task never gets two files of one hour."""
    return min(files, max(most, -(-n_bytes // TASK_BYTES), parallelism))


def write_sized(rows: DataFrame, path: str, batch_id: int, target_bytes: int = TARGET_BYTES) -> int:
    """Write rows with ``bucket``, ``n_bytes`` and ``salt`` below ``path``; the number of files."""
    totals = hour_sizes(rows, target_bytes).agg(F.max("files"), F.sum("files"), F.sum("n_bytes")).first()
    most, n_files, n_bytes = (x or 0 for x in totals)
    if not n_files:
        return 0
    tasks = task_count(most, n_files, n_bytes, rows.sparkSession.sparkContext.defaultParallelism)
    number = F.col("first") + F.pmod(F.col("salt"), F.col("files").cast("long")).cast("int")
    placed = rows.join(file_plan(rows, target_bytes), "bucket").withColumn("task", F.pmod(number, F.lit(tasks)))
    placed = placed.repartitionById(tasks, "task")
    kept = placed.drop("n_bytes", "salt", "files", "first", "task").withColumn("batch_id", F.lit(batch_id))
    writer = kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    # The batch goes through a staging folder anyway, so tasks may place their files in it
    # themselves; otherwise the driver moves them one by one.
    writer = writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    writer.partitionBy("bucket", "batch_id").parquet(path)
    return n_files


def start_sized_archive(
    json_lines: DataFrame,
    archive_path: str,
    bad_path: str,
    checkpoint: str,
    target_bytes: int = TARGET_BYTES,
    trigger: str | None = "availableNow",
) -> StreamingQuery:
    """Job 2: JSON metrics → Parquet by hour in files of ``target_bytes`` of JSON
    or more, and the lines left out with their reason. Read back with ``read_archive``."""
    place = [c for c in ("src_partition", "src_offset") if c in json_lines.columns]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        parsed = metrics_from_json(batch, keep=place).persist()
        try:
            salt = F.xxhash64("value", *place)
            good = with_hour_bucket(parsed.where(F.col("reason").isNull()))
            sized = good.select(
                "hostname", "timestamp", "time_delta_ms", "cpu_metrics", "bucket",
                F.octet_length("value").alias("n_bytes"), salt.alias("salt"),
            )
            write_sized(sized, archive_path, batch_id, target_bytes)
            split_good_bad(parsed)[1].write.mode("overwrite").parquet(f"{bad_path}/batch_id={batch_id}")
        finally:
            parsed.unpersist()

    writer = json_lines.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()
