"""The whole chain as deployed by the reference, on files instead of topics:

dumps → parse (producer) → Avro frames (publish stream) → job 1 stream
(decode + keyed state, JSON sink) → job 2 stream (hour-bucketed archive)
→ read back; equal to the batch computation on the same dumps.
"""

from __future__ import annotations

from conftest import SF_SMALL
from pyspark.sql import functions as F

from statflow.operators.cpu_delta import enrich, explode_metrics
from statflow.operators.metrics_json import read_archive
from statflow.operators.procstat import parse_dumps, render_dump
from statflow.plans.fixtures import snapshots, table, with_arrival_offsets
from statflow.schemas import SNAPSHOT_AVRO_SCHEMA
from statflow.session import scratch_path
from statflow.sources.streams import file_frames, file_json
from statflow.streaming.jobs import start_archive, start_publish, start_wire_enrichment


def test_dumps_to_archive(spark):
    snaps = with_arrival_offsets(snapshots(table(spark, SF_SMALL, "events"), "cumulative"))
    cpus = F.transform("cpus", lambda c, i: c.withField("id", F.concat(F.lit("cpu"), i.cast("string"))))
    dumps = snaps.select("hostname", "timestamp", "src_partition", "src_offset",
                         render_dump({"cpus": cpus}).alias("text"))

    # Producer: parse the dumps, keep the good ones, publish framed Avro.
    parsed = parse_dumps(dumps).where(F.col("reason").isNull()).drop("reason")
    stage = scratch_path(spark, "e2e-stage")
    parsed.drop("hostname").write.parquet(stage)
    frames_path = scratch_path(spark, "e2e-frames")
    start_publish(spark.readStream.schema(spark.read.parquet(stage).schema).parquet(stage),
                  SNAPSHOT_AVRO_SCHEMA, 7, frames_path, scratch_path(spark, "e2e-ck1")).awaitTermination()

    # Job 1: decode + keyed state, JSON lines out (the reference's wire format).
    registry = spark.createDataFrame([(7, SNAPSHOT_AVRO_SCHEMA)], "schema_id INT, schema_json STRING")
    json_path = scratch_path(spark, "e2e-json")
    start_wire_enrichment(file_frames(spark, frames_path), registry, json_path, scratch_path(spark, "e2e-ck2"),
                          sink_format="json").awaitTermination()
    lines = spark.read.text(json_path)
    assert lines.where(~F.col("value").startswith('{"timestamp":')).count() == 0

    # Job 2: archive by hour bucket, then read back.
    arch = scratch_path(spark, "e2e-arch")
    start_archive(file_json(spark, json_path), arch, scratch_path(spark, "e2e-ck3")).awaitTermination()
    back = read_archive(spark, arch)

    # Batch reference: the same snapshots, all under the "unknown" key (the
    # Avro record has no hostname), in arrival order.
    want = enrich(parsed.withColumn("hostname", F.lit(None).cast("string")), order=("src_partition", "src_offset"))
    cols = ["timestamp", "time_delta_ms", "cpu_id", "user_pct", "system_pct", "idle_pct", "iowait_pct",
            "total_busy_pct"]
    got_rows = explode_metrics(back.withColumn("hostname", F.lit("unknown"))).select(cols)
    want_rows = explode_metrics(want).select(cols)
    assert got_rows.count() == want_rows.count() > 0
    assert got_rows.exceptAll(want_rows).count() == 0 and want_rows.exceptAll(got_rows).count() == 0
    assert back.select("bucket").distinct().count() > 1


def test_memory_sink(spark):
    from statflow.schemas import SNAPSHOT_ROW
    from statflow.streaming.jobs import start_enrichment

    snaps = snapshots(table(spark, SF_SMALL, "events"), "cumulative")
    src = scratch_path(spark, "mem-in")
    snaps.write.parquet(src)
    q = start_enrichment(spark.readStream.schema(SNAPSHOT_ROW).parquet(src), "metrics_mem",
                         scratch_path(spark, "mem-ck"), ("timestamp", "src_offset"), sink_format="memory")
    q.awaitTermination()
    assert spark.table("metrics_mem").count() == enrich(snaps).count()
