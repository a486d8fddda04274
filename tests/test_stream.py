"""Stream ≡ batch for the keyed-state enrichment, restarts included (§5)."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL, cpu, snapshot_df
from pyspark.sql import functions as F

from statflow.operators.cpu_delta import enrich, explode_metrics
from statflow.operators.metrics_json import metrics_from_json, metrics_to_json, read_archive
from statflow.plans.fixtures import snapshots, table
from statflow.schemas import SNAPSHOT_ROW
from statflow.session import scratch_path
from statflow.streaming.jobs import archive_replay, replay, start_enrichment


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("engine", ["state", "tws", "batchwise"])
@pytest.mark.parametrize("chunks", [1, 3])
def test_stream_equals_batch(spark, chunks, engine):
    snaps = snapshots(table(spark, SF_SMALL, "events"), "reset", hostless_every=4)
    sink = replay(spark, snaps, chunks=chunks, order=("timestamp", "src_offset"), engine=engine)
    got = explode_metrics(spark.read.parquet(sink).drop("batch_id"))
    want = explode_metrics(enrich(snaps))
    assert got.count() == want.count() > 0
    assert _same(got, want)


def test_stream_orders_by_offset_inside_a_batch(spark):
    """Rows of one host in one micro-batch are sorted by arrival order, not
    by timestamp: a late snapshot gives a negative time delta (E8)."""
    rows = [("h", 61000, [cpu("cpu0", 1, idle=1)], 0), ("h", 1000, [cpu("cpu0", 2, idle=2)], 1),
            ("h", 2000, [cpu("cpu0", 3, idle=3)], 2)]
    src, sink, ck = (scratch_path(spark, n) for n in ("t-in", "t-out", "t-ck"))
    snapshot_df(spark, rows).write.parquet(src)
    q = start_enrichment(spark.readStream.schema(SNAPSHOT_ROW).parquet(src), sink, ck, order=("src_partition", "src_offset"))
    q.awaitTermination()
    out = sorted((r.timestamp, r.time_delta_ms) for r in spark.read.parquet(sink).collect())
    assert out == [(1000, -60000), (2000, 1000)]


def test_archive_round_trip_and_pruning(spark):
    snaps = snapshots(table(spark, SF_SMALL, "events"), "cumulative")
    m = enrich(snaps)
    arch = archive_replay(spark, m)
    back = read_archive(spark, arch)
    assert _same(back.select("hostname", "timestamp", "time_delta_ms", "cpu_metrics"),
                 m.select("hostname", "timestamp", "time_delta_ms", "cpu_metrics"))
    one = back.select("bucket").first().bucket
    pruned = read_archive(spark, arch, [one])
    assert pruned.count() == back.where(F.col("bucket") == one).count()
    assert "PartitionFilters" in pruned._jdf.queryExecution().executedPlan().toString()


def test_json_lenient_and_quarantine(spark):
    lines = spark.createDataFrame(
        [
            ('{"timestamp": "12", "time_delta_ms": 1.9, "cpu_metrics": [{"cpu_id": 3, "user_pct": "2.5",'
             ' "system_pct": true, "idle_pct": null, "iowait_pct": {}, "total_busy_pct": 1}]}',),
            ('{"timestamp": 1, "cpu_metrics": []}',),
            ("not json",),
            ('{"timestamp": 5, "time_delta_ms": 0, "cpu_metrics": []}',),
        ],
        "value STRING",
    )
    rows = metrics_from_json(lines, coerce=True).collect()
    first = rows[0]
    assert first.reason is None and first.timestamp == 12 and first.time_delta_ms == 1
    m = first.cpu_metrics[0]
    assert (m.cpu_id, m.user_pct, m.system_pct, m.idle_pct, m.iowait_pct, m.total_busy_pct) == ("3", 2.5, 1.0, 0.0, 0.0, 1.0)
    assert [x.reason for x in rows[1:]] == ["missing_field", "bad_json", None]
    strict = [x.reason for x in metrics_from_json(lines).collect()]
    assert strict == ["missing_field", "missing_field", "bad_json", None]


def test_json_round_trip_keeps_empty_metrics(spark):
    df = spark.createDataFrame([("h", 5, 0, [])], "hostname STRING, timestamp BIGINT, time_delta_ms BIGINT,"
                               " cpu_metrics ARRAY<STRUCT<cpu_id:STRING,user_pct:DOUBLE,system_pct:DOUBLE,"
                               "idle_pct:DOUBLE,iowait_pct:DOUBLE,total_busy_pct:DOUBLE>>")
    text = metrics_to_json(df).first().value
    assert text == '{"timestamp":5,"time_delta_ms":0,"cpu_metrics":[]}'


def test_batchwise_state_keeps_recent_versions(spark):
    import os

    from statflow.streaming.delta_batchwise import start_enrichment_batchwise

    snaps = snapshots(table(spark, SF_SMALL, "events"), "cumulative")
    src, sink, state, ck = (scratch_path(spark, n) for n in ("bw-in", "bw-out", "bw-state", "bw-ck"))
    days = sorted(r[0] for r in snaps.select("timestamp").distinct().collect())
    for i, lo in enumerate(days[:4]):
        snaps.where(F.col("timestamp") == lo).write.mode("append").parquet(src)
        start_enrichment_batchwise(
            spark.readStream.schema(SNAPSHOT_ROW).parquet(src), sink, state, ck, ("timestamp", "src_offset")
        ).awaitTermination()
    assert sorted(os.listdir(state)) == ["batch_id=2", "batch_id=3"]
    got = explode_metrics(spark.read.parquet(sink).drop("batch_id"))
    want = explode_metrics(enrich(snaps.where(F.col("timestamp") <= days[3])))
    assert _same(got, want)


def test_read_plain_hour_folders(spark, tmp_path):
    snaps = snapshots(table(spark, SF_SMALL, "events"), "cumulative")
    m = enrich(snaps).select("timestamp", "time_delta_ms", "cpu_metrics")
    root = tmp_path / "archive"
    hours = ["2024-01-02--00", "2024-01-03--00"]
    for h, part in zip(hours, m.randomSplit([0.5, 0.5], seed=1)):
        part.write.parquet(str(root / h))
    back = read_archive(spark, str(root), layout="plain")
    assert sorted(r.bucket for r in back.select("bucket").distinct().collect()) == hours
    assert back.count() == m.count()
    assert read_archive(spark, str(root), buckets=[hours[0]], layout="plain").count() < m.count()


@pytest.mark.parametrize("ttl_ms", [None, 200])
def test_group_state_ttl_drops_idle_hosts(spark, ttl_ms):
    """A host idle for longer than the TTL loses its state: its next snapshot
    has no previous one. (Polls progress: with a timeout pending the query is
    never idle, so ``processAllAvailable`` would not return.)"""
    import time

    from conftest import cpu, snapshot_df
    from statflow.streaming.jobs import start_enrichment

    def rows_in(q):
        return sum(p["numInputRows"] for p in q.recentProgress)

    def wait(cond, limit=30):
        t = time.time()
        while not cond() and time.time() - t < limit:
            time.sleep(0.2)

    src, sink, ck = (scratch_path(spark, n) for n in ("ttl-in", "ttl-out", "ttl-ck"))
    snapshot_df(spark, [("h", 0, [cpu("cpu0", 1, idle=1)], 0)]).write.mode("append").parquet(src)
    q = start_enrichment(spark.readStream.schema(SNAPSHOT_ROW).parquet(src), sink, ck,
                         ("src_partition", "src_offset"), trigger="200 milliseconds", ttl_ms=ttl_ms)
    try:
        wait(lambda: rows_in(q) >= 1)
        time.sleep(2.5)  # idle triggers: the timeout fires and drops the state
        snapshot_df(spark, [("h", 1000, [cpu("cpu0", 2, idle=2)], 1)]).write.mode("append").parquet(src)
        wait(lambda: rows_in(q) >= 2)
        time.sleep(1.0)
    finally:
        q.stop()
    assert spark.read.parquet(sink).count() == (1 if ttl_ms is None else 0)


def test_hosts_share_buckets_of_state(spark):
    """40 hosts in 3 buckets: three state rows, and the rows of the batch operator over restarts."""
    from conftest import cpu, snapshot_df
    from statflow.operators.cpu_delta import enrich, explode_metrics
    from statflow.functions.counters import metrics_record
    from statflow.streaming.delta_state import paired_stream

    rows = [(f"h{i % 40}" if i % 40 else None, 1000 * i, [cpu("cpu0", i, idle=i * i)], i) for i in range(120)]
    src, sink, ck = (scratch_path(spark, f"buckets-{n}") for n in ("in", "out", "ck"))
    for a, b in ((0, 50), (50, 55), (55, 120)):
        snapshot_df(spark, rows[a:b]).write.mode("append").parquet(src)
        paired = paired_stream(spark.readStream.schema(SNAPSHOT_ROW).parquet(src), buckets=3)
        metrics = paired.where("prev IS NOT NULL").select("hostname", *metrics_record("prev"))
        q = (metrics.writeStream.format("parquet").option("path", sink).option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] == 3
    got = explode_metrics(spark.read.parquet(sink))
    want = explode_metrics(enrich(snapshot_df(spark, rows), order=("src_partition", "src_offset"), bucket="auto"))
    assert got.count() == want.count() == 80
    assert got.exceptAll(want).count() == 0


def test_ttl_is_kept_per_host_of_a_bucket():
    """A bucket's timeout drops its idle hosts only, and comes again for the others."""
    import pandas as pd
    from statflow.streaming.delta_state import _pairing_with_group_state

    class State:
        hasTimedOut, now, value, timeout = False, 0, None, None
        exists = property(lambda self: self.value is not None)
        get = property(lambda self: self.value)

        def getCurrentProcessingTimeMs(self):
            return self.now

        def update(self, value):
            self.value = value

        def remove(self):
            self.value = None

        def setTimeoutDuration(self, ms):
            self.timeout = ms

    def rows(*found):
        return [pd.DataFrame(found, columns=["hostname", "timestamp", "cpus", "src_offset"])]

    fn, state = _pairing_with_group_state(["src_offset"], 100), State()
    (out,) = fn((0,), rows(("b", 2, "b2", 2), ("a", 1, "a1", 1)), state)
    assert out["has_prev"].tolist() == [False, False] and state.timeout == 100
    state.now = 60
    (out,) = fn((0,), rows(("a", 3, "a3", 3), ("a", 4, "a4", 4)), state)
    assert out["prev_cpus"].tolist() == ["a1", "a3"] and state.timeout == 40
    state.now, state.hasTimedOut = 110, True
    assert list(fn((0,), [], state)) == []
    assert state.value[0] == ["a"] and state.timeout == 50
    state.now = 200
    assert list(fn((0,), [], state)) == [] and state.value is None
