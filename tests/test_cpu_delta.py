"""Hand-computed cases (FIXTURES.md §3) for the batch delta operator."""

from __future__ import annotations

import pytest
from conftest import cpu, snapshot_df
from pyspark.sql import functions as F

from statflow.operators.cpu_delta import enrich, explode_metrics
from statflow.operators.previous import time_bucket, with_previous, with_previous_simple


def run(spark, rows, **kw):
    out = enrich(snapshot_df(spark, rows), **kw).orderBy("hostname", "timestamp").collect()
    return [r.asDict(recursive=True) for r in out]


def test_normal(spark):
    out = run(
        spark,
        [
            ("h", 1000, [cpu("cpu0", 100, 0, 50, 800, 50)], 0),
            ("h", 61000, [cpu("cpu0", 130, 0, 60, 850, 60)], 1),
        ],
    )
    assert len(out) == 1
    r = out[0]
    assert r["timestamp"] == 61000 and r["time_delta_ms"] == 60000
    m = r["cpu_metrics"][0]
    assert (m["cpu_id"], m["user_pct"], m["system_pct"], m["idle_pct"], m["iowait_pct"], m["total_busy_pct"]) == (
        "cpu0", 30.0, 10.0, 50.0, 10.0, 50.0)


def test_hidden_share_counts_in_total(spark):
    out = run(spark, [("h", 0, [cpu("cpu0")], 0), ("h", 1, [cpu("cpu0", 0, 10, 0, 50, 0, 10, 10, 20)], 1)])
    m = out[0]["cpu_metrics"][0]
    assert (m["user_pct"], m["system_pct"], m["idle_pct"], m["iowait_pct"], m["total_busy_pct"]) == (
        0.0, 0.0, 50.0, 0.0, 50.0)


def test_first_snapshot_emits_nothing(spark):
    assert run(spark, [("h", 5, [cpu("cpu0", 1)], 0)]) == []


def test_no_progress_keeps_empty_array(spark):
    c = cpu("cpu0", 5, 1, 1, 1)
    out = run(spark, [("h", 0, [c], 0), ("h", 1, [c], 1)])
    assert len(out) == 1 and out[0]["cpu_metrics"] == []


def test_new_cpu_skipped(spark):
    out = run(spark, [("h", 0, [cpu("cpu0", 1)], 0), ("h", 1, [cpu("cpu0", 2), cpu("cpu1", 5)], 1)])
    assert [m["cpu_id"] for m in out[0]["cpu_metrics"]] == ["cpu0"]


def test_cpu_returning_after_gap_is_skipped(spark):
    out = run(
        spark,
        [
            ("h", 0, [cpu("cpu0", 1), cpu("cpu1", 1)], 0),
            ("h", 1, [cpu("cpu0", 2)], 1),
            ("h", 2, [cpu("cpu0", 3), cpu("cpu1", 9)], 2),
        ],
    )
    assert [m["cpu_id"] for m in out[1]["cpu_metrics"]] == ["cpu0"]


def test_reset_total_not_positive_dropped(spark):
    out = run(spark, [("h", 0, [cpu("cpu0", 100, 0, 0, 900)], 0), ("h", 1, [cpu("cpu0", 1, 0, 0, 9)], 1)])
    assert out[0]["cpu_metrics"] == []


def test_partial_reset_kept_unclamped(spark):
    out = run(spark, [("h", 0, [cpu("cpu0", 100)], 0), ("h", 1, [cpu("cpu0", 50, 0, 0, 150)], 1)])
    m = out[0]["cpu_metrics"][0]
    assert (m["user_pct"], m["idle_pct"], m["total_busy_pct"]) == (-50.0, 150.0, -50.0)


def test_duplicate_id_in_previous_first_wins(spark):
    out = run(spark, [("h", 0, [cpu("cpu0", 0), cpu("cpu0", 5)], 0), ("h", 1, [cpu("cpu0", 10)], 1)])
    assert out[0]["cpu_metrics"][0]["user_pct"] == 100.0


def test_duplicate_id_in_current_both_emitted(spark):
    out = run(spark, [("h", 0, [cpu("cpu0", 0)], 0), ("h", 1, [cpu("cpu0", 10), cpu("cpu0", 20, 0, 0, 20)], 1)])
    assert len(out[0]["cpu_metrics"]) == 2


def test_late_record_negative_delta_when_ordered_by_offset(spark):
    rows = [("h", 61000, [cpu("cpu0", 1)], 0), ("h", 1000, [cpu("cpu0", 2)], 1)]
    out = run(spark, rows, order=("src_offset",), bucket=time_bucket("src_offset", 1000))
    assert out[0]["time_delta_ms"] == -60000


def test_missing_hostname_is_unknown(spark):
    out = run(spark, [(None, 0, [cpu("cpu0", 1)], 0), (None, 1, [cpu("cpu0", 2)], 1)])
    assert out[0]["hostname"] == "unknown"


def test_overflow_drops_cpu_instead_of_failing(spark):
    big = 2**63 - 1
    out = run(spark, [("h", 0, [cpu("cpu0", -big)], 0), ("h", 1, [cpu("cpu0", big)], 1)])
    assert out[0]["cpu_metrics"] == []


def test_idle_plus_busy_is_100(spark):
    from statflow.plans.fixtures import snapshots, table

    m = explode_metrics(enrich(snapshots(table(spark, "/root/testdata/sf0.001", "events"))))
    bad = m.where(F.abs(F.col("idle_pct") + F.col("total_busy_pct") - 100.0) > 1e-9).count()
    assert bad == 0


@pytest.mark.parametrize("width", [1, 2, 3, 1000])
def test_stitching_matches_one_task_per_key(spark, width):
    """Bucketed previous-row equals the plain lag, for any bucket width,
    including empty buckets between non-empty ones."""
    rows = [("a" if i % 3 else "b", ts, [cpu("cpu0", ts)], i) for i, ts in enumerate([0, 1, 2, 5, 6, 9, 10, 11, 30, 31])]
    df = snapshot_df(spark, rows).select("hostname", "timestamp", "src_offset", "cpus")
    order = ["timestamp", "src_offset"]
    got = with_previous(df, "hostname", order, ["timestamp", "cpus"], time_bucket("timestamp", width))
    want = with_previous_simple(df, "hostname", order, ["timestamp", "cpus"])
    cols = ["hostname", "timestamp", "src_offset", "prev"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))


def test_snapshot_count_invariant(spark):
    """Emitted snapshots = snapshots - hosts."""
    from statflow.plans.fixtures import snapshots, table

    snaps = snapshots(table(spark, "/root/testdata/sf0.001", "events"))
    n, hosts = snaps.count(), snaps.select("hostname").distinct().count()
    assert enrich(snaps).count() == n - hosts


@pytest.mark.parametrize("target", [1, 2, 3, 100])
def test_auto_buckets_match_one_task_per_key(spark, target):
    """Adaptive buckets: a hot key split into ~target-row buckets gives the
    same previous rows as the plain lag."""
    ts = [0, 1, 2, 5, 6, 9, 10, 11, 30, 31, 32, 40, 41, 50]
    rows = [("hot", t, [cpu("cpu0", t)], i) for i, t in enumerate(ts)] + [("cold", 3, [cpu("cpu0", 1)], 99)]
    df = snapshot_df(spark, rows).select("hostname", "timestamp", "src_offset", "cpus")
    order = ["timestamp", "src_offset"]
    got = with_previous(df, "hostname", order, ["timestamp", "cpus"], "auto", target_rows=target)
    want = with_previous_simple(df, "hostname", order, ["timestamp", "cpus"])
    cols = ["hostname", "timestamp", "src_offset", "prev"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    from statflow.operators.previous import order_splitters

    n_buckets = order_splitters(df, "hostname", order, target).where("hostname = 'hot'").count()
    assert n_buckets >= (0 if target >= len(ts) else 1)


@pytest.mark.parametrize("fan", [256, 4])
def test_row_buckets_follow_rows_not_values(spark, fan, monkeypatch):
    """An outlier, offsets 1e9 apart near the ends of bigint, nulls in the order and a
    hot key: buckets hold at most twice the target, and the previous rows are those of the plain lag."""
    from statflow.operators import previous as P

    monkeypatch.setattr(P, "FAN", fan)
    target, n = 500, 20_000
    rows = [("hot", 9 * 10**18 - i * 1_000_000_000 if i else -(9 * 10**18), i % 7, str(i)) for i in range(n)]
    rows += [(f"k{i % 40}", (i * 7919) % 10_007, i, str(i)) for i in range(3000)] + [(None, None, 1, "x"), (None, 5, None, "y"), ("hot", None, 0, "z")]
    df = spark.createDataFrame(rows, "k string, t long, u long, x string").repartition(6)
    keyed = df.withColumn("k", F.coalesce("k", F.lit("")))
    got = P.with_previous_rows(df, "k", ["t", "u"], ["x"], target_rows=target)
    want = P.with_previous_simple(keyed, "k", ["t", "u"], ["x"]).select("k", "t", "u", "x", "prev")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    splitters = P.order_splitters(keyed, "k", ["t", "u"], target)
    sizes = P.with_row_buckets(keyed, "k", ["t", "u"], splitters).groupBy("k", "__bkt").count()
    assert sizes.agg(F.max("count")).first()[0] <= 2 * target
    assert sizes.where("k = 'hot'").count() >= n // (2 * target)
    coarser = P.order_splitters(keyed, "k", ["t", "u"], target, max_splitters=5)
    assert 0 < coarser.count() <= 5
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1
    empty = P.with_previous_rows(df.limit(0), "k", ["t", "u"], ["x"])
    assert empty.columns == ["k", "t", "u", "x", "prev"] and empty.count() == 0


def test_broker_order_across_partitions(spark):
    """Order (partition, offset): the last row of partition 0 (a high offset)
    precedes the first row of partition 1 (offset 0)."""
    from statflow.schemas import SNAPSHOT_ROW

    rows = [("h", 1, [cpu("cpu0", 1, idle=1)], [], [], 0, 0, 0, 0, 0, 0, 5_000_000),
            ("h", 2, [cpu("cpu0", 2, idle=2)], [], [], 0, 0, 0, 0, 0, 1, 0)]
    df = spark.createDataFrame(rows, SNAPSHOT_ROW)
    out = enrich(df, order=("src_partition", "src_offset")).collect()
    assert [(r.timestamp, r.time_delta_ms) for r in out] == [(2, 1)]
