"""Keyed state over offset runs: the rows of the batch operator, in groups of bounded size."""

from __future__ import annotations

import pandas as pd
import pytest
from conftest import cpu
from pyspark.sql import functions as F

from statflow.__main__ import main
from statflow.operators.cpu_delta import enrich, explode_metrics
from statflow.schemas import SNAPSHOT_ROW
from statflow.session import scratch_path
from statflow.streaming.delta_runs import RUNS, _link_edges, _pair_run, drain_runs


def _rows(n, hosts, partitions, late_every=7):
    """Snapshots with dense offsets per partition; some come late, some CPUs repeat or vanish."""
    out = []
    for i in range(n):
        partition, offset = i % partitions, i // partitions
        ts = 1000 * i - (5000 if i % late_every == 0 else 0)
        cpus = [cpu("cpu0", i, idle=2 * i), cpu("cpu1", i * i, idle=i)]
        if i % 5 == 0:
            cpus = cpus[:1]
        if i % 11 == 0:
            cpus = [*cpus, cpu("cpu0", 1, idle=1)]
        out.append((hosts[i % len(hosts)], ts, cpus, [], [], 0, 0, 0, 0, 0, partition, offset))
    return out


def _frame(spark, rows):
    return spark.createDataFrame(rows, SNAPSHOT_ROW)


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _batch(snaps):
    """One sequence per host and partition, as one key in the batch operator."""
    host = F.coalesce("hostname", F.lit("unknown"))
    keyed = snaps.withColumn("hostname", F.concat(host, F.lit("/"), "src_partition"))
    found = enrich(keyed, order=("src_partition", "src_offset"), bucket="auto")
    return explode_metrics(found).withColumn("hostname", F.substring_index("hostname", "/", 1))


@pytest.mark.parametrize("run_rows", [1, 1000])
def test_runs_equal_batch_over_restarts(spark, run_rows):
    """Two partitions, a hot key and a rare host, arrivals cut inside runs, three restarts."""
    rows = _rows(90, [None, None, "h1", None], 2)
    src, runs, sink, ck, ck2 = (scratch_path(spark, f"runs-{n}") for n in ("in", "mid", "out", "ck", "ck2"))
    for a, b in ((0, 31), (31, 33), (33, 90)):
        _frame(spark, rows[a:b]).write.mode("append").parquet(src)
        drain_runs(spark.readStream.schema(SNAPSHOT_ROW).parquet(src), runs, sink, ck, ck2, run_rows)
    got = explode_metrics(spark.read.parquet(sink))
    want = _batch(_frame(spark, rows))
    assert got.count() == want.count() > 0
    assert _same(got, want)
    # Every row is in the middle table once; edges are two rows a run and arrival at most.
    middle = spark.read.schema(RUNS).parquet(runs)
    assert middle.count() == len(rows)
    if run_rows == 1000:
        assert middle.where("part = 'edge'").count() <= 2 * 3 * 4


def test_odd_input(spark):
    """No rows at all; null offsets and partitions; equal offsets; no CPUs."""
    src, runs, sink, ck, ck2 = (scratch_path(spark, f"odd-{n}") for n in ("in", "mid", "out", "ck", "ck2"))
    _frame(spark, []).write.parquet(src)
    drain_runs(spark.readStream.schema(SNAPSHOT_ROW).parquet(src), runs, sink, ck, ck2)
    rest = ([], [], 0, 0, 0, 0, 0)
    rows = [("h", 1000, [], *rest, None, None), ("h", 3000, [], *rest, None, None), ("h", 9000, [], *rest, 0, 5), ("h", 8000, [], *rest, 0, 5)]
    _frame(spark, rows).write.mode("append").parquet(src)
    drain_runs(spark.readStream.schema(SNAPSHOT_ROW).parquet(src), runs, sink, ck, ck2)
    got = sorted((r.timestamp, r.time_delta_ms) for r in spark.read.parquet(sink).collect())
    assert got == [(3000, 2000), (9000, 1000)]


class _State:
    def __init__(self):
        self.value = None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value


def _chunks(rows, columns):
    """Rows in chunks and in no order, as they come after a shuffle."""
    frame = pd.DataFrame(rows, columns=columns).sample(frac=1, random_state=3)
    return [frame.iloc[:2], frame.iloc[2:]]


def test_run_and_edges_by_hand():
    columns = ["src_offset", "timestamp", "cpus"]
    (run,) = _pair_run(None, _chunks([(4, 40, []), (5, 50, []), (6, 60, [])], columns), None)
    assert run["opens"].tolist() == [True, False, False] and run["closes"].tolist() == [False, False, True]
    assert [p and p["timestamp"] for p in run["prev"]] == [None, 40, 50]

    columns = ["src_offset", "timestamp", "cpus", "opens", "closes", "prev"]
    state = _State()
    edges = [(4, 40, [], True, False, None), (6, 60, [], False, True, {"timestamp": 50, "cpus": []}), (9, 90, [], True, True, None)]
    (first,) = _link_edges(None, _chunks(edges, columns), state)
    assert [p and p["timestamp"] for p in first["prev"]] == [None, 50, 60]
    (second,) = _link_edges(None, _chunks([(12, 120, [], True, False, None), (15, 150, [], False, True, None)], columns), state)
    assert second["prev"].tolist()[0]["timestamp"] == 90 and state.value[0] == 150


def test_cli_runs_engine(spark, tmp_path):
    line = '{"hostname":"a","timestamp":%d,"cpus":[{"id":"cpu0","user":%d,"nice":0,"system":0,"idle":%d,"iowait":0,"irq":0,"softirq":0,"steal":0,"guest":0,"guest_nice":0}]}'
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.json").write_text("\n".join(line % (1000 * i, 10 * i, 30 * i) for i in range(1, 3)) + "\n")
    out = tmp_path / "out"
    main(["job1", "--json", str(tmp_path / "in"), "--out", str(out), "--checkpoint", str(tmp_path / "ck"), "--engine", "runs"])
    rows = spark.read.parquet(str(out)).select("hostname", "timestamp", F.inline("cpu_metrics")).collect()
    assert [(r.hostname, r.user_pct, r.idle_pct) for r in rows] == [("a", 25.0, 75.0)]


def test_one_group_serves_all_hosts_of_a_run():
    """A run is one call of Python: each host is paired within it, whatever its chunks."""
    columns = ["hostname", "src_offset", "timestamp", "cpus"]
    rows = [("a", 1, 10, "a1"), ("b", 2, 20, "b2"), ("a", 3, 30, "a3"), ("b", 4, 40, "b4"), ("a", 5, 50, "a5")]
    (run,) = _pair_run(None, _chunks(rows, columns), None)
    assert run["hostname"].tolist() == ["a", "a", "a", "b", "b"]
    assert run["opens"].tolist() == [True, False, False, True, False]
    assert run["closes"].tolist() == [False, False, True, False, True]
    assert [p and p["cpus"] for p in run["prev"]] == [None, "a1", "a3", None, "b2"]


def test_one_sequence_over_all_partitions(spark):
    """``by_partition=False``: the rows of the batch operator without a partition in the key."""
    rows = _rows(60, [None, "h1", None], 3)
    src, runs, sink, ck, ck2 = (scratch_path(spark, f"all-{n}") for n in ("in", "mid", "out", "ck", "ck2"))
    _frame(spark, rows).write.parquet(src)
    drain_runs(spark.readStream.schema(SNAPSHOT_ROW).parquet(src), runs, sink, ck, ck2, 4, by_partition=False)
    got = explode_metrics(spark.read.parquet(sink))
    want = explode_metrics(enrich(_frame(spark, rows), order=("src_partition", "src_offset"), bucket="auto"))
    assert got.count() == want.count() > 0
    assert _same(got, want)
    # One CPU array goes through Python as a string, and comes back as it was.
    from statflow.streaming.delta_state import pack_cpus, unpack_cpus

    odd = _frame(spark, [(*_rows(1, ["h"], 1)[0][:2], cpus, *_rows(1, ["h"], 1)[0][3:]) for cpus in ([], [cpu('a"\u00e9\n', 1 << 62), cpu('', -1)])])
    back = odd.select(unpack_cpus(pack_cpus("cpus")).alias("cpus"))
    assert _same(back, odd.select("cpus")) and back.count() == 2
