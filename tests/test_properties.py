"""Property tests: random inputs against simple reference implementations."""

from __future__ import annotations

from conftest import cpu, snapshot_df
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from statflow.functions.avro_binary import decode, encode, parse_schema
from statflow.operators.previous import time_bucket, with_previous, with_previous_simple
from statflow.operators.wire import parse_frames
from statflow.schemas import FRAME, SNAPSHOT_AVRO_SCHEMA

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), st.integers(-50, 200)),
    min_size=1,
    max_size=40,
)


@SETTINGS
@given(rows=rows_strategy, width=st.integers(1, 60), auto=st.booleans())
def test_previous_row_equals_plain_lag(spark, rows, width, auto):
    data = [(h, ts, [cpu("c", ts)], i) for i, (h, ts) in enumerate(rows)]
    df = snapshot_df(spark, data).select("hostname", "timestamp", "src_offset", "cpus").fillna({"hostname": ""})
    order = ["timestamp", "src_offset"]
    bucket = "auto" if auto else time_bucket("timestamp", width)
    got = with_previous(df, "hostname", order, ["timestamp", "cpus"], bucket, target_rows=max(1, width // 10))
    want = with_previous_simple(df, "hostname", order, ["timestamp", "cpus"])
    cols = ["hostname", "timestamp", "src_offset", "prev"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))


def _expected_frame(v: bytes | None):
    if v is None:
        return ("null_value", None, None)
    if len(v) < 5:
        return ("short_frame", None, None)
    if v[0] != 0:
        return ("bad_magic", None, None)
    return (None, int.from_bytes(v[1:5], "big", signed=True), v[5:])


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), st.binary(max_size=12),
                                 st.binary(min_size=4, max_size=10).map(lambda b: b"\x00" + b)), min_size=1, max_size=30))
def test_frame_parse_matches_python(spark, values):
    df = spark.createDataFrame([(v, 0, i) for i, v in enumerate(values)], FRAME)
    got = {r.src_offset: (r.reason, r.schema_id, None if r.payload is None else bytes(r.payload))
           for r in parse_frames(df).collect()}
    assert got == {i: _expected_frame(v) for i, v in enumerate(values)}


longs = st.integers(-(2**63), 2**63 - 1)
cpu_rec = st.builds(
    lambda i, *c: dict(zip(("id", "user", "nice", "system", "idle", "iowait", "irq", "softirq", "steal", "guest",
                            "guest_nice"), (i, *c))),
    st.text(max_size=6), *([longs] * 10),
)
snapshot_rec = st.builds(
    lambda ts, cpus, intr, soft, *s: dict(timestamp=ts, cpus=cpus, intr=intr, softirq=soft, ctxt=s[0], btime=s[1],
                                          processes=s[2], procs_running=s[3], procs_blocked=s[4]),
    longs, st.lists(cpu_rec, max_size=4), st.lists(longs, max_size=5), st.lists(longs, max_size=5), *([longs] * 5),
)


@settings(max_examples=200, deadline=None)
@given(rec=snapshot_rec)
def test_avro_codec_round_trip(rec):
    schema = parse_schema(SNAPSHOT_AVRO_SCHEMA)
    assert decode(encode(rec, schema), schema) == rec


TOTAL = ("user", "nice", "system", "idle", "iowait", "irq", "softirq", "steal")
ALL = TOTAL + ("guest", "guest_nice")


def _expected_metrics(cur, prev):
    out = []
    for c in cur:
        p = next((q for q in prev if q["id"] == c["id"]), None)
        if p is None:
            continue
        d = {n: c[n] - p[n] for n in TOTAL}
        total = sum(d.values())
        if total > 0:
            out.append((c["id"], d["user"] * 100.0 / total, d["system"] * 100.0 / total,
                        d["idle"] * 100.0 / total, d["iowait"] * 100.0 / total,
                        (total - d["idle"]) * 100.0 / total))
    return out


cpu_entry = st.builds(lambda i, *v: {"id": f"cpu{i}", **dict(zip(ALL, v))},
                      st.integers(0, 5), *([st.integers(0, 50)] * len(ALL)))


@SETTINGS
@given(pairs=st.lists(st.tuples(st.lists(cpu_entry, max_size=6), st.lists(cpu_entry, max_size=6)),
                      min_size=1, max_size=8),
       same_order=st.booleans())
def test_cpu_metrics_match_the_loop(spark, pairs, same_order):
    from pyspark.sql import functions as F

    from statflow.functions.counters import cpu_metrics
    from statflow.schemas import CPU

    if same_order:  # mostly the positional path: previous ids in the same order
        pairs = [(cur, [dict(c, **{n: max(0, c[n] - 3) for n in ALL}) for c in cur]) for cur, _ in pairs]
    schema = f"k INT, cpus ARRAY<{CPU.simpleString()}>, prev ARRAY<{CPU.simpleString()}>"
    rows = [(k, [tuple(c[f] for f in ("id",) + ALL) for c in cur], [tuple(c[f] for f in ("id",) + ALL) for c in prev])
            for k, (cur, prev) in enumerate(pairs)]
    df = spark.createDataFrame(rows, schema)
    got = {r.k: [tuple(m) for m in r.m] for r in df.select("k", cpu_metrics(F.col("cpus"), F.col("prev")).alias("m")).collect()}
    assert got == {k: _expected_metrics(cur, prev) for k, (cur, prev) in enumerate(pairs)}
