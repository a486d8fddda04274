"""Frame parsing, schema lookup and Avro decode/encode (FIXTURES.md §3)."""

from __future__ import annotations

import pyarrow as pa
from conftest import cpu
from pyspark.sql import functions as F

from statflow.functions.avro_binary import decode, encode, parse_schema
from statflow.operators.wire import (
    decode_frames,
    encode_payloads,
    frame,
    good_rows,
    parse_frames,
    quarantine,
    registry_from_envelopes,
    values_of,
)
from statflow.schemas import FRAME, SNAPSHOT, SNAPSHOT_AVRO_SCHEMA


def frames(spark, values):
    return spark.createDataFrame([(v, 0, i) for i, v in enumerate(values)], FRAME)


def test_frame_cases(spark):
    vals = [bytes.fromhex("00000000"), bytes.fromhex("0100000007AA"), bytes.fromhex("00000000070102"), None,
            bytes.fromhex("00FFFFFFFF")]
    out = parse_frames(frames(spark, vals)).orderBy("src_offset").collect()
    assert [r.reason for r in out] == ["short_frame", "bad_magic", None, "null_value", None]
    assert out[2].schema_id == 7 and bytes(out[2].payload) == b"\x01\x02"
    assert out[4].schema_id == -1 and bytes(out[4].payload) == b""


def test_frame_builder_inverts_parse(spark):
    df = spark.createDataFrame([(bytearray(b"\x01\x02"), 7), (bytearray(b""), -5)], "p BINARY, id INT")
    built = df.select(frame(F.col("p"), F.col("id")).alias("value"), F.lit(0).alias("src_partition"),
                      F.lit(0).cast("long").alias("src_offset"))
    got = parse_frames(built).select("schema_id", "payload").collect()
    assert [(r.schema_id, bytes(r.payload)) for r in got] == [(7, b"\x01\x02"), (-5, b"")]


def test_registry_envelope_keeps_only_text(spark):
    env = spark.createDataFrame(
        [(1, '{"schema": "{\\"type\\": \\"long\\"}"}'), (2, '{"schema": {"type": "long"}}'), (3, "not json")],
        "schema_id INT, body STRING",
    )
    rows = registry_from_envelopes(env).collect()
    assert [(r.schema_id, r.schema_json) for r in rows] == [(1, '{"type": "long"}')]


def test_avro_codec_round_trip():
    sc = parse_schema(SNAPSHOT_AVRO_SCHEMA)
    rec = {"timestamp": 1, "cpus": [dict(zip(("id",) + tuple(SNAPSHOT["cpus"].dataType.elementType.names[1:]),
                                             cpu("cpu0", 1, 2, 3, 4)))],
           "intr": [7, 1, 2, 4], "softirq": [], "ctxt": -3, "btime": 0, "processes": 0, "procs_running": 0,
           "procs_blocked": 0}
    assert decode(encode(rec, sc), sc) == rec


def test_decode_quarantines_bad_and_unknown(spark):
    snap = spark.createDataFrame(
        [(1000, [cpu("cpu0", 5)], [7, 1], [], 1, 2, 3, 4, 5)],
        "timestamp BIGINT, cpus ARRAY<STRUCT<id:STRING,user:BIGINT,nice:BIGINT,system:BIGINT,idle:BIGINT,"
        "iowait:BIGINT,irq:BIGINT,softirq:BIGINT,steal:BIGINT,guest:BIGINT,guest_nice:BIGINT>>, intr ARRAY<BIGINT>,"
        " softirq ARRAY<BIGINT>, ctxt BIGINT, btime BIGINT, processes BIGINT, procs_running BIGINT,"
        " procs_blocked BIGINT",
    )
    good = encode_payloads(snap, SNAPSHOT_AVRO_SCHEMA).select(
        frame(F.col("payload"), F.lit(7)).alias("value"), F.lit(0).alias("src_partition"),
        F.lit(0).cast("long").alias("src_offset"))
    bad = frames(spark, [bytes.fromhex("0000000007"), bytes.fromhex("0000000009AA"), bytes.fromhex("000000000702")])
    bad = bad.withColumn("src_offset", F.col("src_offset") + 1)
    reg = spark.createDataFrame([(7, SNAPSHOT_AVRO_SCHEMA)], "schema_id INT, schema_json STRING")
    dec = decode_frames(good.unionByName(bad), reg)
    ok = good_rows(dec).collect()
    assert len(ok) == 1 and ok[0].timestamp == 1000 and ok[0].intr == [7, 1] and ok[0].cpus[0].user == 5
    q = {r.src_offset: r.reason for r in quarantine(dec).collect()}
    assert q == {1: "decode_error", 2: "unknown_schema", 3: "decode_error"}


def test_decode_stream_splits_good_and_bad(spark, tmp_path):
    from statflow.operators.wire import encode_payloads as enc
    from statflow.session import scratch_path
    from statflow.sources.streams import file_frames, read_schema_files
    from statflow.streaming.jobs import start_decode

    (tmp_path / "schemas").mkdir()
    (tmp_path / "schemas" / "snapshot-7.avsc").write_text(SNAPSHOT_AVRO_SCHEMA)
    reg = read_schema_files(spark, str(tmp_path / "schemas"))
    assert [r.schema_id for r in reg.collect()] == [7]

    snap = spark.createDataFrame(
        [(1000, [cpu("cpu0", 5)], [7], [], 1, 2, 3, 4, 5)],
        "timestamp BIGINT, cpus ARRAY<STRUCT<id:STRING,user:BIGINT,nice:BIGINT,system:BIGINT,idle:BIGINT,"
        "iowait:BIGINT,irq:BIGINT,softirq:BIGINT,steal:BIGINT,guest:BIGINT,guest_nice:BIGINT>>, intr ARRAY<BIGINT>,"
        " softirq ARRAY<BIGINT>, ctxt BIGINT, btime BIGINT, processes BIGINT, procs_running BIGINT,"
        " procs_blocked BIGINT",
    )
    good = enc(snap, SNAPSHOT_AVRO_SCHEMA).select(
        frame(F.col("payload"), F.lit(7)).alias("value"), F.lit(0).alias("src_partition"),
        F.lit(0).cast("long").alias("src_offset"))
    bad = frames(spark, [bytes.fromhex("01"), bytes.fromhex("0000000008AA")]).withColumn(
        "src_offset", F.col("src_offset") + 1)
    src = scratch_path(spark, "dec-in")
    good.unionByName(bad).write.parquet(src)
    gp, bp, ck = (scratch_path(spark, n) for n in ("dec-good", "dec-bad", "dec-ck"))
    start_decode(file_frames(spark, src), reg, gp, bp, ck).awaitTermination()
    g = spark.read.parquet(gp).collect()
    b = {r.src_offset: r.reason for r in spark.read.parquet(bp).collect()}
    assert len(g) == 1 and g[0].timestamp == 1000
    assert b == {1: "short_frame", 2: "unknown_schema"}


def test_debug_print_job(spark):
    """Decode frames and print each record as JSON (memory sink here;
    the console sink prints from the JVM, out of pytest's reach)."""
    from statflow.session import scratch_path
    from statflow.sources.streams import file_frames
    from statflow.streaming.jobs import start_debug_print

    snap = spark.createDataFrame(
        [(1000, [cpu("cpu0", 5)], [7], [], 1, 2, 3, 4, 5)],
        "timestamp BIGINT, cpus ARRAY<STRUCT<id:STRING,user:BIGINT,nice:BIGINT,system:BIGINT,idle:BIGINT,"
        "iowait:BIGINT,irq:BIGINT,softirq:BIGINT,steal:BIGINT,guest:BIGINT,guest_nice:BIGINT>>, intr ARRAY<BIGINT>,"
        " softirq ARRAY<BIGINT>, ctxt BIGINT, btime BIGINT, processes BIGINT, procs_running BIGINT,"
        " procs_blocked BIGINT",
    )
    src = scratch_path(spark, "dbg-in")
    encode_payloads(snap, SNAPSHOT_AVRO_SCHEMA).select(
        frame(F.col("payload"), F.lit(7)).alias("value"), F.lit(0).alias("src_partition"),
        F.lit(0).cast("long").alias("src_offset")).write.parquet(src)
    reg = spark.createDataFrame([(7, SNAPSHOT_AVRO_SCHEMA)], "schema_id INT, schema_json STRING")
    start_debug_print(file_frames(spark, src), reg, scratch_path(spark, "dbg-ck"),
                      memory_table="debug_records").awaitTermination()
    out = [r.value for r in spark.table("debug_records").collect()]
    assert len(out) == 1 and '"timestamp":1000' in out[0] and '"id":"cpu0"' in out[0]


def test_most_frames_meet_a_schema(spark):
    from statflow.plans import queries

    got = queries.queries()["schema_lookup_table_ids"](spark, "/root/testdata/sf0.01")
    framed = got.where(F.col("schema_id").isNotNull())
    assert framed.where(F.col("schema_name").isNotNull()).count() > 0.8 * framed.count()
    assert framed.where(F.col("reason") == "unknown_schema").count() > 0


def test_values_of_equals_to_pylist():
    item = pa.struct([("id", pa.string()), ("n", pa.int64()), ("x", pa.float64())])
    rows = [[{"id": "a", "n": 1, "x": 0.5}, None], None, [], [{"id": None, "n": None, "x": None}, {"id": "é", "n": 2**62, "x": 1.0}]]
    for column in (pa.array(rows, pa.list_(item)), pa.array([1, None]), pa.array([[1, 2], [None], None]), pa.array([b"a", None])):
        for at in range(len(column) + 1):
            assert values_of(column[at:]) == column[at:].to_pylist()
