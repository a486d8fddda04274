"""JSON snapshots: coercion per counter, missing against null, numbers out of range, the split table."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from statflow.operators.cpu_delta import enrich, explode_metrics
from statflow.operators.snapshot_json import snapshots_from_json
from statflow.schemas import SNAPSHOT, SNAPSHOT_AVRO_SCHEMA, TOTAL_COUNTERS
from statflow.streaming.jobs import SNAPSHOT_SPLIT, split_faults, split_part, start_split


def document(**over):
    cpu = {"id": "cpu0"} | {c: 1 for c in TOTAL_COUNTERS} | over.pop("cpu", {})
    doc = {"timestamp": 1000, "cpus": [{k: v for k, v in cpu.items() if v != "-"}]} | over
    return json.dumps({k: v for k, v in doc.items() if v != "-"})


def read(spark, *values):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, src_offset long")
    return [r for r in snapshots_from_json(df).orderBy("src_offset").collect()]


def test_counters_are_coerced(spark):
    cpu = {"id": 7, "user": "12", "nice": 3.9, "system": True, "idle": None, "iowait": "zz", "irq": {"x": 1}, "softirq": -4, "steal": "2.5"}
    (r,) = read(spark, document(cpu=cpu, intr=["5", 6.5, None], ctxt="8", timestamp="9007199254740993"))
    c = r["cpus"][0]
    assert r["reason"] is None and r["timestamp"] == 9007199254740993
    assert [c[n] for n in ("id", *TOTAL_COUNTERS, "guest", "guest_nice")] == ["7", 12, 3, 1, 0, 0, 0, -4, 2, 0, 0]
    assert (r["intr"], r["softirq"], r["ctxt"], r["btime"]) == ([5, 6, 0], [], 8, 0)


def test_missing_is_not_null(spark):
    rows = read(
        spark, document(timestamp=None), document(timestamp="-"), document(cpus=None), document(cpus="-"), document(cpus="text"),
        document(cpu={"steal": "-"}), document(cpu={"guest": "-"}), document(cpu={"id": None}), document(cpu={"id": "-"}), document(cpus=[3]),
    )
    assert [r["reason"] for r in rows] == [
        None, "missing_field", None, "missing_field", None, "missing_field", None, None, "missing_field", "missing_field"]
    assert rows[0]["timestamp"] == 0 and rows[2]["cpus"] == [] == rows[4]["cpus"] and rows[7]["cpus"][0]["id"] == "null"
    assert rows[1]["cpus"] is None and rows[1]["value"] is not None


def test_out_of_range_and_unreadable(spark):
    rows = read(
        spark, document(cpu={"user": 1e30}), document(cpu={"guest": "99999999999999999999"}), document(intr=[1, 2**63]),
        document(ctxt=2**63 - 1), document(timestamp=-(2**63)), document(timestamp=2**63), "{", "", None, "[]", "3",
    )
    assert [r["reason"] for r in rows] == [
        "out_of_range", "out_of_range", "out_of_range", None, None, "out_of_range", "bad_json", "bad_json", "null_value",
        "missing_field", "missing_field"]
    assert rows[3]["ctxt"] == 2**63 - 1


def test_hosts(spark):
    rows = read(spark, document(), document(hostname=None), document(hostname="a"), document(hostname=5), document(hostname=True), document(hostname={"x": 1}), document(hostname=""))
    assert [r["hostname"] for r in rows] == [None, None, "a", "5", "true", "", ""]
    lines = [document(hostname=None), document(timestamp=3000, cpu={"user": 5, "idle": 5})]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(lines)], "value string, src_offset long")
    (m,) = explode_metrics(enrich(snapshots_from_json(df), bucket="auto")).collect()
    assert (m["hostname"], m["time_delta_ms"], m["user_pct"]) == ("unknown", 2000, 50.0)


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([], "value string, src_offset long, reason string, hostname string")
    assert snapshots_from_json(df).count() == 0
    (r,) = snapshots_from_json(spark.createDataFrame([(document(), "x", "y")], "value string, reason string, cpus string")).collect()
    assert r["reason"] is None and len(r["cpus"]) == 1


def test_split_table_reads_back_both_parts(spark, tmp_path):
    lines = [document(hostname="h"), "{", document(timestamp="-"), document(timestamp=2000)]
    src, split = str(tmp_path / "in"), str(tmp_path / "split")
    spark.createDataFrame([(v, 0, i) for i, v in enumerate(lines)], "value string, src_partition int, src_offset long").write.parquet(src)
    stream = spark.readStream.schema("value STRING, src_partition INT, src_offset LONG").parquet(src)
    for _ in range(2):  # the second run finds nothing new
        start_split(snapshots_from_json(stream), split, str(tmp_path / "ck")).awaitTermination()
    good = split_part(spark, split, SNAPSHOT_SPLIT, streaming=False)
    assert sorted(r["src_offset"] for r in good.collect()) == [0, 3]
    bad = {r["src_offset"]: (r["reason"], r["value"]) for r in split_faults(spark, split, SNAPSHOT_SPLIT).collect()}
    assert bad == {1: ("bad_json", "{"), 2: ("missing_field", lines[2])}
    assert spark.read.schema(SNAPSHOT_SPLIT).parquet(split).where(F.col("reason") == "ok").where("value is not null").count() == 0


def test_schema_document_follows_the_struct():
    doc = json.loads(SNAPSHOT_AVRO_SCHEMA)
    assert [f["name"] for f in doc["fields"]] == SNAPSHOT.names
    assert (doc["namespace"], doc["name"], doc["fields"][1]["type"]["items"]["name"]) == ("local.metrics", "ProcStatSnapshot", "CpuStat")
