"""The command line runs the jobs end to end on files."""

from __future__ import annotations

from pyspark.sql import functions as F

from statflow.__main__ import main
from statflow.schemas import SNAPSHOT_AVRO_SCHEMA

DUMP = "cpu0 {u} 0 {s} {i} 0 0 0 0 0 0\nintr 1 2\nctxt 5\n"


def test_cli_publish_job1_job2(spark, tmp_path):
    d = tmp_path / "dumps"
    d.mkdir()
    for host, ts, u, s, i in [("web1", 1000, 10, 5, 100), ("web1", 61000, 40, 15, 150),
                              ("web2", 1000, 0, 0, 0), ("web2", 61000, 50, 0, 50)]:
        (d / f"{host}_{ts}.txt").write_text(DUMP.format(u=u, s=s, i=i))
    (d / "web3_5.txt").write_text("cpu0 1 2\n")  # bad dump → quarantine
    reg = tmp_path / "registry"
    reg.mkdir()
    (reg / "snapshot-1.avsc").write_text(SNAPSHOT_AVRO_SCHEMA)
    frames, out, arch = tmp_path / "frames", tmp_path / "metrics", tmp_path / "archive"

    main(["publish", "--dumps", str(d), "--out", str(frames)])
    assert spark.read.parquet(str(frames) + "_quarantine").count() == 1
    main(["job1", "--frames", str(frames), "--registry", str(reg), "--out", str(out),
          "--checkpoint", str(tmp_path / "ck1"), "--sink", "json"])
    main(["job2", "--json", str(out), "--out", str(arch), "--checkpoint", str(tmp_path / "ck2")])

    rows = spark.read.parquet(str(arch)).select("timestamp", "time_delta_ms", F.inline("cpu_metrics")).collect()
    got = sorted((r.timestamp, r.time_delta_ms, r.user_pct, r.idle_pct) for r in rows)
    # web1: delta user 30, system 10, idle 50 → total 90; web2: user 50, idle 50 → total 100.
    assert got == sorted([(61000, 60000, 30 * 100.0 / 90, 50 * 100.0 / 90), (61000, 60000, 50.0, 50.0)])


def test_cli_job1_batchwise_keeps_hosts(spark, tmp_path):
    d = tmp_path / "dumps"
    d.mkdir()
    for host, ts, u, i in [("web1", 1000, 10, 100), ("web1", 61000, 40, 150), ("web2", 1000, 0, 0),
                           ("web2", 61000, 50, 50)]:
        (d / f"{host}_{ts}.txt").write_text(DUMP.format(u=u, s=0, i=i))
    reg = tmp_path / "registry"
    reg.mkdir()
    (reg / "snapshot-1.avsc").write_text(SNAPSHOT_AVRO_SCHEMA)
    frames, out = tmp_path / "frames", tmp_path / "metrics"
    main(["publish", "--dumps", str(d), "--out", str(frames)])
    main(["job1", "--frames", str(frames), "--registry", str(reg), "--out", str(out),
          "--checkpoint", str(tmp_path / "ck"), "--engine", "batchwise"])
    got = sorted(r.hostname for r in spark.read.parquet(str(out)).collect())
    assert got == ["web1", "web2"]


def test_cli_jobs_set_bad_input_aside(spark, tmp_path):
    reg, lines, frames = tmp_path / "registry", tmp_path / "lines", tmp_path / "frames"
    reg.mkdir()
    (reg / "snapshot-1.avsc").write_text(SNAPSHOT_AVRO_SCHEMA)
    bad = [(None, "null_value"), (b"\x00\x01", "short_frame"), (b"\x01\x00\x00\x00\x01x", "bad_magic"),
           (b"\x00\x00\x00\x00\x09x", "unknown_schema"), (b"\x00\x00\x00\x00\x01", "decode_error")]
    spark.createDataFrame(
        [(bytearray(v) if v is not None else None, 0, i, "h") for i, (v, _) in enumerate(bad)],
        "value BINARY, src_partition INT, src_offset BIGINT, hostname STRING",
    ).write.parquet(str(frames))
    for engine in ("state", "batchwise"):
        out = str(tmp_path / engine)
        main(["job1", "--frames", str(frames), "--registry", str(reg), "--out", out,
              "--checkpoint", str(tmp_path / f"ck-{engine}"), "--engine", engine])
        got = spark.read.parquet(out + "_quarantine").collect()
        assert {(r.src_offset, r.value and bytes(r.value), r.reason) for r in got} == {(i, *b) for i, b in enumerate(bad)}

    lines.mkdir()
    good = '{"timestamp":1,"time_delta_ms":2,"cpu_metrics":[]}'
    (lines / "part-0").write_text(f'{good}\nnot json\n{{"timestamp":1}}\n')
    arch = str(tmp_path / "archive")
    for _ in range(2):  # the second run starts from the checkpoints and adds nothing
        main(["job2", "--json", str(lines), "--out", arch, "--checkpoint", str(tmp_path / "ck2")])
    assert spark.read.parquet(arch).count() == 1
    got = sorted((bytes(r.value), r.reason) for r in spark.read.parquet(arch + "_quarantine").collect())
    assert got == [(b"not json", "bad_json"), (b'{"timestamp":1}', "missing_field")]


def test_cli_places(spark, tmp_path):
    import json

    from statflow.schemas import ELEVATION, GEOCODE, ROUTES

    (tmp_path / "addresses.csv").write_text("address,notes\n1 A St,quiet\nnowhere,x\n")
    (tmp_path / "dest.json").write_text(json.dumps({"Work": "W addr", "Gym": "G addr"}))
    spark.createDataFrame([("1 A St", 0, 1.0, 1.0)], GEOCODE).write.parquet(str(tmp_path / "geo"))
    spark.createDataFrame([(1.0, 1.0, 0, 1609.344)], ELEVATION).write.parquet(str(tmp_path / "elev"))
    spark.createDataFrame([(1.0, 1.0, "W addr", "driving", 1709337600, 0, 0, "7 mins")], ROUTES).write.parquet(
        str(tmp_path / "routes"))
    out = tmp_path / "locations"
    main(["places", "--addresses", str(tmp_path / "addresses.csv"), "--destinations", str(tmp_path / "dest.json"),
          "--geocode", str(tmp_path / "geo"), "--elevation", str(tmp_path / "elev"), "--routes",
          str(tmp_path / "routes"), "--out", str(out), "--as-of", "2024-03-01"])
    assert (out / "1_A_St.txt").read_text() == "1 A St\n\n*** quiet ***\n\nElevation: 5280\nWork: 7 mins\n"
    q = spark.read.parquet(str(out) + "_quarantine").collect()
    assert [(r.address, r.reason) for r in q] == [("nowhere", "address_not_found")]
