"""/proc/stat dump parsing (FIXTURES.md §3: dump lines)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from statflow.operators.procstat import find_bad_line, parse_dumps, read_dump_files, read_dump_log, render_dump, write_dump_log

DUMP = (
    "cpu  10 1 2 3 4 5 6 7 8 9\n"
    "cpu0 1 2 3 4 5 6 7 8 9 10\n"
    "cpuidle 3\n"
    "intr 7 1 2 4\n"
    "ctxt 99\nbtime 5\nprocesses 12\nprocs_running 2\nprocs_blocked 0\n"
    "softirq 1 2\n"
)


def dumps(spark, rows):
    return spark.createDataFrame(rows, "hostname STRING, timestamp BIGINT, text STRING")


def test_parse_full_dump(spark):
    r = parse_dumps(dumps(spark, [("h", 1, DUMP)])).first()
    assert r.reason is None
    assert [c.id for c in r.cpus] == ["cpu", "cpu0"]
    assert r.cpus[1].guest_nice == 10 and r.cpus[0].user == 10
    assert r.intr == [7, 1, 2, 4] and r.softirq == [1, 2]
    assert (r.ctxt, r.btime, r.processes, r.procs_running, r.procs_blocked) == (99, 5, 12, 2, 0)


def test_defaults_and_blank_lines(spark):
    r = parse_dumps(dumps(spark, [("h", 1, "\n\nctxt 3\n\n")])).first()
    assert r.reason is None and r.cpus == [] and r.intr == [] and r.ctxt == 3 and r.btime == 0


def test_repeated_line_last_wins(spark):
    r = parse_dumps(dumps(spark, [("h", 1, "ctxt 1\nctxt 2\nintr 1\nintr 5 6")])).first()
    assert r.ctxt == 2 and r.intr == [5, 6]


def test_bad_lines_are_flagged(spark):
    rows = [("h", 1, "cpu0 1 2 3\n"), ("h", 2, "ctxt x\n"), ("h", 3, "intr 1 z\n"), ("h", 4, None)]
    got = {r.timestamp: r.reason for r in parse_dumps(dumps(spark, rows)).collect()}
    assert got == {1: "bad_line", 2: "bad_line", 3: "bad_line", 4: "null_text"}


def test_render_parse_round_trip(spark):
    src = parse_dumps(dumps(spark, [("h", 1, DUMP)]))
    again = parse_dumps(src.select("hostname", "timestamp", render_dump().alias("text")))
    cols = ["cpus", "intr", "softirq", "ctxt", "btime", "processes", "procs_running", "procs_blocked"]
    assert src.select(cols).first() == again.select(cols).first()


def test_read_dump_files(spark, tmp_path):
    d = tmp_path / "dumps"
    d.mkdir()
    (d / "web01_1700000000000.txt").write_text(DUMP)
    df = parse_dumps(read_dump_files(spark, str(d)))
    r = df.first()
    assert (r.hostname, r.timestamp, len(r.cpus)) == ("web01", 1700000000000, 2)
    assert os.path.exists(d)
    assert df.where(F.col("reason").isNotNull()).count() == 0


def test_first_bad_line_is_found(spark):
    cpu = "cpu0 1 2 3 4 5 6 7 8 9 10"
    cases = [
        ("short", f"{cpu}\n\ncpu1 1 2\ncpu2 x", (3, "cpu1 1 2")),
        ("overridden", f"ctxt x\nintr 1 y\nctxt 5\nsoftirq 1\t z ", (2, "intr 1 y")),
        ("no number", f"{cpu}\nbtime", (2, "btime")),
        ("idle", "cpuidle x\nprocs_running -", (2, "procs_running -")),
        ("null", None, (None, None)),
        ("good", f"{cpu}\nctxt x\nctxt 5\n\n", None),
        ("empty", "", None),
    ]
    rows = dumps(spark, [(name, 1, text) for name, text, _ in cases]).withColumn("raw", F.col("text"))
    bad = find_bad_line(parse_dumps(rows).where("reason IS NOT NULL"), "raw").collect()
    assert {r.hostname: (r.line_no, r.line) for r in bad} == {name: found for name, _, found in cases if found}
    assert {r.hostname: r.reason for r in bad}["null"] == "null_text"


def test_dump_log_round_trip(spark, tmp_path):
    rows = [("h", 1, DUMP), (None, 2, "ctxt 1\n\n"), ("h", 1, DUMP), ("käse", 3, ""), ("x", 4, None)]
    path = str(tmp_path / "log")
    write_dump_log(dumps(spark, rows), path)
    back = [tuple(r) for r in read_dump_log(spark, path).collect()]
    assert sorted(back, key=repr) == sorted(rows, key=repr)
    write_dump_log(dumps(spark, []), path + "0")
    assert read_dump_log(spark, path + "0").count() == 0
