"""Job 2 with files of a bounded size: file counts, replays, one parse for good and bad lines."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from statflow.operators.metrics_json import metrics_from_json, read_archive, with_hour_bucket
from statflow.session import scratch_path
from statflow.streaming.archive import TASK_BYTES, file_plan, start_sized_archive, task_count, write_sized

HOUR = 3_600_000
LINE = '{"timestamp":%d,"time_delta_ms":%d,"cpu_metrics":[]}'


def _sized(spark, lines):
    rows = metrics_from_json(spark.createDataFrame([(x,) for x in lines], "value string"))
    good = with_hour_bucket(rows.where(F.col("reason").isNull()))
    return good.select(
        "hostname", "timestamp", "time_delta_ms", "cpu_metrics", "bucket",
        F.octet_length("value").alias("n_bytes"), F.xxhash64("value").alias("salt"),
    )


def _files(path):
    found = {}
    for f in glob.glob(f"{path}/bucket=*/batch_id=*/*.parquet"):
        found.setdefault(f.split("bucket=")[1].split("/")[0], []).append(f)
    return found


def test_file_plan_by_hand(spark):
    rows = spark.createDataFrame([("a", 60), ("a", 50), ("b", 10), ("c", 399)], "bucket string, n_bytes int")
    got = [tuple(r) for r in file_plan(rows, 100).orderBy("bucket").collect()]
    assert got == [("a", 1, 0), ("b", 1, 1), ("c", 3, 2)]


def test_file_sizes_and_replay(spark):
    """A hot hour is split, a rare one has one file; the same batch again changes nothing."""
    lines = [LINE % (i, i) for i in range(2000)] + [LINE % (5 * HOUR + i, 1) for i in range(3)]
    path = scratch_path(spark, "sized")
    target = 10_000
    size = sum(map(len, lines[:2000]))
    for _ in range(2):
        n = write_sized(_sized(spark, lines).repartition(16), path, 7, target)
        files = _files(path)
        hot, rare = files["1970-01-01--00"], files["1970-01-01--05"]
        assert (len(hot), len(rare)) == (size // target, 1) and n == len(hot) + 1
        back = read_archive(spark, path)
        assert back.columns == ["timestamp", "time_delta_ms", "cpu_metrics", "hostname", "bucket"]
        assert back.count() == len(lines) == back.distinct().count()
    rows = [spark.read.parquet(f).count() for f in hot]
    assert max(rows) < 2 * min(rows)
    write_sized(_sized(spark, lines[-1:]), path, 8, target)  # another batch adds its own files
    assert len(_files(path)["1970-01-01--05"]) == 2


@pytest.mark.parametrize("offsets", [False, True])
def test_stream_good_and_bad(spark, offsets):
    """Two batches, with and without offsets; unreadable lines are kept; empty input gives nothing."""
    schema = "value string" + (", src_partition int, src_offset long" if offsets else "")
    src, arch, bad, ck = (scratch_path(spark, f"sized-{n}") for n in ("in", "out", "bad", "ck"))

    def arrive(lines):
        rows = [(x, 0, i) if offsets else (x,) for i, x in enumerate(lines)]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        start_sized_archive(spark.readStream.schema(schema).parquet(src), arch, bad, ck, 200).awaitTermination()

    arrive([])
    assert not os.path.exists(arch)
    same = [LINE % (1, 1)] * 40
    arrive([*same, "{", None, "{}", LINE % (HOUR, 2)])
    arrive([LINE % (2, 3)])
    back = sorted((r.timestamp, r.time_delta_ms) for r in read_archive(spark, arch).collect())
    assert back == [(1, 1)] * 40 + [(2, 3), (HOUR, 2)]
    assert sorted(r.reason for r in spark.read.parquet(bad).collect()) == ["bad_json", "bad_json", "missing_field"]
    if offsets:  # equal lines with offsets are dealt over the hour's files
        assert len(_files(arch)["1970-01-01--00"]) > 2


def test_task_count_by_hand():
    assert task_count(3, 40, 10_000, 8) == 8  # small files: as many tasks as there are cores
    assert task_count(20, 40, 10_000, 8) == 20  # no task gets two files of one hour
    assert task_count(1, 40, 30 * TASK_BYTES, 8) == 30
    assert task_count(1, 4, 30 * TASK_BYTES, 8) == 4


def test_a_task_writes_files_of_many_hours(spark):
    """All files of the plan are there, by fewer tasks, and no task has two of one hour."""
    lines = [LINE % (h * HOUR + i, i) for h in range(40) for i in range(60 if h else 900)]
    path, target = scratch_path(spark, "dealt"), 1000
    size = {}
    for line in lines:
        size.setdefault(int(line.split(":")[1].split(",")[0]) // HOUR, []).append(len(line))
    n = write_sized(_sized(spark, lines).repartition(4), path, 0, target)
    files = _files(path)
    assert len(files) == 40 and n == sum(map(len, files.values()))
    assert sorted(map(len, files.values())) == sorted(sum(b) // target for b in size.values())
    tasks = {h: [os.path.basename(f).split("-")[1] for f in names] for h, names in files.items()}
    assert all(len(set(t)) == len(t) for t in tasks.values())
    assert len({x for t in tasks.values() for x in t}) == max(map(len, files.values())) < n
    back = read_archive(spark, path)
    assert back.count() == len(lines) == back.distinct().count()
