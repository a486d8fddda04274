"""One hot key: plain one-task lag vs the bucketed previous-row operator.

All rows of ``lineitem`` become snapshots of a single host (the reference's
"every host is unknown" case): timestamp from the ship date, arrival order
(timestamp, row id), one CPU whose counters come from the line. Both forms
must give the same pairs; the timing shows what splitting the key buys.

Usage: python tools/hot_key_demo.py [sf_dir] [target_rows] [cpus_per_snapshot] [copies]

``copies`` > 1 repeats the table with shifted offsets to see the trend
beyond one scale factor (a demo of the operator, not a registered query).
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from statflow.operators.previous import with_previous, with_previous_simple  # noqa: E402
from statflow.session import local_session, scratch_path  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    target = int(sys.argv[2]) if len(sys.argv) > 2 else 50_000
    n_cpus = int(sys.argv[3]) if len(sys.argv) > 3 else 1
    copies = int(sys.argv[4]) if len(sys.argv) > 4 else 1
    spark = local_session(8)
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    li = li.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))))
    rows = li.select(
        F.lit("unknown").alias("hostname"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("timestamp"),
        (F.col("copy") * 10**12 + F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("src_offset"),
        F.transform(
            F.sequence(F.lit(0), F.lit(n_cpus - 1)),
            lambda i: F.struct(F.concat(F.lit("cpu"), i.cast("string")).alias("id"),
                               (F.col("l_quantity").cast("long") + i).alias("user"),
                               (F.col("l_partkey") + i).alias("idle")),
        ).alias("cpus"),
    ).dropDuplicates(["timestamp", "src_offset"])
    path = scratch_path(spark, "hot-key")
    rows.write.parquet(path)
    snaps = spark.read.parquet(path)
    n = snaps.count()
    order = ["timestamp", "src_offset"]

    def timed(df):
        t = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    plain = with_previous_simple(snaps, "hostname", order, ["timestamp", "cpus"])
    split = with_previous(snaps, "hostname", order, ["timestamp", "cpus"], "auto", target_rows=target)
    timed(plain), timed(split)  # warm-up
    t_plain = min(timed(plain) for _ in range(3))
    t_split = min(timed(split) for _ in range(3))
    cols = ["timestamp", "src_offset", "prev"]
    diff = plain.select(cols).exceptAll(split.select(cols)).count() + split.select(cols).exceptAll(plain.select(cols)).count()
    print(f"rows={n} cpus/row={n_cpus} one key; plain lag {t_plain:.2f}s (1 task); bucketed auto(target={target}) {t_split:.2f}s; "
          f"differences={diff}")
    spark.stop()


if __name__ == "__main__":
    main()
