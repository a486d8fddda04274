"""Scale helpers: size-checked broadcast and partition sizing."""

from __future__ import annotations

from statflow.operators.lookup import small_side
from statflow.session import TARGET_PARTITION_BYTES, tune_for_scale

TUNED_KEYS = (
    "spark.sql.files.maxPartitionBytes",
    "spark.sql.shuffle.partitions",
    "spark.sql.adaptive.enabled",
    "spark.sql.adaptive.coalescePartitions.enabled",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    "spark.sql.adaptive.skewJoin.enabled",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
)


def _hinted(df) -> bool:
    return "broadcast" in df._jdf.queryExecution().logical().toString().lower()


def test_small_side_broadcasts_only_under_the_bound(spark):
    df = spark.range(3)
    assert _hinted(small_side(df, max_rows=3))
    assert not _hinted(small_side(df, max_rows=2))


def test_tune_for_scale_sizes_partitions(spark):
    old = {k: spark.conf.get(k, None) for k in TUNED_KEYS}
    try:
        s = tune_for_scale(spark, 100 * 10**12)
        assert set(s) <= set(TUNED_KEYS)
        assert int(s["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // TARGET_PARTITION_BYTES)
        assert tune_for_scale(spark, 10**6)["spark.sql.shuffle.partitions"] == "200"
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(TARGET_PARTITION_BYTES)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
