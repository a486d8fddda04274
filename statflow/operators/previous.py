"""Previous row per key in arrival order, without one task per key.

The plain form is ``lag(...).over(Window.partitionBy(key).orderBy(order))``.
It puts every row of a key into one task, and a single key may hold a third
of all rows (all hosts fall back to ``unknown`` when the hostname is
missing). So the rows of a key are split into buckets of the order (time
buckets, or offset ranges) and ``lag`` runs inside ``(key, bucket)``: the
data is shuffled once, on ``(key, bucket)``. Only the first row of each
bucket needs more, the last row of the previous non-empty bucket:

1. ``lasts``: the rows with no successor in their bucket (one per bucket),
   taken from the same window pass and the same shuffle.
2. ``carry``: each last row labelled with the next non-empty bucket of its
   key (``lead`` over the one-row-per-bucket table), joined to the first row
   of that bucket.

The per-key window in 2 sees one row per bucket, so a hot key costs one task
``#buckets`` rows; choose the bucket width so that stays in the 10^4–10^6
range. The join is over one row per bucket, and AQE may broadcast it once
its real size is known. The bucket column
must be non-decreasing in the order, and the order unique within a key.

``with_previous_rows`` needs no bucket column: it cuts a heavy key at rows of
its own order, and copies the row at each cut into the next bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statflow.session import scratch_path

_BKT = "__bkt"


def time_bucket(col: str | Column, width: int) -> Column:
    """Bucket of a numeric order column (epoch ms, offset): ``floor(c / width)``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.floor(c / F.lit(int(width))).cast("long")


def offset_bucket(partition_col: str, offset_col: str, rows: int) -> Column:
    """Bucket for the broker order ``(partition, offset)``; offsets are dense,
    so a bucket holds at most ``rows`` rows of one partition."""
    return (
        F.col(partition_col).cast("long") * F.lit(1 << 40)
        + F.floor(F.col(offset_col) / F.lit(int(rows))).cast("long")
    )


# Rows per bucket aimed at by ``with_previous_rows``.
DEFAULT_TARGET_ROWS = 500_000
# Sampled rows per bucket: its size then has a standard deviation of about an eighth.
SAMPLE_PER_BUCKET = 64
# Splitters at most, whatever the number of rows: the table that is broadcast.
FAN = 256
MAX_SPLITTERS = FAN * FAN


def order_splitters(
    rows: DataFrame, key: str, order: Sequence[str], target_rows: int = DEFAULT_TARGET_ROWS,
    max_splitters: int = MAX_SPLITTERS,
) -> DataFrame:
    """``(key, __j, __at)``: for each heavy key, the numbered rows of its full order
    that cut it into buckets of about ``target_rows`` rows.

    One pass over key and order columns draws rows by their hash (the same ones
    in any run), ``SAMPLE_PER_BUCKET`` for each ``target_rows``; every
    ``SAMPLE_PER_BUCKET``-th one of a key is a splitter, so splitters follow the
    rows and not the values: outliers and gaps don't matter. Keys with fewer
    drawn rows stay whole. Beyond ``max_splitters`` buckets grow instead, so the
    table is bounded. Rows of equal order stay together.
    """
    per_bucket = min(SAMPLE_PER_BUCKET, target_rows)
    share = per_bucket / target_rows
    slim = rows.select(key, F.struct(*order).alias("__at"))
    drawn = slim.where(F.pmod(F.xxhash64(key, "__at"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    drawn = _written(drawn, "drawn")
    step = max(per_bucket, -(-drawn.count() // max_splitters))
    place = F.row_number().over(Window.partitionBy(key).orderBy("__at"))
    cuts = drawn.withColumn("__n", place).where(F.col("__n") % step == 0).select(key, "__at").distinct()
    return _written(cuts.withColumn("__j", place - 1), "splitters")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _before(splits: Column, at: Column) -> Column:
    """How many of the sorted ``splits`` lie before ``at``, by bisection (null: 0)."""
    halves = F.sequence(F.lit(1), F.ceil(F.log2(F.size(splits) + 1.0)).cast("int"))
    start = F.struct(F.lit(0).alias("lo"), F.size(splits).alias("hi"))

    def step(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        before = (s["lo"] < s["hi"]) & (F.get(splits, mid) < at)
        return F.struct(
            F.when(before, mid + 1).otherwise(s["lo"]).alias("lo"),
            F.when(before | (s["lo"] >= s["hi"]), s["hi"]).otherwise(mid).alias("hi"),
        )

    return F.when(splits.isNull(), F.lit(0)).otherwise(F.aggregate(halves, start, step, lambda s: s["lo"]))


def with_row_buckets(rows: DataFrame, key: str, order: Sequence[str], splitters: DataFrame) -> DataFrame:
    """Add ``__bkt``, the number of the key's splitters before the row, and ``__ends``,
    whether the row is a splitter itself, the last of its bucket.

    Splitters are looked up in two steps of ``FAN`` each, so that a row never
    carries more than ``FAN`` of them; both tables are broadcast, of at most
    ``MAX_SPLITTERS`` rows' worth.
    """
    at = F.struct(*order)
    group = F.floor(F.col("__j") / FAN).cast("int")
    sorted_cuts = F.sort_array(F.collect_list("__at"))
    coarse = splitters.where(F.col("__j") % FAN == FAN - 1).groupBy(key).agg(sorted_cuts.alias("__coarse"))
    fine = splitters.groupBy(key, group.alias("__g")).agg(sorted_cuts.alias("__fine"))
    placed = rows.join(F.broadcast(coarse), key, "left").withColumn("__g", _before(F.col("__coarse"), at)).drop("__coarse")
    placed = placed.join(F.broadcast(fine), [key, "__g"], "left").withColumn("__f", _before(F.col("__fine"), at))
    ends = F.coalesce(F.get("__fine", F.col("__f")) == at, F.lit(False))
    return placed.withColumn(_BKT, F.col("__g") * FAN + F.col("__f")).withColumn("__ends", ends).drop("__g", "__f", "__fine")


def with_previous_rows(
    df: DataFrame, key: str, order: Sequence[str], payload: Sequence[str], prev_col: str = "prev",
    target_rows: int = DEFAULT_TARGET_ROWS,
) -> DataFrame:
    """``with_previous`` with buckets bounded by rows, in one shuffle, one sort and one ``lag``.

    A bucket ends at its splitter, which is a row of the key: that row goes into
    its bucket and, flagged, into the next one, where it sorts first and serves
    as the previous row only. So no second window and no join stitch the
    buckets. The input is read twice (once for key and order columns alone):
    materialise a derived input first. The columns are ``key``, ``order``,
    ``payload`` and ``prev_col``; a null key is grouped as ``""``.
    """
    order, payload = list(order), list(payload)
    others = [c for c in order if c not in payload]
    k = F.coalesce(F.col(key), F.lit("")) if df.schema[key].nullable else F.col(key)
    rows = df.select(k.alias(key), *[F.col(c) for c in dict.fromkeys(others + payload)])
    cut = with_row_buckets(rows, key, order, order_splitters(rows, key, order, target_rows))
    own = F.struct(F.col(_BKT).alias("b"), F.lit(False).alias("copy"))
    again = F.struct((F.col(_BKT) + 1).alias("b"), F.lit(True).alias("copy"))
    packed = cut.select(
        key, *others, F.struct(*payload).alias("__row"),
        F.explode(F.when(F.col("__ends"), F.array(own, again)).otherwise(F.array(own))).alias("__place"),
    ).select(key, *others, "__row", F.col("__place.b").alias(_BKT), F.col("__place.copy").alias("__copy"))
    w = Window.partitionBy(key, _BKT).orderBy(*[F.col(c) if c in others else F.col(f"__row.{c}") for c in order])
    paired = packed.withColumn(prev_col, F.lag("__row").over(w)).where(~F.col("__copy"))
    return paired.select(key, *others, *[F.col(f"__row.{c}").alias(c) for c in payload], prev_col)


def with_previous(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    payload: Sequence[str],
    bucket: Column | str,
    prev_col: str = "prev",
    target_rows: int = DEFAULT_TARGET_ROWS,
) -> DataFrame:
    """Add ``prev_col``: ``struct(payload)`` of the previous row of the same key
    in ``order``, null for the first row of a key. The result has the
    columns ``key``, ``order``, ``payload`` and ``prev_col``.

    The key should be non-null (callers default it, e.g. ``unknown``); a
    null key is grouped as ``""``.

    ``bucket``: a column non-decreasing in the order (``time_bucket``,
    ``offset_bucket``), or ``"auto"`` for buckets bounded by rows
    (``with_previous_rows``: the input is read twice then, so materialise a
    derived input first)."""
    order = list(order)
    payload = list(payload)
    if isinstance(bucket, str) and bucket == "auto":
        return with_previous_rows(df, key, order, payload, prev_col, target_rows)
    others = [c for c in order if c not in payload]

    # The payload travels in one struct and the order columns beside it, so
    # all branches below read the same columns and Spark reuses the one
    # shuffle on (key, bucket); the caller should use every payload field.
    # Non-null key and bucket: no IsNotNull filter is inferred into a branch.
    k = F.coalesce(F.col(key), F.lit("")) if df.schema[key].nullable else F.col(key)
    packed = df.select(
        k.alias(key),
        F.coalesce(bucket, F.lit(0).cast("long")).alias(_BKT),
        *[F.col(c) for c in others],
        F.struct(*[F.col(c) for c in payload]).alias("__row"),
    )
    w = Window.partitionBy(key, _BKT).orderBy(
        *[F.col(c) if c in others else F.col(f"__row.{c}") for c in order]
    )
    win = packed.select(
        key,
        _BKT,
        *others,
        "__row",
        F.lag("__row").over(w).alias("__lag"),
        F.lead(F.lit(1)).over(w).isNull().alias("__is_last"),
    )
    def unpack(prev: Column) -> list[Column]:
        return [
            F.col(key),
            *[F.col(c) for c in others],
            *[F.col(f"__row.{c}").alias(c) for c in payload],
            prev.alias(prev_col),
        ]

    interior = win.where(F.col("__lag").isNotNull()).select(*unpack(F.col("__lag")))

    # One row per non-empty bucket: its last row, labelled with the next
    # non-empty bucket of the key.
    carry = (
        win.where(F.col("__is_last"))
        .select(
            key,
            F.lead(_BKT).over(Window.partitionBy(key).orderBy(_BKT)).alias(_BKT),
            F.col("__row").alias("__last"),
        )
        .where(F.col(_BKT).isNotNull())
    )
    firsts = (
        win.where(F.col("__lag").isNull())
        .join(carry, [key, _BKT], "left")
        .select(*unpack(F.col("__last")))
    )
    return interior.unionByName(firsts)


def with_previous_simple(
    df: DataFrame, key: str, order: Sequence[str], payload: Sequence[str], prev_col: str = "prev"
) -> DataFrame:
    """The one-task-per-key form; only for small inputs and as a test oracle."""
    w = Window.partitionBy(key).orderBy(*[F.col(c) for c in order])
    return df.withColumn(prev_col, F.lag(F.struct(*[F.col(c) for c in payload])).over(w))
