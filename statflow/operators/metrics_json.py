"""Metrics records ↔ JSON text.

``metrics_to_json``: the enriched record as one JSON document per row (the
reference's wire format between its two jobs). ``metrics_from_json``: parse
it back, strict (typed ``from_json``) or lenient (Jackson-style coercion on
Variant); rows that cannot be read get a ``reason`` instead of failing the
job (the reference throws on a missing field).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statflow.functions.coerce import as_double, as_long, as_text, field
from statflow.operators.plan_tools import barrier
from statflow.schemas import CPU_METRIC, METRICS

# The archive's hour-bucket directory format.
HOUR_BUCKET_FORMAT = "yyyy-MM-dd--HH"

_METRICS_IN = T.StructType([T.StructField("hostname", T.StringType(), True)] + list(METRICS.fields))
_PCT_FIELDS = [f.name for f in CPU_METRIC.fields if f.name != "cpu_id"]


def metrics_to_json(metrics: DataFrame, with_host: bool = False) -> DataFrame:
    """``value STRING``: ``{"timestamp", "time_delta_ms", "cpu_metrics"}``
    (plus ``hostname`` when asked). Empty ``cpu_metrics`` stay ``[]``."""
    cols = (["hostname"] if with_host else []) + ["timestamp", "time_delta_ms", "cpu_metrics"]
    return metrics.select(F.to_json(F.struct(*cols)).alias("value"))


def _strict(value: Column) -> tuple[Column, Column]:
    parsed = F.from_json(value, _METRICS_IN)
    v = F.try_parse_json(value)
    missing = (
        field(v, "$.timestamp").isNull()
        | field(v, "$.time_delta_ms").isNull()
        | field(v, "$.cpu_metrics").isNull()
        | parsed["timestamp"].isNull()
        | parsed["time_delta_ms"].isNull()
        | parsed["cpu_metrics"].isNull()
        | F.exists(
            F.coalesce(parsed["cpu_metrics"], F.array().cast(T.ArrayType(CPU_METRIC))),
            lambda m: F.greatest(*[m[n].isNull().cast("int") for n in ["cpu_id"] + _PCT_FIELDS]) == 1,
        )
    )
    reason = F.when(v.isNull(), F.lit("bad_json")).when(missing, F.lit("missing_field"))
    return parsed, reason


def _lenient(value: Column) -> tuple[Column, Column]:
    v = F.try_parse_json(value)
    elems = F.coalesce(F.try_variant_get(v, "$.cpu_metrics", "array<variant>"), F.array().cast("array<variant>"))
    metrics = F.transform(
        elems,
        lambda e: F.struct(
            as_text(field(e, "$.cpu_id")).alias("cpu_id"),
            *[as_double(field(e, f"$.{n}")).alias(n) for n in _PCT_FIELDS],
        ),
    )
    parsed = F.struct(
        F.try_variant_get(v, "$.hostname", "string").alias("hostname"),
        as_long(field(v, "$.timestamp")).alias("timestamp"),
        as_long(field(v, "$.time_delta_ms")).alias("time_delta_ms"),
        metrics.alias("cpu_metrics"),
    )
    missing = (
        field(v, "$.timestamp").isNull()
        | field(v, "$.time_delta_ms").isNull()
        | field(v, "$.cpu_metrics").isNull()
        | F.exists(
            elems,
            lambda e: F.greatest(*[field(e, f"$.{n}").isNull().cast("int") for n in ["cpu_id"] + _PCT_FIELDS]) == 1,
        )
    )
    reason = F.when(v.isNull(), F.lit("bad_json")).when(missing, F.lit("missing_field"))
    return parsed, reason


def metrics_from_json(lines: DataFrame, coerce: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """``value STRING`` → ``hostname, timestamp, time_delta_ms, cpu_metrics,
    reason, value`` and the columns to ``keep``; ``reason`` is null for good rows. Split with
    ``split_good_bad`` or filter on ``reason``."""
    parsed, reason = (_lenient if coerce else _strict)(F.col("value"))
    # The barrier keeps a later filter on ``reason`` from re-parsing the JSON.
    return barrier(lines.select(
        parsed["hostname"].alias("hostname"),
        parsed["timestamp"].alias("timestamp"),
        parsed["time_delta_ms"].alias("time_delta_ms"),
        parsed["cpu_metrics"].alias("cpu_metrics"),
        reason.alias("reason"),
        F.col("value"),
        *keep,
    ))


def split_good_bad(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = rows.where(F.col("reason").isNull()).drop("reason", "value")
    bad = rows.where(F.col("reason").isNotNull()).select(F.col("value").cast("binary").alias("value"), "reason")
    return good, bad


def hour_bucket(ts_ms: Column) -> Column:
    """Event-time hour bucket ``yyyy-MM-dd--HH`` (UTC) of epoch milliseconds."""
    return F.date_format(F.timestamp_millis(ts_ms), HOUR_BUCKET_FORMAT)


def with_hour_bucket(rows: DataFrame, mode: str = "event") -> DataFrame:
    """K3: ``bucket`` from the record time (``event``) or the clock (``processing``)."""
    if mode == "processing":
        return rows.withColumn("bucket", F.date_format(F.current_timestamp(), HOUR_BUCKET_FORMAT))
    return rows.withColumn("bucket", hour_bucket(F.col("timestamp")))


def read_archive(spark, path: str, buckets: list[str] | None = None, layout: str = "hive") -> DataFrame:
    """Read the archive back.

    ``layout="hive"``: our ``bucket=<hour>`` folders; a bucket filter prunes
    directories. ``layout="plain"``: hour folders named just
    ``yyyy-MM-dd--HH`` (the reference's file sink), read recursively with the
    bucket taken from each file's path; without ``hostname``.
    """
    if layout == "plain":
        df = spark.read.option("recursiveFileLookup", "true").schema(METRICS).parquet(path)
        bucket = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{4}-\d{2}-\d{2}--\d{2})/[^/]*$", 1)
        df = df.withColumn("bucket", F.when(bucket != "", bucket))
    else:
        schema = T.StructType(list(METRICS.fields) + [T.StructField("hostname", T.StringType(), True),
                                                        T.StructField("bucket", T.StringType(), True)])
        # Batches of a size-bounded archive have folders of their own below the hour.
        df = spark.read.schema(schema).parquet(path).select(*schema.names)
    if buckets:
        df = df.where(F.col("bucket").isin(buckets))
    return df
