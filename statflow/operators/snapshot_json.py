"""Snapshots as JSON documents → typed snapshot rows.

A topic may carry the snapshot record as JSON, with the ``hostname`` that the
Avro record lacks. Documents are parsed once into Variant; arrays are typed
element by element, so one odd counter does not lose its snapshot:

* a counter may be a number (decimals are cut off), a text, a boolean or JSON
  null; it is coerced as ``coerce.as_long`` says;
* a *missing* field is not a null one: without ``timestamp``, ``cpus``, a CPU's
  ``id`` or one of the counters that a total needs, the document gets
  ``missing_field``. Guest times, the interrupt lists and the scalar lines may be
  missing and are then 0 or empty;
* a number, or numeric text, that no bigint holds gets ``out_of_range``, wherever
  it stands; a text that is no JSON gets ``bad_json``, a null message ``null_value``;
* ``hostname`` missing or JSON null stays null (job 1 then takes its default
  key); other scalars are taken as text, objects and arrays as empty text;
* ``cpus`` that is no array has no CPUs, as a tree reader sees it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statflow.functions.coerce import as_long, as_text, field, out_of_range
from statflow.operators.plan_tools import barrier
from statflow.schemas import CPU_COUNTERS, SCALAR_FIELDS, SNAPSHOT, TOTAL_COUNTERS

POSITION = ("src_partition", "src_offset")


def _elements(v: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))


def _or_zero(x: Column) -> Column:
    return F.coalesce(as_long(x), F.lit(0).cast("long"))


def _cpu(e: Column) -> Column:
    """One CPU: coerced counters, and what is wrong with it (1: a field is missing, 2: out of range)."""
    counters = {c: field(e, f"$.{c}") for c in CPU_COUNTERS}
    cpu_id = field(e, "$.id")
    absent = reduce(lambda a, b: a | b, [cpu_id.isNull(), *(counters[c].isNull() for c in TOTAL_COUNTERS)])
    beyond = reduce(lambda a, b: a | b, [out_of_range(x) for x in counters.values()])
    return F.struct(
        F.struct(as_text(cpu_id).alias("id"), *[_or_zero(x).alias(c) for c, x in counters.items()]).alias("cpu"),
        F.when(absent, F.lit(1)).when(beyond, F.lit(2)).otherwise(F.lit(0)).alias("fault"),
    )


def snapshots_from_json(lines: DataFrame, keep: Sequence[str] = POSITION) -> DataFrame:
    """``value STRING`` → ``hostname``, the snapshot fields, ``keep`` columns, ``reason`` and ``value``.

    ``reason`` is null for good rows; the others have null snapshot fields.
    """
    keep = [c for c in keep if c in lines.columns]
    # Three steps with a barrier after each: the text is parsed once, every array
    # is walked once, and a filter on ``reason`` repeats neither.
    parsed = barrier(lines.select(*keep, F.col("value").cast("string").alias("value"), F.try_parse_json("value").alias("v")))
    v = F.col("v")
    host = field(v, "$.hostname")
    counts = {n: _elements(v, f"$.{n}") for n in ("intr", "softirq")}
    scalars = {n: field(v, f"$.{n}") for n in ("timestamp", *SCALAR_FIELDS)}
    beyond = [out_of_range(x) for x in scalars.values()] + [F.exists(xs, out_of_range) for xs in counts.values()]
    typed = barrier(parsed.select(
        *keep, "value",
        v.isNull().alias("unread"),
        (scalars["timestamp"].isNull() | field(v, "$.cpus").isNull()).alias("absent"),
        F.coalesce(reduce(lambda a, b: a | b, beyond), F.lit(False)).alias("beyond"),
        F.when(~F.is_variant_null(host), as_text(host)).alias("hostname"),
        F.transform(_elements(v, "$.cpus"), _cpu).alias("found"),
        *[F.transform(xs, _or_zero).alias(n) for n, xs in counts.items()],
        *[_or_zero(x).alias(n) for n, x in scalars.items()],
    ))
    fault = lambda k: F.exists("found", lambda c: c["fault"] == k)
    reason = (
        F.when(F.col("value").isNull(), F.lit("null_value"))
        .when(F.col("unread"), F.lit("bad_json"))
        .when(F.col("absent") | fault(1), F.lit("missing_field"))
        .when(F.col("beyond") | fault(2), F.lit("out_of_range"))
    )
    rows = barrier(typed.select("*", reason.alias("reason")))
    good = lambda c, name: F.when(F.col("reason").isNull(), c).alias(name)
    cpus = F.transform("found", lambda c: c["cpu"])
    return rows.select(
        good(F.col("hostname"), "hostname"),
        *[good(cpus if n == "cpus" else F.col(n), n) for n in SNAPSHOT.names],
        *keep, "reason", "value",
    )
