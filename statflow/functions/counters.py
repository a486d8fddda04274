"""Per-CPU counter maths as native column expressions.

Shared by the batch path and the stream path so both produce the same rows.
All arithmetic stays inside whole-stage codegen: higher-order array
functions, no Python.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from statflow.schemas import PCT_COUNTERS, TOTAL_COUNTERS

UNKNOWN_HOST = "unknown"


def host_key(col: str | Column = "hostname") -> Column:
    """Key with default: a missing or null hostname becomes ``unknown``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(UNKNOWN_HOST))


def first_by_id(prev_cpus: Column, cpu_id: Column) -> Column:
    """First CPU of ``prev_cpus`` whose id equals ``cpu_id``, else null.

    ``get`` returns null out of range where ``[]`` would raise under ANSI.
    """
    return F.get(F.filter(prev_cpus, lambda q: q["id"] == cpu_id), 0)


def _delta(cur: Column, prev: Column, name: str) -> Column:
    # Java wraps on overflow, ANSI Spark raises: try_subtract gives null and
    # the CPU is dropped below.
    return F.try_subtract(cur[name], prev[name])


def _pct(part: Column, total: Column) -> Column:
    # (delta * 100.0D) / total: one double multiply and one double divide, in
    # this order, so results are bit-equal with the reference's formula.
    return (part.cast("double") * F.lit(100.0)) / total.cast("double")


def pair_cpus(cpus: Column, prev_cpus: Column) -> Column:
    """Each current CPU with its match in the previous snapshot.

    Consecutive snapshots of a host almost always list the same ids in the
    same order; then the i-th CPU pairs with the i-th, in O(n). That is only
    taken when the id arrays are equal and duplicate-free, so it is exactly
    the first match by id. Otherwise each CPU searches the previous array
    (O(n²), for hot-plugged or renamed CPUs).
    """
    cur_ids = F.transform(cpus, lambda c: c["id"])
    prev_ids = F.transform(prev_cpus, lambda c: c["id"])
    aligned = (cur_ids == prev_ids) & (F.size(F.array_distinct(cur_ids)) == F.size(cur_ids))
    by_position = F.transform(
        cpus, lambda c, i: F.struct(c["id"].alias("id"), c.alias("c"), F.get(prev_cpus, i).alias("p"))
    )
    by_search = F.transform(
        cpus, lambda c: F.struct(c["id"].alias("id"), c.alias("c"), first_by_id(prev_cpus, c["id"]).alias("p"))
    )
    return F.when(aligned, by_position).otherwise(by_search)


def cpu_metrics(cpus: Column, prev_cpus: Column) -> Column:
    """``cpus`` × previous ``cpus`` → array of metric structs in current order.

    CPUs not in the previous snapshot are skipped (F2, E2); a CPU is kept only
    when the total delta is positive (F3, E6); nothing is clamped.
    """
    paired = pair_cpus(cpus, prev_cpus)
    matched = F.filter(paired, lambda x: x["p"].isNotNull())

    def deltas(x: Column) -> Column:
        ds = [_delta(x["c"], x["p"], n).alias(n) for n in TOTAL_COUNTERS]
        return F.struct(x["id"].alias("id"), *ds)

    with_deltas = F.transform(matched, deltas)

    def with_total(d: Column) -> Column:
        total = reduce(lambda a, b: F.try_add(a, b), [d[n] for n in TOTAL_COUNTERS])
        return F.struct(d.alias("d"), total.alias("total"))

    totals = F.transform(with_deltas, with_total)
    kept = F.filter(totals, lambda x: x["total"].isNotNull() & (x["total"] > 0))

    def metric(x: Column) -> Column:
        d, total = x["d"], x["total"]
        busy = F.try_subtract(total, d["idle"])
        fields = [d["id"].alias("cpu_id")]
        fields += [_pct(d[n], total).alias(f"{n}_pct") for n in PCT_COUNTERS]
        fields.append(_pct(busy, total).alias("total_busy_pct"))
        return F.struct(*fields)

    return F.transform(kept, metric)


def metrics_record(prev: str = "prev") -> list[Column]:
    """Columns of the enriched record for rows carrying ``prev``."""
    return [
        F.col("timestamp"),
        F.try_subtract(F.col("timestamp"), F.col(f"{prev}.timestamp")).alias("time_delta_ms"),
        cpu_metrics(F.col("cpus"), F.col(f"{prev}.cpus")).alias("cpu_metrics"),
    ]
