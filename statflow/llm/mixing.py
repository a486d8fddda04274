"""Operator 4: mix sources to target weights by Poisson replication.

Each source gets a mean repetition rate ``target share * total / its rows``.
A document's number of copies is the inverse of the Poisson distribution with
that mean at a hash-seeded uniform number, so the draw is the same on every
run and needs no state. Documents are exploded by their count and shuffled
globally by a hashed key. Everything is a native expression.

Defined results: a null source is a source of its own. Sources without a
given weight get ``default_weight``. Rows that repeat a ``doc_id`` draw the
same count; a null id draws as the text ``null``. An empty table gives an
empty table. Extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 20240601
#: Without given weights a source's weight is its number of rows to this power.
ALPHA = 0.5
#: Means above this are drawn as sums of Poisson numbers with smaller means.
MEAN_PER_DRAW = 32.0
FEW_SOURCES = 1 << 16


def _hash_int(digits: int, *parts: Column) -> Column:
    text = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) from 52 bits of a hash of the parts."""
    return _hash_int(13, F.lit(seed), *parts) / F.lit(float(1 << 52))


def poisson_inverse(u: Column, mean: Column) -> Column:
    """The smallest k with ``u < P(X <= k)`` for X ~ Poisson(mean)."""
    most = F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int")
    p0 = F.exp(-mean)
    return F.aggregate(
        F.sequence(F.lit(1), most),
        F.struct(F.lit(0).alias("k"), p0.alias("p"), p0.alias("c")),
        lambda s, k: F.when(u < s["c"], s).otherwise(
            F.struct(k.alias("k"), (s["p"] * mean / k).alias("p"), (s["c"] + s["p"] * mean / k).alias("c"))
        ),
        lambda s: s["k"],
    )


def copies(mean: Column, seed: int, key: Column) -> Column:
    """A hash-seeded Poisson number of any mean (null or not positive: 0)."""
    draws = F.ceil(mean / MEAN_PER_DRAW).cast("int")
    total = F.aggregate(
        F.sequence(F.lit(1), draws),
        F.lit(0),
        lambda n, j: n + poisson_inverse(uniform(seed, key, j), mean / draws),
    )
    return F.when(mean > 0, total).otherwise(F.lit(0))


def source_rates(
    docs: DataFrame,
    source_col: str = "source",
    weights: Mapping[str, float] | None = None,
    default_weight: float = 0.0,
    alpha: float = ALPHA,
    total: int | None = None,
) -> DataFrame:
    """(source, n_docs, rate): the mean number of copies of each document of a source."""
    counts = docs.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("n_docs"))
    if weights is None:
        weight = F.pow(F.col("n_docs").cast("double"), F.lit(float(alpha)))
    else:
        weight = F.lit(float(default_weight))
        for name, w in weights.items():
            weight = F.when(F.col("source") == name, F.lit(float(w))).otherwise(weight)
    weighted = counts.withColumn("weight", weight)
    sums = weighted.agg(F.sum("weight").alias("w"), F.sum("n_docs").alias("n"))
    want = F.lit(float(total)) if total is not None else sums.select("n").scalar()
    return weighted.select("source", "n_docs", (F.col("weight") / sums.select("w").scalar() * want / F.col("n_docs")).alias("rate"))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    seed: int = SEED,
    report: str | None = None,
    **rates,
) -> DataFrame:
    """``docs`` with every row repeated by its Poisson count, in one global random order.

    ``report`` names an extra struct column (copy, n_copies, rate, shuffle_key).
    """
    r = source_rates(docs, source_col, **rates).select(F.col("source").alias("__source"), F.col("rate").alias("__rate"))
    # One row per source: broadcast as long as they are few, so that documents don't move by source.
    if r.count() <= FEW_SOURCES:
        r = F.broadcast(r)
    joined = docs.join(r, F.col(source_col).eqNullSafe(F.col("__source")))
    counted = joined.withColumn("__n", copies(F.col("__rate"), seed, F.col(id_col))).where(F.col("__n") > 0)
    each = counted.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    keyed = each.withColumn("__key", _hash_int(15, F.lit(seed), F.lit("shuffle"), F.col(id_col), F.col("__copy")))
    # The key is even over 60 bits, so its leading bits deal rows to equal parts in global
    # order, without a pass to find bounds.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.shiftright(F.shiftright("__key", 28) * parts, 32).cast("int")
    mixed = keyed.repartitionById(parts, part).sortWithinPartitions("__key", id_col, "__copy")
    extra = []
    if report:
        extra = [
            F.struct(
                F.col("__copy").cast("long").alias("copy"),
                F.col("__n").cast("long").alias("n_copies"),
                F.round("__rate", 6).alias("rate"),
                F.col("__key").alias("shuffle_key"),
            ).alias(report)
        ]
    return mixed.select(*[F.col(f"`{c}`") for c in docs.columns], *extra)
