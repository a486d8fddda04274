"""Snapshot tables derived from the driver's ``events`` table.

host = ``user_id``, snapshot time = day of ``ts`` in epoch ms, CPU id =
``event_type``, counters = integer aggregates of ``event_id``. Every step is
a Spark job whose work grows with ``events``:

* a partial+final aggregation to ``(user, day, type)``: skew on a user is
  removed here, since a group is at most one row per type and day;
* for the cumulative form a running sum per ``(user, type)`` ordered by day;
* ``collect_list`` per ``(user, day)``: bounded by the number of event types.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statflow.schemas import CPU_COUNTERS

# The modulus that builds each counter from event_id
# (user is the event count).
COUNTER_MODULI = {
    "nice": 7,
    "system": 11,
    "idle": 13,
    "iowait": 5,
    "irq": 3,
    "softirq": 2,
    "steal": 17,
    "guest": 19,
    "guest_nice": 23,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def day_ms(ts_col: str = "ts"):
    return F.unix_millis(F.date_trunc("day", F.col(ts_col).cast("timestamp")))


def daily_counters(events: DataFrame) -> DataFrame:
    """``(user_id, timestamp, id, counters…)`` per user, day and event type."""
    aggs = [F.count(F.lit(1)).alias("user")]
    aggs += [F.sum(F.col("event_id") % F.lit(m)).cast("long").alias(c) for c, m in COUNTER_MODULI.items()]
    return (
        events.select("user_id", "event_id", "event_type", day_ms().alias("timestamp"))
        .groupBy("user_id", "timestamp", F.col("event_type").alias("id"))
        .agg(*aggs)
    )


def cumulative(daily: DataFrame) -> DataFrame:
    """Running sum of each counter per (user, CPU) over days: monotone counters."""
    w = Window.partitionBy("user_id", "id").orderBy("timestamp").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select(
        "user_id", "timestamp", "id", *[F.sum(c).over(w).cast("long").alias(c) for c in CPU_COUNTERS]
    )


def host_name(user_id: F.Column) -> F.Column:
    return F.concat(F.lit("host-"), user_id.cast("string"))


def snapshots(events: DataFrame, counters: str = "cumulative", hostless_every: int = 0) -> DataFrame:
    """Snapshot rows (``SNAPSHOT_ROW`` columns) built from events.

    ``counters``: ``cumulative`` (monotone, as /proc/stat) or ``reset`` (the
    raw daily values, so deltas may be negative). ``hostless_every`` > 0
    leaves the hostname null for users whose id is a multiple of it, to
    exercise the ``unknown`` default key; those rows are kept, not dropped.
    Arrival order is ``(timestamp, src_offset)`` with ``src_offset = user_id``.
    """
    # After the aggregation a user has at most (days x types) rows, so one
    # hash partitioning by user is safe even for a hot user, and both the
    # running sum (user, type) and the snapshot collect (user, day) reuse it.
    daily = daily_counters(events).repartition("user_id")
    per_cpu = cumulative(daily) if counters == "cumulative" else daily
    cpu = F.struct(F.col("id"), *[F.col(c) for c in CPU_COUNTERS])
    snaps = per_cpu.groupBy("user_id", "timestamp").agg(F.sort_array(F.collect_list(cpu)).alias("cpus"))
    host = host_name(F.col("user_id"))
    if hostless_every:
        host = F.when(F.col("user_id") % F.lit(hostless_every) == 0, F.lit(None).cast("string")).otherwise(host)
    total_user = F.aggregate("cpus", F.lit(0).cast("long"), lambda acc, c: acc + c["user"])
    return snaps.select(
        host.alias("hostname"),
        F.col("timestamp"),
        F.col("cpus"),
        F.concat(F.array(total_user), F.transform("cpus", lambda c: c["user"])).alias("intr"),
        F.transform("cpus", lambda c: c["softirq"]).alias("softirq"),
        F.aggregate("cpus", F.lit(0).cast("long"), lambda acc, c: acc + c["system"]).alias("ctxt"),
        (F.col("timestamp") / 1000 - 86400).cast("long").alias("btime"),
        (F.size("cpus") * 100 + F.col("user_id")).cast("long").alias("processes"),
        F.size("cpus").cast("long").alias("procs_running"),
        F.lit(0).cast("long").alias("procs_blocked"),
        F.lit(0).cast("int").alias("src_partition"),
        F.col("user_id").alias("src_offset"),
    )


def with_arrival_offsets(snaps: DataFrame) -> DataFrame:
    """Broker-style arrival positions for snapshot rows: one partition, and
    offsets increasing with (timestamp, user) — ``seconds * 1e9 + user``,
    so no global numbering pass is needed."""
    return snaps.withColumn("src_partition", F.lit(0)).withColumn(
        "src_offset", (F.col("timestamp") / 1000).cast("long") * F.lit(1_000_000_000) + F.col("src_offset")
    )


def with_dense_offsets(snaps: DataFrame, partition: Column) -> DataFrame:
    """Broker-style positions in several partitions: offsets count up from 0
    without gaps in (timestamp, user) order. Rows are numbered inside a day and
    partition; what came before a day is a running sum over the daily counts."""
    placed = snaps.withColumn("src_partition", partition.cast("int"))
    day = Window.partitionBy("src_partition", "timestamp")
    before = Window.partitionBy("src_partition").orderBy("timestamp").rowsBetween(Window.unboundedPreceding, -1)
    days = placed.groupBy("src_partition", "timestamp").agg(F.count(F.lit(1)).alias("n"))
    starts = days.select("src_partition", "timestamp", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    numbered = placed.withColumn("src_offset", F.row_number().over(day.orderBy("src_offset")) - 1)
    joined = numbered.join(starts, ["src_partition", "timestamp"])
    return joined.withColumn("src_offset", F.col("start") + F.col("src_offset")).select(*snaps.columns)


# Offsets of one fixture day (see with_arrival_offsets).
OFFSETS_PER_DAY = 86_400 * 1_000_000_000


# --- location fixtures from the TPC-H-like tables ---------------------------
# Suppliers are the addresses, nations the destinations; coordinates are
# (nationkey, suppkey); elevation in metres is the account balance; a route
# from a supplier to a nation exists when the supplier shipped a line of an
# order placed by a customer of that nation: route rank = order key, leg
# rank = line number, duration = the quantity in minutes. Only lines shipped
# without discount went by road ("driving"); the others count as transit.

# Departure day of the location fixtures.
AS_OF = "2024-03-01"


def place_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_name").alias("address"),
                    F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("notes"))


def place_geocode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two candidates per address; rank 0 is the right one."""
    s = table(spark, sf_dir, "supplier")
    good = s.select(F.col("s_name").alias("address"), F.lit(0).alias("rank"),
                    F.col("s_nationkey").cast("double").alias("lat"), F.col("s_suppkey").cast("double").alias("lng"))
    decoy = good.select("address", F.lit(1).alias("rank"), F.lit(-1.0).alias("lat"), F.lit(-1.0).alias("lng"))
    return good.unionByName(decoy)


def place_elevation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with a negative balance have no elevation data."""
    s = table(spark, sf_dir, "supplier").where(F.col("s_acctbal") >= 0)
    lat, lng = F.col("s_nationkey").cast("double"), F.col("s_suppkey").cast("double")
    good = s.select(lat.alias("lat"), lng.alias("lng"), F.lit(0).alias("rank"), F.col("s_acctbal").alias("elevation_m"))
    decoy = good.select("lat", "lng", F.lit(1).alias("rank"), F.lit(0.0).alias("elevation_m"))
    return good.unionByName(decoy)


def place_destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("int").alias("pos"), F.col("n_name").alias("name"),
                    F.concat(F.lit("Center of "), F.col("n_name")).alias("destination"))


def place_routes(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity",
                                                 "l_discount")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    from statflow.operators.places import next_midnight_epoch

    j = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
         .join(c, F.col("o_custkey") == F.col("c_custkey"))
         .join(s, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(n, F.col("c_nationkey") == F.col("n_nationkey")))
    return j.select(
        F.col("s_nationkey").cast("double").alias("lat"),
        F.col("s_suppkey").cast("double").alias("lng"),
        F.concat(F.lit("Center of "), F.col("n_name")).alias("destination"),
        F.when(F.col("l_discount") == 0, F.lit("driving")).otherwise(F.lit("transit")).alias("mode"),
        next_midnight_epoch(F.lit(as_of)).alias("departure_epoch"),
        F.col("o_orderkey").alias("route_rank"),
        F.col("l_linenumber").alias("leg_rank"),
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(" mins")).alias("duration_text"),
    )
