"""Location enrichment over many addresses.

Per address: coordinates (first geocode candidate), elevation in feet
(floored), and for each configured destination the duration of the first
leg of the first driving route departing at the next midnight; then a
text report per address. The live maps client of the reference becomes
three lookup tables, joined by key:

* ``geocode``   ``address, rank, lat, lng``
* ``elevation`` ``lat, lng, rank, elevation_m``
* ``routes``    ``lat, lng, destination, mode, departure_epoch, route_rank,
  leg_rank, duration_text``

Unknown addresses are set aside (``address_not_found``) instead of ending
the run; a missing elevation just omits that line; a failure on one
destination does not drop the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Metres → feet, the travel mode, the report's label for
# elevation, the output folder and file suffix of the reports.
FEET_PER_METRE = 3.28084
MODE = "driving"
ELEVATION_LABEL = "Elevation"
OUTPUT_DIR = "locations"
REPORT_SUFFIX = ".txt"
NOTE_SEPARATOR = "; "


# --- scalar functions -------------------------------------------------------

def feet(elevation_m: Column) -> Column:
    """C6 + C7: metres → whole feet, floored (``bigint``)."""
    return F.floor(elevation_m * F.lit(FEET_PER_METRE))


def slug(address: Column) -> Column:
    """Runs of non-word characters → ``_`` (Unicode-aware, as Python's ``\\W``)."""
    return F.regexp_replace(address, r"(?U)\W+", "_")


def report_file(address: Column) -> Column:
    return F.concat(F.lit(OUTPUT_DIR + "/"), slug(address), F.lit(REPORT_SUFFIX))


def next_midnight_epoch(as_of: Column | None = None) -> Column:
    """Epoch seconds of the midnight after ``as_of`` (a date, default
    today) in the session time zone."""
    d = F.current_date() if as_of is None else as_of.cast("date")
    return F.unix_timestamp(F.date_add(d, 1).cast("timestamp"))


# --- sources ----------------------------------------------------------------

def destinations_from_json(text: DataFrame, col: str = "value") -> DataFrame:
    """A JSON object ``{"name": "address", …}`` → ``pos, name,
    destination`` in file order."""
    entries = F.map_entries(F.from_json(F.col(col), "map<string,string>"))
    return text.select(F.posexplode(entries).alias("pos", "e")).select(
        F.col("pos").cast("int").alias("pos"), F.col("e.key").alias("name"), F.col("e.value").alias("destination")
    )


def read_destinations(spark: SparkSession, path: str) -> DataFrame:
    return destinations_from_json(spark.read.text(path, wholetext=True))


def read_report_lines(spark: SparkSession, path: str) -> DataFrame:
    """Existing reports back as stripped lines with their slug."""
    return spark.read.text(path).select(F.col("slug"), F.trim(F.col("value")).alias("line"))


# --- lookups ----------------------------------------------------------------

def first_candidate(table: DataFrame, keys: list[str], rank: list[str], values: list[str]) -> DataFrame:
    """One row per key: the values of the lowest rank (the API's first result).
    Equal ranks are broken by the values themselves, so the pick is
    deterministic."""
    order = F.struct(*[F.col(c) for c in rank + values])
    return table.groupBy(*keys).agg(
        F.min_by(F.struct(*[F.col(c) for c in values]), order).alias("__first")
    ).select(*keys, *[F.col(f"__first.{c}").alias(c) for c in values])


def locate(addresses: DataFrame, geocode: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Addresses → ``(located, not_found)``."""
    coords = first_candidate(geocode, ["address"], ["rank"], ["lat", "lng"])
    joined = addresses.join(coords, "address", "left")
    found = joined.where(F.col("lat").isNotNull() & F.col("lng").isNotNull())
    missing = joined.where(F.col("lat").isNull() | F.col("lng").isNull()).select(
        "address", F.lit("address_not_found").alias("reason")
    )
    return found, missing


def with_elevation(located: DataFrame, elevation: DataFrame) -> DataFrame:
    """Add ``elevation_ft`` (null when the lookup has nothing, E16)."""
    first = first_candidate(elevation, ["lat", "lng"], ["rank"], ["elevation_m"])
    return located.join(first, ["lat", "lng"], "left").withColumn("elevation_ft", feet(F.col("elevation_m")))


def _first_routes(routes: DataFrame, mode: str) -> DataFrame:
    return first_candidate(
        routes.where(F.col("mode") == mode),
        ["lat", "lng", "destination", "departure_epoch"],
        ["route_rank", "leg_rank"],
        ["duration_text"],
    )


def _has_duration() -> Column:
    return F.col("duration_text").isNotNull() & (F.col("duration_text") != "")


def _configured(destinations: DataFrame) -> DataFrame:
    return destinations.select(F.col("pos").cast("int").alias("pos"), "name", "destination")


def travel_times(
    located: DataFrame, destinations: DataFrame, routes: DataFrame, departure: Column | None = None,
    mode: str = MODE,
) -> DataFrame:
    """H3/H4: the rows of ``travel_matrix`` that have a duration, by equi-joins
    alone: addresses with routes by the route key, routes with destinations."""
    dep = next_midnight_epoch() if departure is None else departure
    starts = located.select("address", "lat", "lng", dep.alias("departure_epoch"))
    found = _first_routes(routes, mode).where(_has_duration()).withColumnRenamed("duration_text", "duration")
    return starts.join(found, ["lat", "lng", "departure_epoch"]).join(_configured(destinations), "destination")


def travel_matrix(
    located: DataFrame, destinations: DataFrame, routes: DataFrame, departure: Column | None = None,
    mode: str = MODE,
) -> DataFrame:
    """One row per (address, destination) with ``duration``
    (null when no route). All pairs are the output, so they are made by a
    cross join (of partitions, or broadcast where Spark finds one side
    small), then one equi-join with the first route per key."""
    dep = next_midnight_epoch() if departure is None else departure
    pairs = located.select("address", "lat", "lng", dep.alias("departure_epoch")).crossJoin(_configured(destinations))
    out = pairs.join(_first_routes(routes, mode), ["lat", "lng", "destination", "departure_epoch"], "left")
    return out.withColumn("duration", F.when(_has_duration(), F.col("duration_text"))).drop("duration_text")


def missing_routes(matrix: DataFrame) -> DataFrame:
    """The destinations an address has no route to."""
    return matrix.where(F.col("duration").isNull()).select("address", "pos", "name", "destination")


def results(with_elev: DataFrame, matrix: DataFrame) -> DataFrame:
    """H6: ``address, pos, label, value`` in report order: elevation first,
    then destinations in file order; ``matrix`` may leave out pairs without a route. A destination named like the elevation
    label overwrites its value but keeps its place (as a dict would)."""
    elev = with_elev.where(F.col("elevation_ft").isNotNull()).select(
        "address", F.lit(0).alias("pos"), F.lit(ELEVATION_LABEL).alias("label"),
        F.col("elevation_ft").cast("string").alias("value"),
    )
    trips = matrix.where(F.col("duration").isNotNull()).select(
        "address", (F.col("pos") + 1).alias("pos"), F.col("name").alias("label"), F.col("duration").alias("value")
    )
    both = elev.unionByName(trips)
    return both.groupBy("address", "label").agg(
        F.min("pos").alias("pos"), F.max_by("value", "pos").alias("value")
    )


def report_lines(addresses: DataFrame, res: DataFrame) -> DataFrame:
    """``address, line_no, line``: the address, a blank line,
    ``*** notes ***``, a blank line, then ``label: value`` lines."""
    head = addresses.select(
        "address",
        F.posexplode(
            F.array(
                F.col("address"), F.lit(""),
                F.concat(F.lit("*** "), F.coalesce(F.col("notes"), F.lit("")), F.lit(" ***")), F.lit(""),
            )
        ).alias("line_no", "line"),
    )
    ranked = res.withColumn(
        "line_no",
        F.row_number().over(_by_address_pos()) + F.lit(3),
    ).select("address", "line_no", F.concat(F.col("label"), F.lit(": "), F.col("value")).alias("line"))
    return head.unionByName(ranked.withColumn("line_no", F.col("line_no").cast("int")))


def _by_address_pos():
    from pyspark.sql import Window

    return Window.partitionBy("address").orderBy("pos")


def reports(lines: DataFrame) -> DataFrame:
    """One text per address (lines in order), with its slug. A report
    is a handful of lines, so the per-address group is small."""
    return lines.groupBy("address").agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n"
        ).alias("text")
    ).select("address", slug(F.col("address")).alias("slug"), F.concat(F.col("text"), F.lit("\n")).alias("text"))


def dedupe_slugs(addresses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two addresses with one slug would share a file: keep the smallest
    address, set the others aside (``slug_collision``)."""
    s = addresses.withColumn("slug", slug(F.col("address")))
    keep = s.groupBy("slug").agg(F.min("address").alias("address"))
    kept = s.join(keep, ["slug", "address"], "left_semi").drop("slug")
    clash = s.join(keep, ["slug", "address"], "left_anti").select("address", F.lit("slug_collision").alias("reason"))
    return kept, clash


def write_reports(report_df: DataFrame, path: str, overwrite: bool = False) -> None:
    """K6/K7: one directory per slug. Without ``overwrite`` slugs that
    already have a report are skipped (left anti join on the existing
    slugs); with it their partitions are replaced (dynamic overwrite)."""
    spark = report_df.sparkSession
    out = report_df.select("slug", "text")
    existing = None
    try:
        existing = spark.read.text(path).select("slug").distinct()
    except Exception:  # no reports yet
        existing = None
    if existing is not None and not overwrite:
        out = out.join(existing, "slug", "left_anti")
    writer = out.write.partitionBy("slug")
    if overwrite:  # replace only the partitions written now
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.text(path)


def write_report_files(report_df: DataFrame, out_dir: str, overwrite: bool = False) -> None:
    """K6/K7 with the reference's file names: ``<out_dir>/<slug>.txt``.

    Spark's own writers name files ``part-…``, so each partition writes its
    reports itself through ``pyarrow.fs`` (local, HDFS or S3 URIs). Each file
    is written under a temporary name and then renamed, so a task lost
    mid-write leaves no partial report, and a retried task rewrites the same
    names. Without ``overwrite`` an existing report is left alone.
    """

    def write_part(rows) -> None:
        import uuid

        from pyarrow import fs as pafs

        filesystem, root = pafs.FileSystem.from_uri(out_dir) if "://" in out_dir else (
            pafs.LocalFileSystem(), out_dir)
        filesystem.create_dir(root, recursive=True)
        for r in rows:
            target = f"{root.rstrip('/')}/{r['slug']}{REPORT_SUFFIX}"
            if not overwrite and filesystem.get_file_info(target).type != pafs.FileType.NotFound:
                continue
            tmp = f"{root.rstrip('/')}/.{r['slug']}.{uuid.uuid4().hex}.tmp"
            with filesystem.open_output_stream(tmp) as f:
                f.write(r["text"].encode("utf-8"))
            filesystem.move(tmp, target)

    report_df.select("slug", "text").foreachPartition(write_part)


def enrich_addresses(
    addresses: DataFrame,
    destinations: DataFrame,
    geocode: DataFrame,
    elevation: DataFrame,
    routes: DataFrame,
    as_of: Column | None = None,
) -> dict[str, DataFrame]:
    """The whole job: returns ``results``, ``matrix``, ``missing``,
    ``lines``, ``reports`` and ``quarantine``."""
    # One row per address first (partial aggregation, so a repeated address
    # costs nothing downstream). All its notes are kept, each once, in text order.
    addresses = addresses.groupBy("address").agg(
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("notes") != "", F.col("notes")))), NOTE_SEPARATOR).alias("notes")
    )
    kept, clash = dedupe_slugs(addresses)
    located, not_found = locate(kept, geocode)
    elev = with_elevation(located, elevation)
    departure = next_midnight_epoch(as_of)
    matrix = travel_matrix(located, destinations, routes, departure)
    res = results(elev, travel_times(located, destinations, routes, departure))
    lines = report_lines(located.select("address", "notes"), res)
    return {
        "results": res,
        "matrix": matrix,
        "missing": missing_routes(matrix),
        "lines": lines,
        "reports": reports(lines),
        "quarantine": clash.unionByName(not_found),
    }
