"""Array helpers (R1–R7) and location enrichment (H1–H9) on hand cases."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from statflow.functions import arrays as A
from statflow.operators import places as P


def test_go_slices(spark):
    df = spark.createDataFrame([([1, 2, 3],)], "a ARRAY<BIGINT>")
    r = df.select(
        A.array_slice("a", 0, 2).alias("h"),
        A.array_slice("a", 1, 3).alias("t"),
        A.replace_at("a", 2, F.lit(999).cast("long")).alias("r"),
        A.append("a", F.lit(4).cast("long")).alias("ap"),
        A.prepend("a", F.lit(0).cast("long")).alias("pp"),
        A.length("a").alias("n"),
        A.last("a").alias("last"),
        A.at("a", 7).alias("oob"),
        A.array_slice("a", 2, 9).alias("bad_hi"),
        A.array_slice("a", 2, 1).alias("bad_lo"),
        A.array_slice("a", 3, 3).alias("empty"),
    ).first()
    assert r.h == [1, 2] and r.t == [2, 3] and r.r == [1, 2, 999]
    assert r.ap == [1, 2, 3, 4] and r.pp == [0, 1, 2, 3] and r.n == 3 and r.last == 3
    assert r.oob is None and r.bad_hi is None and r.bad_lo is None and r.empty == []


def test_scalars(spark):
    df = spark.createDataFrame([("1234 My Road, Pleasantville, CO", 1609.344)], "address STRING, m DOUBLE")
    r = df.select(
        P.slug(F.col("address")).alias("slug"),
        P.feet(F.col("m")).alias("ft"),
        P.next_midnight_epoch(F.lit("2024-03-01")).alias("dep"),
        P.slug(F.lit("Café près d'ici")).alias("uni"),
    ).first()
    assert r.slug == "1234_My_Road_Pleasantville_CO"
    assert r.ft == 5280
    assert r.dep == 1709337600
    assert r.uni == "Café_près_d_ici"


def _tables(spark):
    addresses = spark.createDataFrame(
        [("1 A St", "quiet"), ("2 B St", None), ("nowhere", "x"), ("1-A St", "clash")], "address STRING, notes STRING"
    )
    dests = P.destinations_from_json(
        spark.createDataFrame([(json.dumps({"Work": "W addr", "Elevation": "E addr", "Gym": "G addr"}),)], "value STRING")
    )
    geocode = spark.createDataFrame(
        [("1 A St", 1, 9.0, 9.0), ("1 A St", 0, 1.0, 1.0), ("2 B St", 0, 2.0, 2.0)], "address STRING, rank INT, lat DOUBLE, lng DOUBLE"
    )
    elevation = spark.createDataFrame([(1.0, 1.0, 0, 1609.344)], "lat DOUBLE, lng DOUBLE, rank INT, elevation_m DOUBLE")
    dep = 1709337600
    routes = spark.createDataFrame(
        [
            (1.0, 1.0, "W addr", "driving", dep, 1, 0, "9 mins"),
            (1.0, 1.0, "W addr", "driving", dep, 0, 1, "8 mins"),
            (1.0, 1.0, "W addr", "driving", dep, 0, 0, "7 mins"),
            (1.0, 1.0, "E addr", "driving", dep, 0, 0, "1 hour"),
            (1.0, 1.0, "G addr", "transit", dep, 0, 0, "2 mins"),
            (2.0, 2.0, "G addr", "driving", dep, 0, 0, ""),
        ],
        "lat DOUBLE, lng DOUBLE, destination STRING, mode STRING, departure_epoch BIGINT, route_rank INT,"
        " leg_rank INT, duration_text STRING",
    )
    return addresses, dests, geocode, elevation, routes


def test_enrichment_report(spark):
    out = P.enrich_addresses(*_tables(spark), as_of=F.lit("2024-03-01"))
    lines = {
        a: [r.line for r in sorted(rows, key=lambda r: r.line_no)]
        for a, rows in _group(out["lines"].collect()).items()
    }
    # Elevation keeps the first place but the destination named "Elevation"
    # overwrites its value; the transit-only gym has no driving route.
    assert lines["1 A St"] == ["1 A St", "", "*** quiet ***", "", "Elevation: 1 hour", "Work: 7 mins"]
    assert lines["2 B St"] == ["2 B St", "", "***  ***", ""]
    q = {r.address: r.reason for r in out["quarantine"].collect()}
    assert q == {"nowhere": "address_not_found", "1-A St": "slug_collision"}
    missing = {(r.address, r.name) for r in out["missing"].collect()}
    assert missing == {("1 A St", "Gym"), ("2 B St", "Work"), ("2 B St", "Elevation"), ("2 B St", "Gym")}
    rep = {r.slug: r.text for r in out["reports"].collect()}
    assert rep["1_A_St"].endswith("Work: 7 mins\n")


def test_write_reports_skips_existing(spark, tmp_path):
    out = P.enrich_addresses(*_tables(spark), as_of=F.lit("2024-03-01"))
    path = str(tmp_path / "reports")
    P.write_reports(out["reports"], path)
    first = {r.slug for r in P.read_report_lines(spark, path).collect()}
    n1 = spark.read.text(path).count()
    P.write_reports(out["reports"], path)  # no overwrite: existing slugs skipped
    assert spark.read.text(path).count() == n1
    P.write_reports(out["reports"], path, overwrite=True)  # partitions replaced, not doubled
    assert spark.read.text(path).count() == n1
    assert sorted(first) == ["1_A_St", "2_B_St"]


def _group(rows):
    g = {}
    for r in rows:
        g.setdefault(r.address, []).append(r)
    return g


def test_repeated_address_gives_one_report(spark):
    addresses, dests, geocode, elevation, routes = _tables(spark)
    many = addresses.unionByName(spark.createDataFrame([("1 A St", "quiet")] * 50, "address STRING, notes STRING"))
    out = P.enrich_addresses(many, dests, geocode, elevation, routes, as_of=F.lit("2024-03-01"))
    rows = [r for r in out["lines"].collect() if r.address == "1 A St"]
    assert len(rows) == 6
    assert out["reports"].where(F.col("address") == "1 A St").count() == 1


def test_report_files_named_by_slug(spark, tmp_path):
    out = P.enrich_addresses(*_tables(spark), as_of=F.lit("2024-03-01"))
    d = tmp_path / "locations"
    P.write_report_files(out["reports"], str(d))
    assert sorted(p.name for p in d.iterdir()) == ["1_A_St.txt", "2_B_St.txt"]
    text = (d / "1_A_St.txt").read_text()
    assert text == "1 A St\n\n*** quiet ***\n\nElevation: 1 hour\nWork: 7 mins\n"
    (d / "2_B_St.txt").write_text("kept")
    P.write_report_files(out["reports"], str(d))
    assert (d / "2_B_St.txt").read_text() == "kept"
    P.write_report_files(out["reports"], str(d), overwrite=True)
    assert (d / "2_B_St.txt").read_text().startswith("2 B St\n")


def test_more_than_ten_thousand_destinations(spark):
    addresses, _, geocode, elevation, routes = _tables(spark)
    n = 10_050
    dests = spark.range(n).select(
        F.col("id").cast("int").alias("pos"), F.concat(F.lit("d"), "id").alias("name"),
        F.when(F.col("id") == n - 1, "W addr").otherwise(F.concat(F.lit("x"), "id")).alias("destination"))
    out = P.enrich_addresses(addresses, dests, geocode, elevation, routes, as_of=F.lit("2024-03-01"))
    found = out["matrix"].where(F.col("duration").isNotNull()).select("address", "pos", "duration").collect()
    assert [tuple(r) for r in found] == [("1 A St", n - 1, "7 mins")]
    assert out["matrix"].count() == 2 * n and out["missing"].count() == 2 * n - 1
    res = out["results"].collect()
    assert {(r.address, r.pos, r.label, r.value) for r in res} == {("1 A St", 0, "Elevation", "5280"), ("1 A St", n, f"d{n - 1}", "7 mins")}


def test_all_notes_of_an_address(spark):
    addresses, dests, geocode, elevation, routes = _tables(spark)
    more = spark.createDataFrame([("1 A St", "loud"), ("1 A St", ""), ("1 A St", None), ("1 A St", "quiet")], addresses.schema)
    out = P.enrich_addresses(addresses.unionByName(more), dests, geocode, elevation, routes, as_of=F.lit("2024-03-01"))
    notes = {r.address: r.line for r in out["lines"].where("line_no = 2").collect()}
    assert notes == {"1 A St": "*** loud; quiet ***", "2 B St": "***  ***"}
