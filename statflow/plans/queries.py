"""Registered queries: ``(spark, sf_dir) -> DataFrame`` over the driver tables.

Every query reads whole tables (or what Spark derives from them); results
are flat rows with the same column names as the oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statflow.functions import arrays as A
from statflow.functions.coerce import as_long, field
from statflow.operators import places as P
from statflow.operators.cpu_delta import enrich, explode_metrics
from statflow.operators.metrics_json import hour_bucket as hour_bucket_col
from statflow.operators.metrics_json import metrics_from_json, metrics_to_json, read_archive, split_good_bad
from statflow.operators.procstat import find_bad_line, parse_dumps, read_dump_log, render_dump, write_dump_log
from statflow.operators.snapshot_json import snapshots_from_json
from statflow.operators.wire import (
    decode_frames,
    encode_payloads,
    frame,
    good_rows,
    lookup_schemas,
    parse_frames,
    registry_from_envelopes,
)
from statflow.plans.fixtures import (
    AS_OF,
    place_addresses,
    place_destinations,
    place_elevation,
    place_geocode,
    place_routes,
    snapshots,
    table,
    with_arrival_offsets,
    with_dense_offsets,
)
from statflow.schemas import CPU_COUNTERS, SNAPSHOT, SNAPSHOT_AVRO_SCHEMA
from statflow.session import scratch_path
from statflow.sources.streams import file_frames, file_json
from statflow.sources.streams import peek as peek_frames
from statflow.streaming.archive import start_sized_archive
from statflow.streaming.delta_runs import drain_runs
from statflow.streaming.late_schemas import MATCHED, match_late_schemas
from statflow.streaming.jobs import (
    archive_replay,
    await_all,
    SNAPSHOT_SPLIT,
    WIRE_SPLIT,
    replay,
    split_faults,
    split_part,
    start_archive,
    start_archive_quarantine,
    start_enrichment,
    start_split,
    start_publish,
    start_wire_split,
    state_partitions,
)

# The fixture has one snapshot per host and day: a week per stitching bucket.
FIXTURE_BUCKET_MS = 7 * 86_400_000

Query = Callable[[SparkSession, str], DataFrame]


def written(df: DataFrame, name: str) -> DataFrame:
    """A derived input, computed once: what reads it twice reads the table."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fixture_metrics(spark: SparkSession, sf_dir: str, counters: str = "cumulative", hostless_every: int = 0):
    snaps = snapshots(table(spark, sf_dir, "events"), counters, hostless_every)
    return enrich(snaps, bucket_ms=FIXTURE_BUCKET_MS)


def counter_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: per-CPU utilisation from cumulative counters."""
    return explode_metrics(fixture_metrics(spark, sf_dir, "cumulative"))


def counter_delta_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters that go backwards: negative deltas kept when total > 0."""
    return explode_metrics(fixture_metrics(spark, sf_dir, "reset"))


def snapshot_time_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot-level rows, empty ``cpu_metrics`` kept."""
    m = fixture_metrics(spark, sf_dir, "reset")
    return m.select("hostname", "timestamp", "time_delta_ms", F.size("cpu_metrics").cast("long").alias("n_cpus"))


def default_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null hostnames fall back to one ``unknown`` key (C5 E4): a hot key, in
    buckets bounded by rows."""
    snaps = snapshots(table(spark, sf_dir, "events"), "cumulative", hostless_every=10)
    return explode_metrics(enrich(written(snaps, "snapshots"), bucket="auto"))


def metrics_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics → JSON text → typed metrics again."""
    lines = metrics_to_json(fixture_metrics(spark, sf_dir), with_host=True)
    good, _ = split_good_bad(metrics_from_json(lines))
    return explode_metrics(good)


def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON field access, strict and Jackson-lenient."""
    ev = table(spark, sf_dir, "events").select("event_id", "props")
    strict = F.from_json("props", "k BIGINT")["k"]
    lenient = as_long(field(F.try_parse_json("props"), "$.k"))
    return ev.select("event_id", strict.alias("k_strict"), lenient.alias("k_lenient"))


def hour_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-time archive bucket ``yyyy-MM-dd--HH`` (K3)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return ev.select("event_id", ms.alias("ts_ms"), hour_bucket_col(ms).alias("bucket"))


def stream_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job 1 as a stream with keyed state, fed in three arrivals with a restart
    from the checkpoint after each; same rows as ``counter_delta`` (A1–A8)."""
    snaps = snapshots(table(spark, sf_dir, "events"), "cumulative")
    sink = replay(spark, snaps, chunks=3, order=("timestamp", "src_offset"))
    return explode_metrics(spark.read.parquet(sink))


def stream_delta_batchwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job 1 as a stream without Python state: ``foreachBatch`` pairs each
    micro-batch with the stored last snapshot per host through the bucketed
    batch operator; three arrivals with restarts (A1 A3 A5 A8 J1)."""
    snaps = snapshots(table(spark, sf_dir, "events"), "cumulative")
    sink = replay(spark, snaps, chunks=3, order=("timestamp", "src_offset"), engine="batchwise")
    return explode_metrics(spark.read.parquet(sink).drop("batch_id"))


def hot_stream_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job 1 as a stream with half of all users on the ``unknown`` key, from two
    partitions, in three arrivals with restarts: hot keys are split into offset
    runs linked by their edges, so that no worker holds a whole key (A1 A5 A8 J1)."""
    snaps = snapshots(table(spark, sf_dir, "events"), "cumulative", hostless_every=2)
    placed = with_dense_offsets(written(snaps, "hot-snapshots"), F.floor(F.col("src_offset") / 2) % 2)
    sink = replay(spark, placed, chunks=3, engine="runs")
    return explode_metrics(spark.read.parquet(sink))


def archive_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job 2: JSON metrics → Parquet archive by hour bucket → read back."""
    arch = archive_replay(spark, fixture_metrics(spark, sf_dir))
    back = read_archive(spark, arch)
    return back.select("hostname", "timestamp", "time_delta_ms", "bucket", F.inline("cpu_metrics"))


#: JSON bytes a file of the chain's archive is made of; small, so that hours of the test tables get several.
CHAIN_TARGET = 1 << 16


def job_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Producer, job 1 and job 2 as one chain of streams: snapshots → framed Avro
    keyed by host → decode → keyed state → JSON lines → archive in files of a
    bounded size → read back (K5 S3 D1–D7 A1 A7 K1 K2 K3 S4 S13)."""
    from statflow.schemas import SNAPSHOT_ROW

    stage, frames, split, lines, arch, bad, *cks = (
        scratch_path(spark, f"chain-{n}") for n in ("in", "frames", "split", "lines", "out", "bad", "ck1", "ck2", "ck3", "ck4"))
    with_arrival_offsets(snapshots(table(spark, sf_dir, "events"), "cumulative")).write.parquet(stage)
    src = spark.readStream.schema(SNAPSHOT_ROW).parquet(stage)
    start_publish(src, SNAPSHOT_AVRO_SCHEMA, WIRE_SCHEMA_ID, frames, cks[0]).awaitTermination()
    keyed = file_frames(spark, frames, keyed=True)
    start_wire_split(keyed, wire_registry(spark), split, cks[1]).awaitTermination()
    with state_partitions(spark, spark.sparkContext.defaultParallelism):
        q = start_enrichment(split_part(spark, split, WIRE_SPLIT), lines, cks[2], sink_format="json")
    q.awaitTermination()
    start_sized_archive(file_json(spark, lines), arch, bad, cks[3], CHAIN_TARGET).awaitTermination()
    return read_archive(spark, arch).select("timestamp", "time_delta_ms", "bucket", F.inline("cpu_metrics"))


def event_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One framed message per event: schema id = user id, payload = the props
    bytes; ``error`` events carry a bad magic byte, ``signup`` events are cut
    to 3 bytes."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props")
    full = frame(F.encode("props", "UTF-8"), F.col("user_id"))
    bad_magic = F.concat(F.unhex(F.lit("01")), full.substr(F.lit(2), F.octet_length(full)))
    value = (
        F.when(F.col("event_type") == "signup", full.substr(F.lit(1), F.lit(3)))
        .when(F.col("event_type") == "error", bad_magic)
        .otherwise(full)
    )
    return ev.select("event_id", value.alias("value"), F.lit(0).alias("src_partition"),
                     F.col("event_id").alias("src_offset"))


def frame_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame checks, schema id and payload split."""
    p = parse_frames(event_frames(spark, sf_dir))
    return p.select("event_id", "reason", "schema_id", F.octet_length("payload").cast("long").alias("payload_len"))


def schema_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry envelopes → schemas, joined by id."""
    p = lookup_schemas(parse_frames(event_frames(spark, sf_dir)), table_registry(spark, sf_dir))
    return p.select(
        "event_id", "reason", "schema_id", F.get_json_object("schema_json", "$.name").alias("schema_name")
    )


def table_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of the events table, so the registry grows with it: by the first
    hex digit of an id's md5 one in 16 is missing and one in 16 has a non-text schema."""
    ids = table(spark, sf_dir, "events").where(F.col("user_id").isNotNull()).select("user_id").distinct()
    digit = F.substring(F.md5(F.col("user_id").cast("string").cast("binary")), 1, 1)
    body = F.when(digit == "1", F.to_json(F.struct(F.struct(F.lit("record").alias("type")).alias("schema")))).otherwise(
        F.to_json(F.struct(F.lit(SNAPSHOT_AVRO_SCHEMA).alias("schema"))))
    return registry_from_envelopes(ids.where(digit != "0").select(F.col("user_id").alias("schema_id"), body.alias("body")))


def schema_lookup_table_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, under the name that it first had with the table's own ids."""
    return schema_lookup(spark, sf_dir)


def late_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages before their schemas: the registrations of half the ids come with
    the second arrival, those of some never; every message that got its schema
    or is badly framed, once (D3 J3 S7 D1 K8). The rest stays parked."""
    inbox, schemas, out, ck = (scratch_path(spark, f"late-{n}") for n in ("in", "schemas", "out", "ck"))
    frames = written(event_frames(spark, sf_dir), "late-frames")
    digit = F.conv(F.substring(F.md5(F.concat(F.lit("late"), F.col("schema_id").cast("string")).cast("binary")), 1, 1), 16, 10)
    ids = written(table_registry(spark, sf_dir).withColumn("late", digit.cast("int") >= 8), "late-registry")
    for arrival in (0, 1):
        frames.where(F.col("event_id") % 2 == arrival).drop("event_id").write.mode("append").parquet(inbox)
        ids.where(F.col("late") if arrival else ~F.col("late")).drop("late").write.mode("append").parquet(schemas)
        src = spark.readStream.schema("schema_id INT, schema_json STRING").parquet(schemas)
        matched = match_late_schemas(file_frames(spark, inbox), src, salts=4)
        with state_partitions(spark, spark.sparkContext.defaultParallelism):
            q = (matched.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
                 .trigger(availableNow=True).start())
        q.awaitTermination()
    name = F.get_json_object("schema_json", "$.name")
    return spark.read.schema(MATCHED).parquet(out).select(F.col("src_offset").alias("event_id"), "reason", "schema_id", name.alias("schema_name"))


def avro_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots → Avro payload → framed message → frame parse, schema lookup,
    Avro decode → snapshots again (D4 D7 K5)."""
    snaps = snapshots(table(spark, sf_dir, "events"), "cumulative")
    enc = encode_payloads(snaps, SNAPSHOT_AVRO_SCHEMA)
    frames = enc.select(frame(F.col("payload"), F.lit(7)).alias("value"), "src_partition", "src_offset")
    reg = spark.createDataFrame([(7, SNAPSHOT_AVRO_SCHEMA)], "schema_id INT, schema_json STRING")
    back = good_rows(decode_frames(frames, reg))
    return back.select("src_offset", "timestamp", "ctxt", F.size("intr").cast("long").alias("n_intr"),
                       F.inline("cpus"))


def procstat_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots rendered as /proc/stat text (with an ignorable ``cpuidle``
    line) and parsed back (S5 P1–P9 G4)."""
    snaps = snapshots(table(spark, sf_dir, "events"), "cumulative")
    # CPU lines need /proc/stat names: the i-th CPU of a snapshot is cpu<i>.
    cpus = F.transform("cpus", lambda c, i: c.withField("id", F.concat(F.lit("cpu"), i.cast("string"))))
    text = F.concat_ws("\n", F.lit("cpuidle 3"), render_dump({"cpus": cpus}), F.lit(""))
    dumps = snaps.select("hostname", "timestamp", text.alias("text"))
    parsed = parse_dumps(dumps).where(F.col("reason").isNull())
    return parsed.select("hostname", "timestamp", "ctxt", F.size("intr").cast("long").alias("n_intr"),
                         F.inline("cpus"))


def damaged_dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots as /proc/stat text with a ``cpu`` line of totals, by (day + user)
    modulo 7: a short CPU line, an ``intr`` or a ``softirq`` without numbers, a bad
    ``ctxt`` that a later line overrides, a blank line; the rest is whole."""
    snaps = snapshots(table(spark, sf_dir, "events"), "cumulative")

    def total_of(counter: str):
        return F.aggregate("cpus", F.lit(0).cast("long"), lambda acc, c: acc + c[counter]).alias(counter)

    total = F.struct(F.lit("cpu").alias("id"), *[total_of(c) for c in CPU_COUNTERS])
    cpus = F.transform("cpus", lambda c, i: c.withField("id", F.concat(F.lit("cpu"), i.cast("string"))))
    rendered = F.split(render_dump({"cpus": F.concat(F.array(total), cpus)}), "\n")
    n, k = F.size("cpus"), (F.floor(F.col("timestamp") / 86_400_000) + F.col("src_offset")) % 7
    head, rest = F.slice(rendered, 1, n + 1), F.slice(rendered, n + 2, F.size(rendered))
    whole = F.concat(head, F.array(F.lit("cpuidle 3")), rest)
    at = F.when(k == 0, 1).when(k == 1, n + 2).when(k == 5, n + 8)
    bad = F.when(k == 0, F.concat(F.lit("cpu0 "), F.get("cpus", 0)["user"].cast("string"))).when(k == 1, "intr x").otherwise("softirq 1 z")
    hurt = F.transform(whole, lambda ln, i: F.when(i.eqNullSafe(at), bad).otherwise(ln))
    first = F.when(k == 2, F.array(F.lit("ctxt none"))).when(k == 3, F.array(F.lit(" "))).otherwise(F.array().cast("array<string>"))
    return snaps.select("hostname", "timestamp", F.array_join(F.concat(first, hurt), "\n").alias("text"))


def dump_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures written to log files and scanned back: total line, softirq and
    scalars of good dumps, line number and content of bad ones (S5 P1–P9 G4 E12 K8)."""
    path = scratch_path(spark, "dump-log")
    write_dump_log(damaged_dumps(spark, sf_dir), path)
    parsed = parse_dumps(read_dump_log(spark, path).withColumn("raw", F.col("text")))
    kept = ["hostname", "timestamp", "reason"]
    total = F.get(F.filter("cpus", lambda c: c["id"] == "cpu"), 0)
    good = parsed.where(F.col("reason").isNull()).select(
        *kept,
        F.lit(None).cast("long").alias("line_no"),
        F.lit(None).cast("string").alias("line"),
        F.size("cpus").cast("long").alias("n_cpus"),
        total["user"].alias("total_user"),
        F.aggregate("softirq", F.lit(0).cast("long"), lambda acc, x: acc + x).alias("softirq"),
        "ctxt",
    )
    bad = find_bad_line(parsed.where(F.col("reason").isNotNull()), "raw").select(*kept, "line_no", "line")
    return good.unionByName(bad, allowMissingColumns=True)


def _places(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return P.enrich_addresses(
        place_addresses(spark, sf_dir),
        place_destinations(spark, sf_dir),
        place_geocode(spark, sf_dir),
        place_elevation(spark, sf_dir),
        place_routes(spark, sf_dir),
        as_of=F.lit(AS_OF),
    )


def elevation_feet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geocode → elevation lookups, metres → floored feet."""
    located, _ = P.locate(place_addresses(spark, sf_dir), place_geocode(spark, sf_dir))
    return P.with_elevation(located, place_elevation(spark, sf_dir)).select("address", "elevation_ft")


def travel_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses × destinations with the first leg of the first driving route."""
    return _places(spark, sf_dir)["matrix"].select("address", "pos", "name", "duration")


def missing_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Destinations without a route."""
    return _places(spark, sf_dir)["missing"]


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report text lines per address, in order."""
    return _places(spark, sf_dir)["lines"]


def slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report file name from an address."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return p.select("p_partkey", P.slug(F.col("p_name")).alias("slug"),
                    P.report_file(F.col("p_name")).alias("file_name"))


def departure_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next midnight after a date, as epoch seconds."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return o.select("o_orderkey", P.next_midnight_epoch(F.col("o_orderdate")).alias("departure_epoch"))


def array_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Go-style slicing, append, prepend, replace, len, last, index
    on integer arrays derived from the embeddings."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    a = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(1000.0)))
    j = lambda c: F.array_join(c, ",")
    return e.select("vec_id", a.alias("a")).select(
        "vec_id",
        j(A.array_slice("a", 0, 2)).alias("head2"),
        j(A.array_slice("a", 1, 3)).alias("mid2"),
        j(A.append(A.array_slice("a", 0, 2), F.lit(4).cast("long"))).alias("appended"),
        j(A.prepend(A.array_slice("a", 1, 3), F.lit(0).cast("long"))).alias("prepended"),
        j(A.replace_at(A.array_slice("a", 0, 3), 2, F.lit(999).cast("long"))).alias("replaced"),
        A.length("a").cast("long").alias("n"),
        A.last("a").alias("last_v"),
        A.at("a", 5).alias("at5"),
        A.at("a", 1000).alias("at_oob"),
        j(A.array_slice("a", 60, 1000)).alias("slice_oob"),
    )


def peek(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first messages of a topic from the beginning (S11): a top-k by
    offset, the limit being the feature."""
    frames = table(spark, sf_dir, "events").select(
        F.lit(0).alias("src_partition"), F.col("event_id").alias("src_offset"), "event_type"
    )
    return peek_frames(frames, 5).select(F.col("src_offset").alias("event_id"), "event_type")


WIRE_SCHEMA_ID = 7


def wire_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Framed Avro snapshots as a broker would hold them (no hostname: the
    record has none)."""
    snaps = with_arrival_offsets(snapshots(table(spark, sf_dir, "events"), "cumulative"))
    enc = encode_payloads(snaps.drop("hostname"), SNAPSHOT_AVRO_SCHEMA)
    return enc.select(frame(F.col("payload"), F.lit(WIRE_SCHEMA_ID)).alias("value"), "src_partition", "src_offset")


def wire_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(WIRE_SCHEMA_ID, SNAPSHOT_AVRO_SCHEMA)], "schema_id INT, schema_json STRING")


def wire_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job 1 in batch from framed messages: decode, then the delta in broker
    order. Without a hostname every snapshot shares the ``unknown`` key, a
    single hot key in buckets bounded by rows (S3 D1–D4 J1 E4)."""
    snaps = good_rows(decode_frames(wire_frames(spark, sf_dir), wire_registry(spark)))
    snaps = snaps.withColumn("hostname", F.lit(None).cast("string"))
    m = enrich(written(snaps, "wire-snapshots"), order=("src_partition", "src_offset"), bucket="auto")
    return explode_metrics(m)


def snapshot_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per snapshot, as other producers write them: hosts as
    text, as a number, null or missing; counters as text, decimal, boolean or
    null; three in 17 with a fault (a counter beyond bigint, no CPUs, cut off)."""
    snaps = snapshots(table(spark, sf_dir, "events"), "cumulative")
    user, text = F.col("src_offset"), lambda c: c.cast("string")
    fault = (F.floor(F.col("timestamp") / 86_400_000) + user) % 17

    def cpu(c):
        odd = {
            "nice": F.concat(F.lit('"'), text(c["nice"]), F.lit('"')),
            "system": F.concat(text(c["system"]), F.lit(".75")),
            "steal": text(c["steal"] % 2 == 1),
            "irq": F.when(user % 3 == 0, F.lit("null")).otherwise(text(c["irq"])),
            "idle": F.when(fault == 0, F.lit("1e30")).otherwise(text(c["idle"])),
        }
        plain = ("user", "iowait", "softirq")
        fields = [F.concat(F.lit(f'"{n}":'), odd[n] if n in odd else text(c[n])) for n in (*plain, *odd)]
        return F.concat(F.lit('{"id":"'), c["id"], F.lit('",'), F.concat_ws(",", *fields), F.lit("}"))

    host = (
        F.when(user % 10 == 0, F.lit('"hostname":null,'))
        .when(user % 10 == 1, F.lit(""))
        .when(user % 10 == 2, F.concat(F.lit('"hostname":'), text(user), F.lit(",")))
        .otherwise(F.concat(F.lit('"hostname":"'), F.col("hostname"), F.lit('",')))
    )
    cpus = F.concat(F.lit(',"cpus":['), F.concat_ws(",", F.transform("cpus", cpu)), F.lit("]"))
    body = F.concat(
        F.lit("{"), host, F.lit('"timestamp":'), text(F.col("timestamp")), F.when(fault == 1, F.lit("")).otherwise(cpus),
        F.when(fault == 2, F.lit("")).otherwise(F.lit("}")),
    )
    # A document's partition is its place in time, so that broker order is arrival order.
    return snaps.select(
        body.alias("value"), F.floor(F.col("timestamp") / 86_400_000).cast("int").alias("src_partition"), user.alias("src_offset")
    )


def _documents_result(metrics: DataFrame, bad: DataFrame) -> DataFrame:
    rows = explode_metrics(metrics).withColumns(
        {"reason": F.lit(None).cast("string"), "src_offset": F.lit(None).cast("long")})
    return rows.unionByName(bad.select("reason", "src_offset"), allowMissingColumns=True)


def json_snapshot_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job 1 in batch from JSON snapshots with hosts, coerced counters and the
    default key; faulty documents with their reason (D9 D10 C5 C12 E4 E5)."""
    docs = written(snapshots_from_json(snapshot_documents(spark, sf_dir)), "json-snapshots")
    good = docs.where(F.col("reason").isNull())
    return _documents_result(enrich(good, bucket="auto"), docs.where(F.col("reason").isNotNull()))


def json_snapshot_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as streams: documents are parsed once into a table split by
    reason; the keyed state reads its good part by offset runs, since a fifth of
    the documents have the default key (D9 D10 A1 K8)."""
    lines, split, runs, sink, *cks = (
        scratch_path(spark, f"json-{n}") for n in ("in", "split", "runs", "out", "ck1", "ck2", "ck3"))
    snapshot_documents(spark, sf_dir).write.parquet(lines)
    src = spark.readStream.schema("value STRING, src_partition INT, src_offset LONG").parquet(lines)
    start_split(snapshots_from_json(src), split, cks[0]).awaitTermination()
    drain_runs(split_part(spark, split, SNAPSHOT_SPLIT), runs, sink, cks[1], cks[2], by_partition=False)
    return _documents_result(spark.read.parquet(sink), split_faults(spark, split, SNAPSHOT_SPLIT))


def wire_stream_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Producer and job 1 as chained streams (A7 K5 S3 A1): snapshots → framed
    Avro files → decode → keyed state → metrics. All rows have one key, so the
    state goes by offset runs."""
    from statflow.schemas import SNAPSHOT_ROW

    snaps = written(snapshots(table(spark, sf_dir, "events"), "cumulative"), "wire-snapshots")
    stage, frames_path, split, runs, sink = (
        scratch_path(spark, f"wire-{n}") for n in ("stage", "frames", "split", "runs", "out"))
    with_dense_offsets(snaps, F.lit(0)).drop("hostname").write.parquet(stage)
    src = spark.readStream.schema(SNAPSHOT_ROW).parquet(stage).drop("hostname")
    start_publish(src, SNAPSHOT_AVRO_SCHEMA, WIRE_SCHEMA_ID, frames_path,
                  scratch_path(spark, "wire-ck1")).awaitTermination()
    start_wire_split(file_frames(spark, frames_path), wire_registry(spark), split,
                     scratch_path(spark, "wire-ck2")).awaitTermination()
    drain_runs(split_part(spark, split, WIRE_SPLIT), runs, sink,
               scratch_path(spark, "wire-ck3"), scratch_path(spark, "wire-ck4"))
    return explode_metrics(spark.read.parquet(sink))


# Faults of the damaged frames, by (day + user) modulo 11; the rest is whole.
DAMAGE = 11


def damaged_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Framed snapshots keyed by host, 8 of 11 kinds damaged: cut payloads, a varint
    beyond 64 bits, a writer schema with a text timestamp, one without CPUs, an
    unregistered id, an id with two schemas, a short frame, a bad magic byte."""
    snaps = snapshots(table(spark, sf_dir, "events"), "cumulative")
    day = F.floor(F.col("timestamp") / 86_400_000)
    enc = encode_payloads(snaps, SNAPSHOT_AVRO_SCHEMA, SNAPSHOT.names).withColumn("k", (day + F.col("src_offset")) % DAMAGE)
    k, payload = F.col("k"), F.col("payload")
    body = (
        F.when(k == 0, payload.substr(F.lit(1), F.floor(F.octet_length(payload) / 2)))
        .when(k == 1, F.unhex(F.lit("FFFFFFFFFFFFFFFFFF7F00")))
        .when(k == 2, F.unhex(F.lit("0278")))
        .when(k == 3, payload.substr(F.lit(1), F.lit(10)))
        .otherwise(payload)
    )
    schema_id = F.when(k == 2, WIRE_SCHEMA_ID + 1).when(k == 3, WIRE_SCHEMA_ID + 2).when(k == 4, 99).when(k == 5, WIRE_SCHEMA_ID + 3)
    full = frame(body, F.coalesce(schema_id, F.lit(WIRE_SCHEMA_ID)))
    value = (
        F.when(k == 6, full.substr(F.lit(1), F.lit(3)))
        .when(k == 7, F.concat(F.unhex(F.lit("01")), full.substr(F.lit(2), F.octet_length(full))))
        .otherwise(full)
    )
    return enc.select(value.alias("value"), day.cast("int").alias("src_partition"), "src_offset", "hostname")


def damaged_registry(spark: SparkSession) -> DataFrame:
    text_time = '{"type":"record","name":"R","fields":[{"name":"timestamp","type":"string"}]}'
    no_cpus = '{"type":"record","name":"R","fields":[{"name":"timestamp","type":"long"}]}'
    rows = [(0, SNAPSHOT_AVRO_SCHEMA), (1, text_time), (2, no_cpus), (3, SNAPSHOT_AVRO_SCHEMA), (3, no_cpus)]
    return spark.createDataFrame([(WIRE_SCHEMA_ID + i, s) for i, s in rows], "schema_id INT, schema_json STRING")


def decode_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message once, with its reason or its CPU values."""
    found = decode_frames(damaged_frames(spark, sf_dir), damaged_registry(spark))
    busy = F.aggregate("cpus", F.lit(0).cast("long"), lambda acc, c: acc + c["user"] + c["guest_nice"])
    return found.select("src_partition", "src_offset", "reason", "timestamp", F.size("cpus").cast("long").alias("n_cpus"), busy.alias("busy"))


def wire_split_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job 1 from damaged frames of many hosts: each frame decoded once into a
    table split by reason, the keyed state on its good part (K8 D8 A1)."""
    frames_path, split, sink, ck1, ck2 = (scratch_path(spark, f"wire-split-{n}") for n in ("in", "split", "out", "ck1", "ck2"))
    damaged_frames(spark, sf_dir).write.parquet(frames_path)
    start_wire_split(file_frames(spark, frames_path, keyed=True), damaged_registry(spark), split, ck1).awaitTermination()
    with state_partitions(spark, spark.sparkContext.defaultParallelism):
        q = start_enrichment(split_part(spark, split, WIRE_SPLIT), sink, ck2)
    q.awaitTermination()
    return _documents_result(spark.read.parquet(sink), split_faults(spark, split, WIRE_SPLIT))


def archive_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job 2 over one line per event, ``error`` events cut short and ``signup``
    events without metrics: each event once, from the archive (no reason) or
    from the quarantine (K8)."""
    ev = table(spark, sf_dir, "events").select("event_id", "event_type")
    head = F.concat(F.lit('{"timestamp":'), F.col("event_id").cast("string"), F.lit(',"time_delta_ms":1'))
    value = (
        F.when(F.col("event_type") == "error", head)
        .when(F.col("event_type") == "signup", F.concat(head, F.lit("}")))
        .otherwise(F.concat(head, F.lit(',"cpu_metrics":[]}')))
    )
    lines, arch, bad, ck1, ck2 = (scratch_path(spark, f"quarantine-{n}") for n in ("in", "out", "bad", "ck1", "ck2"))
    ev.select(value.alias("value")).write.text(lines)
    stream = spark.readStream.schema("value STRING").text(lines)
    await_all([start_archive(stream, arch, ck1), start_archive_quarantine(stream, bad, ck2)])
    event = F.regexp_extract(F.col("value").cast("string"), r"^\{\"timestamp\":(-?\d+)", 1).cast("long")
    left = spark.read.schema("value BINARY, reason STRING").parquet(bad).select(event.alias("event_id"), "reason")
    good = read_archive(spark, arch).select(F.col("timestamp").alias("event_id"), F.lit(None).cast("string").alias("reason"))
    return good.unionByName(left)


def wire_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job 1 over one framed snapshot per event, cut to 3 bytes for ``signup``
    and with a bad magic byte for ``error`` events, after one event's snapshot
    that opens the state: each event once, from the metrics (no reason) or from
    the quarantine (K8)."""
    ev = table(spark, sf_dir, "events").select("event_id", "event_type")
    first = ev.limit(1).select(F.lit(None).cast("long").alias("event_id"), F.lit(None).cast("string").alias("event_type"))
    at = F.coalesce(F.col("event_id"), F.lit(-1).cast("long"))
    empty = {"long": F.lit(0), "array": F.array()}
    fields = [
        (at if f.name == "timestamp" else empty[f.dataType.typeName()].cast(f.dataType)).alias(f.name)
        for f in SNAPSHOT.fields
    ]
    snaps = ev.unionByName(first).select(*fields, "event_type", at.alias("src_offset"))
    full = frame(F.col("payload"), F.lit(WIRE_SCHEMA_ID))
    value = (
        F.when(F.col("event_type") == "signup", full.substr(F.lit(1), F.lit(3)))
        .when(F.col("event_type") == "error", F.concat(F.unhex(F.lit("01")), full.substr(F.lit(2), F.octet_length(full))))
        .otherwise(full)
    )
    frames_path, split, runs, sink, ck1, ck2, ck3 = (
        scratch_path(spark, f"wire-quarantine-{n}") for n in ("in", "split", "runs", "out", "ck1", "ck2", "ck3"))
    enc = encode_payloads(snaps, SNAPSHOT_AVRO_SCHEMA, [f.name for f in SNAPSHOT.fields])
    enc.select(value.alias("value"), F.lit(0).alias("src_partition"), "src_offset").write.parquet(frames_path)
    start_wire_split(file_frames(spark, frames_path), wire_registry(spark), split, ck1).awaitTermination()
    drain_runs(split_part(spark, split, WIRE_SPLIT), runs, sink, ck2, ck3)
    left = split_faults(spark, split, WIRE_SPLIT).select(F.col("src_offset").alias("event_id"), "reason")
    good = spark.read.parquet(sink).select(F.col("timestamp").alias("event_id"), F.lit(None).cast("string").alias("reason"))
    return good.unionByName(left)


def queries() -> dict[str, Query]:
    return {
        "counter_delta": counter_delta,
        "counter_delta_reset": counter_delta_reset,
        "snapshot_time_delta": snapshot_time_delta,
        "default_key": default_key,
        "metrics_round_trip": metrics_round_trip,
        "json_fields": json_fields,
        "hour_bucket": hour_bucket,
        "stream_delta": stream_delta,
        "stream_delta_batchwise": stream_delta_batchwise,
        "hot_stream_delta": hot_stream_delta,
        "archive_round_trip": archive_round_trip,
        "job_chain": job_chain,
        "frame_parse": frame_parse,
        "schema_lookup": schema_lookup,
        "schema_lookup_table_ids": schema_lookup_table_ids,
        "late_schemas": late_schemas,
        "avro_round_trip": avro_round_trip,
        "procstat_parse": procstat_parse,
        "dump_log": dump_log,
        "elevation_feet": elevation_feet,
        "travel_matrix": travel_matrix,
        "missing_routes": missing_routes,
        "report_lines": report_lines,
        "slug": slug,
        "departure_epoch": departure_epoch,
        "array_ops": array_ops,
        "peek": peek,
        "wire_delta": wire_delta,
        "wire_stream_delta": wire_stream_delta,
        "decode_errors": decode_errors,
        "wire_split_delta": wire_split_delta,
        "json_snapshot_delta": json_snapshot_delta,
        "json_snapshot_stream": json_snapshot_stream,
        "archive_quarantine": archive_quarantine,
        "wire_quarantine": wire_quarantine,
    }
