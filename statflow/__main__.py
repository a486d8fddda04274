"""Command line: start the jobs with paths and options.

    python -m statflow job1    --frames DIR | --json DIR | --kafka HOST:PORT --topic T [--format json]
                               --registry DIR [--schema-id N] --out DIR --checkpoint DIR
                               [--engine state|runs|batchwise] [--sink parquet|json|kafka --out-kafka HOST:PORT --out-topic T]
                               [--max-offsets N] [--max-files N] [--trigger "60 seconds"]
    python -m statflow job2    --json DIR | --kafka HOST:PORT --topic T  --out DIR --checkpoint DIR
                               [--max-offsets N] [--target-mb N] [--trigger "60 seconds"]
    python -m statflow publish --dumps DIR --out DIR [--schema-id 1]
    python -m statflow places  --addresses CSV --destinations JSON --geocode DIR --elevation DIR
                               --routes DIR --out DIR [--as-of YYYY-MM-DD] [--overwrite]

Jobs 1 and 2 write the input they can't read, with a reason, to ``<out>_quarantine``. Job 1
decodes each message once, into ``<out>_decoded``, split by reason.
Without ``--trigger`` a stream drains what is there and stops
(``availableNow``); with it the query runs until stopped. The session comes
from ``spark-submit`` (or a local one when run directly).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from statflow.session import prepare


def _session() -> SparkSession:
    return prepare(SparkSession.builder.appName("statflow").getOrCreate())


def job1(a) -> None:
    """Input → a table split by reason (each message decoded once) → metrics, and
    the rows set aside with their reason."""
    from statflow.operators.snapshot_json import snapshots_from_json
    from statflow.sources.streams import file_frames, file_json, kafka_frames, kafka_json, read_schema_files
    from statflow.streaming import jobs as J
    from statflow.streaming.delta_batchwise import start_enrichment_batchwise
    from statflow.streaming.delta_runs import start_runs, start_runs_metrics

    spark = _session()
    out, ck = a.out.rstrip("/"), a.checkpoint.rstrip("/")
    split = f"{out}_decoded"
    if a.json or a.format == "json":
        schema = J.SNAPSHOT_SPLIT
        lines = file_json(spark, a.json) if a.json else kafka_json(spark, a.kafka, a.topic, max_offsets=a.max_offsets)
        first = J.start_split(snapshots_from_json(lines), split, f"{ck}_decoded", a.trigger)
    else:
        schema = J.WIRE_SPLIT
        if a.kafka:
            frames = kafka_frames(spark, a.kafka, a.topic, max_offsets=a.max_offsets)
        else:
            frames = file_frames(spark, a.frames, keyed=True, max_files=a.max_files)
        first = J.start_wire_split(frames, read_schema_files(spark, a.registry, a.schema_id), split, f"{ck}_decoded", a.trigger)
    if a.trigger in (None, "availableNow"):
        first.awaitTermination()  # drained before the next stages drain it
    else:
        J.await_folder(spark, split, first)
    good = J.split_part(spark, split, schema)
    kafka = {"kafka.bootstrap.servers": a.out_kafka, "topic": a.out_topic} if a.sink == "kafka" else None
    started = [first]
    if a.engine == "runs":  # hot hosts split into offset runs
        runs = f"{out}_runs"
        second = start_runs(good, runs, f"{ck}_runs", trigger=a.trigger)
        started.append(second)
        if a.trigger in (None, "availableNow"):
            second.awaitTermination()
        else:
            J.await_folder(spark, runs, second)
        q = start_runs_metrics(spark, runs, a.out, a.checkpoint, a.sink, a.trigger, kafka)
    elif a.engine == "batchwise":  # Parquet output under batch_id=<n>
        q = start_enrichment_batchwise(good, a.out, f"{out}_state", a.checkpoint, trigger=a.trigger)
    else:
        q = J.start_enrichment(good, a.out, a.checkpoint, sink_format=a.sink, trigger=a.trigger, kafka=kafka)
    faults = J.split_faults(spark, split, schema, streaming=True)
    faults = faults.select(F.col("value").cast("binary").alias("value"), "reason", "src_partition", "src_offset")
    bad = J.start_faults(faults, f"{out}_quarantine", f"{ck}_quarantine", a.trigger)
    J.await_all([q, bad, *started])


def job2(a) -> None:
    from statflow.sources.streams import file_json, kafka_json
    from statflow.streaming.archive import start_sized_archive
    from statflow.streaming.jobs import await_all, start_archive, start_archive_quarantine

    spark = _session()
    lines = kafka_json(spark, a.kafka, a.topic, max_offsets=a.max_offsets) if a.kafka else file_json(spark, a.json)
    if a.target_mb:  # one parse, files of a bounded size
        sized = start_sized_archive(lines, a.out, a.out.rstrip("/") + "_quarantine", a.checkpoint, a.target_mb << 20, a.trigger)
        return await_all([sized])
    q = start_archive(lines, a.out, a.checkpoint, trigger=a.trigger)
    bad = start_archive_quarantine(lines, a.out.rstrip("/") + "_quarantine",
                                   a.checkpoint.rstrip("/") + "_quarantine", trigger=a.trigger)
    await_all([q, bad])


def publish(a) -> None:
    from statflow.operators.procstat import parse_dumps, read_dump_files
    from statflow.operators.wire import encode_payloads, frame
    from statflow.schemas import SNAPSHOT, SNAPSHOT_AVRO_SCHEMA

    spark = _session()
    parsed = parse_dumps(read_dump_files(spark, a.dumps))
    good = parsed.where(F.col("reason").isNull())
    enc = encode_payloads(good.select("hostname", *[f.name for f in SNAPSHOT.fields]), SNAPSHOT_AVRO_SCHEMA,
                          [f.name for f in SNAPSHOT.fields])
    # Arrival order of collected dumps is their capture time; the host rides
    # along as a message key would.
    enc.select(
        frame(F.col("payload"), F.lit(a.schema_id)).alias("value"),
        F.lit(0).alias("src_partition"),
        F.col("timestamp").alias("src_offset"),
        "hostname",
    ).write.mode("append").parquet(a.out)
    parsed.where(F.col("reason").isNotNull()).select("hostname", "timestamp", "reason").write.mode("append").parquet(
        a.out.rstrip("/") + "_quarantine")


def places(a) -> None:
    from statflow.operators import places as P
    from statflow.schemas import ADDRESSES, ELEVATION, GEOCODE, ROUTES

    spark = _session()
    addresses = spark.read.option("header", True).schema(ADDRESSES).csv(a.addresses)
    out = P.enrich_addresses(
        addresses,
        P.read_destinations(spark, a.destinations),
        spark.read.schema(GEOCODE).parquet(a.geocode),
        spark.read.schema(ELEVATION).parquet(a.elevation),
        spark.read.schema(ROUTES).parquet(a.routes),
        as_of=F.lit(a.as_of) if a.as_of else None,
    )
    P.write_report_files(out["reports"], a.out, overwrite=a.overwrite)
    out["quarantine"].write.mode("append").parquet(a.out.rstrip("/") + "_quarantine")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="statflow")
    sub = p.add_subparsers(dest="cmd", required=True)
    j1 = sub.add_parser("job1")
    j1.add_argument("--frames")
    j1.add_argument("--json")
    j1.add_argument("--kafka")
    j1.add_argument("--topic")
    j1.add_argument("--format", choices=["avro", "json"], default="avro")
    j1.add_argument("--max-offsets", type=int)
    j1.add_argument("--max-files", type=int)
    j1.add_argument("--registry")
    j1.add_argument("--schema-id", type=int)
    j1.add_argument("--out", required=True)
    j1.add_argument("--out-kafka")
    j1.add_argument("--out-topic")
    j1.add_argument("--checkpoint", required=True)
    j1.add_argument("--engine", choices=["state", "runs", "batchwise"], default="state")
    j1.add_argument("--sink", choices=["parquet", "json", "kafka"], default="parquet")
    j1.add_argument("--trigger")
    j2 = sub.add_parser("job2")
    j2.add_argument("--json")
    j2.add_argument("--kafka")
    j2.add_argument("--topic")
    j2.add_argument("--max-offsets", type=int)
    j2.add_argument("--target-mb", type=int)
    j2.add_argument("--out", required=True)
    j2.add_argument("--checkpoint", required=True)
    j2.add_argument("--trigger")
    pb = sub.add_parser("publish")
    pb.add_argument("--dumps", required=True)
    pb.add_argument("--out", required=True)
    pb.add_argument("--schema-id", type=int, default=1)
    pl = sub.add_parser("places")
    for name in ("addresses", "destinations", "geocode", "elevation", "routes", "out"):
        pl.add_argument(f"--{name}", required=True)
    pl.add_argument("--as-of")
    pl.add_argument("--overwrite", action="store_true")
    a = p.parse_args(argv)
    if a.cmd == "job1":
        inputs = [a.frames, a.json, a.kafka]
        if sum(x is not None for x in inputs) != 1 or (a.kafka and not a.topic):
            j1.error("give one of --frames, --json, or --kafka with --topic")
        if not a.registry and not (a.json or a.format == "json"):
            j1.error("--registry is needed for framed Avro")
        if a.engine == "batchwise" and a.sink != "parquet":
            j1.error("the batchwise engine writes Parquet only")
        if a.sink == "kafka" and not (a.out_kafka and a.out_topic):
            j1.error("--sink kafka needs --out-kafka and --out-topic")
    if a.cmd == "job2" and ((a.json is None) == (a.kafka is None) or (a.kafka and not a.topic)):
        j2.error("give one of --json, or --kafka with --topic")
    {"job1": job1, "job2": job2, "publish": publish, "places": places}[a.cmd](a)


if __name__ == "__main__":
    main()
