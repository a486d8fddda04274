"""Stream sources (S1, S3, S4, S12, A6) and the bounded peek.

A broker source yields ``value BINARY, src_partition INT, src_offset BIGINT``.
Kafka is used when its connector is on the classpath; the file twin reads
the same columns from a directory of Parquet files (used in tests here:
neither the Kafka nor the Avro connector jar is installed in this image).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statflow.schemas import FRAME, FRAME_KEYED


def kafka_frames(
    spark: SparkSession, bootstrap: str, topic: str, streaming: bool = True, max_offsets: int | None = None
) -> DataFrame:
    """Framed bytes from a topic, from the earliest offset (S1, S3, A6), at most
    ``max_offsets`` messages per micro-batch. The message key, when a producer sets one, is taken as the ``hostname`` (the
    snapshot record itself has no host field)."""
    reader = spark.readStream if streaming else spark.read
    raw = (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if streaming and max_offsets:
        raw = raw.option("maxOffsetsPerTrigger", max_offsets)
    raw = raw.load()
    return raw.select(
        F.col("value"),
        F.col("partition").cast("int").alias("src_partition"),
        F.col("offset").alias("src_offset"),
        F.col("key").cast("string").alias("hostname"),
    )


def file_frames(
    spark: SparkSession, path: str, streaming: bool = True, max_files: int | None = None, keyed: bool = False
) -> DataFrame:
    """File twin of ``kafka_frames``: Parquet with the FRAME columns (plus
    ``hostname`` when ``keyed``)."""
    schema = FRAME_KEYED if keyed else FRAME
    if streaming:
        reader = spark.readStream.schema(schema)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.parquet(path)
    return spark.read.schema(schema).parquet(path)


def kafka_json(
    spark: SparkSession, bootstrap: str, topic: str, streaming: bool = True, max_offsets: int | None = None
) -> DataFrame:
    """JSON strings from a topic (S4): ``value STRING`` plus the offsets."""
    frames = kafka_frames(spark, bootstrap, topic, streaming, max_offsets)
    return frames.select(F.col("value").cast("string").alias("value"), "src_partition", "src_offset")  # S4


def file_json(spark: SparkSession, path: str, streaming: bool = True) -> DataFrame:
    """File twin of ``kafka_json``: one JSON document per line."""
    reader = spark.readStream if streaming else spark.read
    return reader.text(path).select(F.col("value"))


def peek(frames: DataFrame, n: int = 1) -> DataFrame:
    """First ``n`` messages from the beginning (S11): the only limit in the
    reference, and the feature itself. Spark turns it into a top-k."""
    return frames.orderBy("src_partition", "src_offset").limit(n)


def read_schema_files(spark: SparkSession, path: str, schema_id: int | None = None) -> DataFrame:
    """Avro schema files (``.avsc``) → registry rows ``schema_id, schema_json``
    (S6). The id is given, or taken from a number in the file name
    (``snapshot-7.avsc``)."""
    raw = spark.read.text(path, wholetext=True).select(
        F.col("value").alias("schema_json"), F.col("_metadata.file_name").alias("name")
    )
    sid = F.lit(schema_id) if schema_id is not None else F.regexp_extract("name", r"(\d+)", 1).try_cast("int")
    found = raw.select(sid.cast("int").alias("schema_id"), "schema_json").where(F.col("schema_id").isNotNull())
    if found.isEmpty():
        raise ValueError(f"no schema with an id in {path}: give the id, or name a file <name>-<id>.avsc")
    return found


def value_only(frames: DataFrame) -> DataFrame:
    """The raw message bytes, nothing else."""
    return frames.select("value")
