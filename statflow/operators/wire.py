"""Framed-Avro messages.

Frame layout: byte 0 magic ``0``, bytes 1–4 the schema id (big-endian,
signed), the rest the Avro payload. Frame checks, the id and the payload are
native column expressions; the schema lookup is a join against a small
registry table; only the Avro decode/encode of the payload runs in Python,
batch-wise through Arrow (``mapInArrow``), because the spark-avro
connector is not on the classpath here.

Malformed input never fails a job: it gets a ``reason`` (``null_value``,
``short_frame``, ``bad_magic``, ``unknown_schema``, ``ambiguous_schema``,
``decode_error``) and goes to a quarantine table instead.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from statflow.functions.avro_binary import AvroError, decode, encode, parse_schema
from statflow.operators.lookup import small_side
from statflow.schemas import SNAPSHOT

MAGIC = b"\x00"
HEADER_BYTES = 5


def schema_id_bytes(schema_id: Column) -> Column:
    """4-byte big-endian two's-complement encoding of an int column."""
    return F.unhex(F.lpad(F.hex(schema_id.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))


def frame(payload: Column, schema_id: Column) -> Column:
    """Magic byte, schema id, payload (the inverse of ``parse_frames``)."""
    return F.concat(F.lit(bytearray(MAGIC)), schema_id_bytes(schema_id), payload)


def parse_frames(frames: DataFrame) -> DataFrame:
    """Add ``reason`` (null when the framing is valid), ``schema_id`` and
    ``payload`` (D1, D2). Five bytes exactly is valid framing with an empty
    payload; it fails later, at decode."""
    v = F.col("value")
    n = F.octet_length(v)
    reason = (
        F.when(v.isNull(), F.lit("null_value"))
        .when(n < HEADER_BYTES, F.lit("short_frame"))
        .when(v.substr(F.lit(1), F.lit(1)) != F.lit(bytearray(MAGIC)), F.lit("bad_magic"))
    )
    raw = F.conv(F.hex(v.substr(F.lit(2), F.lit(4))), 16, 10).cast("long")
    signed = F.when(raw >= F.lit(1 << 31), raw - F.lit(1 << 32)).otherwise(raw).cast("int")
    return frames.withColumn("reason", reason).select(
        "*",
        F.when(F.col("reason").isNull(), signed).alias("schema_id"),
        F.when(F.col("reason").isNull(), v.substr(F.lit(HEADER_BYTES + 1), n)).alias("payload"),
    )


def registry_from_envelopes(envelopes: DataFrame) -> DataFrame:
    """``(schema_id, body)`` registry responses → ``(schema_id, schema_json)``
    (S7, D12): the ``schema`` field when it is a JSON string, else no row."""
    v = F.try_variant_get(F.try_parse_json(F.col("body")), "$.schema", "variant")
    is_text = F.schema_of_variant(v) == F.lit("STRING")
    return envelopes.where(v.isNotNull() & is_text).select(
        F.col("schema_id").cast("int").alias("schema_id"),
        F.try_variant_get(v, "$", "string").alias("schema_json"),
    )


def lookup_schemas(parsed: DataFrame, registry: DataFrame, max_broadcast_rows: int = 100_000) -> DataFrame:
    """Attach ``schema_json`` by id (D3, J3); ids not registered get
    ``unknown_schema``. The registry is broadcast after a size check."""
    # One row per id, or a repeated registration would repeat its messages.
    # Two schemas under one id: neither can be trusted, so the id is set aside.
    least, most = F.min("schema_json"), F.max("schema_json")
    by_id = registry.groupBy("schema_id").agg(
        F.when(least == most, least).alias("schema_json"), (least != most).alias("__two"))
    joined = parsed.join(small_side(by_id, max_broadcast_rows), "schema_id", "left")
    reason = F.coalesce(
        F.col("reason"),
        F.when(F.col("__two"), F.lit("ambiguous_schema")),
        F.when(F.col("schema_json").isNull(), F.lit("unknown_schema")),
    )
    return joined.withColumn("reason", reason).drop("__two")


def _projector(target: T.DataType):
    """A function from a generic decoded datum to the Python value for a Spark type;
    None where the datum is taken as it is."""
    if isinstance(target, T.StructType):
        fields = [(f.name, _projector(f.dataType)) for f in target.fields]

        def record(value):
            if value is None:
                return None
            if not isinstance(value, dict):
                raise AvroError("not a record")
            return {n: value.get(n) if fn is None else fn(value.get(n)) for n, fn in fields}

        return record
    if isinstance(target, T.ArrayType):
        item = _projector(target.elementType)

        def array(value):
            if value is None:
                return None
            if not isinstance(value, list):
                raise AvroError("not an array")
            return value if item is None else [item(x) for x in value]

        return array
    return None


def _columns(recs: list, names: list[str], types: dict[str, pa.DataType]) -> list[pa.Array]:
    return [pa.array([None if r is None else r.get(n) for r in recs], type=types[n]) for n in names]


def _drop_unfit(recs: list, reasons: list, names: list[str], types: dict[str, pa.DataType]) -> list[pa.Array]:
    """The columns of the records; a record whose values don't fit their columns
    (another type in the writer schema) is a ``decode_error``, not the end of the task."""
    try:
        return _columns(recs, names, types)
    except (pa.ArrowInvalid, pa.ArrowTypeError, OverflowError, TypeError, ValueError):
        for k, rec in enumerate(recs):
            try:
                _columns([rec], names, types)
            except (pa.ArrowInvalid, pa.ArrowTypeError, OverflowError, TypeError, ValueError):
                recs[k], reasons[k] = None, "decode_error"
        return _columns(recs, names, types)


# Fields without which a snapshot can't be used: a message that lacks one is a decode error.
REQUIRED = ("timestamp", "cpus")


def decode_payloads(
    rows: DataFrame, target: T.StructType = SNAPSHOT, keep: Sequence[str] = ("value", "src_partition", "src_offset")
) -> DataFrame:
    """Avro payloads → ``keep`` columns, the ``target`` fields and ``reason``
    (D4, D8). Each payload is read with its writer schema (``schema_json``)
    and projected onto ``target`` by field name; a failed read gets
    ``decode_error``. Runs per Arrow batch (``mapInArrow``, no pandas);
    parsed schemas are cached per task."""
    keep = [c for c in keep if c in rows.columns]
    src = rows.select(*keep, "reason", "schema_json", "payload")
    in_fields = {f.name: f for f in src.schema.fields}
    out_schema = T.StructType(
        [in_fields[c] for c in keep]
        + [T.StructField(f.name, f.dataType, True) for f in target.fields]
        + [T.StructField("reason", T.StringType(), True)]
    )
    arrow_types = {f.name: to_arrow_type(f.dataType) for f in target.fields}
    names = [f.name for f in target.fields]
    required = [n for n in REQUIRED if n in names]
    project = _projector(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schemas: dict[str, object] = {}
        for batch in batches:
            reasons = batch.column("reason").to_pylist()
            recs: list = []
            for k, (sj, payload) in enumerate(zip(batch.column("schema_json").to_pylist(),
                                                  batch.column("payload").to_pylist())):
                rec = None
                if reasons[k] is None:
                    try:
                        if sj not in schemas:
                            schemas[sj] = parse_schema(sj)
                        rec = decode(payload, schemas[sj])
                        if not isinstance(rec, dict):
                            raise AvroError("not a record")
                        rec = project(rec)
                        if any(rec[n] is None for n in required):
                            raise AvroError("a required field is missing")
                    except (AvroError, ValueError, KeyError, IndexError, TypeError, OverflowError, RecursionError):
                        rec, reasons[k] = None, "decode_error"
                recs.append(rec)
            arrays = [batch.column(c) for c in keep]
            arrays += _drop_unfit(recs, reasons, names, arrow_types)
            arrays.append(pa.array(reasons, type=pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *names, "reason"])

    return src.mapInArrow(run, out_schema)


def values_of(column: pa.Array) -> list:
    """``column.to_pylist()``, with the numbers and texts inside arrays and structs taken in one go."""
    t = column.type
    if pa.types.is_list(t):
        ends = list(accumulate(pc.fill_null(pc.list_value_length(column), 0).to_pylist(), initial=0))
        inner = values_of(column.flatten())
        out = [inner[a:b] for a, b in zip(ends, ends[1:])]
    elif pa.types.is_struct(t) and t.num_fields:
        names = t.names
        out = [dict(zip(names, row)) for row in zip(*map(values_of, column.flatten()))]
    elif pa.types.is_string(t) or (pa.types.is_integer(t) or pa.types.is_floating(t)) and not column.null_count:
        return column.to_numpy(zero_copy_only=False).tolist()
    else:
        return column.to_pylist()
    if column.null_count:
        out = [x if valid else None for x, valid in zip(out, column.is_valid().to_pylist())]
    return out


def encode_payloads(
    rows: DataFrame, schema_json: str, fields: Sequence[str] | None = None, out_col: str = "payload"
) -> DataFrame:
    """Rows → Avro payload bytes with the given writer schema (D7); all other
    columns pass through. Runs per Arrow batch (``mapInArrow``)."""
    schema = parse_schema(schema_json)
    fields = list(fields or [f["name"] for f in schema["fields"]])
    out_schema = T.StructType(list(rows.schema.fields) + [T.StructField(out_col, T.BinaryType(), True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [values_of(batch.column(f)) for f in fields]
            recs = (dict(zip(fields, row)) for row in zip(*columns))
            payloads = pa.array([encode(r, schema) for r in recs], type=pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, payloads], names=[*batch.schema.names, out_col])

    return rows.mapInArrow(run, out_schema)


def decode_frames(
    frames: DataFrame, registry: DataFrame, target: T.StructType = SNAPSHOT,
    keep: Sequence[str] = ("value", "src_partition", "src_offset"),
) -> DataFrame:
    """Frames → decoded rows with ``reason`` (null for good rows)."""
    return decode_payloads(lookup_schemas(parse_frames(frames), registry), target, keep)


def good_rows(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reason").isNull()).drop("reason", "value")


def quarantine(decoded: DataFrame) -> DataFrame:
    """K8: the rejected messages with their reason and position."""
    cols = [c for c in ("value", "reason", "src_partition", "src_offset") if c in decoded.columns]
    return decoded.where(F.col("reason").isNotNull()).select(*cols)
