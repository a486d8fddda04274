"""All schemas used by statflow, as Spark types. No logic."""

from __future__ import annotations

import json

from pyspark.sql import types as T

# The snapshot counter fields in the order /proc/stat lists them.
CPU_COUNTERS = (
    "user", "nice", "system", "idle", "iowait", "irq", "softirq", "steal",
    "guest", "guest_nice",
)
# The counters that make up the total of a CPU (guest time is
# already part of user time, so guest and guest_nice stay out).
TOTAL_COUNTERS = ("user", "nice", "system", "idle", "iowait", "irq", "softirq", "steal")
# The counters that get a percentage of their own.
PCT_COUNTERS = ("user", "system", "idle", "iowait")
# Scalar lines of a /proc/stat dump.
SCALAR_FIELDS = ("ctxt", "btime", "processes", "procs_running", "procs_blocked")

CPU = T.StructType(
    [T.StructField("id", T.StringType(), False)]
    + [T.StructField(c, T.LongType(), False) for c in CPU_COUNTERS]
)

SNAPSHOT = T.StructType(
    [
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("cpus", T.ArrayType(CPU, False), False),
        T.StructField("intr", T.ArrayType(T.LongType(), False), False),
        T.StructField("softirq", T.ArrayType(T.LongType(), False), False),
    ]
    + [T.StructField(f, T.LongType(), False) for f in SCALAR_FIELDS]
)

# Snapshot with the optional host and the arrival-order columns.
SNAPSHOT_ROW = T.StructType(
    [T.StructField("hostname", T.StringType(), True)]
    + list(SNAPSHOT.fields)
    + [
        T.StructField("src_partition", T.IntegerType(), True),
        T.StructField("src_offset", T.LongType(), True),
    ]
)

CPU_METRIC = T.StructType(
    [
        T.StructField("cpu_id", T.StringType(), True),
        T.StructField("user_pct", T.DoubleType(), True),
        T.StructField("system_pct", T.DoubleType(), True),
        T.StructField("idle_pct", T.DoubleType(), True),
        T.StructField("iowait_pct", T.DoubleType(), True),
        T.StructField("total_busy_pct", T.DoubleType(), True),
    ]
)

# The three-field record the sink carries.
METRICS = T.StructType(
    [
        T.StructField("timestamp", T.LongType(), True),
        T.StructField("time_delta_ms", T.LongType(), True),
        T.StructField("cpu_metrics", T.ArrayType(CPU_METRIC, True), True),
    ]
)

# Metrics plus the host we keep as an extra column.
METRICS_ROW = T.StructType([T.StructField("hostname", T.StringType(), True)] + list(METRICS.fields))

FRAME = T.StructType(
    [
        T.StructField("value", T.BinaryType(), True),
        T.StructField("src_partition", T.IntegerType(), True),
        T.StructField("src_offset", T.LongType(), True),
    ]
)

# Frames with the host carried next to the value (as a message key).
FRAME_KEYED = T.StructType(list(FRAME.fields) + [T.StructField("hostname", T.StringType(), True)])

SCHEMA_LOOKUP = T.StructType(
    [
        T.StructField("schema_id", T.IntegerType(), False),
        T.StructField("schema_json", T.StringType(), False),
    ]
)

QUARANTINE = T.StructType(
    [
        T.StructField("value", T.BinaryType(), True),
        T.StructField("reason", T.StringType(), False),
        T.StructField("src_partition", T.IntegerType(), True),
        T.StructField("src_offset", T.LongType(), True),
    ]
)

PROCSTAT_DUMP = T.StructType(
    [
        T.StructField("hostname", T.StringType(), True),
        T.StructField("timestamp", T.LongType(), True),
        T.StructField("text", T.StringType(), True),
    ]
)

ADDRESSES = T.StructType(
    [
        T.StructField("address", T.StringType(), False),
        T.StructField("notes", T.StringType(), True),
    ]
)
GEOCODE = T.StructType(
    [
        T.StructField("address", T.StringType(), False),
        T.StructField("rank", T.IntegerType(), False),
        T.StructField("lat", T.DoubleType(), False),
        T.StructField("lng", T.DoubleType(), False),
    ]
)
ELEVATION = T.StructType(
    [
        T.StructField("lat", T.DoubleType(), False),
        T.StructField("lng", T.DoubleType(), False),
        T.StructField("rank", T.IntegerType(), False),
        T.StructField("elevation_m", T.DoubleType(), True),
    ]
)
ROUTES = T.StructType(
    [
        T.StructField("lat", T.DoubleType(), False),
        T.StructField("lng", T.DoubleType(), False),
        T.StructField("destination", T.StringType(), False),
        T.StructField("mode", T.StringType(), False),
        T.StructField("departure_epoch", T.LongType(), False),
        T.StructField("route_rank", T.IntegerType(), False),
        T.StructField("leg_rank", T.IntegerType(), False),
        T.StructField("duration_text", T.StringType(), True),
    ]
)
DESTINATIONS = T.StructType(
    [
        T.StructField("pos", T.IntegerType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("destination", T.StringType(), False),
    ]
)

# The published names of the snapshot record and of its CPU record.
AVRO_NAMESPACE = "local.metrics"
AVRO_RECORD = "ProcStatSnapshot"
AVRO_CPU_RECORD = "CpuStat"

_AVRO_TYPES = {"string": "string", "bigint": "long"}


def avro_schema(struct: T.StructType, names: list[str], namespace: str | None = None) -> dict:
    """The Avro record of a struct of texts, longs, arrays and structs; ``names``
    are the records' names from the outside in."""

    def of(t: T.DataType, inner: list[str]):
        if isinstance(t, T.ArrayType):
            return {"type": "array", "items": of(t.elementType, inner)}
        if isinstance(t, T.StructType):
            return avro_schema(t, inner)
        return _AVRO_TYPES[t.simpleString()]

    head = {"type": "record", "name": names[0]} | ({"namespace": namespace} if namespace else {})
    return head | {"fields": [{"name": f.name, "type": of(f.dataType, names[1:])} for f in struct.fields]}


# The writer schema registered for the framed messages.
SNAPSHOT_AVRO_SCHEMA = json.dumps(avro_schema(SNAPSHOT, [AVRO_RECORD, AVRO_CPU_RECORD], AVRO_NAMESPACE))
