"""Schemas after their messages: parked, released, expired; in = good + bad + parked."""

from __future__ import annotations

import time

from statflow.operators.wire import frame
from statflow.streaming.jobs import state_partitions
from statflow.streaming.late_schemas import MATCHED, match_late_schemas
from pyspark.sql import functions as F

FRAMES = "value BINARY, src_partition INT, src_offset LONG"
SCHEMAS = "schema_id INT, schema_json STRING"


def arrive(spark, path, rows):
    df = spark.createDataFrame(rows, "schema_id int, src_offset long")
    df.select(
        F.when(F.col("schema_id").isNotNull(), frame(F.encode(F.col("src_offset").cast("string"), "UTF-8"), F.col("schema_id"))).alias("value"),
        F.lit(0).alias("src_partition"), "src_offset",
    ).coalesce(1).write.mode("append").parquet(path)


def register(spark, path, rows):
    spark.createDataFrame(rows, SCHEMAS).coalesce(1).write.mode("append").parquet(path)


def run(spark, tmp, known=None, ttl_ms=None, salts=2, wanted=0):
    """Drain the input; with a ttl, run until so many rows have come."""
    frames = spark.readStream.schema(FRAMES).parquet(f"{tmp}/in")
    schemas = spark.readStream.schema(SCHEMAS).parquet(f"{tmp}/schemas")
    matched = match_late_schemas(frames, schemas, known, ttl_ms, salts)
    with state_partitions(spark, 2):
        writer = matched.writeStream.format("parquet").option("path", f"{tmp}/out").option("checkpointLocation", f"{tmp}/ck")
        q = (writer.trigger(processingTime="1 second") if ttl_ms else writer.trigger(availableNow=True)).start()
    if ttl_ms:
        try:
            for _ in range(60):
                time.sleep(1)
                assert q.exception() is None, q.exception()
                if q.lastProgress and spark.read.schema(MATCHED).parquet(f"{tmp}/out").count() >= wanted:
                    break
        finally:
            q.stop()
    else:
        q.awaitTermination()
    rows = spark.read.schema(MATCHED).parquet(f"{tmp}/out").collect()
    return {r["src_offset"]: (r["reason"], r["schema_json"], bytes(r["payload"]) if r["payload"] else None) for r in rows}, len(rows)


def test_parked_until_registered_then_expired(spark, tmp_path):
    tmp = str(tmp_path)
    arrive(spark, f"{tmp}/in", [(1, 10), (2, 20), (2, 21), (3, 30), (None, 40)])
    register(spark, f"{tmp}/schemas", [(1, "one"), (7, "seven"), (8, None)])
    got, n = run(spark, tmp)
    assert got == {10: (None, "one", b"10"), 40: ("null_value", None, None)} and n == 2
    arrive(spark, f"{tmp}/in", [(2, 22), (7, 70), (3, 31)])
    register(spark, f"{tmp}/schemas", [(2, "two"), (2, "other")])
    got, n = run(spark, tmp)
    assert {k for k, v in got.items() if v[0] is None} == {10, 20, 21, 22, 70} and n == 6
    assert len({got[k][1] for k in (20, 21, 22)}) == 1 and got[70] == (None, "seven", b"70")


def test_parked_messages_expire(spark, tmp_path):
    tmp = str(tmp_path)
    arrive(spark, f"{tmp}/in", [(1, 10), (3, 30), (3, 31)])
    register(spark, f"{tmp}/schemas", [(1, "one")])
    got, n = run(spark, tmp, ttl_ms=500, wanted=3)
    assert got == {10: (None, "one", b"10"), 30: ("unknown_schema", None, b"30"), 31: ("unknown_schema", None, b"31")} and n == 3


def test_known_schemas_need_no_state(spark, tmp_path):
    tmp = str(tmp_path)
    known = spark.createDataFrame([(1, "one")], SCHEMAS)
    arrive(spark, f"{tmp}/in", [(1, 10), (2, 20)])
    register(spark, f"{tmp}/schemas", [(2, "two")])
    got, n = run(spark, tmp, known)
    assert {k: v[1] for k, v in got.items()} == {10: "one", 20: "two"} and n == 2


def test_ids_share_a_key_of_the_state():
    """One call serves a bucket of ids: a schema frees the messages of its id, a timer those that are due."""
    import pandas as pd
    from statflow.streaming import late_schemas as L

    class Map(dict):
        reads = 0

        def getValue(self, key):
            self.reads += 1
            return self.get(key)

        def updateValue(self, key, value):
            self[key] = value

        def removeKey(self, key):
            del self[key]

        def iterator(self):
            return iter(list(self.items()))

    class Handle:
        def __init__(self):
            self.maps, self.timers = {}, []

        def getMapState(self, name, key, value):
            return self.maps.setdefault(name, Map())

        def registerTimer(self, ms):
            self.timers.append(ms)

    class Now:
        def __init__(self, ms):
            self.getCurrentProcessingTimeInMs = self.getExpiryTimeInMs = lambda: ms

    names = [c.split()[0] for c in L.ARRIVING.split(", ")]

    def rows(*found):
        full = [(0, 0, i, None if v is None else b"v", 0, v, b"p", None, s) for i, v, s in found]
        return pd.DataFrame(full, columns=names)

    def offsets(out):
        return sorted((int(r.src_offset), r.reason, r.schema_json) for pdf in out for r in pdf.itertuples())

    handle, processor = Handle(), L.ParkedMessages(100)
    processor.init(handle)
    first = [rows((1, 10, None), (2, 20, None), (3, None, "three")), rows((2, 21, None), (3, 30, None))]
    assert offsets(processor.handleInputRows((0, 0), iter(first), Now(0))) == [(30, None, "three")]
    assert handle.maps["ids"].reads == 3 and handle.timers == [100]  # one look an id and call
    second = [rows((4, 40, None), (2, None, "two"), (2, None, "other"))]
    assert offsets(processor.handleInputRows((0, 0), iter(second), Now(50))) == [(20, None, "other"), (21, None, "other")]
    assert offsets(processor.handleExpiredTimer((0, 0), Now(100), Now(100))) == [(10, "unknown_schema", None)]
    assert offsets(processor.handleExpiredTimer((0, 0), Now(150), Now(150))) == [(40, "unknown_schema", None)]
    assert not handle.maps["parked"]
