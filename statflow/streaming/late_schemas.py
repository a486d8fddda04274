"""Schemas that arrive after their messages.

A registry snapshot joined to a stream never sees a schema that is registered
later. Here messages and registrations are two streams in one keyed state: a
message whose schema is not there yet is parked under its schema id, goes on
when the schema comes, and is set aside as ``unknown_schema`` when a timer
runs out. One id may carry nearly all messages, so its messages are dealt to
``salts`` keys by their position, and each registration goes to all of them;
a worker holds one Arrow chunk of messages, the rest stays in the state store.
A key is a bucket of ids and a salt, since a call of Python costs as much as many
messages; inside, a map of the ids and a map of the messages, in chunks by id, are
read and written for the ids of the micro-batch only.
Messages whose schema a snapshot already knows need no state: pass it as
``known`` and only the others are shuffled. With ``ttl_ms`` use a processing-time
trigger: timers keep a query at work that should only drain its input.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from statflow.operators.wire import lookup_schemas, parse_frames

SALTS = 64
#: Keys of the state: buckets of ids times salts.
KEYS = 4096
#: Parked messages that go on as one chunk.
CHUNK = 4096

ARRIVING = "bucket int, salt int, schema_id int, value binary, src_partition int, src_offset long, payload binary, reason string, schema_json string"
MATCHED = "schema_id int, value binary, src_partition int, src_offset long, payload binary, reason string, schema_json string"
_NAMES = [c.split()[0] for c in MATCHED.split(", ")]


class ParkedMessages(StatefulProcessor):
    """Per (bucket of ids, salt): the schema of each id once it is known, its messages until then.

    The first schema of an id stands. Messages leave in no fixed order: what
    needs one sorts by their position.
    """

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # id → its schema, the number of its chunks, and when they run out
        self.ids = handle.getMapState("ids", "schema_id int", "schema_json string, chunks int, expires long")
        self.parked = handle.getMapState(
            "parked", "schema_id int, chunk int",
            "messages array<struct<value:binary,src_partition:int,src_offset:bigint,payload:binary>>")

    def _look(self, seen: dict, schema_id: int) -> list:
        """``[schema_json, chunks, expires]`` of an id, read once a call."""
        if schema_id not in seen:
            seen[schema_id] = list(self.ids.getValue((schema_id,)) or (None, 0, 0))
        return seen[schema_id]

    def _park(self, entry: list, schema_id: int, messages: list, expires: int) -> None:
        if not entry[1]:
            entry[2] = expires
        for at in range(0, len(messages), CHUNK):
            self.parked.updateValue((schema_id, entry[1]), (messages[at : at + CHUNK],))
            entry[1] += 1

    def _leave(self, entries: dict, reason: str | None) -> Iterator[pd.DataFrame]:
        rows = []
        for schema_id, entry in entries.items():
            for chunk in range(entry[1]):
                (messages,) = self.parked.getValue((schema_id, chunk))
                rows += [(schema_id, *m, reason, entry[0]) for m in messages]
                self.parked.removeKey((schema_id, chunk))
                if len(rows) >= CHUNK:
                    yield pd.DataFrame(rows, columns=_NAMES)
                    rows = []
            entry[1] = 0
            self.ids.updateValue((schema_id,), tuple(entry))
        if rows:
            yield pd.DataFrame(rows, columns=_NAMES)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        seen, changed, parked = {}, set(), False
        expires = timerValues.getCurrentProcessingTimeInMs() + self.ttl_ms if self.ttl_ms else 0
        for pdf in rows:
            is_schema = pdf["value"].isna() & pdf["schema_json"].notna()
            arrived = pdf[is_schema]
            least = {}
            for schema_id, schema_json in zip(arrived["schema_id"].tolist(), arrived["schema_json"].tolist()):
                least[schema_id] = min(schema_json, least.get(schema_id, schema_json))
            for schema_id, schema_json in least.items():
                entry = self._look(seen, schema_id)
                if entry[0] is None:
                    entry[0] = schema_json
                    changed.add(schema_id)
            messages = pdf[~is_schema]
            known = {i: self._look(seen, i)[0] for i in messages["schema_id"].unique().tolist()}
            schema_json = pd.Series([known[i] for i in messages["schema_id"].tolist()], index=messages.index, dtype=object)
            through = schema_json.notna()
            if through.any():
                yield messages.assign(schema_json=schema_json)[through][_NAMES]
            waiting: dict[int, list] = {}
            kept = messages.loc[~through, ["schema_id", "value", "src_partition", "src_offset", "payload"]]
            for i, v, p, o, b in kept.itertuples(index=False):
                waiting.setdefault(int(i), []).append((bytes(v), int(p), int(o), bytes(b)))
            for schema_id, found in waiting.items():
                self._park(seen[schema_id], schema_id, found, expires)
                changed.add(schema_id)
                parked = True
        free = {i: e for i, e in seen.items() if e[0] is not None and e[1]}
        for schema_id in changed - free.keys():
            self.ids.updateValue((schema_id,), tuple(seen[schema_id]))
        yield from self._leave(free, None)
        if parked and self.ttl_ms:
            self.handle.registerTimer(expires)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        found = {i: list(entry) for (i,), entry in self.ids.iterator()}
        yield from self._leave({i: e for i, e in found.items() if e[1] and e[2] <= now}, "unknown_schema")

    def close(self) -> None:
        pass


def match_late_schemas(
    frames: DataFrame, registrations: DataFrame, known: DataFrame | None = None,
    ttl_ms: int | None = None, salts: int = SALTS,
) -> DataFrame:
    """Framed messages × registrations (``schema_id, schema_json``), both streams:
    ``MATCHED`` rows for ``decode_payloads``; a message shows up once its schema has come,
    or with a reason. ``known``: a table of schemas registered before the start."""
    parsed = parse_frames(frames)
    if known is not None:
        parsed = lookup_schemas(parsed, known)
        parsed = parsed.withColumn("reason", F.when(F.col("reason") != "unknown_schema", F.col("reason")))
    else:
        parsed = parsed.withColumn("schema_json", F.lit(None).cast("string"))
    waits = F.col("reason").isNull() & F.col("schema_json").isNull()
    through = parsed.where(~waits).select(*_NAMES)
    salt = F.pmod(F.xxhash64("src_partition", "src_offset"), F.lit(salts)).cast("int")
    bucket = F.pmod(F.xxhash64("schema_id"), F.lit(max(1, KEYS // salts))).cast("int")
    columns = [bucket.alias("bucket"), *[c.split()[0] for c in ARRIVING.split(", ")[1:]]]
    nothing = {"value": "binary", "src_partition": "int", "src_offset": "long", "payload": "binary", "reason": "string"}
    messages = parsed.where(waits).withColumn("salt", salt).select(*columns)
    schemas = registrations.where("schema_json IS NOT NULL AND schema_id IS NOT NULL").select(
        F.col("schema_id").cast("int").alias("schema_id"), "schema_json",
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
        *[F.lit(None).cast(t).alias(n) for n, t in nothing.items()],
    ).select(*columns)
    matched = messages.unionByName(schemas).groupBy("bucket", "salt").transformWithStateInPandas(
        statefulProcessor=ParkedMessages(ttl_ms), outputStructType=MATCHED, outputMode="Append",
        timeMode="ProcessingTime" if ttl_ms else "None",
    )
    return through.unionByName(matched)
