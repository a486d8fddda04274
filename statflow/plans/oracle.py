"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each string runs on the driver tables registered as views. They are written
independently of the Spark code: the "previous snapshot" here is found by
numbering a host's distinct snapshots and joining snapshot k with k-1.
"""

from __future__ import annotations

# Counter construction shared by the snapshot-based oracles.
_DAILY = """
daily AS (
  SELECT user_id,
         CAST(epoch_ms(date_trunc('day', ts)) AS BIGINT) AS ts_ms,
         event_type AS id,
         CAST(count(*) AS BIGINT) AS c_user,
         CAST(sum(event_id % 7) AS BIGINT) AS c_nice,
         CAST(sum(event_id % 11) AS BIGINT) AS c_system,
         CAST(sum(event_id % 13) AS BIGINT) AS c_idle,
         CAST(sum(event_id % 5) AS BIGINT) AS c_iowait,
         CAST(sum(event_id % 3) AS BIGINT) AS c_irq,
         CAST(sum(event_id % 2) AS BIGINT) AS c_softirq,
         CAST(sum(event_id % 17) AS BIGINT) AS c_steal,
         CAST(sum(event_id % 19) AS BIGINT) AS c_guest,
         CAST(sum(event_id % 23) AS BIGINT) AS c_guest_nice
  FROM events
  GROUP BY 1, 2, 3
)"""

_CUMULATIVE = """
cpu AS (
  SELECT user_id, ts_ms, id,
         CAST(sum(c_user) OVER w AS BIGINT) AS c_user,
         CAST(sum(c_nice) OVER w AS BIGINT) AS c_nice,
         CAST(sum(c_system) OVER w AS BIGINT) AS c_system,
         CAST(sum(c_idle) OVER w AS BIGINT) AS c_idle,
         CAST(sum(c_iowait) OVER w AS BIGINT) AS c_iowait,
         CAST(sum(c_irq) OVER w AS BIGINT) AS c_irq,
         CAST(sum(c_softirq) OVER w AS BIGINT) AS c_softirq,
         CAST(sum(c_steal) OVER w AS BIGINT) AS c_steal,
         CAST(sum(c_guest) OVER w AS BIGINT) AS c_guest,
         CAST(sum(c_guest_nice) OVER w AS BIGINT) AS c_guest_nice
  FROM daily
  WINDOW w AS (PARTITION BY user_id, id ORDER BY ts_ms
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""

_RESET = """
cpu AS (SELECT * FROM daily)"""


def _host(hostless_every: int) -> str:
    if hostless_every:
        return (
            f"CASE WHEN user_id % {hostless_every} = 0 THEN 'unknown' "
            "ELSE 'host-' || CAST(user_id AS VARCHAR) END"
        )
    return "'host-' || CAST(user_id AS VARCHAR)"


def _pairs(cpu_cte: str, hostless_every: int = 0, host: str | None = None) -> str:
    """CTEs up to ``pairs``: each CPU of snapshot k with the same CPU of k-1."""
    return f"""
WITH {_DAILY},
{cpu_cte},
hcpu AS (SELECT {host or _host(hostless_every)} AS hostname, user_id, ts_ms, id,
                c_user, c_nice, c_system, c_idle, c_iowait, c_irq, c_softirq, c_steal
         FROM cpu),
snaps AS (SELECT DISTINCT hostname, user_id, ts_ms FROM hcpu),
numbered AS (
  SELECT hostname, user_id, ts_ms,
         row_number() OVER (PARTITION BY hostname ORDER BY ts_ms, user_id) AS k
  FROM snaps
),
cur AS (SELECT h.*, n.k FROM hcpu h JOIN numbered n USING (hostname, user_id, ts_ms)),
pairs AS (
  SELECT c.hostname, c.ts_ms, c.ts_ms - p.ts_ms AS time_delta_ms, c.id,
         c.c_user - p.c_user AS d_user, c.c_nice - p.c_nice AS d_nice,
         c.c_system - p.c_system AS d_system, c.c_idle - p.c_idle AS d_idle,
         c.c_iowait - p.c_iowait AS d_iowait, c.c_irq - p.c_irq AS d_irq,
         c.c_softirq - p.c_softirq AS d_softirq, c.c_steal - p.c_steal AS d_steal
  FROM cur c JOIN cur p
    ON p.hostname = c.hostname AND p.id = c.id AND p.k = c.k - 1
),
totals AS (
  SELECT *, d_user + d_nice + d_system + d_idle + d_iowait + d_irq + d_softirq + d_steal AS total
  FROM pairs
)"""


def _metric_rows(cpu_cte: str, hostless_every: int = 0, host: str | None = None) -> str:
    return (
        _pairs(cpu_cte, hostless_every, host)
        + """
SELECT hostname,
       ts_ms AS timestamp,
       time_delta_ms,
       id AS cpu_id,
       (CAST(d_user AS DOUBLE) * 100.0::DOUBLE) / CAST(total AS DOUBLE) AS user_pct,
       (CAST(d_system AS DOUBLE) * 100.0::DOUBLE) / CAST(total AS DOUBLE) AS system_pct,
       (CAST(d_idle AS DOUBLE) * 100.0::DOUBLE) / CAST(total AS DOUBLE) AS idle_pct,
       (CAST(d_iowait AS DOUBLE) * 100.0::DOUBLE) / CAST(total AS DOUBLE) AS iowait_pct,
       (CAST(total - d_idle AS DOUBLE) * 100.0::DOUBLE) / CAST(total AS DOUBLE) AS total_busy_pct
FROM totals
WHERE total > 0
"""
    )


COUNTER_DELTA = _metric_rows(_CUMULATIVE)
COUNTER_DELTA_RESET = _metric_rows(_RESET)
DEFAULT_KEY = _metric_rows(_CUMULATIVE, hostless_every=10)
# Every snapshot without a host: one sequence in (time, user) order.
ALL_UNKNOWN = _metric_rows(_CUMULATIVE, hostless_every=1)

# Half of the users without a host, in two partitions: one sequence per host and partition.
HOT_STREAM_DELTA = (
    "SELECT * REPLACE (split_part(hostname, '/', 1) AS hostname) FROM ("
    + _metric_rows(
        _CUMULATIVE,
        host="CASE WHEN user_id % 2 = 0 THEN 'unknown/' || CAST((user_id // 2) % 2 AS VARCHAR) "
        "ELSE 'host-' || CAST(user_id AS VARCHAR) END",
    )
    + ")"
)

# Snapshots as JSON, with odd hosts and counters: see queries.snapshot_documents.
_JSON_FAULT = "(ts_ms // 86400000 + user_id) % 17"
_JSON_HOST = """CASE WHEN user_id % 10 IN (0, 1) THEN 'unknown' WHEN user_id % 10 = 2 THEN CAST(user_id AS VARCHAR)
                     ELSE 'host-' || CAST(user_id AS VARCHAR) END"""
_JSON_CPU = (
    _CUMULATIVE.replace("cpu AS (", "all_cpu AS (", 1)
    + f""",
cpu AS (
  SELECT * REPLACE (CASE WHEN user_id % 3 = 0 THEN 0 ELSE c_irq END AS c_irq, c_steal % 2 AS c_steal)
  FROM all_cpu WHERE {_JSON_FAULT} > 2
)"""
)
JSON_SNAPSHOT_DELTA = f"""
SELECT *, NULL::VARCHAR AS reason, NULL::BIGINT AS src_offset FROM ({_metric_rows(_JSON_CPU, host=_JSON_HOST)})
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       ['out_of_range', 'missing_field', 'bad_json'][{_JSON_FAULT} + 1], user_id
FROM (SELECT DISTINCT user_id, CAST(epoch_ms(date_trunc('day', ts)) AS BIGINT) AS ts_ms FROM events) WHERE {_JSON_FAULT} <= 2
"""

# Damaged frames: see queries.damaged_frames.
_DAMAGE = "(ts_ms // 86400000 + user_id) % 11"
_DAMAGE_REASON = f"""CASE WHEN {_DAMAGE} < 4 THEN 'decode_error' WHEN {_DAMAGE} = 4 THEN 'unknown_schema'
         WHEN {_DAMAGE} = 5 THEN 'ambiguous_schema' WHEN {_DAMAGE} = 6 THEN 'short_frame' WHEN {_DAMAGE} = 7 THEN 'bad_magic' END"""
DECODE_ERRORS = f"""
WITH {_DAILY},
{_CUMULATIVE},
whole AS (SELECT user_id, ts_ms, count(*) AS n, sum(c_user + c_guest_nice) AS busy, {_DAMAGE_REASON} AS reason FROM cpu GROUP BY user_id, ts_ms)
SELECT (ts_ms // 86400000)::INT AS src_partition, user_id AS src_offset, reason, CASE WHEN reason IS NULL THEN ts_ms END AS timestamp,
       CASE WHEN reason IS NULL THEN n::BIGINT END AS n_cpus, CASE WHEN reason IS NULL THEN busy::BIGINT END AS busy
FROM whole
"""
_WHOLE_CPU = _CUMULATIVE.replace("cpu AS (", "all_cpu AS (", 1) + f", cpu AS (SELECT * FROM all_cpu WHERE {_DAMAGE_REASON} IS NULL)"
WIRE_SPLIT_DELTA = f"""
SELECT *, NULL::VARCHAR AS reason, NULL::BIGINT AS src_offset FROM ({_metric_rows(_WHOLE_CPU)})
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, {_DAMAGE_REASON}, user_id
FROM (SELECT DISTINCT user_id, CAST(epoch_ms(date_trunc('day', ts)) AS BIGINT) AS ts_ms FROM events) WHERE {_DAMAGE_REASON} IS NOT NULL
"""

SNAPSHOT_TIME_DELTA = f"""
WITH {_DAILY},
{_RESET},
snaps AS (SELECT DISTINCT user_id, ts_ms FROM cpu),
prev AS (
  SELECT user_id, ts_ms,
         lag(ts_ms) OVER (PARTITION BY user_id ORDER BY ts_ms) AS prev_ts
  FROM snaps
),
kept AS (
  SELECT c.user_id, c.ts_ms,
         CAST(count(*) FILTER (WHERE
           (c.c_user - p.c_user) + (c.c_nice - p.c_nice) + (c.c_system - p.c_system)
           + (c.c_idle - p.c_idle) + (c.c_iowait - p.c_iowait) + (c.c_irq - p.c_irq)
           + (c.c_softirq - p.c_softirq) + (c.c_steal - p.c_steal) > 0) AS BIGINT) AS n
  FROM prev s
  JOIN cpu c ON c.user_id = s.user_id AND c.ts_ms = s.ts_ms
  JOIN cpu p ON p.user_id = s.user_id AND p.ts_ms = s.prev_ts AND p.id = c.id
  GROUP BY 1, 2
)
SELECT 'host-' || CAST(s.user_id AS VARCHAR) AS hostname,
       s.ts_ms AS timestamp,
       s.ts_ms - s.prev_ts AS time_delta_ms,
       CAST(coalesce(k.n, 0) AS BIGINT) AS n_cpus
FROM prev s LEFT JOIN kept k ON k.user_id = s.user_id AND k.ts_ms = s.ts_ms
WHERE s.prev_ts IS NOT NULL
"""


JSON_FIELDS = """
SELECT event_id,
       CAST(json_extract(props, '$.k') AS BIGINT) AS k_strict,
       CAST(json_extract(props, '$.k') AS BIGINT) AS k_lenient
FROM events
"""

HOUR_BUCKET = """
SELECT event_id,
       CAST(epoch_us(ts) // 1000 AS BIGINT) AS ts_ms,
       strftime(ts, '%Y-%m-%d--%H') AS bucket
FROM events
"""

ARCHIVE_ROUND_TRIP = f"""
SELECT *, strftime(make_timestamp(timestamp * 1000), '%Y-%m-%d--%H') AS bucket
FROM ({COUNTER_DELTA})
"""

# The JSON between the jobs has no host.
JOB_CHAIN = f"SELECT * EXCLUDE (hostname) FROM ({ARCHIVE_ROUND_TRIP})"


_FRAME_REASON = """CASE WHEN event_type = 'signup' THEN 'short_frame'
            WHEN event_type = 'error' THEN 'bad_magic' END"""

FRAME_PARSE = f"""
SELECT event_id,
       {_FRAME_REASON} AS reason,
       CASE WHEN {_FRAME_REASON} IS NULL THEN CAST(user_id AS INTEGER) END AS schema_id,
       CASE WHEN {_FRAME_REASON} IS NULL THEN CAST(octet_length(encode(props)) AS BIGINT) END AS payload_len
FROM events
"""

SCHEMA_LOOKUP = f"""
SELECT event_id, reason, schema_id,
       CASE WHEN reason IS NULL THEN 'ProcStatSnapshot' END AS schema_name
FROM (
  SELECT event_id,
         coalesce({_FRAME_REASON},
                  CASE WHEN substr(md5(CAST(user_id AS VARCHAR)), 1, 1) IN ('0', '1') THEN 'unknown_schema' END) AS reason,
         CASE WHEN {_FRAME_REASON} IS NULL THEN CAST(user_id AS INTEGER) END AS schema_id
  FROM events
)
"""

# Messages without a schema stay parked.
LATE_SCHEMAS = f"""
SELECT * FROM ({SCHEMA_LOOKUP}) WHERE reason IS DISTINCT FROM 'unknown_schema'
"""

ARCHIVE_QUARANTINE = """
SELECT event_id, CASE event_type WHEN 'error' THEN 'bad_json' WHEN 'signup' THEN 'missing_field' END AS reason
FROM events
"""

WIRE_QUARANTINE = """
SELECT event_id, CASE event_type WHEN 'error' THEN 'bad_magic' WHEN 'signup' THEN 'short_frame' END AS reason
FROM events
"""

AVRO_ROUND_TRIP = f"""
WITH {_DAILY},
{_CUMULATIVE}
SELECT user_id AS src_offset, ts_ms AS timestamp,
       CAST(sum(c_system) OVER (PARTITION BY user_id, ts_ms) AS BIGINT) AS ctxt,
       CAST(count(*) OVER (PARTITION BY user_id, ts_ms) + 1 AS BIGINT) AS n_intr,
       id, c_user AS "user", c_nice AS nice, c_system AS system, c_idle AS idle,
       c_iowait AS iowait, c_irq AS irq, c_softirq AS softirq, c_steal AS steal,
       c_guest AS guest, c_guest_nice AS guest_nice
FROM cpu
"""


PROCSTAT_PARSE = f"""
SELECT 'host-' || CAST(src_offset AS VARCHAR) AS hostname,
       * EXCLUDE (src_offset, id),
       'cpu' || CAST(row_number() OVER (PARTITION BY src_offset, timestamp ORDER BY id) - 1 AS VARCHAR) AS id
FROM ({AVRO_ROUND_TRIP})
"""


# Damage of a dump, by day and user: see queries.damaged_dumps.
DUMP_LOG = f"""
WITH {_DAILY},
{_CUMULATIVE},
dumps AS (
  SELECT user_id, ts_ms, (ts_ms // 86400000 + user_id) % 7 AS k, count(*) AS n, sum(c_user) AS total_user,
         sum(c_softirq) AS softirq, sum(c_system) AS ctxt, min_by(c_user, id) AS first_user
  FROM cpu GROUP BY user_id, ts_ms
)
SELECT 'host-' || CAST(user_id AS VARCHAR) AS hostname, ts_ms AS timestamp,
       CASE WHEN k IN (0, 1, 5) THEN 'bad_line' END AS reason,
       CAST(CASE k WHEN 0 THEN 2 WHEN 1 THEN n + 3 WHEN 5 THEN n + 9 END AS BIGINT) AS line_no,
       CASE k WHEN 0 THEN 'cpu0 ' || CAST(first_user AS VARCHAR) WHEN 1 THEN 'intr x' WHEN 5 THEN 'softirq 1 z' END AS line,
       CASE WHEN k NOT IN (0, 1, 5) THEN CAST(n + 1 AS BIGINT) END AS n_cpus,
       CASE WHEN k NOT IN (0, 1, 5) THEN CAST(total_user AS BIGINT) END AS total_user,
       CASE WHEN k NOT IN (0, 1, 5) THEN CAST(softirq AS BIGINT) END AS softirq,
       CASE WHEN k NOT IN (0, 1, 5) THEN CAST(ctxt AS BIGINT) END AS ctxt
FROM dumps
"""


ELEVATION_FEET = """
SELECT s_name AS address,
       CASE WHEN s_acctbal >= 0 THEN CAST(floor(s_acctbal * 3.28084::DOUBLE) AS BIGINT) END AS elevation_ft
FROM supplier
"""

_ROUTES = """
routes AS (
  SELECT l_suppkey AS suppkey, c_nationkey AS nationkey,
         CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR) || ' mins' AS duration,
         row_number() OVER (PARTITION BY l_suppkey, c_nationkey
                            ORDER BY o_orderkey, l_linenumber,
                                     CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR) || ' mins') AS rn
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
  WHERE l_discount = 0
),
matrix AS (
  SELECT s.s_name AS address, s.s_acctbal, s.s_nationkey, CAST(n.n_nationkey AS INTEGER) AS pos,
         n.n_name AS name, 'Center of ' || n.n_name AS destination, r.duration
  FROM supplier s CROSS JOIN nation n
  LEFT JOIN routes r ON r.suppkey = s.s_suppkey AND r.nationkey = n.n_nationkey AND r.rn = 1
)"""

TRAVEL_MATRIX = f"""
WITH {_ROUTES}
SELECT address, pos, name, duration FROM matrix
"""

MISSING_ROUTES = f"""
WITH {_ROUTES}
SELECT address, pos, name, destination FROM matrix WHERE duration IS NULL
"""

REPORT_LINES = f"""
WITH {_ROUTES},
results AS (
  SELECT s_name AS address, 0 AS pos,
         'Elevation: ' || CAST(CAST(floor(s_acctbal * 3.28084::DOUBLE) AS BIGINT) AS VARCHAR) AS line
  FROM supplier WHERE s_acctbal >= 0
  UNION ALL
  SELECT address, pos + 1, name || ': ' || duration FROM matrix WHERE duration IS NOT NULL
)
SELECT s_name AS address, 0 AS line_no, s_name AS line FROM supplier
UNION ALL SELECT s_name, 1, '' FROM supplier
UNION ALL SELECT s_name, 2, '*** nation ' || CAST(s_nationkey AS VARCHAR) || ' ***' FROM supplier
UNION ALL SELECT s_name, 3, '' FROM supplier
UNION ALL
SELECT address, CAST(3 + row_number() OVER (PARTITION BY address ORDER BY pos) AS INTEGER), line FROM results
"""

SLUG = r"""
SELECT p_partkey,
       regexp_replace(p_name, '\W+', '_', 'g') AS slug,
       'locations/' || regexp_replace(p_name, '\W+', '_', 'g') || '.txt' AS file_name
FROM part
"""

DEPARTURE_EPOCH = """
SELECT o_orderkey, CAST(epoch(CAST(o_orderdate AS DATE) + 1) AS BIGINT) AS departure_epoch
FROM orders
"""


ARRAY_OPS = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1000.0) AS BIGINT)) AS a
  FROM embeddings
)
SELECT vec_id,
       array_to_string(a[1:2], ',') AS head2,
       array_to_string(a[2:3], ',') AS mid2,
       array_to_string(list_append(a[1:2], 4::BIGINT), ',') AS appended,
       array_to_string(list_prepend(0::BIGINT, a[2:3]), ',') AS prepended,
       array_to_string(list_concat(a[1:2], [999::BIGINT]), ',') AS replaced,
       CAST(len(a) AS BIGINT) AS n,
       a[len(a)] AS last_v,
       a[6] AS at5,
       CAST(NULL AS BIGINT) AS at_oob,
       CAST(NULL AS VARCHAR) AS slice_oob
FROM v
"""

PEEK = """
SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 5
"""


def oracle_sql() -> dict[str, str]:
    return {
        "counter_delta": COUNTER_DELTA,
        "counter_delta_reset": COUNTER_DELTA_RESET,
        "snapshot_time_delta": SNAPSHOT_TIME_DELTA,
        "default_key": DEFAULT_KEY,
        "metrics_round_trip": COUNTER_DELTA,
        "json_fields": JSON_FIELDS,
        "hour_bucket": HOUR_BUCKET,
        "stream_delta": COUNTER_DELTA,
        "stream_delta_batchwise": COUNTER_DELTA,
        "hot_stream_delta": HOT_STREAM_DELTA,
        "archive_round_trip": ARCHIVE_ROUND_TRIP,
        "job_chain": JOB_CHAIN,
        "frame_parse": FRAME_PARSE,
        "schema_lookup": SCHEMA_LOOKUP,
        "schema_lookup_table_ids": SCHEMA_LOOKUP,
        "late_schemas": LATE_SCHEMAS,
        "avro_round_trip": AVRO_ROUND_TRIP,
        "procstat_parse": PROCSTAT_PARSE,
        "dump_log": DUMP_LOG,
        "elevation_feet": ELEVATION_FEET,
        "travel_matrix": TRAVEL_MATRIX,
        "missing_routes": MISSING_ROUTES,
        "report_lines": REPORT_LINES,
        "slug": SLUG,
        "departure_epoch": DEPARTURE_EPOCH,
        "array_ops": ARRAY_OPS,
        "peek": PEEK,
        "wire_delta": ALL_UNKNOWN,
        "wire_stream_delta": ALL_UNKNOWN,
        "decode_errors": DECODE_ERRORS,
        "wire_split_delta": WIRE_SPLIT_DELTA,
        "json_snapshot_delta": JSON_SNAPSHOT_DELTA,
        "json_snapshot_stream": JSON_SNAPSHOT_DELTA,
        "archive_quarantine": ARCHIVE_QUARANTINE,
        "wire_quarantine": WIRE_QUARANTINE,
    }
