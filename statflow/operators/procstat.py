"""``/proc/stat`` text dumps → typed snapshots.

A dump is one row ``(hostname, timestamp, text)``. It is parsed in place
with higher-order array functions over its lines: no explode, no shuffle,
whole-stage codegen. Rules:

* lines split on whitespace; blank lines are skipped (the reference fails
  on them);
* ``cpu`` and ``cpu<digits>`` lines become CPU entries in line order; other
  ``cpu…`` lines (``cpuidle``) are ignored;
* ``intr`` and ``softirq`` lines become long arrays of all their numbers
  (for ``intr`` element 0 is the total); ``ctxt``, ``btime``,
  ``processes``, ``procs_running``, ``procs_blocked`` take their first
  number; a repeated line overrides an earlier one;
* missing parts default to 0 and ``[]``;
* a short CPU line or a non-integer token makes the dump bad:
  ``reason = 'bad_line'`` (the reference raises).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statflow.operators.plan_tools import barrier
from statflow.schemas import CPU_COUNTERS, SCALAR_FIELDS

CPU_LINE = r"^cpu[0-9]*$"


def _tokens(text: Column) -> Column:
    # One regex pass turns every run of blanks into one space; the splits are
    # then on single characters (no regex engine per line).
    norm = F.regexp_replace(text, r"[ \t\r\f\x0B]+", " ")
    toks = F.transform(F.split(norm, "\n"), lambda ln: F.array_remove(F.split(ln, " "), ""))
    return F.filter(toks, lambda t: F.size(t) > 0)


def _longs(strs: Column) -> Column:
    return F.transform(strs, lambda x: x.try_cast("long"))


_NAMED = ("intr", "softirq") + SCALAR_FIELDS


def parse_dumps(dumps: DataFrame) -> DataFrame:
    """``hostname, timestamp, text`` (+ any other columns, kept) → snapshot
    columns plus ``reason`` (null when the dump parsed cleanly).

    Two passes over a dump's lines: one filter for the CPU lines, one fold
    that keeps the last line of each named kind."""
    toks = F.col("__toks")
    cpu_lines = F.filter(toks, lambda t: F.get(t, 0).rlike(CPU_LINE))
    none = F.lit(None).cast("array<string>")
    init = F.struct(*[none.alias(n) for n in _NAMED])

    def step(acc: Column, t: Column) -> Column:
        head = F.get(t, 0)
        return F.struct(*[F.when(head == n, t).otherwise(acc[n]).alias(n) for n in _NAMED])

    last = F.col("__last")

    def cpu_struct(t: Column) -> Column:
        fields = [F.get(t, 0).alias("id")]
        fields += [F.get(t, i + 1).try_cast("long").alias(c) for i, c in enumerate(CPU_COUNTERS)]
        return F.struct(*fields)

    def numbers(name: str) -> Column:
        line = last[name]
        return F.coalesce(_longs(F.slice(line, 2, F.greatest(F.size(line) - 1, F.lit(0)))),
                          F.array().cast("array<bigint>"))

    def scalar(name: str) -> Column:
        return F.coalesce(F.get(last[name], 1).try_cast("long"), F.lit(0).cast("long"))

    bad_cpu = F.exists(
        F.col("cpus"),
        lambda c: F.greatest(*[c[n].isNull().cast("int") for n in CPU_COUNTERS]) == 1,
    )
    bad = bad_cpu | F.exists("intr", lambda x: x.isNull()) | F.exists("softirq", lambda x: x.isNull())
    for s_ in SCALAR_FIELDS:
        bad = bad | (last[s_].isNotNull() & F.get(last[s_], 1).try_cast("long").isNull())

    others = [c for c in dumps.columns if c not in ("hostname", "timestamp", "text")]
    # Barriers: the tokens feed two expressions, and a filter on ``reason``
    # must not drag the whole parse into the filter condition.
    parsed = (
        barrier(dumps.withColumn("__toks", _tokens(F.col("text"))))
        .select(
            "hostname",
            "timestamp",
            "text",
            *others,
            F.transform(cpu_lines, cpu_struct).alias("cpus"),
            F.aggregate(toks, init, step).alias("__last"),
        )
        .select(
            "hostname", "timestamp", "text", *others, "cpus", "__last",
            numbers("intr").alias("intr"),
            numbers("softirq").alias("softirq"),
        )
    )
    return barrier(parsed).select(
        "hostname",
        "timestamp",
        "cpus",
        "intr",
        "softirq",
        *[scalar(s_).alias(s_) for s_ in SCALAR_FIELDS],
        *others,
        F.when(F.col("text").isNull(), F.lit("null_text")).when(bad, F.lit("bad_line")).alias("reason"),
    )


def find_bad_line(bad: DataFrame, text: str = "text") -> DataFrame:
    """Dumps that ``parse_dumps`` set aside, with their ``text`` → the same rows
    with ``line_no`` (from 1, blank lines counted) and ``line``: the first line that
    made the dump bad, null for a dump without text. A named line that a later one
    of its kind overrides makes nothing bad. Costs are paid for bad dumps only."""
    lines = F.transform(
        F.split(text, "\n"),
        lambda ln, i: F.struct(
            (i + 1).cast("long").alias("line_no"),
            ln.alias("line"),
            F.array_remove(F.split(F.regexp_replace(ln, r"[ \t\r\f\x0B]+", " "), " "), "").alias("t"),
        ),
    )
    numbered = barrier(bad.withColumn("__lines", lines))

    def not_long(token: Column) -> Column:
        return token.isNull() | token.try_cast("long").isNull()

    def wrong(x: Column) -> Column:
        head, t = F.get(x["t"], 0), x["t"]
        short = reduce(lambda a, b: a | b, [not_long(F.get(t, i + 1)) for i in range(len(CPU_COUNTERS))])
        rest = F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0)))
        listed = head.isin("intr", "softirq") & F.exists(rest, not_long)
        scalar = head.isin(*SCALAR_FIELDS) & not_long(F.get(t, 1))
        last = ~F.exists("__lines", lambda y: (y["line_no"] > x["line_no"]) & (F.get(y["t"], 0) == head))
        return (head.rlike(CPU_LINE) & short) | ((listed | scalar) & last)

    first = F.get(F.filter("__lines", lambda x: F.coalesce(wrong(x), F.lit(False))), 0)
    return numbered.withColumns({"line_no": first["line_no"], "line": first["line"]}).drop("__lines")


#: Between the captures of a log. No line of a dump looks like it.
CAPTURE_END = "\n----\n"


def write_dump_log(dumps: DataFrame, path: str) -> None:
    """``hostname, timestamp, text`` → log files, many captures in each: a line with
    host and time, then the dump. Far fewer files than one a capture, and they split."""
    head = F.concat_ws("\t", F.coalesce("hostname", F.lit("")), F.col("timestamp").cast("string"))
    capture = F.concat_ws("\n", head, F.col("text"))
    dumps.select(capture.alias("value")).write.option("lineSep", CAPTURE_END).text(path)


def read_dump_log(spark, path: str) -> DataFrame:
    """Log files → ``hostname, timestamp, text`` (S5, P8). An empty host is null; a
    capture without a readable time has a null timestamp, one without a dump a null text."""
    capture = spark.read.option("lineSep", CAPTURE_END).text(path)
    head = F.substring_index("value", "\n", 1)
    host = F.substring_index(head, "\t", 1)
    text = F.substring(F.col("value"), F.length(head) + 2, F.length("value"))
    return capture.select(
        F.when(host != "", host).alias("hostname"),
        F.when(F.contains(head, F.lit("\t")), F.substring_index(head, "\t", -1)).try_cast("long").alias("timestamp"),
        F.when(F.length(head) < F.length("value"), text).alias("text"),
    )


def render_dump(snapshot_cols: dict[str, Column] | None = None) -> Column:
    """Snapshot columns → ``/proc/stat``-style text (the inverse of
    ``parse_dumps``), e.g. to replay stored snapshots through the parser."""
    c = snapshot_cols or {}
    col = lambda n: c.get(n, F.col(n))
    cpu_lines = F.transform(
        col("cpus"),
        lambda x: F.concat_ws(" ", x["id"], *[x[n].cast("string") for n in CPU_COUNTERS]),
    )
    arr_line = lambda name: F.concat_ws(" ", F.lit(name), F.array_join(col(name).cast("array<string>"), " "))
    lines = [F.array_join(cpu_lines, "\n"), arr_line("intr")]
    lines += [F.concat_ws(" ", F.lit(s), col(s).cast("string")) for s in ("ctxt", "btime", "processes",
                                                                          "procs_running", "procs_blocked")]
    lines.append(arr_line("softirq"))
    return F.concat_ws("\n", *lines)


def read_dump_files(spark, path: str, name_pattern: str = r"^(.+)_(\d+)(?:\.[^.]*)?$") -> DataFrame:
    """Collected dump files (one file per capture) → ``hostname, timestamp,
    text``. Host and capture time (epoch ms) come from the file name, e.g.
    ``web01_1700000000000.txt``; without a time in the name the file's
    modification time is used (P8)."""
    raw = spark.read.text(path, wholetext=True).select(
        F.col("value").alias("text"),
        F.col("_metadata.file_name").alias("__name"),
        F.col("_metadata.file_modification_time").alias("__mtime"),
    )
    host = F.regexp_extract("__name", name_pattern, 1)
    ts = F.regexp_extract("__name", name_pattern, 2)
    return raw.select(
        F.when(host != "", host).alias("hostname"),
        F.coalesce(F.when(ts != "", ts).try_cast("long"), F.unix_millis("__mtime")).alias("timestamp"),
        "text",
    )
