"""Operator 5: quality rules as one native projection.

A threshold table (``RULES``) is compiled into a single Spark projection of
length, symbol, stop-word and line ratios; no user function runs.

Defined results: a null or empty text has no word, so every count is 0, the
base rule fails and the document is rejected. A ratio with a zero denominator
is 0. Repeated rows are judged one by one; a null ``doc_id`` is returned as
it is. Columns of the input that share a name with a result column are
replaced in the report and left alone by the filter.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statflow.llm.common import without, words_of
from statflow.operators.plan_tools import barrier


class Rule(NamedTuple):
    """Keep a document if ``low <= numerator / denominator <= high``."""

    name: str
    numerator: str
    denominator: str | None
    low: float | None
    high: float | None


#: The threshold table: production values.
RULES: tuple[Rule, ...] = (
    Rule("words", "n_words", None, 50, None),
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 14.0),
    Rule("symbols_per_word", "n_symbols", "n_words", None, 0.3),
    Rule("stop_words", "n_stop_words", None, 2, None),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", None, 0.5),
    Rule("bullet_line_ratio", "n_bullet_lines", "n_lines", None, 0.9),
    Rule("ellipsis_line_ratio", "n_ellipsis_lines", "n_lines", None, 0.5),
)

#: Frequent function words of the four languages.
STOP_WORDS: dict[str, tuple[str, ...]] = {
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "on", "was", "be", "with", "as", "by", "this"),
    "de": ("der", "die", "und", "das", "den", "von", "zu", "mit", "sich", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "que", "est", "pour", "qui", "dans", "par", "au"),
    "es": ("el", "los", "las", "y", "por", "con", "del", "se", "no", "su", "para", "es", "al", "lo", "como", "más"),
}

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Bits that hold a window's start; a text with more words takes the exact path by words.
START_BITS = 20
LAST_PACKED = (1 << START_BITS) - 1
HAS_WORD = r"[^\x20\x09-\x0D]"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "n_bullet_lines", "n_ellipsis_lines")


def _covered(starts: Column) -> Column:
    """How many words the three-word windows at these ascending starts cover."""
    return F.aggregate(
        starts,
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(F.lit(3), i - s["last"])).alias("n")),
        lambda s: s["n"],
    )


def with_counts(df: DataFrame, text: str, into: str) -> DataFrame:
    """``df`` with a struct column ``into`` holding ``COUNTS`` of the text column."""
    t, w, p, d, lines = (f"{into}_{x}" for x in ("text", "words", "windows", "twice", "lines"))
    stop = sorted({x for words in STOP_WORDS.values() for x in words})
    n, last = F.size(w), F.size(w) - 3
    window_hash = lambda i: F.xxhash64(F.get(F.col(w), i), F.get(F.col(w), i + 1), F.get(F.col(w), i + 2))
    # A window is one long: the upper bits of its hash, then where it starts.
    packed = F.when(
        last.between(0, LAST_PACKED),
        F.sort_array(
            F.transform(
                F.sequence(F.lit(0), last), lambda i: window_hash(i).bitwiseAND(F.lit(~LAST_PACKED)).bitwiseOR(i.cast("long"))
            )
        ),
    ).otherwise(_empty("bigint"))
    # Where in the sorted windows one has the upper bits of the one before it.
    twice = F.when(
        F.size(p) > 1,
        F.filter(
            F.sequence(F.lit(1), F.size(p) - 1),
            lambda k: F.shiftright(F.get(F.col(p), k), START_BITS) == F.shiftright(F.get(F.col(p), k - 1), START_BITS),
        ),
    ).otherwise(_empty("int"))
    return (
        df.withColumn(t, F.coalesce(F.col(text), F.lit("")))
        .withColumns({w: words_of(F.col(t)), lines: F.filter(F.split(F.col(t), "\n"), lambda x: x.rlike(HAS_WORD))})
        .withColumn(p, packed)
        .withColumn(d, twice)
        .withColumn(
            into,
            F.struct(
                n.cast("long").alias("n_words"),
                F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
                (F.octet_length(F.col(t)) - F.octet_length(without(F.col(t), SYMBOLS))).cast("long").alias("n_symbols"),
                (F.size(lines) - F.size(F.array_distinct(F.col(lines)))).cast("long").alias("n_dup_lines"),
                F.when((last <= LAST_PACKED) & (F.size(d) == 0), F.lit(0))
                .when((last <= LAST_PACKED) & F.forall(F.col(d), lambda k: _same_words(w, _start(p, k), _start(p, k - 1))), _covered(_starts(p, d)))
                .otherwise(_covered(_starts_by_words(w)))
                .cast("long")
                .alias("n_repeat_words"),
                F.size(lines).cast("long").alias("n_lines"),
                F.size(F.filter(F.col(w), lambda x: F.lower(x).isin(stop))).cast("long").alias("n_stop_words"),
                F.size(F.filter(F.col(lines), lambda x: F.ltrim(x).rlike("^[-*•]")))
                .cast("long")
                .alias("n_bullet_lines"),
                F.size(F.filter(F.col(lines), lambda x: F.rtrim(x).rlike("(\\.\\.\\.|…)$")))
                .cast("long")
                .alias("n_ellipsis_lines"),
            ),
        )
        .drop(t, w, lines, p, d)
    )


def _empty(kind: str) -> Column:
    return F.expr(f"cast(array() as array<{kind}>)")


def _start(p: str, k: Column) -> Column:
    return F.get(F.col(p), k).bitwiseAND(F.lit(LAST_PACKED)).cast("int")


def _same_words(w: str, a: Column, b: Column) -> Column:
    word = lambda i: F.get(F.col(w), i)
    return (word(a) == word(b)) & (word(a + 1) == word(b + 1)) & (word(a + 2) == word(b + 2))


def _starts(p: str, d: str) -> Column:
    """Starts of the repeated windows, ascending, from the sorted windows and their repeats."""
    both = F.transform(F.col(d), lambda k: F.array(_start(p, k), _start(p, k - 1)))
    return F.sort_array(F.array_distinct(F.flatten(both)))


def _starts_by_words(w: str) -> Column:
    """The same from the words themselves: for texts of a million words, or where
    two different windows share the upper bits of their hashes."""
    word = lambda i: F.get(F.col(w), i)
    ordered = F.array_sort(
        F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(F.concat_ws(" ", word(i), word(i + 1), word(i + 2)).alias("x"), i.alias("i")),
        )
    )
    near = lambda a, q, k: F.coalesce(q["x"] == F.get(a, k)["x"], F.lit(False))
    # aggregate() over a one-element array names the sorted pairs, so that they are sorted once.
    return F.aggregate(
        F.array(ordered),
        _empty("int"),
        lambda _, a: F.sort_array(
            F.transform(F.filter(a, lambda q, k: near(a, q, k - 1) | near(a, q, k + 1)), lambda q: q["i"])
        ),
    )


def verdict(c: Column, rules: Sequence[Rule] = RULES) -> tuple[Column, Column]:
    """(base_failed, kept): the threshold table compiled over a ``COUNTS`` struct."""
    base_failed = (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
    kept = ~base_failed
    for r in rules:
        x = c[r.numerator].cast("double")
        if r.denominator:
            x = F.when(c[r.denominator] > 0, x / c[r.denominator]).otherwise(F.lit(0.0))
        if r.low is not None:
            kept = kept & (x >= F.lit(float(r.low)))
        if r.high is not None:
            kept = kept & (x <= F.lit(float(r.high)))
    return base_failed, kept


def quality_report(df: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, the counts, ``base_failed`` and ``kept``."""
    slim = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    counted = with_counts(slim, "text", "q")
    base_failed, kept = verdict(F.col("q"), rules)
    return counted.select("doc_id", "q.*", base_failed.alias("base_failed"), kept.alias("kept"))


def quality_filter(df: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that the rules keep, with ``df``'s columns."""
    mark = "__quality"
    counted = with_counts(df, text_col, mark)
    # Without the barrier the optimizer would push the filter through every projection
    # and repeat the counting in its condition.
    judged = barrier(counted.withColumn(mark, verdict(F.col(mark), rules)[1]))
    return judged.where(F.col(mark)).drop(mark)
