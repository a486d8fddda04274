"""Operator 6: drop lines that many documents share.

Lines are exploded in normalised form, hashed (128 bits), and the distinct
documents of each hash counted; lines over the threshold go from every
document but the one with the largest id, and each text is put together
again by line position. Only (id, hash, position) is shuffled for the
counting, aggregated before each shuffle; the lines found most often are looked up
in a broadcast table of bounded size. The texts move once, to meet their own
list of dropped positions.

Defined results: a null or empty text is one empty line and becomes the empty
text. Rows with a null ``doc_id`` count as no document: they lose every line
over the threshold. Rows that repeat a ``doc_id`` count as one document. Extra
columns pass through the filter unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statflow.llm.common import SPACE, ascii_lower, stage

MIN_CHARS = 20
MIN_DOCS = 3
HOT_LINES = 1024


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """A line with the white space of both ends stripped and A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def _line_hashes(min_chars: int):
    def of(line: Column) -> Column:
        key = line_key(line)
        return F.when(F.char_length(key) >= min_chars, F.unhex(F.md5(key)))

    return of


def dropped_positions(df: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int) -> DataFrame:
    """(id, md5 of the text, positions): the 0-based lines each text loses."""
    slim = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lines = slim.select(
        "id",
        F.unhex(F.md5("text")).alias("text_md5"),
        F.posexplode(F.transform(split_lines(F.col("text")), _line_hashes(min_chars))).alias("pos", "h"),
    ).where(F.col("h").isNotNull())
    lines = stage(lines, "line-hashes")  # texts are split and hashed once
    shared = (
        lines.groupBy("h")
        .agg(F.count_distinct("id").alias("docs"), F.max("id").alias("keeper"), F.count(F.lit(1)).alias("n"))
        .where(F.col("docs") >= min_docs)
    )
    shared = stage(shared, "line-shared")
    # The lines in the most places go by a broadcast table of ``HOT_LINES`` rows; any other
    # line is in less than 1 / HOT_LINES of all places, so no task of the join gets a hot one.
    hot = F.broadcast(shared.orderBy(F.desc("n"), "h").limit(HOT_LINES).select("h", F.col("keeper").alias("hot"), F.lit(True).alias("is_hot")))
    marked = lines.join(hot, "h", "left")
    light = marked.where(F.col("is_hot").isNull()).drop("hot", "is_hot").join(shared.select("h", "keeper"), "h")
    both = marked.where("is_hot").drop("is_hot").withColumnRenamed("hot", "keeper").unionByName(light)
    lost = both.where(~F.col("id").eqNullSafe(F.col("keeper")))
    return lost.groupBy("id", "text_md5").agg(F.collect_list("pos").alias("positions"))


def line_dedup(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    report: str | None = None,
) -> DataFrame:
    """``df`` with the shared lines cut out of its text column.

    ``report`` names an extra struct column (n_lines, n_dropped).
    """
    lost = dropped_positions(df, id_col, text_col, min_chars, min_docs).select(
        F.col("id").alias("__id"), F.col("text_md5").alias("__md5"), F.col("positions").alias("__lost")
    )
    text = F.coalesce(F.col(text_col), F.lit(""))
    joined = df.withColumn("__text_md5", F.unhex(F.md5(text))).join(
        lost, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__text_md5") == F.col("__md5")), "left"
    )
    lines = joined.withColumn("__lines", split_lines(F.col(text_col)))
    all_positions = F.sequence(F.lit(0), F.size("__lines") - 1)
    kept = lines.withColumn(
        "__kept",
        F.when(F.col("__lost").isNull(), all_positions).otherwise(F.array_except(all_positions, F.col("__lost"))),
    )
    rebuilt = F.array_join(F.transform(F.col("__kept"), lambda p: F.get(F.col("__lines"), p)), "\n")
    extra = []
    if report:
        n = F.size("__lines").cast("long")
        extra = [F.struct(n.alias("n_lines"), (n - F.size("__kept")).alias("n_dropped")).alias(report)]
    columns = [
        F.when(F.col("__lost").isNull(), text).otherwise(rebuilt).alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns
    ]
    return kept.select(*columns, *extra)


def line_dedup_report(df: DataFrame, **kw) -> DataFrame:
    """Per document: how many lines it had and lost, and the digest of what is left."""
    cut = line_dedup(df.select("doc_id", "text"), report="r", **kw)
    return cut.select(
        "doc_id", "r.n_lines", F.col("r.n_dropped").cast("long").alias("n_dropped"), F.sha2(F.col("text"), 256).alias("kept_sha256")
    )
