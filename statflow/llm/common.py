"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statflow.session import scratch_path

#: The white space of the word pattern ``[^\x20\x09-\x0D]+``.
SPACE = " \t\n\x0b\x0c\r"

#: Python splits a block of this many bytes into words at a time.
WORD_BLOCK = 1 << 22


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its rows are computed
    once, and a lost executor costs only the tasks after it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_id(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a whole-number id column as text, for pandas, which reads whole numbers
    beside a null as doubles and so rounds those beyond 2**53. Cast it back after the worker."""
    whole = df.schema[name].dataType.typeName() in ("byte", "short", "integer", "long")
    return df.withColumn(name, F.col(name).cast("string")) if whole else df


def most_frequent(counts: DataFrame, n: str, most: int) -> DataFrame:
    """The rows of ``counts`` with the largest ``n`` (1 or more), at most ``most`` of them.

    A histogram over octaves in 16 steps each, of at most 1,024 rows, gives the
    threshold; no task sends more than the rows that are wanted. A row with the
    threshold's step is in only if its whole step fits.
    """
    step = F.floor(F.log2(F.col(n).cast("double")) * 16).cast("int")
    histogram = sorted((tuple(r) for r in counts.groupBy(step.alias("s")).count().collect()), reverse=True)
    room, least = most, None
    for s, rows in histogram:
        if rows > room:
            break
        room, least = room - rows, s
    return counts.where(step >= least) if least is not None else counts.limit(0)


def words_of(text: Column) -> Column:
    """The words ``[^\x20\x09-\x0D]+`` of a text, in order (null: none)."""
    one_space = F.coalesce(text, F.lit(""))
    for c in SPACE[1:]:  # byte searches, much faster than one translate()
        one_space = F.replace(one_space, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(one_space, " "), "")


def without(text: Column, characters: str) -> Column:
    """The text less every one of these characters."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_blocks(text: str | None) -> Iterator[list[bytes]]:
    """Lists of a text's words, A-Z lower-cased, as UTF-8; a very long text comes
    in several lists, cut between words, so that memory stays bounded.

    ``bytes.lower`` changes A-Z only and ``bytes.split`` splits at exactly ``SPACE``.
    """
    if not text:
        return
    data = text.encode("utf-8", "surrogatepass").lower()
    if len(data) <= WORD_BLOCK:
        yield data.split()
        return
    rest = b""
    for at in range(0, len(data), WORD_BLOCK):
        part = rest + data[at : at + WORD_BLOCK]
        words = part.split()
        rest = b""
        if words and at + WORD_BLOCK < len(data) and not part[-1:].isspace():
            rest = words.pop()
        yield words
    if rest:
        yield [rest]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all the texts as one array, A-Z lower-cased, as UTF-8, and each text's
    number of words (null: none). Arrow's ASCII white space is exactly ``SPACE``."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    words = lists.flatten().cast(pa.binary())
    empty = np.nonzero(pc.equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False))[0]
    if len(empty):  # before a text's first white space and after its last
        words = words.filter(pc.not_equal(pc.binary_length(words), 0))
        lengths -= np.bincount(np.searchsorted(np.cumsum(lengths), empty, side="right"), minlength=len(lengths))
    return words, lengths
