"""Operator 7: token counts from pre-token frequencies.

The library splits a text into pre-tokens and merges inside each one, so a
text's token count is the sum over its distinct pre-tokens of frequency times
pieces. The pieces of each distinct pre-token are counted once, in a table;
that table is joined to the per-document frequencies and summed. No ids are
kept.

The join has two halves with one result. The pre-tokens most frequent in a
hash-chosen set of about ``FIT_DOCS`` documents, at most ``HOT`` of them (a
bounded table, broadcast), are looked up where the text is split. Every other
(document, pre-token, frequency) goes through a shuffle join with the piece
table. Which pre-tokens are hot changes the cost only, never a count.

Defined results: a null or empty text has no byte and no token. Special
strings inside texts count as the library's default counts them: one token.
Rows that repeat an id, or have none, are counted one by one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statflow.llm.common import most_frequent, stage, text_id
from statflow.llm.encode import load

LIMIT = 1024
HOT = 1 << 16
FIT_DOCS = 1 << 14

#: Fixed value: the published split pattern of this byte-level vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_SPLITTERS: dict[str, object] = {}


def _library_split(tok, text: str) -> list[str]:
    return [text[a:b] for _, (a, b) in tok.pre_tokenizer.pre_tokenize_str(text)]


def splitter(path: str):
    """A function from a text to its pre-tokens and the number of special strings in it.

    ``regex`` and the library may follow different versions of Unicode. Characters
    on which they differ are found when a worker starts, and texts that hold one,
    or any character beyond the first plane, are split by the library itself.
    """
    if path in _SPLITTERS:
        return _SPLITTERS[path]
    import regex

    tok = load(path)
    find = regex.compile(SPLIT).findall
    plane = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    step = 4096
    odd = []
    for i in range(0, len(plane), step):
        part = plane[i : i + step]
        text = "".join(f"a{c} {c}b x{c} 1 " for c in part)
        if find(text) != _library_split(tok, text):
            odd += [c for c in part if find(x := f"a{c} {c}b x{c} 1 ") != _library_split(tok, x)]
    unsure = re.compile("[\U00010000-\U0010ffff" + "".join(map(re.escape, odd)) + "]").search
    special = [t.content for t in tok.get_added_tokens_decoder().values() if t.special]
    cut = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))).split if special else None

    def pre_tokens(text: str) -> tuple[list[str], int]:
        parts = cut(text) if cut and any(s in text for s in special) else [text]
        out: list[str] = []
        for p in parts:
            out += _library_split(tok, p) if unsure(p) else find(p)
        return out, len(parts) - 1

    _SPLITTERS[path] = pre_tokens
    return pre_tokens


def piece_counts(tokens: DataFrame, tokenizer: str) -> DataFrame:
    """(pretoken, pieces) of a one-column table of distinct pre-tokens."""

    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load(tokenizer)
        for frame in frames:
            pieces = [len(model.encode(t, add_special_tokens=False).ids) for t in frame["pretoken"]]
            yield frame.assign(pieces=pieces)

    return tokens.mapInPandas(of, "pretoken string, pieces long")


def _frequencies(tokenizer: str):
    """Rows (pretoken, n) of the texts of a partition, added up in steps of bounded size."""

    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split, seen = splitter(tokenizer), Counter()
        for frame in frames:
            for text in frame["text"]:
                if text:
                    seen.update(split(text)[0])
                if len(seen) > 200_000:
                    yield pd.DataFrame(list(seen.items()), columns=["pretoken", "n"])
                    seen.clear()
        yield pd.DataFrame(list(seen.items()), columns=["pretoken", "n"])

    return of


def _count(tokenizer: str, hot):
    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split, known = splitter(tokenizer), hot.value
        for frame in frames:
            sums, cold, n_bytes = [], [], []
            for text in frame["text"]:
                text = text or ""
                tokens, total = split(text)
                rest = []
                for t, n in Counter(tokens).items():
                    pieces = known.get(t)
                    if pieces is None:
                        rest.append({"pretoken": t, "n": n})
                    else:
                        total += n * pieces
                sums.append(total)
                cold.append(rest)
                n_bytes.append(len(text.encode("utf-8", "surrogatepass")))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "n_bytes": n_bytes, "n_hot": sums, "cold": cold})

    return of


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_counts(
    docs: DataFrame,
    tokenizer: str | None = None,
    limit: int = LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
    hot: int = HOT,
    fit_docs: int = FIT_DOCS,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per row of ``docs``."""
    tokenizer = tokenizer or default_tokenizer()
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = slim.schema["doc_id"].dataType.simpleString()
    share = fit_docs / max(1, slim.count())
    chosen = slim.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(min(1.0, share) * (1 << 20)))
    fit = (
        chosen.select("text")
        .mapInPandas(_frequencies(tokenizer), "pretoken string, n long")
        .groupBy("pretoken")
        .agg(F.sum("n").alias("n"))
    )
    frequent = most_frequent(stage(fit, "pre-tokens"), "n", hot).select("pretoken")
    table = spark.sparkContext.broadcast(
        {r["pretoken"]: r["pieces"] for r in piece_counts(frequent.repartition(8), tokenizer).collect()}
    )
    named = text_id(slim, "doc_id")
    counted = named.mapInPandas(
        _count(tokenizer, table),
        f"doc_id {named.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_hot long, cold array<struct<pretoken:string,n:long>>",
    ).withColumn("doc_id", F.col("doc_id").cast(id_type))
    base = stage(counted.withColumn("row", F.monotonically_increasing_id()), "token-counts")
    cold = base.select("row", F.explode("cold").alias("c")).select("row", "c.pretoken", "c.n")
    pieces = piece_counts(cold.select("pretoken").distinct(), tokenizer)
    sums = cold.join(pieces, "pretoken").groupBy("row").agg(F.sum(F.col("n") * F.col("pieces")).alias("n_cold"))
    total = F.col("n_hot") + F.coalesce(F.col("n_cold"), F.lit(0))
    return (
        base.select("row", "doc_id", "n_bytes", "n_hot")
        .join(sums, "row", "left")
        .select("doc_id", "n_bytes", total.alias("n_tokens"), (total > limit).alias("over_limit"))
    )
