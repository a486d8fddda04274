"""Operator 10: pack token sequences into windows by minimum bin slack.

A document's ids are cut at multiples of the window: whole windows are
sequences of their own, without padding. What remains of each document is
packed: for every window, a subset-sum dynamic programme over the multiset of
remaining lengths (one Python integer as the bitset of reachable sums, counts
folded in by doubling) finds the fill closest to capacity, and walking the
steps back gives how many pieces of each length to take. The largest remaining
piece opens each window, so every round places at least one piece.

Remainders are dealt over blocks of about ``BLOCK_PIECES`` by a hash, so the
number of blocks follows the input and each block wastes at most its last
windows. Only (length, digest) rows move; token ids never leave the task that
made them.

Defined results: a null or empty text is one id (the closing id). Repeated rows
and repeated or null ids are documents of their own. An empty table gives no
piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statflow.llm.common import stage, text_id
from statflow.llm.encode import chunk_encoder

WINDOW = 4096
CLOSING_ID = 2
BLOCK_PIECES = 8192

PIECE = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, part long, seq long"
PLACED = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def fill_window(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths (length -> how many) whose sum comes closest to
    ``capacity`` from below, out of ``counts``. Exact."""
    full = 1 << capacity
    mask = (full << 1) - 1
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        left = min(counts[length], capacity // length) if length <= capacity else 0
        times = 1
        while left > 0:
            take = min(times, left)
            grown = (reach | (reach << (length * take))) & mask
            if grown != reach:
                steps.append((length, take, reach))
                reach = grown
            left -= take
            times *= 2
        if reach & full:
            break
    total = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


def pack_lengths(lengths: list[int], capacity: int) -> list[list[int]]:
    """Windows as lists of positions in ``lengths`` (each length below or at capacity)."""
    at: dict[int, list[int]] = {}
    for i, n in enumerate(lengths):
        at.setdefault(n, []).append(i)
    counts = {n: len(v) for n, v in at.items()}

    def take(n: int) -> int:
        counts[n] -= 1
        if not counts[n]:
            del counts[n]
        return at[n].pop()

    windows = []
    largest = sorted(counts)
    while counts:
        while largest[-1] not in counts:
            largest.pop()
        window = [take(largest[-1])]
        rest = capacity - largest[-1]
        if rest and counts:
            for n, times in fill_window(counts, rest).items():
                window += [take(n) for _ in range(times)]
        windows.append(window)
    return windows


def _pieces(window: int, tokenizer: str, closing: int):
    end = int(closing).to_bytes(4, "little")

    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = chunk_encoder(tokenizer)
        part, seq = TaskContext.get().partitionId(), 0
        for frame in frames:
            rows = []
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                ids = encode(text) + end
                n = len(ids) // 4
                for start in range(0, n, window):
                    piece = ids[4 * start : 4 * (start + window)]
                    rows.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), n, part, seq))
                    seq += 1
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "seq"])
            out["doc_id"] = out["doc_id"].astype(frame["doc_id"].dtype)
            yield out

    return of


def _pack_block(window: int):
    def of(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["length", "part", "seq"], ignore_index=True)
        lengths = block["length"].tolist()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for k, members in enumerate(pack_lengths(lengths, window)):
            used = 0
            for i in members:
                sequence[i], offset[i] = k, used
                used += lengths[i]
        # Packed windows are numbered above all whole windows.
        block["sequence_id"] = (1 << 62) + (int(key[0]) << 32) + sequence
        block["offset"] = offset
        return block[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]

    return of


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack_documents(
    docs: DataFrame,
    tokenizer: str | None = None,
    window: int = WINDOW,
    closing_id: int = CLOSING_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_pieces: int = BLOCK_PIECES,
) -> DataFrame:
    """One row per piece: where its ids lie in the document and in its sequence."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = slim.schema["doc_id"].dataType.simpleString()
    slim = text_id(slim, "doc_id")
    text_type = slim.schema["doc_id"].dataType.simpleString()
    cut = slim.mapInPandas(
        _pieces(window, tokenizer or default_tokenizer(), closing_id), PIECE.format(id=text_type)
    )
    pieces = stage(cut.withColumn("doc_id", F.col("doc_id").cast(id_type)), "pieces")
    whole = pieces.where(F.col("length") == window).select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.shiftleft(F.col("part"), 36) + F.col("seq")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    rest = pieces.where(F.col("length") < window)
    blocks = max(1, -(-rest.count() // block_pieces))
    packed = (
        text_id(rest, "doc_id")
        .withColumn("block", F.pmod(F.xxhash64("part", "seq"), F.lit(blocks)))
        .groupBy("block")
        .applyInPandas(_pack_block(window), PLACED.format(id=text_type))
        .withColumn("doc_id", F.col("doc_id").cast(id_type))
    )
    return whole.unionByName(packed)
