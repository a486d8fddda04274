"""Operator 1: exact top-k search with a bit-sliced index.

Index: the quantised vectors of a block of rows are stored as bitmaps, one per
attribute and bit (two's complement). Search: for each query the slices of all
attributes are added up with bitmap arithmetic, carry-save, every slice shifted
by the bits of the query's component, which gives the slices of an approximate
score. Rows are selected from the most significant slice downward: a row whose
bit is set where others' is not is above them, until k rows are in. The slices
leave out the lowest ``drop_bits`` bits of each attribute, so the approximate
score is off by a bounded amount (Cauchy-Schwarz, per block); the selection
is repeated for the threshold less that bound and the rows in between are
resolved by exact integer products.

Blocks of rows meet chunks of queries by an equi-join on their numbers
(``cogroup``): every query sees every block, once, and returns at most k rows
from it; those few are ranked in Spark. Neither side is broadcast.

Vectors with a component beyond 2**26 after scaling (wide ones) do not go into the
bitmaps. They meet all others in blocks of their own, as queries and as candidates:
floating-point scores with their error bound pick the rows that can be among the k
best, and those are resolved by exact Python integers. Both results are ranked
together.

Defined results: vectors that are null, empty, or hold a null or non-finite
component take no part, as do rows without ``vec_id``. A score that a bigint can't
hold is ranked exactly and returned as null. Every row is a query or a candidate of
its own, also where ids or whole rows repeat: a query leaves out its own row only.
Vectors of another length than the query's are no candidates. Ties go to the
smaller ``vec_id``. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from statflow.llm.common import stage

K = 10
SCALE = 1024
DROP_BITS = 4
BLOCK_ROWS = 16384
CHUNK_QUERIES = 512
LARGEST = 1 << 26
BIGINT = 1 << 63

INDEX = "dim int, block long, n long, ids binary, keys binary, vectors binary, slices binary, n_slices int"
FOUND = "query_row long, query_id long, vec_id long, score long"
#: Scores of wide vectors, as decimal digits.
WIDE_FOUND = "query_row long, query_id long, vec_id long, score string"
RANKED = "query_id long, rank int, vec_id long, score long"


# --- bitmaps --------------------------------------------------------------


def slice_block(vectors: np.ndarray, drop_bits: int) -> np.ndarray:
    """Bitmaps [attribute, bit, word] of the vectors less their lowest bits, two's complement."""
    kept = vectors.T >> drop_bits
    width = max(int(kept.max(initial=0)).bit_length(), int(~kept.min(initial=0)).bit_length()) + 1
    words = -(-vectors.shape[0] // 64)
    out = np.zeros((kept.shape[0], width, words * 8), np.uint8)
    for b in range(width):
        packed = np.packbits((kept >> b & 1).astype(np.uint8), axis=1, bitorder="little")
        out[:, b, : packed.shape[1]] = packed
    return out.view(np.uint64).reshape(kept.shape[0], width, words)


def signed_digits(q: int) -> list[tuple[int, int]]:
    """(place, +1 or -1) of the fewest signed binary digits that make up ``q``."""
    digits, place = [], 0
    while q:
        if q & 1:
            d = 2 - (q & 3)
            digits.append((place, d))
            q -= d
        q >>= 1
        place += 1
    return digits


def add_slices(slices: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Slices of ``query . row`` for every row, two's complement, by carry-save addition.

    Minus a bitmap is its complement plus one, and the sign slice of a number weighs
    minus its place; both leave constants that are added once at the end.
    """
    width = slices.shape[1]
    reach = int(np.abs(query.astype(np.int64)).sum()) << (width - 1)
    top = reach.bit_length() + 2
    columns: list[list[np.ndarray]] = [[] for _ in range(top)]
    constant = 0
    for j, q in enumerate(query.tolist()):
        for place, sign in signed_digits(q):
            for b in range(width):
                bits = slices[j, b]
                weight_sign = -sign if b == width - 1 else sign
                if weight_sign < 0:
                    # -x = (1 - x) - 1 for one bit x
                    bits = ~bits
                    constant -= 1 << (place + b)
                columns[place + b].append(bits)
    ones = np.full(slices.shape[2], ~np.uint64(0))
    constant &= (1 << top) - 1
    for p in range(top):
        if constant >> p & 1:
            columns[p].append(ones)
    out = np.zeros((top, slices.shape[2]), np.uint64)
    for p in range(top):
        now = columns[p]
        while len(now) > 2:
            a, b, c = now.pop(), now.pop(), now.pop()
            ab = a ^ b
            now.insert(0, ab ^ c)
            if p + 1 < top:
                columns[p + 1].append((a & b) | (ab & c))
        if len(now) == 2:
            a, b = now
            out[p] = a ^ b
            if p + 1 < top:
                columns[p + 1].append(a & b)
        elif now:
            out[p] = now[0]
    return out


def count(bits: np.ndarray) -> int:
    return int(np.bitwise_count(bits).sum())


def select_top(slices: np.ndarray, among: np.ndarray, k: int) -> int:
    """The k-th largest number of the rows ``among``, from the most significant slice downward.

    The sign slice counts as set where the number is not negative.
    """
    top = slices.shape[0] - 1
    left, value, tied = k, 0, among
    for p in range(top, -1, -1):
        bits = ~slices[p] if p == top else slices[p]
        ahead = tied & bits
        n = count(ahead)
        if n >= left:
            tied = ahead
            value += 0 if p == top else 1 << p
        else:
            left -= n
            tied = tied & ~bits
            value -= (1 << p) if p == top else 0
    return value


def at_least(slices: np.ndarray, among: np.ndarray, least: int) -> np.ndarray:
    """The rows ``among`` whose number is ``least`` or more, as a bitmap."""
    top = slices.shape[0] - 1
    if least <= -(1 << top):
        return among
    above, tied = np.zeros_like(among), among
    for p in range(top, -1, -1):
        bits = ~slices[p] if p == top else slices[p]
        wanted = (least >= 0) if p == top else bool((least if least >= 0 else least + (1 << top)) >> p & 1)
        if wanted:
            tied = tied & bits
        else:
            above = above | (tied & bits)
            tied = tied & ~bits
    return above | tied


def rows_of(bits: np.ndarray) -> np.ndarray:
    return np.nonzero(np.unpackbits(bits.view(np.uint8), bitorder="little"))[0]


class Block:
    """A block of the index, ready to be searched."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, slices: np.ndarray, drop_bits: int, keys: np.ndarray | None = None):
        self.ids, self.vectors, self.slices, self.drop = ids, vectors, slices, drop_bits
        self.all = np.zeros(slices.shape[2] * 8, np.uint8)
        packed = np.packbits(np.ones(len(ids), np.uint8), bitorder="little")
        self.all[: len(packed)] = packed
        self.all = self.all.view(np.uint64)
        self.at = {int(v): i for i, v in enumerate(ids if keys is None else keys)}
        left_out = vectors & ((1 << drop_bits) - 1)
        self.centre = (1 << drop_bits) / 2
        # The longest vector of what the slices leave out, about its centre.
        self.error = float(np.sqrt(((left_out - self.centre) ** 2).sum(1).max(initial=0.0)))

    def search(self, query_key: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(vec_id, score) of the block's k best candidates but the row of that key, ties to the smaller id."""
        among = self.all
        own = self.at.get(query_key)
        if own is not None:
            among = among.copy()
            among[own >> 6] &= ~np.uint64(1 << (own & 63))
        n = count(among)
        if not n:
            return []
        if n > k:
            score = add_slices(self.slices, query)
            kth = select_top(score, among, k)
            # |exact - (slices + constant)| <= off, so a row this far below the k-th can't be in.
            off = float(np.sqrt((query.astype(np.float64) ** 2).sum())) * self.error
            slack = int(np.ceil(2 * off / (1 << self.drop))) + 1 if off else 0
            among = at_least(score, among, kth - slack)
        rows = rows_of(among)
        exact = self.vectors[rows].astype(np.int64) @ query.astype(np.int64)
        order = np.lexsort((self.ids[rows], -exact))[:k]
        return [(int(self.ids[rows[i]]), int(exact[i])) for i in order]


# --- Spark jobs -----------------------------------------------------------


def _floored(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(row, vec_id, f): the vectors that take part, every component floored to a multiple of 1 / SCALE.

    Doubles of 2**52 and more are whole, so they stay.
    """
    floor = lambda x: F.when(F.abs(x) < F.lit(2.0**52), F.floor(F.lit(float(SCALE)) * x) / F.lit(float(SCALE))).otherwise(x)
    fits = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    usable = F.col(id_col).isNotNull() & (F.size(vec_col) > 0) & F.forall(F.col(vec_col), fits)
    floored = vectors.where(F.coalesce(usable, F.lit(False))).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(F.col(vec_col), lambda x: floor(x.cast("double"))).alias("f"),
    )
    return stage(floored, "topk-rows")  # written once: the rows keep their numbers


def _is_wide(f):
    return F.exists(f, lambda x: F.abs(x) > F.lit(LARGEST / SCALE))


def quantised(floored: DataFrame) -> DataFrame:
    """(row, vec_id, v, dim): the vectors that are not wide, scaled and floored."""
    scaled = F.transform("f", lambda x: (x * F.lit(float(SCALE))).cast("int"))
    return floored.where(~_is_wide("f")).select("row", "vec_id", scaled.alias("v")).withColumn("dim", F.size("v"))


def _unscaled(v):
    return F.transform(v, lambda x: x.cast("double") / F.lit(float(SCALE)))


def _build(drop_bits: int):
    def of(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["vec_id", "row"])
        ids, keys = rows["vec_id"].to_numpy(np.int64), rows["row"].to_numpy(np.int64)
        vectors = np.stack(rows["v"].to_list()).astype(np.int32)
        slices = slice_block(vectors, drop_bits)
        return pd.DataFrame(
            [(int(key[0]), int(key[1]), len(ids), ids.tobytes(), keys.tobytes(), vectors.tobytes(), slices.tobytes(), slices.shape[1])],
            columns=["dim", "block", "n", "ids", "keys", "vectors", "slices", "n_slices"],
        )

    return of


def build_index(rows: DataFrame, blocks: int, drop_bits: int = DROP_BITS) -> DataFrame:
    """One row per block of about equal size: ids, exact integers and bitmaps (``INDEX``)."""
    blocked = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    return blocked.groupBy("dim", "block").applyInPandas(_build(drop_bits), INDEX)


def _search(k: int, drop_bits: int):
    def of(key: tuple, index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        for row in index.itertuples(index=False):
            ids = np.frombuffer(row.ids, np.int64)
            vectors = np.frombuffer(row.vectors, np.int32).reshape(row.n, row.dim)
            slices = np.frombuffer(row.slices, np.uint64).reshape(row.dim, row.n_slices, -1)
            block = Block(ids, vectors, slices, drop_bits, np.frombuffer(row.keys, np.int64))
            for key_, query_id, v in zip(queries["row"], queries["vec_id"], queries["v"]):
                found += [(int(key_), int(query_id), i, s) for i, s in block.search(int(key_), np.asarray(v, np.int64), k)]
        return pd.DataFrame(found, columns=["query_row", "query_id", "vec_id", "score"])

    return of


def _whole(f: np.ndarray) -> list[int]:
    """The scaled components, exactly."""
    return [int(x * SCALE) if abs(x) < 1 << 52 else int(x) * SCALE for x in f.tolist()]


def search_wide(
    ids: np.ndarray, keys: np.ndarray, vectors: np.ndarray, query_key: int, query: np.ndarray, k: int
) -> list[tuple[int, int]]:
    """(vec_id, score) of the k best candidates for floored vectors, wide ones included."""
    keep = keys != query_key
    ids, vectors = ids[keep], vectors[keep]
    if len(ids) > k:
        with np.errstate(over="ignore", invalid="ignore"):
            near = vectors @ query
            off = (np.abs(vectors) @ np.abs(query)) * (4 * (len(query) + 2) * np.finfo(float).eps)
            # A product that doubles can't hold says nothing: its row stays, and sets no threshold.
            low = np.where(np.isfinite(near) & np.isfinite(off), near - off, -np.inf)
            keep = ~np.isfinite(near + off) | (near + off >= np.partition(low, len(low) - k)[len(low) - k])
        ids, vectors = ids[keep], vectors[keep]
    q = _whole(query)
    exact = [(sum(a * b for a, b in zip(_whole(v), q)), int(i)) for i, v in zip(ids, vectors)]
    return [(i, s) for s, i in sorted(exact, key=lambda x: (-x[0], x[1]))[:k]]


def _search_wide(k: int):
    def of(key: tuple, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(queries):
            ids, keys, vectors = rows["vec_id"].to_numpy(np.int64), rows["row"].to_numpy(np.int64), np.stack(rows["f"].to_list())
            for key_, query_id, f in zip(queries["row"], queries["vec_id"], queries["f"]):
                best = search_wide(ids, keys, vectors, int(key_), np.asarray(f), k)
                found += [(int(key_), int(query_id), i, str(s)) for i, s in best]
        return pd.DataFrame(found, columns=["query_row", "query_id", "vec_id", "score"])

    return of


def _meet_wide(rows: DataFrame, queries: DataFrame, blocks: int, chunks: int, k: int) -> DataFrame:
    """The k best of each block of ``rows`` (row, vec_id, f) for every query (``WIDE_FOUND``)."""
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = (
        rows.withColumn("dim", F.size("f"))
        .withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
        .withColumn("chunk", numbers(chunks))
    )
    right = (
        queries.withColumn("dim", F.size("f"))
        .withColumn("chunk", F.pmod(F.xxhash64(F.lit("chunk"), "row"), F.lit(chunks)).cast("int"))
        .withColumn("block", numbers(blocks))
    )
    keys = ("dim", "block", "chunk")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_search_wide(k), WIDE_FOUND)


def _rank_exactly(k: int):
    def of(key: tuple, found: pd.DataFrame) -> pd.DataFrame:
        best = sorted(((-int(s), int(i)) for s, i in zip(found["score"], found["vec_id"])))[:k]
        fits = lambda s: s if -BIGINT <= s < BIGINT else None
        rows = [(int(key[1]), n + 1, i, fits(-s)) for n, (s, i) in enumerate(best)]
        out = pd.DataFrame(rows, columns=["query_id", "rank", "vec_id", "score"], dtype=object)
        return out.astype({"query_id": "int64", "rank": "int32", "vec_id": "int64", "score": "Int64"})

    return of


def top_k(
    vectors: DataFrame,
    is_query,
    k: int = K,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    chunk_queries: int = CHUNK_QUERIES,
    drop_bits: int = DROP_BITS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each row that ``is_query`` selects.

    ``is_query`` is a condition on the column ``vec_id``.
    """
    floored = _floored(vectors, id_col, vec_col)
    rows, wide = quantised(floored), floored.where(_is_wide("f"))
    n_wide = wide.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q")).first()
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q")).first()
    blocks = max(1, -(-sizes["n"] // block_rows))
    chunks = max(1, -(-sizes["q"] // chunk_queries))
    index = build_index(rows, blocks, drop_bits).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    asked = (
        rows.where(is_query)
        .withColumn("chunk", F.pmod(F.xxhash64(F.lit("chunk"), "row"), F.lit(chunks)).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    )
    keys = ("dim", "block", "chunk")
    found = index.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(_search(k, drop_bits), FOUND)
    if n_wide["n"]:
        asks = lambda q: max(1, -(-q // chunk_queries))
        far_blocks = max(1, -(-n_wide["n"] // block_rows))
        small = rows.select("row", "vec_id", _unscaled("v").alias("f"))
        everything = small.unionByName(wide)
        found = (
            found.withColumn("score", F.col("score").cast("string"))
            .unionByName(_meet_wide(wide, small.where(is_query), far_blocks, chunks, k))
            .unionByName(_meet_wide(everything, wide.where(is_query), blocks + far_blocks, asks(n_wide["q"]), k))
        )
        return found.groupBy("query_row", "query_id").applyInPandas(_rank_exactly(k), RANKED)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
