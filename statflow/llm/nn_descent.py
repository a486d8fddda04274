"""Operator 13: approximate nearest neighbours by NN-descent and greedy graph search.

Equal vectors are one node. Nodes lie in blocks of some ``BLOCK`` rows each, the
subtrees of a tree of random projections with median thresholds; a node's code is
block and position. A block's part of a table is one row of packed arrays, and
every exchange below is a Spark join of such rows on the block.

* Start: in each of ``TREES`` such trees the nodes of a leaf are compared with each other.
* NN-descent: a node's neighbours, and the nodes whose neighbour it is, are likely to be
  near each other. Of its new and its old ones ``SAMPLE`` each are drawn, in both
  directions (reverse edges are sent to the block of their node). A block asks for each
  vector that it needs once, scores neighbours of neighbours, and sends every pair
  that beats the worse end's last neighbour to that end's block, which merges it.
* Search: every query starts at its own node. A round sends the unexpanded nodes of its beam
  to their blocks; a block scores their neighbours (it holds copies of these vectors),
  goes on greedily among its own nodes, and answers with what beats the beam. It ends
  when the beam of every query is expanded. The best are scored again, in double
  precision, on the original vectors.

Graph and search use half precision, with a scale per vector; every row is indexed, and the
sample that lays out the trees is bounded by ``MAX_SAMPLE``. There, components below 1e-18 of
the table's largest one lose their weight; final scores are exact for all. Memory follows the size of
a block, not of the table; what the driver broadcasts is one number per leaf.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take
no part, nor do rows without ``vec_id``. Each row is a candidate of its own, also where
ids or whole rows repeat; a query leaves out its own row only. Vectors of another
length than the query's are no candidates: each length is indexed by itself. Ties go to
the smaller ``vec_id``. Of equal vectors the 21 smallest ids are kept with their node, as
no result can name more. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from statflow.llm.common import stage

K = 20
#: Neighbours of a node in the graph, and drawn neighbours of one kind and direction.
DEGREE, SAMPLE = 32, 16
ROUNDS, LEAST_CHANGE = 2, 0.02
TREES, LEAF, LEAVES_A_BLOCK = 3, 4096, 4
#: Rows that lay out the trees: so many per leaf, and in all.
SAMPLE_PER_LEAF, MAX_SAMPLE = 64, 1 << 16
#: Nodes in a query's beam, and nodes it expands in one go. So many of the beam are scored exactly.
BEAM, EXPAND, RESCORED = 200, 100, 64
SHIFT = 20
NONE = -1

RANKED = "query_id long, rank int, vec_id long, score double"


# --- packed arrays --------------------------------------------------------


def pack(codes: np.ndarray) -> bytes:
    """Codes (or NONE) as bytes, four each where they fit."""
    codes = codes.ravel() + 1
    small = not len(codes) or codes.max() < 1 << 32
    return (b"4" + codes.astype(np.uint32).tobytes()) if small else (b"8" + codes.astype(np.int64).tobytes())


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint32 if data[:1] == b"4" else np.int64, offset=1).astype(np.int64) - 1


def halve(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as half-precision numbers of size 1 at most, and their scales."""
    scale = np.abs(x).max(axis=1, initial=0.0)
    return (x / np.where(scale > 0, scale, 1)[:, None]).astype(np.float16), scale.astype(np.float32)


def whole(half: bytes, scale: bytes, dim: int) -> np.ndarray:
    x = np.frombuffer(half, np.float16).reshape(-1, dim).astype(np.float32)
    return x * np.frombuffer(scale, np.float32)[:, None]


def by_block(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(block, positions) of codes, block by block."""
    order = np.argsort(codes >> SHIFT, kind="stable")
    blocks = (codes >> SHIFT)[order]
    cuts = np.nonzero(np.diff(blocks))[0] + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(codes[part[0]] >> SHIFT), part


# --- trees of random projections ------------------------------------------


class Tree:
    """Median thresholds of a complete tree; the directions of its levels come from the seed."""

    def __init__(self, sample: np.ndarray, depth: int, dim: int, seed: int):
        self.depth, self.dim, self.seed = depth, dim, seed
        self.thresholds = np.zeros((1 << depth) - 1)
        at = np.zeros(len(sample), np.int64)
        for level, p in enumerate(self.projections(sample)):
            first = (1 << level) - 1
            order = np.lexsort((p, at))
            cuts = np.searchsorted(at[order], np.arange(first, 2 * first + 2))
            for i in range(first + 1):
                members = p[order[cuts[i] : cuts[i + 1]]]
                self.thresholds[first + i] = np.median(members) if len(members) else 0.0
            at = 2 * at + 1 + (p > self.thresholds[at])

    def projections(self, x: np.ndarray) -> Iterator[np.ndarray]:
        directions = np.random.default_rng(self.seed).standard_normal((self.depth, self.dim))
        for d in directions:
            yield x @ d

    def leaves(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        for p in self.projections(x):
            at = 2 * at + 1 + (p > self.thresholds[at])
        return at - ((1 << self.depth) - 1)


# --- neighbour lists ------------------------------------------------------


class Lists:
    """The neighbour lists of a block's nodes: codes, scores (best first), and which are new."""

    SCHEMA = "block long, n int, ids binary, scores binary, fresh binary, changed long"

    def __init__(self, block: int, n: int):
        self.block, self.n, self.changed = block, n, 0
        self.ids = np.full((n, DEGREE), NONE, np.int64)
        self.scores = np.full((n, DEGREE), -np.inf, np.float32)
        self.fresh = np.zeros((n, DEGREE), bool)

    @staticmethod
    def read(row) -> Lists:
        out = Lists(int(row["block"]), 0)
        out.n = int(row["n"])
        out.ids = unpack(row["ids"]).reshape(-1, DEGREE)
        out.scores = np.frombuffer(row["scores"], np.float32).reshape(-1, DEGREE).copy()
        out.fresh = np.frombuffer(row["fresh"], bool).reshape(-1, DEGREE).copy()
        return out

    def row(self) -> pd.DataFrame:
        data = (self.block, self.n, pack(self.ids), self.scores.tobytes(), self.fresh.tobytes(), self.changed)
        return pd.DataFrame([data], columns=["block", "n", "ids", "scores", "fresh", "changed"])

    def merge(self, u: np.ndarray, v: np.ndarray, s: np.ndarray) -> None:
        """Take in the links from positions u to codes v; of a link that comes again the first stands."""
        keep = (s > self.scores[u, -1]) & (v != (self.block << SHIFT) + u)
        u, v, s = u[keep], v[keep], s[keep]
        known = self.ids.ravel() != NONE
        old_u = np.repeat(np.arange(self.n), DEGREE)[known]
        all_u = np.concatenate([old_u, u])
        all_v = np.concatenate([self.ids.ravel()[known], v])
        all_s = np.concatenate([self.scores.ravel()[known], s])
        added = np.concatenate([np.zeros(len(old_u), bool), np.ones(len(u), bool)])
        fresh = np.concatenate([self.fresh.ravel()[known], np.ones(len(u), bool)])
        order = np.lexsort((added, all_v, all_u))
        same = (np.diff(all_u[order]) == 0) & (np.diff(all_v[order]) == 0)
        order = order[np.concatenate([[True], ~same])] if len(order) else order
        order = order[np.lexsort((all_v[order], -all_s[order], all_u[order]))]
        place = np.arange(len(order)) - np.searchsorted(all_u[order], all_u[order])
        order, place = order[place < DEGREE], place[place < DEGREE]
        out = Lists(self.block, self.n)
        out.ids[all_u[order], place], out.scores[all_u[order], place] = all_v[order], all_s[order]
        out.fresh[all_u[order], place] = fresh[order]
        self.ids, self.scores, self.fresh = out.ids, out.scores, out.fresh
        self.changed = int(added[order].sum())

    def draw(self, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(new, old, mask): drawn neighbours of either kind, and which entries the new ones are."""
        chance = np.random.default_rng((seed, self.block)).random(self.ids.shape)
        picks = []
        for kind in (self.fresh, ~self.fresh):
            order = np.argsort(np.where(kind & (self.ids != NONE), chance, 2), axis=1)[:, :SAMPLE]
            fits = np.take_along_axis(kind & (self.ids != NONE), order, 1)
            picks.append((np.where(fits, np.take_along_axis(self.ids, order, 1), NONE), order, fits))
        mask = np.zeros(self.ids.shape, bool)
        np.put_along_axis(mask, picks[0][1], picks[0][2], 1)
        return picks[0][0], picks[1][0], mask


LINKS = "block long, u binary, v binary, s binary"


def _links(u: np.ndarray, v: np.ndarray, s: np.ndarray) -> pd.DataFrame:
    """Links of codes u to codes v as messages to the blocks of u."""
    rows = [
        (block, (u[at] & ((1 << SHIFT) - 1)).astype(np.uint32).tobytes(), pack(v[at]), s[at].astype(np.float32).tobytes())
        for block, at in by_block(u)
    ]
    return pd.DataFrame(rows, columns=["block", "u", "v", "s"])


def _read_links(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(frame):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
    return (
        np.concatenate([np.frombuffer(b, np.uint32) for b in frame["u"]]).astype(np.int64),
        np.concatenate([unpack(b) for b in frame["v"]]),
        np.concatenate([np.frombuffer(b, np.float32) for b in frame["s"]]),
    )


# --- nodes ----------------------------------------------------------------

BASE = "block long, n int, x binary, half binary, scale binary, h1 binary, h2 binary, members array<array<long>>, asks binary"


def _route(trees, dim: int, wide: bool):
    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                x = np.stack(frame["vec"].to_list()).astype(np.float64 if wide else np.float32)
                yield frame.assign(block=trees.value[0].leaves(x) // LEAVES_A_BLOCK)

    return of


def _build_block(dim: int, wide: bool, top: float):
    def of(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["h1", "h2"])
        x = np.stack(rows["vec"].to_list()).astype(np.float64 if wide else np.float32).reshape(-1, dim)
        half, scale = halve(x / x.dtype.type(top))  # the largest component of all is 1, so products stay finite
        asks = np.nonzero(rows["asks"].to_numpy(bool))[0].astype(np.uint32)
        return pd.DataFrame(
            [(int(key[0]), len(rows), x.tobytes(), half.tobytes(), scale.tobytes(), rows["h1"].to_numpy(np.int64).tobytes(),
              rows["h2"].to_numpy(np.int64).tobytes(), [list(m) for m in rows["members"]], asks.tobytes())],
            columns=[c.split()[0] for c in BASE.split(", ")],
        )

    return of


def usable_rows(vectors: DataFrame, is_query, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec, h1, h2, dim, asks): the rows that take part, with a 128-bit digest of the vector."""
    if vectors.schema[vec_col].dataType.elementType.simpleString() != "float":
        vectors = vectors.withColumn(vec_col, F.col(vec_col).cast("array<double>"))
    real = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf")))
    usable = F.col(id_col).isNotNull() & F.forall(vec_col, real) & F.exists(vec_col, lambda c: c != 0)
    slim = vectors.where(F.coalesce(usable, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"))
    return slim.select(
        "vec_id", "vec", F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2"), F.size("vec").alias("dim"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(h1, h2, vec, members, asks): one row per distinct vector, with its ``k + 1`` smallest ids."""
    smallest = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))
    nodes = (
        rows.withColumn("place", smallest)
        .where(F.col("place") <= k + 1)
        .groupBy("h1", "h2")
        .agg(F.any_value("vec").alias("vec"), F.sort_array(F.collect_list("vec_id")).alias("members"), F.any_value("dim").alias("dim"))
    )
    asked = rows.groupBy("h1", "h2").agg(F.bool_or("asks").alias("asks"))
    return stage(nodes.join(asked, ["h1", "h2"]), "ann-nodes")


# --- the start: leaves of random trees ------------------------------------


def _to_leaves(trees, dim: int, wide: bool):
    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                x = np.frombuffer(row.x, np.float64 if wide else np.float32).reshape(-1, dim)
                half = np.frombuffer(row.half, np.float16).reshape(-1, dim)
                scale = np.frombuffer(row.scale, np.float32)
                codes = (int(row.block) << SHIFT) + np.arange(row.n)
                for t, tree in enumerate(trees.value):
                    leaves = tree.leaves(x)
                    for leaf in np.unique(leaves):
                        at = np.nonzero(leaves == leaf)[0]
                        yield pd.DataFrame([(t, int(leaf), pack(codes[at]), half[at].tobytes(), scale[at].tobytes())], columns=["tree", "leaf", "codes", "half", "scale"])

    return of


def _compare_leaf(dim: int):
    def of(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        codes = np.concatenate([unpack(c) for c in rows["codes"]])
        x = np.concatenate([whole(h, s, dim) for h, s in zip(rows["half"], rows["scale"])])
        order = np.argsort(codes)
        codes, x = codes[order], x[order]
        k = min(DEGREE, len(codes) - 1)
        if not k:
            return _links(codes[:0], codes[:0], np.zeros(0, np.float32))
        u, v, s = [], [], []
        for i in range(0, len(x), 1024):
            g = x[i : i + 1024] @ x.T
            g[np.arange(len(g)), i + np.arange(len(g))] = -np.inf
            top = np.argpartition(-g, k - 1, axis=1)[:, :k]
            u.append(np.repeat(codes[i : i + 1024], k))
            v.append(codes[top].ravel())
            s.append(np.take_along_axis(g, top, 1).ravel())
        return _links(np.concatenate(u), np.concatenate(v), np.concatenate(s))

    return of


def _merge_links(key: tuple, base: pd.DataFrame, links: pd.DataFrame) -> pd.DataFrame:
    lists = Lists(int(key[0]), int(base["n"][0]))
    lists.merge(*_read_links(links))
    return lists.row()


# --- NN-descent -----------------------------------------------------------

DRAWN = "block long, new binary, old binary"


def _reverse(seed: int):
    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.to_dict("records"):
                lists = Lists.read(row)
                new, old, _ = lists.draw(seed)
                for fresh, drawn in ((True, new), (False, old)):
                    at, place = np.nonzero(drawn != NONE)
                    to, source = drawn[at, place], (lists.block << SHIFT) + at
                    for block, part in by_block(to):
                        yield pd.DataFrame([(block, fresh, pack(to[part]), pack(source[part]))], columns=["block", "fresh", "u", "v"])

    return of


def _join_reverse(seed: int):
    def of(key: tuple, own: pd.DataFrame, reverse: pd.DataFrame) -> pd.DataFrame:
        lists = Lists.read(own.iloc[0])
        new, old, _ = lists.draw(seed)
        both = []
        for fresh, drawn in ((True, new), (False, old)):
            part = reverse[reverse["fresh"] == fresh]
            out = np.full((lists.n, SAMPLE), NONE, np.int64)
            if len(part):
                u = np.concatenate([unpack(b) for b in part["u"]]) & ((1 << SHIFT) - 1)
                v = np.concatenate([unpack(b) for b in part["v"]])
                order = np.lexsort((v, u))
                u, v = u[order], v[order]
                order = np.lexsort((np.random.default_rng((seed, lists.block, fresh)).random(len(u)), u))
                u, v = u[order], v[order]
                place = np.arange(len(u)) - np.searchsorted(u, u)
                out[u[place < SAMPLE], place[place < SAMPLE]] = v[place < SAMPLE]
            both.append(np.concatenate([drawn, out], axis=1))
        return pd.DataFrame([(lists.block, pack(both[0]), pack(both[1]))], columns=["block", "new", "old"])

    return of


def _ask(columns: list[str]):
    """The codes that a block holds in these columns, as one request to each block that has them."""

    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.to_dict("records"):
                wanted = np.unique(np.concatenate([unpack(row[c]) for c in columns]))
                wanted = wanted[wanted != NONE]
                for block, at in by_block(wanted):
                    yield pd.DataFrame([(block, int(row["block"]), pack(wanted[at]))], columns=["block", "asker", "codes"])

    return of


VECTORS = "block long, codes binary, half binary, scale binary, least binary"


def _give(dim: int):
    def of(key: tuple, base: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        half = np.frombuffer(base["half"][0], np.float16).reshape(-1, dim)
        scale = np.frombuffer(base["scale"][0], np.float32)
        least = np.frombuffer(base["scores"][0], np.float32).reshape(-1, DEGREE)[:, -1]
        rows = []
        for asker, codes in zip(asked["asker"], asked["codes"]):
            at = unpack(codes) & ((1 << SHIFT) - 1)
            rows.append((int(asker), codes, half[at].tobytes(), scale[at].tobytes(), least[at].tobytes()))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in VECTORS.split(", ")])

    return of


def _given(frame: pd.DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted codes, their vectors, and their last neighbours' scores."""
    if not len(frame):
        return np.zeros(0, np.int64), np.zeros((0, dim), np.float32), np.zeros(0, np.float32)
    codes = np.concatenate([unpack(c) for c in frame["codes"]])
    x = np.concatenate([whole(h, s, dim) for h, s in zip(frame["half"], frame["scale"])])
    least = np.concatenate([np.frombuffer(b, np.float32) for b in frame["least"]])
    order = np.argsort(codes)
    return codes[order], x[order], least[order]


def best_links(u: np.ndarray, v: np.ndarray, s: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each link once, and of each u its ``DEGREE`` best."""
    first = np.unique(u * size + v, return_index=True)[1]
    u, v, s = u[first], v[first], s[first]
    order = np.lexsort((v, -s, u))
    u, v, s = u[order], v[order], s[order]
    keep = np.arange(len(u)) - np.searchsorted(u, u) < DEGREE
    return u[keep], v[keep], s[keep]


def _neighbours_of_neighbours(dim: int):
    def of(key: tuple, drawn: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        codes, x, least = _given(vectors, dim)
        if not len(codes):
            return _links(codes, codes, least)
        new = unpack(drawn["new"][0]).reshape(-1, 2 * SAMPLE)
        every = np.concatenate([new, unpack(drawn["old"][0]).reshape(-1, 2 * SAMPLE)], axis=1)
        found = []
        for i in range(0, len(new), 256):
            a, c = (np.where(z != NONE, np.searchsorted(codes, z), NONE) for z in (new[i : i + 256], every[i : i + 256]))
            g = np.matmul(x[a], x[c].transpose(0, 2, 1))
            off = (a[:, :, None] == NONE) | (c[:, None, :] == NONE) | (a[:, :, None] == c[:, None, :])
            g[off] = -np.inf
            # A link is worth sending to an end that has a worse neighbour.
            q, p, r = np.nonzero(g > least[a][:, :, None])
            found.append((a[q, p], c[q, r], g[q, p, r]))
            q, p, r = np.nonzero(g > least[c][:, None, :])
            found.append((c[q, r], a[q, p], g[q, p, r]))
            if sum(len(f[0]) for f in found) > 1 << 22:
                found = [best_links(*(np.concatenate(z) for z in zip(*found)), len(codes))]
        u, v, s = best_links(*(np.concatenate(z) for z in zip(*found)), len(codes))
        return _links(codes[u], codes[v], s)

    return of


def _merge_updates(seed: int):
    def of(key: tuple, own: pd.DataFrame, links: pd.DataFrame) -> pd.DataFrame:
        lists = Lists.read(own.iloc[0])
        lists.fresh &= ~lists.draw(seed)[2]
        lists.merge(*_read_links(links))
        return lists.row()

    return of


def _meet(left: DataFrame, right: DataFrame, do, schema: str) -> DataFrame:
    return left.groupBy("block").cogroup(right.groupBy("block")).applyInPandas(do, schema)


def descend(base: DataFrame, lists: DataFrame, dim: int, rounds: int) -> DataFrame:
    """Better neighbour lists, until few entries change or after so many rounds."""
    slim = base.select("block", "half", "scale")
    for seed in range(rounds):
        reverse = lists.mapInPandas(_reverse(seed), "block long, fresh boolean, u binary, v binary")
        drawn = stage(_meet(lists, reverse, _join_reverse(seed), DRAWN), "ann-drawn")
        asked = drawn.mapInPandas(_ask(["new", "old"]), "block long, asker long, codes binary")
        given = _meet(slim.join(lists.select("block", "scores"), "block"), asked, _give(dim), VECTORS)
        links = _meet(drawn, given, _neighbours_of_neighbours(dim), LINKS)
        lists = stage(_meet(lists, links, _merge_updates(seed), Lists.SCHEMA), "ann-lists")
        change = lists.agg(F.sum("changed").alias("c"), F.sum("n").alias("n")).first()
        if change["c"] < LEAST_CHANGE * DEGREE * change["n"]:
            break
    return lists


# --- greedy graph search --------------------------------------------------

GRAPH = "block long, near binary, codes binary, half binary, scale binary"


def _graph_block(dim: int):
    def of(key: tuple, own: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        """Neighbours as positions among the sorted codes, of which the block has the vectors."""
        codes, x, _ = _given(vectors, dim)
        ids = unpack(own["ids"][0])
        near = np.where(ids != NONE, np.searchsorted(codes, ids), NONE).astype(np.int32)
        half, scale = halve(x)
        return pd.DataFrame([(int(key[0]), near.tobytes(), pack(codes), half.tobytes(), scale.tobytes())], columns=[c.split()[0] for c in GRAPH.split(", ")])

    return of


class Beams:
    """The beams of a block's queries: codes and scores, best first, and which are expanded."""

    SCHEMA = "block long, asks binary, x binary, ids binary, scores binary, done binary, waiting long"

    def __init__(self, block: int, asks: np.ndarray, x: np.ndarray):
        self.block, self.asks, self.x = block, asks, x
        self.ids = np.full((len(asks), BEAM), NONE, np.int64)
        self.scores = np.full((len(asks), BEAM), -np.inf, np.float32)
        self.done = np.zeros((len(asks), BEAM), bool)

    @staticmethod
    def read(row, dim: int) -> Beams:
        asks = np.frombuffer(row["asks"], np.uint32).astype(np.int64)
        out = Beams(int(row["block"]), asks, np.frombuffer(row["x"], np.float32).reshape(-1, dim))
        out.ids = unpack(row["ids"]).reshape(-1, BEAM)
        out.scores = np.frombuffer(row["scores"], np.float32).reshape(-1, BEAM).copy()
        out.done = np.frombuffer(row["done"], bool).reshape(-1, BEAM).copy()
        return out

    def row(self) -> pd.DataFrame:
        waiting = int(((self.ids != NONE) & ~self.done).sum())
        data = (self.block, self.asks.astype(np.uint32).tobytes(), self.x.astype(np.float32).tobytes(), pack(self.ids), self.scores.tobytes(), self.done.tobytes(), waiting)
        return pd.DataFrame([data], columns=[c.split()[0] for c in self.SCHEMA.split(", ")])

    def take(self, i: int, codes: np.ndarray, scores: np.ndarray, done: np.ndarray) -> None:
        """Merge found nodes into the beam of query i, its own node left out."""
        known = self.ids[i] != NONE
        ids = np.concatenate([self.ids[i][known], codes])
        s = np.concatenate([self.scores[i][known], scores])
        d = np.concatenate([self.done[i][known], done])
        order = np.lexsort((~d, ids))  # of one node's entries an expanded one first
        order = order[np.concatenate([[True], np.diff(ids[order]) != 0])] if len(order) else order
        order = order[ids[order] != (self.block << SHIFT) + self.asks[i]]
        order = order[np.lexsort((ids[order], -s[order]))][:BEAM]
        self.ids[i], self.scores[i], self.done[i] = NONE, -np.inf, False
        self.ids[i, : len(order)], self.scores[i, : len(order)], self.done[i, : len(order)] = ids[order], s[order], d[order]


def _start_beams(dim: int):
    def of(key: tuple, own: pd.DataFrame, base: pd.DataFrame) -> pd.DataFrame:
        asks = np.frombuffer(base["asks"][0], np.uint32).astype(np.int64)
        beams = Beams(int(key[0]), asks, whole(base["half"][0], base["scale"][0], dim)[asks])
        lists = Lists.read(own.iloc[0])
        for i, a in enumerate(asks):
            near = lists.ids[a] != NONE
            beams.take(i, lists.ids[a][near], lists.scores[a][near], np.zeros(int(near.sum()), bool))
        return beams.row()

    return of


REQUESTS = "block long, home long, asks binary, x binary, least binary, at binary, ids binary"


def _expand_requests(dim: int):
    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.to_dict("records"):
                beams = Beams.read(row, dim)
                open_ = (beams.ids != NONE) & ~beams.done
                open_ &= np.cumsum(open_, axis=1) <= EXPAND
                at, place = np.nonzero(open_)
                ids = beams.ids[at, place]
                for block, part in by_block(ids):
                    asks, where = np.unique(at[part], return_inverse=True)
                    yield pd.DataFrame(
                        [(block, beams.block, asks.astype(np.uint32).tobytes(), beams.x[asks].tobytes(), beams.scores[asks, -1].tobytes(),
                          where.astype(np.uint32).tobytes(), pack(ids[part]))],
                        columns=[c.split()[0] for c in REQUESTS.split(", ")],
                    )

    return of


def greedy(block: int, near: np.ndarray, codes: np.ndarray, x: np.ndarray, query: np.ndarray, least: float, start: np.ndarray):
    """(positions, scores, expanded): what beats ``least`` among the neighbours of the block's nodes
    ``start`` and of the best nodes met on the way, as far as they lie in this block."""
    seen = np.zeros(len(codes), bool)
    expanded = np.zeros(len(near), bool)
    at, s = np.zeros(0, np.int64), np.zeros(0, np.float32)
    own = codes >> SHIFT == block
    position = codes & ((1 << SHIFT) - 1)
    todo = start
    while len(todo):
        expanded[todo] = True
        new = near[todo].ravel()
        new = np.unique(new[new != NONE])
        new = new[~seen[new]]
        seen[new] = True
        score = x[new] @ query
        keep = score > least
        at, s = np.concatenate([at, new[keep]]), np.concatenate([s, score[keep]])
        if len(at) > BEAM:
            best = np.argpartition(-s, BEAM - 1)[:BEAM]
            at, s = at[best], s[best]
            least = max(least, float(s.min()))
        here = own[at]
        here[here] = ~expanded[position[at[here]]]
        todo = position[at[here][np.argsort(-s[here], kind="stable")[:EXPAND]]]
    return at, s, own, position, expanded


ANSWERS = "block long, asks binary, sizes binary, ids binary, scores binary, done binary"


def _answer(dim: int):
    def of(key: tuple, graph: pd.DataFrame, requests: pd.DataFrame) -> pd.DataFrame:
        if not len(requests):
            return pd.DataFrame([], columns=[c.split()[0] for c in ANSWERS.split(", ")])
        block = int(key[0])
        codes, x = unpack(graph["codes"][0]), whole(graph["half"][0], graph["scale"][0], dim)
        near = np.frombuffer(graph["near"][0], np.int32).reshape(-1, DEGREE)
        rows = []
        for r in requests.itertuples(index=False):
            asks = np.frombuffer(r.asks, np.uint32)
            queries = np.frombuffer(r.x, np.float32).reshape(-1, dim)
            least, at = np.frombuffer(r.least, np.float32), np.frombuffer(r.at, np.uint32)
            start = unpack(r.ids) & ((1 << SHIFT) - 1)
            cuts = np.searchsorted(at, np.arange(len(asks) + 1))  # np.nonzero gave them by query
            ids, scores, done = [], [], []
            for i in range(len(asks)):
                begun = start[cuts[i] : cuts[i + 1]]
                found, s, own, position, expanded = greedy(block, near, codes, x, queries[i], float(least[i]), begun)
                d = own[found]
                d[d] = expanded[position[found[d]]]
                # The expanded nodes themselves come back too: the beam marks them as done.
                ids.append(np.concatenate([codes[found], (block << SHIFT) + begun]))
                scores.append(np.concatenate([s, np.full(len(begun), -np.inf, np.float32)]))
                done.append(np.concatenate([d, np.ones(len(begun), bool)]))
            sizes = np.array([len(z) for z in ids], np.uint32)
            rows.append((int(r.home), r.asks, sizes.tobytes(), pack(np.concatenate(ids)), np.concatenate(scores).astype(np.float32).tobytes(), np.concatenate(done).tobytes()))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in ANSWERS.split(", ")])

    return of


def _take_answers(dim: int):
    def of(key: tuple, own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        beams = Beams.read(own.iloc[0], dim)
        for r in answers.itertuples(index=False):
            ids, scores, done = unpack(r.ids), np.frombuffer(r.scores, np.float32), np.frombuffer(r.done, bool)
            ends = np.cumsum(np.frombuffer(r.sizes, np.uint32).astype(np.int64))
            for i, b, e in zip(np.frombuffer(r.asks, np.uint32).astype(np.int64), np.concatenate([[0], ends]), ends):
                finished = ids[b:e][np.isneginf(scores[b:e])]
                beams.done[i] |= np.isin(beams.ids[i], finished)
                real = ~np.isneginf(scores[b:e])
                beams.take(i, ids[b:e][real], scores[b:e][real], done[b:e][real])
        return beams.row()

    return of


def search(base: DataFrame, lists: DataFrame, dim: int) -> DataFrame:
    """The final beams (``Beams.SCHEMA``) of all nodes that ask."""
    slim = base.select("block", "half", "scale", "asks")
    asked = lists.select("block", "ids").mapInPandas(_ask(["ids"]), "block long, asker long, codes binary")
    given = _meet(slim.join(lists.select("block", "scores"), "block"), asked, _give(dim), VECTORS)
    graph = stage(_meet(lists.select("block", "ids"), given, _graph_block(dim), GRAPH), "ann-graph")
    beams = stage(_meet(lists, slim, _start_beams(dim), Beams.SCHEMA), "ann-beams")
    while beams.agg(F.sum("waiting")).first()[0]:
        requests = beams.mapInPandas(_expand_requests(dim), REQUESTS)
        answers = _meet(graph, requests, _answer(dim), ANSWERS)
        beams = stage(_meet(beams, answers, _take_answers(dim), Beams.SCHEMA), "ann-beams")
    return beams


# --- exact scores of the best ---------------------------------------------


def _exact_requests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for row in frame.to_dict("records"):
            ids = unpack(row["ids"]).reshape(-1, BEAM)[:, :RESCORED]
            asks = np.frombuffer(row["asks"], np.uint32).astype(np.int64)
            x = np.frombuffer(row["x"]).reshape(len(asks), -1)
            ids = np.concatenate([(int(row["block"]) << SHIFT) + asks[:, None], ids], axis=1)
            at, place = np.nonzero(ids != NONE)
            wanted = ids[at, place]
            for block, part in by_block(wanted):
                own, where = np.unique(at[part], return_inverse=True)
                yield pd.DataFrame(
                    [(block, int(row["block"]), asks[own].astype(np.uint32).tobytes(), x[own].tobytes(), where.astype(np.uint32).tobytes(), pack(wanted[part]))],
                    columns=["block", "home", "asks", "x", "at", "ids"],
                )


def _own_vectors(dim: int, wide: bool):
    def of(key: tuple, beams: pd.DataFrame, base: pd.DataFrame) -> pd.DataFrame:
        x = np.frombuffer(base["x"][0], np.float64 if wide else np.float32).reshape(-1, dim)
        asks = np.frombuffer(beams["asks"][0], np.uint32)
        return pd.DataFrame([(int(key[0]), beams["asks"][0], x[asks].astype(np.float64).tobytes(), beams["ids"][0])], columns=["block", "asks", "x", "ids"])

    return of


def _exact_scores(dim: int, wide: bool, k: int):
    def of(key: tuple, base: pd.DataFrame, requests: pd.DataFrame) -> pd.DataFrame:
        """The members of the asked nodes with their scores: of each query and block the ``k + 1`` best."""
        rows = []
        if len(requests):
            x = np.frombuffer(base["x"][0], np.float64 if wide else np.float32).reshape(-1, dim)
            members = base["members"][0]
            for r in requests.itertuples(index=False):
                asks, at = np.frombuffer(r.asks, np.uint32), np.frombuffer(r.at, np.uint32).astype(np.int64)
                queries = np.frombuffer(r.x).reshape(-1, dim)
                nodes = unpack(r.ids) & ((1 << SHIFT) - 1)
                cuts = np.searchsorted(at, np.arange(len(asks) + 1))
                for i in range(len(asks)):
                    mine = nodes[cuts[i] : cuts[i + 1]]
                    scores = (x[mine].astype(np.float64) * queries[i]).sum(axis=1)  # the same order of terms in any block
                    self_ = int(asks[i]) if int(key[0]) == r.home else NONE
                    best = sorted((-float(s), int(m), n != self_) for s, n in zip(scores, mine) for m in members[n])[: k + 1]
                    rows.append((int(r.home), int(asks[i]), [(m, -s, not other) for s, m, other in best]))
        return pd.DataFrame(rows, columns=["block", "ask", "hits"])

    return of


def _finish(k: int):
    def of(key: tuple, base: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        h1, h2 = np.frombuffer(base["h1"][0], np.int64), np.frombuffer(base["h2"][0], np.int64)
        best: dict[int, list] = {}
        for ask, hits in zip(found["ask"], found["hits"]):
            best.setdefault(int(ask), []).extend((-h["score"], h["vec_id"], h["own"]) for h in hits)
        rows = []
        for ask, hits in best.items():
            hits = sorted(hits, key=lambda h: (h[0], h[1], not h[2]))[: k + 1]
            rows.append((int(h1[ask]), int(h2[ask]), [(int(i), float(-s), bool(own)) for s, i, own in hits]))
        return pd.DataFrame(rows, columns=["h1", "h2", "found"])

    return of


HITS = "array<struct<vec_id:long,score:double,own:boolean>>"
SHARE = 1024


def _rank(queries: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Every query row with the best rows of its node but itself.

    A node with more than 1/1024 of all query rows goes by a broadcast table, of under 1,024 nodes.
    """
    keys = ["h1", "h2"]
    total = queries.count()
    heavy = queries.groupBy(*keys).count().where(F.col("count") * SHARE > total).select(*keys)
    heavy = F.broadcast(stage(found.join(F.broadcast(heavy), keys), "ann-heavy").withColumnRenamed("found", "heavy"))
    marked = queries.join(heavy, keys, "left")
    light = marked.where(F.col("heavy").isNull()).drop("heavy").join(found, keys)
    both = light.unionByName(marked.where(F.col("heavy").isNotNull()).withColumnRenamed("heavy", "found"))
    # The query's own row: the first entry with its vector and its id (rows that repeat it are equal in the result).
    own = F.array_position(F.transform("found", lambda f: f["own"] & (f["vec_id"] == F.col("vec_id"))), True)
    others = F.filter("found", lambda f, i: i + 1 != F.col("own"))
    return (
        both.withColumn("own", own)
        .select(F.col("vec_id").alias("query_id"), F.posexplode(F.slice(others, 1, k)).alias("at", "hit"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
    )


def _nearest_of_length(nodes: DataFrame, n: int, dim: int, top: float, k: int, rounds: int, leaf: int) -> DataFrame:
    """(h1, h2, found): the best ``k + 1`` rows of every node that asks, its own rows included."""
    spark = nodes.sparkSession
    wide = nodes.schema["vec"].dataType.elementType.simpleString() == "double"
    depth = max(0, int(np.ceil(np.log2(n / leaf))))
    share = min(1.0, min(MAX_SAMPLE, SAMPLE_PER_LEAF << depth) / n)
    drawn = nodes.where(F.pmod("h1", F.lit(1 << 30)) < int(share * (1 << 30)) + 1).orderBy("h1", "h2").limit(2 * MAX_SAMPLE)
    sample = np.array([r["vec"] for r in drawn.select("vec").collect()], float).reshape(-1, dim)
    trees = spark.sparkContext.broadcast([Tree(sample, depth, dim, t) for t in range(TREES)])  # a number per leaf
    slim = nodes.select("h1", "h2", "vec", "members", "asks")
    routed = slim.mapInPandas(_route(trees, dim, wide), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in slim.schema) + ", block long")
    base = stage(routed.groupBy("block").applyInPandas(_build_block(dim, wide, top), BASE), "ann-base")

    leaves = base.select("block", "n", "x", "half", "scale").mapInPandas(
        _to_leaves(trees, dim, wide), "tree int, leaf long, codes binary, half binary, scale binary"
    )
    links = leaves.groupBy("tree", "leaf").applyInPandas(_compare_leaf(dim), LINKS)
    lists = stage(_meet(base.select("block", "n"), links, _merge_links, Lists.SCHEMA), "ann-lists")
    lists = descend(base, lists, dim, rounds)
    beams = search(base, lists, dim)

    own = _meet(beams.select("block", "asks", "ids"), base.select("block", "x"), _own_vectors(dim, wide), "block long, asks binary, x binary, ids binary")
    asked = own.mapInPandas(_exact_requests, "block long, home long, asks binary, x binary, at binary, ids binary")
    hits = _meet(base.select("block", "x", "members"), asked, _exact_scores(dim, wide, k), f"block long, ask long, hits {HITS}")
    return _meet(base.select("block", "h1", "h2"), hits, _finish(k), f"h1 long, h2 long, found {HITS}")


def nearest_neighbours(
    vectors: DataFrame,
    is_query,
    k: int = K,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    rounds: int = ROUNDS,
    leaf: int = LEAF,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found for each row that ``is_query`` selects.

    ``is_query`` is a condition on the column ``vec_id``.
    """
    rows = usable_rows(vectors, is_query, id_col, vec_col)
    nodes = distinct_vectors(rows, k)
    largest = F.max(F.array_max(F.transform("vec", lambda c: F.abs(c)))).cast("double")
    lengths = nodes.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), largest.alias("top")).orderBy("dim").collect()
    found = None
    for r in lengths:
        part = _nearest_of_length(nodes.where(F.col("dim") == r["dim"]), r["n"], r["dim"], r["top"], k, rounds, leaf)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return vectors.sparkSession.createDataFrame([], RANKED)
    return _rank(rows.where("asks").select("vec_id", "h1", "h2"), stage(found, "ann-found"), k)
