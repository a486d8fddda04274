"""Operator 2: SimHash near-duplicates by vantage-point trees.

Fingerprints: words, lower-cased shingles, 64-bit hashes, one vote per bit.
Equal fingerprints collapse into one before the search, so a group of copies
of any size costs one point. A vantage-point tree over the distinct
fingerprints is laid out from a bounded sample: each inner node splits by the
Hamming distance to its vantage point at the median. Its leaves are the
shards. Every fingerprint is at home in one shard, and is also sent as a
guest to each shard that the triangle bound cannot rule out: a point at
distance d from the vantage point can have a partner on the other side of
the radius r only if |d - r| is within the bound. Inside a shard the same
tree goes on, vectorised, down to small buckets, where distances are computed
exactly. Each shard gives a spanning forest of its links, never all pairs;
components come from star contraction over those links in Spark.

On fingerprints spread evenly over 64 bits the distance to a vantage point
has a standard deviation of 4, so a band of 3 on either side holds about half
of the points: guests grow as about the 0.6th power of the number of shards.
That is a property of the method; see the README for figures.

Defined results: a null or empty text, or one without words, has fingerprint
zero, linked like any other. ``component_id`` is the smallest ``doc_id`` of
the component that isn't null, and null if all are. Repeated rows and ids
stay as they are in the report; the filter keeps one row of each component, told
apart by id and text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statflow.llm.common import stage, text_id, word_blocks

SHINGLE = 3
MAX_BITS = 3
#: Distinct fingerprints that are at home in one shard, about.
SHARD = 8192
#: Buckets of the tree inside a shard.
BUCKET = 128
#: Sampled fingerprints that lay out the shards: at most this many per shard, and in all.
SAMPLE_PER_SHARD = 64
MAX_SAMPLE = 1 << 18


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of a whole text, shingles counted with repeats."""
    from xxhash import xxh64_intdigest

    digest = partial(xxh64_intdigest, seed=42)
    votes, n, tail = np.zeros(64, np.int64), 0, []
    for words in word_blocks(text):
        tail += words
        if len(tail) >= shingle:
            parts = map(b" ".join, zip(*(tail[i:] for i in range(shingle))))
            h = np.fromiter(map(digest, parts), np.uint64, len(tail) - shingle + 1)
            for i in range(0, len(h), 1 << 16):
                bits = np.unpackbits(h[i : i + (1 << 16)].view(np.uint8), bitorder="little")
                votes += bits.reshape(-1, 64).sum(0, dtype=np.int64)
            n += len(h)
            tail = tail[len(tail) - shingle + 1 :] if shingle > 1 else []
    if not n:
        if not tail:
            return 0
        return digest(b" ".join(tail))
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            fp = np.array([fingerprint(t, shingle) for t in frame["text"]], np.uint64)
            yield frame.drop(columns="text").assign(fp=fp.view(np.int64))

    return of


# --- the tree over shards -------------------------------------------------


def lay_out(sample: np.ndarray, depth: int, seed: int = 7) -> list[tuple[int, int]]:
    """A complete tree of (vantage point, radius), children of node i at 2i+1 and 2i+2.

    Of a few candidates, the vantage point whose distances spread most is taken:
    the fewest points then lie near the radius.
    """
    rng = np.random.default_rng(seed)
    nodes: list[tuple[int, int]] = []
    level = [sample]
    for _ in range(depth):
        below = []
        for points in level:
            best = (-1.0, 0, 32)
            for _ in range(8):
                v = np.uint64(rng.integers(0, 1 << 64, dtype=np.uint64))
                if len(points) and rng.random() < 0.75:
                    v = points[rng.integers(len(points))]
                    if rng.random() < 0.5:
                        v = ~v
                d = np.bitwise_count(points ^ v) if len(points) else np.array([32])
                spread = float(d.std())
                if spread > best[0]:
                    best = (spread, int(v), int(np.median(d)))
            _, v, r = best
            nodes.append((v, r))
            d = np.bitwise_count(points ^ np.uint64(v))
            below += [points[d <= r], points[d > r]]
        level = below
    return nodes


def route(fps: np.ndarray, nodes: list[tuple[int, int]], depth: int, bound: int):
    """(index, shard, at_home) arrays: every shard where each fingerprint has to be.

    Of two points on different sides of a node, the one outside the radius is the
    guest: a point at home inside never goes out, a point outside goes in too if it
    lies within ``bound`` of the radius. A guest below goes to both sides that the
    triangle bound leaves.
    """
    index = np.arange(len(fps))
    node = np.zeros(len(fps), np.int64)
    home = np.ones(len(fps), bool)
    if nodes:
        vantage = np.array([v for v, _ in nodes], np.uint64)
        radius = np.array([r for _, r in nodes], np.int64)
    for _ in range(depth):
        gap = np.bitwise_count(fps[index] ^ vantage[node]).astype(np.int64) - radius[node]
        inside = gap <= bound
        outside = np.where(home, gap > 0, gap > -bound)
        stays = home & (gap <= 0)
        index, node, home = (
            np.concatenate([index[inside], index[outside]]),
            np.concatenate([2 * node[inside] + 1, 2 * node[outside] + 2]),
            np.concatenate([stays[inside], home[outside]]),
        )
    return index, node, home


# --- search inside a shard ------------------------------------------------


class _Forest:
    """Union-find over positions; ``add`` tells whether a link joins two trees."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return i

    def add(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True

    def join(self, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        """The links a[i] - b[i] that join trees. In each round every point takes its
        first link; links inside one tree then fall away, so a dense group costs a few
        rounds, not a step for each of its pairs."""
        added = []
        a, b = a[a != b], b[a != b]
        while len(a):
            first = np.unique(a, return_index=True)[1]
            added += [(x, y) for x, y in zip(a[first].tolist(), b[first].tolist()) if self.add(x, y)]
            ids, where = np.unique(np.concatenate([a, b]), return_inverse=True)
            root = np.array([self.find(i) for i in ids.tolist()])[where]
            apart = root[: len(a)] != root[len(a) :]
            a, b = a[apart], b[apart]
        return added


def shard_links(home: np.ndarray, guests: np.ndarray, bound: int, bucket: int = BUCKET) -> list[tuple[int, int]]:
    """A spanning forest of the links between home points, and of home points with guests."""
    points = np.concatenate([home, guests])
    n_home = len(home)
    forest, links = _Forest(len(points)), []
    rng = np.random.default_rng(11)
    todo = [(np.arange(n_home), np.arange(len(points)), 0)]
    while todo:
        members, queries, stuck = todo.pop()
        if not len(members) or not len(queries):
            continue
        if len(members) <= bucket or stuck > 8:
            for i in range(0, len(members), 1024):
                own = members[i : i + 1024]
                for j in range(0, len(queries), 1024):
                    q = queries[j : j + 1024]
                    near = np.bitwise_count(points[q][:, None] ^ points[own][None, :]) <= bound
                    a, b = np.nonzero(near)
                    for x, y in forest.join(q[a], own[b]):
                        links.append((int(points[x]), int(points[y])))
            continue
        tries = []
        for v in points[members[rng.integers(len(members), size=4)]]:
            d = np.bitwise_count(points[members] ^ v)
            tries.append((float(d.std()), int(v), int(np.median(d))))
        _, v, r = max(tries)
        d = np.bitwise_count(points[members] ^ np.uint64(v)).astype(np.int64)
        dq = np.bitwise_count(points[queries] ^ np.uint64(v)).astype(np.int64)
        inner = members[d <= r]
        again = stuck + 1 if len(inner) in (0, len(members)) else 0
        todo.append((inner, queries[dq <= r + bound], again))
        todo.append((members[d > r], queries[dq > r - bound], again))
    return links


def _route_frames(nodes, depth: int, bound: int):
    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            fps = frame["fp"].to_numpy(np.int64).view(np.uint64)
            for i in range(0, len(fps), 4096):
                part = fps[i : i + 4096]
                index, shard, home = route(part, nodes.value, depth, bound)
                yield pd.DataFrame({"fp": part[index].view(np.int64), "shard": shard, "home": home})

    return of


def _search(bound: int):
    def of(shard: pd.DataFrame) -> pd.DataFrame:
        fp = shard["fp"].to_numpy(np.int64).view(np.uint64)
        home = shard["home"].to_numpy(bool)
        links = np.array(shard_links(np.sort(fp[home]), np.sort(fp[~home]), bound), np.uint64).reshape(-1, 2)
        return pd.DataFrame({"a": links[:, 0].copy().view(np.int64), "b": links[:, 1].copy().view(np.int64)})

    return of


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, shard: int = SHARD) -> DataFrame:
    """(a, b) links between the distinct fingerprints of column ``fp``: enough of them
    that every two fingerprints within ``max_bits`` are connected."""
    spark = fps.sparkSession
    distinct = stage(fps.select("fp").distinct(), "fingerprints")
    n = distinct.count()
    depth = max(0, int(np.ceil(np.log2(max(1, n / shard)))))
    want = min(MAX_SAMPLE, SAMPLE_PER_SHARD << depth)
    sample = distinct.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(min(1.0, want / max(1, n)) * (1 << 30)))
    points = np.sort(np.array([r["fp"] for r in sample.limit(4 * MAX_SAMPLE).collect()], np.int64)).view(np.uint64)
    nodes = spark.sparkContext.broadcast(lay_out(points, depth))
    routed = distinct.mapInPandas(_route_frames(nodes, depth, max_bits), "fp long, shard long, home boolean")
    return routed.groupBy("shard").applyInPandas(_search(max_bits), "a long, b long")


# --- components -----------------------------------------------------------


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """(node, root): every linked node with the smallest node it can reach.

    Alternates large-star and small-star steps until nothing changes. Each step is
    one aggregation and one join; a step's result is a table in the shared folder.
    """
    edges = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name
    )
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(low, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(down.withColumnRenamed("u", "k"), F.col("u") == F.col("k"))
        small = joined.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = stage(small.select("e.*").where("u <> v").distinct(), name)
        mark = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor(F.xxhash64("u", "v")).alias("x"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
        ).first()
        if mark == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard: int = SHARD,
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row per row of ``docs``."""
    marked = _marked(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), shingle)
    # One row per distinct fingerprint: its smallest document, its root, the root's smallest document.
    rooted = _rooted(marked, F.min("doc_id"), max_bits, shard)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _marked(slim: DataFrame, shingle: int) -> DataFrame:
    """The columns of ``slim`` but text, with the fingerprint ``fp``; written once."""
    id_type = slim.schema["doc_id"].dataType.simpleString()
    named = text_id(slim, "doc_id")
    kept = [f for f in named.schema if f.name != "text"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    marked = named.mapInPandas(_fingerprints(shingle), f"{schema}, fp long")
    return stage(marked.withColumn("doc_id", F.col("doc_id").cast(id_type)), "simhash")


def _rooted(marked: DataFrame, first, max_bits: int, shard: int) -> DataFrame:
    """(fp, least, root): every distinct fingerprint with ``first`` of its rows and its component's root."""
    roots = components(fingerprint_links(marked, max_bits, shard))
    own = marked.groupBy("fp").agg(first.alias("least"))
    return own.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, shard: int = SHARD) -> DataFrame:
    """``docs`` with one row of each component: the first by ``doc_id`` (rows without one come
    last), then by a digest of id and text. Of rows that repeat both id and text one stays; rows that
    share an id only are told apart. All columns stay, whatever their names.
    """
    parts = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("text").isNull(), F.col("text")]
    keyed = docs.withColumns({f"__h{i}": F.xxhash64(F.lit(i), *parts) for i in (1, 2)})
    marked = _marked(keyed.select("doc_id", "text", "__h1", "__h2"), shingle)
    row = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "__h1", "__h2")
    first = _rooted(marked, F.min(row), max_bits, shard).groupBy("root").agg(F.min("least").alias("least"))
    first = stage(first.select("least.__h1", "least.__h2"), "simhash-first")
    keys = ["__h1", "__h2"]
    return keyed.join(first, keys, "left_semi").dropDuplicates(keys).drop(*keys)
