"""Operator 11: the prefix trie of conversations by ROLLUP over turn-id columns.

A turn's id is a digest of its role and text. The turns of a conversation are
laid out in blocks of ``WIDTH`` positional columns; ``GROUP BY block, node,
ROLLUP(t1, ..., t8)`` makes every prefix of a block a group of its own, and
``grouping_id()`` tells its depth. Conversations longer than one block go on in
further blocks, keyed by the node at which the block before ended: the digest of
the whole path up to there, running over the turns. So one aggregation gives
the nodes of all blocks, however long the longest conversation is.

The smallest member of a node owns it. What a conversation owns is the tail of its
path, from depth ``s`` on, so every sum over a subtree is a sum over members:

* leaves: members whose own last node is childless;
* saved tokens: a member walks ``W(s - 1)`` words through nodes that others own, of
  which ``W(d - 1)`` lie above a node of depth d.

The first ROLLUP finds the owners (hence ``s``), the second one sums these.

No step puts a whole conversation or a whole group into one task. Turns are dealt
by ranges of (conversation, turn); running values go on from range to range by
the totals of the ranges, of which a conversation has few. What is known of a
conversation reaches its blocks by the key (conversation, hundreds of blocks). A
node with more than 1/1024 of all attached paths is looked up in a broadcast table,
which so has at most 1,024 rows. Conversations that end at one node are listed by
ranges, in texts of bounded length, over which the digest then runs.

Defined results: rows without ``conv_id`` take no part. Turns that tie are ordered by
the digest of role and text; repeated rows are turns of their own; null turns come
first. Null roles and texts are empty. Without rows there is no root. Extra columns
are ignored. Two different turns or paths count as equal only if 128 bits of their digests
agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statflow.llm.common import stage, words_of

#: Turns of one block: the positional columns of the ROLLUP.
WIDTH = 8
#: Blocks of a conversation that share one copy of what is known of it.
SPAN = 512
#: A key with more than this part of all rows is heavy; there are fewer than that many of them.
SHARE = 1024
#: Borrowed turns: conversation c starts with the first crc32(c) % BORROW turns of conversation c - c % BASE.
BORROW, BASE = 4, 20
#: Conversations that one piece of a list of ends names.
LISTED = 1 << 15

EMPTY_SHA256 = hashlib.sha256().hexdigest()


def borrowed(conv_id: Column) -> Column:
    """How many turns a conversation takes from its base."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % BORROW).cast("long")


def _mix(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "d", "tid")


def dealt_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, tid, words, range): slim turns, dealt by ranges of their order."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    slim = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.substring(digest, 1, 32)).alias("tid"),
        F.size(words_of(text)).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("row"),  # spreads rows that are repeated very often
    )
    ranged = slim.repartitionByRange("conv_id", F.asc_nulls_first("turn"), "tid", "row")
    return stage(ranged.drop("row").withColumn("range", F.spark_partition_id()), "trie-turns")


def _totals_before(parts: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Totals over the earlier ranges of the conversation; it has one row per range."""
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("conv_id", "range", *[F.coalesce(c.over(before), F.lit(0)).alias(n) for n, c in sums.items()])


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, len) of every rebuilt conversation, and its turns:
    (conv_id, d, tid, words, len, walked, x1, x2), where ``walked`` words and the path
    digest ``x1, x2`` run over the turns up to depth d."""
    first = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "tid")
    heads = (
        turns.withColumn("pos", F.row_number().over(first))
        .where(F.col("pos") < BORROW)
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "tid", "words"))).alias("head"))
    )
    parts = turns.groupBy("conv_id", "range").agg(F.count(F.lit(1)).alias("n"))
    convs = parts.groupBy("conv_id").agg(F.sum("n").alias("own"))
    convs = (
        convs.withColumn("h", borrowed(F.col("conv_id")))
        .withColumn("base", F.col("conv_id") - F.col("conv_id") % BASE)
        .join(heads.select(F.col("conv_id").alias("base"), "head"), "base", "left")
        .withColumn("taken", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("h").cast("int")))
        .withColumn("shift", F.size("taken") - F.col("h"))
        .withColumn("len", F.size("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
        .select("conv_id", "h", "taken", "shift", "len")
    )
    convs = stage(convs, "trie-convs")

    starts = _totals_before(parts, {"start": F.sum("n")}).join(convs.drop("taken"), "conv_id")
    inside = Window.partitionBy("conv_id", "range")
    own = (
        turns.join(starts, ["conv_id", "range"])
        .withColumn("pos", F.row_number().over(inside.orderBy(F.asc_nulls_first("turn"), "tid")) + F.col("start"))
        .where(F.col("pos") > F.col("h"))
        .select("conv_id", "range", (F.col("pos") + F.col("shift")).alias("d"), "tid", "words", "len")
    )
    lent = convs.select("conv_id", F.lit(-1).alias("range"), F.explode("taken").alias("t"), "len").select(
        "conv_id", "range", F.col("t.pos").cast("long").alias("d"), "t.tid", "t.words", "len"
    )
    up_to = inside.orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    running = stage(
        own.unionByName(lent).select(
            "conv_id", "range", "d", "tid", "words", "len",
            F.sum("words").over(up_to).alias("walked"),
            F.bit_xor(_mix(1)).over(up_to).alias("x1"),
            F.bit_xor(_mix(2)).over(up_to).alias("x2"),
        ),
        "trie-running",
    )
    totals = running.groupBy("conv_id", "range").agg(
        F.sum("words").alias("words"), F.bit_xor(_mix(1)).alias("x1"), F.bit_xor(_mix(2)).alias("x2")
    )
    before = _totals_before(totals, {"w0": F.sum("words"), "y1": F.bit_xor("x1"), "y2": F.bit_xor("x2")})
    rebuilt = running.join(before, ["conv_id", "range"]).select(
        "conv_id", "d", "tid", "words", "len",
        (F.col("walked") + F.col("w0")).alias("walked"),
        F.col("x1").bitwiseXOR(F.col("y1")).alias("x1"),
        F.col("x2").bitwiseXOR(F.col("y2")).alias("x2"),
    )
    return convs.select("conv_id", "len"), stage(rebuilt, "trie-rebuilt")


def column_blocks(convs: DataFrame, rebuilt: DataFrame, width: int = WIDTH) -> DataFrame:
    """(conv_id, block, p1, p2, here, len, t1, ...): one row per conversation and block; p1, p2
    are the node where the block before ended, ``here`` the turns in this one."""
    at = F.col("d") - 1
    turn = F.struct(at.alias("at"), "tid", F.col("x1").bitwiseXOR(_mix(1)).alias("p1"), F.col("x2").bitwiseXOR(_mix(2)).alias("p2"))
    grouped = (
        rebuilt.groupBy("conv_id", F.floor(at / width).alias("block"))
        .agg(F.sort_array(F.collect_list(turn)).alias("ts"), F.max("len").alias("len"))  # at most ``width`` turns
        .select(
            "conv_id", "block", F.col("ts")[0]["p1"].alias("p1"), F.col("ts")[0]["p2"].alias("p2"), F.size("ts").alias("here"), "len",
            *[F.get("ts", F.lit(i))["tid"].alias(f"t{i + 1}") for i in range(width)],
        )
    )
    none = [F.lit(0).cast("long").alias(c) for c in ("block", "p1", "p2")]
    turnless = convs.where("len = 0").select(
        "conv_id", *none, F.lit(0).alias("here"), "len", *[F.lit(None).cast("binary").alias(f"t{i + 1}") for i in range(width)]
    )
    return stage(grouped.unionByName(turnless), "trie-blocks")


def roll_up(blocks: DataFrame, aggregates: str, width: int = WIDTH) -> DataFrame:
    """(conv_id, depth, ...): one row per node, named by its smallest member.

    A group ends at a turn that some members lack if that turn's column is null; such a
    group is no node. The empty prefix of a later block is a node of the block before.
    """
    columns = ", ".join(f"t{i + 1}" for i in range(width))
    groups = blocks.sparkSession.sql(
        f"""SELECT block, {width} - bit_count(grouping_id()) AS level, min(here) AS least, min(conv_id) AS conv_id, {aggregates}
            FROM {{blocks}} GROUP BY block, p1, p2, ROLLUP ({columns})""",
        blocks=blocks,
    )
    nodes = groups.where("least >= level AND (level > 0 OR block = 0)")
    return nodes.withColumn("depth", F.col("block") * width + F.col("level")).drop("block", "level", "least")


def owners_of(paths: DataFrame, nodes: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """``paths`` (conv_id, k, x1, x2) with ``top``, the owner of the node at depth k of this path digest."""
    keys = ["k", "x1", "x2"]
    nodes = nodes.where("depth > 0").select(F.col("conv_id").alias("top"), F.col("depth").alias("k"))
    digests = rebuilt.select(F.col("conv_id").alias("top"), F.col("d").alias("k"), "x1", "x2")
    ways = paths.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    named = stage(nodes.join(digests, ["top", "k"]).join(ways, keys), "trie-named")
    total = paths.count()
    heavy = F.broadcast(named.where(F.col("n") * SHARE > total).select(*keys, F.col("top").alias("heavy")))  # under SHARE rows
    marked = paths.join(heavy, keys, "left")
    light = named.where(F.col("n") * SHARE <= total).select(*keys, "top")
    return (
        marked.where(F.col("heavy").isNull()).drop("heavy").join(light, keys, "left")
        .unionByName(marked.where(F.col("heavy").isNotNull()).withColumnRenamed("heavy", "top"))
    )


ENDS = "end_conv long, end_depth long, first long, listed string"


def _list_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted (end_conv, end_depth, conv_id) rows as comma-joined texts of at most ``LISTED`` ids."""
    schema = pa.schema([("end_conv", pa.int64()), ("end_depth", pa.int64()), ("first", pa.int64()), ("listed", pa.string())])
    key, ids = None, []
    for batch in batches:
        out = []
        for e, d, c in zip(*(batch.column(n).to_pylist() for n in ("end_conv", "end_depth", "conv_id"))):
            if key != (e, d) or len(ids) == LISTED:
                if ids:
                    out.append((*key, ids[0], ",".join(map(str, ids))))
                key, ids = (e, d), []
            ids.append(c)
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 4, schema.types)], schema=schema)
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*key, ids[0], ",".join(map(str, ids))), schema.types)], schema=schema)


def _digest_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("end_conv", pa.int64()), ("end_depth", pa.int64()), ("ends_sha256", pa.string())])
    key, sha = None, None
    for batch in batches:
        out = []
        for e, d, listed in zip(*(batch.column(n).to_pylist() for n in ("end_conv", "end_depth", "listed"))):
            if key != (e, d):
                if key is not None:
                    out.append((*key, sha.hexdigest()))
                key, sha = (e, d), hashlib.sha256(listed.encode())
            else:
                sha.update(b"," + listed.encode())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 3, schema.types)], schema=schema)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*key, sha.hexdigest()), schema.types)], schema=schema)


def ends_of(members: DataFrame) -> DataFrame:
    """(end_conv, end_depth, ends_sha256) from (end_conv, end_depth, conv_id), in bounded memory."""
    order = ["end_conv", "end_depth", "conv_id"]
    listed = members.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_list_ends, ENDS)
    by_node = listed.repartition("end_conv", "end_depth").sortWithinPartitions("end_conv", "end_depth", "first")
    return by_node.mapInArrow(_digest_ends, "end_conv long, end_depth long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs, rebuilt = rebuilt_turns(dealt_turns(conversations))
    blocks = column_blocks(convs, rebuilt, width)

    owned = stage(roll_up(blocks, "max(len) AS longest", width), "trie-owned")
    tails = owned.groupBy("conv_id").agg(
        F.min("depth").alias("s"), F.max((F.col("longest") == F.col("depth")).cast("long")).alias("leaf")
    )
    # k: the depth of the node above the tail, or the last one of a conversation that owns none.
    tails = convs.join(tails, "conv_id", "left").withColumn("k", F.coalesce(F.col("s") - 1, "len"))
    above = rebuilt.select("conv_id", F.col("d").alias("k"), "walked", "x1", "x2")
    tails = stage(tails.join(above, ["conv_id", "k"], "left").fillna(0, ["leaf", "walked"]), "trie-tails")
    root = F.broadcast(convs.agg(F.min("conv_id").alias("root")))  # one row
    tops = owners_of(tails.where("k > 0").select("conv_id", "k", "x1", "x2"), owned, rebuilt)
    tails = tails.join(tops.select("conv_id", "top"), "conv_id", "left").crossJoin(root)
    tails = stage(
        tails.select("conv_id", "len", "s", "leaf", "walked", F.when(F.col("k") == 0, F.col("root")).otherwise(F.col("top")).alias("top")),
        "trie-tops",
    )

    span = width * SPAN
    known = tails.select(
        "conv_id", "leaf", "walked", F.explode(F.sequence(F.lit(0), F.floor(F.col("len") / span))).alias("part")
    )
    counted = roll_up(
        blocks.withColumn("part", F.floor(F.col("block") / SPAN)).join(known, ["conv_id", "part"]),
        "count(*) AS n_convs, sum(leaf) AS n_leaves, sum(walked) AS walked_all",
        width,
    )
    here = rebuilt.select("conv_id", F.col("d").alias("depth"), (F.col("walked") - F.col("words")).alias("before"))
    attached = tails.where("s > 0").select("conv_id", F.col("s").alias("depth"), "top")
    nodes = (
        counted.withColumn("part", F.floor(F.col("depth") / span))
        .join(known.select("conv_id", "part", F.col("walked").alias("own")), ["conv_id", "part"])
        .join(here, ["conv_id", "depth"], "left")
        .join(attached, ["conv_id", "depth"], "left")
        .select(
            "conv_id", "depth",
            F.when(F.col("depth") > 0, F.coalesce("top", "conv_id")).alias("parent_conv_id"),
            "n_convs", "n_leaves",
            (F.col("walked_all") - F.col("own") - (F.col("n_convs") - 1) * F.coalesce("before", F.lit(0))).alias("saved_tokens"),
        )
    )
    nodes = stage(nodes, "trie-nodes")
    children = (
        nodes.where("depth > 0")
        .groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    last = F.when(F.col("s").isNotNull(), F.col("conv_id")).otherwise(F.col("top"))
    ends = ends_of(tails.select(last.alias("end_conv"), F.col("len").cast("long").alias("end_depth"), "conv_id"))
    ends = ends.select(F.col("end_conv").alias("conv_id"), F.col("end_depth").alias("depth"), "ends_sha256")
    return (
        nodes.join(children, ["conv_id", "depth"], "left")
        .join(ends, ["conv_id", "depth"], "left")
        .select(
            "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
        )
    )
