"""Operator 11 against a brute-force trie."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

from statflow.llm.prefix_trie import ends_of, owners_of, prefix_trie

TURNS = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    convs = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            tid = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            convs.setdefault(c, []).append(((turn is not None, turn or 0, tid), (role, text)))
    convs = {c: [t for _, t in sorted(ts, key=lambda x: x[0])] for c, ts in convs.items()}
    rebuilt = {}
    for c, ts in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        rebuilt[c] = convs.get(base, [])[:h] + ts[h:]
    members, kids = {}, {}
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    for k in members:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        below = kids.get(k, [])
        leaves[k] = sum(leaves[x] for x in below) or 1
        own = (len(members[k]) - 1) * len(WORD.findall(k[-1][1])) if k else 0
        saved[k] = own + sum(saved[x] for x in below)
    ends = lambda k: ",".join(str(c) for c in sorted(members[k]) if len(rebuilt[c]) == len(k))
    return sorted(
        (min(m), len(k), min(members[k[:-1]]) if k else -(10**9), len(m), len(kids.get(k, [])), leaves[k], saved[k],
         hashlib.sha256(ends(k).encode()).hexdigest())
        for k, m in members.items()
    )


def found(df):
    return sorted((r[0], r[1], -(10**9) if r[2] is None else r[2], *r[3:]) for r in df.collect())


def odd_rows():
    """Ids of both signs, absent bases, nulls, ties, repeated and very long rows, empty texts, several blocks."""
    rnd = random.Random(5)
    rows = [(None, 0, "user", "no id"), (1 << 60, None, None, None), ((1 << 60) + 1, 5, "user", "w " * 200_000)]
    for c in list(range(-7, 30)) + list(range(61, 66)):
        for i in range(rnd.choice([1, 2, 3, 5, 9, 20])):
            turn = rnd.choice([i, i, None]) if c % 3 == 0 else i
            rows.append((c, turn, rnd.choice(["user", None]) if i > 2 else "user", rnd.choice(["a", "b c", "", None]) if i > 1 else "a b"))
    return rows + rows[5:9]


def test_equals_brute_force(spark):
    rows = odd_rows()
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS + ", depth string, n_convs int").repartition(5)
    assert found(prefix_trie(turns)) == brute(rows)


def test_other_width_and_many_copies_of_one_conversation(spark):
    rows = [(c, i, "user", f"t{i}") for c in range(0, 4000, 20) for i in range(7)] + [(10_001, 0, "user", "t0")]
    assert found(prefix_trie(spark.createDataFrame(rows, TURNS), width=3)) == brute(rows)


def test_no_rows(spark):
    assert prefix_trie(spark.createDataFrame([], TURNS)).collect() == []


def test_heavy_and_light_nodes_are_named_alike(spark):
    """A node that holds nearly all paths goes by the broadcast table, the others by the join."""
    paths = [(c, 1, 7, 7) for c in range(1500)] + [(2000, 1, 8, 8)]
    df = spark.createDataFrame(paths, "conv_id long, k long, x1 long, x2 long")
    nodes = spark.createDataFrame([(0, 1), (2000, 1)], "conv_id long, depth long")
    turns = spark.createDataFrame([(0, 1, 7, 7), (2000, 1, 8, 8)], "conv_id long, d long, x1 long, x2 long")
    got = {r["conv_id"]: r["top"] for r in owners_of(df, nodes, turns).collect()}
    assert got == {c: (2000 if c == 2000 else 0) for c, *_ in paths}


def test_ends_in_several_pieces(spark, monkeypatch):
    from statflow.llm import prefix_trie as module

    monkeypatch.setattr(module, "LISTED", 3)
    rows = [(1, 2, c) for c in range(-20, 20)] + [(5, 2, 5)]
    got = {r[0]: r[2] for r in ends_of(spark.createDataFrame(rows, "end_conv long, end_depth long, conv_id long")).collect()}
    assert got == {1: hashlib.sha256(",".join(map(str, range(-20, 20))).encode()).hexdigest(), 5: hashlib.sha256(b"5").hexdigest()}
