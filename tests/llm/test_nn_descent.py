"""Operator 13 against brute force: recall, exact scores, order, and rows that are out of the ordinary."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from llm_data import SF
from statflow.llm.nn_descent import DEGREE, Lists, Tree, halve, nearest_neighbours, pack, unpack

VECTORS = "vec_id long, embedding array<double>"


def brute(rows, k=20, asks=lambda i: i % 20 == 0):
    """{query row number: [(vec_id, score)]} over rows (vec_id, vector)."""
    kept = [(n, i, v) for n, (i, v, *_) in enumerate(rows) if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    out = {}
    for n, i, v in kept:
        if asks(i):
            near = [(-float((np.array(w) * np.array(v)).sum()), j) for m, j, w in kept if m != n and len(w) == len(v)]
            out[n] = [(j, -s) for s, j in sorted(near)[:k]]
    return out


def results(df):
    """Sorted result lists, one per query row; rows that share an id are told apart by their ranks."""
    by = {}
    for r in df.collect():
        by.setdefault(r["query_id"], {}).setdefault(r["rank"], []).append((r["vec_id"], r["score"]))
    return by


def recall(rows, got, k=20):
    want = brute(rows, k)
    hit = total = 0
    for n, near in want.items():
        found = [x for at in got.get(rows[n][0], {}).values() for x in at]
        hit += len({i for i, _ in near} & {i for i, _ in found})
        total += len(near)
    return hit / total


def test_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = results(nearest_neighbours(spark.read.parquet(f"{SF}/embeddings.parquet"), F.col("vec_id") % 20 == 0))
    assert recall(rows, got) >= 0.99
    at = dict(rows)
    for q, ranks in got.items():
        assert sorted(ranks) == list(range(1, 21))
        order = [(-ranks[n][0][1], ranks[n][0][0]) for n in range(1, 21)]
        assert order == sorted(order)
        assert all(abs(-s - float(np.dot(np.array(at[i]), np.array(at[q])))) < 1e-12 for s, i in order)


def test_many_small_leaves(spark):
    """Several blocks, leaves far smaller than the table: the descent and the search find the neighbours."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.normal(size=12)]) for i in range(3000)]
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    got = results(nearest_neighbours(df, F.col("vec_id") % 20 == 0, leaf=128))
    assert recall(rows, got) >= 0.9


def test_odd_rows(spark):
    """Nulls, zeros, copies, repeated ids, other lengths, large ids and values: exact on a small table."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(c) for c in rng.normal(size=6)]) for i in range(100)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # copies of one vector, queries among them
    rows += [(20, [9.0] * 6), (20, rows[20][1]), (10_000, [1.0, 2.0]), (10_001, [3.0, 1.0]), (10_020, [1.0])]
    rows += [((1 << 53) + 1, rows[3][1]), ((1 << 53) + 8, rows[4][1]), (None, rows[5][1]), (80, None), (100, [])]
    rows += [(120, [0.0] * 6), (140, [float("nan")] * 6), (160, [1.0, None] * 3), (180, [float("inf")] * 6), (200, [1e12, -1e12] * 3)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS + ", rank string, score int").repartition(3)
    got = results(nearest_neighbours(df, F.col("vec_id") % 20 == 0))
    want = {}
    for n, near in brute(rows).items():
        for rank, hit in enumerate(near):
            want.setdefault(rows[n][0], {}).setdefault(rank + 1, []).append(hit)
    assert {q: {r: sorted(i for i, _ in x) for r, x in v.items()} for q, v in got.items()} == {
        q: {r: sorted(i for i, _ in x) for r, x in v.items()} for q, v in want.items()
    }
    assert 10_020 not in got and set(got[10_000]) == {1}


def test_hot_vector_is_ranked_through_the_broadcast_table(spark):
    rows = [(i, [1.0, 0.5]) for i in range(0, 3000)] + [(5000 + i, [1.0, 0.1 * i]) for i in range(8)]
    got = results(nearest_neighbours(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0))
    # Vectors with a larger product come first, then the smallest ids of the copies, the query left out.
    assert [got[40][r][0][0] for r in range(1, 6)] == [5007, 5006, 0, 1, 2]
    assert [got[0][r][0][0] for r in range(1, 6)] == [5007, 5006, 1, 2, 3]
    assert len(got) == 151 and len(got[2980]) == 20


def test_no_rows_and_one_row(spark):
    assert nearest_neighbours(spark.createDataFrame([], VECTORS), F.col("vec_id") % 20 == 0).collect() == []
    assert nearest_neighbours(spark.createDataFrame([(0, [1.0])], VECTORS), F.col("vec_id") % 20 == 0).collect() == []


def test_lists_keep_the_best_and_packing_round_trips():
    lists = Lists(2, 3)
    u, v, s = np.array([0, 0, 0, 1]), np.array([5, 6, 5, 9]), np.array([1.0, 2.0, 1.0, 3.0], np.float32)
    lists.merge(u, v, s)
    assert lists.ids[0, :3].tolist() == [6, 5, -1] and lists.changed == 3
    lists.merge(np.zeros(100, np.int64), np.arange(100, 200), np.arange(100, dtype=np.float32))
    assert lists.ids[0].tolist() == list(range(199, 199 - DEGREE, -1))
    again = Lists.read(lists.row().iloc[0])
    assert (again.ids == lists.ids).all() and (again.fresh == lists.fresh).all()
    for codes in ([-1, 0, 5], [1 << 40, -1], []):
        assert unpack(pack(np.array(codes, np.int64))).tolist() == codes


def test_tree_halves_and_half_precision():
    x = np.random.default_rng(1).normal(size=(1024, 8))
    leaves = Tree(x, 3, 8, 0).leaves(x)
    assert np.bincount(leaves).tolist() == [128] * 8
    half, scale = halve(x)
    assert np.abs(half.astype(float) * scale[:, None] - x).max() < 2e-3
