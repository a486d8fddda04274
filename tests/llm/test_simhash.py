from __future__ import annotations

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import SF, no_docs, odd_docs  # noqa: F401
from xxhash import xxh64_intdigest

from statflow.llm import queries, simhash


def plain_fingerprint(text, k=3):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    out = 0
    for b in range(64):
        if 2 * sum(xxh64_intdigest(s.encode(), seed=42) >> b & 1 for s in shingles) > len(shingles):
            out |= 1 << b
    return out


def plain_components(fps):
    root = list(range(len(fps)))
    arr = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.nonzero(np.bitwise_count(arr ^ arr[i]) <= 3)[0]:
            a, b = root[i], root[j]
            if a != b:
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def test_fingerprint_of_edge_texts():
    for text in (None, "", " \n", "One", "a b", "A b c", "x\x1cy É z w", "tail " * 7):
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 37}é" for i in range(500)) + "  end"
    want = plain_fingerprint(text)
    monkeypatch.setattr("statflow.llm.common.WORD_BLOCK", 101)
    assert simhash.fingerprint(text) == want


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.lists(st.integers(0, 63), max_size=3)), min_size=1, max_size=60), st.integers(0, 3))
def test_tree_loses_no_link(spec, depth):
    centres = np.random.default_rng(5).integers(0, 1 << 64, 6, dtype=np.uint64)
    pts = set()
    for c, flips in spec:
        x = int(centres[c])
        for f in flips:
            x ^= 1 << f
        pts.add(x)
    pts = np.array(sorted(pts), np.uint64)
    index, shard, home = simhash.route(pts, simhash.lay_out(pts, depth), depth, 3)
    assert sorted(index[home]) == list(range(len(pts)))
    where = {int(p): i for i, p in enumerate(pts)}
    forest = simhash._Forest(len(pts))
    for s in np.unique(shard):
        m = shard == s
        for a, b in simhash.shard_links(pts[index[m & home]], pts[index[m & ~home]], 3, bucket=2):
            assert (a ^ b).bit_count() <= 3
            forest.add(where[a], where[b])
    assert [forest.find(i) for i in range(len(pts))] == plain_components(list(map(int, pts)))


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    fps = [plain_fingerprint(t) for t in docs["text"]]
    root = plain_components(fps)
    least = {}
    for r, d in zip(root, docs["doc_id"]):
        least[r] = min(least.get(r, d), d)
    want = {(d, f"{f:016x}", least[r]) for d, f, r in zip(docs["doc_id"], fps, root)}
    got = {tuple(r) for r in queries.op2_simhash_dedup(spark, SF).collect()}
    assert got == want
    assert len({c for _, _, c in want}) < len(want)


def test_many_shards(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    few = {tuple(r) for r in simhash.near_duplicates(docs).collect()}
    many = {tuple(r) for r in simhash.near_duplicates(docs, shard=16).collect()}
    assert few == many


def test_chain_of_links(spark):
    rows, x = [], 0
    for i in range(40):
        rows.append((i, x))
        x ^= 0b111 << (3 * (i % 21))
    links = spark.createDataFrame([(rows[i][1], rows[i + 1][1]) for i in range(39)], "a long, b long")
    assert {r["root"] for r in simhash.components(links).collect()} == {0}


def test_odd_rows(spark, odd_docs, no_docs):
    got = [tuple(r) for r in simhash.near_duplicates(odd_docs).collect()]
    assert len(got) == odd_docs.count()
    zero = [g for g in got if g[1] == "0" * 16]
    assert {g[2] for g in zero} == {0}
    kept = simhash.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [0, 2, 3, 4, 7]
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.drop_near_duplicates(no_docs).count() == 0


def test_filter_keeps_one_row_of_each_component(spark):
    """Unrelated texts under one id stay apart; near copies without ids go; repeated rows count once."""
    base = " ".join(f"word{i} and{i % 17} then{i % 5}" for i in range(300))
    near = base.replace("word7 ", "word7x ")
    assert 0 < bin(simhash.fingerprint(base) ^ simhash.fingerprint(near)).count("1") <= 3
    other = " ".join(f"quite{i} different{i % 9}" for i in range(200))
    third = " ".join(f"and{i} another{i % 4}" for i in range(100))
    rows = [(5, base), (5, other), (3, near), (None, base), (None, near), (None, third), (None, third), (9, third), (9, third)]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, `a.b` int")
    kept = simhash.drop_near_duplicates(docs).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted([(3, near), (5, other), (9, third)])
    nameless = spark.createDataFrame([(None, base), (None, near), (None, other), (None, None), (None, "")], "doc_id long, text string")
    assert simhash.drop_near_duplicates(nameless).count() == 3
