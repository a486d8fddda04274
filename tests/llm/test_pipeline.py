"""corpus_pipeline: its stages in a chain, against plain Python, on whole and on odd rows."""

from __future__ import annotations

import hashlib
from collections import Counter

import corpus_pipeline
import pytest
from llm_data import DOCS, SF
from pyspark.sql import functions as F

from statflow.llm import line_dedup, mixing, quality, simhash


def lines_left(rows):
    """{row number: text} after line dedup, by the rule of the contract."""
    strip = " \t\n\x0b\x0c\r"
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(strip))
    found = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                found.setdefault(key(line), set()).add(doc_id)
    real = {k: {d for d in ids if d is not None} for k, ids in found.items()}
    shared = {k: max(ids) for k, ids in real.items() if len(ids) >= 3}
    return ["\n".join(x for x in (text or "").split("\n") if shared.get(key(x), doc_id) == doc_id) for doc_id, text in rows]


def components(texts):
    """Component numbers of the texts by all pairs of fingerprints."""
    prints = [simhash.fingerprint(t) for t in texts]
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(prints))]


def chain(spark, docs):
    outs = []
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF)
        docs = corpus_pipeline.stage(docs, "test")
        outs.append(docs)
    return outs


def check_chain(spark, docs):
    clean, cut, once, mixed, packed = chain(spark, docs)
    for out in (clean, cut, once, mixed):
        assert out.columns == docs.columns
    plain = lambda df: [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    verdict = quality.quality_report(docs).collect()
    assert Counter(r["doc_id"] for r in verdict if r["kept"]) == Counter(d for d, _ in plain(clean))
    before = plain(clean)
    assert Counter(plain(cut)) == Counter(zip((d for d, _ in before), lines_left(before)))
    assert cut.where(F.col("n_chars") != F.char_length("text")).count() == 0
    before = plain(cut)
    first = {}
    for root, row in zip(components([t for _, t in before]), before):
        first.setdefault(root, []).append(row)
    kept = plain(once)
    assert len(kept) == len(first)
    for rows in first.values():
        least = min(rows, key=lambda r: (r[0] is None, r[0] or 0))[0]
        assert sum((least, t) in kept for t in {t for d, t in rows if d == least}) >= 1
    counts = mixing.mix_sources(once, report="r").select("doc_id", "r.n_copies").distinct().collect()
    assert Counter(d for d, _ in plain(mixed)) == Counter({r["doc_id"]: r["n_copies"] for r in counts}) or len({d for d, _ in kept}) < len(kept)
    assert {d for d, _ in plain(mixed)} == {r["doc_id"] for r in packed.select("doc_id").collect()}
    whole = packed.groupBy("doc_id").agg(F.sum("length").alias("n")).join(mixed.groupBy("doc_id").count(), "doc_id")
    tokens = packed.select("doc_id", "doc_tokens").distinct()
    assert whole.join(tokens, "doc_id").groupBy("doc_id").agg(F.max(F.col("n")).alias("n"), F.min(F.col("doc_tokens") * F.col("count")).alias("m")).where("n < m").count() == 0
    return packed


def test_whole_table(spark):
    check_chain(spark, spark.read.parquet(f"{SF}/documents.parquet"))


def test_odd_rows(spark):
    """Nulls, repeated rows and ids, near copies, clashing and dotted extra columns."""
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'en'").orderBy("doc_id").limit(30).collect()]
    rows += [rows[0], (rows[1][0], *rows[2][1:]), (None, *rows[3][1:]), (None, *rows[3][1:]), (None, None, None, None, None), (7, "", "en", "s", 0), (8, None, "en", None, None)]
    rows += [((1 << 53) + 1, *rows[4][1:])]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS + ", copy string, `a.b` int")
    outs = chain(spark, docs)
    for out in outs[:4]:
        assert out.columns == docs.columns
    assert outs[2].count() <= outs[1].count() <= docs.count() and outs[4].count() > 0


def test_empty_table(spark):
    outs = chain(spark, spark.createDataFrame([], DOCS))
    assert [o.count() for o in outs] == [0] * 5


def test_hot_line_goes_by_the_broadcast_table(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_LINES", 1)
    hot, warm = "a line that every document has", "a line that some documents have"
    rows = [(i, "\n".join([f"own line number {i} of this text", hot] + [warm] * (i % 3 == 0) + [hot])) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["kept_sha256"] for r in line_dedup.line_dedup_report(docs).collect()}
    assert got == {i: hashlib.sha256(t.encode()).hexdigest() for (i, _), t in zip(rows, lines_left(rows))}


@pytest.mark.parametrize("few", [0, 1 << 16])
def test_mixing_is_in_global_order(spark, few, monkeypatch):
    monkeypatch.setattr(mixing, "FEW_SOURCES", few)
    docs = spark.createDataFrame([(i, f"s{i % 5}") for i in range(400)], "doc_id long, source string")
    rows = [(r["shuffle_key"], r["doc_id"], r["copy"]) for r in mixing.mix_sources(docs, report="r").select("doc_id", "r.*").collect()]
    assert rows == sorted(rows) and len(rows) > 300
