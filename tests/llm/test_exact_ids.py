"""Ids beyond 2**53 stay exact, also where another row of the batch has none."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from statflow.llm import chat, packing, simhash, token_counts, warc

A, B = (1 << 53) + 1, (1 << 53) + 3
SAME = "the very same words in both of these documents, " * 4


def docs(spark):
    return spark.createDataFrame([(A, SAME), (None, "no id"), (B, SAME), (-B, None)], "doc_id long, text string").coalesce(1)


def test_pages(spark):
    pages = spark.createDataFrame([(A, "a", SAME), (None, "n", "x"), (B, "b", SAME)], "page_id long, url string, html string").coalesce(1)
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.page_round_trip(pages).collect()}
    assert got == {A: ("response", None), B: ("revisit", A), None: ("response", None)}


def test_documents(spark):
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs(spark)).collect()}
    assert found == {A: A, B: A, None: None, -B: -B}
    assert {r["doc_id"] for r in token_counts.token_counts(docs(spark)).collect()} == {A, B, -B, None}
    assert {r["doc_id"] for r in packing.pack_documents(docs(spark)).collect()} == {A, B, -B, None}


def test_conversations(spark):
    rows = [(A, A, "user", "x"), (None, None, None, None), (A, B, "assistant", "y"), (B, 0, "user", "z")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1)
    formatted = chat.format_conversations(turns)
    assert {(r["conv_id"], r["turn"]) for r in formatted.select("conv_id", F.col("turn")).collect()} == {(A, A), (None, None), (A, B), (B, 0)}
    got = {r["conv_id"]: r["turns_sha256"] for r in chat.read_back(formatted).collect()}
    assert got[A] == hashlib.sha256(b"user\nx\nassistant\ny\n").hexdigest() and set(got) == {A, B, None}
