from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import SF, no_docs, odd_docs  # noqa: F401
from tokenizers import Tokenizer

from statflow.llm import encode, packing, queries, token_counts

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
TEXTS = st.text(st.characters(exclude_categories=["Cs"]) | st.sampled_from(list(" \t\n\r'sSéΣß|<>0")), max_size=60)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_chunks_equal_whole_texts(text):
    whole = Tokenizer.from_file(WORDS).encode(text, add_special_tokens=False).ids if len(text) % 7 == 0 else encode.load(WORDS).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encode.chunk_encoder(WORDS)(text), "<u4").tolist() == whole


@settings(max_examples=200, deadline=None)
@given(TEXTS | st.just("a<|endoftext|> b") | st.just("՘ \U000107bb x"))
def test_pre_tokens_equal_whole_texts(text):
    tok = encode.load(BYTES)
    parts, special = token_counts.splitter(BYTES)(text)
    total = special + sum(len(tok.encode(p, add_special_tokens=False).ids) for p in parts)
    assert total == len(tok.encode(text, add_special_tokens=False).ids)


def test_plain_chunks_equal_the_library():
    """Chunks that skip the library's normaliser and split give the ids of the whole library."""
    tok = encode.load(WORDS)
    chunks = ["", "word", "Word,", "WORD!!", "a1b22", "don't", "\u00c9T\u00c9.", "\u00df\u00ff\u0178", "\u00d7\u00f7", "<|endoftext|>", "<|ENDOFTEXT|>"]
    chunks += ["x<|startoftext|>,", "H\u0331", "\u0130", "e\u0301,", "\u2126", "\u212b", "a\x0bb", "a\x85b", "\u00b5m", "\u00aa", "a\x00b", "\x7f", "#" * 300]
    got = encode._Chunks(tok)
    for chunk in chunks:
        want = tok.encode(chunk, add_special_tokens=False).ids
        assert np.frombuffer(got[chunk], "<u4").tolist() == want, chunk
        assert got[chunk] == got[chunk]


def plain_counts(docs):
    tok = Tokenizer.from_file(BYTES)
    out = []
    for d, t in zip(docs["doc_id"], docs["text"]):
        t = t or ""
        n = len(tok.encode(t, add_special_tokens=False).ids)
        out.append((d, len(t.encode()), n, n > 1024))
    return sorted(out, key=repr)


def test_token_counts_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = plain_counts(docs.toPandas())
    assert sorted((tuple(r) for r in queries.op7_token_counts(spark, SF).collect()), key=repr) == want
    few_hot = token_counts.token_counts(docs, hot=20, fit_docs=30)
    assert sorted((tuple(r) for r in few_hot.collect()), key=repr) == want


def test_token_counts_odd_rows(spark, odd_docs, no_docs):
    got = sorted((tuple(r) for r in token_counts.token_counts(odd_docs, hot=2).collect()), key=repr)
    rows = odd_docs.collect()
    assert got == plain_counts({"doc_id": [r["doc_id"] for r in rows], "text": [r["text"] for r in rows]})
    assert token_counts.token_counts(no_docs).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=12), st.integers(1, 40))
def test_fill_is_closest_to_capacity(lengths, capacity):
    counts = defaultdict(int)
    for n in lengths:
        counts[n] += 1
    chosen = packing.fill_window(dict(counts), capacity)
    assert all(chosen[n] <= counts[n] for n in chosen)
    sums = {0}
    for n in lengths:
        sums |= {s + n for s in sums if s + n <= capacity}
    assert sum(n * k for n, k in chosen.items()) == max(sums)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_every_piece_is_packed_once(lengths):
    windows = packing.pack_lengths(lengths, 50)
    assert sorted(i for w in windows for i in w) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in w) <= 50 for w in windows)


def check_pieces(rows, docs, window=4096):
    tok = Tokenizer.from_file(WORDS)
    want = sorted(
        ((d if d is not None else -9, i) for d, t in docs for i in [tuple(tok.encode(t or "", add_special_tokens=False).ids) + (2,)]),
        key=repr,
    )
    lens = defaultdict(list)
    for d, ids in want:
        lens[d].append(ids)
    seqs = defaultdict(list)
    for r in rows:
        d = r["doc_id"] if r["doc_id"] is not None else -9
        fits = [ids for ids in lens[d] if len(ids) == r["doc_tokens"]]
        assert any(
            zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"] for ids in fits
        )
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= window
    assert sum(r["length"] for r in rows) == sum(len(ids) for _, ids in want)
    return len(seqs), sum(len(ids) for _, ids in want)


def test_packing_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    n, tokens = check_pieces(queries.op10_packing(spark, SF).collect(), [tuple(r) for r in docs.collect()])
    assert n == -(-tokens // 4096)  # only one window is not full


def test_packing_odd_rows(spark, odd_docs, no_docs):
    rows = packing.pack_documents(odd_docs, block_pieces=3).collect()
    check_pieces(rows, [(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert packing.pack_documents(no_docs).count() == 0


def test_chunks_are_encoded_once(monkeypatch):
    """Upper and lower case share an entry, and a frequent chunk outlives a full table."""
    monkeypatch.setattr(encode, "MEMORY", 50)
    chunks = encode._Chunks(encode.load(WORDS))
    monkeypatch.setitem(encode._CHUNKS, WORDS, chunks)
    runs, merge = [], chunks.merge
    chunks.merge = lambda run: runs.append(run) or merge(run)
    of = encode.chunk_encoder(WORDS)
    assert of("Often") == of("OFTEN") == of("often") and runs == ["often"]
    for i in range(40):
        of("often " + " ".join(f"rare{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + k)}" for k in range(20)))
    assert runs.count("often") == 1 and len(runs) == 801
    assert len(chunks) + len(chunks.aside) < 150


@pytest.mark.parametrize("text", ["ÀÉ ß ÿ µ DON'T É'S", "ΑΣ Ÿ İ ǄÀ", "<|ENDOFTEXT|> a<|endoftext|>B", "A\u0085B\xa0C²¼ª", "".join(map(chr, range(256)))])
def test_case_and_specials_as_the_library(text):
    whole = encode.load(WORDS).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encode.chunk_encoder(WORDS)(text), "<u4").tolist() == whole
