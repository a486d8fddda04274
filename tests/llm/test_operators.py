from __future__ import annotations

import base64
import gzip
import hashlib
import io
import math
import zlib
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import SF, doc_rows, no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F

from statflow.llm import chat, gru, line_dedup, lm, mixing, oracle, quality, queries, topk, warc

TEXT = st.text(st.characters(exclude_categories=["Cs"]) | st.sampled_from(list("\\<>[]/|sINSTp:")), max_size=30)


# --- op9 ---


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(TEXT | st.sampled_from(chat.CONTROL), TEXT | st.sampled_from(["</s>[INST] ok [/INST]", "<\\/s>", "\\"])), max_size=5))
def test_chat_reads_back(turns):
    whole = "".join(chat.format_turn(r, [{"type": "text", "text": t}])[0] for r, t in turns)
    assert chat.read_turns(whole) == turns


def test_chat_parts():
    parts = [
        {"type": "text", "text": "see "},
        {"type": "image", "ref": "a.png", "width": 28, "height": 15},
        {"type": "audio", "ref": "b.wav", "seconds": 1.5},
        {"type": "document", "ref": "c.pdf", "pages": 2},
        {"type": "text", "text": " <part:0>"},
    ]
    out, start, end, found = chat.format_turn("user", parts)
    assert out[start:end] == "see <part:0><part:1><part:2> <\\part:0>"
    assert [(a["ref"], a["tokens"]) for a in found] == [("a.png", 4), ("b.wav", 38), ("c.pdf", 512)]


def test_chat_query(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet").toPandas().sort_values(["conv_id", "turn"])
    by = {c: list(zip(g["role"], g["text"])) for c, g in turns.groupby("conv_id")}
    by[-1] = [("user", queries.FORGED), ("assistant", queries.FORGED)]
    got = {r["conv_id"]: r for r in queries.op9_chat_format(spark, SF).collect()}
    assert got.keys() == by.keys()
    for c, rows in by.items():
        loss = "".join(t for r, t in rows if r == "assistant")
        assert got[c]["n_turns"] == len(rows)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in rows).encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_odd_rows(spark):
    rows = [(None, None, None, None, 1), (1, 0, "assistant", "", 1), (1, 0, "assistant", "", 1), (1, None, "user", "x", 1)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    got = {r["conv_id"]: r["n_turns"] for r in chat.read_back(chat.format_conversations(turns)).collect()}
    assert got == {None: 1, 1: 3}
    assert chat.read_back(chat.format_conversations(turns.limit(0))).count() == 0


# --- op3 ---


def test_archive_is_one_member_per_record():
    blocks = [b"", b"x" * 1_000_000, "é\r\n\r\n".encode() * 9]
    data = b"".join(warc.record_bytes([("WARC-Block-Digest", "sha256:" + hashlib.sha256(b).hexdigest())], b) for b in blocks)
    read = list(warc.read_records(io.BytesIO(data)))
    assert [r.block for r in read] == blocks and all(r.digest_ok for r in read)
    assert gzip.decompress(data[read[1].position : read[2].position]).startswith(b"WARC/1.1\r\n")
    bad = warc.record_bytes([("WARC-Block-Digest", "sha256:0")], b"y")
    assert not next(warc.read_records(io.BytesIO(bad))).digest_ok
    with pytest.raises(EOFError):
        list(warc.read_records(io.BytesIO(data[:-5])))


def test_warc_odd_rows(spark):
    same = "z" * 100
    rows = [(3, "u", same), (1, None, same), (2, "a\nb", same), (None, "n", same), (4, "", None), (5, "q", ""), (6, "s", "z" * 99), (7, "s", "z" * 99), (1, None, same)]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, digest int")
    got = Counter((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.page_round_trip(pages).collect())
    assert got == Counter(
        [(3, 100, "revisit", 1), (1, 100, "response", None), (1, 100, "response", None), (2, 100, "revisit", 1), (None, 100, "revisit", 1)]
        + [(4, 0, "response", None), (5, 0, "response", None), (6, 99, "response", None), (7, 99, "response", None)]
    )
    assert warc.page_round_trip(pages.limit(0)).count() == 0


# --- op1 ---


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**31), st.integers(1, 150), st.integers(1, 6), st.integers(0, 5), st.sampled_from([2, 300, 70000]))
def test_bit_sliced_search_is_exact(seed, n, dim, drop, size):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-size, size + 1, (n, dim)).astype(np.int32)
    ids = rng.permutation(3 * n)[:n]
    ids.sort()
    query = rng.integers(-size, size + 1, dim).astype(np.int64)
    block = topk.Block(ids, vectors, topk.slice_block(vectors, drop), drop)
    exact = vectors.astype(np.int64) @ query
    own = int(ids[0])
    want = sorted(((-int(s), int(i)) for i, s in zip(ids, exact) if i != own))[:10]
    assert [(-s, i) for i, s in block.search(own, query, 10)] == want


def test_top_k_ranks_wide_vectors(spark):
    """Components beyond 65,536 count, as query and as candidate; checked by Fractions over all pairs."""
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 1, 4).tolist()) for i in range(60)]
    rows += [(100, [70000.0, 0.0, -1.0, 0.5]), (101, [70000.0, 0.0, 0.0, 0.0]), (102, [8e15, 1.0, 0.0, 0.0])]
    rows += [(103, [-3e12, 3e12, 0.001, 2.0]), (104, [65536.0, 1.0, 1.0, 1.0]), (105, [9e15, 9e15 + 2, -9e15, 1.0])]
    # Rows that repeat an id are candidates and queries of their own.
    rows += [(7, [90000.0, 0.0, 0.0, 0.0]), (8, [-90000.0, 0.0, 0.0, 0.0])]
    rows += [(200, [float("inf"), 0.0, 0.0, 0.0]), (201, [70000.0, None, 0.0, 0.0]), (202, [70000.0]), (203, [1e16, 0.0, 0.0, 0.0])]
    rows += [(204, [1e300, -1e300, 1.0, 0.0]), (205, [-1e300, -1e300, 5e-324, 0.0]), (10, [3.0, -70000.0, 1.0, 1.0]), (10, [3.0, -70000.0, 1.0, 1.0])]
    real = [(i, [math.floor(Fraction(x) * 1024) for x in v]) for i, v in rows if i not in (200, 201, 202)]
    want = []
    for m, (q, u) in enumerate(real):
        if q % 5 == 0:
            scores = sorted((-sum(a * b for a, b in zip(u, w)), i) for n, (i, w) in enumerate(real) if n != m)
            want += [(q, n + 1, i, -s if abs(s) < 1 << 63 else None) for n, (s, i) in enumerate(scores[:10])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, block_rows=16, chunk_queries=4).collect()
    order = lambda r: (*r[:3], r[3] is None, r[3] or 0)
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)


def test_top_k_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [0.5, 0.5]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, []), (8, [1.0]), (None, [9.0, 9.0]), (9, [1e30, 0.0])]
    df = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<float>, score int")
    got = [tuple(r) for r in topk.top_k(df, F.col("vec_id") % 100 == 0, block_rows=2, chunk_queries=1).orderBy("query_id", "rank").collect()]
    a, h = 1024 * 1024, 512 * 1024
    assert got == [(0, 1, 9, None), (0, 2, 1, a), (0, 3, 2, a), (0, 4, 2, a), (0, 5, 100, h)] + [
        (100, 1, 9, None), (100, 2, 0, h), (100, 3, 1, h), (100, 4, 2, h), (100, 5, 2, h)]
    assert topk.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


# --- op8 ---


def test_gradient():
    net = gru.Net(3, 4, 5)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64) + np.random.default_rng(1).normal(0, 0.3, net.p[k].shape)
    docs = [np.array([1, 5, 11, 2]), np.array([7, 0])]
    (_, x, y, begin, doc), = gru.windows(docs, 2, net.start, 4)
    real = (doc >= 0).reshape(-1)

    def loss():
        hs, _ = net.recur(np.zeros((2, 5)), x, begin)
        return -net.output(hs.reshape(-1, 5).astype(np.float64)[real], y.reshape(-1)[real])[0].sum()

    tape, grads = [], {}
    hs, _ = net.recur(np.zeros((2, 5)), x, begin, tape)
    d = np.zeros((8, 5))
    _, d[real] = net.output(hs.reshape(-1, 5).astype(np.float64)[real], y.reshape(-1)[real], grads)
    net.back(tape, begin, x, d.reshape(4, 2, 5), grads)
    for k, at in (("U", (1, 3)), ("Wc", (2, 1)), ("bm", (1, 1)), ("b", (7,))):
        keep = net.p[k][at]
        net.p[k][at] = keep + 1e-2
        up = loss()
        net.p[k][at] = keep - 1e-2
        down = loss()
        net.p[k][at] = keep
        assert abs((up - down) / 2e-2 - grads[k][at]) < 2e-2 * max(1, abs(grads[k][at]))


def test_state_is_carried_over_windows():
    net = gru.Net(2, 4, 3)
    doc = np.arange(40) % 8
    whole = gru.log_likelihoods(net, [doc, doc[:3], doc[:17]], 2)
    assert np.allclose(whole, [gru.log_likelihoods(net, [d], 1)[0] for d in (doc, doc[:3], doc[:17])], rtol=1e-4)


def test_scoring_prepares_the_weights_once(monkeypatch):
    """Bounds and input weights follow from the parameters alone, so scoring asks for them once."""
    asked = Counter()
    for name in ("bounds", "inputs"):
        of = getattr(gru.Net, name)
        monkeypatch.setattr(gru.Net, name, lambda net, of=of, name=name: asked.update([name]) or of(net))
    gru.log_likelihoods(gru.Net(2, 4, 3), [np.arange(200) % 8, np.arange(50) % 8], 2)
    assert asked == {"bounds": 1, "inputs": 1}


def test_large_weights_do_not_overflow():
    net = gru.Net(2, 4, 3)
    net.p["bm"][1, 2], net.p["bc"][0] = 500, 300
    logs = gru.log_likelihoods(net, [np.array([6, 1, 5])], 1)
    assert np.isfinite(logs).all() and logs[0] < -100


def test_lm_query(spark, odd_docs, no_docs):  # noqa: F811
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    got = {r["doc_id"]: r for r in queries.op8_lm_score(spark, SF).collect()}
    words = {d: t.encode().lower().split() + [lm.END] for d, t in zip(docs["doc_id"], docs["text"])}
    out = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in words}
    c = Counter(w for d, ws in words.items() if not out[d] for w in ws)
    n, v = sum(c.values()), len(c)
    better = 0
    for d, ws in words.items():
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out[d], len(ws), sum(w in c for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(np.log10((c[w] + 1) / (n + v + 1)) for w in ws))
        better += out[d] and r["score"] > r["base_score"]
    assert better > 0.8 * sum(out.values())
    assert lm.lm_scores(odd_docs.drop("n_words")).count() == odd_docs.count()
    assert lm.lm_scores(no_docs).count() == 0


# --- op4, op5, op6 on odd rows, against the SQL ---


@pytest.mark.parametrize("name,report", [("op5_quality_rules", quality.quality_report), ("op6_line_dedup", line_dedup.line_dedup_report)])
def test_reports_on_odd_rows(spark, odd_docs, no_docs, name, report):  # noqa: F811
    con = duckdb.connect()
    documents = odd_docs.where("doc_id is not null").toPandas()  # noqa: F841
    want = con.execute(oracle.oracle_sql()[name]).df()
    got = report(odd_docs.where("doc_id is not null")).toPandas()[list(want.columns)]
    key = lambda df: sorted(map(str, df.astype(str).values.tolist()))
    assert key(got) == key(want)
    assert report(odd_docs).count() == odd_docs.count() and report(no_docs).count() == 0


def test_filters_keep_columns(spark, odd_docs, no_docs):  # noqa: F811
    kept = quality.quality_filter(odd_docs)
    assert kept.columns == odd_docs.columns and quality.quality_filter(no_docs).count() == 0
    cut = line_dedup.line_dedup(odd_docs)
    assert cut.columns == odd_docs.columns and cut.count() == odd_docs.count()


def test_shared_lines(spark):
    line = "  A line that Many documents share "
    texts = [f"{line}\nown {i}\n{line.upper()}" for i in range(3)] + ["A line that many\tdocuments share"]
    got = [r["text"] for r in line_dedup.line_dedup(spark.createDataFrame(doc_rows(texts), "doc_id long, text string, lang string, source string, n_chars long")).orderBy("doc_id").collect()]
    assert got == ["own 0", "own 1", texts[2], texts[3]]


def test_mixing(spark, odd_docs, no_docs):  # noqa: F811
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 15000, "big").when(F.col("id") < 19999, "small").alias("source"))
    got = mixing.mix_sources(docs, weights={"big": 1, "small": 1}, report="r")
    by = {r["source"]: r["count"] for r in got.groupBy("source").count().collect()}
    assert abs(by["big"] - 10000) < 400 and abs(by["small"] - 10000) < 500 and None not in by
    keys = [r["k"] for r in got.select(F.col("r.shuffle_key").alias("k")).collect()]
    assert keys == sorted(keys)
    large = mixing.mix_sources(docs.where("doc_id < 300"), total=300 * 100).groupBy("doc_id").count()
    mean, spread = large.agg(F.avg("count"), F.var_samp("count")).first()
    assert abs(mean - 100) < 3 and 70 < spread < 140
    assert mixing.mix_sources(odd_docs).columns == odd_docs.columns and mixing.mix_sources(no_docs).count() == 0


def test_source_mix_documents_carry_their_columns(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.queries()["op4_source_mix_documents"](spark, SF).collect()
    ids = queries.op4_source_mix(spark, SF).collect()
    assert got and [(r["doc_id"], r["copy"]) for r in got] == [(r["doc_id"], r["copy"]) for r in ids]
    assert all(r[c] == docs[r["doc_id"]][c] for r in got for c in ("text", "lang", "source", "n_chars"))


def _member(text: bytes) -> bytes:
    return gzip.compress(text)


def test_warc_of_other_writers():
    """Older versions, header names in any case, values without a space, folded lines, SHA-1 digests."""
    block = b"hello"
    sha1 = base64.b32encode(hashlib.sha1(block).digest())
    data = (
        _member(b"WARC/1.0\r\nwarc-type:warcinfo\r\ncontent-length:5\r\nX-Note: a\r\n\t b:c\r\n\r\nhello\r\n\r\n")
        + _member(b"WARC/0.18\r\nWARC-Block-Digest: sha1:" + sha1 + b"\r\nCONTENT-LENGTH:  5\r\n\r\nhello\r\n\r\n")
        + _member(b"WARC/1.1\r\nWARC-Block-Digest: sha1:AAAA\r\nContent-Length: 0\r\nX-Note: \xff\r\n\r\n\r\n\r\n")
        + _member(b"WARC/1.1\r\nWARC-Block-Digest: crc:1\r\nContent-Length: 2\r\n\r\n\r\n\r\n\r\n")
    )
    read = list(warc.read_records(io.BytesIO(data)))
    assert [(r.block, r.digest_ok) for r in read] == [(block, None), (block, True), (b"", False), (b"\r\n", None)]
    assert read[0].headers == {"warc-type": "warcinfo", "content-length": "5", "x-note": "a b:c"}
    for bad in (b"HTTP/1.1 200\r\nContent-Length: 0\r\n\r\n\r\n\r\n", b"WARC/1.0\r\nX: 1\r\n\r\n\r\n\r\n", b"WARC/1.0\r\nContent-Length: -1\r\n\r\n\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.read_records(io.BytesIO(_member(bad))))


def test_attachments_are_read_back(spark):
    """Placeholders of the output lead to their attachments; texts that spell one out do not."""
    part = lambda kind, **f: tuple([kind] + [f.get(n) for n in ("text", "ref", "width", "height", "seconds", "pages")])
    rows = [
        (1, 0, "user", None, [part("text", text="see <part:7>"), part("image", ref="a", width=28, height=15), part("text", text="!")]),
        (1, 1, "assistant", "<part:0>", None),
        (2, 0, "user", None, [part("audio", ref="b", seconds=1.5), part("document", pages=2), part("other"), None]),
        (3, None, None, None, []),
    ]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, text string, parts {chat.PARTS}")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(turns)).collect()}
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert [(got[k]["n_attachments"], got[k]["expanded_tokens"]) for k in (1, 2, 3)] == [(1, 4), (3, 38 + 512), (0, 0)]
    assert got[1]["attachments_sha256"] == digest("image\ta\t4\n")
    assert got[2]["attachments_sha256"] == digest("audio\tb\t38\ndocument\t\t512\nother\t\t0\n")
    assert got[1]["turns_sha256"] == digest("user\nsee <part:7><part:0>!\nassistant\n<part:0>\n")
    assert got[1]["loss_sha256"] == digest("<part:0>") and got[3]["turns_sha256"] == digest("\n\n")


def test_lm_reads_texts_in_pieces(monkeypatch):
    """Documents looked up together, cut at any word, give the columns of each one alone."""
    import numpy as np
    from statflow.llm import lm

    v = lm.Vocabulary.__new__(lm.Vocabulary)
    v.words, v.c = {b"a": 0, b" ": 1, b"bb": 2}, np.array([5, 4, 3])
    v.symbol = np.array([0, 1, lm.CLASSES * lm.MEMBERS + lm.bucket(b"bb")], np.int32)
    v.n, v.v, v.bucket_log = 12, 3, np.arange(lm.MEMBERS) / 7.0
    v.c_log, v.tail_log = np.log10(v.c + 1.0), np.array([0.0, 0.0, -0.5])
    texts = ["a bb zz A zz y", None, "", "x y x", "bb " * 9]
    alone = [{k: c.to_pylist()[0] for k, c in v.read([t]).items()} for t in texts]
    assert alone[0]["n_tokens"] == 7 and alone[0]["n_hot"] == 4
    assert alone[0]["cold"] == [{"word": b"zz", "n": 2}, {"word": b"y", "n": 1}]
    monkeypatch.setattr(lm, "LOOKUP", 3)
    together = v.read(texts)
    for name, column in together.items():
        want = [row[name] for row in alone]
        assert column.to_pylist() == (pytest.approx(want) if name in ("base_hot", "tail") else want), name
    assert all(len(column) == 0 for column in v.read([]).values())


ODD_TEXTS = ["  The the\tTHE ", None, "", " \n", "a\x1cb c\x85d e", "ÀB àb\x0b\x0cß", "x y x", "w" * 40, "q " * 30 + "r"]


def test_lm_words_of_many_texts():
    """Arrow splits at the same white space as ``word_blocks``, whatever lies at a text's ends."""
    from statflow.llm.common import split_words, word_blocks

    for texts in (ODD_TEXTS, [], [None], ["z", " "]):
        want = [[w for some in word_blocks(t) for w in some] for t in texts]
        for kind in (pa.string(), pa.large_string()):
            words, lengths = split_words(pa.array(["cut off", *texts], kind)[1:])
            assert words.to_pylist() == [w for some in want for w in some]
            assert lengths.tolist() == [len(some) for some in want]


def test_lm_counts_in_parts(monkeypatch):
    """Counts are the same however texts and words are gathered; every text has one end token."""
    want = Counter(w for t in ODD_TEXTS if t for w in t.encode().lower().split()) + Counter({lm.END: len(ODD_TEXTS)})
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(t, pa.string())}) for t in (ODD_TEXTS[:4], [], ODD_TEXTS[4:])]
    for lookup, gathered in ((1 << 23, 4_000_000), (5, 3), (20, 0)):
        monkeypatch.setattr(lm, "LOOKUP", lookup)
        monkeypatch.setattr(lm, "COUNT_WORDS", gathered)
        got = Counter()
        for out in lm._count_words(iter(batches)):
            for word, n in zip(*out.to_pydict().values()):
                got[word] += n
        assert got == want


def test_lm_looks_each_word_up_once(monkeypatch):
    """A word that comes many times, in any text of a block, is looked up once."""
    v = lm.Vocabulary.__new__(lm.Vocabulary)
    v.words, v.c, v.symbol = {b"a": 0}, np.array([5]), np.array([0], np.int32)
    v.n, v.v, v.bucket_log, v.c_log, v.tail_log = 9, 3, np.zeros(lm.MEMBERS), np.log10([6.0]), np.zeros(1)
    asked, of = [], lm.buckets
    monkeypatch.setattr(lm, "buckets", lambda words: asked.extend(words.to_pylist()) or of(words))
    found = v.read(["a x yy " * 50, "yy a zzz"])
    assert sorted(asked) == [lm.END, b"x", b"yy", b"zzz"]
    assert of(pa.array([b"cut", *asked], pa.binary())[1:]).tolist() == [lm.bucket(w) for w in asked]
    assert found["n_hot"].to_pylist() == [50, 1] and found["n_tokens"].to_pylist() == [151, 4]
    assert found["cold"].to_pylist()[1] == [{"word": w, "n": 1} for w in (b"yy", b"zzz", lm.END)]


def test_lm_reads_long_texts_in_parts(monkeypatch):
    """The parts of a text longer than a block share their words' entries."""
    from statflow.llm import common

    v = lm.Vocabulary.__new__(lm.Vocabulary)
    v.words, v.c, v.symbol = {b"a": 0}, np.array([5]), np.array([0], np.int32)
    v.n, v.v, v.bucket_log, v.c_log, v.tail_log = 9, 3, np.arange(lm.MEMBERS) / 7.0, np.log10([6.0]), np.zeros(1)
    texts = ["b a", "b a c " * 20 + "b", None, "c a"]
    whole = v.read(texts)
    monkeypatch.setattr(lm, "LOOKUP", 8)
    monkeypatch.setattr(common, "WORD_BLOCK", 16)
    parts = v.read(texts)
    for name, column in whole.items():
        want = column.to_pylist()
        assert parts[name].to_pylist() == (pytest.approx(want) if name in ("base_hot", "tail") else want), name
