"""Operator 8: language-model scores of whole documents.

1. Words of all training documents are counted (pre-aggregated per task): the
   exact counts c, their sum N and the number of words V.
2. A bounded vocabulary, the ``classes * members`` most frequent words, are symbols
   of their own; every other word is one of ``members`` buckets, chosen by a hash
   of its last two bytes. So P(word | state) = P(class | state) * P(member | class,
   state) * P(word | bucket), where the last factor is (c + 1) / (N_b + V_b + 1) of
   the bucket's exact counts, and 1 for words that are symbols.
3. Every text is read once into its symbols, two bytes a token, and its exact
   counts; that table in the shared folder feeds training and scoring. A gated
   recurrent network (``gru.py``) gives the first two factors. One task
   warms it up on a bounded sample of training documents (``warm_docs``), which
   only gives all replicas the same start; then every task of the training data
   trains a replica on all its documents, and the replicas are averaged by their
   numbers of tokens, in a tree, so that the driver gets ``TOP`` models at most.
4. Every document is scored with the averaged network, its state carried from the
   first token to the last. The ``HOT`` most frequent words are looked up in the
   task (a bounded table, broadcast); the counts of all others come by a join.

Defined results: a null or empty text is the end token alone. A null id hashes as
the empty string. Rows that repeat an id are scored one by one. Without training
documents N and V are 0 and the network stays as it was initialised; an empty
table gives no row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statflow.llm.common import most_frequent, split_words, stage, word_blocks
from statflow.llm.gru import Net, log_likelihoods, train

CLASSES, MEMBERS, HIDDEN = 16, 64, 16
HOT = 1 << 17
WARM_DOCS = 2000
LANES = 512
RATE = 0.1
FOLDS, HELD_OUT = 7, 2
#: Tokens that a task gathers before it runs the network over them.
BLOCK_TOKENS = 4_000_000
#: Bytes of text whose words a task looks up at once, whatever documents they are of.
LOOKUP = 1 << 23
#: Words that a task gathers before it counts them.
COUNT_WORDS = 4_000_000
#: Models that reach the driver, at most.
TOP = 16
#: The end token; no word holds a space.
END = b" "

READ = (
    "doc_id {id}, held_out boolean, n_tokens long, n_hot long, base_hot double, tail double, "
    "cold array<struct<word:binary,n:long>>, symbols binary"
)
SCORED = "row long, doc_id {id}, held_out boolean, n_tokens long, n_hot long, base_hot double, model_hot double"
#: Symbols as they are stored.
SYMBOL = np.dtype("<u2")


def bucket(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % MEMBERS


@cache
def _endings() -> np.ndarray:
    """The bucket of every one-byte word, then of every ending of two bytes."""
    one = [bytes([i]) for i in range(256)]
    return np.array([bucket(w) for w in [*one, *(x + y for x in one for y in one)]])


def buckets(words: pa.BinaryArray) -> np.ndarray:
    """``bucket`` of every word; none is empty."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset :][: len(words) + 1]
    if not len(words):
        return np.zeros(0, np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8)
    last, long = data[ends[1:] - 1].astype(np.int64), np.diff(ends) > 1
    return _endings()[np.where(long, 256 + 256 * data[np.where(long, ends[1:] - 2, 0)].astype(np.int64) + last, last)]


def bucket_column(word):
    """``bucket`` of a binary column."""
    return F.pmod(F.crc32(F.when(F.octet_length(word) > 2, F.substring(word, -2, 2)).otherwise(word)), F.lit(MEMBERS))


def held_out(id_col: str):
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == HELD_OUT


# --- counting -------------------------------------------------------------


def _blocks(texts: pa.Array, most: int) -> Iterator[tuple]:
    """(rows, whether it ends a text, words, lengths) blocks of the texts in order; a block is whole texts of
    ``most`` bytes together, or a part of one that is longer. ``lengths`` are the words of each row."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if first < row and held + size > most:
            yield np.arange(first, row), True, *split_words(texts.slice(first, row - first))
            first, held = row, 0
        held += size
        if size > most:
            for words in word_blocks(texts[row].as_py()):
                yield np.array([row]), False, pa.array(words, pa.binary()), np.array([len(words)])
            yield np.array([row]), True, pa.array([], pa.binary()), np.array([0])
            first, held = row + 1, 0
    if first < len(texts):
        yield np.arange(first, len(texts)), True, *split_words(texts.slice(first))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size, docs = [], 0, 0

    def out():
        counts = pc.value_counts(pa.chunked_array(held, pa.binary()))
        words, n = counts.field("values"), counts.field("counts")
        return pa.RecordBatch.from_pydict(
            {"word": pa.concat_arrays([words, pa.array([END], pa.binary())]), "n": pa.concat_arrays([n, pa.array([docs], pa.int64())])}
        )

    for batch in batches:
        docs += batch.num_rows
        for _, _, words, _ in _blocks(batch.column("text"), LOOKUP):
            held.append(words)
            size += len(words)
            if size > COUNT_WORDS:
                yield out()
                held, size, docs = [], 0, 0
    if docs or held:
        yield out()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) of all the texts, the end token included."""
    return (
        texts.select("text").mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))
    )


class Vocabulary:
    """The bounded tables that every task holds."""

    def __init__(self, counts: DataFrame, hot: int):
        rows = sorted(most_frequent(counts, "c", hot).collect(), key=lambda r: (-r["c"], bytes(r["word"])))
        n_symbols = CLASSES * MEMBERS
        self.words = {bytes(r["word"]): i for i, r in enumerate(rows)}
        self.c = np.array([r["c"] for r in rows], np.int64)
        top = [bytes(r["word"]) for r in rows[:n_symbols]]
        self.symbol = np.array(
            [i if i < n_symbols else n_symbols + bucket(w) for w, i in self.words.items()], np.int32
        )
        total = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
        self.n, self.v = total["n"] or 0, total["v"]
        # N_b and V_b of the buckets, from all words less the symbols.
        b = bucket_column(F.col("word")).cast("int").alias("b")
        mass, kinds = np.zeros(MEMBERS), np.zeros(MEMBERS)
        for r in counts.groupBy(b).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect():
            mass[r["b"]], kinds[r["b"]] = r["n"], r["v"]
        for w, c in zip(top, self.c):
            mass[bucket(w)] -= c
            kinds[bucket(w)] -= 1
        self.bucket_log = np.log10(mass + kinds + 1)
        # A hot word's static factor: 0 for symbols.
        self.tail_log = np.where(
            self.symbol < n_symbols, 0.0, np.log10(self.c + 1.0) - self.bucket_log[self.symbol % MEMBERS]
        ) if len(rows) else np.zeros(0)
        self.c_log = np.log10(self.c + 1.0)
        self.unigrams = np.concatenate([np.pad(self.c[:n_symbols], (0, n_symbols - len(top))), mass]).astype(np.float64)

    @property
    def base_log(self) -> float:
        return float(np.log10(self.n + self.v + 1))

    def read(self, texts: list[str | None] | pa.Array) -> dict[str, pa.Array]:
        """The columns of ``READ`` from n_tokens on, for texts with their end tokens."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        n, n_symbols = len(texts), CLASSES * MEMBERS
        n_tokens, n_hot, base, tail = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
        symbols, cold, parted = [np.zeros(0, SYMBOL)], [], False
        hot_words = pa.array(list(self.words), pa.binary())
        for rows, ends, words, lengths in _blocks(texts, LOOKUP):
            parted |= not ends
            # Each distinct word of the block is looked up once, its tokens go by its number.
            coded = words.dictionary_encode()
            distinct, codes = coded.dictionary, coded.indices.to_numpy()
            if ends:
                codes = np.insert(codes, np.cumsum(lengths), len(distinct))
                distinct = pa.concat_arrays([distinct, pa.array([END], pa.binary())])
            owner = np.repeat(rows, lengths + ends)
            at = pc.index_in(distinct, value_set=hot_words).fill_null(-1).to_numpy(zero_copy_only=False)
            hot, rare = at >= 0, np.nonzero(at < 0)[0]
            s, c_log, tail_log, bucket_log = np.zeros(len(at), SYMBOL), *np.zeros((3, len(at)))
            s[hot], c_log[hot], tail_log[hot] = self.symbol[at[hot]], self.c_log[at[hot]], self.tail_log[at[hot]]
            of_rare = buckets(distinct.take(pa.array(rare)))
            s[rare], bucket_log[rare] = n_symbols + of_rare, self.bucket_log[of_rare]
            symbols.append(s[codes])
            is_hot = hot[codes]
            place = np.nonzero(~is_hot)[0]
            by, kind = owner[place], codes[place]
            n_tokens += np.bincount(owner, minlength=n)
            n_hot += np.bincount(owner, is_hot, n).astype(np.int64)
            base += np.bincount(owner, c_log[codes], n)
            tail += np.bincount(owner, tail_log[codes], n) - np.bincount(by, bucket_log[kind], n)
            # One entry for each rare word of a text, in the order of first places.
            _, head, times = np.unique(by * len(at) + kind, return_index=True, return_counts=True)
            order = np.argsort(head)
            head = head[order]
            cold.append((by[head], distinct.take(pa.array(kind[head])), times[order]))
        of = np.concatenate([np.zeros(0, np.int64), *(c[0] for c in cold)])
        found = pa.concat_arrays([pa.array([], pa.binary()), *(c[1] for c in cold)])
        times = np.concatenate([np.zeros(0, np.int64), *(c[2] for c in cold)])
        if parted:  # a long text's parts may share words
            merged: dict = {}
            for key, k in zip(zip(of.tolist(), found.to_pylist()), times.tolist()):
                merged[key] = merged.get(key, 0) + k
            of, found = np.array([row for row, _ in merged], np.int64), pa.array([w for _, w in merged], pa.binary())
            times = np.array(list(merged.values()), np.int64)
        width = SYMBOL.itemsize
        starts = np.concatenate([[0], np.cumsum(n_tokens) * width]).astype(np.int64)
        stored = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), n, [None, pa.py_buffer(starts), pa.py_buffer(np.concatenate(symbols))])
        pairs = pa.StructArray.from_arrays([found, pa.array(times)], names=["word", "n"])
        bounds = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))]).astype(np.int32)
        return {
            "n_tokens": pa.array(n_tokens),
            "n_hot": pa.array(n_hot),
            "base_hot": pa.array(base - n_tokens * self.base_log),
            "tail": pa.array(tail),
            "cold": pa.ListArray.from_arrays(pa.array(bounds), pairs),
            "symbols": stored.cast(pa.binary()),
        }

    def new_net(self) -> Net:
        net = Net(CLASSES + 1, MEMBERS, HIDDEN)
        net.set_unigrams(self.unigrams)
        return net


# --- training -------------------------------------------------------------


def _lanes(docs: int) -> int:
    return max(1, min(LANES, docs // 8))


def _train(vocabulary, start, passes: int):
    """One row per task: the number of tokens and the parameters its replica ends with."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary.value
        net = v.new_net()
        if start is not None:
            _load(net, start.value)
        held, size, tokens = [], 0, 0

        def run():
            for _ in range(passes):
                train(net, held, _lanes(len(held)), RATE)

        for batch in batches:
            for symbols in batch.column("symbols").to_pylist():
                held.append(np.frombuffer(symbols, SYMBOL))
                size += len(held[-1])
                if size >= BLOCK_TOKENS:
                    run()
                    tokens, held, size = tokens + size, [], 0
        if held:
            run()
            tokens += size
        if tokens:
            model = np.concatenate([a.ravel() for a in [*net.p.values(), *net.g2.values()]]).astype("<f4")
            yield pa.RecordBatch.from_pydict(
                {
                    "task": pa.array([TaskContext.get().partitionId()], pa.int64()),
                    "tokens": pa.array([float(tokens)], pa.float64()),
                    "model": pa.array([model.tobytes()], pa.binary()),
                }
            )

    return of


def _load(net: Net, flat: bytes) -> None:
    values, at = np.frombuffer(flat, "<f4"), 0
    for a in [*net.p.values(), *net.g2.values()]:
        a[...] = values[at : at + a.size].reshape(a.shape)
        at += a.size


MODEL = "task long, tokens double, model binary"


def _average(key: tuple, models: pd.DataFrame) -> pd.DataFrame:
    """The mean of a group's models, weighted by their tokens."""
    total = float(models["tokens"].sum())
    mean = sum(np.frombuffer(m, "<f4").astype(np.float64) * (t / total) for m, t in zip(models["model"], models["tokens"]))
    return pd.DataFrame([(int(key[0]), total, mean.astype("<f4").tobytes())], columns=["task", "tokens", "model"])


def train_network(training: DataFrame, vocabulary, warm: DataFrame) -> bytes | None:
    """The averaged parameters, or None without training documents."""
    spark = training.sparkSession
    first = warm.select("symbols").repartition(1).mapInArrow(_train(vocabulary, None, 2), MODEL).collect()
    start = spark.sparkContext.broadcast(bytes(first[0]["model"])) if first else None
    models = stage(training.select("symbols").mapInArrow(_train(vocabulary, start, 1), MODEL), "lm-replicas")
    fan = max(TOP, int(np.ceil(np.sqrt(max(1, models.count())))))
    for groups in (fan, TOP):
        grouped = models.withColumn("g", F.pmod("task", F.lit(groups))).groupBy("g")
        models = grouped.applyInPandas(_average, MODEL)
    rows = models.collect()
    if not rows:
        return None
    top = _average((0,), pd.DataFrame([(bytes(r["model"]), r["tokens"]) for r in rows], columns=["model", "tokens"]))
    return top["model"][0]


# --- reading and scoring ----------------------------------------------------


def _read(vocabulary):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Some texts at a time, as a batch is bounded in rows only.
            held = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
            cuts = np.nonzero(np.diff(held // LOOKUP))[0] + 1
            for first, last in pairwise([0, *cuts.tolist(), batch.num_rows]):
                part = batch.slice(first, last - first)
                found = vocabulary.value.read(part.column("text"))
                kept = {name: part.column(name) for name in ("doc_id", "held_out")}
                yield pa.RecordBatch.from_pydict(kept | found)

    return of


def _score(vocabulary, model):
    passed = ["row", "doc_id", "held_out", "n_tokens", "n_hot", "base_hot"]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = vocabulary.value.new_net()
        if model.value is not None:
            _load(net, model.value)

        def run(parts: list[pa.RecordBatch], docs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(parts)
            logs = log_likelihoods(net, docs, LANES) + table.column("tail").to_numpy()
            out = table.select(passed).append_column("model_hot", pa.array(logs, pa.float64()))
            yield from out.to_batches()

        parts, docs, size = [], [], 0
        for batch in batches:
            found = [np.frombuffer(x, SYMBOL) for x in batch.column("symbols").to_pylist()]
            parts.append(batch.select([*passed, "tail"]))
            docs += found
            size += sum(map(len, found))
            if size >= BLOCK_TOKENS:
                yield from run(parts, docs)
                parts, docs, size = [], [], 0
        if docs:
            yield from run(parts, docs)

    return of


def lm_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, warm_docs: int = WARM_DOCS
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per row of ``docs``."""
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    id_type = slim.schema["doc_id"].dataType.simpleString()
    training = slim.where(~F.col("held_out"))
    counts = stage(word_counts(training), "word-counts")
    tables = Vocabulary(counts, hot)
    vocabulary = spark.sparkContext.broadcast(tables)
    read = slim.mapInArrow(_read(vocabulary), READ.format(id=id_type))
    read = stage(read.withColumn("row", F.monotonically_increasing_id()), "lm-symbols")
    learned = read.where(~F.col("held_out"))
    share = min(1.0, warm_docs / max(1, learned.count()))
    warm = learned.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    model = spark.sparkContext.broadcast(train_network(learned, vocabulary, warm))
    scored = read.drop("cold").mapInArrow(_score(vocabulary, model), SCORED.format(id=id_type))
    cold = read.select("row", F.explode("cold").alias("w")).select("row", "w.word", "w.n")
    sums = (
        cold.join(counts, "word")
        .groupBy("row")
        .agg(F.sum("n").alias("n_cold"), F.sum(F.col("n") * F.log10(F.col("c") + F.lit(1.0))).alias("log_cold"))
    )
    zero = F.lit(0.0)
    return (
        scored.join(sums, "row", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_hot") + F.coalesce("n_cold", F.lit(0))).alias("n_known"),
            F.lit(tables.n).cast("long").alias("train_tokens"),
            (F.col("base_hot") + F.coalesce("log_cold", zero)).alias("base_score"),
            (F.col("model_hot") + F.coalesce("log_cold", zero)).alias("score"),
        )
    )
