"""Log-bilinear language model trained with noise-contrastive estimation, and a unigram base.

The corpus is coded once: chunks of documents hold a list of their distinct words and each text as
numbers of that list. Word counts over all training texts come from the chunks' lists; every chunk
gets the counts of its own words back by joins. The model predicts the class of a token (one of the
most frequent words, the end, or any other word) from the two tokens before it; any other word is
then drawn by its smoothed count, so probabilities over all words add up to one. Each chunk trains
a copy of the model on its training texts, and the copies' weighted mean is the model. Scores come
from batched matrix products over the distinct contexts of a chunk, normalised over all classes.

Contract: a null text is an empty one and has the end alone; rows without a key train like others
and are not held out; repeated rows count each time; equal counts go by word; without training
tokens c and N are 0 and the model gives every class and every other word the same chance; an empty
table gives no row; texts of any length are read whole; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ideamill.llm.common import part_id, raw_texts, written

# Model parameters: classes that are words, vector size, noise words, tokens per step, rate.
CLASS_WORDS = 1_022
SIZE, NOISE, STEP, RATE = 16, 24, 2_048, 0.05
SMOOTHING = 0.1
# A chunk ends after so many tokens or distinct words, at the end of a document.
CHUNK_TOKENS, CHUNK_WORDS = 1 << 21, 1 << 18
PAIRS = 2_048
CHUNK_SCHEMA = "chunk long, docs binary, doc_null binary, held binary, lengths binary, tokens binary, words array<binary>, counts array<int>"


def coded_corpus(docs: DataFrame) -> DataFrame:
    """Chunks of documents (doc_id, held, text): word list, token numbers, training counts of the list."""
    def run(batches: Iterator[pa.RecordBatch]):
        chunk, number = 0, {}
        keys, held, lengths, tokens = [], [], [], []

        def cut():
            ids = np.concatenate(tokens) if tokens else np.zeros(0, np.int32)
            sizes, out = np.array(lengths, np.int64), np.array(held, bool)
            counts = np.bincount(ids[np.repeat(~out, sizes)], minlength=len(number)).astype(np.int32)
            row = [part_id() << 32 | chunk, np.array([k or 0 for k in keys], np.int64).tobytes(),
                   np.array([k is None for k in keys], bool).tobytes(), out.tobytes(), sizes.tobytes(),
                   zstandard.compress(ids.tobytes(), 1)]
            kinds = [pa.int64(), *[pa.binary()] * 5]
            arrays = [pa.array([x], t) for x, t in zip(row, kinds)]
            lists = [pa.array([list(number)], pa.list_(pa.binary())), pa.array([counts], pa.list_(pa.int32()))]
            return pa.RecordBatch.from_arrays([*arrays, *lists], [c.split()[0] for c in CHUNK_SCHEMA.split(", ")])

        size = 0
        for b in batches:
            for key, out, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), raw_texts(b.column(2))):
                words = raw.lower().split()
                for w in set(words).difference(number):
                    number[w] = len(number)
                keys.append(key)
                held.append(out)
                lengths.append(len(words))
                tokens.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
                size += len(words)
                if size >= CHUNK_TOKENS or len(number) >= CHUNK_WORDS:
                    yield cut()
                    chunk, size, number = chunk + 1, 0, {}
                    keys, held, lengths, tokens = [], [], [], []
        if keys:
            yield cut()

    return docs.select(F.col("doc_id").cast("long"), "held", "text").mapInArrow(run, CHUNK_SCHEMA)


@dataclass(frozen=True)
class Totals:
    """Facts on all training tokens. Classes: the words in `words`, then the end, then any other word."""
    words: tuple[bytes, ...]
    counts: np.ndarray
    tokens: int
    distinct: int

    @property
    def classes(self) -> int:
        return len(self.words) + 2

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + SMOOTHING) / (self.tokens + SMOOTHING * (self.distinct + 1)))

    def other(self, counts: np.ndarray) -> np.ndarray:
        """log10 chance of a word among the words that are no class; unseen words share one place."""
        own = self.distinct - len(self.words) - (self.counts[-2] > 0)
        return np.log10((counts + SMOOTHING) / (self.counts[-1] + SMOOTHING * (own + 1)))


def totals(chunks: DataFrame, counts: DataFrame) -> Totals:
    """counts: (word, n) of all training texts."""
    whole = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    # CLASS_WORDS rows.
    top = counts.orderBy(F.desc("n"), "word").limit(CLASS_WORDS).collect()
    ends = chunks.select("held").mapInArrow(_count_false, "n long").agg(F.sum("n")).first()[0] or 0
    own = [r.n for r in top]
    return Totals(tuple(bytes(r.word) for r in top), np.array([*own, ends, (whole.n or 0) - sum(own)], np.float64),
                  (whole.n or 0) + ends, whole.v + (ends > 0))


def _count_false(batches: Iterator[pa.RecordBatch]):
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([x.count(0) for x in b.column(0).to_pylist()], pa.int64())], ["n"])


@dataclass(frozen=True)
class Model:
    context: np.ndarray
    target: np.ndarray
    bias: np.ndarray
    near: np.ndarray
    far: np.ndarray

    @classmethod
    def start(cls, whole: Totals) -> Model:
        rng, k = np.random.default_rng(11), whole.classes
        share = (whole.counts + 1) / (whole.counts + 1).sum()
        # One more context than targets: the place before a text.
        return cls(*(rng.normal(0, 0.1, (n, SIZE)).astype(np.float32) for n in (k + 1, k)), np.log(share).astype(np.float32),
                   np.ones(SIZE, np.float32), np.full(SIZE, 0.5, np.float32))

    def hidden(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return self.near * self.context[one] + self.far * self.context[two]

    def rows(self) -> np.ndarray:
        """All parameters as rows of one matrix."""
        k = len(self.target)
        bias = np.zeros((k + 1, 1), np.float32)
        bias[:k, 0] = self.bias
        first = np.hstack([self.context, np.vstack([self.target, np.zeros((1, SIZE), np.float32)]), bias])
        gates = np.zeros((1, 2 * SIZE + 1), np.float32)
        gates[0, :2 * SIZE] = np.concatenate([self.near, self.far])
        return np.vstack([first, gates])

    @classmethod
    def from_rows(cls, x: np.ndarray) -> Model:
        k = len(x) - 2
        x = x.astype(np.float32)
        return cls(x[:k + 1, :SIZE], x[:k, SIZE:2 * SIZE], x[:k, 2 * SIZE], x[k + 1, :SIZE], x[k + 1, SIZE:2 * SIZE])


def _sums(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(index, values[:, j], n) for j in range(values.shape[1])], 1).astype(np.float32)


def train(start: Model, whole: Totals, one: np.ndarray, two: np.ndarray, target: np.ndarray, seed: int) -> Model:
    """One pass of noise-contrastive estimation over the tokens; noise is drawn by class counts."""
    rng = np.random.default_rng(seed)
    context, goal, bias, near, far = (x.copy() for x in (start.context, start.target, start.bias, start.near, start.far))
    share = (whole.counts + 1) / (whole.counts + 1).sum()
    shift, k = np.log(NOISE * share).astype(np.float32), len(goal)
    order = rng.permutation(-(-len(target) // STEP))
    # Adaptive rates: squared gradients of each parameter's row.
    seen_c, seen_g, seen_b = (np.full(n, 1e-2, np.float32) for n in (k + 1, k, k))

    def sigmoid(x):
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    for step in order.tolist():
        at = slice(step * STEP, (step + 1) * STEP)
        c1, c2, w = one[at], two[at], target[at]
        noise = rng.choice(k, NOISE, p=share)
        r1, r2 = context[c1], context[c2]
        h = near * r1 + far * r2
        up = 1 - sigmoid((h * goal[w]).sum(1) + bias[w] - shift[w])
        down = -sigmoid(h @ goal[noise].T + bias[noise] - shift[noise])
        dh = up[:, None] * goal[w] + down @ goal[noise]
        dg, db = _sums(w, up[:, None] * h, k), np.bincount(w, up, k).astype(np.float32)
        np.add.at(dg, noise, down.T @ h)
        np.add.at(db, noise, down.sum(0))
        dc = _sums(c1, dh * near, k + 1) + _sums(c2, dh * far, k + 1)
        for values, gradient, seen in ((context, dc, seen_c), (goal, dg, seen_g)):
            seen += (gradient * gradient).mean(1)
            values += RATE * gradient / np.sqrt(seen)[:, None]
        seen_b += db * db
        bias += RATE * db / np.sqrt(seen_b)
        near += RATE * (dh * r1).mean(0)
        far += RATE * (dh * r2).mean(0)
    return Model(context, goal, bias, near, far)


class Chunk:
    """One chunk in classes: contexts and targets of all its tokens, ends included."""

    def __init__(self, row, whole: Totals):
        self.keys, self.null = np.frombuffer(row["docs"], np.int64), np.frombuffer(row["doc_null"], bool)
        self.held, lengths = np.frombuffer(row["held"], bool), np.frombuffer(row["lengths"], np.int64)
        local = np.frombuffer(zstandard.decompress(row["tokens"]), np.int32)
        k = whole.classes
        named = {w: i for i, w in enumerate(whole.words)}
        self.word_class = np.array([named.get(bytes(w), k - 1) for w in row["words"]] + [k - 2], np.int32)
        # Local numbers with an end (the last number) behind each text.
        self.sizes = lengths + 1
        ends = np.cumsum(self.sizes) - 1
        self.local = np.full(int(self.sizes.sum()), len(self.word_class) - 1, np.int32)
        inside = np.ones(len(self.local), bool)
        inside[ends] = False
        self.local[inside] = local
        self.target = self.word_class[self.local]
        starts = ends - lengths
        self.one, self.two = np.empty_like(self.target), np.empty_like(self.target)
        self.one[1:], self.two[2:] = self.target[:-1], self.target[:-2]
        self.one[starts], self.two[starts] = k, k
        second = starts[lengths > 0] + 1
        self.two[second] = k
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)


def fitted(chunks: DataFrame, whole: Totals) -> Model:
    """The mean of the chunks' models, weighted by their training tokens."""
    start = Model.start(whole)
    columns = [f"v{i}" for i in range(2 * SIZE + 1)]

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for row in b.to_pylist():
                c = Chunk(row, whole)
                learned = ~c.held[c.doc]
                n = int(learned.sum())
                if n:
                    own = train(start, whole, c.one[learned], c.two[learned], c.target[learned], row["chunk"] & 0xFFFFFFFF).rows()
                    arrays = [pa.array(np.arange(len(own))), pa.array(np.full(len(own), float(n)))]
                    yield pa.RecordBatch.from_arrays(
                        [*arrays, *[pa.array(own[:, j].astype(np.float64)) for j in range(own.shape[1])]], ["row", "n", *columns])

    parts = chunks.drop("counts").mapInArrow(run, "row long, n double, " + ", ".join(f"{c} double" for c in columns))
    # As many rows as the model has classes, whatever the corpus.
    means = parts.groupBy("row").agg(*[(F.sum(F.col("n") * F.col(c)) / F.sum("n")).alias(c) for c in columns]).collect()
    if not means:
        return start
    return Model.from_rows(np.array([r[1:] for r in sorted(means)]))


def log_chances(model: Model, one: np.ndarray, two: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log10 of the normalised chance of each target class, a block of distinct contexts at a time."""
    pair = one.astype(np.int64) << 32 | two
    own, which = np.unique(pair, return_inverse=True)
    order = np.argsort(which, kind="stable")
    ends = np.searchsorted(which[order], np.arange(PAIRS, len(own) + PAIRS, PAIRS), "left")
    out = np.empty(len(target), np.float64)
    begin = 0
    for n, end in enumerate(ends.tolist()):
        some = own[n * PAIRS:(n + 1) * PAIRS]
        logits = model.hidden(some >> 32, some & 0xFFFFFFFF) @ model.target.T + model.bias
        top = logits.max(1, keepdims=True)
        norm = top[:, 0] + np.log(np.exp(logits - top).sum(1))
        at = order[begin:end]
        row = which[at] - n * PAIRS
        out[at] = logits[row, target[at]] - norm[row]
        begin = end
    return out / np.log(10)


def scored(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of docs (doc_id, held, text)."""
    chunks = written(coded_corpus(docs), "coded")
    listed = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "entry")).select(
        "chunk", "place", F.col("entry.words").alias("word"), F.col("entry.counts").alias("n"))
    counts = written(listed.where("n > 0").groupBy("word").agg(F.sum("n").alias("n")), "counts")
    whole = totals(chunks, counts)
    model = fitted(chunks, whole)
    own = listed.select("chunk", "place", "word").join(counts, "word").select(F.col("chunk").alias("of"), "place", F.col("n").alias("c"))

    def score(words: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in held.to_dict("records"):
            c = Chunk(row, whole)
            counted = np.zeros(len(c.word_class))
            counted[words["place"].to_numpy(np.int64)] = words["c"].to_numpy(np.float64)
            counted[-1] = whole.counts[-2]
            base = whole.base(counted)
            rare = np.where(c.word_class == whole.classes - 1, whole.other(counted), 0.0)
            chance = log_chances(model, c.one, c.two, c.target) + rare[c.local]
            n = len(c.sizes)
            out.append(pd.DataFrame({
                "doc_id": pd.array(c.keys, "Int64"), "held_out": c.held, "n_tokens": c.sizes,
                "n_known": np.bincount(c.doc, counted[c.local] > 0, n).astype(np.int64), "train_tokens": np.int64(whole.tokens),
                "base_score": np.bincount(c.doc, base[c.local], n), "score": np.bincount(c.doc, chance, n)}))
            out[-1].loc[c.null, "doc_id"] = pd.NA
        return pd.concat(out) if out else pd.DataFrame(columns=_COLUMNS)

    # A chunk's coded texts and its words' counts meet in one task; both are bounded by the chunk.
    return own.groupBy("of").cogroup(chunks.drop("counts").groupBy("chunk")).applyInPandas(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


_COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
