"""Quality by fixed rules and gradient-boosted trees over document statistics.

Rules reject first. The trees are boosted by histograms on a bounded sample of labelled rows, with
monotonic constraints on chosen statistics (more repetition never raises the chance of good
quality), and flattened into node arrays that score whole batches of documents at once.

Contract: a null text has no words and fails the rules, as an empty one does; repeated rows are
judged alike; of repeated labels the highest counts; without labels of both kinds only the rules
decide; an empty table gives no row; texts of any length are read whole; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from ideamill.llm.common import raw_texts
from ideamill.llm.toxicity import labelled_sample

WINDOW = 5
SYMBOLS = "#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Statistics the trees see, and the sign that a growing value may have on the chance of good quality.
STATISTICS = {
    "log_words": 0, "mean_word": 0, "symbols": -1, "dup_lines": -1, "repeats": -1, "capitals": 0, "digits": 0,
    "marks": 0, "line_words": 0, "distinct": 0, "longest": 0,
}
TREES, DEPTH, BINS, RATE, LEAST = 80, 4, 64, 0.2, 20


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur more than once."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = np.array(list(map(xxhash.xxh64_intdigest, words)), np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(window):
        key = (key ^ h[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    # Equal windows have equal keys; the windows themselves are compared among those.
    maybe = np.unique(np.concatenate([order[1:][same], order[:-1][same]])).tolist()
    found = Counter(tuple(words[i:i + window]) for i in maybe)
    cover = np.zeros(len(words) + 1, np.int64)
    for i in maybe:
        if found[tuple(words[i:i + window])] > 1:
            cover[i] += 1
            cover[i + window] -= 1
    return int((np.cumsum(cover) > 0).sum())


def base_values(raw: bytes) -> tuple[int, int, int, int, int]:
    """The values of BASE for one text."""
    words = raw.split()
    chars = len(b"".join(words).decode("utf-8", "replace"))
    lines = Counter(line for line in raw.split(b"\n") if line.split())
    return (len(words), chars, sum(raw.count(s.encode()) for s in SYMBOLS),
            sum(lines.values()) - len(lines), repeated_words(words))


def statistics(raw: bytes, base: tuple[int, int, int, int, int]) -> tuple[float, ...]:
    n, chars, symbols, dup_lines, repeats = base
    words = raw.split()
    lines = raw.count(b"\n") + 1
    return (np.log1p(n), chars / max(1, n), symbols / max(1, chars), dup_lines / lines, repeats / max(1, n),
            _share(raw, _CAPITALS), _share(raw, _DIGITS), _share(raw, _POINTS), n / lines, len(set(words)) / max(1, n), max(map(len, words), default=0))


_CAPITALS, _DIGITS, _POINTS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:!?"


def _share(raw: bytes, of: bytes) -> float:
    return (len(raw) - len(raw.translate(None, of))) / max(1, len(raw))


@dataclass
class Forest:
    """Trees as node arrays: a leaf is its own child."""
    feature: list = field(default_factory=list)
    threshold: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    value: list = field(default_factory=list)
    roots: list = field(default_factory=list)
    base: float = 0.0

    def add(self, value: float) -> int:
        i = len(self.value)
        for column, x in ((self.feature, 0), (self.threshold, np.inf), (self.left, i), (self.right, i), (self.value, value)):
            column.append(x)
        return i

    def flat(self) -> FlatForest:
        return FlatForest(np.array(self.feature, np.int64), np.array(self.threshold), np.array(self.left, np.int64),
                          np.array(self.right, np.int64), np.array(self.value), np.array(self.roots, np.int64), self.base)


@dataclass(frozen=True)
class FlatForest:
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def chance(self, x: np.ndarray) -> np.ndarray:
        """The chance of good quality for each row."""
        out, row = np.full(len(x), self.base), np.arange(len(x))
        for root in self.roots.tolist():
            node = np.full(len(x), root)
            for _ in range(DEPTH):
                node = np.where(x[row, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            out += self.value[node]
        return 1 / (1 + np.exp(-np.clip(out, -35, 35)))


def fit(x: np.ndarray, y: np.ndarray, signs: list[int]) -> FlatForest:
    """Boosted trees for the chance of y = 1; signs bound the direction of each column."""
    forest = Forest()
    share = float(y.mean()) if len(y) else 1.0
    if not 0 < share < 1:
        forest.base = 35.0 if share else -35.0
        return forest.flat()
    forest.base = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, col, "left") for c, col in zip(cuts, x.T)], 1)
    margin = np.full(len(x), forest.base)

    def leaf(g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(-g / (h + 1.0), low, high))

    def best(rows: np.ndarray, g: np.ndarray, h: np.ndarray, low: float, high: float):
        found = (1e-6, None)
        whole_g, whole_h = g[rows].sum(), h[rows].sum()
        for f, sign in enumerate(signs):
            if not len(cuts[f]):
                continue
            own = binned[rows, f]
            gs, hs, ns = (np.cumsum(np.bincount(own, w, len(cuts[f]) + 1))[:-1] for w in (g[rows], h[rows], np.ones(len(rows))))
            one, two = np.clip(-gs / (hs + 1), low, high), np.clip(-(whole_g - gs) / (whole_h - hs + 1), low, high)
            gain = gs * gs / (hs + 1) + (whole_g - gs) ** 2 / (whole_h - hs + 1) - whole_g ** 2 / (whole_h + 1)
            gain[(ns < LEAST) | (len(rows) - ns < LEAST) | (sign * (two - one) < 0)] = -1
            k = int(gain.argmax())
            if gain[k] > found[0]:
                found = (gain[k], (f, k, one[k], two[k]))
        return found[1]

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, low: float, high: float) -> int:
        node = forest.add(RATE * leaf(g[rows].sum(), h[rows].sum(), low, high))
        split = best(rows, g, h, low, high) if depth else None
        if split is None:
            margin[rows] += forest.value[node]
            return node
        f, k, one, two = split
        goes = binned[rows, f] <= k
        middle, sign = (one + two) / 2, signs[f]
        # Below a constrained split no leaf may pass the middle of the two sides.
        first = (low, min(high, middle)) if sign > 0 else (max(low, middle), high) if sign < 0 else (low, high)
        second = (max(low, middle), high) if sign > 0 else (low, min(high, middle)) if sign < 0 else (low, high)
        forest.feature[node], forest.threshold[node] = f, cuts[f][k]
        forest.left[node] = grow(rows[goes], g, h, depth - 1, *first)
        forest.right[node] = grow(rows[~goes], g, h, depth - 1, *second)
        return node

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        forest.roots.append(grow(np.arange(len(x)), p - y, p * (1 - p), DEPTH, -np.inf, np.inf))
    return forest.flat()


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> FlatForest:
    """Trees from a bounded sample of the labelled rows given."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            x = [statistics(raw, base_values(raw)) for raw in raw_texts(b.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array([list(map(float, r)) for r in x], pa.list_(pa.float64())), *b.columns[1:]], ["x", "y", "turn"])

    sample = labelled_sample(docs, labels, label).select("text", "y", "turn")
    rows = sorted((r.turn, r.y, tuple(r.x)) for r in sample.mapInArrow(run, "x array<double>, y int, turn long").collect())
    x = np.array([r[2] for r in rows]).reshape(len(rows), len(STATISTICS))
    return fit(x, np.array([r[1] for r in rows], np.float64), list(STATISTICS.values()))


def judged(docs: DataFrame, forest: FlatForest) -> DataFrame:
    """doc_id, the values of BASE, base_failed, kept and the chance of good quality of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            raws = raw_texts(b.column(1))
            base = [base_values(raw) for raw in raws]
            x = np.array([statistics(raw, v) for raw, v in zip(raws, base)], np.float64).reshape(len(raws), len(STATISTICS))
            columns = np.array(base, np.int64).reshape(len(raws), len(BASE)).T
            failed = (columns[0] < 10) | (100 * columns[4] > 20 * columns[0])
            chance = forest.chance(x)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c) for c in columns], pa.array(failed), pa.array(~failed & (chance >= 0.5)), pa.array(chance)],
                ["doc_id", *BASE, "base_failed", "kept", "chance"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, kept boolean, chance double")
