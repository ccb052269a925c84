"""Quality rules: gradient-boosted trees over document statistics (operator 3).

Statistics of whole texts are counted in vectorised scans. The trees are
trained on the driver on a bounded sample of labelled rows, with monotonic
constraints on chosen statistics, and flattened into node arrays, so that a
batch is scored by a few array lookups per level.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, table
from .textnp import SPACE, U, mix64, pair_hash, released, runs, slices, span_hashes, words

#: Labelled rows that are used for training at most: those with the smallest hash of their key.
TRAIN_ROWS = 20_000
#: Documents whose probability of good quality is under this are rejected.
MIN_GOOD = 0.5
SYMBOLS = b"#*$%&|<>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: The trees' statistics and their constraint: -1 may only lower the probability of good quality.
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": -1,
    "digit_share": 0, "bang_share": -1, "punct_share": 0, "distinct_share": 0, "words_per_line": 0, "long_word_share": 0,
}


def _mask(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL, _BANG = _mask(SYMBOLS), _mask(b"!?")
_UPPER, _DIGIT = _mask(bytes(range(65, 91))), _mask(bytes(range(48, 58)))
_PUNCT = _mask(b".,;:'\"()-")
_LEAD = ~SPACE & ((np.arange(256) & 0xC0) != 0x80)  # first bytes of characters in words


def _per_doc(s, mask: np.ndarray) -> np.ndarray:
    total = np.zeros(len(s.data) + 1, np.int64)
    np.cumsum(mask[s.data], out=total[1:])
    return np.diff(total[s.bounds])


def _repeats(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of equal (doc, hash) rows for each row, and whether it is the first of them."""
    _, first, inverse, counts = np.unique(mix64(hashes + doc.astype(U) * U(0x9E3779B97F4A7C15)),
                                          return_index=True, return_inverse=True, return_counts=True)
    is_first = np.zeros(len(doc), bool)
    is_first[first] = True
    return counts[inverse], is_first


def slice_statistics(s) -> tuple[np.ndarray, np.ndarray]:
    """BASE counts (n, 5) and FEATURES (n, 12) of the documents of a slice."""
    n = s.docs
    w = words(s, lower=False)
    n_words = np.diff(w.bounds)
    chars, symbols = _per_doc(s, _LEAD), _per_doc(s, _SYMBOL)

    start, end = runs(s.data != 10, s.bounds)
    with_word = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end = start[with_word], end[with_word]
    line_doc = np.searchsorted(s.bounds, start, "right") - 1
    n_lines = np.bincount(line_doc, minlength=n)
    _, first = _repeats(line_doc, span_hashes(s.data, start, end, lower=False))
    dup_lines = np.bincount(line_doc[~first], minlength=n)

    repeat = np.zeros(n, np.int64)
    if len(w.hash) >= 3:
        inside = np.flatnonzero(w.doc[:-2] == w.doc[2:])
        h = pair_hash(pair_hash(w.hash[:-2], w.hash[1:-1]), w.hash[2:])[inside]
        twice = inside[_repeats(w.doc[inside], h)[0] >= 2]
        hit = np.zeros(len(w.hash), bool)
        for k in range(3):
            hit[twice + k] = True
        repeat = np.bincount(w.doc[hit], minlength=n)

    _, first_word = _repeats(w.doc, w.hash)
    distinct = np.bincount(w.doc[first_word], minlength=n)
    long_words = np.bincount(w.doc[w.end - w.start > 12], minlength=n)
    base = np.stack([n_words, chars, symbols, dup_lines, repeat], 1).astype(np.int64)
    nw, nc, nl = np.maximum(n_words, 1), np.maximum(chars, 1), np.maximum(n_lines, 1)
    features = np.stack([
        np.log1p(n_words), chars / nw, symbols / nw, dup_lines / nl, repeat / nw, _per_doc(s, _UPPER) / nc,
        _per_doc(s, _DIGIT) / nc, _per_doc(s, _BANG) / nw, _per_doc(s, _PUNCT) / nc, distinct / nw,
        n_words / nl, long_words / nw], 1).astype(np.float32)
    return base, features


def statistics_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    base, features = [np.zeros((0, len(BASE)), np.int64)], [np.zeros((0, len(FEATURES)), np.float32)]
    for s in slices(column):
        b, f = slice_statistics(s)
        base.append(b)
        features.append(f)
    return np.concatenate(base), np.concatenate(features)


def base_failed(base: np.ndarray) -> np.ndarray:
    return (base[:, 0] < 50) | (100 * base[:, 4] > 50 * base[:, 0])


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, BASE counts and FEATURES of every whole text (null: no words)."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            base, features = statistics_of(b.column(1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c) for c in base.T), *(pa.array(np.ascontiguousarray(c)) for c in features.T)],
                names=[key, *BASE, *FEATURES])

    schema = f"`{key}` {kind}, " + ", ".join([*(f"{c} long" for c in BASE), *(f"{c} float" for c in FEATURES)])
    return docs.select(key, text).mapInArrow(released(run), schema)


# ---------------------------------------------------------------- trees

class Trees(NamedTuple):
    """Node arrays of all trees; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality of each row, all trees at once."""
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
        return 1 / (1 + np.exp(-(self.bias + self.value[node].sum(1))))


def fit(x: np.ndarray, y: np.ndarray, monotone: list[int], trees: int = 60, depth: int = 4,
        rate: float = 0.2, min_rows: int = 20, ridge: float = 1.0, cuts: int = 64) -> Trees:
    """Boosted trees for the log-odds of ``y`` by Newton steps on binned statistics.

    A split on a constrained statistic must order its sides' values, and the
    sides' subtrees stay on their side of the middle, so the sum is monotone.
    With no rows or one class the result is that constant.
    """
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    mean = float(np.clip(y.mean() if len(y) else 1.0, 1e-3, 1 - 1e-3))
    bias = float(np.log(mean / (1 - mean)))
    if len(y) and 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, cuts + 1)[1:-1], method="lower")) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], 1)
        f = np.full(len(y), bias)

        def grow(rows, g, h, level, lo, hi) -> int:
            gs, hs = g[rows].sum(), h[rows].sum()
            me = len(nodes)
            nodes.append([0, np.inf, me, me, rate * float(np.clip(gs / (hs + ridge), lo, hi))])
            if level == depth or len(rows) < 2 * min_rows:
                return me
            best = (1e-6, None)
            for k, e in enumerate(edges):
                if not len(e):
                    continue
                b = binned[rows, k]
                gl = np.cumsum(np.bincount(b, g[rows], len(e) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, h[rows], len(e) + 1))[:-1]
                nl = np.cumsum(np.bincount(b, minlength=len(e) + 1))[:-1]
                vl = np.clip(gl / (hl + ridge), lo, hi)
                vr = np.clip((gs - gl) / (hs - hl + ridge), lo, hi)
                gain = gl * vl - (hl + ridge) * vl ** 2 / 2 + (gs - gl) * vr - (hs - hl + ridge) * vr ** 2 / 2
                v = np.clip(gs / (hs + ridge), lo, hi)
                gain -= gs * v - (hs + ridge) * v ** 2 / 2
                gain[(nl < min_rows) | (len(rows) - nl < min_rows)] = -1
                if monotone[k]:
                    gain[monotone[k] * (vr - vl) < 0] = -1
                j = int(gain.argmax())
                if gain[j] > best[0]:
                    best = (gain[j], (k, j, vl[j], vr[j]))
            if best[1] is None:
                return me
            k, j, vl, vr = best[1]
            low = binned[rows, k] <= j
            mid = (vl + vr) / 2
            bounds = {1: ((lo, mid), (mid, hi)), -1: ((mid, hi), (lo, mid)), 0: ((lo, hi), (lo, hi))}[monotone[k]]
            a = grow(rows[low], g, h, level + 1, *bounds[0])
            b = grow(rows[~low], g, h, level + 1, *bounds[1])
            nodes[me][:4] = [k, float(edges[k][j]), a, b]
            return me

        for _ in range(trees):
            p = 1 / (1 + np.exp(-f))
            roots.append(grow(np.arange(len(y)), y - p, p * (1 - p), 0, -np.inf, np.inf))
            one = _arrays(nodes, [roots[-1]], depth, 0.0)
            node = np.full(len(y), roots[-1])
            for _ in range(depth):
                node = np.where(x[np.arange(len(x)), one.feature[node]] <= one.threshold[node], one.left[node], one.right[node])
            f += one.value[node]
    return _arrays(nodes, roots, depth, bias)


def _arrays(nodes, roots, depth, bias) -> Trees:
    c = list(zip(*nodes, strict=True)) if nodes else [[], [], [], [], []]
    return Trees(np.array(c[0], np.int32), np.array(c[1], np.float32), np.array(c[2], np.int32), np.array(c[3], np.int32),
                 np.array(c[4], np.float64), np.array(roots, np.int32), depth, bias)


def train(stats: DataFrame, labels: DataFrame, key: str = "doc_id", target: str = "quality", rows: int = TRAIN_ROWS) -> Trees:
    """Trees from at most ``rows`` labelled documents, those with the smallest hash of their key.

    Rows without a label or key are no use for training; repeated labels count each.
    """
    good = labels.select(F.col(key), F.col(target).cast("int").alias("_y")).where(F.col("_y").isNotNull())
    sample = stored(stats.select(key, *FEATURES).join(good, key), "quality_labelled")
    # a histogram of the hashes' first 16 bits says where the sample ends, so tasks send little beside it
    bucket = F.shiftright(F.xxhash64(key), 48)
    counts = sorted(tuple(r) for r in sample.groupBy(bucket.alias("b")).count().collect())  # 65,536 rows at most
    sums = np.cumsum([n for _, n in counts])
    if len(counts) and sums[-1] > rows:
        sample = sample.where(bucket <= int(counts[int(np.searchsorted(sums, rows))][0]))
    pdf = sample.orderBy(F.xxhash64(key), *FEATURES, "_y").limit(rows).select(*FEATURES, "_y").toPandas()
    return fit(pdf[list(FEATURES)].to_numpy(np.float32), pdf["_y"].to_numpy(np.float64), list(FEATURES.values()))


def judge(stats: DataFrame, trees: Trees, key: str = "doc_id", min_good: float = MIN_GOOD) -> DataFrame:
    """Key, BASE, base_failed, kept and good (the trees' probability)."""
    kind = stats.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            base = np.stack([b.column(i + 1).to_numpy() for i in range(len(BASE))], 1)
            x = np.stack([b.column(i + 1 + len(BASE)).to_numpy() for i in range(len(FEATURES))], 1)
            failed, good = base_failed(base), _score(trees, x)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(b.column(i + 1) for i in range(len(BASE))), pa.array(failed),
                 pa.array(~failed & (good >= min_good)), pa.array(good)],
                names=[key, *BASE, "base_failed", "kept", "good"])

    schema = f"`{key}` {kind}, " + ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, kept boolean, good double"
    return stats.select(key, *BASE, *FEATURES).mapInArrow(released(run), schema)


def _score(trees: Trees, x: np.ndarray, rows: int = 2048) -> np.ndarray:
    return np.concatenate([np.zeros(0), *(trees.score(x[i:i + rows]) for i in range(0, len(x), rows))])


def quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", target: str = "quality") -> DataFrame:
    """Statistics and verdict of every document, trained on the labelled ones.

    One row per input row. A null or empty text has no words and fails the base
    rules. Null keys and repeated rows are judged like any other; a document
    without a label is judged by the trees alone; without usable labels the
    trees reject nothing. Extra columns are not read.
    """
    stats = stored(statistics(docs, key, text), "quality_statistics")
    return judge(stats, train(stats, labels, key, target), key)


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", min_good: float = MIN_GOOD) -> DataFrame:
    """The documents that pass, all their columns unchanged (null and empty texts go)."""
    trees = train(stored(statistics(docs, key, text), "quality_statistics"), labels, key)
    at = docs.columns.index(text)

    def run(batches):
        for b in batches:
            base, x = statistics_of(b.column(at))
            yield b.filter(pa.array(~base_failed(base) & (_score(trees, x) >= min_good)))

    return docs.mapInArrow(released(run), docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    """Contract columns of operator 3 over all documents."""
    out = quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *BASE, "base_failed", "kept")
