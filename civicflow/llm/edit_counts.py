"""Edit-aware token counts (operator 6).

A document keeps the lengths and token counts of its pre-tokens under a segment
tree of subtree sums. An edit finds its place by the sums, splits and encodes
anew only from a few characters before the edit until the new pre-tokens meet
an old boundary again, and updates the sums on the paths to the root. This is
exact because a pre-token depends only on the text from its start to a few
characters past its end.
"""

from __future__ import annotations

from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import table

#: Characters past a pre-token's end that its pattern may look at ("'re" is the longest case), and one more.
CONTEXT = 3
#: Pre-tokens per leaf of a tree when it is built; a leaf is allowed four times as many.
LEAF = 32


class SegmentTree:
    """Pre-token (length, tokens) pairs in leaves, with sums of both over every subtree.

    Leaves are arrays of two rows: slices of the array a tree is built from, but for those that edits replaced.
    """

    def __init__(self, lengths, counts):
        self._build(np.array([lengths, counts], "<u4"))

    def _build(self, pairs: np.ndarray) -> None:
        n = pairs.shape[1]
        self.leaves = [pairs[:, i:i + LEAF] for i in range(0, n, LEAF)] or [pairs]
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        sums = np.zeros((2, self.size), np.int64)
        if n:
            sums[:, :len(self.leaves)] = np.add.reduceat(pairs, np.arange(0, n, LEAF), axis=1, dtype=np.int64)
        levels = [sums]
        while sums.shape[1] > 1:
            sums = sums[:, ::2] + sums[:, 1::2]
            levels.append(sums)
        levels.append(np.zeros((2, 1), np.int64))
        self.chars, self.tokens = np.concatenate(levels[::-1], axis=1).tolist()

    def _pull(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def locate(self, at: int) -> tuple[int, int, int]:
        """Leaf, index in it and start of the pre-token that holds character ``at`` (past the end: the last one)."""
        i, start = 1, 0
        at = max(0, min(at, self.chars[1] - 1))
        while i < self.size:
            i *= 2
            if start + self.chars[i] <= at:
                start += self.chars[i]
                i += 1
        leaf = i - self.size
        k = 0
        for k, n in enumerate(self.leaves[leaf][0].tolist()):
            if start + n > at:
                break
            start += n
        return leaf, k, start

    def ends(self, leaf: int, k: int, start: int):
        """Ends of the pre-tokens from a place on, with the place after each."""
        while leaf < len(self.leaves):
            for n in self.leaves[leaf][0, k:].tolist():
                start += n
                k += 1
                yield start, leaf, k
            leaf, k = leaf + 1, 0

    def replace(self, a: tuple[int, int], z: tuple[int, int], pairs: np.ndarray) -> None:
        """Put ``pairs`` in the place of those from ``a`` (leaf, index) up to ``z``; sums change on the paths up."""
        (la, ka), (lz, kz) = a, z
        new = np.concatenate([self.leaves[la][:, :ka], pairs, self.leaves[lz][:, kz:]], axis=1)
        if new.shape[1] > 4 * LEAF * (lz - la + 1):
            self._build(np.concatenate([*self.leaves[:la], new, *self.leaves[lz + 1:]], axis=1))
            return
        per = -(-new.shape[1] // (lz - la + 1))
        dirty = set()
        for i in range(la, lz + 1):
            leaf = self.leaves[i] = new[:, (i - la) * per:(i - la + 1) * per]
            self.chars[self.size + i], self.tokens[self.size + i] = leaf.sum(axis=1, dtype=np.int64).tolist()
            dirty.add((self.size + i) // 2)
        while dirty - {0}:
            for i in dirty:
                self._pull(i)
            dirty = {i // 2 for i in dirty if i > 1}

    def arrays(self) -> np.ndarray:
        """Lengths and tokens of the pre-tokens in order, as two rows."""
        return np.concatenate(self.leaves, axis=1)

    def pairs(self) -> list[tuple[int, int]]:
        return list(zip(*self.arrays().tolist(), strict=True))


def _pairs(v: bpe.Vocabulary, split: list[list[str]]) -> list[np.ndarray]:
    """Lengths and token counts of each list of pieces; those of all lists are encoded together."""
    flat = list(chain.from_iterable(split))
    v.measure(flat)
    both = np.empty((2, len(flat)), "<u4")
    both[0] = np.fromiter(map(len, flat), "<u4", len(flat))
    both[1] = np.fromiter(map(v.sizes.__getitem__, flat), "<u4", len(flat))
    cuts = accumulate(map(len, split), initial=0)
    return [both[:, a:b] for a, b in pairwise(cuts)]


def build(v: bpe.Vocabulary, text: str) -> SegmentTree:
    (pairs,) = _pairs(v, [v.pieces(text)])
    return SegmentTree(*pairs)


def _split(v: bpe.Vocabulary, text: str, tree: SegmentTree, at: int, delete: int, insert: str):
    """The text after an edit (clamped to it), its new pre-tokens, and the places in the tree from and up to which they stand.

    Texts with a special token, or with characters that only the library's
    pre-tokenizer knows, are split whole: they are cut at special tokens first.
    """
    at = max(0, min(at, len(text)))
    delete = max(0, min(delete, len(text) - at))
    new = text[:at] + insert + text[at + delete:]
    scan = v.split.scanner(new)
    if scan is None or any(s in text or s in new for s in v.special) or not tree.chars[1]:
        return new, v.pieces(new), None, None
    shift = len(insert) - delete
    leaf, k, start = tree.locate(at - CONTEXT)
    old = tree.ends(leaf, k, start)
    here = (start, leaf, k)
    pieces: list[str] = []
    stop = None
    for m in scan(new, start):
        pieces.append(m.group())
        end = m.end() - shift  # in the old text
        if m.end() >= at + len(insert) and end >= at + delete:
            while here is not None and here[0] < end:
                here = next(old, None)
            if here is not None and here[0] == end:
                stop = here[1:]
                break
    if stop is None:
        stop = (len(tree.leaves) - 1, tree.leaves[-1].shape[1])
    return new, pieces, (leaf, k), stop


def edit_each(v: bpe.Vocabulary, docs: list[tuple[str, SegmentTree, int, int, str]]) -> list[tuple[str, SegmentTree, int]]:
    """Apply one edit (at, delete, insert) to each of some documents; returns text, tree and the number of pre-tokens encoded anew."""
    split = [_split(v, *d) for d in docs]
    out = []
    for (_, tree, *_), (new, _, a, z), pairs in zip(docs, split, _pairs(v, [s[1] for s in split]), strict=True):
        if a is None:
            tree = SegmentTree(*pairs)
        else:
            tree.replace(a, z, pairs)
        out.append((new, tree, pairs.shape[1]))
    return out


def edit(v: bpe.Vocabulary, text: str, tree: SegmentTree, at: int, delete: int, insert: str) -> tuple[str, SegmentTree, int]:
    """``edit_each`` of one document."""
    return edit_each(v, [(text, tree, at, delete, insert)])[0]


# ---------------------------------------------------------------- tables

_TREE = "n_tokens long, lengths binary, counts binary"


def trees(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = bpe.VOCABULARY) -> DataFrame:
    """Key, text, n_tokens, and lengths and token counts of the pre-tokens (little-endian 32-bit integers)."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        v = bpe.vocabulary(path)
        for part, texts in bpe.blocks(batches, 1):
            pairs = _pairs(v, [v.pieces(t) for t in texts])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(texts, pa.string()), pa.array([int(c.sum()) for _, c in pairs], pa.int64()),
                 pa.array([x.tobytes() for x, _ in pairs], pa.binary()), pa.array([c.tobytes() for _, c in pairs], pa.binary())],
                names=["key", "text", "n_tokens", "lengths", "counts"])

    out = docs.select(key, text).mapInArrow(run, f"key {kind}, text string, {_TREE}")
    return out.withColumnsRenamed({"text": text, "key": key})


def apply_edits(kept: DataFrame, edits: Column, key: str = "doc_id", text: str = "text", path: str = bpe.VOCABULARY) -> DataFrame:
    """Trees (as ``trees`` returns) after their edits, an array of (at, delete, insert) applied in turn.

    Returns key, text, n_tokens, lengths, counts, and before (tokens before the
    edits) and encoded (pre-tokens encoded anew). A null array, or a null in an
    edit (at 0, delete 0, insert nothing), changes nothing; edits are clamped to the text.
    """
    kind = kept.schema[key].dataType.simpleString()
    frame = kept.select(F.col(key).alias("key"), F.col(text).alias("text"), "n_tokens", "lengths", "counts", edits.alias("edits"))

    def run(batches):
        v = bpe.vocabulary(path)
        for b in batches:
            for part, texts in bpe.blocks([b], 1):
                forest = [SegmentTree(np.frombuffer(x, "<u4"), np.frombuffer(c, "<u4"))
                          for x, c in zip(*(part.column(i).to_pylist() for i in (3, 4)), strict=True)]
                todo = [[tuple(y.values()) for y in es or ()] for es in part.column(5).to_pylist()]
                encoded, rows, r = [0] * len(texts), range(len(texts)), 0
                while rows := [i for i in rows if r < len(todo[i])]:
                    turn = [(texts[i], forest[i], at or 0, delete or 0, insert or "") for i in rows for at, delete, insert in todo[i][r:r + 1]]
                    for i, (t, tree, k) in zip(rows, edit_each(v, turn), strict=True):
                        texts[i], forest[i] = t, tree
                        encoded[i] += k
                    r += 1
                pairs = [tree.arrays() for tree in forest]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts, pa.string()), pa.array([tree.n_tokens for tree in forest], pa.int64()),
                     pa.array([x.tobytes() for x, _ in pairs], pa.binary()), pa.array([c.tobytes() for _, c in pairs], pa.binary()),
                     part.column(2), pa.array(encoded, pa.int64())],
                    names=["key", "text", "n_tokens", "lengths", "counts", "before", "encoded"])

    out = frame.mapInArrow(run, f"key {kind}, text string, {_TREE}, before long, encoded long")
    return out.withColumnsRenamed({"text": text, "key": key})


def sample_edits(text: Column) -> Column:
    """Three edits made from each document itself: a replacement at a third, its own first 40 characters
    copied in at two thirds, and its first character dropped."""
    t = F.coalesce(text, F.lit(""))
    n = F.length(t)

    def one(at, delete, insert):
        return F.struct(at.cast("int").alias("at"), F.lit(delete).alias("delete"), insert.alias("insert"))

    return F.array(one(F.floor(n / 3), 10, F.lit(" edited ")), one(F.floor(2 * n / 3), 0, F.substring(t, 1, 40)), one(F.lit(0), 1, F.lit("")))


def query(spark, sf_dir: str) -> DataFrame:
    """Token counts of all documents before and after edits: doc_id, n_tokens, n_tokens_after, n_pieces_after, n_encoded, text_sha256."""
    out = apply_edits(trees(table(spark, sf_dir, "documents")), sample_edits(F.col("text")))
    return out.select("doc_id", F.col("before").alias("n_tokens"), F.col("n_tokens").alias("n_tokens_after"),
                      (F.length("lengths") / 4).cast("long").alias("n_pieces_after"), F.col("encoded").alias("n_encoded"),
                      F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
