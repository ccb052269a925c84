"""Hierarchical Pitman-Yor language model (operator 5).

Every token is a customer in the restaurant of the word before it (the end
token stands for a document's start); every word seen in training has one. A
table there is a customer of the shared parent, the restaurant of single words,
whose tables come from a uniform base. Seatings are sampled by Gibbs: a pass
redraws the tables of every word pair given the totals of the pass before, then
those of every word in the parent, and predictive probabilities are averaged
over the kept samples. Only sums over all words reach the driver. A pair met
once has one table in every sample, so the passes read the repeated pairs only.

Texts are met in blocks of whole documents, words in buckets by hash, and pairs
in cells, one for each bucket of contexts and bucket of words. What one sends
another is a parcel of packed arrays: a block sends each of its words and pairs
once and receives their counts and samples in the same order; a cell asks each
of its two buckets for the words of its repeated pairs once, and each pass sends
numbers in that order. So no word and no pair is a row, and a frequent context's
pairs lie in as many cells as there are buckets.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, table
from .textnp import U, mix64, pair_hash, slices, words

#: Documents per block.
BLOCK_DOCS = 4000
#: Gibbs passes per word that are dropped, and kept.
BURN_IN, SAMPLES = 2, 3
#: Strength of both levels; discounts are estimated from the counts.
THETA = 1.0
#: Customers of a dish up to which its tables are drawn from the exact conditional; tables that
#: further customers open are added by their expected number, in steps of a twentieth.
EXACT = 100
END = U(0x0E4D0E4D0E4D0E4D)  # the end token's hash; as a context, a document's start


def held_out(key: str) -> Column:
    """crc32 of the key as text mod 10 is 0 (a null key counts as the empty text, whose crc32 is 0)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 10 == 0


# ---------------------------------------------------------------- tokens of a block

class Tokens(NamedTuple):
    hash: np.ndarray   # words and ends, in order
    doc: np.ndarray    # document of each
    first: np.ndarray  # first token of each document


def tokens(columns: list[pa.Array]) -> Tokens:
    hashes, docs, at = [], [], 0
    for column in columns:
        for s in slices(column):
            w = words(s)
            h = np.full(len(w.hash) + s.docs, END, U)
            h[np.arange(len(w.hash)) + w.doc] = w.hash
            hashes.append(h)
            docs.append(np.repeat(np.arange(s.docs) + at, np.diff(w.bounds) + 1))
            at += s.docs
    doc = np.concatenate([np.zeros(0, np.int64), *docs])
    return Tokens(np.concatenate([np.zeros(0, U), *hashes]), doc, np.searchsorted(doc, np.arange(at)))


def _among(values: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each of ``x`` in sorted ``values``, and whether it is there."""
    if not len(values):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    i = np.minimum(np.searchsorted(values, x), len(values) - 1)
    return i, values[i] == x


def _by_block(batches, reduce):
    """Runs of equal ``block`` (column 0) across batches, each given whole to ``reduce``."""
    held, parts = None, []
    for b in batches:
        ids = b.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
        for a, z in zip(cuts[:-1], cuts[1:]):
            if a == z:
                continue
            if held is not None and ids[a] != held:
                yield reduce(held, parts)
                parts = []
            held = int(ids[a])
            parts.append(b.slice(a, z - a))
    if parts:
        yield reduce(held, parts)


def _block_words(docs: DataFrame) -> DataFrame:
    """(block, w, n): every distinct token of a block and its count in training documents (maybe 0)."""

    def reduce(block, parts):
        t = tokens([p.column(2) for p in parts])
        train = np.concatenate([p.column(1).to_numpy(zero_copy_only=False) for p in parts])
        w, inverse = np.unique(t.hash, return_inverse=True)
        n = np.bincount(inverse, train[t.doc], len(w)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(w), block)), pa.array(w.view(np.int64)), pa.array(n)],
                                          names=["block", "w", "n"])

    return docs.select("block", "train", "text").mapInArrow(lambda b: _by_block(b, reduce), "block long, w long, n long")


# ---------------------------------------------------------------- seating

class Totals(NamedTuple):
    """What the restaurants share: customers and tables of each context and of the parent."""

    customers: np.ndarray
    tables: np.ndarray
    parent_customers: float
    parent_tables: float
    types: int
    discount: float
    parent_discount: float


def log_stirling(d: float, top: int = EXACT) -> np.ndarray:
    """Log of the generalised Stirling numbers: ways, weighted by discount, to seat n customers at t tables."""
    out = np.full((top + 1, top + 1), -np.inf)
    out[1, 1] = 0.0
    for n in range(1, top):
        t = np.arange(1, n + 1)
        out[n + 1, 1:n + 1] = out[n, 1:n + 1] + np.log(n - t * d)
        out[n + 1, 1:n + 2] = np.logaddexp(out[n + 1, 1:n + 2], out[n, 0:n + 1])
    return out


def draw_tables(n: np.ndarray, weight: np.ndarray, chance: np.ndarray, stirling: np.ndarray, d: float) -> np.ndarray:
    """Tables of dishes with ``n`` customers when a new table weighs ``weight``; ``chance`` is uniform."""
    t = np.minimum(n, 1)
    small = np.minimum(n, EXACT)
    order = np.argsort(small, kind="stable")
    sizes, starts = np.unique(small[order], return_index=True)
    ends = np.append(starts[1:], len(order))
    for size, a, z in zip(sizes.tolist(), starts.tolist(), ends.tolist(), strict=True):
        if size < 2:
            continue
        for at in range(a, z, 20_000):
            rows = order[at:min(z, at + 20_000)]
            logs = stirling[size, 1:size + 1] + np.log(weight[rows])[:, None] * np.arange(1, size + 1)
            logs -= logs.max(1, keepdims=True)
            p = np.cumsum(np.exp(logs), 1)
            t[rows] = 1 + (p < (chance[rows] * p[:, -1])[:, None]).sum(1)
    rows = np.flatnonzero(n > EXACT)
    seated = np.full(len(rows), EXACT, np.int64)
    step = 0
    while len(rows):
        upto = np.minimum(n[rows], np.ceil(seated * 1.05).astype(np.int64))
        p = weight[rows] / (weight[rows] + seated - d * t[rows])
        u = _uniform(mix64((chance[rows] * 2.0 ** 52).astype(U) + U(step)))
        t[rows] += np.minimum(np.floor((upto - seated) * p + u).astype(np.int64), upto - seated)
        more = upto < n[rows]
        rows, seated, step = rows[more], upto[more], step + 1
    return t


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> U(11)).astype(np.float64) + 0.5) * 2.0 ** -53


class Seating:
    """Gibbs passes in memory, totals held fixed: words w, c (training count), and their contexts' (row, ctx, n).

    The yardstick of the passes over tables below.
    """

    def __init__(self, w, c, row, ctx, n, totals: Totals):
        self.w, self.c, self.row, self.ctx, self.n, self.t = w, c, row, ctx, n, totals
        self.s1, self.s0 = log_stirling(totals.discount), log_stirling(totals.parent_discount)
        self.direct = c - np.bincount(row, n, len(w)).astype(np.int64)
        self.tables = np.minimum(n, 1)
        self.base = (THETA + totals.parent_discount * totals.parent_tables) / (totals.types + 1)
        self.draw_parent(0)

    def draw_parent(self, sweep: int) -> None:
        self.parent_customers = self.direct + np.bincount(self.row, self.tables, len(self.w)).astype(np.int64)
        chance = _uniform(mix64(self.w + U(7919 * (sweep + 1))))
        t = self.t
        self.parent_tables = draw_tables(self.parent_customers, np.full(len(self.w), self.base), chance, self.s0, t.parent_discount)
        self.p1 = (self.parent_customers - t.parent_discount * self.parent_tables + self.base) / (THETA + t.parent_customers)

    def sweep(self, k: int) -> None:
        weight = (THETA + self.t.discount * self.t.tables[self.ctx]) * self.p1[self.row]
        chance = _uniform(mix64(mix64(self.w[self.row] + self.ctx.astype(U)) + U(104729 * (k + 1))))
        self.tables = draw_tables(self.n, weight, chance, self.s1, self.t.discount)
        self.draw_parent(k + 1)

    def predictive(self) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each word in the parent, and of each (row, ctx) in its context."""
        t, c = self.t, self.ctx
        back = (THETA + t.discount * t.tables[c]) * self.p1[self.row]
        return self.p1, (self.n - t.discount * self.tables + back) / (THETA + t.customers[c])


# ---------------------------------------------------------------- parcels

#: Text bytes (about) whose word pairs meet in one cell; the buckets of words are the square root of the cells.
CELL_BYTES = 24 << 20
#: A parcel: what it holds, the group that it goes to, whom it comes from or answers, packed arrays, sums.
PARCEL = "kind int, at long, peer long, data binary, a long, b long, c long, d long"
WORDS, IDS, PAIRS, LISTS, ASK, HASH, TO_CELL, TO_BUCKET, SAMPLE, KEPT, KEYS, TOKENS = range(12)
_LOW = U(0xFFFFFFFF)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers from 0, rising ones as differences, compressed byte by byte of their numbers."""
    head, body = [len(arrays)], []
    for x in arrays:
        x = np.ascontiguousarray(x).astype(U)
        rising = len(x) > 1 and bool((x[1:] >= x[:-1]).all())
        if rising:
            x = np.diff(x, prepend=U(0))
        width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
        head += [len(x), int(rising), width]
        body.append(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())
    return zstandard.ZstdCompressor(3).compress(np.array(head, "<i8").tobytes() + b"".join(body))


def unpack(data: bytes) -> list[np.ndarray]:
    """The unsigned arrays that ``pack`` was given."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    count = int(raw[:8].view("<i8")[0])
    at, out = 8 + 24 * count, []
    for n, rising, width in raw[8:at].view("<i8").reshape(-1, 3).tolist():
        x = np.zeros((n, 8), np.uint8)
        x[:, :width] = raw[at:at + n * width].reshape(width, n).T
        x = x.view("<u8").reshape(n).astype(U)
        out.append(np.cumsum(x, dtype=U) if rising else x)
        at += n * width
    return out


def _ints(data: bytes) -> list[np.ndarray]:
    return [x.view(np.int64) for x in unpack(data)]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    """Parcels as a batch; missing sums are 0."""
    columns = list(zip(*((*r, *[0] * (8 - len(r))) for r in rows))) or [()] * 8
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["kind", "at", "peer", "data", "a", "b", "c", "d"])


def _table(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_batches([_batch(rows)])


def _opened(t: pa.Table) -> list[tuple[int, int, int, bytes]]:
    """(kind, at, peer, data) of a group, by kind and peer."""
    rows = zip(*(t.column(c).to_pylist() for c in ("kind", "at", "peer", "data")))
    return sorted(rows, key=lambda r: (r[0], r[2]))


def _union(arrays) -> np.ndarray:
    """Sorted distinct values of sorted arrays, merged before they become many."""
    held, size = [np.zeros(0, U)], 0
    for x in arrays:
        held.append(x)
        size += len(x)
        if size > len(held[0]) + 4_000_000:
            held, size = [np.unique(np.concatenate(held))], 0
    return np.unique(np.concatenate(held))


def _cuts(groups: np.ndarray):
    """(group, first, end) of runs of equal values."""
    edges = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(groups)] if len(groups) else []
    return [(int(groups[a]), a, e) for a, e in zip(edges[:-1], edges[1:])]


class Block(NamedTuple):
    """Tokens of a block by their words' places among its words, which are in order of bucket and hash."""

    words: np.ndarray
    bucket: np.ndarray  # of each word
    at: np.ndarray      # each token's word
    ctx: np.ndarray     # the word before it, the end token at a start
    seated: np.ndarray  # whether that has a restaurant
    bare: np.ndarray    # words without one


def _before(at: np.ndarray, first: np.ndarray, bare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ctx = np.empty_like(at)
    ctx[1:] = at[:-1]
    seated = np.ones(len(at), bool)
    seated[1:] = ~bare[ctx[1:]]
    ctx[first], seated[first] = at[-1:], True  # the last token is an end
    return ctx, seated


def _numbered(t: Tokens, buckets: int, frequent: np.ndarray | None) -> Block:
    w, at = np.unique(t.hash, return_inverse=True)
    bucket = (mix64(w) % U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(w), np.int64)
    rank[order] = np.arange(len(w))
    w, bucket, at = w[order], bucket[order], rank[at]
    bare = np.zeros(len(w), bool) if frequent is None else ~_among(frequent, w)[1]
    return Block(w, bucket, at, *_before(at, t.first, bare), bare)


def _pair_keys(ctx: np.ndarray, w: np.ndarray) -> np.ndarray:
    return (ctx.astype(U) << U(32)) | w.astype(U)


def _from_blocks(docs: DataFrame, buckets: int, frequent: np.ndarray | None, send) -> DataFrame:
    """Parcels that ``send`` makes of each block, given its number, tokens, numbered words, training documents and keys."""

    def reduce(block, parts):
        t = tokens([p.column(3) for p in parts])
        train = np.concatenate([p.column(2).to_numpy(zero_copy_only=False) for p in parts])
        return _batch(send(block, t, _numbered(t, buckets, frequent), train, parts))

    return docs.select("block", "key", "train", "text").mapInArrow(lambda b: _by_block(b, reduce), PARCEL)


def _send_words(block, t, b, train, parts):
    """A block's words by bucket, with their training tokens and those that sit in the parent directly."""
    n = np.bincount(b.at, train[t.doc], len(b.words)).astype(np.int64)
    direct = np.bincount(b.at, train[t.doc] & ~b.seated, len(b.words)).astype(np.int64)
    return [(WORDS, j, block, pack(b.words[a:e], n[a:e], direct[a:e])) for j, a, e in _cuts(b.bucket)]


def _send_pairs(block, t, b, train, parts):
    """A block's distinct pairs by the places of their words, with their training tokens."""
    key, of = np.unique(_pair_keys(b.ctx, b.at)[b.seated], return_inverse=True)
    return [(PAIRS, block, -1, pack(key, np.bincount(of, train[t.doc][b.seated], len(key))))]


def _send_tokens(block, t, b, train, parts):
    """A block's tokens by their words' places, and its documents."""
    length = np.diff(np.append(t.first, len(t.hash)))
    key = pa.chunked_array([p.column(1) for p in parts])
    sink = pa.BufferOutputStream()
    rows = pa.table({"key": key, "train": train, "length": length})
    with pa.ipc.new_stream(sink, rows.schema) as w:
        w.write_table(rows)
    return [(KEYS, block, -1, zstandard.ZstdCompressor(3).compress(sink.getvalue().to_pybytes())), (TOKENS, block, -1, pack(b.at, b.bare))]


def _merge_words(t: pa.Table) -> pa.Table:
    """A bucket's words and counts from those of all blocks, and to each block the places of its words."""
    rows = _opened(t)
    words = _union(unpack(data)[0] for *_, data in rows)
    c, direct, out = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), []
    for _, bucket, block, data in rows:
        w, n, d = unpack(data)
        i = np.searchsorted(words, w)
        c[i] += n.view(np.int64)
        direct[i] += d.view(np.int64)
        out.append((IDS, block, bucket, pack(i)))
    sums = [int(x) for x in ((c > 0).sum(), c.sum(), (c == 1).sum(), (c == 2).sum())]
    return _table([*out, (WORDS, bucket, -1, pack(words, c, direct), *sums)])


def _deal_pairs(buckets: int):
    """Of a block's pairs and the places of its words in their buckets: the pairs by cell, a bucket of contexts and one of words."""

    def run(t: pa.Table) -> pa.Table:
        rows = _opened(t)
        ids = [(j, unpack(data)[0]) for kind, _, j, data in rows if kind == IDS]
        place = np.concatenate([x for _, x in ids])
        bucket = np.repeat([j for j, _ in ids], [len(x) for _, x in ids])
        (block, key, n), = [(at, *unpack(data)) for kind, at, _, data in rows if kind == PAIRS]
        ctx, w = (key >> U(32)).astype(np.int64), (key & _LOW).astype(np.int64)
        cell = bucket[ctx] * buckets + bucket[w]
        order = np.argsort(cell, kind="stable")
        key, n, cell = _pair_keys(place[ctx], place[w])[order], n[order], cell[order]
        return _table([(PAIRS, k, block, pack(key[a:e], n[a:e])) for k, a, e in _cuts(cell)])

    return run


def _merge_pairs(buckets: int):
    """A cell's repeated pairs from those of all blocks, the words that they ask buckets for, and for each block where its pairs are."""

    def run(t: pa.Table) -> pa.Table:
        rows = _opened(t)
        key = _union(unpack(data)[0] for *_, data in rows)
        n = np.zeros(len(key), np.int64)
        for *_, data in rows:
            own, m = unpack(data)
            n[np.searchsorted(key, own)] += m.view(np.int64)
        again, once = n > 1, key[n == 1]
        place, out = np.cumsum(again) - 1, []
        for _, cell, block, data in rows:
            i = np.searchsorted(key, unpack(data)[0])
            met = np.minimum(n[i], 2)
            out.append((LISTS, cell, block, pack(met, place[i[met == 2]])))
        sides = []
        for side, (pairs, single, bucket) in enumerate(((key[again] & _LOW, once & _LOW, cell % buckets),
                                                        (key[again] >> U(32), once >> U(32), cell // buckets))):
            asked, of = np.unique(pairs, return_inverse=True)
            sides.append(of)
            out.append((ASK, bucket, 2 * cell + side, pack(asked, np.bincount(of, minlength=len(asked)), *np.unique(single, return_counts=True))))
        return _table([*out, (PAIRS, cell, -1, pack(*sides, n[again]), len(once), int((n == 2).sum()))])

    return run


def _tell_hashes(t: pa.Table) -> pa.Table:
    """The hashes of the words that cells ask a bucket for."""
    rows = _opened(t)
    words, = [unpack(data)[0] for kind, _, _, data in rows if kind == WORDS]
    asked = [(peer, _ints(data)[0]) for kind, _, peer, data in rows if kind == ASK]
    return _table([(HASH, peer >> 1, peer & 1, pack(words[i])) for peer, i in asked if len(i)])


def _seat_words(base: float, d0: float, sweep: int, keep: bool):
    """A pass over a bucket's words: customers and tables from the cells' pairs, and new tables in the parent."""

    def run(state: pa.Table, told: pa.Table) -> pa.Table:
        rows, got = _opened(state), {peer: _ints(data)[0] for _, _, peer, data in _opened(told)}
        if not rows:
            return _table([])
        (bucket, w, c, direct), = [(at, *unpack(data)) for kind, at, _, data in rows if kind == WORDS]
        k, t = direct.view(np.int64).copy(), np.zeros(len(w), np.int64)
        asks = [(peer, *_ints(data)) for kind, _, peer, data in rows if kind == ASK]
        for peer, asked, pairs, single, number in asks:
            to = t if peer & 1 else k
            to[asked] += got.get(peer, pairs)
            to[single] += number
        pt = draw_tables(k, np.full(len(k), base), _uniform(mix64(w + U(7919 * (sweep + 1)))), log_stirling(d0), d0)
        out = [(TO_CELL, peer >> 1, peer & 1, pack(t[i]) if peer & 1 else pack(k[i], pt[i])) for peer, i, *_ in asks if len(i)]
        return _table([*out, (SAMPLE, bucket, sweep, pack(c, k, pt, t) if keep else b"", int(k.sum()), int(pt.sum()))])

    return run


class Sample(NamedTuple):
    """One pass over the words: parcels, and sums of customers and tables in the parent."""

    rows: DataFrame
    customers: int
    tables: int

    def base(self, types: int, d0: float) -> float:
        return (THETA + d0 * self.tables) / (types + 1)


class Parent(NamedTuple):
    """What a sample's probabilities in the parent take besides each word's customers k and tables pt."""

    base: float
    customers: int
    discount: float

    def p1(self, k: np.ndarray, pt: np.ndarray) -> np.ndarray:
        return (k - self.discount * pt + self.base) / (THETA + self.customers)


def _seat_pairs(parent: Parent, buckets: int, d: float, sweep: int, keep: bool, first: bool):
    """A pass over a cell's repeated pairs: new tables given their contexts' and words' totals."""

    def run(state: pa.Table, told: pa.Table) -> pa.Table:
        rows = _opened(state)
        if not any(kind == HASH for kind, *_ in rows):
            return _table([])
        (cell, word, ctx, n), = [(at, *_ints(data)) for kind, at, _, data in rows if kind == PAIRS]
        word_hash, ctx_hash = [unpack(data)[0] for kind, _, _, data in rows if kind == HASH]
        (k, pt), (total,) = [_ints(data) for *_, data in _opened(told)]
        weight = ((THETA + d * total)[ctx]) * parent.p1(k, pt)[word]
        chance = _uniform(mix64(pair_hash(ctx_hash[ctx], word_hash[word]) + U(104729 * (sweep + 1))))
        t = draw_tables(n, weight, chance, log_stirling(d), d)
        out = [(TO_BUCKET, bucket, 2 * cell + side, pack(np.bincount(of, t, size).astype(np.int64)))
               for side, (of, size, bucket) in enumerate(((word, len(k), cell % buckets), (ctx, len(total), cell // buckets)))]
        return _table([*out, *([(KEPT, cell, sweep, pack(t, n) if first else pack(t))] if keep else [])])

    return run


def _answer_words(t: pa.Table) -> pa.Table:
    """To each block, of its words in a bucket: the count, then customers, tables in the parent and tables as a context of each sample."""
    rows = _opened(t)
    samples = [_ints(data) for kind, *_, data in rows if kind == SAMPLE]
    arrays = [samples[0][0], *(x for s in samples for x in s[1:])]
    out = []
    for kind, bucket, block, data in rows:
        if kind == IDS:
            i, = _ints(data)
            out.append((IDS, block, bucket, pack(*(x[i] for x in arrays))))
    return _table(out)


def _answer_pairs(t: pa.Table) -> pa.Table:
    """To each block, of its pairs in a cell: the count and the sum of the samples' tables."""
    rows = _opened(t)
    samples = [_ints(data) for kind, *_, data in rows if kind == KEPT]
    n = next((s[1] for s in samples if len(s) > 1), None)
    kept = sum(s[0] for s in samples)
    out = []
    for kind, cell, block, data in rows:
        if kind == LISTS:
            met, place = _ints(data)
            count, tables, again = met.copy(), met * SAMPLES, met == 2
            if len(place):
                count[again], tables[again] = n[place], kept[place]
            out.append((LISTS, block, cell, pack(count, tables)))
    return _table(out)


# ---------------------------------------------------------------- model

class Model(NamedTuple):
    frequent: np.ndarray | None
    buckets: int
    tokens: int
    types: int
    discount: float
    parents: list[Parent]  # by sample
    answers: DataFrame     # parcels to blocks, of their words and pairs


def _blocked(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Documents with their block: the partition, and the row's place in it by BLOCK_DOCS."""
    row = F.monotonically_increasing_id()
    block = F.shiftright(row, 33) * F.lit(1 << 24) + F.floor(row.bitwiseAND(F.lit((1 << 33) - 1)) / BLOCK_DOCS)
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text"), (~held_out(key)).alias("train")).withColumn("block", block)


def _grouped(rows: DataFrame, run) -> DataFrame:
    return rows.groupBy("at").applyInArrow(run, PARCEL)


def _kind(rows: DataFrame, *kinds: int) -> DataFrame:
    return rows.where(F.col("kind").isin(*kinds))


def _kept(rows: DataFrame) -> DataFrame:
    """Parcels dealt by their group and kept so, as each pass reads them again."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "at").persist(StorageLevel.DISK_ONLY)


def fit(docs: DataFrame, contexts: int | None = None) -> Model:
    """Model of the training documents of ``docs`` (blocked)."""
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    buckets = max(1, math.isqrt(max(0, size - 1) // CELL_BYTES) + 1)
    frequent = None
    if contexts is not None:
        end = int(np.array([END]).view(np.int64)[0])
        counts = _block_words(docs).groupBy("w").agg(F.sum("n").alias("c")).where(f"c > 0 and w != {end}")
        top = counts.orderBy(F.desc("c"), "w").limit(contexts).select("w").collect()  # at most ``contexts`` rows
        frequent = np.sort(np.array([r[0] for r in top], np.int64).view(U))

    words = stored(_grouped(_from_blocks(docs, buckets, frequent, _send_words), _merge_words), "pitman_yor_words")
    types, total, *ones = _sums(_kind(words, WORDS), "a", "b", "c", "d")
    sent = _from_blocks(docs, buckets, frequent, _send_pairs).unionByName(_kind(words, IDS))
    pairs = stored(_grouped(_grouped(sent, _deal_pairs(buckets)), _merge_pairs(buckets)), "pitman_yor_pairs")

    def discount(n1, n2):
        return min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 else 0.5

    d, d0 = discount(*_sums(_kind(pairs, PAIRS), "a", "b")), discount(*ones)
    by_bucket = _kept(_kind(words, WORDS).unionByName(_kind(pairs, ASK)))
    by_cell = _kept(_kind(pairs, PAIRS).unionByName(_grouped(by_bucket, _tell_hashes)))

    def words_pass(told, base, sweep, keep):
        run = _seat_words(base, d0, sweep, keep)
        rows = stored(by_bucket.groupBy("at").cogroup(told.groupBy("at")).applyInArrow(run, PARCEL), "pitman_yor_sample")
        return Sample(rows, *_sums(_kind(rows, SAMPLE), "a", "b"))

    last = words_pass(spark.createDataFrame([], PARCEL), (THETA + d0 * types) / (types + 1), 0, False)
    parents, kept = [], []
    for i in range(BURN_IN + SAMPLES):
        keep = i >= BURN_IN
        run = _seat_pairs(Parent(last.base(types, d0), last.customers, d0), buckets, d, i, keep, i == BURN_IN)
        told = _kind(last.rows, TO_CELL)
        seated = stored(by_cell.groupBy("at").cogroup(told.groupBy("at")).applyInArrow(run, PARCEL), "pitman_yor_seated")
        last = words_pass(_kind(seated, TO_BUCKET), last.base(types, d0), i + 1, keep)
        if keep:
            parents.append(Parent(last.base(types, d0), last.customers, d0))
            kept += [_kind(last.rows, SAMPLE), _kind(seated, KEPT)]
    by_bucket.unpersist()
    by_cell.unpersist()
    of_words, of_pairs = _kind(words, IDS).select("kind", F.col("peer").alias("at"), F.col("at").alias("peer"), "data", "a", "b", "c", "d"), _kind(pairs, LISTS)
    for sample, seated in zip(kept[::2], kept[1::2]):
        of_words, of_pairs = of_words.unionByName(sample), of_pairs.unionByName(seated)
    return Model(frequent, buckets, total, types, d, parents, _grouped(of_words, _answer_words).unionByName(_grouped(of_pairs, _answer_pairs)))


def _sums(rows: DataFrame, *columns: str) -> list[int]:
    return [int(x or 0) for x in rows.agg(*(F.sum(c) for c in columns)).first()]


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", contexts: int | None = None) -> DataFrame:
    """Train on documents that are not held out and score all.

    Returns key, held_out, n_tokens, n_known, train_tokens, base_score and
    score, one row per input row. Null text counts as empty (one end token); a
    null key is held out; repeated rows count and are scored each; extra
    columns are not read. With no training document every token is unknown and
    has the uniform base's probability. ``docs`` is read several times and must
    give its rows in the same order each time, as a stored table does.
    ``contexts`` limits restaurants to those of so many frequent words; tokens
    after any other word then sit in the parent directly.
    """
    blocked = _blocked(docs, key, text)
    model = fit(blocked, contexts)
    known = model._replace(answers=None)
    kind = docs.schema[key].dataType.simpleString()
    arrow = {"bigint": pa.int64(), "int": pa.int32()}.get(kind)

    def score(t: pa.Table) -> pa.Table:
        rows = {}
        for what, _, peer, data in _opened(t):
            rows.setdefault(what, []).append((peer, data))
        raw = zstandard.ZstdDecompressor().decompress(rows[KEYS][0][1])
        part = pa.ipc.open_stream(raw).read_all()
        length, train = part.column("length").to_numpy(), part.column("train").to_numpy()
        at, bare = _ints(rows[TOKENS][0][1])
        base, score, seen = _score_block(at, bare > 0, np.cumsum(length) - length, [(j, _ints(x)) for j, x in rows[IDS]],
                                         [_ints(x) for _, x in rows.get(LISTS, [])], known)
        keys = part.column("key")
        return pa.table({key: keys.cast(arrow) if arrow else keys, "held_out": ~train, "n_tokens": length, "n_known": seen,
                         "train_tokens": np.full(len(length), known.tokens), "base_score": base, "score": score})

    sent = _from_blocks(blocked, model.buckets, model.frequent, _send_tokens).unionByName(model.answers)
    return sent.groupBy("at").applyInArrow(
        score, f"`{key}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _score_block(at: np.ndarray, bare: np.ndarray, first: np.ndarray, of_words: list, of_pairs: list, m: Model):
    ctx, seated = _before(at, first, bare)
    bucket = np.repeat([j for j, _ in of_words], [len(x[0]) for _, x in of_words])
    c, *samples = (np.concatenate(x) for x in zip(*(x for _, x in of_words)))
    count, customers = c[at], np.where(seated, c[ctx], 0)
    prob = np.zeros(len(at))
    for s, parent in enumerate(m.parents):
        k, pt, t = samples[3 * s:3 * s + 3]
        back = (THETA + m.discount * t) / (THETA + c)
        prob += parent.p1(k, pt)[at] * np.where(seated, back[ctx], 1.0) / len(m.parents)

    key, of = np.unique(_pair_keys(ctx, at)[seated], return_inverse=True)
    cell = bucket[(key >> U(32)).astype(np.int64)] * m.buckets + bucket[(key & _LOW).astype(np.int64)]
    order = np.argsort(cell, kind="stable")
    n, tables = np.zeros(len(key), np.int64), np.zeros(len(key))
    if of_pairs:
        n[order], tables[order] = (np.concatenate(x) for x in zip(*of_pairs))
    prob[seated] += (n - m.discount * (tables / SAMPLES))[of] / (THETA + customers[seated])

    base = np.log10((count + 0.1) / (m.tokens + 0.1 * (m.types + 1)))
    return np.add.reduceat(base, first), np.add.reduceat(np.log10(prob), first), np.add.reduceat((count > 0).astype(np.int64), first)


def perplexity(scored: DataFrame) -> DataFrame:
    """Tokens, perplexity of the model and of the base, over training and held-out documents."""
    def ppl(c):
        return F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))

    return scored.groupBy("held_out").agg(F.sum("n_tokens").alias("n_tokens"), ppl("score").alias("perplexity"),
                                          ppl("base_score").alias("base_perplexity"))


def query(spark, sf_dir: str) -> DataFrame:
    """Contract columns of operator 5 over all documents."""
    return score_documents(table(spark, sf_dir, "documents"))
