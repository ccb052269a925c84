"""Byte-level BPE over a pair occurrence index (operator 1).

Each task takes its documents in blocks, splits them into pre-tokens and
encodes the block's distinct new pre-tokens together: their symbols lie in one
linked sequence, an index maps every adjacent pair to all its positions, and
the pairs' merge ranks are applied in ascending order; applying a rank touches
only that pair's positions and the lists of the pairs next to them. This equals
the usual merge loop, because a merge of rank r can only create pairs of higher
rank (checked when the vocabulary is loaded). Where only numbers of tokens
are asked for (operator 6), short pre-tokens are merged as rows of matrices.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textnp import parts

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: Bytes of text encoded together, and distinct pre-tokens remembered by a task.
BLOCK_BYTES = 2 << 20
REMEMBER = 1_000_000
#: Bytes of the words that are counted together as rows of a matrix, and rows of one matrix; longer words go through the index.
WIDTHS, MATRIX_ROWS = (8, 16, 32), 1 << 14
NO_RANK = np.int32(2**31 - 1)

_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.A)
_SIMPLE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_FULL = regex.compile(public_tokenizers.PATTERN)
_CLASSES = [(re.compile(a), regex.compile(b)) for a, b in
            ((r"[^\W\d_]", r"\p{L}"), (r"\d", r"\p{N}"), (r"\s", r"\s"))]


class Splitter:
    """Pre-tokens of a text, as the vocabulary's pre-tokenizer makes them.

    The pattern of the vocabulary is run by the quickest engine that knows the
    text's characters: ``re`` where its classes agree with Unicode's letters
    and numbers, else ``regex``, else (characters younger than Python's
    Unicode tables) the pre-tokenizer of the tokenizers library itself.
    """

    def __init__(self, pre_tokenizer):
        self.pre_tokenizer = pre_tokenizer
        self.simple: set[str] = set()
        self.known: set[str] = set()

    def _sort(self, c: str) -> None:
        if unicodedata.category(c) in ("Cn", "Co", "Cs"):
            return
        self.known.add(c)
        if all(bool(a.match(c)) == bool(b.match(c)) for a, b in _CLASSES):
            self.simple.add(c)

    def _engine(self, text: str):
        if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return _ASCII
        chars = set(text)
        for c in chars - self.known:
            self._sort(c)
        return _SIMPLE if chars <= self.simple else _FULL if chars <= self.known else None

    def scanner(self, text: str):
        """Function of (text, start) that yields the matches from a boundary on; None if only the library can split it."""
        engine = self._engine(text)
        return engine and engine.finditer

    def __call__(self, text: str) -> list[str]:
        engine = self._engine(text)
        if engine is not None:
            return engine.findall(text)
        return [text[a:b] for _, (a, b) in self.pre_tokenizer.pre_tokenize_str(text)]


class Vocabulary:
    """Ids, bytes and merge ranks of a byte-level BPE file."""

    remember = REMEMBER

    def __init__(self, path: str):
        from tokenizers import Tokenizer  # the library's pre-tokenizer, for characters nothing else knows

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = _byte_of_char()
        model = spec["model"]
        self.bytes = {i: bytes(byte[c] for c in t) for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for t, i in self.special.items():
            self.bytes[i] = t.encode()
        self.of_byte = np.zeros(256, np.int64)
        for t, i in model["vocab"].items():
            if len(t) == 1:
                self.of_byte[byte[t]] = i
        self.rank: dict[int, int] = {}  # left id << 20 | right id -> rank
        self.pairs: list[tuple[int, int]] = []
        self.merged: list[int] = []
        self.byte_rank = np.full((256, 256), -1, np.int32)
        made: dict[int, int] = {}
        for r, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            ia, ib, new = model["vocab"][a], model["vocab"][b], model["vocab"][a + b]
            if made.get(ia, -1) >= r or made.get(ib, -1) >= r:
                raise ValueError("a merge uses a token that only a later merge makes")
            made.setdefault(new, r)
            self.rank[ia << 20 | ib] = r
            self.pairs.append((ia, ib))
            self.merged.append(new)
            if len(a) == len(b) == 1:
                self.byte_rank[byte[a], byte[b]] = r
        self.merged_array = np.array(self.merged, np.int64)
        keys = np.fromiter(self.rank, np.int64, len(self.rank))
        order = np.argsort(keys)
        self.keys, self.key_ranks = keys[order], np.fromiter(self.rank.values(), np.int32, len(keys))[order]
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.split = Splitter(Tokenizer.from_file(path).pre_tokenizer)
        self.ids: dict[str, bytes] = {}  # pre-token -> its ids, little-endian 32-bit
        self.sizes: dict[str, int] = {}  # pre-token -> its number of tokens

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens and special tokens in order; their concatenation is the text."""
        if self.special_split is None or not any(s in text for s in self.special):
            return self.split(text)
        out: list[str] = []
        for part in self.special_split.split(text):
            if part in self.special:
                out.append(part)
            elif part:
                out += self.split(part)
        return out

    def _unknown(self, held: dict, pieces: Iterable[str]) -> list[str]:
        """Distinct pieces that ``held`` lacks; it is emptied first where they would not fit."""
        distinct = set(pieces)
        new = list(distinct.difference(held))
        if len(held) + len(new) > self.remember:
            held.clear()
            new = list(distinct)
        return new

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode the distinct pieces that are not remembered yet."""
        plain = []
        for p in self._unknown(self.ids, pieces):
            if p in self.special:
                self.ids[p] = array("I", [self.special[p]]).tobytes()
            else:
                plain.append(p)
        for p, ids in zip(plain, self._merge([p.encode() for p in plain]), strict=True):
            self.ids[p] = ids

    def measure(self, pieces: Iterable[str]) -> None:
        """Count the tokens of the distinct pieces whose number is not remembered yet; their ids are not kept."""
        new = self._unknown(self.sizes, pieces)
        self.sizes.update(zip(new, self._tokens([p.encode() for p in new]), strict=True))
        self.sizes.update((p, 1) for p in self.special if p in self.sizes)

    def _tokens(self, words: list[bytes]) -> list[int]:
        """Number of tokens of each word: short ones as rows of matrices by length, the others by the index."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        out = np.zeros(len(words), np.int64)
        kinds = np.searchsorted(WIDTHS, lengths)
        for kind, width in enumerate(WIDTHS):
            rows = np.flatnonzero(kinds == kind)
            for i in range(0, len(rows), MATRIX_ROWS):
                part = rows[i:i + MATRIX_ROWS]
                raw = np.frombuffer(b"".join([words[k].ljust(width, b"\0") for k in part.tolist()]), np.uint8)
                out[part] = self._merge_rows(raw.reshape(-1, width), lengths[part])
        rest = np.flatnonzero(kinds == len(WIDTHS))
        out[rest] = [len(ids) >> 2 for ids in self._merge([words[k] for k in rest.tolist()])]
        return out.tolist()

    def _merge_rows(self, raw: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Number of tokens of words that are the rows of a matrix, ``lengths`` of whose bytes count.

        Each round merges the first pair of least rank of every row that has
        one; so every row left is one symbol shorter, and the matrix one
        column narrower.
        """
        cols = np.arange(raw.shape[1])
        tok = np.where(cols < lengths[:, None], self.of_byte[raw], -1)
        ranks = self.byte_rank[raw[:, :-1], raw[:, 1:]]
        ranks[(ranks < 0) | (cols[1:] >= lengths[:, None])] = NO_RANK
        n, rows = lengths.copy(), np.arange(len(raw))
        while ranks.size:
            at = ranks.argmin(axis=1)
            r = ranks[np.arange(len(rows)), at]
            live = np.flatnonzero(r < NO_RANK)
            if len(live) < len(rows):
                tok, ranks, at, r, rows = tok[live], ranks[live], at[live], r[live], rows[live]
            n[rows] -= 1
            keep = cols[:tok.shape[1] - 1] <= at[:, None]
            tok = np.where(keep, tok[:, :-1], tok[:, 1:])
            ranks = np.where(keep[:, :-1], ranks[:, :-1], ranks[:, 1:])
            new = self.merged_array[r]
            tok[np.arange(len(rows)), at] = new
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self._ranks(tok[left, at[left] - 1], new[left])
            right = np.flatnonzero(at < ranks.shape[1])
            ranks[right, at[right]] = self._ranks(new[right], tok[right, at[right] + 1])
        return n

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs of symbols, NO_RANK where they do not merge."""
        key = left << 20 | right
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[i] == key, self.key_ranks[i], NO_RANK)

    def _merge(self, words: list[bytes]) -> Iterator[bytes]:
        if not words:
            return
        rank, merged, pairs = self.rank, self.merged, self.pairs
        # One sequence of symbols for all words, -1 around each, with links over merged positions.
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(lengths)
        first = np.zeros(len(raw) + 1, bool)
        first[ends] = True
        at = np.arange(len(raw)) + 1 + np.repeat(np.arange(len(words)), lengths)
        symbols = np.full(len(raw) + len(words) + 1, -1, np.int64)
        symbols[at] = self.of_byte[raw]
        tok = symbols.tolist()
        n = len(tok)
        prev, nxt = list(range(-1, n - 1)), list(range(1, n + 1))
        nxt[-1] = n - 1
        # The index: active rank -> positions of its pair's left symbol.
        starts = self.byte_rank[raw[:-1], raw[1:]]
        starts[first[1:-1]] = -1
        held = np.flatnonzero(starts >= 0)
        held = held[np.argsort(starts[held], kind="stable")]
        ranks, cut = np.unique(starts[held], return_index=True)
        index: dict[int, list[int]] = {
            r: p.tolist() for r, p in zip(ranks.tolist(), np.split(at[held], cut[1:]), strict=True)} if len(held) else {}
        active = list(index)
        heapq.heapify(active)
        get, pop, push = rank.get, heapq.heappop, heapq.heappush
        while active:
            r = pop(active)
            a, b = pairs[r]
            new = merged[r]
            positions = index.pop(r)
            if a == b:
                positions.sort()  # left to right, as overlapping pairs ("aaa") need
            for i in positions:
                if tok[i] != a:
                    continue  # merged away since it was listed
                j = nxt[i]
                if tok[j] != b:
                    continue
                tok[i] = new
                tok[j] = -2
                k = nxt[j]
                nxt[i] = k
                prev[k] = i
                q = get(new << 20 | tok[k])
                if q is not None:
                    if q in index:
                        index[q].append(i)
                    else:
                        index[q] = [i]
                        push(active, q)
                h = prev[i]
                q = get(tok[h] << 20 | new)
                if q is not None:
                    if q in index:
                        index[q].append(h)
                    else:
                        index[q] = [h]
                        push(active, q)
        left = np.array(tok, np.int64)
        left = left[left != -2]
        bounds = np.flatnonzero(left == -1)
        data = left.astype("<u4").tobytes()
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            yield data[4 * a + 4:4 * b]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        split = [self.pieces(t) for t in texts]
        self.learn(p for s in split for p in s)
        get = self.ids.__getitem__
        return [b"".join(map(get, s)) for s in split]

    def decode(self, ids: bytes) -> str:
        """The text of ids; invalid UTF-8 becomes the replacement character."""
        get = self.bytes.__getitem__
        return b"".join(map(get, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def _byte_of_char() -> dict[str, int]:
    """Byte for each character by which byte-level vocabularies write it: printable
    Latin-1 characters stand for themselves, other bytes follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out = {chr(b): b for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in set(plain)):
        out[chr(256 + k)] = b
    return out


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary at ``path``, loaded once by each Python worker."""
    return Vocabulary(path)


def blocks(batches: Iterable[pa.RecordBatch], text: int, size: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of record batches with about ``size`` bytes of text, and the texts (null: empty)."""
    for part in parts(batches, text, size):
        yield part, [t or "" for t in part.column(text).to_pylist()]


def encode_decode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """Encode every whole text and decode its ids again.

    Returns key, n_tokens, ids (binary: little-endian unsigned 32-bit) and
    decoded, one row per input row. A null text is encoded as the empty one:
    no ids, empty decoded text. Keys may be null or repeat; other columns are
    not read. Python: a merge loop over strings has no DataFrame form.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        v = vocabulary(path)
        for part, texts in blocks(batches, 1):
            ids = v.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                 pa.array([v.decode(x) for x in ids], pa.string())], names=[key, "n_tokens", "ids", "decoded"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_tokens long, ids binary, decoded string")


def query(spark, sf_dir: str) -> DataFrame:
    """Contract columns of operator 1 over all documents."""
    from .common import table

    out = encode_decode(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
