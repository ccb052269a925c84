"""Best-fit packing by bin completion (operator 7).

Documents become pieces of at most ``size`` tokens. Only a piece's length
matters for packing, so the histogram of lengths (at most ``size`` numbers, for
any corpus) is solved on the driver by bin completion: around the largest
remaining length the undominated fillings are enumerated, a plan is cut off
when its waste already makes it no better than the incumbent, and incumbents
are best-fit plans. The solution is a bounded list of patterns; every piece
then finds its sequence and offset from its rank among the pieces of its
length, in Spark. The task that cuts the pieces numbers those of a length as it
goes, so a rank is that number plus the counts of the tasks before: pieces are
neither sorted nor shuffled.
"""

from __future__ import annotations

import functools
import re
import zlib
from bisect import bisect_left
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe
from .common import stored, table

SIZE = 1024
END = 2
#: Counts (24 bytes each, at most ``size`` for each task that cut pieces) that are broadcast to the pieces; more are joined by shuffle.
BROADCAST_COUNTS = 300_000
#: White space in a row from which on a text is split here: tiktoken's pattern engine keeps a state for each such character.
LONG_SPACE = re.compile(r"\s{5000}")
#: Fillings tried in each phase of the search for a plan with fewer sequences; in the second, PATHS more for each pattern of the plan.
SEARCH_NODES = 4000
PATHS = 8
#: Distinct lengths left at which a node counts as near the leaves, and fillings of its enumeration there.
FEW, NEAR = 12, 256


class RankVocabulary(bpe.Vocabulary):
    """The same ids, made by tiktoken from the vocabulary's own pattern and ranks.

    Texts with special tokens, with characters younger than Python's Unicode
    tables or with very long white space are split as in the vocabulary, and
    tiktoken only merges their pre-tokens. Little is remembered, and nothing
    from task to task: other stages of a pipeline share the executor's memory.
    """

    remember = 150_000

    def __init__(self, path: str):
        super().__init__(path)
        import tiktoken

        if any(x >= y for x, y in zip(self.merged, self.merged[1:])):
            raise ValueError("ids do not follow the merge order")
        special = set(self.special.values())
        self._core = tiktoken.Encoding(
            "pack", pat_str=bpe.public_tokenizers.PATTERN, special_tokens={},
            mergeable_ranks={b: i for i, b in self.bytes.items() if i not in special})

    def encode(self, texts: list[str]) -> list[bytes]:
        whole = self._core.encode_to_numpy
        return [whole(t, disallowed_special=()).astype("<u4", copy=False).tobytes() if self._regular(t) else super(RankVocabulary, self).encode([t])[0]
                for t in texts]

    def _regular(self, text: str) -> bool:
        """Whether tiktoken's pattern splits ``text`` as the vocabulary's does, in bounded memory."""
        return (self.split.scanner(text) is not None and not any(s in text for s in self.special)
                and (len(text) < 5000 or LONG_SPACE.search(text) is None))

    def _merge(self, words):
        one = self._core._core_bpe.encode_single_piece
        for w in words:
            yield np.array(one(w), "<u4").tobytes()


@functools.lru_cache(maxsize=2)
def _vocabulary(path: str) -> RankVocabulary:
    return RankVocabulary(path)


# ---------------------------------------------------------------- pieces

def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = bpe.VOCABULARY,
           size: int = SIZE, end: int = END, with_ids: bool = False, numbered: bool = False) -> DataFrame:
    """Cut every document (its ids, then ``end``) into pieces of at most ``size`` tokens.

    A document of up to ``size`` tokens is one piece; of a longer one every
    piece is full but the first. Null text counts as empty (one piece of one
    token). Returns key, piece, start, length, ids_crc32 and, when asked, ids;
    ``numbered`` adds _block (the task) and _number (from 0 among the block's
    pieces of that length), which hold together only once they are stored.
    """
    kind = docs.schema[key].dataType.simpleString()
    last = np.array([end], "<u4").tobytes()

    def run(batches):
        v = _vocabulary(path)
        block, met = TaskContext.get().partitionId(), [0] * (size + 1)
        for part, texts in bpe.blocks(batches, 1):
            rows, piece, start, length, crc, raw, number = [], [], [], [], [], [], []
            for row, ids in enumerate(v.encode(texts)):
                ids += last
                n = len(ids) // 4
                at, k = 0, 0
                while at < n:
                    upto = at + (n % size or size) if k == 0 else at + size
                    cut = ids[4 * at:4 * upto]
                    rows.append(row)
                    piece.append(k)
                    start.append(at)
                    length.append(upto - at)
                    crc.append(zlib.crc32(cut))
                    number.append(met[upto - at])
                    met[upto - at] += 1
                    if with_ids:
                        raw.append(cut)
                    at, k = upto, k + 1
            columns = [part.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                       pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = [key, "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(raw, pa.binary()))
                names.append("ids")
            if numbered:
                columns += [pa.array([block] * len(rows), pa.int32()), pa.array(number, pa.int64())]
                names += ["_block", "_number"]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        v.ids.clear()
        pa.default_memory_pool().release_unused()

    schema = f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids + ", _block int, _number long" * numbered
    return docs.select(key, text).mapInArrow(run, schema)


# ---------------------------------------------------------------- solver

def fillings(counts: np.ndarray, room: int, limit: int = 64, few: int = 0, most: int = 64) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room`` from the lengths with counts, fullest first.

    A filling is dominated when another one holds a longer piece in the place
    of one or more of its own; a filling whose waste admits no remaining
    length, and in which no piece can be exchanged for a longer one, is not.
    At most ``limit`` are found, those with the longest pieces first, and the
    first ``most`` of them returned. With at most ``few`` lengths left, all
    pieces are tried at every place, for up to NEAR fillings.
    """
    at = np.flatnonzero(counts[:room + 1])[::-1]
    sizes = at.tolist()
    if not sizes:
        return [()]
    left = counts[at].tolist()  # of each size, less what is chosen
    near = len(sizes) <= few
    limit = NEAR if near else limit
    upto, least = [-s for s in sizes], sizes[-1]  # upto ascends, to find the longest piece that fits
    out: list[tuple[int, tuple[int, ...]]] = []  # less the waste, pieces
    steps = 0

    def grow(k: int, room: int, chosen: tuple[int, ...]) -> None:
        nonlocal steps
        steps += 1
        if len(out) >= limit or steps > 20 * limit:
            return
        fits = False
        tried = 0
        for i in range(bisect_left(upto, -room, k), len(sizes)):
            if not left[i]:
                continue
            s = sizes[i]
            fits = True
            rest = room - s
            if rest < least:  # nothing more fits
                steps += 1
                if len(out) < limit and steps <= 20 * limit:
                    out.append((-rest, (*chosen, s)))
            else:
                left[i] -= 1
                grow(i, rest, (*chosen, s))
                left[i] += 1
            tried += 1
            if rest == 0 or (tried >= 4 and not near) or len(out) >= limit:
                break  # an exact fit dominates every filling of shorter pieces
        if not fits:
            out.append((-room, chosen))

    grow(0, room, ())
    if most == 1:
        return [max(out)[1]]
    keep: list[tuple[int, ...]] = []
    for _, f in sorted(out, reverse=True):  # of equal waste none begins another
        if not any(_dominates(g, f) for g in keep):
            keep.append(f)
            if len(keep) == most:
                break
    return keep


def _dominates(a: tuple[int, ...], b: tuple[int, ...]) -> bool:
    """Whether the pieces of ``b`` fit, first-fit, into bins of the sizes of ``a``."""
    bins = list(a)
    for s in b:
        for i, x in enumerate(bins):
            if s <= x:
                bins[i] = x - s
                break
        else:
            return False
    return True


def best_fit(counts: np.ndarray, size: int) -> list[tuple[int, tuple[int, ...]]]:
    """Incumbent: around the largest length, always the longest piece that fits, in runs of equal bins."""
    return _plan(counts, size, lambda c, room: _greedy(c, room))


def _greedy(counts: np.ndarray, room: int) -> tuple[int, ...]:
    out: list[int] = []
    used: dict[int, int] = {}
    s = room
    while room > 0:
        s = min(s, room)
        while s > 0 and counts[s] - used.get(s, 0) <= 0:
            s -= 1
        if s <= 0:
            break
        out.append(s)
        used[s] = used.get(s, 0) + 1
        room -= s
    return tuple(out)


def _plan(counts: np.ndarray, size: int, choose: Callable) -> list[tuple[int, tuple[int, ...]]]:
    left = counts.astype(np.int64).copy()
    plan = []
    for big in range(size, 0, -1):
        while left[big]:
            left[big] -= 1
            fill = choose(left, size - big)
            left[big] += 1
            need: dict[int, int] = {}
            for s in (big, *fill):
                need[s] = need.get(s, 0) + 1
            times = int(min(left[s] // k for s, k in need.items()))
            for s, k in need.items():
                left[s] -= k * times
            plan.append((times, (big, *fill)))
    return plan


def bins(plan: list[tuple[int, tuple[int, ...]]]) -> int:
    return sum(t for t, _ in plan)


def lower_bound(counts: np.ndarray, size: int) -> int:
    """Sequences that any plan needs: by volume, and by dual feasible functions, which round lengths to k-ths of the size."""
    lengths = np.arange(len(counts))
    out = max(-(-int((counts * lengths).sum()) // size), int(counts[size // 2 + 1:].sum()))
    for k in range(1, 51):
        # in k-ths times size, so that all numbers are integers; multiples of size / (k + 1) keep their length
        f = np.where((k + 1) * lengths % size == 0, k * lengths, (k + 1) * lengths // size * size)
        out = max(out, -(-int((counts * f).sum()) // (k * size)))
    return out


def _take(left: np.ndarray, big: int, fill: tuple[int, ...]) -> int:
    """Take the bin from the counts as often as they hold it; returns how often."""
    need: dict[int, int] = {}
    for s in (big, *fill):
        need[s] = need.get(s, 0) + 1
    times = int(min(left[s] // k for s, k in need.items()))
    for s, k in need.items():
        left[s] -= k * times
    return times


def complete(counts: np.ndarray, size: int, nodes: int = SEARCH_NODES) -> list[tuple[int, tuple[int, ...]]]:
    """Bin completion over a histogram of lengths (index 1..size): (times, lengths) patterns.

    Depth-first over the undominated fillings around the largest remaining
    length, equal bins in runs, for ``nodes`` fillings: on a histogram of many
    lengths, that is a few dives. Then limited discrepancy: along the incumbent, from its leaf upwards, every other filling of a node
    is dived from; a dive ends when its bins and the volume left allow no plan
    smaller than the incumbent, and a smaller plan becomes the incumbent, whose
    nodes are tried from its leaf again. The search ends when the incumbent
    meets the lower bound, when all its nodes are tried, or after ``nodes``
    fillings more and PATHS for each pattern. The result is never worse than
    best fit.
    """
    counts = np.asarray(counts, np.int64)
    lengths = np.arange(len(counts))
    volume, bound = int((counts * lengths).sum()), lower_bound(counts, size)
    best = best_fit(counts, size)
    least = bins(best)
    tried = 0
    for width in (1, 2, 4, 8):  # few discrepancies first, then more of each node's fillings
        if least <= bound or tried >= nodes:
            break
        stack: list[tuple[np.ndarray, list, int, int, int]] = [(counts.copy(), [], 0, 0, size)]
        first_budget = tried + nodes // 4
        while stack and tried < min(nodes, first_budget) and least > bound:
            left, plan, used, waste, big = stack.pop()
            while big and not left[big]:
                big -= 1
            if not big:
                if used < least:
                    best, least = plan, used
                continue
            rest = int((left * lengths).sum())
            if used + -(-rest // size) >= least or waste >= least * size - volume:
                continue
            tried += 1
            left[big] -= 1
            options = fillings(left, size - big, most=width)
            left[big] += 1
            for fill in reversed(options):
                after = left.copy()
                times = _take(after, big, fill)
                stack.append((after, [*plan, (times, (big, *fill))], used + times,
                              waste + times * (size - big - sum(fill)), big))
    tried, budget = 0, nodes + PATHS * len(best)

    def options(left: np.ndarray, big: int, most: int = 64) -> list[tuple[int, ...]]:
        nonlocal tried
        tried += 1
        left[big] -= 1
        out = fillings(left, size - big, few=FEW, most=most)
        left[big] += 1
        return out

    def dive(left: np.ndarray, fill: tuple[int, ...] | None, used: int) -> list | None:
        """Patterns for what is left, with ``fill`` in the first bin; None if they would not improve on the incumbent."""
        left, plan, rest = left.copy(), [], int((left * lengths).sum())
        big = size
        while rest:
            if used - (-rest // size) >= least or tried >= budget:
                return None
            while not left[big]:
                big -= 1
            fill = options(left, big, 1)[0] if fill is None else fill
            times = _take(left, big, fill)
            plan.append((times, (big, *fill)))
            used, rest, fill = used + times, rest - times * (big + sum(fill)), None
        return plan if used < least else None

    better = True
    while better and least > bound and tried < budget:
        better, left, states, used = False, counts.copy(), [], 0
        for times, (big, *fill) in best:
            states.append((left.copy(), used))
            used += _take(left, big, tuple(fill))
        for level in range(len(best) - 1, -1, -1):
            left, used = states[level]
            big, *now = best[level][1]
            for fill in options(left, big):
                if fill == tuple(now):
                    continue
                rest = dive(left, fill, used)
                if rest is not None:
                    best, better = [*best[:level], *rest], True
                    least = bins(best)
                    break
            if better or tried >= budget:
                break
    return best


# ---------------------------------------------------------------- assignment

def assign(cut: DataFrame, size: int = SIZE, nodes: int = SEARCH_NODES, broadcast_counts: int = BROADCAST_COUNTS) -> DataFrame:
    """Add sequence_id and offset to stored, numbered pieces (columns as ``pieces`` returns).

    A piece's rank within its length is its number in its block plus the
    pieces of that length in the blocks before, from one count for each block
    and length. ``cut`` must be stored, as it is read twice and a block's rows
    must keep their numbers.
    """
    spark = cut.sparkSession
    per = stored(cut.groupBy("_block", "length").agg(F.count(F.lit(1)).alias("n")), "pack_counts")
    counts = np.zeros(size + 1, np.int64)
    for length, n in per.groupBy("length").agg(F.sum("n")).collect():  # at most ``size`` rows
        counts[length] = n
    slots, base = [], 0
    taken = [0] * (size + 1)
    for times, lengths in complete(counts, size, nodes):
        at = 0
        for s in sorted(set(lengths), reverse=True):
            k = lengths.count(s)
            slots.append((s, taken[s], taken[s] + times * k, k, base, at))
            taken[s] += times * k
            at += k * s
        base += times
    before = F.sum("n").over(Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = per.select("_block", "length", F.coalesce(before, F.lit(0)).alias("_base"))  # a window holds a row for each block
    if per.count() <= broadcast_counts:
        offsets = F.broadcast(offsets)
    ranked = cut.join(offsets, ["_block", "length"]).withColumn("_rank", F.col("_number") + F.col("_base"))
    # Every pattern uses up a length and has at most sqrt(2 * size) different ones, so slots are bounded too.
    slot = spark.createDataFrame(slots, "_len long, _from long, _upto long, _k long, _seq long, _at long")
    hit = (F.col("length") == F.col("_len")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_upto"))
    out = ranked.join(F.broadcast(slot), hit)
    place = F.col("_rank") - F.col("_from")
    return out.select(*[c for c in cut.columns if c not in ("_block", "_number")],
                      (F.col("_seq") + F.floor(place / F.col("_k"))).alias("sequence_id"),
                      (F.col("_at") + place % F.col("_k") * F.col("length")).alias("offset"))


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = bpe.VOCABULARY,
         size: int = SIZE, end: int = END) -> DataFrame:
    """Pack all documents into as few sequences of at most ``size`` tokens as the search finds.

    One row per piece: key, piece, start, length, ids_crc32, sequence_id,
    offset. Null keys and repeated rows are packed like any other; an empty
    table gives no rows; other columns are not read. Python: encoding only.
    """
    return assign(stored(pieces(docs, key, text, path, size, end, numbered=True), "pack_pieces"), size)


def query(spark, sf_dir: str) -> DataFrame:
    """Contract columns of operator 7 over all documents."""
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
