"""Near-duplicate groups by SimHash and the generalised pigeonhole principle (operator 13).

Equal fingerprints are one node. The 64 bits are dealt to eight blocks of
correlated bits; partitions are runs of blocks. If partition i has threshold
t_i and the sum of t_i + 1 is ``distance`` + 1, two fingerprints at most
``distance`` apart differ by at most t_i within some partition i. Cuts and
unequal thresholds are chosen together by dynamic programming on estimated
candidate counts, which come from the blocks' full histograms over all nodes.

A node is probed under its own bits in a partition and under those at most half
the threshold away, so a pair within the threshold meets under some key. Every
link is verified on whole fingerprints. Where many nodes share a key they are
first linked to the least one; only nodes of different components that still
share a key are compared further, and those are dealt anew by the bits outside
the partition, again by the pigeonhole principle. No link between components is
lost.
"""

from __future__ import annotations

import json
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, table
from .components import components
from .textnp import released

BITS, BLOCK = 64, 8
SHINGLE, SEED, DISTANCE = 4, 42, 4
#: Shingles hashed at a time.
SLICE = 1 << 16
#: A key with over 1 / HOT of the rows is joined by broadcast: there are at most HOT such keys.
HOT = 1000
#: Keys (under 100 bytes each) that are broadcast to pick their nodes; more of them are joined by shuffle.
BROADCAST_KEYS = 300_000
#: Nodes of a key up to which they are compared as they are; those of a larger one are dealt anew first.
SMALL_CROWD = 64
#: Work of a compared pair against that of a probed key, for the choice of partitions.
PAIR_WORK = 1.0


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: str | None, size: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned fingerprint of a text; zero without words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and the six ASCII white-space characters only
    if not words:
        return 0
    size = min(size, len(words))
    data = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(words) - size + 1]
    ends = ends[size - 1:]
    ones = np.zeros(BITS, np.int64)
    one = xxhash.xxh64_intdigest
    for at in range(0, len(starts), SLICE):
        h = np.array([one(data[a:b], seed) for a, b in zip(starts[at:at + SLICE].tolist(), ends[at:at + SLICE].tolist())], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc, fp (the fingerprint's bits as a long) of every row."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                fp = np.array([fingerprint(t.as_py(), size, seed) for t in part.column(1)], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp)], names=["doc", "fp"])

    return docs.select(key, text).mapInArrow(released(run), f"doc {kind}, fp long")


# ---------------------------------------------------------------- choice of partitions

def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fp, "<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def joint_ones(nodes: DataFrame) -> np.ndarray:
    """64 x 64 counts of nodes with both bits set."""
    def run(batches):
        total = np.zeros((BITS, BITS), np.int64)
        for b in batches:
            fp = b.column(0).to_numpy()
            for at in range(0, len(fp), SLICE):
                x = _bits(fp[at:at + SLICE]).astype(np.float32)  # sums stay below 2**24, so they are exact
                total += (x.T @ x).astype(np.int64)
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i * BITS + j, pa.int32()), pa.array(total[i, j])], names=["at", "n"])

    out = np.zeros(BITS * BITS, np.int64)
    for r in nodes.select("fp").mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():  # 4096 rows
        out[r["at"]] = r["n"]
    return out.reshape(BITS, BITS)


def correlated_blocks(joint: np.ndarray, n: int) -> list[list[int]]:
    """Eight blocks of eight bits: each takes the bit most correlated with it until it is full."""
    p = joint.diagonal() / max(n, 1)
    spread = np.sqrt(p * (1 - p))
    with np.errstate(divide="ignore", invalid="ignore"):
        r = np.nan_to_num(np.abs((joint / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)), posinf=0.0)
    np.fill_diagonal(r, 0)
    left, blocks = list(range(BITS)), []
    while left:
        sub = r[np.ix_(left, left)]
        block = [left.pop(int(sub.max(1).argmax()))]
        while len(block) < BLOCK:
            block.append(left.pop(int(r[np.ix_(left, block)].sum(1).argmax())))
        blocks.append(sorted(block))
    return blocks


def block_values(nodes: DataFrame, blocks: list[list[int]]) -> np.ndarray:
    """Per block, the counts of its 256 values over all nodes."""
    weights = 1 << np.arange(BLOCK)

    def run(batches):
        total = np.zeros((len(blocks), 1 << BLOCK), np.int64)
        for b in batches:
            x = _bits(b.column(0).to_numpy())
            for k, block in enumerate(blocks):
                total[k] += np.bincount(x[:, block] @ weights, minlength=1 << BLOCK)
        k, v = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k * (1 << BLOCK) + v, pa.int32()), pa.array(total[k, v])], names=["at", "n"])

    out = np.zeros(len(blocks) << BLOCK, np.int64)
    for r in nodes.select("fp").mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():  # 2048 rows
        out[r["at"]] = r["n"]
    return out.reshape(len(blocks), 1 << BLOCK)


def distance_shares(counts: np.ndarray) -> np.ndarray:
    """Share of all ordered pairs of nodes at each distance within a block, exactly from its histogram."""
    v = np.arange(len(counts))
    apart = np.array([x.bit_count() for x in range(len(counts))])[v[:, None] ^ v[None, :]]
    p = counts / max(counts.sum(), 1)
    return np.bincount(apart.ravel(), weights=np.outer(p, p).ravel(), minlength=BLOCK + 1)


def probes(width: int, radius: int) -> int:
    return sum(comb(width, k) for k in range(radius + 1))


def meetings(width: int, distance: int, radius: int) -> int:
    """Keys under which two nodes at ``distance`` in a partition meet, both probed within ``radius``."""
    return sum(comb(distance, i) * comb(width - distance, j) for i in range(distance + 1) for j in range(width - distance + 1)
               if i + j <= radius and distance - i + j <= radius)


class Part(NamedTuple):
    bits: tuple[int, ...]
    threshold: int

    @property
    def radius(self) -> int:
        return -(-self.threshold // 2)

    @property
    def mask(self) -> int:
        return sum(1 << b for b in self.bits)

    def flips(self) -> list[int]:
        """The changes of at most ``radius`` of the bits."""
        out = [0]
        layer = [(0, 0)]  # value, next bit
        for _ in range(self.radius):
            layer = [(x | 1 << self.bits[i], i + 1) for x, at in layer for i in range(at, len(self.bits))]
            out += [x for x, _ in layer]
        return out


def allocate(blocks: list[list[int]], counts: np.ndarray, n: int, distance: int = DISTANCE) -> list[Part]:
    """Partitions (runs of blocks) and thresholds of the least estimated work.

    Work is keys probed plus pairs met. The pairs within a partition's threshold
    are estimated from its blocks' distance shares, taken as independent.
    best[g][b]: least work over the first g blocks with thresholds t whose t + 1
    sum to b.
    """
    shares = [distance_shares(c) for c in counts]
    whole = distance + 1
    best: list[list] = [[None] * (whole + 1) for _ in range(len(blocks) + 1)]
    best[0][0] = (0.0, [])
    for start in range(len(blocks)):
        share, bits = np.ones(1), []
        for end in range(start + 1, len(blocks) + 1):
            share = np.convolve(share, shares[end - 1])
            bits = bits + blocks[end - 1]
            for t in range(-1, distance + 1):
                part = Part(tuple(sorted(bits)), t)
                work = 0.0
                if t >= 0:
                    met = sum(share[d] * meetings(len(bits), d, part.radius) for d in range(min(2 * part.radius, len(bits)) + 1))
                    work = n * probes(len(bits), part.radius) + PAIR_WORK * n * n / 2 * met
                for b in range(whole - t):
                    before = best[start][b]
                    if before is not None:
                        found = before[0] + work, before[1] + [part]
                        if best[end][b + t + 1] is None or found[0] < best[end][b + t + 1][0]:
                            best[end][b + t + 1] = found
    return [p for p in best[len(blocks)][whole][1] if p.threshold >= 0]


# ---------------------------------------------------------------- probing and verifying

def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _probed(nodes: DataFrame, parts: list[Part]) -> DataFrame:
    """h and fp: every key under which a fingerprint is probed, as a hash of its bits that ends in the partition's number.

    Keys of equal hash only bring more pairs to verify.
    """
    table = json.dumps([(k, _signed(part.mask), _signed(x)) for k, part in enumerate(parts) for x in part.flips()])
    keys = F.from_json(F.lit(table), "array<array<long>>")  # a constant, whatever its length
    one = nodes.select("fp", F.explode(keys).alias("k"))
    z = F.col("fp").bitwiseAND(F.col("k")[1]).bitwiseXOR(F.col("k")[2])
    return one.select(F.xxhash64(z).bitwiseAND(F.lit(-8)).bitwiseOR(F.col("k")[0]).alias("h"), "fp")


def _shuffled(df: DataFrame) -> DataFrame:
    """Let ``df`` and what it is joined with meet by shuffle.

    Spark would broadcast either side by its own estimate, which goes by the
    bytes of the stored files and leaves out what an explode adds: the keys
    probed were taken for the nodes that they come from.
    """
    return df.hint("merge")


def _outside(fp: Column, h: Column, parts: list[Part], distance: int) -> Column:
    """The ``distance`` + 1 pieces of what lies outside the key's partition, as hashes: linked nodes agree in one of them."""
    out = None
    for k, p in enumerate(parts):
        rest = [b for b in range(BITS) if b not in p.bits]
        pieces = [_signed(sum(1 << b for b in rest[i::distance + 1])) for i in range(distance + 1)]
        here = F.array(*(F.xxhash64(F.lit(i), fp.bitwiseAND(F.lit(m))) for i, m in enumerate(pieces)))
        out = here if out is None else F.when(h.bitwiseAND(F.lit(7)) == k, here).otherwise(out)
    return out


def links(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Verified links (a, b) between nodes (fp): enough of them for the right components."""
    n = nodes.count()
    blocks = correlated_blocks(joint_ones(nodes), n)
    parts = allocate(blocks, block_values(nodes, blocks), n, distance)
    near = lambda a, b: _apart(F.col(a), F.col(b)) <= distance
    probed = _probed(nodes, parts)
    shared = probed.groupBy("h").agg(F.min("fp").alias("a"), F.max("fp").alias("b"), F.count(F.lit(1)).alias("c")).where("a <> b")
    shared = stored(shared, "simhash_keys")
    pairs = shared.where("c = 2").where(near("a", "b")).select("a", "b")
    # keys of three nodes and more: each with the least one
    heads = shared.where("c > 2").select("h", "a", "c")
    heads = F.broadcast(heads) if heads.count() <= BROADCAST_KEYS else _shuffled(heads)
    crowd = stored(probed.join(heads, "h"), "simhash_crowds")
    found = stored(pairs.unionByName(crowd.where("fp <> a").where(near("a", "fp")).select("a", F.col("fp").alias("b"))).distinct(), "simhash_links")
    if crowd.isEmpty():
        return found
    # crowds that still hold several components; large ones are dealt by a piece of the bits outside the partition
    comp = components(found) if not found.isEmpty() else found.select(F.col("a").alias("node"), F.col("b").alias("component"))
    member = crowd.drop("a").join(_shuffled(comp), F.col("fp") == F.col("node"), "left")
    pieces = F.when(F.col("c") > SMALL_CROWD, _outside(F.col("fp"), F.col("h"), parts, distance)).otherwise(F.array(F.lit(0).cast("long")))
    member = member.select("h", "fp", F.coalesce("component", "fp").alias("comp"), F.explode(pieces).alias("y"))
    member = stored(member, "simhash_members")
    at = ["h", "y"]
    major = member.groupBy(*at, "comp").agg(F.count(F.lit(1)).alias("c")).groupBy(*at).agg(
        F.max_by("comp", F.struct("c", "comp")).alias("major"), F.count(F.lit(1)).alias("comps")).where("comps > 1").drop("comps")
    member = stored(member.join(_shuffled(major), at), "simhash_mixed")
    x = member.where("comp <> major").select(*at, F.col("fp").alias("a"), F.col("comp").alias("ca"))
    y = member.select(*at, F.col("fp").alias("b"), F.col("comp").alias("cb"))
    more = x.join(_shuffled(y), at).where("ca <> cb").where(near("a", "b")).select("a", "b").distinct()
    return found.unionByName(stored(more, "simhash_more_links"))


def join_hot(rows: DataFrame, sizes: DataFrame, on: str, total: int) -> DataFrame:
    """``rows`` joined on ``on`` with ``sizes``, one row per key with its number of rows ``c``.

    Keys with over 1 / HOT of all rows are joined by broadcast, as there are at
    most HOT of them; the others by shuffle.
    """
    hot = F.broadcast(sizes.where(F.col("c") * HOT > total).withColumnRenamed(on, "_hot"))
    cold = sizes.where(F.col("c") * HOT <= total)
    there = rows.join(hot, rows[on] == F.col("_hot")).drop("_hot")
    rest = rows.join(hot.select("_hot"), rows[on] == F.col("_hot"), "left_anti").join(_shuffled(cold), on)
    return there.select(*rest.columns).unionByName(rest)


def simhash_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """fingerprint (16 hex digits) and component_id of every document, one row per input row.

    Components are over links between fingerprints with at most ``distance``
    differing bits; component_id is the smallest key reachable (null only if
    there is no other). Null, empty and wordless texts have fingerprint zero and
    link like any other; a text with fewer words than ``size`` is one shingle.
    Repeated rows share a fingerprint and so a component. Extra columns are not
    read, an empty table gives no rows.
    """
    rows = stored(fingerprints(docs, key, text, size), "simhash_rows")
    # equal fingerprints are one node
    nodes = stored(rows.groupBy("fp").agg(F.min("doc").alias("least"), F.count(F.lit(1)).alias("c")), "simhash_nodes")
    found = links(nodes.select("fp"), distance)
    total = rows.count()
    if not found.isEmpty():
        comp = components(found).withColumnRenamed("node", "fp")
        of = stored(nodes.join(_shuffled(comp), "fp", "left").select("fp", "least", "c", F.coalesce("component", "fp").alias("comp")), "simhash_components")
        lows = stored(of.groupBy("comp").agg(F.min("least").alias("low"), F.count(F.lit(1)).alias("c")), "simhash_lows")
        nodes = stored(join_hot(of.select("fp", F.col("c").alias("size"), "comp"), lows, "comp", nodes.count()).select(
            "fp", F.col("low").alias("least"), F.col("size").alias("c")), "simhash_least")
    out = join_hot(rows, nodes, "fp", total)
    return out.select(F.col("doc").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("least").alias("component_id"))


def query(spark, sf_dir: str) -> DataFrame:
    """Contract columns of operator 13 over all documents."""
    return simhash_groups(table(spark, sf_dir, "documents"))
