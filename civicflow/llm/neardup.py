"""Near-duplicate groups by MinHash with tensored banding (operator 4).

Two small collections of sub-keys are computed from few minhashes; the key of
table (i, j) combines sub-key i of the first with sub-key j of the second, so
m * m tables cost 2 * m sub-keys (about a square root of the usual minhash
work). A sub-key that no other document shares can be in no shared table, so
only the others are combined. Documents of a table are linked to its smallest
one; what these stars leave apart within shared tables is searched by rare
shingles (prefix and position bounds, which lose no pair). Every link is
confirmed on whole shingle sets.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, table, without_rows
from .components import components
from .textnp import U, mix64, pair_hash, released, slices, stream, words

#: Sub-keys in each collection and minhashes in a sub-key: at similarity 0.8 a pair shares a table
#: with probability (1 - (1 - 0.8**3)**14)**2, which is over 0.9999.
SUBKEYS, WIDTH = 14, 3
#: A link needs 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Ids (under 100 bytes each) that are broadcast to pick candidates' texts; more of them are joined by shuffle.
BROADCAST_IDS = 100_000


def shingle_sets(column: pa.Array, size: int):
    """Sorted distinct 64-bit hashes of the ``size``-word shingles of each document, in order."""
    for s in slices(column):
        w = words(s)
        h = w.hash
        for k in range(1, size):
            h = pair_hash(h[:len(w.hash) - k], w.hash[k:]) if len(w.hash) > k else h[:0]
        for a, b in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist()):
            if b - a >= size:
                yield np.unique(h[a:b - size + 1])
            elif b > a:  # fewer words: the whole sequence is one shingle
                x = np.array([b - a], U)
                for v in w.hash[a:b]:
                    x = pair_hash(x, np.array([v], U))
                yield x
            else:
                yield np.zeros(0, U)


def set_digest(x: np.ndarray) -> bytes:
    return hashlib.blake2b(x.tobytes(), digest_size=16).digest()


def subkeys(x: np.ndarray, m: int = SUBKEYS, width: int = WIDTH) -> np.ndarray:
    """2 * m sub-keys of a shingle set, each of ``width`` minhashes and its own place."""
    seeds = _seeds(2 * m * width)
    low = np.full(len(seeds), np.iinfo(np.uint64).max, U)
    for at in range(0, len(x), 4096):
        y = (x[at:at + 4096, None] ^ seeds[None, :]) * U(0xBF58476D1CE4E5B9)
        low = np.minimum(low, (y ^ (y >> U(32))).min(0))
    out = np.arange(1, 2 * m + 1, dtype=np.uint64)
    for k in range(width):
        out = pair_hash(out, low[k::width])
    return out


_SEEDS: dict[int, np.ndarray] = {}


def _seeds(n: int) -> np.ndarray:
    if n not in _SEEDS:
        _SEEDS[n] = stream(77, n)
    return _SEEDS[n]


def signatures(docs: DataFrame, key: str, text: str, size: int, m: int = SUBKEYS, width: int = WIDTH) -> DataFrame:
    """Key, n (set size), digest of the set, and its sub-keys (empty for an empty set)."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            n, digest, keys = [], [], []
            for x in shingle_sets(b.column(1), size):
                n.append(len(x))
                digest.append(set_digest(x))
                keys.append(subkeys(x, m, width).view(np.int64) if len(x) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                                              pa.array(keys, pa.list_(pa.int64()))], names=["doc", "n", "digest", "keys"])

    return docs.select(key, text).mapInArrow(released(run), f"doc {kind}, n long, digest binary, keys array<long>")


def _sets(docs: DataFrame, key: str, text: str, needed: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of the needed nodes (doc, node, digest), from their documents' whole texts."""
    if needed.count() <= BROADCAST_IDS:
        needed = F.broadcast(needed)
    rows = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t")).join(needed, F.col("_k").eqNullSafe(F.col("doc")))

    def run(batches):
        for b in batches:
            node, out = [], []
            for x, i, d in zip(shingle_sets(b.column(2), size), b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if set_digest(x) == d:  # a repeated key may have other texts
                    node.append(i)
                    out.append(x.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(out, pa.list_(pa.int64()))],
                                             names=["node", "shingles"])

    return rows.select("node", "digest", "_t").mapInArrow(released(run), "node long, shingles array<long>").dropDuplicates(["node"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose whole sets are similar enough."""
    x = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    x = x.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    both = F.size(F.array_intersect("sa", "sb"))
    return x.where(100 * both >= percent * (F.size("sa") + F.size("sb") - both)).select("a", "b")


def _similar_size(x: str, y: str, percent: int):
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def _residue(active: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of ``active`` nodes (node, comp) of different components that may be similar.

    Shingles are ordered from rare to common. A pair as similar as asked shares
    a shingle among the first of both sets, and from the first one shared on
    both still hold as many shingles as the pair must share; rows that cannot
    meet this are not joined. Nodes of the component most frequent at a shingle
    meet only the nodes outside it, so no two of its nodes are paired.
    """
    own = stored(active.join(sets, "node").withColumn("n", F.size("shingles")), "near_active")
    single = own.select("node", "comp", "n", F.explode("shingles").alias("s"))
    df = single.groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    first = single.join(df, "s").groupBy("node", "comp", "n").agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("o"))
    keep = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    first = first.select("node", "comp", "n", F.posexplode(F.slice("o", F.lit(1), keep.cast("int"))).alias("i", "o"))
    first = stored(first.where("o.df > 1").select("node", "comp", "n", "i", F.col("o.s").alias("s")), "near_prefix")
    per = first.groupBy("s", "comp").agg(F.count(F.lit(1)).alias("c"))
    major = per.groupBy("s").agg(F.max_by("comp", F.struct("c", "comp")).alias("major"), F.count(F.lit(1)).alias("comps"))
    first = stored(first.join(major.where("comps > 1").drop("comps"), "s"), "near_mixed")
    x = first.where("comp <> major").select("s", *(F.col(c).alias(f"{c}_x") for c in ("node", "comp", "n", "i")))
    y = first.select("s", *(F.col(c).alias(f"{c}_y") for c in ("node", "comp", "n", "i")))
    need = F.ceil((F.col("n_x") + F.col("n_y")) * percent / (100 + percent))
    ok = ((F.col("comp_x") != F.col("comp_y")) & _similar_size("n_x", "n_y", percent)
          & (F.least(F.col("n_x") - F.col("i_x"), F.col("n_y") - F.col("i_y")) >= need))
    return x.join(y, "s").where(ok).select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct()


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = PERCENT,
                m: int = SUBKEYS, width: int = WIDTH) -> DataFrame:
    """n_shingles, component_id, kept, row and stays of every document (one row per input row).

    Components are over links with 100 * intersection >= percent * union of
    the sets of ``size``-word shingles; equal sets are one node. Null, empty and
    wordless texts have no shingles and are alone. component_id is the smallest
    key reachable (nulls only if there is none else); kept is key = component_id,
    so rows that repeat a kept key are kept too, while ``stays`` is one row per
    component. Extra columns are not read. ``docs`` is read twice; ``row`` is
    monotonically_increasing_id over it, stable for a stored table.
    """
    sig = signatures(docs, key, text, size, m, width).withColumn("row", F.monotonically_increasing_id())
    sig = stored(sig, "near_signatures")
    # Equal sets collapse to the node of their first row.
    nodes = sig.where("n > 0").groupBy("digest").agg(F.min(F.struct("row", "doc", "n", "keys")).alias("r"))
    nodes = stored(nodes.select("digest", F.col("r.row").alias("node"), F.col("r.doc").alias("doc"),
                                F.col("r.n").alias("n"), F.col("r.keys").alias("keys")), "near_nodes")
    links = _links(docs, key, text, nodes, size, percent, m)
    comp = components(links) if links is not None else None
    of = nodes.select("digest", "node")
    if comp is not None:
        of = of.join(comp, "node", "left")
        of = of.select("digest", F.coalesce("component", "node").alias("component"))
    else:
        of = of.select("digest", F.col("node").alias("component"))
    rows = sig.select("doc", "n", "digest", "row").join(of, "digest", "left")
    rows = stored(rows.select("doc", "n", "row", F.coalesce("component", "row").alias("component")), "near_rows")
    order = F.struct(F.col("doc").isNull().alias("no"), F.col("doc").alias("doc"), F.col("row").alias("row"))
    least = rows.groupBy("component").agg(F.min(order).alias("first"))
    return rows.join(least, "component").select(
        F.col("doc").alias(key), F.col("n").alias("n_shingles"), F.col("first.doc").alias("component_id"),
        F.col("doc").eqNullSafe(F.col("first.doc")).alias("kept"), "row", (F.col("row") == F.col("first.row")).alias("stays"))


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5) -> DataFrame:
    """``docs`` with one document of each group (the smallest key), all columns unchanged."""
    return without_rows(docs, near_groups(docs, key, text, size).where(~F.col("stays")).select("row"))


def _links(docs, key, text, nodes, size, percent, m) -> DataFrame | None:
    """Confirmed links between nodes: enough of them for the right components."""
    single = nodes.select("node", "n", F.posexplode("keys").alias("i", "k"))
    shared = single.groupBy("k").agg(F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    live = single.join(shared, "k").groupBy("node", "n").agg(
        F.collect_list(F.when(F.col("i") < m, F.col("k"))).alias("p"),
        F.collect_list(F.when(F.col("i") >= m, F.col("k"))).alias("q"))
    tables = live.select("node", "n", F.explode("p").alias("p"), "q").select("node", "n", "p", F.explode("q").alias("q"))
    tables = tables.select("node", "n", F.xxhash64("p", "q").alias("t"))
    heads = tables.groupBy("t").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    tables = stored(tables.join(heads, "t"), "near_tables")
    if tables.isEmpty():
        return None
    candidates = stored(tables.groupBy("node").agg(F.first("n").alias("n")), "near_candidates")
    needed = nodes.select("doc", "node", "digest").join(candidates.select("node"), "node", "left_semi")
    sets = stored(_sets(docs, key, text, needed, size), "near_sets")
    # round one: every document of a table with the table's smallest
    star = tables.where("node <> head").groupBy(F.col("head").alias("a"), F.col("node").alias("b")).agg(F.first("n").alias("nb"))
    star = star.join(candidates.select(F.col("node").alias("a"), F.col("n").alias("na")), "a").where(_similar_size("na", "nb", percent))
    links = stored(_verified(star.select("a", "b"), sets, percent), "near_links")
    comp = components(links)
    # round two: tables that still hold several components
    member = tables.join(comp, "node", "left").select("t", "node", F.coalesce("component", "node").alias("comp"))
    mixed = member.groupBy("t").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("t")
    active = member.join(mixed, "t", "left_semi").select("node", "comp").distinct()
    more = stored(_verified(_residue(active, sets, percent), sets, percent), "near_more_links")
    return links.unionByName(more)


def query(spark, sf_dir: str) -> DataFrame:
    """Contract columns of operator 4 over all documents: two-word shingles, similarity 0.8."""
    return near_groups(table(spark, sf_dir, "documents"), size=2).drop("row", "stays")
