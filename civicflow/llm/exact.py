"""Exact deduplication screened by static binary-fuse filters (operator 10).

An immutable snapshot is indexed once: its digests are dealt to parts of
bounded size and each part gets a 3-wise binary-fuse filter. The distinct
digests of an incoming batch (its own duplicates are grouped first, apart from
the snapshot) probe the filter of their part; only positives meet the
snapshot's exact buckets. Groups of equal digests are confirmed byte by byte.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, table, without_rows
from .textnp import mix64, released

BLANK = b" \t\n\x0b\x0c\r"
#: Digests of the snapshot per filter.
PER_FILTER = 200_000
#: Shared digests (32 bytes each) that are broadcast for the byte check; more of them are joined by shuffle.
BROADCAST_DIGESTS = 200_000
U = np.uint64


# ---------------------------------------------------------------- binary-fuse filter

def _slots(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The three slots of each key, in three neighbouring segments, and its 16-bit fingerprint."""
    h = mix64(keys + U(seed))
    first = ((h >> U(32)) * U(segment * segments) >> U(32)).astype(np.int64)
    mask = U(segment - 1)
    second = (first + segment) ^ ((h >> U(18)) & mask).astype(np.int64)
    third = (first + 2 * segment) ^ (h & mask).astype(np.int64)
    return np.stack([first, second, third], 1), (mix64(h) & U(0xFFFF)).astype(np.uint16)


class FuseFilter:
    """Static set of 64-bit keys: no false negatives, about 2**-16 false positives."""

    def __init__(self, seed: int, segment: int, segments: int, table: np.ndarray):
        self.seed, self.segment, self.segments, self.table = seed, segment, segments, table

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        keys = np.unique(np.asarray(keys, U))
        n = len(keys)
        segment = 1 << max(2, min(18, int(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
        factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 3)))
        for attempt in range(100):
            segments = max(1, -(-int(n * factor * (1.05 ** attempt)) // segment) - 2 + (n < 1000))
            slots, prints = _slots(keys, attempt + 1, segment, segments)
            order = cls._peel(slots, segment * (segments + 2))
            if order is None:
                continue
            values = np.zeros(segment * (segments + 2), np.uint16)
            for who, slot in reversed(order):  # keys peeled together never share their slots
                values[slot] = 0
                s = slots[who]
                values[slot] = prints[who] ^ values[s[:, 0]] ^ values[s[:, 1]] ^ values[s[:, 2]]
            return cls(attempt + 1, segment, segments, values)
        raise RuntimeError("no peeling order found")

    @staticmethod
    def _peel(slots: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
        alive = np.arange(len(slots))
        order = []
        while len(alive):
            s = slots[alive]
            single = np.bincount(s.ravel(), minlength=size)[s] == 1
            which = single.any(1)
            if not which.any():
                return None
            order.append((alive[which], s[which, single[which].argmax(1)]))
            alive = alive[~which]
        return order

    def __contains__(self, key: int) -> bool:
        return bool(self.probe(np.array([key], U))[0])

    def probe(self, keys: np.ndarray) -> np.ndarray:
        slots, prints = _slots(np.asarray(keys, U), self.seed, self.segment, self.segments)
        t = self.table
        return (t[slots[:, 0]] ^ t[slots[:, 1]] ^ t[slots[:, 2]]) == prints


def _keys(digests) -> np.ndarray:
    """64-bit key of each digest (of any length from one byte on)."""
    return np.fromiter((int.from_bytes(bytes(d)[:8], "little") for d in digests), U, len(digests))


# ---------------------------------------------------------------- digests

def digests(docs: DataFrame, key: str, text: str, keep: tuple[str, ...] = (), with_text: bool = False) -> DataFrame:
    """Key, ``keep`` columns, code points and SHA-256 of each normalised text (null: empty)."""
    columns = [key, text, *keep]
    fields = [docs.schema[c] for c in columns]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields if f.name != text)
    schema += ", _chars long, _sha binary" + ", _norm binary" * with_text

    def run(batches):
        for b in batches:
            norm, chars, sha = [], [], []
            for t in b.column(1).to_pylist():
                t = t or ""
                chars.append(len(t))
                x = t.encode().translate(None, BLANK)
                sha.append(hashlib.sha256(x).digest())
                if with_text:
                    norm.append(x)
            out = [b.column(i) for i in range(len(columns)) if i != 1] + [pa.array(chars, pa.int64()), pa.array(sha, pa.binary())]
            names = [c for c in columns if c != text] + ["_chars", "_sha"]
            if with_text:
                out.append(pa.array(norm, pa.binary()))
                names.append("_norm")
            yield pa.RecordBatch.from_arrays(out, names=names)

    return docs.select(*columns).mapInArrow(released(run), schema)


# ---------------------------------------------------------------- screening

def build_filters(snapshot: DataFrame, parts: int) -> DataFrame:
    """One filter row per part of the snapshot's distinct ``_digest``s: part, seed, segment, segments, table."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        f = FuseFilter.build(_keys(pdf["_digest"]))
        return pd.DataFrame({"part": [pdf["part"].iloc[0]], "seed": [f.seed], "segment": [f.segment],
                             "segments": [f.segments], "table": [f.table.tobytes()]})

    return snapshot.select("_digest", _part(parts)).groupBy("part").applyInPandas(
        build, "part int, seed long, segment long, segments long, table binary")


def _part(parts: int) -> Column:
    return F.pmod(F.xxhash64("_digest"), F.lit(parts)).cast("int").alias("part")


def screen(batch: DataFrame, filters: DataFrame, parts: int, salts: int = 1) -> DataFrame:
    """Distinct ``_digest``s of a batch with ``maybe``: false only if no snapshot digest equals it.

    A part's digests are dealt to ``salts`` groups, each of which gets the
    part's filter (about half a MB), so a batch far larger than the snapshot
    does not meet in the snapshot's few parts.
    """

    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(right) or not len(left):
            return pd.DataFrame({"_digest": left["_digest"], "maybe": np.zeros(len(left), bool)})
        r = right.iloc[0]
        f = FuseFilter(int(r["seed"]), int(r["segment"]), int(r["segments"]), np.frombuffer(r["table"], np.uint16))
        return pd.DataFrame({"_digest": left["_digest"], "maybe": f.probe(_keys(left["_digest"]))})

    dealt = batch.select("_digest", _part(parts), F.pmod(F.xxhash64(F.lit(7), "_digest"), F.lit(salts)).cast("int").alias("salt"))
    copies = filters.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.groupBy("part", "salt").cogroup(copies.groupBy("part", "salt")).applyInPandas(probe, "_digest binary, maybe boolean")


def _best(key: str) -> Column:
    """Smallest first: most code points, then smallest key (null last), then the row's own number."""
    return F.struct((-F.col("_chars")).alias("a"), F.col(key).isNull().alias("b"), F.col(key).alias("k"), F.col("_row").alias("r"))


def exact_dedup(docs: DataFrame, incoming: Column, key: str = "doc_id", text: str = "text",
                digest_bytes: int = 32, per_filter: int = PER_FILTER) -> DataFrame:
    """Groups of equal normalised texts over a snapshot (``incoming`` false) and a batch (true or null).

    Returns one row per input row: key, keep_id, group_size, kept, text_sha256,
    row. ``docs`` is read twice and must give its rows in the same order each
    time, as a stored table does; ``row`` is monotonically_increasing_id over it.
    A null text equals the empty one. Of rows that agree in length and key one
    is kept, whichever was read first; a null key is last among keys. Extra
    columns are not read, an empty table gives no rows. ``digest_bytes`` under
    32 only forces digest collisions, which the byte check must undo.
    """
    flagged = docs.select(F.col(key), F.col(text), F.coalesce(incoming, F.lit(True)).alias("_incoming"))
    sig = digests(flagged, key, text, ("_incoming",))
    sig = sig.withColumn("_digest", F.expr(f"substring(_sha, 1, {digest_bytes})")).withColumn("_row", F.monotonically_increasing_id())
    sig = stored(sig, "exact_rows")

    def groups(rows):
        return rows.groupBy("_digest").agg(F.min(_best(key)).alias("best"), F.count(F.lit(1)).alias("n"))

    snapshot = stored(groups(sig.where(~F.col("_incoming"))), "exact_snapshot")
    batch = stored(groups(sig.where("_incoming")), "exact_incoming")  # the batch's own duplicates, apart from the snapshot
    parts = max(1, -(-snapshot.count() // per_filter))
    screened = screen(batch, build_filters(snapshot, parts), parts, max(1, -(-batch.count() // (parts * per_filter))))
    batch = stored(batch.join(screened, "_digest"), "exact_batch")
    merged = snapshot.unionByName(batch.where("maybe").drop("maybe")).groupBy("_digest").agg(
        F.min("best").alias("best"), F.sum("n").alias("n"))
    merged = stored(merged.unionByName(batch.where(~F.col("maybe")).drop("maybe")), "exact_groups")

    odd = stored(_collisions(flagged, merged, key, text, digest_bytes), "exact_collisions")
    out = sig.join(merged, "_digest")
    if not odd.isEmpty():
        out = out.join(odd, "_digest", "left_anti")
    columns = [F.col(key), F.col("best.k").alias("keep_id"), F.col("n").alias("group_size"),
               (F.col("best.r") == F.col("_row")).alias("kept"), F.lower(F.hex("_sha")).alias("text_sha256"), F.col("_row").alias("row")]
    out = out.select(*columns)
    if odd.isEmpty():
        return out
    # Different texts share a digest: their rows are grouped by the texts themselves.
    rows = digests(flagged, key, text, with_text=True).withColumn("_digest", F.expr(f"substring(_sha, 1, {digest_bytes})"))
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    rows = stored(rows.join(odd, "_digest", "left_semi"), "exact_odd_rows")
    own = rows.groupBy("_digest", "_norm").agg(F.min(_best(key)).alias("best"), F.count(F.lit(1)).alias("n"))
    return out.unionByName(rows.join(own, ["_digest", "_norm"]).select(*columns))


def _collisions(flagged: DataFrame, merged: DataFrame, key: str, text: str, digest_bytes: int) -> DataFrame:
    """Digests whose rows' normalised texts are not all the same bytes."""
    shared = merged.where("n > 1").select("_digest", F.col("best.k").alias("_keep"))
    if shared.count() <= BROADCAST_DIGESTS:
        shared = F.broadcast(shared)
    rows = digests(flagged, key, text, with_text=True).withColumn("_digest", F.expr(f"substring(_sha, 1, {digest_bytes})"))
    rows = stored(rows.join(shared, "_digest").select(F.col(key).alias("_key"), "_keep", "_digest", "_norm"), "exact_texts")
    model = rows.where(F.col("_key").eqNullSafe(F.col("_keep"))).groupBy("_digest").agg(F.min("_norm").alias("_model"))
    model = stored(model, "exact_models")  # a plain join of stored sides, so that Spark can split a hot digest
    return rows.join(model, "_digest").where(~F.col("_norm").eqNullSafe(F.col("_model"))).select("_digest")


def incoming_half(key: str = "doc_id") -> Column:
    """The registered query's batch: rows whose key's CRC-32 is odd (a null key is incoming)."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 2 == 1


def query(spark, sf_dir: str) -> DataFrame:
    """Contract columns of operator 10: half of documents as the snapshot, half as the batch, all rows out."""
    return exact_dedup(table(spark, sf_dir, "documents"), incoming_half()).drop("row")


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` does not keep, all columns unchanged."""
    return without_rows(docs, exact_dedup(docs, incoming_half(key), key, text).where(~F.col("kept")).select("row"))


SQL = r"""
with d as (
  select doc_id, coalesce(text, '') as t,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm from documents),
g as (
  select norm, count(*) as group_size, arg_min(doc_id, (-length(t), doc_id)) as keep_id from d group by norm)
select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept, sha256(d.norm) as text_sha256
from d join g on d.norm = g.norm
"""
