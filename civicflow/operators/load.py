"""Idempotent loading and the (created, key) progress watermark.

* ``insert_absent``  : append-if-absent (first write of a key wins).
* ``batch_max``      : newest (created, key) of a batch, per source.
* ``merge_watermark``: monotonic merge of the stored watermark with a batch max.
* ``WatermarkLog``   : the watermark table stored as an append-only log read
  through ``max``; no file is ever overwritten while being read, and
  replaying a batch appends a row that cannot move the maximum.
* ``load_batch``     : dedupe -> insert-if-absent -> append -> watermark, data first.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import as_ntz
from ..schema import CREATED, EXPECTED_COLUMNS, KEY, META_SCHEMA, SOURCE_NAME
from ..session import path_exists
from .keyindex import BROADCAST_WORDS_MAX, absent_rows, bit_of, key_words, stored_words, word_of
from .normalize import batch_dedupe, null_key_rows

# Largest batch whose key set is broadcast to probe the target (8-byte keys: ~32 MB hash table).
BROADCAST_KEYS_MAX = 4_000_000


# --------------------------------------------------------------------------- L1

def colliding_keys(batch: DataFrame, target: DataFrame, key: str = KEY) -> DataFrame:
    """Distinct keys of ``target`` that ``batch`` also has (never more rows than the batch).

    The batch's keys are broadcast and the target's key column is probed where
    it lies: the target is scanned (key column only) but never shuffled.
    """
    batch_keys = batch.select(key).where(F.col(key).isNotNull())
    return target.select(key).join(F.broadcast(batch_keys), key, "left_semi").distinct()


def insert_absent(batch: DataFrame, target: DataFrame, key: str = KEY,
                  batch_rows: int | None = None) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target`` (ON CONFLICT DO NOTHING).

    When the batch's size is known and bounded, the colliding keys (a set no
    larger than the batch) are found by probing the target in place and then
    broadcast into the anti-join. Otherwise both sides shuffle on the key
    (sort-merge anti join; AQE splits skewed partitions).
    """
    if batch_rows is not None and batch_rows <= BROADCAST_KEYS_MAX:
        return batch.join(F.broadcast(colliding_keys(batch, target, key)), key, "left_anti")
    return batch.join(target.select(key), key, "left_anti")


# --------------------------------------------------------------------------- L2 / L7

def batch_max(batch: DataFrame, source: str = SOURCE_NAME, source_col: str | None = None) -> DataFrame:
    """Newest (created, key) per source; rows without a creation time never win.

    ``max(struct(created, key))`` is one aggregate pass with map-side partial
    aggregation; it orders by created, then key, numerically.
    """
    src = F.col(source_col) if source_col else F.lit(source)
    top = (batch.where(F.col(CREATED).isNotNull())
           .groupBy(src.alias("source_name"))
           .agg(F.max(F.struct(F.col(CREATED).alias("d"), F.col(KEY).cast("long").alias("k"))).alias("m")))
    return top.select("source_name",
                      F.col("m.d").alias("last_created_date"),
                      F.col("m.k").alias("last_unique_key"))


# --------------------------------------------------------------------------- L3

def merge_watermark(meta: DataFrame, batch_top: DataFrame, now) -> DataFrame:
    """Stored watermark ⊔ batch maximum, per source.

    date = greatest(old, new); key = new if the new date is newer (or there was
    no date), greatest(old, new) if the dates are equal, else old. Sources not
    in the batch keep their row (and their ``updated_at``); touched sources get
    ``updated_at = now``. Keys compare as numbers.
    """
    o = meta.select(F.col("source_name"), F.col("last_created_date").alias("od"),
                    F.col("last_unique_key").alias("ok"), F.col("updated_at").alias("ou"))
    n = batch_top.select(F.col("source_name"), F.col("last_created_date").alias("nd"),
                         F.col("last_unique_key").alias("nk"))
    j = o.join(n, "source_name", "full_outer")
    od, ok, nd, nk = F.col("od"), F.col("ok"), F.col("nd"), F.col("nk")
    touched = F.col("nd").isNotNull() | F.col("nk").isNotNull()
    key = (F.when(nd.isNull(), ok)
           .when(od.isNull() | (nd > od), nk)
           .when(nd == od, F.greatest(ok, nk))
           .otherwise(ok))
    return j.select(
        F.col("source_name"),
        F.greatest(od, nd).alias("last_created_date"),
        key.alias("last_unique_key"),
        F.when(touched, as_ntz(now)).otherwise(F.col("ou")).alias("updated_at"),
    )


# --------------------------------------------------------------------------- L4 / L5

def read_watermark(meta: DataFrame, source: str = SOURCE_NAME) -> tuple[_dt.datetime | None, int | None]:
    """(date, key) of a source, or (None, None) without a row or without a date."""
    row = meta.where(F.col("source_name") == source).select("last_created_date", "last_unique_key").first()
    if row is None or row[0] is None:
        return None, None
    return row[0], row[1]


def resume_point(watermark: tuple, start_date: _dt.datetime | None) -> tuple:
    """Start date wins when there is no watermark or it is newer (then date-only, inclusive);
    otherwise resume after the watermark (from its date on, inclusive, when it has no key);
    otherwise scan from the beginning."""
    last_date, last_key = watermark
    if start_date is not None and (last_date is None or start_date > last_date):
        return start_date, None
    return last_date, last_key


def watermark_after(spark: SparkSession, raw: DataFrame, now=None, source: str = SOURCE_NAME) -> DataFrame:
    """Watermark table after loading ``raw`` into an empty state at ``now``."""
    empty = spark.createDataFrame([], META_SCHEMA)
    return merge_watermark(empty, batch_max(raw, source), now)


# --------------------------------------------------------------------------- storage

@dataclass
class WatermarkLog:
    """Watermark table as an append-only Parquet log at ``path``.

    Each load appends (source, batch max, now). The current table is the max
    per source: the merge rule above is exactly the lexicographic maximum of
    (date, key), so the log read through ``max`` equals the merged table, and
    appending is safe to repeat.
    """

    path: str

    def read(self, spark: SparkSession) -> DataFrame:
        if not path_exists(spark, self.path):
            return spark.createDataFrame([], META_SCHEMA)
        log = spark.read.schema(META_SCHEMA).parquet(self.path)
        top = log.groupBy("source_name").agg(
            F.max(F.when(F.col("last_created_date").isNotNull(),
                         F.struct(F.col("last_created_date").alias("d"),
                                  F.col("last_unique_key").alias("k")))).alias("m"),
            F.max("updated_at").alias("updated_at"))
        return top.select("source_name", F.col("m.d").alias("last_created_date"),
                          F.col("m.k").alias("last_unique_key"), "updated_at")

    def append_values(self, spark: SparkSession, source: str, last_created, last_key, now) -> None:
        """Append one known (source, date, key) row (the batch max computed by the caller)."""
        row = spark.createDataFrame([(source, None, None, None)], META_SCHEMA).select(
            "source_name", as_ntz(last_created).alias("last_created_date"),
            F.lit(int(last_key)).cast("long").alias("last_unique_key"), as_ntz(now).alias("updated_at"))
        row.coalesce(1).write.mode("append").parquet(self.path)

    def data_files(self, spark: SparkSession) -> list:
        """Hadoop paths of the log's Parquet files."""
        jvm = spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        return [st.getPath() for st in fs.listStatus(root) if st.getPath().getName().endswith(".parquet")]

    def compact(self, spark: SparkSession, min_files: int = 64) -> int:
        """Fold the log into one file once it has ``min_files`` files; returns files removed.

        The folded row per source is the maximum of the rows it replaces, so a
        reader gets the same watermark before, during and after compaction.
        """
        old = self.data_files(spark)
        if len(old) < min_files:
            return 0
        current = self.read(spark).collect()  # one row per source
        spark.createDataFrame(current, META_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        fs = old[0].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for f in old:
            fs.delete(f, False)
        return len(old)

    def append(self, batch_top: DataFrame, now) -> None:
        rows = batch_top.select("source_name", "last_created_date", "last_unique_key",
                                as_ntz(now).alias("updated_at"))
        rows.coalesce(1).write.mode("append").parquet(self.path)


@dataclass
class LoadResult:
    rows_in: int
    rows_loaded: int
    watermark: tuple | None
    created_range: tuple | None = None  # (first, last) creation time in the batch: the months to refresh
    undated: int = 0                    # rows without a creation time
    quarantined: int = 0                # rows without a key, set aside (not loadable into a keyed table)
    months: list = field(default_factory=list)  # first days of the batch's creation months


# Directory column of the month layout of the raw table.
MONTH_COL = "created_month"


def _month(c):
    return F.trunc(F.to_date(c), "month")


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """The raw table in contract columns (a month directory column is layout only)."""
    return spark.read.parquet(path).select(*EXPECTED_COLUMNS)


def _set_aside(spark: SparkSession, rows: DataFrame, path: str) -> int:
    """Append rows that are not in quarantine yet; returns how many. Rows are compared whole, so a replay adds none."""
    if path_exists(spark, path):
        rows = rows.select("*", F.to_json(F.struct("*")).alias("_text"))
        held = spark.read.schema(rows.drop("_text").schema).parquet(path).select(F.to_json(F.struct("*")).alias("_text"))
        rows = rows.join(held, "_text", "left_anti").drop("_text")
    rows = rows.persist()
    try:
        n = rows.count()
        if n:
            rows.write.mode("append").parquet(path)
        return n
    finally:
        rows.unpersist()


def load_batch(spark: SparkSession, batch: DataFrame, raw_path: str, log: WatermarkLog,
               now, source: str = SOURCE_NAME, created_is_immutable: bool = False,
               read_back: bool = True, by_month: bool = False,
               quarantine_path: str | None = None,
               dedupe: Callable[[DataFrame], DataFrame] = batch_dedupe) -> LoadResult:
    """One batch: dedupe, insert-if-absent into ``raw_path``, then advance the watermark.

    One aggregate over the cached batch gives its counts, ranges and months;
    the rows that were new are counted by the write itself. That metric lies
    behind the last shuffle of the write, where Spark counts each task once,
    however often a lost executor makes it run.

    Data is committed before the watermark, so a crash in between is repaired
    by replaying the batch (the anti-join makes the replay add nothing).

    Layout: each batch's files are sorted by creation time, so Parquet min/max
    statistics skip row groups for creation-range filters. ``by_month`` also
    writes a directory per creation month (partition pruning; worth it when
    batches arrive roughly in time order, as live feeds do).

    The target is probed only within the batch's key range (exact; pushed to
    Parquet). ``created_is_immutable``: when a key never changes its creation
    time, a stored row that collides with the batch also lies in the batch's
    creation range, so only that range of the target is probed.

    Rows without a key cannot enter the keyed table; with ``quarantine_path``
    they are appended there (and counted) instead of being left out silently.
    ``dedupe`` picks the row of a key that the batch repeats.
    """
    rows = batch.persist()
    held = [rows]
    try:
        c, k = F.col(CREATED), F.col(KEY)
        top = F.max(F.when(c.isNotNull() & k.isNotNull(), F.struct(c.alias("d"), k.alias("k"))))
        total, keyed, n, lo, hi, undated, last, k_lo, k_hi, months = rows.agg(
            F.count(F.lit(1)), F.count(k), F.countDistinct(k), F.min(c), F.max(c), F.count_if(c.isNull()), top,
            F.min(k), F.max(k), F.collect_set(F.when(k.isNotNull(), _month(c)))).first()  # a value for each month
        keyless = int(total) - int(keyed)
        if keyless and quarantine_path:
            keyless = _set_aside(spark, null_key_rows(rows), quarantine_path)
        # The wide dedupe aggregate runs only when the batch really repeats a key.
        # (Stats taken before dedupe are still right: the row kept per key has its
        # greatest creation time, so the max (created, key) is the same, and the
        # creation range can only be wider.)
        if keyed == n:
            deduped = rows.where(k.isNotNull())
        else:
            deduped = dedupe(rows).persist()
            held.append(deduped)
        if n == 0:
            return LoadResult(0, 0, read_watermark(log.read(spark), source) if read_back else None,
                              quarantined=keyless)
        new = deduped
        if path_exists(spark, raw_path):
            # a colliding stored key lies within the batch's key range: always exact, and the
            # range reaches Parquet, where row-group key statistics skip most of the target
            stored = spark.read.parquet(raw_path).where(k.between(F.lit(int(k_lo)), F.lit(int(k_hi))))
            if created_is_immutable:
                span = F.lit(False)
                if lo is not None:
                    span = c.between(as_ntz(lo), as_ntz(hi))
                    if MONTH_COL in stored.columns:
                        span = span & F.col(MONTH_COL).between(_month(as_ntz(lo)), _month(as_ntz(hi)))
                if undated:
                    span = span | c.isNull()
                stored = stored.where(span)
            if n <= BROADCAST_KEYS_MAX:
                new = deduped.join(F.broadcast(colliding_keys(deduped, stored)), KEY, "left_anti")
            else:
                # batch too large to broadcast its keys: their bits meet those of the target, and the rows
                # stay where they are unless more words collide than can be broadcast
                words = key_words(deduped).persist()
                held.append(words)
                common = stored_words(words, stored.select(word_of(k).alias("word"), bit_of(k).alias("bits"))).persist()
                held.append(common)
                new = absent_rows(deduped, common, small=common.count() <= BROADCAST_WORDS_MAX)
        out = new.select(*deduped.columns)
        if by_month:
            # rebalance: few files a month, and a large month is split over tasks
            out = out.withColumn(MONTH_COL, _month(c)).hint("rebalance", MONTH_COL)
        written = Observation()
        out = out.sortWithinPartitions(CREATED).observe(written, F.count(F.lit(1)).alias("rows"))
        (out.write.partitionBy(MONTH_COL) if by_month else out.write).mode("append").parquet(raw_path)
        loaded = int(written.get["rows"])
        if last is not None:
            log.append_values(spark, source, last["d"], last["k"], now)
            log.compact(spark)
        return LoadResult(n, loaded, read_watermark(log.read(spark), source) if read_back else None,
                          (lo, hi) if lo is not None else None, int(undated), keyless, sorted(months))
    finally:
        for df in held:
            df.unpersist()

