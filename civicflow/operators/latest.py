"""Loading with the latest version of a key: late closings and status changes replace what is stored.

The default load keeps the first version of a key. This one is asked for, and
needs the month layout of raw: a batch's changes are found by key, and only the
creation months that hold an old or a new version are written again.

The rewrite is journaled. The new months are staged next to raw and marked ready
before raw is touched; putting them in place replaces whole months, so it can be
repeated, and every later load first finishes a rewrite that died. Readers see
each month old or new. One load runs at a time.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CREATED, EXPECTED_COLUMNS, KEY, RAW_SCHEMA, SOURCE_NAME
from ..session import create_file, path_exists, remove_dir
from .load import BROADCAST_KEYS_MAX, MONTH_COL, LoadResult, WatermarkLog, _month, _set_aside
from .normalize import batch_dedupe, null_key_rows

MONTHS_SCHEMA = T.StructType([*RAW_SCHEMA.fields, T.StructField(MONTH_COL, T.DateType(), True)])


def pending_of(raw_path: str) -> str:
    """Where a rewrite is staged: next to the raw table."""
    return raw_path.rstrip("/") + "_pending"


def changed_rows(batch: DataFrame, stored: DataFrame, batch_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """What a batch (one row a key) changes: its rows that are new or differ, and the stored versions they replace.

    Stored rows are met by key where they lie if the batch's size is known and
    bounded (its keys are broadcast), else by shuffle. The comparison then joins
    tables of at most the batch's rows.
    """
    k = F.col(KEY)
    keys = batch.select(KEY)
    if batch_rows is not None and batch_rows <= BROADCAST_KEYS_MAX:
        keys = F.broadcast(keys)
    old = stored.join(keys, KEY, "left_semi")
    before = old.select(k.alias("_key"), F.struct(*EXPECTED_COLUMNS).alias("_old"))
    now = F.struct(*EXPECTED_COLUMNS)
    differs = F.col("_old").isNull() | ~now.eqNullSafe(F.col("_old"))
    new = batch.join(before, k == F.col("_key"), "left").where(differs).select(*EXPECTED_COLUMNS)
    return new, old


def _among(months: list) -> Column:
    """Rows of the given months (None: rows without a creation time)."""
    dated = [m for m in months if m is not None]
    keep = F.col(MONTH_COL).isin(*dated) if dated else F.lit(False)
    return keep | F.col(MONTH_COL).isNull() if None in months else keep


def finish_rewrite(spark: SparkSession, raw_path: str) -> bool:
    """Put a staged rewrite in place, if a load left one that is ready; throws an unfinished one away."""
    pending = pending_of(raw_path)
    if not path_exists(spark, f"{pending}/ready"):
        remove_dir(spark, pending)
        return False
    months = [r[0] for r in spark.read.schema("m date").parquet(f"{pending}/months").collect()]  # one row a month
    rows = spark.read.schema(MONTHS_SCHEMA).parquet(f"{pending}/rows")
    filled = {r[0] for r in rows.select(MONTH_COL).distinct().collect()}
    out = rows.hint("rebalance", MONTH_COL).sortWithinPartitions(MONTH_COL, CREATED).write.mode("overwrite")
    out.option("partitionOverwriteMode", "dynamic").partitionBy(MONTH_COL).parquet(raw_path)
    for m in set(months) - filled:  # all rows of the month have moved to others
        remove_dir(spark, f"{raw_path}/{MONTH_COL}={'__HIVE_DEFAULT_PARTITION__' if m is None else m.isoformat()}")
    remove_dir(spark, f"{pending}/ready")
    remove_dir(spark, pending)
    return True


def load_latest(spark: SparkSession, batch: DataFrame, raw_path: str, log: WatermarkLog, now: _dt.datetime,
                source: str = SOURCE_NAME, quarantine_path: str | None = None) -> LoadResult:
    """Load a batch so that its version of a key replaces the stored one (month layout); then advance the watermark.

    Within a batch the version that ``batch_dedupe`` picks counts. Rows equal to
    the stored version change nothing, so a replay of the last batch writes
    nothing; a replay of an older one brings its versions back, as the batch loaded
    last is the latest. ``rows_loaded`` counts rows new or changed, ``months`` the
    creation months to refresh, those that lost a row included; ``undated`` is
    positive if rows without a creation time are among them.
    """
    finish_rewrite(spark, raw_path)
    rows = batch.persist()
    held = [rows]

    def kept(df: DataFrame) -> DataFrame:
        held.append(df.persist())
        return df

    try:
        keyless = null_key_rows(rows)
        aside = _set_aside(spark, keyless, quarantine_path) if quarantine_path else keyless.count()
        deduped = kept(batch_dedupe(rows))
        c, k = F.col(CREATED), F.col(KEY)
        top = F.max(F.when(c.isNotNull(), F.struct(c.alias("d"), k.alias("k"))))
        n, k_lo, k_hi, lo, hi, last = deduped.agg(F.count(F.lit(1)), F.min(k), F.max(k), F.min(c), F.max(c), top).first()
        if n == 0:
            return LoadResult(0, 0, None, quarantined=aside)
        stored = spark.createDataFrame([], MONTHS_SCHEMA)
        if path_exists(spark, raw_path):
            stored = spark.read.schema(MONTHS_SCHEMA).parquet(raw_path)
        near = stored.where(k.between(F.lit(int(k_lo)), F.lit(int(k_hi))))
        new, old = changed_rows(deduped, near, int(n))
        new = kept(new.withColumn(MONTH_COL, _month(c)))
        changed = new.count()
        months = []
        if changed:
            replaced = old.join(new.select(KEY), KEY, "left_semi")
            months = [r[0] for r in new.select(MONTH_COL).union(replaced.select(MONTH_COL)).distinct().collect()]  # one row a month
            keys = new.select(KEY)
            if changed <= BROADCAST_KEYS_MAX:
                keys = F.broadcast(keys)
            stay = stored.where(_among(months)).join(keys, KEY, "left_anti").select(*MONTHS_SCHEMA.names)
            pending = pending_of(raw_path)
            stay.unionByName(new.select(*MONTHS_SCHEMA.names)).write.parquet(f"{pending}/rows")
            spark.createDataFrame([(m,) for m in months], "m date").coalesce(1).write.parquet(f"{pending}/months")
            create_file(spark, f"{pending}/ready")
            finish_rewrite(spark, raw_path)
        if last is not None:
            log.append_values(spark, source, last["d"], last["k"], now)
            log.compact(spark)
        return LoadResult(int(n), changed, None, (lo, hi) if lo is not None else None, int(None in months), aside,
                          sorted(m for m in months if m is not None))
    finally:
        for df in held:
            df.unpersist()
