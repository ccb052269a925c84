"""Incremental ingestion of landed request files.

Two drivers over the same operators (conform -> dedupe -> insert-if-absent ->
append -> watermark):

* ``ingest_stream``: Structured Streaming file source with
  ``trigger(availableNow=True)``; ``maxFilesPerTrigger`` is the batch size.
  The checkpoint records which files each micro-batch took, so a restarted
  query (or a lost executor, by task retry) neither skips nor repeats a file,
  and a replayed micro-batch adds nothing because the load is insert-if-absent.
* ``ingest_pages``: the keyset page loop over a table (cut pages after the
  watermark, load them many at a time, re-read the watermark) until nothing is
  left, then the rows that no page can hold (without a creation time or a key).
* ``ingest_planned``: the same rows by planned pages: one histogram sets every
  page, a stream over the plan loads them, its checkpoint says which are done.
"""

from __future__ import annotations

import datetime as _dt
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.latest import load_latest
from ..operators.load import LoadResult, WatermarkLog, load_batch, read_raw, read_watermark, resume_point
from ..operators.normalize import LEDGER_SCHEMA, batch_dedupe, conform, conform_with_failures, failed_cells
from ..schema import CREATED, DEFAULT_BATCH_SIZE, KEY, LANDING_SCHEMA, SOURCE_NAME
from ..session import list_files, path_exists
from ..sources.files import CORRUPT
from ..sources.pages import Page, first_page_rows, joined_where, ordered_pages, plan_pages, planned_stream, publish_plan

# Rows of the pages that the page loop loads at once, and most loads that a plan of pages is dealt into.
LOAD_ROWS = 2_000_000
LOADS_MAX = 16


@dataclass
class RunCounters:
    """Rows, seconds and batches of an ingestion run."""

    rows: int = 0
    loaded: int = 0
    seconds: float = 0.0
    batches: int = 0
    quarantined: int = 0   # keyless rows and malformed lines, set aside under the quarantine path
    failed_cells: int = 0  # cells whose text could not be typed, kept with their text under the quarantine path
    per_batch: list = field(default_factory=list)

    def add(self, result: LoadResult, seconds: float, malformed: int = 0) -> None:
        self.rows += result.rows_in
        self.loaded += result.rows_loaded
        self.quarantined += result.quarantined + malformed
        self.seconds += seconds
        self.batches += 1
        self.per_batch.append((result.rows_in, result.rows_loaded, round(seconds, 3)))

    @property
    def rows_per_second(self) -> float:
        return self.rows / self.seconds if self.seconds else 0.0


def quarantine_of(raw_path: str) -> str:
    """Default place for rows that cannot be loaded: next to the raw table."""
    return raw_path.rstrip("/") + "_quarantine"


def keep_failures(spark: SparkSession, landed: DataFrame, path: str) -> int:
    """Write the ledger of the landed rows' failed cells to ``path`` (replacing a replay's own); returns how many.

    Nothing is written for a batch without failures: whether there are any is
    asked of the cached rows first.
    """
    ledger = failed_cells(conform_with_failures(landed))
    n = ledger.count()
    if n:
        ledger.write.mode("overwrite").parquet(path)
    return n


def read_failures(spark: SparkSession, raw_path: str, quarantine: str | None = None) -> DataFrame:
    """Every failed cell kept so far (``LEDGER_SCHEMA``), with the micro-batch that met it."""
    path = f"{quarantine or quarantine_of(raw_path)}/failed_cells"
    schema = T.StructType([*LEDGER_SCHEMA.fields, T.StructField("epoch_id", T.LongType(), True)])
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def refresh_marts_after(spark: SparkSession, result: LoadResult, raw_path: str, marts_root: str) -> None:
    """Rebuild the month-layout marts for the months of a batch.

    A batch that added no rows is refreshed too: it may be the replay of one
    whose rows were stored before its refresh was lost.
    """
    from ..plans import marts as M

    months = result.months + ([None] if result.undated else [])
    if months:
        M.refresh_months(spark, marts_root, read_raw(spark, raw_path), months)


def _loader(spark: SparkSession, raw_path: str, log_path: str, now, source: str,
            created_is_immutable: bool, by_month: bool, counters: RunCounters, quarantine: str,
            marts_root: str | None = None, mode: str = "first"):
    if mode not in ("first", "latest"):
        raise ValueError(f"mode is 'first' or 'latest', not {mode!r}")
    if mode == "latest" and not by_month:
        raise ValueError("mode='latest' rewrites months: it needs by_month=True")
    log = WatermarkLog(log_path)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        t0 = time.time()
        when = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        rows = batch.persist()  # cached: Spark refuses filters on the corrupt-record column of a raw scan
        try:
            bad = rows.where(F.col(CORRUPT).isNotNull())
            malformed = bad.count()
            if malformed:  # lines that are not JSON objects keep their text for inspection
                # a replayed micro-batch replaces its own lines
                bad.select(F.col(CORRUPT).alias("line")).write.mode("overwrite").parquet(
                    f"{quarantine}/malformed/epoch_id={int(epoch_id)}")
            landed = rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
            counters.failed_cells += keep_failures(spark, landed, f"{quarantine}/failed_cells/epoch_id={int(epoch_id)}")
            good = conform(landed)
            if mode == "latest":
                result = load_latest(spark, good, raw_path, log, when, source, quarantine_path=f"{quarantine}/keyless")
            else:
                result = load_batch(spark, good, raw_path, log, when, source,
                                    created_is_immutable=created_is_immutable, read_back=False, by_month=by_month,
                                    quarantine_path=f"{quarantine}/keyless")
        finally:
            rows.unpersist()
        if marts_root:
            refresh_marts_after(spark, result, raw_path, marts_root)
        counters.add(result, time.time() - t0, malformed)

    return per_batch


def _file_stream(spark: SparkSession, landing: str, fmt: str, files_per_batch: int) -> DataFrame:
    schema = T.StructType(list(LANDING_SCHEMA.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
    return (spark.readStream.schema(schema).format(fmt).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("maxFilesPerTrigger", int(files_per_batch)).load(landing))


def ingest_stream(spark: SparkSession, landing: str, raw_path: str, log_path: str, checkpoint: str,
                  files_per_batch: int = 1, fmt: str = "json", now=None,
                  source: str = SOURCE_NAME, created_is_immutable: bool = False,
                  by_month: bool = False, quarantine: str | None = None,
                  marts_root: str | None = None, mode: str = "first") -> RunCounters:
    """Load every file present under ``landing`` and stop (``availableNow``).

    ``mode="latest"`` lets a later version of a key replace the stored one
    (``operators.latest``, with ``by_month``); by default the first one stays.

    Malformed lines and keyless records go to ``quarantine`` (default: next to raw).
    With ``marts_root`` (a month-layout warehouse), each micro-batch also
    refreshes the marts for the months it touched.
    """
    counters = RunCounters()
    per_batch = _loader(spark, raw_path, log_path, now, source, created_is_immutable, by_month, counters,
                        quarantine or quarantine_of(raw_path), marts_root, mode)
    query = (_file_stream(spark, landing, fmt, files_per_batch).writeStream.foreachBatch(per_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return counters


def ingest_stream_deltas(spark: SparkSession, landing: str, root: str, checkpoint: str, files_per_batch: int = 1,
                         fmt: str = "json", fold_after: int = 64, first_batch: int = 0) -> RunCounters:
    """Load every file present under ``landing`` into the delta warehouse at ``root`` and stop.

    A micro-batch is a batch of the warehouse under its own id (``first_batch``
    plus the epoch; streams with checkpoints of their own need ranges of their
    own), so its replay replaces what it wrote, or does nothing once it was
    folded. Malformed lines, keyless rows and failed cells are kept next to raw
    by micro-batch, as ``ingest_stream`` keeps them.
    """
    from ..plans.deltas import DeltaWarehouse

    warehouse, counters, quarantine = DeltaWarehouse(spark, root), RunCounters(), quarantine_of(f"{root}/raw")

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        t0, number = time.time(), int(first_batch) + int(epoch_id)
        rows = batch.persist()  # cached: Spark refuses filters on the corrupt-record column of a raw scan
        try:
            bad, landed = rows.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line")), rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
            good = conform(landed)
            keyless = good.where(F.col(KEY).isNull())
            aside = []
            for kind, some in (("malformed", bad), ("keyless", keyless)):
                aside.append(some.count())
                if aside[-1]:
                    some.write.mode("overwrite").parquet(f"{quarantine}/{kind}/epoch_id={number}")
            counters.failed_cells += keep_failures(spark, landed, f"{quarantine}/failed_cells/epoch_id={number}")
            keyed = good.where(F.col(KEY).isNotNull())
            result = warehouse.load_counted(keyed, number)
            warehouse.fold(fold_after)
            if result is None:  # folded before: none of its rows were read
                result = LoadResult(0, 0, None)
            result.quarantined = aside[1]
        finally:
            rows.unpersist()
        counters.add(result, time.time() - t0, aside[0])

    query = (_file_stream(spark, landing, fmt, files_per_batch).writeStream.foreachBatch(per_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return counters


def start_ingest_stream(spark: SparkSession, landing: str, raw_path: str, log_path: str, checkpoint: str,
                        every: str = "1 minute", files_per_batch: int = 1, fmt: str = "json",
                        source: str = SOURCE_NAME, created_is_immutable: bool = False,
                        by_month: bool = False, quarantine: str | None = None, marts_root: str | None = None,
                        mode: str = "first") -> tuple[StreamingQuery, RunCounters]:
    """Keep loading new files as they land (processing-time trigger); returns the running query. Arguments as of ``ingest_stream``."""
    counters = RunCounters()
    per_batch = _loader(spark, raw_path, log_path, None, source, created_is_immutable, by_month, counters,
                        quarantine or quarantine_of(raw_path), marts_root, mode)
    query = (_file_stream(spark, landing, fmt, files_per_batch).writeStream.foreachBatch(per_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(processingTime=every).start())
    return query, counters


def spread(rows: DataFrame) -> DataFrame:
    """The rows of pages dealt over all cores: a large file of the source is one task's, or a few tasks'."""
    return rows.repartition(CREATED, KEY)


def ingest_pages(spark: SparkSession, source_df: DataFrame, raw_path: str, log_path: str,
                 batch_size: int = DEFAULT_BATCH_SIZE, start_date: _dt.datetime | None = None,
                 now=None, source: str = SOURCE_NAME, max_batches: int | None = None) -> RunCounters:
    """Page through ``source_df`` in (created, key) order after the stored watermark.

    Pages hold rows with a creation time and a key, so no page is the end
    and the page size cannot change what is loaded. A last step loads the keyed
    rows without a creation time and quarantines the keyless ones, once each.

    Pages are cut by one sort and loaded many at a time, as a load reads the
    source and probes the target whatever its size: as many as make
    ``LOAD_ROWS`` rows, or more if that makes over ``LOADS_MAX`` loads. What is
    stored is what loading them one by one stores. The watermark moves with a
    load, so a run that was killed repeats one load, which adds no row twice.
    ``batches`` counts pages, ``per_batch`` has one entry a load.
    """
    log = WatermarkLog(log_path)
    counters = RunCounters()
    rows = conform(source_df)
    size = int(batch_size)

    def load(some: DataFrame, dedupe=batch_dedupe) -> LoadResult:
        when = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        return load_batch(spark, some, raw_path, log, when, source, quarantine_path=f"{quarantine_of(raw_path)}/keyless", dedupe=dedupe)

    last_date, last_key = resume_point(read_watermark(log.read(spark), source), start_date)
    while max_batches is None or counters.batches < max_batches:
        pages = ordered_pages(rows, size, last_date, last_key)
        if not pages:
            t0 = time.time()
            result = load(rows.where(F.col(CREATED).isNull() | F.col(KEY).isNull()))
            if result.rows_in or result.quarantined:
                counters.add(result, time.time() - t0)
            break
        if max_batches is not None:
            pages = pages[:max_batches - counters.batches]
        at_once = max(-(-LOAD_ROWS // size), -(-len(pages) // LOADS_MAX))
        for i in range(0, len(pages), at_once):
            t0, some = time.time(), pages[i:i + at_once]
            result = load(spread(rows.where(joined_where(some))), lambda held, of=some: first_page_rows(held, of))
            counters.add(result, time.time() - t0)
            counters.batches += len(some) - 1
            last_date, last_key = result.watermark
    return counters


def ingest_planned(spark: SparkSession, source_df: DataFrame, raw_path: str, log_path: str, plan_root: str,
                   batch_size: int = DEFAULT_BATCH_SIZE, start_date: _dt.datetime | None = None, now=None,
                   source: str = SOURCE_NAME, pages_per_batch: int = 1, created_is_immutable: bool = False) -> RunCounters:
    """The page loop over a plan: one histogram sets all pages, each is loaded by a micro-batch, then the unplaced rows.

    A run plans what lies after the watermark and drains that plan by a stream
    whose checkpoint lies beside it, so a run that was killed is resumed by
    finishing its own plan first (``plan_root`` holds the plans in order). A
    micro-batch reads closed ranges, so its replay reads the same rows and,
    as the load is insert-if-absent, adds none of them twice. Ends with the
    keyed rows without a creation time and the quarantine of keyless ones, as
    ``ingest_pages`` does.

    A micro-batch takes ``pages_per_batch`` pages, or whole multiples of them
    where a plan would make more than ``LOADS_MAX`` micro-batches, as each reads
    the source and probes the target once. What is stored is what groups of
    ``pages_per_batch`` pages, loaded one after the other, store.
    """
    log, counters = WatermarkLog(log_path), RunCounters()
    rows = conform(source_df)
    quarantine = f"{quarantine_of(raw_path)}/keyless"

    def load(batch: DataFrame, dedupe=batch_dedupe) -> None:
        t0 = time.time()
        when = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        result = load_batch(spark, batch, raw_path, log, when, source, quarantine_path=quarantine, read_back=False,
                            created_is_immutable=created_is_immutable, dedupe=dedupe)
        if result.rows_in or result.quarantined:
            counters.add(result, time.time() - t0)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        pages = [Page(*r) for r in batch.orderBy("page").collect()]  # the micro-batch's pages, a row each
        if pages:
            ends = {p.page // pages_per_batch: p for p in pages}  # the last page of each group
            load(spread(rows.where(joined_where(pages))), lambda held: first_page_rows(held, list(ends.values())))

    def drain(number: int) -> None:
        plan = f"{plan_root}/{number}/pages"
        n = sum(not name.startswith(("_", ".")) for name in list_files(spark, plan))  # one file a page
        at_once = pages_per_batch * -(-n // (pages_per_batch * LOADS_MAX))
        query = (planned_stream(spark, plan, at_once).writeStream.foreachBatch(per_batch)
                 .option("checkpointLocation", f"{plan_root}/{number}/checkpoint").trigger(availableNow=True).start())
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))

    number = 0
    while path_exists(spark, f"{plan_root}/{number}/pages/_SUCCESS"):
        number += 1
    if number:  # the last run's plan: finished first, without effect if it was
        drain(number - 1)
    last_date, last_key = resume_point(read_watermark(log.read(spark), source), start_date)
    pages = plan_pages(rows, batch_size, last_date, last_key)
    if pages:
        publish_plan(spark, pages, f"{plan_root}/{number}/pages")
        drain(number)
    load(rows.where(F.col(CREATED).isNull() | F.col(KEY).isNull()))
    return counters


def land_as_json(df: DataFrame, landing: str, files: int) -> None:
    """Write records as JSON-lines files (NULL fields omitted, so keys vary by record).

    The records become text in the tasks that read them; the few tasks that
    write the files only copy it.
    """
    text = F.to_json(F.struct("*"), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("value")
    df.select(text, F.col("unique_key").alias("_key")).repartition(int(files), "_key").select("value").write.mode("overwrite").text(landing)


def backfill_json(spark: SparkSession, path: str, raw_path: str, log_path: str, now=None,
                  source: str = SOURCE_NAME, split_bytes: int | None = None) -> LoadResult:
    """Load JSON-array file(s) once: check the shape, normalise, insert-if-absent, advance the watermark.

    Raises ``ValueError`` when a file is not an array of objects; an empty array loads nothing.
    A file is read by one task, or with ``split_bytes`` by one for each so many bytes.
    """
    from ..sources.arrays import split_json_arrays
    from ..sources.files import read_json_array, validate_json_array

    when = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    if split_bytes is None:
        validate_json_array(spark, path)
        landed = read_json_array(spark, path).persist()
    else:
        arrays = split_json_arrays(spark, path, split_bytes)
        bad = arrays.problems().limit(1).collect()
        if bad:
            raise ValueError(f"{bad[0]['path']}: {bad[0]['problem']}")
        landed = arrays.rows().persist()
    try:
        keep_failures(spark, landed, f"{quarantine_of(raw_path)}/failed_cells/epoch_id=-1")
        return load_batch(spark, conform(landed), raw_path, WatermarkLog(log_path), when, source,
                          quarantine_path=f"{quarantine_of(raw_path)}/keyless")
    finally:
        landed.unpersist()
