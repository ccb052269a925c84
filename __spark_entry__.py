"""

Every query reads the driver's tables at ``sf_dir`` (through the request
view of the testdata) and runs over them whole.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow import oracle as O
from civicflow.operators import load as L
from civicflow.operators import quality as D
from civicflow.operators.keycounts import KeyCounts
from civicflow.operators.latest import load_latest
from civicflow.operators.load import watermark_after
from civicflow.operators.normalize import batch_dedupe, conform, conform_with_failures, failed_cells
from civicflow.plans import marts as M
from civicflow.plans import queries as Q
from civicflow.plans.deltas import DeltaWarehouse
from civicflow.plans.published import open_published, publish
from civicflow.schema import RAW_SCHEMA
from civicflow.session import path_exists, remove_dir, scratch_path
from civicflow.sources import extract as S
from civicflow.sources import testdata
from civicflow.sources.arrays import split_json_arrays
from civicflow.sources.files import write_json_array
from civicflow.streaming import ingest_pages, ingest_planned, ingest_stream, ingest_stream_deltas, land_as_json


def _training_queries() -> tuple[dict, dict]:
    """Queries and SQL of the training-data package; none where the package is not installed."""
    try:
        import corpus_pipeline
        from civicflow.llm import registry
    except ModuleNotFoundError as e:
        if e.name not in ("corpus_pipeline", "civicflow.llm", "civicflow.llm.registry", "civicflow.llm.common"):
            raise  # the package is there, but something that it needs is not
        return {}, {}
    sql = dict(registry.SQL)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return registry.QUERIES | {"pipeline": corpus_pipeline.run}, sql


SMOKE_DIR = "/root/testdata/sf0.001"
AS_OF = _dt.date.fromisoformat(O.AS_OF)
NOW = _dt.datetime.combine(AS_OF, _dt.time())


def _ts(text: str) -> _dt.datetime:
    return _dt.datetime.fromisoformat(text)


def _marts(spark: SparkSession, sf_dir: str) -> M.Marts:
    return M.from_testdata(spark, sf_dir, now=NOW)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(testdata.requests(spark, sf_dir))


_BUILT: dict[tuple[str, str, str], tuple[str, str]] = {}


def _built(spark: SparkSession, sf_dir: str, layout: str = "flat") -> M.Marts:
    """The stored warehouse over ``sf_dir``, built once in an application for each layout.

    ``refreshed`` is a month layout built from the requests before a day and
    then refreshed, after the later ones arrived, for their months only.
    """
    at = (spark.sparkContext.applicationId, sf_dir, layout)
    if at not in _BUILT or not path_exists(spark, f"{_BUILT[at][1]}/marts/dim_date"):
        base = scratch_path(spark, f"warehouse_{layout}")
        _raw(spark, sf_dir).select(*testdata.PRESENT_COLUMNS).write.parquet(f"{base}/raw")  # the others are null, as the schema reads them
        raw = spark.read.schema(RAW_SCHEMA).parquet(f"{base}/raw")
        watermark_after(spark, raw, now=NOW).write.parquet(f"{base}/watermark")
        old = raw.where(F.col("created_date") < F.lit(O.REFRESH_FROM).cast("timestamp_ntz")) if layout == "refreshed" else raw
        M.materialize(spark, M.derive(spark, old, calendar=M.TESTDATA_CALENDAR), f"{base}/out", by_month=layout != "flat")
        if layout == "refreshed":
            last = raw.agg(F.max("created_date")).first()[0]
            if last is not None:
                M.refresh_months(spark, f"{base}/out", raw, M.months_between(_ts(O.REFRESH_FROM), last))
        _BUILT[at] = f"{base}", f"{base}/out"
    base, out = _BUILT[at]
    return M.load(spark, out, spark.read.schema(RAW_SCHEMA).parquet(f"{base}/raw"), spark.read.parquet(f"{base}/watermark"))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: top complaint types over the last year, weighted mean resolution time."""
    return Q.top_complaint_types(_marts(spark, SMOKE_DIR), O.TOP_DAYS, AS_OF)


# --------------------------------------------------------------------------- ingestion

def _batch_dedupe(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return batch_dedupe(raw.unionByName(testdata.replayed(raw)))


def _insert_absent(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    target = raw.where(F.col("created_date") < F.lit(O.TARGET_BEFORE).cast("timestamp_ntz"))
    batch = testdata.replayed(raw).where(F.col("created_date") >= F.lit(O.BATCH_FROM).cast("timestamp_ntz"))
    return target.unionByName(L.insert_absent(batch, target))


def _watermark_merge(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    created = F.col("created_date")
    old_rows = raw.where(created < F.lit(O.MERGE_STATE_BEFORE).cast("timestamp_ntz"))
    state = L.merge_watermark(spark.createDataFrame([], L.META_SCHEMA),
                              L.batch_max(old_rows, source_col="agency"), _ts(O.MERGE_STATE_BEFORE))
    split = F.col("agency") >= F.lit(O.MERGE_AGENCY_SPLIT)
    batch = raw.where((created >= F.lit(O.MERGE_NEW_FROM).cast("timestamp_ntz")) & split).unionByName(
        raw.where((created < F.lit(O.TARGET_BEFORE).cast("timestamp_ntz")) & ~split))
    return L.merge_watermark(state, L.batch_max(batch, source_col="agency"), NOW)


def _stream_ingest(spark, sf_dir):
    landing = scratch_path(spark, "landing")
    base = scratch_path(spark, "stream")
    land_as_json(_raw(spark, sf_dir), landing, files=4)
    ingest_stream(spark, landing, f"{base}/raw", f"{base}/watermark", f"{base}/checkpoint",
                  files_per_batch=1, now=NOW)
    return L.read_raw(spark, f"{base}/raw")


def _page_ingest(spark, sf_dir):
    base = scratch_path(spark, "pages")
    _raw(spark, sf_dir).write.parquet(f"{base}/source")  # the paged source is a stored table
    ingest_pages(spark, spark.read.parquet(f"{base}/source"), f"{base}/raw", f"{base}/watermark",
                 batch_size=5000, now=NOW)
    return L.read_raw(spark, f"{base}/raw")


def _gappy(raw):
    """Requests of which some have lost their creation time and some their key."""
    key = F.col("unique_key")
    return raw.withColumn("created_date", F.when(key % O.UNDATED_EVERY != 0, F.col("created_date"))).withColumn(
        "unique_key", F.when(key % O.KEYLESS_EVERY != 0, key))


def _page_ingest_gaps(batch_size):
    def run(spark, sf_dir):
        base = scratch_path(spark, "pages")
        _gappy(_raw(spark, sf_dir)).write.parquet(f"{base}/source")
        ingest_pages(spark, spark.read.parquet(f"{base}/source"), f"{base}/raw", f"{base}/watermark",
                     batch_size=batch_size, now=NOW)
        return L.read_raw(spark, f"{base}/raw")

    return run


def _planned_ingest(batch_size):
    def run(spark, sf_dir):
        base = scratch_path(spark, "planned")
        _gappy(_raw(spark, sf_dir)).write.parquet(f"{base}/source")
        ingest_planned(spark, spark.read.parquet(f"{base}/source"), f"{base}/raw", f"{base}/watermark", f"{base}/plans",
                       batch_size=batch_size, now=NOW, pages_per_batch=4)
        return L.read_raw(spark, f"{base}/raw")

    return run


def _failed_cells(spark, sf_dir):
    """Requests landed as text, some of whose cells no type fits: the ledger of those cells."""
    key, rows = F.col("unique_key"), testdata.requests(spark, sf_dir)
    landed = rows.select(*(F.col(c).cast("string").alias(c) for c in rows.columns if c not in ("unique_key", "created_date", "latitude")),
                         F.when(key % O.BAD_KEY_EVERY == 0, F.concat(F.lit("K-"), key)).otherwise(key.cast("string")).alias("unique_key"),
                         F.when(key % O.BAD_CREATED_EVERY == 0, "soon").otherwise(F.col("created_date").cast("string")).alias("created_date"),
                         F.when(key % O.BAD_LATITUDE_EVERY == 0, F.concat(F.lit("n/a "), key)).otherwise(
                             F.col("latitude").cast("string")).alias("latitude"))
    return failed_cells(conform_with_failures(landed)).drop("row_hash")


_DELTAS: dict[tuple[str, str], str] = {}


def _delta(spark: SparkSession, sf_dir: str) -> DeltaWarehouse:
    """The warehouse by deltas: three batches by creation time, the second landed twice, two folded, the last with replayed keys."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _DELTAS or not path_exists(spark, _DELTAS[at]):
        root = scratch_path(spark, "deltas")
        w, raw, created = DeltaWarehouse(spark, root), _raw(spark, sf_dir), F.col("created_date")
        early, late = (F.lit(x).cast("timestamp_ntz") for x in (O.TARGET_BEFORE, O.REFRESH_FROM))
        second = raw.where((created >= early) & (created < late))
        w.load(raw.where(created < early), 0)
        w.load(second, 1)
        w.load(second, 1)
        w.fold(min_batches=2)
        w.load(testdata.replayed(raw.where(created < early)).unionByName(raw.where((created >= late) | created.isNull())), 2)
        _DELTAS[at] = root
    return DeltaWarehouse(spark, _DELTAS[at])


def _delta_stream(spark, sf_dir):
    """Requests streamed into a delta warehouse twice, the second time changed: all its stored rows."""
    landing, base, raw = scratch_path(spark, "landing"), scratch_path(spark, "delta_stream"), _raw(spark, sf_dir)
    for k, batch in enumerate((raw, testdata.replayed(raw))):
        land_as_json(batch, f"{landing}/{k}", files=4)
        ingest_stream_deltas(spark, f"{landing}/{k}", base, f"{base}_checkpoint{k}", files_per_batch=2, fold_after=2, first_batch=k << 40)
    return DeltaWarehouse(spark, base).raw()


def _json_array_split(spark, sf_dir):
    """Requests stored as JSON arrays, read back in splits of a megabyte."""
    at = scratch_path(spark, "arrays")
    write_json_array(_raw(spark, sf_dir), at, rows_per_file=200_000)
    return conform(split_json_arrays(spark, at, 1 << 20).rows())


def _latest_ingest(spark, sf_dir):
    """All requests loaded, then changed versions of every fourth with the latest one winning."""
    base, raw = scratch_path(spark, "latest"), _raw(spark, sf_dir)
    log = L.WatermarkLog(f"{base}/watermark")
    for batch in (raw, testdata.replayed(raw).where(F.col("unique_key") % O.LATEST_EVERY == 0)):
        load_latest(spark, batch, f"{base}/raw", log, NOW)
    return L.read_raw(spark, f"{base}/raw")


def _counted(test):
    """Overlapping batches of requests, the second counted twice, two folded: a uniqueness test as it stood after each."""
    def run(spark, sf_dir):
        stg = M.models.staging(_raw(spark, sf_dir))
        model, columns = {"unique": ("stg_requests", D.UNIQUE["stg_requests"]),
                          "unique_combination": ("dim_complaint_type", D.UNIQUE_COMBINATION["dim_complaint_type"])}[test]
        counts = KeyCounts(spark, scratch_path(spark, "keycounts"), columns, nulls=test == "unique_combination")
        for i, (every, below) in enumerate(O.COUNTED_BATCHES):
            rows = stg.where(F.col("unique_key") % every < below)
            rows = rows if test == "unique" else M.models.dim_complaint_type(rows)
            for _ in range(2 if i == 1 else 1):
                counts.load(rows, i)
            if i == 1:
                counts.fold(min_batches=2)
        return counts.history(test, model)

    return run


def _published(read):
    """A warehouse published before the late requests arrived, and again after; the reader opens the version in force."""
    def run(spark, sf_dir):
        root, raw = scratch_path(spark, "published"), _raw(spark, sf_dir)
        early = raw.where(F.col("created_date") < F.lit(O.REFRESH_FROM).cast("timestamp_ntz"))
        for rows in (early, raw):
            publish(spark, M.derive(spark, rows, watermark_after(spark, rows, now=NOW), calendar=M.TESTDATA_CALENDAR), root)
        return read(open_published(spark, root, raw, watermark_after(spark, raw, now=NOW)))

    return run


def _stream_replay(spark, sf_dir):
    landing, base = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    raw = _raw(spark, sf_dir)
    for k, batch in enumerate((raw, testdata.replayed(raw))):  # the second landing repeats every key
        land_as_json(batch, f"{landing}/{k}", files=2)
        ingest_stream(spark, f"{landing}/{k}", f"{base}/raw", f"{base}/watermark", f"{base}/checkpoint{k}", files_per_batch=2, now=NOW)
        remove_dir(spark, f"{landing}/{k}")  # loaded: the next landing needs its room
    return L.read_raw(spark, f"{base}/raw")


def _ingestion_status(spark, sf_dir):
    top = L.batch_max(_raw(spark, sf_dir), source_col="agency")
    return Q.ingestion_status(top.withColumn("updated_at", F.col("last_created_date")), NOW)


def _report(fn):
    return lambda spark, sf_dir: fn(D.models_of(_built(spark, sf_dir)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    mq = {
        # models
        "staging": lambda m: m.stg,
        "enriched": lambda m: M.models.enriched(m.stg),
        "fact": lambda m: m.fct,
        "dim_agency": lambda m: m.dim_agency,
        "dim_borough": lambda m: m.dim_borough,
        "dim_complaint_type": lambda m: m.dim_complaint_type,
        "calendar_days": lambda m: m.dim_date.join(
            m.fct.select(F.to_date("created_date").alias("date_day")).distinct(), "date_day", "left_semi"),
        "daily": lambda m: m.daily,
        "geo_heatmap": lambda m: m.geo,
        "agency_performance": lambda m: m.agency_perf,
    }
    questions = {  # over the stored warehouse
        "overview": Q.overview,
        "daily_trends": lambda m: Q.daily_trends(m, O.TREND_DAYS, AS_OF),
        "top_types": lambda m: Q.top_complaint_types(m, O.TOP_DAYS, AS_OF),
        "top_types_exact": lambda m: Q.top_complaint_types_exact(m, O.TOP_DAYS, AS_OF),
        "geo_hotspots": lambda m: Q.geo_hotspots(m, O.GEO_DAYS, AS_OF),
        "geo_hotspots_exact": lambda m: Q.geo_hotspots_exact(m, O.GEO_DAYS, AS_OF),
        "agency_trend": lambda m: Q.agency_trend(m, O.AGENCY_MONTHS, AS_OF),
        "borough_options": Q.borough_options,
        "status_options": Q.status_options,
        "agency_options": Q.agency_options,
        "recent": lambda m: Q.recent_requests(m, O.RECENT_LIMIT),
        "recent_filtered": lambda m: Q.recent_requests(m, O.RECENT_LIMIT, **O.RECENT_FILTER),
        "heatmap_month": Q.heatmap_by_month,
        "latest_inspection": Q.latest_inspection,
        "instant_close_by_agency": Q.instant_close_by_agency,
        "display_time": Q.display_times,
        "freshness": lambda m: D.freshness(m.raw, NOW),
    }
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        # ingestion
        "conform": _raw,
        "batch_dedupe": _batch_dedupe,
        "insert_absent": _insert_absent,
        "batch_max": lambda spark, sf_dir: L.batch_max(_raw(spark, sf_dir), source_col="agency"),
        "watermark_merge": _watermark_merge,
        "keyset_page": lambda spark, sf_dir: S.keyset_page(
            _raw(spark, sf_dir), O.PAGE_SIZE, _ts(O.PAGE_AFTER[0]), O.PAGE_AFTER[1]),
        "keyset_page_bulk": lambda spark, sf_dir: S.keyset_page(
            _raw(spark, sf_dir), O.BULK_PAGE_SIZE, _ts(O.PAGE_AFTER[0]), O.PAGE_AFTER[1]),
        "keyset_ties": lambda spark, sf_dir: S.keyset_ties(
            _raw(spark, sf_dir), O.PAGE_SIZE, _ts(O.TIES_AT[0]), O.TIES_AT[1]),
        "since_date": lambda spark, sf_dir: S.since_date(_raw(spark, sf_dir), O.PAGE_SIZE, _ts(O.SINCE)),
        "latest_n": lambda spark, sf_dir: S.latest_n(_raw(spark, sf_dir), O.PAGE_SIZE),
        "latest_n_bulk": lambda spark, sf_dir: S.latest_n(_raw(spark, sf_dir), O.BULK_PAGE_SIZE),
        "key_lookup": lambda spark, sf_dir: S.key_lookup(_raw(spark, sf_dir), O.LOOKUP_KEY),
        "stream_ingest": _stream_ingest,
        "stream_replay": _stream_replay,
        "stream_delta": _delta_stream,
        "latest_ingest": _latest_ingest,
        "json_array_split": _json_array_split,
        "overview_published": _published(Q.overview),
        "daily_published": _published(lambda m: m.daily),
        "page_ingest": _page_ingest,
        "page_ingest_small": _page_ingest_gaps(O.SMALL_BATCH),
        "page_ingest_large": _page_ingest_gaps(O.LARGE_BATCH),
        "planned_ingest_small": _planned_ingest(O.SMALL_BATCH),
        "planned_ingest_large": _planned_ingest(O.LARGE_BATCH),
        "failed_cells": _failed_cells,
        "keyset_page_null_keys": lambda spark, sf_dir: S.keyset_page(_gappy(_raw(spark, sf_dir)), O.BULK_PAGE_SIZE, columns=["created_date", "unique_key"]),
        "ingestion_status": _ingestion_status,
        # data tests
        "not_null_report": _report(D.not_null_report),
        "unique_report": _report(D.unique_report),
        "accepted_values_report": _report(D.accepted_values_report),
        "unique_combo_report": _report(D.unique_combination_report),
        "unique_by_batch": _counted("unique"),
        "unique_combo_by_batch": _counted("unique_combination"),
    }
    for name, fn in mq.items():
        out[name] = (lambda f: lambda spark, sf_dir: f(_marts(spark, sf_dir)))(fn)
    for name, fn in questions.items():
        out[name] = (lambda f: lambda spark, sf_dir: f(_built(spark, sf_dir)))(fn)
    for layout, suffix in O.LAYOUTS.items():
        for name, field in O.BUILT_TABLES.items():
            out[f"{name}_{suffix}"] = (lambda a, b: lambda spark, sf_dir: getattr(_built(spark, sf_dir, a), b))(layout, field)
    for name, field in O.DELTA_TABLES.items():
        out[f"{name}_delta"] = (lambda f: lambda spark, sf_dir: (lambda w: w.dimensions() if f.startswith("dim_") else w.aggregates())(
            _delta(spark, sf_dir))[f])(field)
    for name in ("overview", "recent"):
        out[f"{name}_monthly"] = (lambda f: lambda spark, sf_dir: f(_built(spark, sf_dir, "monthly")))(questions[name])
    return out | _training_queries()[0]


def oracle_sql() -> dict[str, str]:
    sql = O.queries_sql() | _training_queries()[1]
    return {k: sql[k] for k in queries() if k in sql}
