"""Planned pages, the stream over a plan, the ledger of failed cells, the sample command, and the warehouse by deltas."""

import datetime as dt
import json
import tempfile

import pytest
from conftest import raw_rows, ts
from pyspark.sql import functions as F

import civicflow.streaming.ingest as I
from civicflow.__main__ import main
from civicflow.operators.load import insert_absent, read_raw
from civicflow.operators.normalize import conform, conform_with_failures, failed_cells
from civicflow.plans import models
from civicflow.plans.deltas import DeltaWarehouse
from civicflow.sources.extract import keyset_page
from civicflow.sources.pages import first_page_rows, joined_where, ordered_pages, plan_pages, read_page

NOW = dt.datetime(2026, 5, 1)


def hot_rows():
    """Even hours, one hot second, one hot instant with far keys, repeats of a key, undated and keyless rows."""
    rows = [(k, ts("2026-01-01") + dt.timedelta(hours=k)) for k in range(300)]
    rows += [(1000 + k, ts("2026-01-05 07:00:03") + dt.timedelta(microseconds=k * 7)) for k in range(400)]
    rows += [((k * 7919) << 21, ts("2026-01-06 12:00:00")) for k in range(500)]
    rows += [(50_000 + k, ts("2026-01-06 12:00:00")) for k in range(200)]
    rows += [(77, ts("2026-01-09 01:02:03"))] * 3 + [(-5, ts("1969-12-31 23:59:59.5")), (9, None), (10, None), (None, ts("2026-01-02")), (None, None)]
    return rows


@pytest.fixture(scope="module")
def source(spark):
    df = spark.createDataFrame(hot_rows(), "unique_key long, created_date timestamp_ntz").withColumn("agency", F.lit("A"))
    path = tempfile.mkdtemp(prefix="civicflow-test-", dir="/tmp") + "/source"
    df.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def order(r):
    return r[1], r[0]


@pytest.mark.parametrize("size", [1, 7, 450, 10_000])
def test_pages_are_the_ordered_table(source, size):
    placed = sorted((r for r in hot_rows() if r[0] is not None and r[1] is not None), key=order)
    pages = plan_pages(source, size)
    assert sum(p.rows for p in pages) == len(placed)
    at = 0
    for n, p in enumerate(pages):
        assert p.page == n and (p.rows <= size or len({tuple(x) for x in placed[at:at + p.rows]}) == 1)
        assert (p.last_created, p.last_key) == (placed[at + p.rows - 1][1], placed[at + p.rows - 1][0])
        assert (p.after_created, p.after_key) == ((placed[at - 1][1], placed[at - 1][0]) if at else (None, None))
        if size >= 450:
            assert sorted(((r[0], r[1]) for r in read_page(source, p).collect()), key=order) == placed[at:at + p.rows]
        at += p.rows
    if size >= 7:  # about as few pages as can be
        assert len(pages) <= 2 * -(-len(placed) // size) + 4


def test_pages_after_a_watermark(source):
    first = keyset_page(source.where("unique_key is not null and created_date is not null"), 350).collect()[-1]
    rest = plan_pages(source, 100, first["created_date"], first["unique_key"])
    assert sum(p.rows for p in rest) == len(hot_rows()) - 4 - 350
    assert (rest[0].after_created, rest[0].after_key) == (first["created_date"], first["unique_key"])
    assert plan_pages(source, 100, ts("2030-01-01"), 1) == [] == plan_pages(source.limit(0), 100)


def test_a_page_reaches_the_scan(spark, source):
    page = plan_pages(source, 450)[1]
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = read_page(source, page)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters" in plan and "LessThanOrEqual(created_date" in plan and "GreaterThanOrEqual(created_date" in plan


def paths():
    root = tempfile.mkdtemp(prefix="civicflow-test-", dir="/tmp")
    return f"{root}/raw", f"{root}/watermark", f"{root}/plans"


def loaded(spark, raw):
    return sorted((r["unique_key"], r["created_date"]) for r in read_raw(spark, raw).where("created_date is not null").collect())


def test_planned_ingest_equals_the_page_loop(spark, source):
    a, b = paths(), paths()
    run = I.ingest_planned(spark, source, *a, batch_size=300, now=NOW, pages_per_batch=2)
    I.ingest_pages(spark, source, *b[:2], batch_size=300, now=NOW)
    assert loaded(spark, a[0]) == loaded(spark, b[0]) and read_raw(spark, a[0]).count() == read_raw(spark, b[0]).count()
    assert I.WatermarkLog(a[1]).read(spark).collect() == I.WatermarkLog(b[1]).read(spark).collect()
    assert run.quarantined == 2
    again = I.ingest_planned(spark, source, *a, batch_size=300, now=NOW)
    assert again.loaded == 0 and read_raw(spark, a[0]).count() == read_raw(spark, b[0]).count()


@pytest.mark.parametrize("size", [300, 10_000])
def test_ordered_pages_are_full(source, size):
    placed = sorted((r for r in hot_rows() if r[0] is not None and r[1] is not None), key=order)
    pages = ordered_pages(source, size)
    assert len(pages) == -(-len(placed) // size) and sum(p.rows for p in pages) == len(placed)
    assert [(p.last_created, p.last_key) for p in pages] == [order(r)[:2] for r in [*placed[size - 1::size], placed[-1]]][:len(pages)]
    assert ordered_pages(source, size, ts("2030-01-01"), 1) == [] == ordered_pages(source.limit(0), size)


def versions(spark):
    """Keys that come back on later pages with other values."""
    rows = [(k, ts("2026-01-01") + dt.timedelta(hours=h), f"at {h}") for h in range(60) for k in {h, h // 2, 99}]
    return spark.createDataFrame(rows, "unique_key long, created_date timestamp_ntz, agency string")


def one_by_one(rows, units):
    """(key, value) stored by units of pages one after the other."""
    held = {}
    for unit in units:
        best = {}
        for r in rows.where(joined_where(unit)).select("unique_key", "created_date", "agency").collect():
            best[r[0]] = max(best.get(r[0], (r[1], r[2])), (r[1], r[2]))
        held = best | held
    return sorted((k, v[1]) for k, v in held.items())


def test_pages_loaded_at_once_store_what_single_pages_store(spark):
    rows, a = versions(spark), paths()
    pages = ordered_pages(rows, 7)
    want = one_by_one(rows, [[p] for p in pages])
    got = first_page_rows(rows, pages)
    assert sorted((r[0], r[1]) for r in got.select("unique_key", "agency").collect()) == want
    assert got.columns == rows.columns
    run = I.ingest_pages(spark, rows, *a[:2], batch_size=7, now=NOW)
    assert sorted((r[0], r[1]) for r in read_raw(spark, a[0]).select("unique_key", "agency").collect()) == want
    assert (run.batches, len(run.per_batch), run.loaded) == (len(pages), 1, len(want))  # was a load for each page


def test_a_long_plan_makes_a_bounded_number_of_loads(spark, monkeypatch):
    rows, a = versions(spark), paths()
    pages = plan_pages(rows, 4)
    monkeypatch.setattr(I, "LOADS_MAX", 3)
    run = I.ingest_planned(spark, rows, *a, batch_size=4, now=NOW, pages_per_batch=2)
    assert len(pages) > 20 and run.batches == 3  # was one for every two pages
    want = one_by_one(rows, [pages[i:i + 2] for i in range(0, len(pages), 2)])
    assert sorted((r[0], r[1]) for r in read_raw(spark, a[0]).select("unique_key", "agency").collect()) == want


def test_a_killed_plan_is_finished_and_loads_no_row_twice(spark, source, monkeypatch):
    a, real, calls = paths(), I.load_batch, []

    def dies(*args, **kw):
        calls.append(1)
        out = real(*args, **kw)
        if len(calls) == 2:
            raise RuntimeError("killed after its rows were stored")
        return out

    monkeypatch.setattr(I, "load_batch", dies)
    with pytest.raises(Exception, match="killed"):
        I.ingest_planned(spark, source, *a, batch_size=300, now=NOW)
    monkeypatch.setattr(I, "load_batch", real)
    assert 0 < read_raw(spark, a[0]).count() < 1402
    more = source.limit(0).unionByName(spark.createDataFrame([(5, ts("2026-03-01"), "B")], source.schema)).unionByName(source)
    I.ingest_planned(spark, more, *a, batch_size=300, now=NOW)  # a row that came since is in the next plan (its key is not new: 5)
    keys = [r[0] for r in read_raw(spark, a[0]).select("unique_key").collect()]
    want = {r[0] for r in hot_rows() if r[0] is not None}
    assert len(keys) == len(set(keys)) and set(keys) == want


# ---------------------------------------------------------------- failed cells

def test_failed_cells_keep_their_text(spark):
    df = spark.createDataFrame([("K-77", "2026-01-01", "40.5", "A", {"a": 1}), ("12", "soon", "", "", None), ("13", None, None, None, None),
                                ("14", "2026-01-01T10:00:00.000", "1e1", "x", None)],
                               "unique_key string, created_date string, latitude string, agency string, location map<string,int>")
    both = conform_with_failures(df)
    assert [tuple(r) for r in both.drop("failed_cells", "row_hash").collect()] == [tuple(r) for r in conform(df).collect()]
    got = {(r["unique_key"], r["column"], r["raw_text"], r["reason"]) for r in failed_cells(both).collect()}
    assert got == {(None, "unique_key", "K-77", "not a bigint"), (12, "created_date", "soon", "not a timestamp_ntz"),
                   (12, "latitude", "", "not a decimal(38,18)")}
    assert both.select("row_hash").distinct().count() == 4
    assert failed_cells(conform_with_failures(conform(df))).count() == 0
    assert failed_cells(conform_with_failures(df.limit(0))).count() == 0
    assert failed_cells(conform_with_failures(spark.createDataFrame([(1,)], "other int"))).count() == 0


def test_stream_keeps_the_ledger(spark):
    root = tempfile.mkdtemp(prefix="civicflow-test-", dir="/tmp")
    lines = [{"unique_key": "1", "created_date": "2026-01-01T00:00:00"}, {"unique_key": "K-77", "created_date": "2026-01-02T00:00:00"},
             {"unique_key": "3", "created_date": "tomorrow"}]
    spark.createDataFrame([(json.dumps(x),) for x in lines], "value string").coalesce(1).write.text(f"{root}/landing")
    for _ in range(2):  # a second run finds nothing new
        run = I.ingest_stream(spark, f"{root}/landing", f"{root}/raw", f"{root}/wm", f"{root}/ckpt", now=NOW)
    assert run.batches == 0
    got = {(r["unique_key"], r["column"], r["raw_text"]) for r in I.read_failures(spark, f"{root}/raw").collect()}
    assert got == {(None, "unique_key", "K-77"), (3, "created_date", "tomorrow")}
    assert I.read_failures(spark, f"{root}/other").count() == 0


def test_sample_command(spark, source, monkeypatch):
    root = tempfile.mkdtemp(prefix="civicflow-test-", dir="/tmp")
    source.write.parquet(f"{root}/table")
    main(["sample", "--table", f"{root}/table", "--out", f"{root}/one", "--key", "1003"])
    rows = spark.read.option("header", True).csv(f"{root}/one/normalised").collect()
    assert [r["unique_key"] for r in rows] == ["1003"] and len(rows[0]) == 44
    main(["sample", "--table", f"{root}/table", "--out", f"{root}/some", "--size", "7"])
    assert spark.read.option("header", True).csv(f"{root}/some/raw").count() == 7


# ---------------------------------------------------------------- deltas

def request(k, day, closed=None, **more):
    return {"unique_key": k, "created_date": ts(f"2026-01-{day:02}"), "closed_date": closed and ts(closed), "agency": f"A{k % 3}",
            "agency_name": f"Agency {k % 4}", "borough": None if k % 5 == 0 else f"B{k % 2}", "complaint_type": f"T{k % 2}",
            "latitude": 40.0 + k / 100, "longitude": -70.0, **more}


def tables(w):
    return {n: sorted(map(str, df.collect())) for n, df in (w.aggregates() | w.dimensions()).items()}


def full_build(raw):
    stg = models.staging(raw)
    fct = models.fact(models.enriched(stg))
    out = {"daily": models.daily(fct), "geo": models.geo_heatmap(fct), "agency_perf": models.agency_performance(fct),
           "dim_agency": models.dim_agency(stg), "dim_borough": models.dim_borough(stg), "dim_complaint_type": models.dim_complaint_type(stg)}
    return {n: sorted(map(str, df.collect())) for n, df in out.items()}


def test_deltas_equal_a_full_build(spark):
    w = DeltaWarehouse(spark, tempfile.mkdtemp(prefix="civicflow-test-", dir="/tmp") + "/w")
    assert all(not v for v in tables(w).values()) and w.raw().count() == 0
    batches = [raw_rows(spark, [request(k, 1 + k % 3, "2026-01-05 06:00:00") for k in range(0, 12)] + [request(3, 2)]),
               raw_rows(spark, [request(k, 2 + k % 3, None, agency="late") for k in range(8, 20)] + [{"unique_key": 99, "agency": None, "borough": "B"}]),
               raw_rows(spark, [request(k, 4, "2026-01-03") for k in range(15, 25)])]
    raw = conform(batches[0].limit(0))
    for i, b in enumerate(batches):
        w.load(b, i)
        w.load(b, i)  # a replay
        raw = raw.unionByName(insert_absent(models_dedupe(b), raw))
        w.fold(2)  # of three batches, two are folded
    for i, b in enumerate(batches):  # late replays of all
        assert w.load(b, i) == (i == 2)
    assert tables(w) == full_build(raw) and sorted(map(str, w.raw().collect())) == sorted(map(str, raw.collect()))


def models_dedupe(b):
    from civicflow.operators.normalize import batch_dedupe
    return batch_dedupe(b)


def test_only_repeated_keys_are_deduped(spark, monkeypatch):
    import civicflow.plans.deltas as D

    calls, real = [], D.batch_dedupe
    monkeypatch.setattr(D, "batch_dedupe", lambda rows: calls.append(1) or real(rows))
    w = DeltaWarehouse(spark, tempfile.mkdtemp(prefix="civicflow-test-", dir="/tmp") + "/w")
    batch = raw_rows(spark, [request(k, 1 + k % 3) for k in range(-70, 70)] + [{"unique_key": None, "agency": "A"}])
    assert (w.load_counted(batch, 0).rows_loaded, calls) == (140, [])  # was sorted and shuffled whole
    more = raw_rows(spark, [request(k, 2) for k in range(60, 80)] + [request(75, 3, agency="later")])
    got = w.load_counted(more, 1)
    assert (got.rows_in, got.rows_loaded, calls) == (20, 10, [1])
    assert [r[0] for r in w.raw().where("unique_key = 75").select("agency").collect()] == ["later"]


def test_a_crash_in_a_load_or_fold_changes_nothing(spark, monkeypatch):
    w = DeltaWarehouse(spark, tempfile.mkdtemp(prefix="civicflow-test-", dir="/tmp") + "/w")
    first, second = (raw_rows(spark, [request(k, 1 + k % 3) for k in ks]) for ks in (range(6), range(4, 9)))
    w.load(first, 0)
    real, before = models.aggregate_sets, tables(w)
    calls = []

    def dies(fct):
        calls.append(1)
        raise RuntimeError("killed before the delta")

    monkeypatch.setattr(models, "aggregate_sets", dies)
    with pytest.raises(RuntimeError):
        w.load(second, 1)  # rows are stored, their delta is not
    monkeypatch.setattr(models, "aggregate_sets", real)
    assert tables(w)["daily"] == before["daily"]
    w.load(second, 1)
    want = tables(w)
    from pyspark.sql import DataFrameWriter
    write = DataFrameWriter.parquet

    def dies_at_manifest(self, path, *a, **kw):
        if path.endswith("/manifest"):
            raise RuntimeError("killed before the manifest")
        return write(self, path, *a, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", dies_at_manifest)
    with pytest.raises(RuntimeError):
        w.fold(1)
    monkeypatch.setattr(DataFrameWriter, "parquet", write)
    assert tables(w) == want and w.raw().count() == 9
    assert w.fold(1) == 2 and tables(w) == want and w.raw().count() == 9
    assert w.load(first, 0) is False


def test_many_batches_leave_few_directories(spark):
    from civicflow.session import list_dirs

    w = DeltaWarehouse(spark, tempfile.mkdtemp(prefix="civicflow-test-", dir="/tmp") + "/w")
    for i in range(4):
        w.load(raw_rows(spark, [request(i, 1)]), i)
        w.fold(1)
    assert len(list_dirs(spark, f"{w.root}/state")) == 2 and len(list_dirs(spark, f"{w.root}/deltas")) <= 2
    assert w.raw().count() == 4
