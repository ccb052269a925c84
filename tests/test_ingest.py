import datetime as dt
import json
import os

import pytest
from conftest import SF_SMALL, raw_rows, ts
from pyspark.sql import functions as F

from civicflow.operators import load as L
from civicflow.operators.normalize import batch_dedupe, conform
from civicflow.schema import EXPECTED_COLUMNS, META_SCHEMA, RAW_SCHEMA
from civicflow.sources import extract as S
from civicflow.sources import files
from civicflow.streaming import ingest_pages, ingest_stream


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


RECORDS = [
    {"unique_key": "10", "created_date": "2026-01-05T10:00:00.000", "agency": "DOB",
     "location": {"type": "Point", "coordinates": [-73.9, 40.7]}, "unexpected": "x", "latitude": "40.7"},
    {"unique_key": "11", "created_date": "2026-01-05T11:00:00.000", "closed_date": "not a date",
     "borough": "QUEENS"},
]


def test_conform_json_array(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "array.json")
    late = [{"unique_key": str(100 + i), "created_date": "2026-01-06T00:00:00.000"} for i in range(120)]
    late[-1]["vehicle_type"] = "CAR"  # a key first seen late in the file
    _write(p, json.dumps(RECORDS + late))
    files.validate_json_array(spark, p)
    df = conform(files.read_json_array(spark, p))
    assert df.columns == EXPECTED_COLUMNS and df.schema == conform(df).schema
    assert [f.dataType for f in df.schema.fields] == [f.dataType for f in RAW_SCHEMA.fields]
    rows = {r.unique_key: r for r in df.collect()}
    assert len(rows) == 122
    assert json.loads(rows[10].location) == {"type": "Point", "coordinates": [-73.9, 40.7]}
    assert rows[10].created_date == dt.datetime(2026, 1, 5, 10)
    assert str(rows[10].latitude).startswith("40.7")
    assert rows[11].closed_date is None and rows[11].borough == "QUEENS"  # bad cell only
    assert rows[219].vehicle_type == "CAR"


def test_json_lines_match_array(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "lines.json")
    _write(p, "\n".join(json.dumps(r) for r in RECORDS))
    a = os.path.join(tmpdir_path, "a.json")
    _write(a, json.dumps(RECORDS))
    lines = conform(files.read_json_lines(spark, p))
    arr = conform(files.read_json_array(spark, a))
    assert sorted(map(tuple, lines.collect())) == sorted(map(tuple, arr.collect()))


@pytest.mark.parametrize("content,problem", [
    ('{"unique_key": "1"}', "not a JSON array"),
    ('[{"unique_key": "1"}, 5]', "element is not a JSON object"),
    ('[{"unique_key": "1"}, "x"]', "element is not a JSON object"),
])
def test_json_shape_rejected(spark, tmpdir_path, content, problem):
    p = os.path.join(tmpdir_path, "bad.json")
    _write(p, content)
    with pytest.raises(ValueError, match=problem):
        files.validate_json_array(spark, p)


def test_empty_array_loads_nothing(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "empty.json")
    _write(p, "[]")
    files.validate_json_array(spark, p)
    log = L.WatermarkLog(os.path.join(tmpdir_path, "wm"))
    res = L.load_batch(spark, conform(files.read_json_array(spark, p)), os.path.join(tmpdir_path, "raw"), log,
                       ts("2026-01-07 00:00:00"))
    assert res.rows_in == 0 and res.watermark == (None, None)


def test_dedupe_is_deterministic_and_insert_keeps_stored_row(spark):
    c = ts("2026-01-05 10:00:00")
    batch = raw_rows(spark, [
        {"unique_key": 1, "created_date": c, "status": "Open"},
        {"unique_key": 1, "created_date": c, "status": "Closed"},
        {"unique_key": 2, "created_date": c, "status": "Open"},
    ])
    d = {r.unique_key: r.status for r in batch_dedupe(batch).collect()}
    assert d == {1: "Open", 2: "Open"}  # greatest row: 'Open' > 'Closed'
    target = raw_rows(spark, [{"unique_key": 2, "created_date": c, "status": "Stored"}])
    for rows_known in (None, 3):
        new = L.insert_absent(batch_dedupe(batch), target, batch_rows=rows_known)
        assert sorted(r.unique_key for r in new.collect()) == [1]


def test_batch_max_numeric_keys_and_null_dates(spark):
    c = ts("2026-01-05 10:00:00")
    batch = raw_rows(spark, [
        {"unique_key": 999, "created_date": c},
        {"unique_key": 1000, "created_date": c},
        {"unique_key": 5, "created_date": None},
    ])
    top = L.batch_max(batch).first()
    assert (top.last_created_date, top.last_unique_key) == (c, 1000)


def test_watermark_merge_rules(spark):
    now = ts("2026-02-01 00:00:00")
    old = spark.createDataFrame([
        ("a", ts("2026-01-10 00:00:00"), 50, ts("2026-01-10 01:00:00")),
        ("b", ts("2026-01-10 00:00:00"), 50, ts("2026-01-10 01:00:00")),
        ("c", ts("2026-01-10 00:00:00"), 50, ts("2026-01-10 01:00:00")),
        ("d", ts("2026-01-10 00:00:00"), 50, ts("2026-01-10 01:00:00")),
    ], META_SCHEMA)
    top = spark.createDataFrame([
        ("a", ts("2026-01-11 00:00:00"), 7),      # newer date: new key even if smaller
        ("b", ts("2026-01-10 00:00:00"), 60),     # equal date: greatest key
        ("c", ts("2026-01-09 00:00:00"), 999),    # older batch: nothing goes back
        ("e", ts("2026-01-01 00:00:00"), 1),      # new source
    ], "source_name string, last_created_date timestamp_ntz, last_unique_key bigint")
    got = {r.source_name: r for r in L.merge_watermark(old, top, now).collect()}
    assert (got["a"].last_created_date, got["a"].last_unique_key) == (ts("2026-01-11 00:00:00"), 7)
    assert got["b"].last_unique_key == 60
    assert (got["c"].last_created_date, got["c"].last_unique_key) == (ts("2026-01-10 00:00:00"), 50)
    assert got["c"].updated_at == now
    assert got["d"].updated_at == ts("2026-01-10 01:00:00")  # untouched
    assert got["e"].last_unique_key == 1


def test_resume_point():
    d, k = ts("2026-01-10 00:00:00"), 5
    start = ts("2026-01-01 00:00:00")
    assert L.resume_point((None, None), start) == (start, None)
    assert L.resume_point((d, k), start) == (d, k)
    assert L.resume_point((d, k), ts("2026-02-01 00:00:00")) == (ts("2026-02-01 00:00:00"), None)
    assert L.resume_point((None, None), None) == (None, None)


def test_paging_equals_full_scan_with_ties(spark):
    c = ts("2026-01-05 10:00:00")
    rows = [{"unique_key": k, "created_date": c} for k in (5, 1, 4, 2, 3)]
    rows += [{"unique_key": 9, "created_date": ts("2026-01-04 10:00:00")},
             {"unique_key": 0, "created_date": ts("2026-01-06 10:00:00")}]
    df = raw_rows(spark, rows)
    seen, d, k = [], None, None
    while True:
        page = [(r.created_date, r.unique_key) for r in S.keyset_page(df, 2, d, k).collect()]
        if not page:
            break
        seen += page
        d, k = page[-1]
    full = [(r.created_date, r.unique_key) for r in df.orderBy("created_date", "unique_key").collect()]
    assert seen == full
    assert [r.unique_key for r in S.keyset_ties(df, 10, c, 2).collect()] == [3, 4, 5]
    over = S.keyset_page(df, 10, c, 2, where=F.col("unique_key") != 4, columns=["unique_key"],
                         order=[F.col("unique_key").desc()])
    assert over.columns == ["unique_key"] and [r.unique_key for r in over.collect()] == [5, 3, 0]
    assert [r.unique_key for r in S.since_date(df, 10, c).collect()] == [1, 2, 3, 4, 5, 0]
    assert [r.unique_key for r in S.latest_n(df, 2).collect()] == [0, 5]
    assert [r.unique_key for r in S.key_lookup(df, 4).collect()] == [4]
    assert S.sample(df, 3).count() == 3


def test_page_loop_loads_once_and_watermark_tracks(spark, tmpdir_path):
    c = ts("2026-01-05 10:00:00")
    df = raw_rows(spark, [{"unique_key": k, "created_date": c} for k in range(7)])
    raw, wm = os.path.join(tmpdir_path, "raw"), os.path.join(tmpdir_path, "wm")
    run = ingest_pages(spark, df, raw, wm, batch_size=3, now=ts("2026-01-06 00:00:00"))
    assert run.rows == 7 and run.batches == 3
    again = ingest_pages(spark, df, raw, wm, batch_size=3, now=ts("2026-01-06 00:00:00"))
    assert again.rows == 0
    assert spark.read.parquet(raw).count() == 7
    assert L.read_watermark(L.WatermarkLog(wm).read(spark)) == (c, 6)


def test_stream_overlapping_files_no_duplicates(spark, tmpdir_path):
    land = os.path.join(tmpdir_path, "landing")
    os.makedirs(land)
    recs = [{"unique_key": str(k), "created_date": f"2026-01-0{1 + k % 5}T00:00:00"} for k in range(20)]
    _write(os.path.join(land, "a.json"), "\n".join(json.dumps(r) for r in recs[:12]))
    _write(os.path.join(land, "b.json"), "\n".join(json.dumps(r) for r in recs[8:]))  # 8..11 repeat
    raw, wm, ck = (os.path.join(tmpdir_path, x) for x in ("raw", "wm", "ck"))
    run = ingest_stream(spark, land, raw, wm, ck, files_per_batch=1, now=ts("2026-01-07 00:00:00"))
    assert run.batches == 2 and run.loaded == 20
    out = spark.read.parquet(raw)
    assert out.count() == 20 and out.select("unique_key").distinct().count() == 20
    # a second query over the same files (new checkpoint) adds nothing
    rerun = ingest_stream(spark, land, raw, wm, ck + "2", files_per_batch=2, now=ts("2026-01-08 00:00:00"))
    assert rerun.loaded == 0 and spark.read.parquet(raw).count() == 20
    meta = L.WatermarkLog(wm).read(spark).first()
    assert (meta.last_created_date, meta.last_unique_key) == (ts("2026-01-05 00:00:00"), 19)
    assert meta.updated_at == ts("2026-01-08 00:00:00")


def test_batch_split_invariance(spark, tmpdir_path):
    """Any split of the same records gives the same raw table and watermark."""
    c = ts("2026-01-05 10:00:00")
    rows = [{"unique_key": k, "created_date": c + dt.timedelta(hours=k % 3), "status": str(k)} for k in range(30)]
    df = raw_rows(spark, rows)
    results = []
    for parts in (1, 3):
        raw, wm = os.path.join(tmpdir_path, f"raw{parts}"), os.path.join(tmpdir_path, f"wm{parts}")
        log = L.WatermarkLog(wm)
        for i in range(parts):
            L.load_batch(spark, df.where(F.col("unique_key") % parts == i), raw, log, ts("2026-01-06 00:00:00"))
        results.append((sorted(map(tuple, spark.read.parquet(raw).collect())), L.read_watermark(log.read(spark))))
    assert results[0] == results[1]


def test_csv_and_json_sinks(spark, tmpdir_path):
    df = raw_rows(spark, [{"unique_key": 1, "created_date": ts("2026-01-05 10:00:00"), "agency": "A"}])
    files.write_csv(df, os.path.join(tmpdir_path, "csv"))
    files.write_json(df, os.path.join(tmpdir_path, "json"))
    back = spark.read.option("header", True).csv(os.path.join(tmpdir_path, "csv"))
    assert back.count() == 1 and back.columns == EXPECTED_COLUMNS
    j = conform(files.read_json_lines(spark, os.path.join(tmpdir_path, "json")))
    assert [tuple(r) for r in j.collect()] == [tuple(r) for r in df.collect()]


def test_pruned_target_still_rejects_stored_keys(spark, tmpdir_path):
    """With immutable creation times only the batch's months are probed; stored rows still win."""
    rows = [{"unique_key": k, "created_date": ts(f"2026-0{1 + k % 3}-10 10:00:00"), "status": "stored"}
            for k in range(9)]
    raw, wm = os.path.join(tmpdir_path, "raw"), os.path.join(tmpdir_path, "wm")
    log = L.WatermarkLog(wm)
    L.load_batch(spark, raw_rows(spark, rows), raw, log, ts("2026-04-01 00:00:00"), by_month=True)
    again = [dict(r, status="again") for r in rows] + [
        {"unique_key": 100, "created_date": ts("2026-02-11 00:00:00"), "status": "new"},
        {"unique_key": 101, "created_date": None, "status": "undated"}]
    res = L.load_batch(spark, raw_rows(spark, again), raw, log, ts("2026-04-02 00:00:00"),
                       created_is_immutable=True, by_month=True)
    assert res.rows_in == 11 and res.rows_loaded == 2
    out = {r.unique_key: r.status for r in L.read_raw(spark, raw).collect()}
    assert len(out) == 11 and out[0] == "stored" and out[100] == "new" and out[101] == "undated"
    months = sorted(x for x in os.listdir(raw) if x.startswith("created_month="))
    assert months == ["created_month=2026-01-01", "created_month=2026-02-01", "created_month=2026-03-01",
                      "created_month=__HIVE_DEFAULT_PARTITION__"]
    # undated rows are probed in the NULL-month directory: replaying them adds nothing
    res2 = L.load_batch(spark, raw_rows(spark, again[-1:]), raw, log, ts("2026-04-03 00:00:00"),
                        created_is_immutable=True, by_month=True)
    assert res2.rows_loaded == 0
    # flat layout: the same pruning through row-group statistics
    flat = os.path.join(tmpdir_path, "flat")
    L.load_batch(spark, raw_rows(spark, rows), flat, log, ts("2026-04-01 00:00:00"))
    res3 = L.load_batch(spark, raw_rows(spark, again), flat, log, ts("2026-04-02 00:00:00"),
                        created_is_immutable=True)
    assert res3.rows_loaded == 2 and L.read_raw(spark, flat).count() == 11


def test_backfill_json_and_sample_copies(spark, tmpdir_path):
    from civicflow.streaming import backfill_json
    p = os.path.join(tmpdir_path, "array.json")
    _write(p, json.dumps(RECORDS))
    raw, wm = os.path.join(tmpdir_path, "raw"), os.path.join(tmpdir_path, "wm")
    res = backfill_json(spark, p, raw, wm, now=ts("2026-01-07 00:00:00"))
    assert (res.rows_in, res.rows_loaded) == (2, 2)
    assert res.watermark == (ts("2026-01-05 11:00:00"), 11)
    assert res.created_range == (ts("2026-01-05 10:00:00"), ts("2026-01-05 11:00:00")) and res.undated == 0
    assert backfill_json(spark, p, raw, wm, now=ts("2026-01-08 00:00:00")).rows_loaded == 0
    bad = os.path.join(tmpdir_path, "object.json")
    _write(bad, json.dumps(RECORDS[0]))
    with pytest.raises(ValueError):
        backfill_json(spark, bad, raw, wm)
    out = os.path.join(tmpdir_path, "sample")
    files.write_sample_copies(files.read_json_array(spark, p), out, size=1)
    assert spark.read.option("header", True).csv(out + "/raw").count() == 1
    assert spark.read.option("header", True).csv(out + "/normalised").columns == EXPECTED_COLUMNS


def test_continuous_stream_picks_up_new_files(spark, tmpdir_path):
    from civicflow.streaming import start_ingest_stream
    land = os.path.join(tmpdir_path, "landing")
    os.makedirs(land)
    _write(os.path.join(land, "a.json"), json.dumps({"unique_key": "1", "created_date": "2026-01-01T00:00:00"}))
    raw, wm, ck = (os.path.join(tmpdir_path, x) for x in ("raw", "wm", "ck"))
    query, counters = start_ingest_stream(spark, land, raw, wm, ck, every="1 second")
    try:
        query.processAllAvailable()
        _write(os.path.join(land, "b.json"), json.dumps({"unique_key": "2", "created_date": "2026-01-02T00:00:00"}))
        query.processAllAvailable()
    finally:
        query.stop()
    assert counters.loaded == 2 and spark.read.parquet(raw).count() == 2
    assert L.read_watermark(L.WatermarkLog(wm).read(spark)) == (ts("2026-01-02 00:00:00"), 2)


@pytest.mark.parametrize("limit", [1, 3, 7, 12, 20, 25])
def test_bounded_first_rows_equals_plain_top_k(spark, limit):
    """Hot instant (many rows at one time), hot day, undated rows: same rows as a full sort."""
    hot = ts("2026-01-05 10:00:00")
    rows = [{"unique_key": k, "created_date": hot} for k in (5, 1 << 41, 3, 1 << 21, 9, 2)]
    rows += [{"unique_key": 100 + k, "created_date": hot + dt.timedelta(minutes=k)} for k in range(6)]
    rows += [{"unique_key": 200 + k, "created_date": ts("2026-01-0%d 00:00:00" % (1 + k % 4))} for k in range(6)]
    rows += [{"unique_key": 300 + k, "created_date": None} for k in range(3)]
    df = raw_rows(spark, rows)
    for desc in (False, True):
        for nulls_first in (False, True):
            order = S._order(desc, nulls_first)
            want = [r.unique_key for r in df.orderBy(*order).limit(limit).collect()]
            got = S.bounded_first_rows(df, limit, desc, nulls_first, slack=1).orderBy(*order).collect()
            assert [r.unique_key for r in got] == want, (desc, nulls_first)


def test_target_probe_is_limited_to_the_batch_key_range(spark, tmpdir_path):
    raw, wm = os.path.join(tmpdir_path, "raw"), os.path.join(tmpdir_path, "wm")
    log = L.WatermarkLog(wm)
    c = ts("2026-01-05 10:00:00")
    L.load_batch(spark, raw_rows(spark, [{"unique_key": k, "created_date": c} for k in (1, 50, 100)]), raw, log, c)
    res = L.load_batch(spark, raw_rows(spark, [{"unique_key": k, "created_date": c} for k in (50, 60, 100, 101)]),
                       raw, log, c)
    assert (res.rows_in, res.rows_loaded) == (4, 2)
    assert sorted(r.unique_key for r in L.read_raw(spark, raw).collect()) == [1, 50, 60, 100, 101]


def test_command_line_ingest_build_test(spark, tmpdir_path):
    from civicflow.__main__ import main
    p = os.path.join(tmpdir_path, "array.json")
    _write(p, json.dumps(RECORDS))
    raw, wm, out = (os.path.join(tmpdir_path, x) for x in ("raw", "wm", "out"))
    main(["ingest", "--raw", raw, "--watermark", wm, "--json-source", p])
    main(["build", "--raw", raw, "--watermark", wm, "--out", out, "--by-month"])
    main(["refresh", "--raw", raw, "--watermark", wm, "--out", out, "--months", "2026-01", "--undated"])
    with pytest.raises(SystemExit) as done:
        main(["test", "--raw", raw, "--watermark", wm, "--out", out, "--now", "2026-01-05T12:00:00"])
    assert done.value.code == 1  # records without complaint types fail their not_null tests
    assert spark.read.parquet(os.path.join(out, "marts", "fct")).count() == 2


def test_load_then_refresh_touched_months_equals_full_build(spark, tmpdir_path):
    from civicflow.plans import marts as M
    raw, wm, wh = (os.path.join(tmpdir_path, x) for x in ("raw", "wm", "wh"))
    log = L.WatermarkLog(wm)
    first = [{"unique_key": k, "created_date": ts(f"2026-0{1 + k % 2}-1{k % 9} 08:00:00"), "agency": f"A{k % 3}",
              "borough": "B", "complaint_type": "T", "closed_date": ts(f"2026-0{1 + k % 2}-1{k % 9} 09:30:00"),
              "latitude": 40.7, "longitude": -74.0} for k in range(12)]
    L.load_batch(spark, raw_rows(spark, first), raw, log, ts("2026-03-01 00:00:00"))
    M.materialize(spark, M.derive(spark, L.read_raw(spark, raw)), "file://" + wh, by_month=True)
    second = first[:3] + [{"unique_key": 100 + k, "created_date": ts(f"2026-03-0{1 + k} 12:00:00"),
                           "agency": "A9", "borough": "C", "complaint_type": "U"} for k in range(4)]
    res = L.load_batch(spark, raw_rows(spark, second), raw, log, ts("2026-03-09 00:00:00"))
    assert res.rows_loaded == 4
    months = M.months_between(*res.created_range) + ([None] if res.undated else [])
    current = L.read_raw(spark, raw)
    refreshed = M.refresh_months(spark, "file://" + wh, current, months)
    full = M.derive(spark, current)
    for name in ("fct", "daily", "geo", "agency_perf", "dim_agency", "dim_borough", "dim_complaint_type"):
        a, b = getattr(refreshed, name), getattr(full, name)
        cols = sorted(b.columns)
        assert sorted(map(tuple, a.select(*cols).collect()), key=repr) == sorted(
            map(tuple, b.select(*cols).collect()), key=repr), name


def test_command_line_stream_and_table_modes(spark, tmpdir_path, capsys):
    from civicflow.__main__ import main
    land = os.path.join(tmpdir_path, "landing")
    os.makedirs(land)
    _write(os.path.join(land, "a.json"), "\n".join(json.dumps(r) for r in RECORDS))
    raw, wm, ck = (os.path.join(tmpdir_path, x) for x in ("raw", "wm", "ck"))
    main(["ingest", "--raw", raw, "--watermark", wm, "--landing", land, "--checkpoint", ck])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert (out["rows"], out["loaded"], out["batches"]) == (2, 2, 1)
    table = os.path.join(tmpdir_path, "table")
    raw_rows(spark, [{"unique_key": k, "created_date": ts("2026-01-05 10:00:00")} for k in range(5)]).write.parquet(table)
    raw2, wm2 = os.path.join(tmpdir_path, "raw2"), os.path.join(tmpdir_path, "wm2")
    main(["ingest", "--raw", raw2, "--watermark", wm2, "--table", table, "--batch-size", "2",
          "--start-date", "2026-01-01T00:00:00"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert (out["rows"], out["loaded"], out["batches"]) == (5, 5, 3)


def test_stream_quarantines_malformed_and_keyless_records(spark, tmpdir_path):
    land = os.path.join(tmpdir_path, "landing")
    os.makedirs(land)
    lines = [json.dumps({"unique_key": "1", "created_date": "2026-01-01T00:00:00"}),
             "{not json at all",
             json.dumps({"created_date": "2026-01-02T00:00:00", "agency": "no key"}),
             json.dumps({"unique_key": "2", "created_date": "2026-01-03T00:00:00"})]
    _write(os.path.join(land, "a.json"), "\n".join(lines))
    raw, wm, ck = (os.path.join(tmpdir_path, x) for x in ("raw", "wm", "ck"))
    run = ingest_stream(spark, land, raw, wm, ck, now=ts("2026-01-05 00:00:00"))
    assert (run.rows, run.loaded, run.quarantined) == (2, 2, 2)
    q = raw + "_quarantine"
    assert [r.line for r in spark.read.parquet(q + "/malformed").collect()] == ["{not json at all"]
    assert [r.agency for r in spark.read.parquet(q + "/keyless").collect()] == ["no key"]
    assert spark.read.parquet(raw).count() == 2


def test_stream_keeps_month_marts_fresh(spark, tmpdir_path):
    from civicflow.plans import marts as M
    land = os.path.join(tmpdir_path, "landing")
    os.makedirs(land)
    recs = [{"unique_key": str(k), "created_date": f"2026-0{1 + k % 3}-0{1 + k % 5}T08:00:00",
             "closed_date": f"2026-0{1 + k % 3}-0{1 + k % 5}T09:00:00", "agency": f"A{k % 2}", "borough": "B",
             "complaint_type": "T"} for k in range(9)]
    _write(os.path.join(land, "a.json"), "\n".join(json.dumps(r) for r in recs[:5]))
    raw, wm, ck, wh = (os.path.join(tmpdir_path, x) for x in ("raw", "wm", "ck", "wh"))
    ingest_stream(spark, land, raw, wm, ck, now=ts("2026-04-01 00:00:00"))
    M.materialize(spark, M.derive(spark, L.read_raw(spark, raw)), "file://" + wh, by_month=True)
    _write(os.path.join(land, "b.json"), "\n".join(json.dumps(r) for r in recs[3:]))  # 3, 4 replayed
    run = ingest_stream(spark, land, raw, wm, ck, now=ts("2026-04-02 00:00:00"), marts_root="file://" + wh)
    assert run.loaded == 4
    current = L.read_raw(spark, raw)
    got = M.load(spark, "file://" + wh, current)
    want = M.derive(spark, current)
    for name in ("fct", "daily", "agency_perf", "dim_agency"):
        cols = sorted(getattr(want, name).columns)
        assert sorted(map(tuple, getattr(got, name).select(*cols).collect()), key=repr) == sorted(
            map(tuple, getattr(want, name).select(*cols).collect()), key=repr), name


@pytest.mark.parametrize("by_month,most", [(False, L.BROADCAST_KEYS_MAX), (True, L.BROADCAST_KEYS_MAX), (False, 0), (True, 0)])
def test_the_write_counts_what_it_adds(spark, tmpdir_path, monkeypatch, by_month, most):
    monkeypatch.setattr(L, "BROADCAST_KEYS_MAX", most)
    log = L.WatermarkLog(f"{tmpdir_path}/w")

    def rows(keys):
        return raw_rows(spark, [{"unique_key": k, "created_date": dt.datetime(2020, 1 + k % 3, 2) if k % 7 else None, "agency": "A"} for k in keys])

    for keys, added in ((range(1, 30), 29), (range(1, 30), 0), ([*range(20, 40), 39, 39], 10), ([], 0)):
        got = L.load_batch(spark, rows(keys) if len(keys) else rows([1]).limit(0), f"{tmpdir_path}/raw", log, dt.datetime(2021, 1, 1), by_month=by_month)
        assert (got.rows_in, got.rows_loaded) == (len(set(keys)), added)
        assert got.months == sorted({dt.date(2020, 1 + k % 3, 1) for k in keys if k % 7})
    assert L.read_raw(spark, f"{tmpdir_path}/raw").count() == 39


def test_landing_writes_text_made_before_its_shuffle(spark, tmpdir_path, monkeypatch):
    from civicflow.streaming import land_as_json

    df = raw_rows(spark, [{"unique_key": k, "created_date": ts("2026-01-05 10:00:00"), "agency": None if k % 2 else 'A "é"'} for k in range(6)]
                  + [{"unique_key": None, "agency": None}])
    df.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(f"{tmpdir_path}/want")
    dealt, real = [], type(df).repartition
    monkeypatch.setattr(type(df), "repartition", lambda self, *a: dealt.append(self.columns) or real(self, *a))
    land_as_json(df, f"{tmpdir_path}/got", files=2)
    assert dealt == [["value", "_key"]]  # the rows were dealt, and turned to text by two tasks
    lines = [sorted(r[0] for r in spark.read.text(f"{tmpdir_path}/{x}").collect()) for x in ("got", "want")]
    assert lines[0] == lines[1] and len(lines[0]) == 7


def test_large_batch_meets_the_target_by_key_bits(spark, tmpdir_path, monkeypatch):
    """The rows of a batch whose keys are too many to broadcast were shuffled with all their columns."""
    def of(keys, agency):
        return raw_rows(spark, [{"unique_key": k, "created_date": ts("2026-01-05 10:00:00"), "agency": agency} for k in keys])

    args = f"{tmpdir_path}/raw", L.WatermarkLog(f"{tmpdir_path}/wm"), ts("2026-02-01 00:00:00")
    L.load_batch(spark, of([-65, -1, 0, 63, 64, 2**40], "first"), *args)
    frame = type(spark.range(0))
    plans, real = [], frame.sortWithinPartitions
    monkeypatch.setattr(frame, "sortWithinPartitions", lambda self, *c: plans.append(self._jdf.queryExecution().executedPlan().toString()) or real(self, *c))
    monkeypatch.setattr(L, "BROADCAST_KEYS_MAX", 0)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        res = L.load_batch(spark, of([-65, -64, -2, -1, 0, 1, 62, 63, 64, 127, 2**40, 2**40 + 1], "second"), *args)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert res.rows_loaded == 6 and len(plans) == 1 and "SortMergeJoin" not in plans[0].split("InMemoryRelation")[0]
    stored = {r["unique_key"]: r["agency"] for r in L.read_raw(spark, f"{tmpdir_path}/raw").collect()}
    assert stored == dict.fromkeys([-65, -1, 0, 63, 64, 2**40], "first") | dict.fromkeys([-64, -2, 1, 62, 127, 2**40 + 1], "second")


def test_replay_keeps_one_landing_at_a_time(spark, tmpdir_path, monkeypatch):
    import __spark_entry__ as entry

    held, real = [], entry.land_as_json

    def land(df, landing, files):
        held.append(sorted(os.listdir(os.path.dirname(landing))) if os.path.isdir(os.path.dirname(landing)) else [])
        real(df, landing, files)

    monkeypatch.setattr(entry, "land_as_json", land)
    monkeypatch.setattr(entry, "scratch_path", lambda spark, *parts: f"{tmpdir_path}/{parts[0]}")
    assert entry.queries()["stream_replay"](spark, SF_SMALL).count() == 1500
    assert held == [[], []] and os.listdir(f"{tmpdir_path}/landing") == []
