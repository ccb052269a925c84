"""Loads that keep the latest version of a key: changed rows, months that move, replays, crashes, marts after them."""

import datetime as dt

import pytest
from conftest import raw_rows

from civicflow.operators import latest as L
from civicflow.operators.load import MONTH_COL, WatermarkLog, read_raw
from civicflow.plans import marts as M
from civicflow.session import list_dirs, path_exists
from civicflow.streaming import ingest_stream, land_as_json
from civicflow.streaming.ingest import refresh_marts_after

NOW = dt.datetime(2026, 5, 1)


def req(key, month=1, status="Open", closed=None, **more):
    created = dt.datetime(2026, month, 1 + (key or 0) % 9) if month else None
    return {"unique_key": key, "created_date": created, "closed_date": closed, "status": status, "agency": "A", "borough": "B",
            "complaint_type": "C"} | more


def rows(df):
    return sorted(map(str, df.collect()))


def of(spark, *reqs):
    return raw_rows(spark, list(reqs), sorted(req(1)))


FIRST = [req(k, 1 + k % 3) for k in range(12)] + [req(50, None)]
SECOND = [req(1, 2, "Closed", dt.datetime(2026, 3, 1)), req(2, 3), req(4, 1, "Closed"), req(50, 2), req(7, None), req(99, 6), req(None, 1)]


def merged():
    by_key = {r["unique_key"]: r for r in FIRST}
    return list((by_key | {r["unique_key"]: r for r in SECOND if r["unique_key"] is not None}).values())


def test_latest_version_wins(spark, tmpdir_path):
    raw, log = f"{tmpdir_path}/raw", WatermarkLog(f"{tmpdir_path}/wm")
    got = L.load_latest(spark, of(spark, *FIRST), raw, log, NOW)
    assert (got.rows_in, got.rows_loaded, got.undated, len(got.months)) == (13, 13, 1, 3)
    assert rows(read_raw(spark, raw)) == rows(of(spark, *FIRST))
    got = L.load_latest(spark, of(spark, *SECOND), raw, log, NOW, quarantine_path=f"{tmpdir_path}/q")
    # key 2 is as it was; 4 moves from February to January, 7 loses and 50 gets a creation time
    assert (got.rows_in, got.rows_loaded, got.quarantined, got.undated) == (6, 5, 1, 1)
    assert got.months == [dt.date(2026, m, 1) for m in (1, 2, 6)]
    want = rows(of(spark, *merged()))
    assert rows(read_raw(spark, raw)) == want
    again = L.load_latest(spark, of(spark, *SECOND), raw, log, NOW)
    assert again.rows_loaded == 0 and again.months == [] and rows(read_raw(spark, raw)) == want
    assert L.load_latest(spark, of(spark, *SECOND).limit(0), raw, log, NOW).rows_in == 0
    assert log.read(spark).first()["last_unique_key"] == 99 and not path_exists(spark, L.pending_of(raw))


def test_only_touched_months_are_written(spark, tmpdir_path):
    raw, log = f"{tmpdir_path}/raw", WatermarkLog(f"{tmpdir_path}/wm")
    L.load_latest(spark, of(spark, *FIRST), raw, log, NOW)
    before = {f for f in spark.read.parquet(raw).inputFiles()}
    L.load_latest(spark, of(spark, req(2, 3, "Closed")), raw, log, NOW)
    gone = before - set(spark.read.parquet(raw).inputFiles())
    assert gone and all(f"{MONTH_COL}=2026-03-01" in f for f in gone)
    L.load_latest(spark, of(spark, req(50, 1)), raw, log, NOW)  # the only undated row moves: its directory goes
    assert list_dirs(spark, raw) == [f"{MONTH_COL}=2026-0{m}-01" for m in (1, 2, 3)]


@pytest.mark.parametrize("ready", [False, True])
def test_a_rewrite_that_died_is_finished_or_undone(spark, tmpdir_path, monkeypatch, ready):
    raw, log = f"{tmpdir_path}/raw", WatermarkLog(f"{tmpdir_path}/wm")
    L.load_latest(spark, of(spark, *FIRST), raw, log, NOW)

    def dies(*a):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        if ready:
            real = L.finish_rewrite
            m.setattr(L, "finish_rewrite", lambda s, p: dies() if path_exists(s, f"{L.pending_of(p)}/ready") else real(s, p))
        else:
            m.setattr(L, "create_file", dies)
        with pytest.raises(RuntimeError):
            L.load_latest(spark, of(spark, *SECOND), raw, log, NOW)
    assert rows(read_raw(spark, raw)) == rows(of(spark, *FIRST))
    L.finish_rewrite(spark, raw)
    assert rows(read_raw(spark, raw)) == rows(of(spark, *(merged() if ready else FIRST)))
    L.load_latest(spark, of(spark, *SECOND), raw, log, NOW)
    assert rows(read_raw(spark, raw)) == rows(of(spark, *merged()))


def test_by_shuffle_and_marts(spark, tmpdir_path, monkeypatch):
    """Without broadcasts, and month marts refreshed after each load equal a full build of the latest versions."""
    monkeypatch.setattr(L, "BROADCAST_KEYS_MAX", 0)
    raw, log, root = f"{tmpdir_path}/raw", WatermarkLog(f"{tmpdir_path}/wm"), f"{tmpdir_path}/w"
    L.load_latest(spark, of(spark, *FIRST), raw, log, NOW)
    M.materialize(spark, M.derive(spark, read_raw(spark, raw)), root, by_month=True)
    result = L.load_latest(spark, of(spark, *SECOND), raw, log, NOW)
    refresh_marts_after(spark, result, raw, root)
    full = M.derive(spark, of(spark, *merged()))
    got = M.load(spark, root, read_raw(spark, raw))
    for name in ("fct", "daily", "geo", "agency_perf", "dim_agency", "dim_borough", "dim_complaint_type"):
        want = getattr(full, name)
        assert rows(getattr(got, name).select(*want.columns)) == rows(want), name


def test_stream_mode(spark, tmpdir_path):
    landing, raw = f"{tmpdir_path}/landing", f"{tmpdir_path}/raw"
    for i, part in enumerate((FIRST, SECOND)):
        land_as_json(of(spark, *part), f"{landing}/{i}", files=1)
        run = ingest_stream(spark, f"{landing}/{i}", raw, f"{tmpdir_path}/wm", f"{tmpdir_path}/ckpt{i}", by_month=True, mode="latest", now=NOW)
    assert (run.loaded, run.quarantined) == (5, 1) and rows(read_raw(spark, raw)) == rows(of(spark, *merged()))
    for bad in ({"mode": "latest"}, {"mode": "last", "by_month": True}):
        with pytest.raises(ValueError):
            ingest_stream(spark, landing, raw, f"{tmpdir_path}/wm", f"{tmpdir_path}/ckpt2", **bad)
