"""Published builds: readers keep one complete set, dead builds change nothing, old versions go. Streams into the delta warehouse."""

import datetime as dt

import pytest
from conftest import raw_rows

from civicflow.plans import marts as M
from civicflow.plans.deltas import DeltaWarehouse
from civicflow.plans.published import open_published, publish, versions
from civicflow.session import create_file, list_dirs, list_files
from civicflow.streaming import ingest_stream_deltas, land_as_json
from civicflow.streaming.ingest import read_failures

NAMES = ("fct", "dim_agency", "dim_borough", "dim_complaint_type", "daily", "geo", "agency_perf")


def raw_of(spark, keys, agency="A"):
    return raw_rows(spark, [{"unique_key": k, "created_date": dt.datetime(2026, 1, 1 + k % 9), "closed_date": None, "agency": agency,
                             "borough": "B", "complaint_type": "C", "status": "Open"} for k in keys])


def contents(marts):
    return {n: sorted(map(str, getattr(marts, n).collect())) for n in NAMES}


def test_readers_keep_a_complete_set(spark, tmpdir_path, monkeypatch):
    root, first, second = f"{tmpdir_path}/w", raw_of(spark, range(20)), raw_of(spark, range(30), "Z")
    with pytest.raises(FileNotFoundError):
        open_published(spark, root, first)
    assert publish(spark, M.derive(spark, first), root) == 0
    reader = open_published(spark, root, first)
    want = contents(M.derive(spark, first))
    assert contents(reader) == want

    real, seen = M.write_table, []

    def looks(df, path, **kw):  # after each table of the second build, a new reader looks
        real(df, path, **kw)
        seen.append(contents(open_published(spark, root, first)) if len(seen) in (0, 4) else None)

    monkeypatch.setattr(M, "write_table", looks)
    assert publish(spark, M.derive(spark, second), root) == 1
    monkeypatch.setattr(M, "write_table", real)
    assert len(seen) > 5 and all(s in (None, want) for s in seen)
    assert contents(reader) == want  # opened before: its files are kept
    after = contents(M.derive(spark, second))
    assert contents(open_published(spark, root, second)) == after

    def dies(df, path, **kw):
        if path.endswith("daily"):
            raise RuntimeError("killed")
        real(df, path, **kw)

    monkeypatch.setattr(M, "write_table", dies)
    with pytest.raises(RuntimeError):
        publish(spark, M.derive(spark, first), root)
    monkeypatch.setattr(M, "write_table", real)
    assert versions(spark, root) == [0, 1] and contents(open_published(spark, root, second)) == after


def test_builds_at_once_and_old_versions(spark, tmpdir_path):
    root, raw = f"{tmpdir_path}/w", raw_of(spark, range(5))
    assert create_file(spark, f"{root}/claims/0") and not create_file(spark, f"{root}/claims/0")  # another build runs
    assert publish(spark, M.derive(spark, raw), root) == 1
    assert publish(spark, M.derive(spark, raw), root, by_month=True) == 2
    create_file(spark, f"{root}/published/0")  # the slow one ends: it is not in force
    assert versions(spark, root)[-1] == 2
    assert publish(spark, M.derive(spark, raw), root, keep=1) == 3
    assert versions(spark, root) == [3] and list_dirs(spark, f"{root}/builds") == ["v=3"]
    assert sorted(list_files(spark, f"{root}/claims")) == ["0", "1", "2", "3"]


def test_stream_into_the_delta_warehouse(spark, tmpdir_path):
    rows = raw_of(spark, range(40))
    land_as_json(rows, f"{tmpdir_path}/landing/0", files=3)
    land_as_json(raw_of(spark, range(30, 60), "late"), f"{tmpdir_path}/landing/1", files=1)
    with open(f"{tmpdir_path}/landing/1/bad.json", "w") as f:
        f.write('{"unique_key": "K-7"}\nno json\n')
    root = f"{tmpdir_path}/w"
    for part in (0, 1, 1):  # the last run has nothing to do
        run = ingest_stream_deltas(spark, f"{tmpdir_path}/landing/{part}", root, f"{tmpdir_path}/ckpt{part}", files_per_batch=2,
                                   fold_after=2, first_batch=1000 * part)
    assert run.batches == 0
    w = DeltaWarehouse(spark, root)
    assert w.raw().count() == 60 and w.raw().where("agency = 'late'").count() == 20
    daily = w.aggregates()["daily"].agg({"complaint_count": "sum"}).first()[0]
    assert daily == 60
    assert [r["raw_text"] for r in read_failures(spark, f"{root}/raw").collect()] == ["K-7"]
