import datetime as dt

from conftest import raw_rows, ts
from pyspark.sql import functions as F

from civicflow.operators import quality as D
from civicflow.plans import marts as M
from civicflow.plans import queries as Q
from civicflow.schema import META_SCHEMA

AS_OF = dt.date(2026, 2, 1)


def _marts(spark, rows, meta=None):
    return M.derive(spark, raw_rows(spark, rows), meta)


def _req(k, created, **kw):
    return {"unique_key": k, "created_date": ts(created), **kw}


def test_overview_without_watermark_row(spark):
    m = _marts(spark, [_req(1, "2026-01-05 10:00:00", agency="A", complaint_type="T", borough="B",
                            closed_date=ts("2026-01-05 12:00:00")),
                       _req(2, "2026-01-06 10:00:00", agency="C", complaint_type="T")],
               meta=spark.createDataFrame([], META_SCHEMA))
    r = Q.overview(m).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.total_records, r.complaint_types, r.agencies, r.boroughs) == (2, 1, 2, 1)
    assert r.avg_resolution_hours == 2.0 and r.latest_created_at == ts("2026-01-06 10:00:00")
    assert r.last_ingestion_at is None and r.ingestion_watermark is None


def test_options_exclude_null_and_empty(spark):
    m = _marts(spark, [
        _req(1, "2026-01-05 10:00:00", borough="", agency="", status="", agency_name="x"),
        _req(2, "2026-01-05 10:00:00", borough=None, agency=None, status=None),
        _req(3, "2026-01-05 10:00:00", borough="Q", agency="A", agency_name="Alpha", status="Open"),
        _req(4, "2026-01-05 10:00:00", borough="Q", agency="A", agency_name="Alpha (old)", status="Open"),
    ])
    assert [r[0] for r in Q.borough_options(m).collect()] == ["Q"]
    assert [r[0] for r in Q.status_options(m).collect()] == ["Open"]
    assert [r[0] for r in Q.agency_options(m).collect()] == ["A", "A"]  # two names -> listed twice


def test_top_types_all_open_is_null_and_windows_inclusive(spark):
    m = _marts(spark, [
        _req(1, "2026-01-02 10:00:00", complaint_type="Open only"),   # 30 days before as_of: inside
        _req(2, "2026-01-20 10:00:00", complaint_type="Mixed", closed_date=ts("2026-01-20 12:00:00")),
        _req(3, "2026-01-21 10:00:00", complaint_type="Mixed"),
        _req(4, "2026-01-01 10:00:00", complaint_type="Too old"),
    ])
    got = {r.complaint_type: r for r in Q.top_complaint_types(m, 30, AS_OF).collect()}
    assert set(got) == {"Open only", "Mixed"}
    assert got["Open only"].avg_resolution_hours is None
    # weight = all requests of the day-group with a mean: day 01-20 has 1 request, mean 2 h; 01-21 has none
    assert got["Mixed"].complaint_count == 2 and got["Mixed"].avg_resolution_hours == 2.0
    exact = {r.complaint_type: r for r in Q.top_complaint_types_exact(m, 30, AS_OF).collect()}
    assert exact["Mixed"].avg_resolution_hours == 2.0


def test_weighted_mean_counts_open_requests_of_mixed_groups(spark):
    # one day-group: 1 closed (4 h) + 1 open -> mean 4 h, weight 2; other day: 1 closed (1 h), weight 1
    m = _marts(spark, [
        _req(1, "2026-01-20 10:00:00", complaint_type="T", closed_date=ts("2026-01-20 14:00:00")),
        _req(2, "2026-01-20 11:00:00", complaint_type="T"),
        _req(3, "2026-01-21 10:00:00", complaint_type="T", closed_date=ts("2026-01-21 11:00:00")),
    ])
    r = Q.top_complaint_types(m, 30, AS_OF).first()
    assert abs(r.avg_resolution_hours - (2 * 4 + 1 * 1) / 3) < 1e-12
    e = Q.top_complaint_types_exact(m, 30, AS_OF).first()
    assert e.avg_resolution_hours == 2.5


def test_geo_hotspots_mean_of_means_and_label(spark):
    m = _marts(spark, [
        _req(1, "2026-01-20 10:00:00", latitude=40.705, longitude=-74.005, closed_date=ts("2026-01-20 11:00:00")),
        _req(2, "2026-01-20 10:00:00", latitude=40.705, longitude=-74.005, closed_date=ts("2026-01-20 11:00:00")),
        _req(3, "2026-01-21 10:00:00", latitude=40.705, longitude=-74.005, closed_date=ts("2026-01-21 14:00:00")),
    ])
    r = Q.geo_hotspots(m, 30, AS_OF).first()
    assert r.complaint_count == 3 and r.avg_resolution_hours == 2.5  # (1 + 4) / 2, unweighted
    assert r.location_label == "Lat 40.71, Lon -74.01"
    assert Q.geo_hotspots_exact(m, 30, AS_OF).first().avg_resolution_hours == 2.0


def test_agency_trend_top_k_and_null_agency(spark):
    rows = [_req(i, "2026-01-10 10:00:00", agency=None) for i in range(5)]
    rows += [_req(10 + i, "2026-01-10 10:00:00", agency="A") for i in range(3)]
    rows += [_req(20 + i, "2025-12-10 10:00:00", agency="B") for i in range(2)]
    rows += [_req(30, "2024-01-10 10:00:00", agency="C")]  # outside the window
    m = _marts(spark, rows)
    got = [(r.agency, r.month, r.complaint_count) for r in Q.agency_trend(m, 1, AS_OF, limit=2).collect()]
    # NULL agency is the busiest and takes a slot, then matches nothing in the join
    assert got == [("A", dt.datetime(2026, 1, 1), 3)]
    got3 = Q.agency_trend(m, 2, AS_OF, limit=3).collect()  # window from 2025-12-01
    assert [(r.agency, r.month) for r in got3] == [("B", dt.datetime(2025, 12, 1)), ("A", dt.datetime(2026, 1, 1))]


def test_recent_filters_and_null_first(spark):
    m = _marts(spark, [
        _req(1, "2026-01-05 10:00:00", borough="Q", status="Open", agency="A"),
        _req(2, "2026-01-06 10:00:00", borough="Q", status="Closed", agency="A"),
        _req(3, "2026-01-07 10:00:00", borough="K", status="Open", agency="A"),
    ])
    assert [r.unique_key for r in Q.recent_requests(m, 10).collect()] == [3, 2, 1]
    assert [r.unique_key for r in Q.recent_requests(m, 10, borough="Q", status="Open").collect()] == [1]
    assert [r.unique_key for r in Q.recent_requests(m, 1, agency="A").collect()] == [3]
    assert Q.recent_requests(m, 10).columns == Q.RECENT_COLUMNS


def test_ingestion_status_thresholds(spark):
    now = ts("2026-02-01 00:00:00")
    meta = spark.createDataFrame([
        ("none", None, None, None),
        ("h24", None, None, now - dt.timedelta(hours=24)),
        ("s", None, None, now - dt.timedelta(hours=24, seconds=1)),
        ("s72", None, None, now - dt.timedelta(hours=72)),
        ("d", None, None, now - dt.timedelta(hours=72, seconds=1)),
    ], META_SCHEMA)
    got = {r.source_name: r.status for r in Q.ingestion_status(meta, now).collect()}
    assert got == {"none": "Unknown", "h24": "Healthy", "s": "Stale", "s72": "Stale", "d": "Delayed"}


def test_freshness(spark):
    now = ts("2026-02-01 00:00:00")
    for hours, status in ((24, "pass"), (25, "warn"), (49, "error")):
        raw = raw_rows(spark, [_req(1, (now - dt.timedelta(hours=hours)).isoformat(sep=" "))])
        assert D.freshness(raw, now).first().status == status


def test_display_time(spark):
    m = _marts(spark, [
        _req(1, "2026-01-05 15:04:00", closed_date=None),
        _req(2, "2026-07-05 09:30:00", closed_date=ts("2026-07-05 10:00:00")),
    ])
    got = {r.unique_key: (r.created_label, r.closed_label) for r in Q.display_times(m).collect()}
    assert got[1] == ("2026-01-05 03:04 PM EST", "Unavailable")
    assert got[2] == ("2026-07-05 09:30 AM EDT", "2026-07-05 10:00 AM EDT")


def test_coerce_timestamps(spark):
    df = spark.createDataFrame([("2026-01-05 10:00:00", "x"), ("nonsense", "y")], "t string, v string")
    got = [r.t for r in Q.to_timestamp_or_null(df, "t").collect()]
    assert got == [ts("2026-01-05 10:00:00"), None]


def test_heatmap_month_and_instant_close(spark):
    rows = [_req(1, "2026-01-05 10:00:00", latitude=40.7, longitude=-74.0, agency="DOB",
                 closed_date=ts("2026-01-05 10:00:00")),
            _req(2, "2026-01-06 10:00:00", latitude=40.7, longitude=-74.0, agency="NYPD",
                 closed_date=ts("2026-01-06 12:00:00"))]
    m = _marts(spark, rows)
    r = Q.heatmap_by_month(m).collect()
    assert [(x.year, x.month, x.total_complaints, x.avg_resolution_hours) for x in r] == [(2026, 1, 2, 1.0)]
    ic = Q.instant_close_by_agency(m).collect()
    assert [(x.agency, x.instant_close_count) for x in ic] == [("DOB", 1)]
    assert [r.unique_key for r in Q.latest_inspection(m, 1).collect()] == [2]


def test_data_tests_pass_and_fail(spark):
    good = _marts(spark, [_req(1, "2026-01-05 10:00:00", agency="A", agency_name="Alpha", complaint_type="T",
                               borough="B", latitude=40.7, longitude=-74.0)])
    bad = _marts(spark, [
        _req(1, "2026-01-05 10:00:00", agency="A", agency_name="Alpha", complaint_type="T", borough=None),
        _req(2, "2026-01-05 10:00:00", agency="A", agency_name="Alpha 2", complaint_type=None, borough="B"),
    ])
    for m, expect_fail in ((good, set()), (bad, {
            ("not_null", "stg_requests", "complaint_type"), ("not_null", "dim_complaint_type", "complaint_type"),
            ("not_null", "fct_daily", "borough"), ("not_null", "fct_daily", "complaint_type"),
            ("unique", "dim_agency", "agency")})):
        reports = D.run_all(m, ts("2026-01-05 12:00:00"))
        failed = set()
        for name in ("not_null", "unique", "accepted_values", "unique_combination"):
            failed |= {(r.test, r.model, r.column_name) for r in reports[name].where(F.col("status") == "fail").collect()}
        assert failed == expect_fail
    assert D.not_null_report(D.models_of(good)).count() == 18
    assert D.unique_report(D.models_of(good)).count() == 5
    assert D.unique_failures(bad.dim_agency, "agency").first().n_records == 2
    assert D.accepted_values_failures(good.fct, "resolution_bucket", ["x"]).count() == 1
    assert D.unique_combination_failures(bad.dim_complaint_type, ["complaint_type", "complaint_subtype"]).count() == 0


def test_display_time_repeated_autumn_hour(spark):
    m = _marts(spark, [_req(1, "2026-11-01 01:30:00"), _req(2, "2026-11-01 02:30:00"),
                       _req(3, "2026-11-01 00:30:00")])
    got = {r.unique_key: r.created_label for r in Q.display_times(m).collect()}
    assert got == {1: "2026-11-01 01:30 AM EDT", 2: "2026-11-01 02:30 AM EST", 3: "2026-11-01 12:30 AM EDT"}


def test_results_do_not_depend_on_the_session_zone(spark):
    """Wall-clock times in a daylight-saving gap of the session zone keep their meaning."""
    from civicflow.sources import extract as S
    rows = [_req(1, "2001-03-28 18:00:00", closed_date=ts("2001-04-01 02:05:45")),   # 02:05 does not exist in LA
            _req(2, "2001-04-01 02:30:00", closed_date=ts("2001-04-01 03:10:00")),
            _req(3, "2001-04-01 03:10:00")]
    m = _marts(spark, rows)

    def snapshot():
        hours = sorted((r.unique_key, r.resolution_hours) for r in m.fct.collect())
        labels = sorted(tuple(r) for r in Q.display_times(m).collect())
        first = [r.unique_key for r in S.bounded_first_rows(m.raw, 2, slack=1).orderBy(*S.asc_order()).collect()]
        return hours, labels, first

    base = snapshot()
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert snapshot() == base
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert base[0][0][1] == (3 * 24 + 8 + 5 / 60 + 45 / 3600)
    assert base[2] == [1, 2]


def test_bounded_recent_equals_full_scan(spark):
    m = M.from_testdata(spark, "/root/testdata/sf0.001")
    for kw in ({}, {"borough": "EUROPE"}, {"agency": "NATION_3"}, {"status": "F"},
               {"borough": "ASIA", "agency": "NATION_8"}):
        for limit in (1, 7, 100, 5000):
            a = [tuple(r) for r in Q.recent_requests(m, limit, **kw).collect()]
            b = [tuple(r) for r in Q.recent_requests(m, limit, bounded=False, **kw).collect()]
            assert a == b, (kw, limit)
    assert [tuple(r) for r in Q.latest_inspection(m, 50).collect()] == [
        tuple(r) for r in m.fct.select("unique_key", "closed_at", "created_at", "agency")
        .orderBy(F.col("created_at").desc_nulls_first(), F.col("unique_key").desc()).limit(50).collect()]


def test_overview_with_a_watermark_log_row(spark, tmpdir_path):
    from civicflow.operators.load import WatermarkLog
    log = WatermarkLog(tmpdir_path + "/wm")
    log.append_values(spark, "service_requests", ts("2026-01-06 10:00:00"), 2, ts("2026-01-07 00:00:00"))
    log.append_values(spark, "other_feed", ts("2027-01-01 00:00:00"), 9, ts("2027-01-02 00:00:00"))
    m = _marts(spark, [_req(1, "2026-01-05 10:00:00", agency="A", complaint_type="T", borough="B"),
                       _req(2, "2026-01-06 10:00:00", agency="A", complaint_type="T", borough="B")],
               meta=log.read(spark))
    r = Q.overview(m).collect()
    assert len(r) == 1
    assert (r[0].last_ingestion_at, r[0].ingestion_watermark) == (ts("2026-01-07 00:00:00"), ts("2026-01-06 10:00:00"))
    assert r[0].avg_resolution_hours is None  # no closed request
    status = {x.source_name: x.status for x in Q.ingestion_status(log.read(spark), ts("2026-01-08 00:00:00")).collect()}
    assert status == {"service_requests": "Healthy", "other_feed": "Healthy"}  # exactly 24 h is still healthy
