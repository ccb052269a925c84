import datetime as dt
from decimal import Decimal

from conftest import raw_rows, ts
from pyspark.sql import functions as F

from civicflow.plans import marts as M
from civicflow.plans import models


def _fact(spark, rows):
    return models.fact_from_raw(raw_rows(spark, rows))


def test_durations_buckets_and_flags(spark):
    c = "2026-01-05 10:00:00"
    rows = [
        {"unique_key": 1, "created_date": ts(c)},                                         # open
        {"unique_key": 2, "created_date": ts(c), "closed_date": ts("2026-01-06 10:00:00")},  # exactly 24 h
        {"unique_key": 3, "created_date": ts(c), "closed_date": ts("2026-01-06 10:00:00.000001")},
        {"unique_key": 4, "created_date": ts(c), "closed_date": ts("2026-01-08 10:00:00")},  # exactly 72 h
        {"unique_key": 5, "created_date": ts(c), "closed_date": ts("2026-01-08 10:00:00.000001")},
        {"unique_key": 6, "created_date": ts(c), "closed_date": ts("2026-01-05 09:00:00")},  # -1 h
        {"unique_key": 7, "created_date": ts(c), "closed_date": ts(c)},                      # instant
        {"unique_key": 8, "created_date": ts("2026-03-08 01:30:00"), "closed_date": ts("2026-03-08 03:30:00")},
        {"unique_key": None, "created_date": ts(c)},                                      # no key: dropped
    ]
    got = {r.unique_key: r for r in _fact(spark, rows).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6, 7, 8}
    assert got[1].resolution_hours is None and got[1].resolution_bucket == "over_3_days"
    assert got[2].resolution_hours == 24.0 and got[2].resolution_bucket == "under_24h"
    assert got[3].resolution_bucket == "1-3_days"
    assert got[4].resolution_bucket == "1-3_days"
    assert got[5].resolution_bucket == "over_3_days"
    assert got[6].resolution_hours == -1.0 and got[6].resolution_bucket == "under_24h"
    assert got[7].is_instant_close is True and got[7].resolution_hours == 0.0
    assert got[1].is_instant_close is False
    assert got[8].resolution_hours == 2.0  # zone-less: no DST hour lost
    assert got[8].created_date == dt.datetime(2026, 3, 8)


def test_grid_rounding_half_away_from_zero(spark):
    rows = [
        {"unique_key": 1, "created_date": ts("2026-01-01 00:00:00"), "latitude": 40.705, "longitude": -74.005},
        {"unique_key": 2, "created_date": ts("2026-01-01 00:00:00"), "latitude": 1.005, "longitude": None},
    ]
    got = {r.unique_key: r for r in _fact(spark, rows).collect()}
    assert got[1].latitude_rounded == Decimal("40.71")
    assert got[1].longitude_rounded == Decimal("-74.01")
    assert got[1].has_location_data is True
    assert got[2].latitude_rounded == Decimal("1.01")
    assert got[2].has_location_data is False


def test_grid_of_doubles_equals_grid_of_digits(spark):
    from civicflow.functions.measures import _grid_of_digits, grid
    near = [s * (n + h) / 100 for n in (0, 1, 99, 4070, 7400, 99_999) for h in (0.5, 0.4999999, 0.5000001, 0.25, 0.0) for s in (1, -1)]
    values = [*near, 40.705, -74.005, 1.005, 40.70499999999999, 40.70500000000001, 0.0, -0.0, 1e-9, 999.994, 999.995, 1000.005, 123456.785, None]
    df = spark.createDataFrame([(x,) for x in values], "x double").select(grid("x").alias("a"), _grid_of_digits(F.col("x")).alias("b"))
    assert df.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0
    assert df.schema["a"].dataType == df.schema["b"].dataType


def test_aggregates_count_open_and_average_closed(spark):
    c = ts("2026-01-05 10:00:00")
    rows = [
        {"unique_key": 1, "created_date": c, "borough": "B", "complaint_type": "T", "agency": "A",
         "latitude": 40.7, "longitude": -74.0},
        {"unique_key": 2, "created_date": c, "closed_date": ts("2026-01-05 12:00:00"), "borough": "B",
         "complaint_type": "T", "agency": "A", "latitude": 40.7, "longitude": -74.0},
        {"unique_key": 3, "created_date": c, "closed_date": ts("2026-01-05 14:00:00"), "borough": None,
         "complaint_type": "T", "agency": "A", "latitude": None, "longitude": -74.0},
    ]
    fct = _fact(spark, rows)
    d = {(r.borough): r for r in models.daily(fct).collect()}
    assert d["B"].complaint_count == 2 and d["B"].avg_resolution_hours == 2.0 and d["B"].closed_count == 1
    assert d[None].complaint_count == 1 and d[None].avg_resolution_hours == 4.0
    g = models.geo_heatmap(fct).collect()
    assert len(g) == 1 and g[0].complaint_count == 2
    a = models.agency_performance(fct).collect()
    assert len(a) == 1 and a[0].month == dt.datetime(2026, 1, 1) and a[0].avg_resolution_hours == 3.0
    assert a[0].latest_created_at == c


def test_dimensions(spark):
    c = ts("2026-01-05 10:00:00")
    rows = [
        {"unique_key": 1, "created_date": c, "agency": "A", "agency_name": "Alpha", "borough": "B",
         "complaint_type": "T", "descriptor": "x"},
        {"unique_key": 2, "created_date": c, "agency": "A", "agency_name": "Alpha (old)", "borough": None,
         "complaint_type": "T", "descriptor": None},
        {"unique_key": 3, "created_date": c, "agency": "A", "agency_name": "Alpha", "borough": "B",
         "complaint_type": "T", "descriptor": None},
    ]
    m = M.derive(spark, raw_rows(spark, rows))
    assert m.dim_agency.count() == 2  # two names for one code
    assert [r.borough for r in m.dim_borough.collect()] == ["B"]
    assert m.dim_complaint_type.count() == 2


def test_calendar_edges(spark):
    cal = models.dim_date(spark)
    assert cal.count() == 9496
    want = {
        dt.date(2016, 1, 1): (53, 5, "Friday   ", "2015-53", False, True, False),
        dt.date(2021, 1, 3): (53, 0, "Sunday   ", "2020-53", True, False, False),
        dt.date(2024, 2, 29): (9, 4, "Thursday ", "2024-09", False, False, True),
        dt.date(2026, 5, 3): (18, 0, "Sunday   ", "2026-18", True, False, False),
        dt.date(2027, 1, 1): (53, 5, "Friday   ", "2026-53", False, True, False),
    }
    rows = cal.where(F.col("date_day").isin(list(want))).collect()
    assert len(rows) == 5
    for r in rows:
        assert (r.week_of_year, r.day_of_week, r.day_name, r.iso_year_week, r.is_weekend,
                r.is_month_start, r.is_month_end) == want[r.date_day]
    may = cal.where(F.col("date_day") == dt.date(2026, 5, 3)).first()
    assert may.month_name == "May      " and may.month_abbrev == "May" and may.year_month == "2026-05"
    assert may.quarter == 2 and may.day_of_year == 123


def test_testdata_profile(spark):
    m = M.from_testdata(spark, "/root/testdata/sf0.001")
    fct = m.fct
    assert fct.count() == 1500
    assert fct.where("closed_at is null").count() == 514
    assert fct.where("is_instant_close").count() == 92
    assert fct.where("borough is null").count() == 30
    assert m.dim_agency.count() == 37
    buckets = {r[0]: r[1] for r in fct.groupBy("resolution_bucket").count().collect()}
    assert buckets == {"under_24h": 275, "1-3_days": 348, "over_3_days": 877}
    # roll-up of the daily aggregate equals the fact
    assert m.daily.agg(F.sum("complaint_count")).first()[0] == 1500


def _same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    cols = sorted(a.columns)
    assert sorted(map(tuple, a.select(*cols).collect()), key=repr) == sorted(
        map(tuple, b.select(*cols).collect()), key=repr)


def test_one_pass_builds_equal_separate_builds(spark):
    m = M.from_testdata(spark, "/root/testdata/sf0.001")
    aggs = models.split_aggregates(models.aggregate_sets(m.fct))
    _same(aggs["daily"], m.daily)
    _same(aggs["geo"], m.geo)
    _same(aggs["agency_perf"], m.agency_perf)
    dims = models.split_dimensions(models.dimension_sets(m.stg))
    _same(dims["dim_agency"], m.dim_agency)
    _same(dims["dim_borough"], m.dim_borough)
    _same(dims["dim_complaint_type"], m.dim_complaint_type)


def test_materialized_marts_equal_lazy(spark, tmpdir_path):
    m = M.from_testdata(spark, "/root/testdata/sf0.001")
    w = M.materialize(spark, m, "file://" + tmpdir_path)
    for name in ("fct", "daily", "geo", "agency_perf", "dim_agency", "dim_borough", "dim_complaint_type"):
        _same(getattr(w, name), getattr(m, name))
    assert w.dim_date.count() == m.dim_date.count()


def test_month_layout_reads_raw_once_for_all_dimensions(spark, tmpdir_path):
    """A build by months takes two passes over raw: the fact's, and one for the sets of the three dimensions."""
    rows = [{"unique_key": i, "created_date": ts(f"2001-0{1 + i % 3}-05 10:00:00") if i else None, "agency": f"A{i % 2}", "borough": "B"}
            for i in range(12)]
    raw, read = raw_rows(spark, rows).coalesce(1), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    m = M.derive(spark, raw.mapInArrow(counted, raw.schema), calendar=M.TESTDATA_CALENDAR)
    built = M.materialize(spark, m, "file://" + tmpdir_path, by_month=True)
    assert read.value == 2 * len(rows)
    for name in ("dim_agency", "dim_borough", "dim_complaint_type"):
        _same(getattr(built, name), getattr(M.derive(spark, raw), name))


def test_refresh_reads_raw_once_for_all_dimensions(spark, tmpdir_path):
    rows = [{"unique_key": i, "created_date": ts(f"2001-0{1 + i % 3}-05 10:00:00"), "agency": f"A{i % 2}", "borough": f"B{i % 3}"} for i in range(12)]
    raw, read = raw_rows(spark, rows).coalesce(1), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    old = raw.where("month(created_date) < 3")
    M.materialize(spark, M.derive(spark, old, calendar=M.TESTDATA_CALENDAR), "file://" + tmpdir_path, by_month=True)
    built = M.refresh_months(spark, "file://" + tmpdir_path, raw.mapInArrow(counted, raw.schema), [dt.date(2001, 3, 1)])
    assert read.value == 2 * len(rows)  # before the filter by month
    _same(built.dim_borough, M.derive(spark, raw).dim_borough)


def test_stored_requests_read_as_the_whole_contract(spark):
    """The stored raw of the registered warehouse holds the filled columns only, and reads as the contract's rows."""
    import __spark_entry__ as E
    from civicflow.schema import RAW_SCHEMA
    sf = "/root/testdata/sf0.001"
    built = E._built(spark, sf, "monthly").raw
    assert built.columns == RAW_SCHEMA.names
    assert spark.read.parquet(E._BUILT[(spark.sparkContext.applicationId, sf, "monthly")][0] + "/raw").columns == M.testdata.PRESENT_COLUMNS
    _same(built, E._raw(spark, sf))


def test_month_layout_and_refresh_equal_full_builds(spark, tmpdir_path):
    from conftest import raw_rows, ts
    base = M.from_testdata(spark, "/root/testdata/sf0.001")
    root = "file://" + tmpdir_path
    flat = M.materialize(spark, base, root + "/flat")
    monthly = M.materialize(spark, base, root + "/monthly", by_month=True)
    names = ("fct", "daily", "geo", "agency_perf", "dim_agency", "dim_borough", "dim_complaint_type")
    for name in names:
        _same(getattr(monthly, name), getattr(flat, name))
    # new rows in two months (one already present, one new), one undated, a new agency name
    extra = raw_rows(spark, [
        {"unique_key": 900001, "created_date": ts("2001-07-15 10:00:00"), "closed_date": ts("2001-07-16 10:00:00"),
         "agency": "NATION_1", "agency_name": "Agency renamed", "borough": "ASIA", "complaint_type": "BUILDING",
         "latitude": 40.7, "longitude": -74.0},
        {"unique_key": 900002, "created_date": ts("2002-02-01 00:00:00"), "agency": "NEW", "complaint_type": "NEW"},
        {"unique_key": 900003, "created_date": None, "agency": "NATION_1"},
    ])
    raw2 = base.raw.unionByName(extra)
    months = M.months_between(dt.date(2001, 7, 15), dt.date(2002, 2, 1)) + [None]
    full = M.derive(spark, raw2, calendar=M.TESTDATA_CALENDAR)
    refreshed = M.refresh_months(spark, root + "/monthly", raw2, months)
    for name in names:
        _same(getattr(refreshed, name), getattr(full, name))
    again = M.refresh_months(spark, root + "/monthly", raw2, months)  # idempotent
    for name in names:
        _same(getattr(again, name), getattr(full, name))
    assert len(M.months_between(dt.date(2001, 11, 3), dt.date(2002, 2, 1))) == 4
