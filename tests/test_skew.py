"""A third of all rows on one key / one group: results stay exact (brute force in Python)."""

import datetime as dt

from conftest import raw_rows

from civicflow.operators.normalize import batch_dedupe
from civicflow.plans import marts as M
from civicflow.plans import models
from civicflow.plans import queries as Q

BASE = dt.datetime(2026, 1, 5, 10)


def _rows():
    rows = []
    for i in range(600):
        hot = i % 3 == 0  # every third row: the same key, day, borough and type
        rows.append({
            "unique_key": 7 if hot else 1000 + i,
            "created_date": BASE if hot else BASE + dt.timedelta(hours=i),
            "closed_date": (BASE if hot else BASE + dt.timedelta(hours=i)) + dt.timedelta(minutes=i),
            "status": f"s{i:04d}", "borough": "HOT" if hot else f"B{i % 5}", "complaint_type": "T",
            "agency": "A" if hot else f"A{i % 7}",
        })
    return rows


def test_hot_key_dedupe_keeps_one_greatest_row(spark):
    rows = _rows()
    out = {r.unique_key: r for r in batch_dedupe(raw_rows(spark, rows)).collect()}
    assert len(out) == 401
    hot = [r for r in rows if r["unique_key"] == 7]
    best = max(hot, key=lambda r: (r["created_date"], r["closed_date"]))
    assert out[7].closed_date == best["closed_date"] and out[7].status == best["status"]


def test_hot_group_aggregates_are_exact(spark):
    rows = [dict(r, unique_key=i) for i, r in enumerate(_rows())]  # 200 distinct requests in one group
    m = M.derive(spark, raw_rows(spark, rows))
    daily = {(r.created_date, r.borough): r for r in models.daily(m.fct).collect()}
    hot = daily[(dt.datetime(2026, 1, 5), "HOT")]
    hot_minutes = [i for i in range(600) if i % 3 == 0]
    assert hot.complaint_count == 200 and hot.closed_count == 200
    assert int(hot.resolution_us_sum) == sum(hot_minutes) * 60_000_000
    assert sum(r.complaint_count for r in daily.values()) == 600
    sets = models.split_aggregates(models.aggregate_sets(m.fct))
    assert sorted(map(tuple, sets["daily"].collect()), key=repr) == sorted(
        map(tuple, models.daily(m.fct).collect()), key=repr)
    ov = Q.overview(m).first()
    assert ov.total_records == 600 and ov.boroughs == 6 and ov.agencies == 8
    assert ov.avg_resolution_hours == sum(range(600)) * 60_000_000 / (3.6e9 * 600)
