"""Operational questions over the marts (overview, trends, top lists, hotspots, ...).

Parameters that the dashboards took from the clock (``current_date``,
``now()``) are arguments here (``as_of``, ``now``). Every ``order``/``limit``
has a full tie-break so a top-k is the same on every run and every engine.
No function collects: each returns a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (
    as_ntz,
    cell_label,
    days_before,
    display_local,
    hours_between,
    mean_hours,
    mean_us,
    months_before_month_start,
)
from ..schema import (
    AGENCY_LIMIT,
    HEATMAP_LIMIT,
    HEATMAP_MONTH_LIMIT,
    INSPECTION_LIMIT,
    SOURCE_NAME,
    STATUS_DELAYED,
    STATUS_HEALTHY,
    STATUS_LIMITS_HOURS,
    STATUS_STALE,
    STATUS_UNKNOWN,
    TOP_TYPES_LIMIT,
)
from .marts import Marts


def _recent_days(df: DataFrame, as_of, days: int) -> DataFrame:
    """``created_date >= as_of - days`` (inclusive: days + 1 calendar days)."""
    return df.where(F.col("created_date") >= days_before(as_of, days))


# --------------------------------------------------------------------------- Q1

def overview(m: Marts, source: str = SOURCE_NAME) -> DataFrame:
    """One row: totals, distinct types/agencies/boroughs, newest request, mean hours,
    and the source's watermark row (NULLs when there is none).

    Answered from the aggregates, not the fact: they hold every request
    (count = sum of counts, distinct values = distinct group keys, the mean is
    rebuilt from exact microsecond sums), and are orders of magnitude smaller.
    The other one-row parts are scalar subqueries, so no join is planned.
    """
    by_day = m.daily.agg(F.struct(
        F.countDistinct("complaint_type").cast("long").alias("types"),
        F.countDistinct("borough").cast("long").alias("boroughs"))).scalar()
    if m.meta is None:
        ingested_at = watermark = F.lit(None).cast("timestamp_ntz")
    else:
        # at most one row per source: its value, or NULL without one (a left join on TRUE)
        mine = m.meta.where(F.col("source_name") == source)
        ingested_at = mine.agg(F.max("updated_at")).scalar()
        watermark = mine.agg(F.max("last_created_date")).scalar()
    stats = m.agency_perf.agg(
        F.sum("complaint_count").cast("long").alias("total_records"),
        F.countDistinct("agency").cast("long").alias("agencies"),
        F.max("latest_created_at").alias("latest_created_at"),
        mean_hours(F.sum("resolution_us_sum"), F.sum("closed_count")).alias("avg_resolution_hours"),
    )
    return stats.select(
        "total_records",
        by_day.getField("types").alias("complaint_types"),
        "agencies",
        by_day.getField("boroughs").alias("boroughs"),
        "latest_created_at",
        "avg_resolution_hours",
        ingested_at.alias("last_ingestion_at"),
        watermark.alias("ingestion_watermark"),
    )


def _mean_of_means():
    """Plain mean of the groups' means (each at microsecond resolution), in hours."""
    mu = mean_us("resolution_us_sum", "closed_count")
    return mean_hours(F.sum(mu), F.count(mu))


# --------------------------------------------------------------------------- Q2

def daily_trends(m: Marts, days: int, as_of) -> DataFrame:
    """Requests per (day, borough) over the trailing window; date asc, count desc."""
    return (_recent_days(m.daily, as_of, days)
            .groupBy("created_date", "borough")
            .agg(F.sum("complaint_count").cast("long").alias("complaint_count"))
            .orderBy(F.col("created_date").asc(), F.col("complaint_count").desc(),
                     F.col("borough").asc_nulls_last()))


# --------------------------------------------------------------------------- Q3

def top_complaint_types(m: Marts, days: int, as_of, limit: int = TOP_TYPES_LIMIT) -> DataFrame:
    """Top types by count, with the count-weighted mean of the daily means.

    The weight is each group's full count (open requests included), divided by
    the counts of groups that have a mean; all-open types get NULL.
    """
    n = F.col("complaint_count")
    mu = mean_us("resolution_us_sum", "closed_count")  # the daily mean, in whole microseconds
    weighted = mean_hours(F.sum(n.cast("decimal(38,0)") * F.coalesce(mu, F.lit(0))),
                          F.sum(F.when(mu.isNotNull(), n).otherwise(F.lit(0))))
    return (_recent_days(m.daily, as_of, days)
            .groupBy("complaint_type")
            .agg(F.sum(n).cast("long").alias("complaint_count"), weighted.alias("avg_resolution_hours"))
            .orderBy(F.col("complaint_count").desc(), F.col("complaint_type").asc_nulls_last())
            .limit(int(limit)))


def top_complaint_types_exact(m: Marts, days: int, as_of, limit: int = TOP_TYPES_LIMIT) -> DataFrame:
    """Same ranking; the mean is the true mean over closed requests (exact sums)."""
    return (_recent_days(m.daily, as_of, days)
            .groupBy("complaint_type")
            .agg(F.sum("complaint_count").cast("long").alias("complaint_count"),
                 mean_hours(F.sum("resolution_us_sum"), F.sum("closed_count")).alias("avg_resolution_hours"))
            .orderBy(F.col("complaint_count").desc(), F.col("complaint_type").asc_nulls_last())
            .limit(int(limit)))


# --------------------------------------------------------------------------- Q4 / Q4a

def geo_hotspots(m: Marts, days: int, as_of, limit: int = HEATMAP_LIMIT) -> DataFrame:
    """Busiest grid cells in the window; the mean is the plain mean of daily means."""
    agg = (_recent_days(m.geo, as_of, days)
           .groupBy(F.col("latitude_rounded").alias("latitude"), F.col("longitude_rounded").alias("longitude"))
           .agg(F.sum("complaint_count").cast("long").alias("complaint_count"),
                _mean_of_means().alias("avg_resolution_hours")))
    return (agg.orderBy(F.col("complaint_count").desc(), "latitude", "longitude").limit(int(limit))
            .withColumn("location_label", cell_label("latitude", "longitude")))


def geo_hotspots_exact(m: Marts, days: int, as_of, limit: int = HEATMAP_LIMIT) -> DataFrame:
    """Same cells; the mean over closed requests instead of the mean of means."""
    agg = (_recent_days(m.geo, as_of, days)
           .groupBy(F.col("latitude_rounded").alias("latitude"), F.col("longitude_rounded").alias("longitude"))
           .agg(F.sum("complaint_count").cast("long").alias("complaint_count"),
                mean_hours(F.sum("resolution_us_sum"), F.sum("closed_count")).alias("avg_resolution_hours")))
    return (agg.orderBy(F.col("complaint_count").desc(), "latitude", "longitude").limit(int(limit))
            .withColumn("location_label", cell_label("latitude", "longitude")))


# --------------------------------------------------------------------------- Q5

def agency_trend(m: Marts, months: int, as_of, limit: int = AGENCY_LIMIT) -> DataFrame:
    """Monthly rows of the ``limit`` busiest agencies in the window.

    The ranking is a top-k (at most ``limit`` rows), so the join back is a
    broadcast of a proven-small side; a NULL agency may take a slot and then
    matches nothing, as in the inner join it mirrors.
    """
    recent = m.agency_perf.where(F.col("month") >= months_before_month_start(as_of, months)).select(
        "agency", "month", "complaint_count", "avg_resolution_hours")
    ranked = (recent.groupBy("agency").agg(F.sum("complaint_count").alias("total_complaints"))
              .orderBy(F.col("total_complaints").desc(), F.col("agency").asc_nulls_last())
              .limit(int(limit)).select("agency"))
    return (recent.join(F.broadcast(ranked), "agency")
            .select("agency", "month", "complaint_count", "avg_resolution_hours")
            .orderBy(F.col("month").asc(), F.col("complaint_count").desc(), F.col("agency").asc()))


# --------------------------------------------------------------------------- Q6

def _non_blank(c: str):
    return F.col(c).isNotNull() & (F.col(c) != "")


def borough_options(m: Marts) -> DataFrame:
    return m.dim_borough.where(_non_blank("borough")).select("borough").orderBy("borough")


def status_options(m: Marts) -> DataFrame:
    return m.fct.select("status").where(_non_blank("status")).distinct().orderBy("status")


def agency_options(m: Marts) -> DataFrame:
    """From the agency dimension as stored: a code with two names is listed twice."""
    return m.dim_agency.where(_non_blank("agency")).select("agency").orderBy("agency")


# --------------------------------------------------------------------------- Q7

RECENT_COLUMNS = ["unique_key", "created_at", "closed_at", "borough", "agency",
                  "complaint_type", "status", "resolution_hours"]


def _newest_floor(m: Marts, limit: int, borough: str | None, agency: str | None):
    """Scalar subquery: the latest day (or month) D such that at least ``limit`` matching
    requests were created on or after D, from the aggregates (the earliest possible
    time when fewer exist). None when no aggregate carries the filters (no bound)."""
    if agency and not borough:
        src, key = m.agency_perf.where(F.col("agency") == F.lit(agency)), "month"
    elif not agency:
        src, key = m.daily, "created_date"
        if borough:
            src = src.where(F.col("borough") == F.lit(borough))
    else:
        return None
    per = src.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum("complaint_count").alias("n"))
    newest_first = Window.orderBy(F.col(key).desc()).rowsBetween(Window.unboundedPreceding, 0)
    cum = per.withColumn("running", F.sum("n").over(newest_first))
    oldest = F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")
    return cum.where(F.col("running") >= int(limit)).agg(F.coalesce(F.max(key), oldest)).scalar()


def recent_requests(m: Marts, limit: int, borough: str | None = None, status: str | None = None,
                    agency: str | None = None, bounded: bool = True) -> DataFrame:
    """Newest requests, optionally filtered by equality on borough/status/agency (ANDed).

    Requests without a creation time sort first (descending order, NULLs first).
    With ``bounded``, the aggregates give the oldest day (or month) that can
    still hold one of the newest ``limit`` rows; that bound is a scalar
    subquery pushed into the fact scan, so only the newest files are read.
    """
    df = m.fct
    for name, value in (("borough", borough), ("status", status), ("agency", agency)):
        if value:
            df = df.where(F.col(name) == F.lit(value))
    floor = _newest_floor(m, limit, borough, agency) if bounded and not status else None
    if floor is not None:  # a plain comparison, so the scan evaluates the subquery and skips files
        df = df.where(F.col("created_date") >= floor).unionByName(
            df.where(F.col("created_date").isNull()))
    return (df.select(*RECENT_COLUMNS)
            .orderBy(F.col("created_at").desc_nulls_first(), F.col("unique_key").desc())
            .limit(int(limit)))


# --------------------------------------------------------------------------- Q8

def heatmap_by_month(m: Marts, limit: int = HEATMAP_MONTH_LIMIT) -> DataFrame:
    """Daily cells joined to the calendar, rolled up to (year, month, cell).

    The calendar has a fixed number of days, so it is broadcast.
    """
    cal = m.dim_date.select(F.col("date_day").cast("timestamp_ntz").alias("created_date"), "year", "month")
    j = m.geo.join(F.broadcast(cal), "created_date")
    return (j.groupBy("year", "month", "latitude_rounded", "longitude_rounded")
            .agg(F.sum("complaint_count").cast("long").alias("total_complaints"),
                 _mean_of_means().alias("avg_resolution_hours"))
            .orderBy("month", "year", "latitude_rounded", "longitude_rounded")
            .limit(int(limit)))


# --------------------------------------------------------------------------- Q9 / Q9a

def latest_inspection(m: Marts, limit: int = INSPECTION_LIMIT) -> DataFrame:
    """Key, closing, creation and agency of the newest requests (scan bounded as in Q7)."""
    return (recent_requests(m, limit)
            .select("unique_key", "closed_at", "created_at", "agency"))


def instant_close_by_agency(m: Marts) -> DataFrame:
    """Agencies with requests closed at the instant they were created."""
    return (m.fct.groupBy("agency")
            .agg(F.count_if(F.col("is_instant_close")).alias("instant_close_count"),
                 F.count(F.lit(1)).alias("complaint_count"))
            .where(F.col("instant_close_count") > 0))


# --------------------------------------------------------------------------- Q10 / Q11

def ingestion_status(meta: DataFrame, now) -> DataFrame:
    """Per source: age of the last load and a status label."""
    age_h = hours_between(F.col("updated_at"), as_ntz(now))
    healthy, stale = STATUS_LIMITS_HOURS
    status = (F.when(F.col("updated_at").isNull(), F.lit(STATUS_UNKNOWN))
              .when(age_h <= healthy, F.lit(STATUS_HEALTHY))
              .when(age_h <= stale, F.lit(STATUS_STALE))
              .otherwise(F.lit(STATUS_DELAYED)))
    return meta.select("source_name", "updated_at", age_h.alias("age_hours"), status.alias("status"))


def display_times(m: Marts) -> DataFrame:
    """Creation and closing time of every request as local display text."""
    return m.fct.select("unique_key", display_local("created_at").alias("created_label"),
                        display_local("closed_at").alias("closed_label"))


def to_timestamp_or_null(df: DataFrame, *cols: str) -> DataFrame:
    """Coerce text columns to timestamps; unparseable values become NULL."""
    return df.select(*[F.col(c).try_cast("timestamp_ntz").alias(c) if c in cols else F.col(c) for c in df.columns])

