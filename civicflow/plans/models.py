"""Warehouse models: staging, enriched, fact, dimensions, calendar, aggregates.

Each model is a function DataFrame -> DataFrame. Staging and enriched are
views (lazy; Catalyst collapses the projections), the rest are materialised by
``plans.marts``. Aggregates carry, besides the mean, the exact parts it is
made of (``closed_count``, ``resolution_us_sum``) so roll-ups stay exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import day_start, grid, hours_between, mean_hours, micros_between, month_start, us_sum
from ..schema import (
    BUCKET_1_3_DAYS,
    BUCKET_LIMITS_HOURS,
    BUCKET_OVER_3_DAYS,
    BUCKET_UNDER_24H,
    CALENDAR_END,
    CALENDAR_START,
)

FACT_COLUMNS = [
    "unique_key", "created_at", "closed_at", "created_date", "is_instant_close",
    "borough", "agency", "complaint_type", "status",
    "resolution_hours", "resolution_bucket",
    "has_location_data", "latitude", "longitude", "latitude_rounded", "longitude_rounded",
]


# --------------------------------------------------------------------------- staging (T1-T4)

def staging(raw: DataFrame) -> DataFrame:
    """Rename, cast coordinates to double, derive resolution hours, require a key."""
    return raw.where(F.col("unique_key").isNotNull()).select(
        F.col("unique_key"),
        F.col("created_date").alias("created_at"),
        F.col("closed_date").alias("closed_at"),
        F.col("due_date").alias("due_at"),
        F.col("agency"),
        F.col("agency_name"),
        F.col("complaint_type"),
        F.col("descriptor").alias("complaint_subtype"),
        F.col("descriptor_2"),
        F.col("borough"),
        F.col("incident_zip").alias("zip_code"),
        F.col("city"),
        F.col("status"),
        F.col("resolution_description"),
        F.col("resolution_action_updated_date").alias("resolution_updated_at"),
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        F.col("council_district"),
        F.col("police_precinct"),
        F.col("community_board"),
        F.col("open_data_channel_type").alias("submission_channel"),
        hours_between("created_date", "closed_date").alias("resolution_hours"),
    )


# --------------------------------------------------------------------------- enriched (E1-E5)

def resolution_bucket(hours: Column) -> Column:
    """<= 24 h, <= 72 h, else (NULL i.e. still open, falls to the last bucket)."""
    lo, hi = BUCKET_LIMITS_HOURS
    return (F.when(hours <= lo, F.lit(BUCKET_UNDER_24H))
            .when(hours <= hi, F.lit(BUCKET_1_3_DAYS))
            .otherwise(F.lit(BUCKET_OVER_3_DAYS)))


def enriched(stg: DataFrame) -> DataFrame:
    closed, created = F.col("closed_at"), F.col("created_at")
    return stg.select(
        "*",
        resolution_bucket(F.col("resolution_hours")).alias("resolution_bucket"),
        (closed.isNotNull() & (closed == created)).alias("is_instant_close"),
        day_start(created).alias("created_date"),
        (F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).alias("has_location_data"),
        grid("latitude").alias("latitude_rounded"),
        grid("longitude").alias("longitude_rounded"),
    )


# --------------------------------------------------------------------------- fact (F1)

def fact(enr: DataFrame) -> DataFrame:
    return enr.select(*FACT_COLUMNS)


def fact_from_raw(raw: DataFrame) -> DataFrame:
    return fact(enriched(staging(raw)))


# --------------------------------------------------------------------------- dimensions (M1-M3)

def dim_agency(stg: DataFrame) -> DataFrame:
    """Distinct (code, name) pairs; a code with two names appears twice."""
    return stg.select("agency", "agency_name").distinct()


def dim_borough(stg: DataFrame) -> DataFrame:
    return stg.select("borough").where(F.col("borough").isNotNull()).distinct()


def dim_complaint_type(stg: DataFrame) -> DataFrame:
    return stg.select("complaint_type", "complaint_subtype").distinct()


# --------------------------------------------------------------------------- calendar (M4-M5)

def _pad9(c: Column) -> Column:
    return F.rpad(c, 9, " ")


def calendar_columns(d: Column) -> list[Column]:
    """The 16 calendar attributes of a DATE column (besides the date itself)."""
    dow = F.dayofweek(d) - 1  # 0 = Sunday
    return [
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        _pad9(F.date_format(d, "MMMM")).alias("month_name"),
        F.date_format(d, "MMM").alias("month_abbrev"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofyear(d).alias("day_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        dow.cast("int").alias("day_of_week"),
        _pad9(F.date_format(d, "EEEE")).alias("day_name"),
        F.date_format(d, "EEE").alias("day_abbrev"),
        dow.isin(0, 6).alias("is_weekend"),
        (d == F.trunc(d, "month")).alias("is_month_start"),
        (d == F.last_day(d)).alias("is_month_end"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.format_string("%04d-%02d", F.extract(F.lit("YEAROFWEEK"), d), F.weekofyear(d)).alias("iso_year_week"),
    ]


def date_spine(spark: SparkSession, start=CALENDAR_START, end=CALENDAR_END) -> DataFrame:
    """One row per day, both ends inclusive (a few thousand rows: generated, not read)."""
    n_days = (end - start).days + 1
    return spark.range(n_days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_day"))


def dim_date(spark: SparkSession, start=CALENDAR_START, end=CALENDAR_END) -> DataFrame:
    spine = date_spine(spark, start, end)
    return spine.select("date_day", *calendar_columns(F.col("date_day")))


# --------------------------------------------------------------------------- aggregates (A1-A3)

def _measures(extra: list[Column] | None = None) -> list[Column]:
    """count(*), mean hours over closed requests, and its exact parts."""
    us = micros_between("created_at", "closed_at")
    parts = [
        F.count(F.lit(1)).alias("complaint_count"),
        F.count(us).alias("closed_count"),
        us_sum(us).alias("resolution_us_sum"),
    ]
    return parts + (extra or [])


def _finish(df: DataFrame, keys: list[str], extra: list[str] | None = None) -> DataFrame:
    return df.select(*keys, "complaint_count",
                     mean_hours("resolution_us_sum", "closed_count").alias("avg_resolution_hours"),
                     "closed_count", "resolution_us_sum", *(extra or []))


def daily(fct: DataFrame) -> DataFrame:
    """Per (day, borough, type). Partial aggregation runs in each task before the shuffle."""
    keys = ["created_date", "borough", "complaint_type"]
    return _finish(fct.groupBy(*keys).agg(*_measures()), keys)


def geo_heatmap(fct: DataFrame) -> DataFrame:
    """Per (day, grid cell), located requests only."""
    keys = ["created_date", "latitude_rounded", "longitude_rounded"]
    return _finish(fct.where(F.col("has_location_data")).groupBy(*keys).agg(*_measures()), keys)


def agency_performance(fct: DataFrame) -> DataFrame:
    """Per (agency, month); also the newest creation time (lets the overview skip the fact)."""
    agg = (fct.groupBy(F.col("agency"), month_start("created_at").alias("month"))
           .agg(*_measures([F.max("created_at").alias("latest_created_at")])))
    return _finish(agg, ["agency", "month"], ["latest_created_at"])


# --------------------------------------------------------------------------- one-pass builds

def _set_id(columns: list[str], grouped: tuple[str, ...]) -> int:
    """grouping_id() of a grouping set: a 1 bit for every column not grouped (first column = high bit)."""
    n = len(columns)
    return sum(1 << (n - 1 - i) for i, c in enumerate(columns) if c not in grouped)


_AGG_COLS = ["created_date", "borough", "complaint_type", "latitude_rounded", "longitude_rounded",
             "has_location_data", "agency", "month"]
_AGG_SETS = {
    "daily": ("created_date", "borough", "complaint_type"),
    "geo": ("created_date", "latitude_rounded", "longitude_rounded", "has_location_data"),
    "agency_perf": ("agency", "month"),
}


def aggregate_sets(fct: DataFrame) -> DataFrame:
    """The three aggregates' groups from one scan of the fact (GROUPING SETS).

    Each task pre-aggregates all three groupings before the single shuffle, so
    the fact is read once instead of three times. Split with ``split_aggregates``.
    """
    base = fct.select(*[c for c in _AGG_COLS if c != "month"], month_start("created_at").alias("month"),
                      "created_at", "closed_at")
    return (base.groupingSets([list(s) for s in _AGG_SETS.values()], *_AGG_COLS)
            .agg(F.grouping_id().alias("set_id"), *_measures([F.max("created_at").alias("latest_created_at")])))


def split_aggregates(sets: DataFrame) -> dict[str, DataFrame]:
    """daily / geo / agency_perf tables from ``aggregate_sets`` (same columns as the separate builds)."""
    sid = {name: _set_id(_AGG_COLS, grouped) for name, grouped in _AGG_SETS.items()}
    daily_t = sets.where(F.col("set_id") == sid["daily"])
    geo_t = sets.where((F.col("set_id") == sid["geo"]) & F.col("has_location_data"))
    agency_t = sets.where(F.col("set_id") == sid["agency_perf"])
    return {
        "daily": _finish(daily_t, list(_AGG_SETS["daily"])),
        "geo": _finish(geo_t, ["created_date", "latitude_rounded", "longitude_rounded"]),
        "agency_perf": _finish(agency_t, ["agency", "month"], ["latest_created_at"]),
    }


_DIM_COLS = ["agency", "agency_name", "borough", "complaint_type", "complaint_subtype"]
_DIM_SETS = {
    "dim_agency": ("agency", "agency_name"),
    "dim_borough": ("borough",),
    "dim_complaint_type": ("complaint_type", "complaint_subtype"),
}


def dimension_sets(stg: DataFrame, by: str | None = None) -> DataFrame:
    """The distinct values of all three dimensions from one scan of staging
    (per value of ``by`` as well, when given: e.g. per creation month)."""
    cols = ([by] if by else []) + _DIM_COLS
    sets = [([by] if by else []) + list(s) for s in _DIM_SETS.values()]
    return stg.groupingSets(sets, *cols).agg(F.grouping_id().alias("set_id"))


def split_dimensions(sets: DataFrame, by: str | None = None) -> dict[str, DataFrame]:
    cols = ([by] if by else []) + _DIM_COLS
    out = {}
    for name, grouped in _DIM_SETS.items():
        keep = ([by] if by else []) + list(grouped)
        t = sets.where(F.col("set_id") == _set_id(cols, tuple(keep))).select(*keep)
        out[name] = t.where(F.col("borough").isNotNull()) if name == "dim_borough" else t
    return out
