"""Declared data tests as Spark jobs.

``*_failures`` return the failing rows (empty = pass); ``*_report`` return one
row per declared test: (test, model, column_name, failures, status). NULL checks
for all columns of a model run in a single aggregate pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_ntz, hours_between
from ..schema import BUCKET_LABELS, CREATED, FRESHNESS_ERROR_HOURS, FRESHNESS_WARN_HOURS

# ---------------------------------------------------------------------------
# The declared tests (model -> columns).
# ---------------------------------------------------------------------------
NOT_NULL = {
    "stg_requests": ["unique_key", "created_at", "agency", "complaint_type"],
    "fct_requests": ["unique_key", "created_at"],
    "dim_borough": ["borough"],
    "dim_agency": ["agency"],
    "dim_complaint_type": ["complaint_type"],
    "dim_date": ["date_day"],
    "fct_geo_heatmap": ["created_date", "latitude_rounded", "longitude_rounded"],
    "fct_daily": ["created_date", "borough", "complaint_type"],
    "fct_agency_performance": ["agency", "month"],
}
UNIQUE = {
    "stg_requests": ["unique_key"],
    "fct_requests": ["unique_key"],
    "dim_borough": ["borough"],
    "dim_agency": ["agency"],
    "dim_date": ["date_day"],
}
ACCEPTED_VALUES = {("int_requests_enriched", "resolution_bucket"): BUCKET_LABELS}
UNIQUE_COMBINATION = {"dim_complaint_type": ["complaint_type", "complaint_subtype"]}

REPORT_SCHEMA = "test string, model string, column_name string, failures bigint, status string"


def _status(failures):
    return F.when(failures > 0, F.lit("fail")).otherwise(F.lit("pass"))


def _report(test: str, model: str, column: str, failures) -> list:
    return [F.lit(test).alias("test"), F.lit(model).alias("model"), F.lit(column).alias("column_name"),
            failures.cast("long").alias("failures"), _status(failures).alias("status")]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --------------------------------------------------------------------------- D1

def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def not_null_report(models: dict[str, DataFrame], tests: dict[str, list[str]] = NOT_NULL) -> DataFrame:
    """One scan per model counts the NULLs of all its tested columns at once."""
    frames = []
    for model, cols in tests.items():
        counts = models[model].agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
        stacked = counts.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("c"), F.col(f"n{i}").alias("n")) for i, c in enumerate(cols)])).alias("t"))
        frames.append(stacked.select(F.lit("not_null").alias("test"), F.lit(model).alias("model"),
                                     F.col("t.c").alias("column_name"),
                                     F.col("t.n").cast("long").alias("failures"),
                                     _status(F.col("t.n")).alias("status")))
    return _union(frames)


# --------------------------------------------------------------------------- D2

def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once (NULLs are not tested)."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def unique_report(models: dict[str, DataFrame], tests: dict[str, list[str]] = UNIQUE) -> DataFrame:
    frames = []
    for model, cols in tests.items():
        for c in cols:
            n = unique_failures(models[model], c).agg(F.count(F.lit(1)).alias("n"))
            frames.append(n.select(*_report("unique", model, c, F.col("n"))))
    return _union(frames)


# --------------------------------------------------------------------------- D3

def accepted_values_failures(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Non-NULL values outside the list."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def accepted_values_report(models: dict[str, DataFrame], tests=ACCEPTED_VALUES) -> DataFrame:
    frames = []
    for (model, c), values in tests.items():
        n = models[model].agg(F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*values)).alias("n"))
        frames.append(n.select(*_report("accepted_values", model, c, F.col("n"))))
    return _union(frames)


# --------------------------------------------------------------------------- D4

def unique_combination_failures(df: DataFrame, columns: list[str]) -> DataFrame:
    """Combinations that occur more than once (NULL is a value here, as in GROUP BY)."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def unique_combination_report(models: dict[str, DataFrame], tests=UNIQUE_COMBINATION) -> DataFrame:
    frames = []
    for model, cols in tests.items():
        n = unique_combination_failures(models[model], cols).agg(F.count(F.lit(1)).alias("n"))
        frames.append(n.select(*_report("unique_combination", model, ",".join(cols), F.col("n"))))
    return _union(frames)


# --------------------------------------------------------------------------- D5

def freshness(raw: DataFrame, now, loaded_at: str = CREATED,
              warn_hours: int = FRESHNESS_WARN_HOURS, error_hours: int = FRESHNESS_ERROR_HOURS) -> DataFrame:
    """Newest ``loaded_at`` against ``now``: pass, warn (> warn_hours) or error (> error_hours)."""
    latest = raw.agg(F.max(loaded_at).alias("max_loaded_at"))
    age = hours_between(F.col("max_loaded_at"), as_ntz(now))
    status = (F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
              .when(age > error_hours, F.lit("error"))
              .when(age > warn_hours, F.lit("warn"))
              .otherwise(F.lit("pass")))
    return latest.select("max_loaded_at", age.alias("age_hours"), status.alias("status"))


def models_of(marts) -> dict[str, DataFrame]:
    """The tested models of a ``Marts``."""
    from ..plans import models as mdl
    return {
        "stg_requests": marts.stg,
        "int_requests_enriched": mdl.enriched(marts.stg),
        "fct_requests": marts.fct,
        "dim_borough": marts.dim_borough,
        "dim_agency": marts.dim_agency,
        "dim_complaint_type": marts.dim_complaint_type,
        "dim_date": marts.dim_date,
        "fct_geo_heatmap": marts.geo,
        "fct_daily": marts.daily,
        "fct_agency_performance": marts.agency_perf,
    }


def run_all(marts, now) -> dict[str, DataFrame]:
    models = models_of(marts)
    return {
        "not_null": not_null_report(models),
        "unique": unique_report(models),
        "accepted_values": accepted_values_report(models),
        "unique_combination": unique_combination_report(models),
        "freshness": freshness(marts.raw, now),
    }
