"""The warehouse as a set of DataFrames: derived lazily, or materialised and read back.

Staging and enriched stay views (lazy). The fact, the dimensions, the calendar
and the three aggregates are tables: written once per build so that queries
read small pre-aggregated tables instead of re-deriving them from raw.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ..operators.load import watermark_after
from ..schema import CALENDAR_END, CALENDAR_START, RAW_SCHEMA
from ..operators.normalize import conform
from ..session import path_exists
from ..sources import testdata
from ..sources.tables import read_table, table_path, write_table
from . import models

# Tables written by a build: name -> (layer, partition columns).
MATERIALISED = {
    "fct": ("marts", None),
    "dim_agency": ("marts", None),
    "dim_borough": ("marts", None),
    "dim_complaint_type": ("marts", None),
    "dim_date": ("marts", None),
    "daily": ("marts", None),
    "geo": ("marts", None),
    "agency_perf": ("marts", None),
}


@dataclass(frozen=True)
class Marts:
    raw: DataFrame
    meta: DataFrame | None
    stg: DataFrame
    fct: DataFrame
    dim_agency: DataFrame
    dim_borough: DataFrame
    dim_complaint_type: DataFrame
    dim_date: DataFrame
    daily: DataFrame
    geo: DataFrame
    agency_perf: DataFrame


def derive(spark: SparkSession, raw: DataFrame, meta: DataFrame | None = None,
           calendar: tuple[_dt.date, _dt.date] = (CALENDAR_START, CALENDAR_END)) -> Marts:
    """Every model as a lazy DataFrame over ``raw``."""
    stg = models.staging(raw)
    fct = models.fact(models.enriched(stg))
    return Marts(
        raw=raw, meta=meta, stg=stg, fct=fct,
        dim_agency=models.dim_agency(stg),
        dim_borough=models.dim_borough(stg),
        dim_complaint_type=models.dim_complaint_type(stg),
        dim_date=models.dim_date(spark, *calendar),
        daily=models.daily(fct),
        geo=models.geo_heatmap(fct),
        agency_perf=models.agency_performance(fct),
    )


def materialize(spark: SparkSession, marts: Marts, root: str, by_month: bool = False) -> Marts:
    """Write the table models under ``root`` and return marts that read them back.

    ``by_month`` writes the month layout instead (see ``refresh_months``).

    Raw is read twice in all: once for the fact (a projection, no shuffle) and
    once for the three dimensions together (grouping sets). The three
    aggregates come from one scan of the written fact (grouping sets), are
    written once as a combined table, then split. Aggregates are range-sorted
    by day so trailing-window filters skip files by their min/max statistics.
    """
    if by_month:
        _write_months(spark, marts.raw, root, months=None)
        write_table(marts.dim_date, table_path(root, "marts", "dim_date"))
        return load(spark, root, marts.raw, marts.meta)

    def path(name: str) -> str:
        return table_path(root, MATERIALISED.get(name, ("marts", None))[0], name)

    write_table(marts.fct.sortWithinPartitions("created_date"), path("fct"))  # tight day ranges per row group
    fct = read_table(spark, path("fct"))

    write_table(models.dimension_sets(marts.stg), table_path(root, "staging", "dimension_sets"))
    dims = models.split_dimensions(read_table(spark, table_path(root, "staging", "dimension_sets")))
    write_table(models.aggregate_sets(fct), table_path(root, "staging", "aggregate_sets"))
    aggs = models.split_aggregates(read_table(spark, table_path(root, "staging", "aggregate_sets")))

    built = {**dims, "dim_date": marts.dim_date,
             "daily": aggs["daily"].orderBy("created_date"),
             "geo": aggs["geo"].orderBy("created_date"),
             "agency_perf": aggs["agency_perf"].orderBy("month")}
    out = {"fct": fct}
    for name, df in built.items():
        write_table(df, path(name), partition_by=MATERIALISED[name][1])
        out[name] = read_table(spark, path(name))
    return replace(marts, **out)


def load(spark: SparkSession, root: str, raw: DataFrame, meta: DataFrame | None = None) -> Marts:
    """Marts as written by ``materialize`` under ``root`` (staging stays a view over ``raw``).

    In the month layout the month column is dropped, and dimensions are the
    distinct values over their per-month sets.
    """
    tables = {}
    empty = None
    for name, (layer, _) in MATERIALISED.items():
        if not path_exists(spark, table_path(root, layer, name)):
            raise FileNotFoundError(f"no table {name} under {root}: build the warehouse first")
        try:
            df = read_table(spark, table_path(root, layer, name))
        except AnalysisException:  # written empty in the month layout: no files to infer from
            empty = empty or derive(spark, spark.createDataFrame([], RAW_SCHEMA))
            df = getattr(empty, name)
        if MONTH in df.columns:
            df = df.drop(MONTH)
            if name.startswith("dim_"):
                df = df.distinct()
        tables[name] = df
    return Marts(raw=raw, meta=meta, stg=models.staging(raw), **tables)


# --------------------------------------------------------------------------- month layout

MONTH = "created_month"


def _month_of(c):
    return F.trunc(F.to_date(c), "month")


def months_between(first, last) -> list[_dt.date]:
    """First days of every month from ``first``'s month to ``last``'s month."""
    y, m = first.year, first.month
    out = []
    while (y, m) <= (last.year, last.month):
        out.append(_dt.date(y, m, 1))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def _write_months(spark: SparkSession, raw: DataFrame, root: str, months: list | None) -> None:
    """Build fact, aggregates and per-month dimension sets for ``months`` (None: all)
    from ``raw`` and write them partitioned by creation month. With a month list,
    only those month directories are replaced (dynamic partition overwrite). Raw is
    read once for the fact and once for the three dimensions' sets together."""
    created = F.col("created_date")
    part = raw
    if months is not None:
        dated = sorted(m for m in months if m is not None)
        keep = F.lit(False)
        if dated:
            hi = F.add_months(F.lit(dated[-1]), 1).cast("timestamp_ntz")
            keep = (created >= F.lit(dated[0]).cast("timestamp_ntz")) & (created < hi) & _month_of(created).isin(
                *dated)  # the range reaches the scan; the list keeps only the named months
        if None in months:
            keep = keep | created.isNull()
        part = raw.where(keep)

    schemas = {}

    def write(df: DataFrame, layer: str, name: str) -> None:
        # rebalance: few files a month, and a large month is split over tasks; a full build replaces every month
        order = [MONTH, *(c for c in df.columns if c == "created_date")]
        w = df.hint("rebalance", MONTH).sortWithinPartitions(*order).write.mode("overwrite").partitionBy(MONTH)
        w = w.option("partitionOverwriteMode", "static" if months is None else "dynamic")
        w.parquet(table_path(root, layer, name))
        schemas[name] = df.schema

    def read_back(layer: str, name: str) -> DataFrame:
        try:
            df = read_table(spark, table_path(root, layer, name))
        except AnalysisException:  # nothing written yet
            return spark.createDataFrame([], schemas[name])
        if months is None:
            return df
        dated = [m for m in months if m is not None]
        sel = F.col(MONTH).isin(*dated) if dated else F.lit(False)
        return df.where(sel | F.col(MONTH).isNull() if None in months else sel)

    stg = models.staging(part)
    fct = models.fact(models.enriched(stg)).withColumn(MONTH, _month_of("created_date"))
    write(fct, "marts", "fct")
    fct_w = read_back("marts", "fct").drop(MONTH)

    write(models.dimension_sets(stg.withColumn(MONTH, _month_of("created_at")), by=MONTH), "staging", "dimension_sets")
    dim_sets = read_back("staging", "dimension_sets").withColumn(MONTH, F.col(MONTH).cast("date"))  # undated months alone have no type
    for name, df in models.split_dimensions(dim_sets, by=MONTH).items():
        write(df, "marts", name)

    sets = models.aggregate_sets(fct_w)
    sets = sets.withColumn(MONTH, F.coalesce(_month_of("created_date"), F.to_date("month")))
    write(sets, "staging", "aggregate_sets")
    split = models.split_aggregates(read_back("staging", "aggregate_sets").drop(MONTH))
    write(split["daily"].withColumn(MONTH, _month_of("created_date")), "marts", "daily")
    write(split["geo"].withColumn(MONTH, _month_of("created_date")), "marts", "geo")
    write(split["agency_perf"].withColumn(MONTH, F.to_date("month")), "marts", "agency_perf")


def refresh_months(spark: SparkSession, root: str, raw: DataFrame, months: list,
                   meta: DataFrame | None = None) -> Marts:
    """Recompute the month-layout marts for ``months`` only (``None`` in the list: rows
    without a creation time) from ``raw``, replacing just those month directories.

    Raw is insert-only and every table row belongs to one creation month, so
    rebuilding the months a load touched gives the same tables as a full
    rebuild; running it again changes nothing.
    """
    _write_months(spark, raw, root, months)
    return load(spark, root, raw, meta)


# The testdata requests are created 1995-2001; its calendar starts early enough to cover them.
TESTDATA_CALENDAR = (_dt.date(1990, 1, 1), CALENDAR_END)


def from_testdata(spark: SparkSession, sf_dir: str, now: _dt.datetime | None = None) -> Marts:
    """Marts over the request view of the driver testdata.

    The watermark table is the state after loading all of raw at ``now``.
    """
    raw = conform(testdata.requests(spark, sf_dir))
    meta = watermark_after(spark, raw, now=now)
    return derive(spark, raw, meta, calendar=TESTDATA_CALENDAR)


def names() -> list[str]:
    return [f.name for f in fields(Marts)]
