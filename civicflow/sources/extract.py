"""Incremental extraction over a request table (keyset paging on (created, key)).

Filters and sorts over a DataFrame; predicates reach the Parquet scan as pushed
filters, and the implied ``created >= d`` lets row-group min/max statistics
prune before the OR predicate is evaluated. Functions are lazy, but for pages
and newest-N cuts of more than ``SMALL_PAGE`` rows: those run histogram jobs
while the DataFrame is built. A watermark's predicate holds only for dated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import as_ntz, epoch_micros
from ..schema import CREATED, KEY



def asc_order() -> list[Column]:
    return [F.col(CREATED).asc_nulls_last(), F.col(KEY).asc_nulls_last()]


def desc_order() -> list[Column]:
    return [F.col(CREATED).desc_nulls_last(), F.col(KEY).desc_nulls_last()]


def after(last_created, last_key=None, inclusive_date: bool = False) -> Column:
    """Keyset predicate.

    * both given: ``created > d OR (created = d AND key > k)``
    * date only: ``created >= d`` (inclusive)
    * neither: TRUE (start from the oldest row)
    """
    c, k = F.col(CREATED), F.col(KEY)
    if last_created is None:
        return F.lit(True)
    d = as_ntz(last_created)
    if last_key is None or inclusive_date:
        return c >= d
    return (c >= d) & ((c > d) | ((c == d) & (k > F.lit(int(last_key)))))


# Pages up to this size use a plain top-k (each task keeps ``limit`` rows, one task merges them).
SMALL_PAGE = 2_000


def keyset_page(df: DataFrame, limit: int, last_created=None, last_key=None,
                where: Column | None = None, order: list[Column] | None = None,
                columns: list[str] | None = None) -> DataFrame:
    """Next page after the watermark, ordered (created, key) ascending, at most ``limit`` rows.

    ``where``/``order``/``columns`` override the filter, order and selection
    like the API override parameters; the watermark predicate is still
    applied. Pages larger than ``SMALL_PAGE`` in the default order are cut by
    ``bounded_first_rows``.
    """
    out = df.where(after(last_created, last_key))
    if where is not None:
        out = out.where(where)
    if order is None and int(limit) > SMALL_PAGE:
        page = bounded_first_rows(out, int(limit)).orderBy(*asc_order())
    else:
        page = out.orderBy(*(order or asc_order())).limit(int(limit))
    return page.select(*columns) if columns else page


def _levels() -> list[Column]:
    """Buckets that follow the (created, key) order ever more finely: day, hour, second,
    microsecond of creation, then key ranges (2^40, 2^20, single keys)."""
    us = epoch_micros(CREATED)
    k = F.col(KEY)
    out = [us - F.pmod(us, F.lit(w)) for w in (86_400_000_000, 3_600_000_000, 1_000_000, 1)]
    return out + [k - F.pmod(k, F.lit(w)) for w in (1 << 40, 1 << 20, 1)]


# Bucket of rows without a key: after every key, in either direction.
_NO_KEY = (1 << 63) - 1


def _order(descending: bool, nulls_first: bool) -> list[Column]:
    c, k = F.col(CREATED), F.col(KEY)
    if not descending:
        return [c.asc_nulls_first() if nulls_first else c.asc_nulls_last(), k.asc_nulls_last()]
    return [c.desc_nulls_first() if nulls_first else c.desc_nulls_last(), k.desc_nulls_last()]


def bounded_first_rows(df: DataFrame, limit: int, descending: bool = False, nulls_first: bool = False,
                       slack: int = 4) -> DataFrame:
    """The first ``limit`` rows of ``df`` in (created, key) order, with a bounded merge.

    A plain top-k lets every task keep ``limit`` rows and merges them all in
    one task. Here a histogram finds the bucket where the running count reaches
    the rows still needed; every row before it is taken whole, and only that
    boundary bucket is refined (day -> ... -> single key) until it holds at most
    ``slack`` times the rows still needed, where a top-k finishes. Only
    histograms reach the driver; a hot day or instant just takes more levels.
    Rows without a creation time come last (or first with ``nulls_first``), by key;
    rows without a key come last within their instant. The running count of a
    histogram is one window over its buckets (at most about 10**6 of them).
    """
    sign = -1 if descending else 1
    order = _order(descending, nulls_first)
    need = int(limit)
    pieces: list[DataFrame] = []
    by_time = [lvl * sign for lvl in _levels()[:4]]
    by_key = [F.coalesce(lvl * sign, F.lit(_NO_KEY)) for lvl in _levels()[4:]]
    dated = (df.where(F.col(CREATED).isNotNull()), by_time + by_key)
    undated = (df.where(F.col(CREATED).isNull()), by_key)
    for part, levels in ((undated, dated) if nulls_first else (dated, undated)):
        region = part
        for i, lvl in enumerate(levels):
            if need <= 0:
                break
            hist = region.groupBy(lvl.alias("b")).agg(F.count(F.lit(1)).alias("n"))
            running = hist.withColumn("cum", F.sum("n").over(
                Window.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)))
            cut = running.where(F.col("cum") >= need).orderBy("b").limit(1).collect()
            if not cut:  # fewer rows than needed: all of them
                pieces.append(region)
                need -= int(running.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
                break
            b, n_b, cum = cut[0]["b"], int(cut[0]["n"]), int(cut[0]["cum"])
            pieces.append(region.where(lvl < F.lit(b)))
            need -= cum - n_b
            region = region.where(lvl == F.lit(b))
            if n_b <= slack * need or i == len(levels) - 1:
                pieces.append(region.orderBy(*order).limit(need))
                need = 0
                break
    out = pieces[0] if pieces else df.limit(0)
    for p in pieces[1:]:
        out = out.unionByName(p)
    return out


def keyset_ties(df: DataFrame, limit: int, last_created, last_key) -> DataFrame:
    """Rows at exactly the watermark date with a larger key (the tie-break part of a page)."""
    c, k = F.col(CREATED), F.col(KEY)
    d = as_ntz(last_created)
    return df.where((c == d) & (k > F.lit(int(last_key)))).orderBy(*asc_order()).limit(int(limit))


def since_date(df: DataFrame, limit: int, start) -> DataFrame:
    """Date-only resume: ``created >= start``, oldest first."""
    return keyset_page(df, limit, start, None)


def latest_n(df: DataFrame, n: int) -> DataFrame:
    """Newest ``n`` rows by (created desc, key desc); large ``n`` uses the bounded cut."""
    if int(n) > SMALL_PAGE:
        return bounded_first_rows(df, int(n), descending=True).orderBy(*desc_order())
    return df.orderBy(*desc_order()).limit(int(n))


def key_lookup(df: DataFrame, key: int, limit: int | None = None) -> DataFrame:
    """Rows with the given key (a point lookup; at most ``limit`` when given)."""
    out = df.where(F.col(KEY) == F.lit(int(key)))
    return out.limit(int(limit)) if limit is not None else out


def sample(df: DataFrame, size: int) -> DataFrame:
    """Any ``size`` rows (no order), as the sample download does."""
    return df.limit(int(size))


def write_sample(df: DataFrame, out_dir: str, size: int | None = None, key: int | None = None) -> None:
    """The sample download: ``size`` rows (or those with ``key``) as CSV, as landed and normalised.

    The key is compared as text, since a landed key need not be a number.
    """
    from .files import write_sample_copies

    rows = df if key is None else df.where(F.col(KEY).cast("string") == str(int(key)))
    write_sample_copies(rows, out_dir, size)
