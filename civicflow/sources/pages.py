"""Page planning for keyset extraction: all page boundaries from one histogram.

The page loop's cost should follow the data, not pages times data. ``plan_pages``
counts the remaining rows once per hour of creation; hours with more rows than a
page are counted again by second, microsecond and key range, and only they are
read for that. Neighbouring buckets are joined into chunks before anything
reaches the driver, so what it holds grows with the number of pages. A page is a
closed range of (created, key) that reaches the scan as a filter.

``ordered_pages`` cuts pages of exactly the page size instead, by one distributed
sort of (created, key). Pages of either kind can be loaded many at a time:
``joined_where`` reads them by as few ranges as they make, and
``first_page_rows`` keeps what loading them one after the other would.
"""

from __future__ import annotations

import datetime as _dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import as_ntz, epoch_micros
from ..schema import CREATED, KEY
from .extract import after

#: Bucket widths after the hour: second and microsecond of creation, then key ranges.
_TIME_WIDTHS = (3_600_000_000, 1_000_000, 1)
_NTZ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_EPOCH = _dt.datetime(1970, 1, 1)
_KEY_WIDTHS = (1 << 40, 1 << 20, 1 << 10, 1)

PLAN_SCHEMA = T.StructType([
    T.StructField("page", T.LongType(), False),
    T.StructField("after_created", T.TimestampNTZType(), True),
    T.StructField("after_key", T.LongType(), True),
    T.StructField("last_created", T.TimestampNTZType(), False),
    T.StructField("last_key", T.LongType(), False),
    T.StructField("rows", T.LongType(), False),
])


class Page(NamedTuple):
    """Rows after (after_created, after_key), or from the start, up to (last_created, last_key) included."""

    page: int
    after_created: _dt.datetime | None
    after_key: int | None
    last_created: _dt.datetime
    last_key: int
    rows: int

    def where(self) -> Column:
        c, k = F.col(CREATED), F.col(KEY)
        d = as_ntz(self.last_created)
        upper = (c <= d) & ((c < d) | (k <= F.lit(self.last_key)))
        return k.isNotNull() & upper & after(self.after_created, self.after_key)


def _bucket(value: Column, width: int) -> Column:
    return value - F.pmod(value, F.lit(width))


def _chunks(hist: DataFrame, half: int) -> DataFrame:
    """Neighbouring buckets (parent, b, n, last) joined to chunks of at most ``2 * half`` rows.

    A chunk holds the buckets that start within one stretch of ``half`` rows; a
    bucket of more rows than that stays alone, as the next starts in another
    stretch. The window's groups are the buckets of one parent bucket.
    """
    start = F.sum("n").over(Window.partitionBy("parent").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    placed = hist.withColumn("chunk", F.floor(start / half))
    alone = F.when(F.col("n") > half, F.col("b"))
    return placed.groupBy("parent", "chunk", alone.alias("alone")).agg(
        F.sum("n").alias("n"), F.max("last").alias("last"), F.min("b").alias("b"))


def plan_pages(rows: DataFrame, batch_size: int, last_created=None, last_key=None) -> list[Page]:
    """Pages of at most ``batch_size`` rows over everything after the watermark, in (created, key) order.

    Rows without a creation time or a key are in no page. Rows that share both
    (repeats of one key) stay in one page, which may then hold more rows. The
    source is scanned once, and buckets that hold more than a page once more a
    level.
    """
    half = max(1, int(batch_size) // 2)
    placed = rows.where(F.col(CREATED).isNotNull() & F.col(KEY).isNotNull()).where(after(last_created, last_key))
    region = placed.select(epoch_micros(CREATED).alias("us"), F.col(KEY).alias("k"), F.col(CREATED).alias("d"))
    last = F.max(F.struct("d", "k")).alias("last")
    levels = [_bucket(F.col("us"), w) for w in _TIME_WIDTHS] + [_bucket(F.col("k"), w) for w in _KEY_WIDTHS]
    leaves: list[tuple] = []
    parents = None  # values of the levels so far, of buckets with more rows than a page
    for i, level in enumerate(levels):
        named = region.withColumn("b", level)
        above = [x.alias(f"p{j}") for j, x in enumerate(levels[:i])]
        named = named.select("*", *above)
        path = [f"p{j}" for j in range(i)]
        if parents is not None:
            named = named.join(F.broadcast(parents), path, "left_semi")  # at most rows / batch_size of them
        hist = named.groupBy(*path, "b").agg(F.count(F.lit(1)).alias("n"), last)
        hist = hist.withColumn("parent", F.struct(*path) if path else F.lit(0))
        chunks = _chunks(hist, half).select("parent", "b", "n", "last").collect()  # about 4 x rows / batch_size, and one a parent
        deepest = i == len(levels) - 1
        large = [r for r in chunks if r["n"] > batch_size and not deepest]
        leaves += [(r["last"]["d"], r["last"]["k"], int(r["n"])) for r in chunks if r["n"] <= batch_size or deepest]
        if not large:
            break
        values = [(*(r["parent"] if path else ()), r["b"]) for r in large]
        first, final = min(v[0] for v in values), max(v[0] for v in values) + _TIME_WIDTHS[0]
        region = region.where((F.col("d") >= as_ntz(_EPOCH + _dt.timedelta(microseconds=first)))
                              & (F.col("d") < as_ntz(_EPOCH + _dt.timedelta(microseconds=final))))  # reaches the scan
        parents = rows.sparkSession.createDataFrame(values, ", ".join(f"p{j} long" for j in range(i + 1)))
    return _join_leaves(sorted(leaves), int(batch_size), last_created, last_key)


def _join_leaves(leaves: list[tuple], batch_size: int, last_created, last_key) -> list[Page]:
    pages: list[Page] = []
    at = (last_created, last_key)
    total, end = 0, None
    for d, k, n in [*leaves, (None, None, 0)]:
        if end is not None and (d is None or total + n > batch_size):
            pages.append(Page(len(pages), *at, *end, total))
            at, total = end, 0
        total, end = total + n, (d, k)
    return pages


def ordered_pages(rows: DataFrame, batch_size: int, last_created=None, last_key=None) -> list[Page]:
    """Pages of ``batch_size`` rows (the last may hold fewer) over everything after the watermark, in (created, key) order.

    Only the two columns are sorted, in ranges; a row's place is its place in
    its range and the rows of the ranges before. Rows that share both columns
    stay in one page. The driver holds one row a page and one a range.
    """
    placed = rows.where(F.col(CREATED).isNotNull() & F.col(KEY).isNotNull()).where(after(last_created, last_key))
    pair = placed.select(F.col(CREATED).alias("d"), F.col(KEY).alias("k")).repartitionByRange("d", "k").sortWithinPartitions("d", "k")
    held = pair.withColumn("id", F.monotonically_increasing_id()).persist()  # its ranges must be the same for both reads
    try:
        part, place = F.shiftright("id", 33), F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
        ranges = held.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("d", "k")).alias("last"))
        ranges = sorted(ranges.collect(), key=lambda r: r["part"])  # one row a range
        if not ranges:
            return []
        starts, total = [], 0
        for r in ranges:
            starts.append((r["part"], total))
            total += r["n"]
        first = F.broadcast(rows.sparkSession.createDataFrame(starts, "part long, start long"))
        ends = held.withColumn("part", part).join(first, "part").where((F.col("start") + place + 1) % int(batch_size) == 0)
        ends = [(r["d"], r["k"], r["n"]) for r in ends.select("d", "k", (F.col("start") + place + 1).alias("n")).orderBy("n").collect()]
    finally:
        held.unpersist()
    final = (ranges[-1]["last"]["d"], ranges[-1]["last"]["k"])
    if not ends or ends[-1][:2] != final:
        ends.append((*final, total))
    pages, at, before = [], (last_created, last_key), 0
    for i, (d, k, n) in enumerate(ends):
        if i + 1 < len(ends) and ends[i + 1][:2] == (d, k):  # the same row repeated over a page's end
            continue
        pages.append(Page(len(pages), *at, d, k, n - before))
        at, before = (d, k), n
    return pages


def joined_where(pages: list[Page]) -> Column:
    """Rows of any of ``pages`` (in order): neighbours make one range, and the span of all reaches the scan."""
    runs: list[Page] = []
    for p in pages:
        if runs and (runs[-1].last_created, runs[-1].last_key) == (p.after_created, p.after_key):
            runs[-1] = runs[-1]._replace(last_created=p.last_created, last_key=p.last_key, rows=runs[-1].rows + p.rows)
        else:
            runs.append(p)
    keep = F.lit(False)
    for run in runs:
        keep = keep | run.where()
    span = F.col(CREATED) <= as_ntz(pages[-1].last_created)
    if pages[0].after_created is not None:
        span = span & (F.col(CREATED) >= as_ntz(pages[0].after_created))
    return span & keep


def first_page_rows(rows: DataFrame, pages: list[Page]) -> DataFrame:
    """One row a key of the dated rows of ``pages`` (in order): that which ``batch_dedupe`` picks in the first page that has the key.

    So many pages loaded at once leave what the same pages leave when they are
    loaded one by one and a stored key stays. One aggregate, as ``batch_dedupe``.
    """
    ends = [(p.last_created, p.last_key) for p in pages[:-1]]
    table = rows.sparkSession.createDataFrame([(ends,)], "_ends array<struct<d:timestamp_ntz,k:bigint>>")
    at = F.struct(F.col(CREATED).alias("d"), F.col(KEY).cast("long").alias("k"))
    earlier = F.size(F.filter("_ends", lambda e: e < at))
    others = [CREATED, *(c for c in rows.columns if c not in (KEY, CREATED))]
    best = F.max(F.struct((-earlier).alias("_first"), *others)).alias("_row")
    numbered = rows.where(F.col(KEY).isNotNull()).crossJoin(F.broadcast(table))
    return numbered.groupBy(KEY).agg(best).select(*(c if c == KEY else F.col(f"_row.{c}").alias(c) for c in rows.columns))


def read_page(rows: DataFrame, page: Page) -> DataFrame:
    """The rows of one page (unordered; the range reaches the scan)."""
    return rows.where(page.where())


def publish_plan(spark: SparkSession, pages: list[Page], plan_dir: str) -> None:
    """Write the plan as one small file a page, in page order, for ``planned_stream``; a published plan is never rewritten."""
    if not pages:
        return
    plan = spark.createDataFrame([tuple(p) for p in pages], PLAN_SCHEMA)
    # one task writes them one after the other, as the stream takes files by their age
    plan.coalesce(1).sortWithinPartitions("page").write.mode("append").option("maxRecordsPerFile", 1).option(
        "timestampNTZFormat", _NTZ).json(plan_dir)


def planned_stream(spark: SparkSession, plan_dir: str, pages_per_batch: int = 1) -> DataFrame:
    """Structured Streaming source of planned pages: the checkpoint's offsets are pages, that is closed (created, key) ranges."""
    return spark.readStream.schema(PLAN_SCHEMA).option("maxFilesPerTrigger", int(pages_per_batch)).option(
        "timestampNTZFormat", _NTZ).json(plan_dir)
