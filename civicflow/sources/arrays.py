"""Splittable reading of JSON arrays: one large file is read by many tasks.

The text source is told that lines end with ``}``. It then splits a file by
bytes like any text, and every object ends at the end of such a line. What a
line lacks is its context: whether it starts inside a string, and how deep. Both
are prefix sums, so

1. each line is reduced to its quotes and brackets, with its change of depth for
   either start (outside or inside a string);
2. each block (the byte range of one task) is reduced to its quotes and its two
   changes of depth, and a window over the blocks of a file, a handful of rows
   each, gives every block its start;
3. a window over the lines of a block finds the ends of elements (depth one,
   outside strings), and the lines of an element are joined. Only the first and
   last piece of a block meet those of other blocks.

Column expressions only; the text is shuffled once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import LANDING_SCHEMA
from ..session import scratch_path

NOT_ARRAY = "not a JSON array"
NOT_OBJECT = "element is not a JSON object"
SEPARATOR = "\u001e"
_STRICT = {"allowSingleQuotes": "false"}  # an apostrophe starts no string: the scan knows double quotes only


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines that end with a closing brace, with their quotes mod 2 and change of depth when started outside (d0) or inside (d1) a string."""
    rows = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("file_bytes"), F.monotonically_increasing_id().alias("row"), "value")
    marks = F.regexp_replace(F.regexp_replace("value", r"(?s)\\.", ""), r'[^"{\[\]]', "")
    rows = rows.withColumn("parts", F.split(marks, '"', -1))

    def depth(odd: int):
        own = F.array_join(F.filter("parts", lambda x, i: i % 2 == odd), "")
        return F.length(own) - 2 * F.length(F.regexp_replace(own, r"[^\]]", ""))

    return rows.select("path", "block", "file_bytes", "row", "value", F.pmod(F.size("parts") - 1, F.lit(2)).alias("quotes"),
                       depth(0).alias("d0"), depth(1).alias("d1"))


_BEFORE = (Window.unboundedPreceding, -1)


def _started(lines: DataFrame, start) -> DataFrame:
    """``inside`` (a string) before and after each line of a block that starts in the state ``start``, and its change of depth."""
    order = Window.partitionBy("path", "block").orderBy("row")
    seen = F.coalesce(F.sum("quotes").over(order.rowsBetween(*_BEFORE)), F.lit(0))
    lines = lines.withColumn("inside", F.pmod(seen + start, F.lit(2)))
    lines = lines.withColumn("after", F.pmod(F.col("inside") + F.col("quotes"), F.lit(2)))
    return lines.withColumn("net", F.when(F.col("inside") == 0, F.col("d0")).otherwise(F.col("d1")) - (F.col("after") == 0).cast("int"))


def _ends(lines: DataFrame) -> DataFrame:
    """Lines joined to their block's start: ``ends`` marks the last line of an element, ``e`` counts the block's ends before."""
    order = Window.partitionBy("path", "block").orderBy("row")
    lines = _started(lines, F.col("start"))
    lines = lines.withColumn("depth", F.col("depth0") + F.sum("net").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    lines = lines.withColumn("ends", ((F.col("after") == 0) & (F.col("depth") == 1)).cast("long"))
    return lines.withColumn("e", F.coalesce(F.sum("ends").over(order.rowsBetween(*_BEFORE)), F.lit(0)))


@dataclass
class SplitArrays:
    """JSON-array files cut into elements: ``pieces`` holds (path, element, text), ``files`` what is known of each file.

    An element's text has the bracket or comma before it. The piece numbered
    ``elements`` of a file is what follows its last object.
    """

    pieces: DataFrame
    files: DataFrame

    def rows(self, schema: T.StructType = LANDING_SCHEMA) -> DataFrame:
        """The objects as rows of ``schema``; in files without problems these are ``read_json_array``'s, to the byte.

        The objects are written as lines that end with a record separator, which
        no JSON text holds unescaped, and read by the JSON source: unlike
        ``from_json`` it keeps nested values as they were written.
        """
        spark = self.pieces.sparkSession
        objects = self.pieces.join(self.files, "path").where(F.col("element") < F.col("elements"))
        at = scratch_path(spark, "array_objects")
        objects.select(F.regexp_replace("text", r"(?s)^[^{]*", "").alias("value")).write.option("lineSep", SEPARATOR).text(at)
        return spark.read.schema(schema).option("lineSep", SEPARATOR).json(at)

    def problems(self) -> DataFrame:
        """One row per file that is not a JSON array of objects: (path, problem), as ``json_array_problems`` reports.

        Stricter than that check in one thing, text after the array is a problem,
        and milder in one, a byte order mark is none. Neither sees files of no bytes.
        """
        of = self.pieces.join(self.files, "path")
        tail, first = F.col("element") == F.col("elements"), F.col("element") == 0
        body = F.regexp_replace("text", r"(?s)^\s*[\[,]", "")
        body = F.when(tail, F.regexp_replace(body, r"(?s)\]\s*$", "")).otherwise(body)
        parsed = F.from_json(F.concat(F.lit("["), body, F.lit("]")), "array<string>", _STRICT)
        opens = F.when(first, F.col("text").rlike(r"(?s)^\s*\[")).otherwise(F.col("text").rlike(r"(?s)^\s*,"))
        closes = F.col("text").rlike(r"(?s)\]\s*$")
        blank = F.trim(F.regexp_replace(body, r"\s", "")) == ""
        an_object = (F.size(parsed) == 1) & F.coalesce(F.ltrim(parsed[0]).startswith("{"), F.lit(False))
        last = (F.when(~first & F.col("text").rlike(r"^\s*\]\s*$"), F.lit(None))
                .when(~opens | ~closes | parsed.isNull(), F.lit(NOT_ARRAY))
                .when(blank, F.when(first, F.lit(None)).otherwise(F.lit(NOT_ARRAY)))
                .otherwise(F.lit(NOT_OBJECT)))
        inner = F.when(~opens | parsed.isNull(), F.lit(NOT_ARRAY)).when(~an_object, F.lit(NOT_OBJECT))
        found = of.select("path", F.when(tail, last).otherwise(inner).alias("problem"))
        found = found.groupBy("path").agg(F.max("problem").alias("problem"))  # "not a JSON array" goes before the other
        out = self.files.join(found, "path").select("path", F.when(~F.col("closed"), F.lit(NOT_ARRAY)).otherwise(F.col("problem")).alias("problem"))
        return out.where(F.col("problem").isNotNull())


_SPLIT = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")


def _store_lines(spark: SparkSession, path: str, to: str, split_bytes: int | None) -> None:
    before = {k: spark.conf.get(k) for k in _SPLIT}
    try:
        if split_bytes is not None:
            for k in _SPLIT:
                spark.conf.set(k, str(int(split_bytes)))
        _lines(spark, path).withColumn("bytes", F.octet_length("value")).write.parquet(to)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def split_json_arrays(spark: SparkSession, path: str, split_bytes: int | None = None) -> SplitArrays:
    """Cut the JSON-array files at ``path`` into their elements, each file by as many tasks as its bytes make splits.

    ``split_bytes`` is the size of a split, the session's if not given.

    The lines are stored once in the shared folder, as the blocks of two scans
    need not be the same. Strings are double-quoted, as JSON has it. An element
    is held whole by one task, a file is not.
    """
    base = scratch_path(spark, "arrays")
    _store_lines(spark, path, f"{base}/lines", split_bytes)
    lines = spark.read.parquet(f"{base}/lines")

    # blocks: their quotes and changes of depth for either start, then their starts by prefix sums
    outside = _started(lines.drop("value"), F.lit(0))
    inside = F.when(F.col("inside") == 0, F.col("d1")).otherwise(F.col("d0")) - (F.col("after") == 1).cast("int")
    blocks = outside.groupBy("path", "block").agg(
        F.pmod(F.sum("quotes"), F.lit(2)).alias("quotes"), F.sum("net").alias("out"), F.sum(inside).alias("in"),
        F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), F.max("file_bytes").alias("file_bytes"))
    order = Window.partitionBy("path").orderBy("block")
    blocks = blocks.withColumn("start", F.pmod(F.coalesce(F.sum("quotes").over(order.rowsBetween(*_BEFORE)), F.lit(0)), F.lit(2)))
    change = F.when(F.col("start") == 0, F.col("out")).otherwise(F.col("in"))
    blocks = blocks.withColumn("change", change)
    blocks = blocks.withColumn("depth0", F.coalesce(F.sum("change").over(order.rowsBetween(*_BEFORE)), F.lit(0)))
    blocks.write.parquet(f"{base}/blocks")
    blocks = spark.read.parquet(f"{base}/blocks")

    starts = blocks.select("path", "block", "start", "depth0")
    # ends by block, without the text
    counts = _ends(lines.drop("value", "bytes", "file_bytes").join(starts, ["path", "block"])).groupBy("path", "block").agg(F.sum("ends").alias("of_block"))
    counts = counts.withColumn("offset", F.coalesce(F.sum("of_block").over(order.rowsBetween(*_BEFORE)), F.lit(0)))
    final = F.max(F.struct("block", F.pmod(F.col("start") + F.col("quotes"), F.lit(2)).alias("inside")))
    whole = blocks.groupBy("path").agg(final.alias("final"), F.sum("change").alias("depth"), F.max("block").alias("last_block"),
                                       (F.max("file_bytes") - F.sum("bytes") - F.sum("n")).alias("rest"))
    # every line was counted as closed by a brace; all bytes but one (and a byte order mark) are there if the last was not
    whole = whole.withColumn("open_end", F.col("rest").isin(-1, 2))
    closed = F.col("open_end") & (F.col("final.inside") == 0) & (F.col("depth") == -1)
    totals = counts.groupBy("path").agg(F.sum("of_block").alias("found"))
    known = whole.join(totals, "path").select(
        "path", "last_block", "open_end", closed.alias("closed"), F.col("found").alias("elements"))
    known.write.parquet(f"{base}/known")
    known = spark.read.parquet(f"{base}/known")
    files = known.select("path", "closed", "elements")

    placed = _ends(lines.drop("bytes", "file_bytes").join(starts.join(counts, ["path", "block"]).join(known.select("path", "last_block", "open_end"), "path"),
                                                 ["path", "block"]))
    final_row = F.max("row").over(Window.partitionBy("path", "block"))
    unclosed = F.col("open_end") & (F.col("block") == F.col("last_block")) & (F.col("row") == final_row)
    placed = placed.withColumn("text", F.when(unclosed, F.col("value")).otherwise(F.concat("value", F.lit("}"))))

    def joined(at: str):
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, "text"))), lambda x: x["text"]), "").alias("text")

    pieces = placed.groupBy("path", "block", "offset", "of_block", "e").agg(joined("row"))
    pieces = pieces.withColumn("element", F.col("offset") + F.col("e"))
    edge = (F.col("e") == 0) | (F.col("e") == F.col("of_block"))  # at most two a block may go on in others
    across = pieces.where(edge).groupBy("path", "element").agg(joined("block"))
    out = pieces.where(~edge).select("path", "element", "text").unionByName(across)
    out.write.parquet(f"{base}/pieces")
    return SplitArrays(spark.read.parquet(f"{base}/pieces"), files)


__all__ = ["SplitArrays", "split_json_arrays", "NOT_ARRAY", "NOT_OBJECT"]
