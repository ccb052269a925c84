"""File sources and sinks for request records (JSON arrays, JSON lines, CSV)."""

from __future__ import annotations

import itertools

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import LANDING_SCHEMA

CORRUPT = "_corrupt_record"


def read_json_array(spark: SparkSession, path: str, schema: T.StructType = LANDING_SCHEMA) -> DataFrame:
    """Files holding one JSON array of objects each (not splittable: one file, one task).

    Every field is read as text: nested values arrive as their JSON text and
    numbers as written, so a single bad value cannot poison a whole file.
    Typing happens later, per cell, with ``try_cast``.
    """
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType = LANDING_SCHEMA,
                    keep_corrupt: bool = False) -> DataFrame:
    """JSON-lines files (splittable). Malformed lines land in ``_corrupt_record`` when kept."""
    if keep_corrupt:
        schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
        return (spark.read.schema(schema).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", CORRUPT).json(path))
    return spark.read.schema(schema).json(path)


def json_array_problems(spark: SparkSession, path: str) -> DataFrame:
    """One row per file that is not a JSON array of objects: (path, problem).

    The JSON reader accepts a top-level object as one row and turns an array
    with a scalar element into a null row, so the shape is checked on the
    file text: parse as ``array<string>`` (NULL = not an array or malformed)
    and require every element to be an object. Each file is read as one string
    by one task (arrays are for backfills and samples; continuous feeds land as
    JSON lines, which split across tasks).
    """
    files = spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("path"), F.from_json("value", "array<string>").alias("items"))
    not_array = F.col("items").isNull()
    non_object = F.exists("items", lambda x: x.isNull() | ~F.ltrim(x).startswith("{"))
    problem = (F.when(not_array, F.lit("not a JSON array"))
               .when(non_object, F.lit("element is not a JSON object")))
    return files.select("path", problem.alias("problem")).where(F.col("problem").isNotNull())


def validate_json_array(spark: SparkSession, path: str) -> None:
    """Raise ``ValueError`` if any file is not an array of objects (reads only the problem rows)."""
    bad = json_array_problems(spark, path).limit(1).collect()
    if bad:
        raise ValueError(f"{bad[0]['path']}: {bad[0]['problem']}")


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON-lines sink, one file per partition."""
    df.write.mode(mode).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)


#: Most objects that are held at once as the text of one line of an array file.
LINE_ROWS = 1000


def write_json_array(df: DataFrame, path: str, mode: str = "overwrite", rows_per_file: int | None = None) -> None:
    """JSON arrays as ``read_json_array`` loads: one file of all rows (for samples), or files of at most ``rows_per_file`` rows.

    Files of bounded size are written by the tasks that hold the rows, a line
    of at most ``LINE_ROWS`` objects at a time: neither a file nor a task's rows are held as a whole.
    """
    value = F.to_json(F.struct("*"), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("v")
    if rows_per_file is None:
        array = F.concat(F.lit("["), F.concat_ws(",", F.collect_list("v")), F.lit("]")).alias("value")
        df.select(value).agg(array).write.mode(mode).text(path)
        return
    # the writer begins a file after so many lines, so all but a task's last line hold the same number of objects
    per_file = int(rows_per_file)
    per_line = next(n for n in range(min(per_file, LINE_ROWS), 0, -1) if per_file % n == 0)
    lines = per_file // per_line

    def run(batches):
        def texts():
            held: list[str] = []
            for b in batches:
                for at in range(0, b.num_rows, per_line):
                    held += b.column(0).slice(at, per_line).to_pylist()
                    if len(held) >= per_line:
                        yield ",".join(held[:per_line])
                        held = held[per_line:]
            if held:
                yield ",".join(held)

        number, last = 0, None
        for text in itertools.chain(texts(), (None,)):
            if last is not None:
                ends = text is None or number % lines == 0
                yield pa.RecordBatch.from_arrays([pa.array([f"{last}]" if ends else last])], names=["value"])
            if text is not None:
                last = f"{',' if number % lines else '['}{text}"
                number += 1

    df.select(value).mapInArrow(run, "value string").write.mode(mode).option("maxRecordsPerFile", lines).text(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV sink; nested columns are written as JSON text."""
    cols = [F.to_json(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) else F.col(f.name)
            for f in df.schema.fields]
    df.select(*cols).write.mode(mode).option("header", True).csv(path)


def write_sample_copies(landed: DataFrame, out_dir: str, size: int | None = None) -> None:
    """Header-CSV copies of a sample, as landed (text) and normalised (typed contract)."""
    from ..operators.normalize import conform

    out = out_dir.rstrip("/")
    sample = landed.limit(int(size)) if size is not None else landed
    write_csv(sample, f"{out}/raw")
    # normalise the copy just written, so both files hold the same rows
    spark = landed.sparkSession
    text_schema = T.StructType([T.StructField(c, T.StringType(), True) for c in landed.columns])
    written = spark.read.schema(text_schema).option("header", True).csv(f"{out}/raw")
    write_csv(conform(written), f"{out}/normalised")
