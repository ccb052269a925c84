"""Shared helpers of the training-data operators."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.session import scratch_path


#: Bytes of an Arrow batch sent to a Python worker where the session keeps Spark's default.
BATCH_BYTES, _DEFAULT_BATCH_BYTES = "4m", 64 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by ``BATCH_BYTES`` unless the session sets a bound of its own.

    Rows are whole texts, so Spark's default batches hold up to 64 MB; the JVM
    keeps such a batch outside its heap, doubled while it grows, for every task.
    """
    if spark.conf.get(_BATCH_CONF) in (f"{_DEFAULT_BATCH_BYTES}b", str(_DEFAULT_BATCH_BYTES), "64m", "64MB"):
        spark.conf.set(_BATCH_CONF, BATCH_BYTES)


def ship(spark: SparkSession) -> None:
    """Bound the batches, and let Python workers import this library where the driver's path entry does not reach them."""
    bound_batches(spark)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    seen = {os.path.abspath(p) for p in (os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)) if p}
    if root in seen or any(os.path.isdir(os.path.join(p, "civicflow", "llm")) for p in seen):
        return
    sc = spark.sparkContext
    if any(str(f).endswith("civicflow.zip") for f in sc._python_includes):
        return
    folder = tempfile.mkdtemp(prefix="civicflow-ship-")  # on the driver; Spark sends the file to the executors
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "civicflow"), "zip", root, "civicflow"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Row numbers (8 bytes each) that are broadcast to drop rows; more of them are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def without_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``docs`` without the given ``row`` numbers (monotonically_increasing_id over ``docs``, a stored table)."""
    rows = stored(rows, "dropped_rows")
    if rows.count() <= BROADCAST_ROWS:
        rows = F.broadcast(rows)
    (number,) = fresh_columns(docs, "_row")
    numbered = docs.withColumn(number, F.monotonically_increasing_id())
    return numbered.join(rows, F.col(number) == rows["row"], "left_anti").drop(number)


def fresh_columns(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until it clashes with no column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out
