"""Layered table storage: ``<root>/<layer>/<name>`` Parquet directories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LAYERS = ("raw", "staging", "intermediate", "marts")


def table_path(root: str, layer: str, name: str) -> str:
    """Path of a table; a layer outside the known four is used verbatim."""
    return f"{root.rstrip('/')}/{layer}/{name}"


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Materialise a model (full rebuild by default). The file commit protocol makes
    the write all-or-nothing, so a retried task or job never leaves half a table."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
