"""Normalisation of request batches to the 44-column contract, and batch dedupe."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CREATED, KEY, RAW_SCHEMA

_NESTED = (T.StructType, T.ArrayType, T.MapType)


def conform(df: DataFrame, schema: T.StructType = RAW_SCHEMA, keep: tuple[str, ...] = ()) -> DataFrame:
    """Any input columns -> exactly ``schema``'s columns, in order, typed.

    * missing names become typed NULL columns,
    * unexpected names are dropped,
    * nested values become their JSON text,
    * other values are converted with ``try_cast`` (a bad cell is NULL, the row stays).

    One projection: no shuffle, fully code-generated. ``keep`` names columns of
    the schema that are taken as they are.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        if f.name in keep:
            c = F.col(f.name)
        elif f.name not in present:
            c = F.lit(None).cast(f.dataType)
        else:
            c = F.col(f"`{f.name}`")
            src = present[f.name]
            if isinstance(src, _NESTED):
                c = F.to_json(c)
                src = T.StringType()
            if src != f.dataType:
                c = c.try_cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


#: Typed copy of a landed row's key, the column, the text that could not be converted, why, and the row it came from.
LEDGER_SCHEMA = T.StructType([
    T.StructField(KEY, T.LongType(), True),
    T.StructField("column", T.StringType(), False),
    T.StructField("raw_text", T.StringType(), False),
    T.StructField("reason", T.StringType(), False),
    T.StructField("row_hash", T.LongType(), False),
])


def conform_with_failures(df: DataFrame, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """``conform(df)`` with two more columns: ``failed_cells`` and ``row_hash``.

    A cell has failed when its text is there and its typed value is not (an
    empty text of a typed column counts, as it is no number or time either).
    ``failed_cells`` is an array of (column, raw_text, reason), so typed rows
    and failures come from one projection. ``row_hash`` is over the landed
    contract columns as text, and ties a failure to its row where the key itself
    could not be read.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    present = [f for f in schema.fields if f.name in types]

    def as_text(name: str):
        c = F.col(f"`{name}`")
        return F.to_json(c) if isinstance(types[name], _NESTED) else c.cast("string")

    cells = []
    for f in present:
        if f.dataType != T.StringType() and types[f.name] != f.dataType:
            bad = as_text(f.name).isNotNull() & as_text(f.name).try_cast(f.dataType).isNull()
            cells.append(F.when(bad, F.struct(F.lit(f.name).alias("column"), as_text(f.name).alias("raw_text"),
                                              F.lit(f"not a {f.dataType.simpleString()}").alias("reason"))))
    failed = F.filter(F.array(*cells), lambda x: x.isNotNull()) if cells else F.array().cast(
        "array<struct<column:string,raw_text:string,reason:string>>")
    row_hash = F.xxhash64(*(F.coalesce(as_text(f.name), F.lit("\0")) for f in present)) if present else F.lit(0).cast("long")
    whole = df.withColumns({"_failed": failed, "_hash": row_hash})
    typed = conform(whole, T.StructType([*schema.fields, T.StructField("_failed", failed_type(), True),
                                         T.StructField("_hash", T.LongType(), True)]), keep=("_failed", "_hash"))
    return typed.withColumnsRenamed({"_failed": "failed_cells", "_hash": "row_hash"})


def failed_type() -> T.DataType:
    return T.ArrayType(T.StructType([T.StructField(c, T.StringType(), True) for c in ("column", "raw_text", "reason")]))


def failed_cells(conformed: DataFrame) -> DataFrame:
    """The ledger of ``conform_with_failures``' output: one row per failed cell (``LEDGER_SCHEMA``)."""
    one = conformed.where(F.size("failed_cells") > 0).select(KEY, F.explode("failed_cells").alias("c"), "row_hash")
    return one.select(KEY, "c.column", "c.raw_text", "c.reason", "row_hash")


def batch_dedupe(df: DataFrame, key: str = KEY) -> DataFrame:
    """One row per key; the pick is deterministic: the greatest row, comparing the
    creation time first, then the other columns in order (NULL is smallest).

    Written as an aggregate, not a window: ``max(struct(...))`` combines
    partially inside each task before the shuffle, so a key holding a large
    share of the batch is reduced map-side instead of landing whole in one task.
    Rows with a NULL key cannot enter a keyed table; they are left out here
    and returned by ``null_key_rows`` for quarantine.
    """
    others = [c for c in df.columns if c != key]
    if CREATED in others:
        others = [CREATED] + [c for c in others if c != CREATED]
    return (df.where(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.max(F.struct(*others)).alias("_row"))
            .select(key, *[F.col(f"_row.{c}").alias(c) for c in df.columns if c != key]))


def null_key_rows(df: DataFrame, key: str = KEY) -> DataFrame:
    return df.where(F.col(key).isNull())


def is_empty(df: DataFrame) -> bool:
    """Empty-batch guard (reads at most one row)."""
    return df.isEmpty()
