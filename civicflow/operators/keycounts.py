"""Uniqueness tests kept by batches: a batch costs its own keys, not the table.

Layout under one root (shared storage):

    counts/batch_id=N   (bucket, key columns, n): how often the batch holds each key, in order of bucket
    added/batch_id=N    one row: the keys and the failures that the batch added; written after its counts
    folded/upto=K       counts and added rows of all batches up to K in one; in force once its marker is there

A key fails when it occurs more than once in all batches together. What a batch
adds to the number of failing keys follows from its own counts and from the
earlier counts of its own keys, so only those are looked up: whole-number keys
lie in buckets of neighbouring values and others in hash buckets, and a batch's
bucket range reaches Parquet. Batches come in order of their ids; a replayed one
replaces what it wrote and looks only at the batches before it, so it writes the
same again.

The counters come from the stored counts, not from metrics observed in front of
the shuffle: a lost executor makes Spark run those tasks again, and a metric
would then count their rows twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import create_file, list_dirs, path_exists, remove_dir
from .quality import _status

#: Neighbouring whole numbers of one bucket (as a power of two), and buckets of other keys.
KEY_BITS, HASH_BUCKETS = 16, 4096
#: Most keys of a batch that are broadcast to the earlier counts; more meet them by shuffle.
BROADCAST_KEYS_MAX = 500_000
ADDED_SCHEMA = T.StructType([T.StructField("batch_id", T.LongType()), T.StructField("n_keys", T.LongType()),
                             T.StructField("failures", T.LongType())])


@dataclass
class KeyCounts:
    """Occurrences of the values of ``columns`` over batches with ids.

    ``nulls``: whether NULL is a value (as in the test of a combination) or a
    row with a NULL is not tested (as in the test of one column).
    """

    spark: SparkSession
    root: str
    columns: list[str]
    nulls: bool = False

    # ---------------------------------------------------------------- what is there

    def _folded(self) -> list[int]:
        """Published folds, oldest first."""
        found = [int(d.split("=")[1]) for d in list_dirs(self.spark, f"{self.root}/folded")]
        return sorted(k for k in found if path_exists(self.spark, f"{self.root}/folded/upto={k}/published"))

    def _loose(self, after: int | None) -> list[int]:
        """Finished batches that the fold does not hold."""
        ids = [int(d.split("=")[1]) for d in list_dirs(self.spark, f"{self.root}/added")]
        return sorted(i for i in ids if (after is None or i > after) and path_exists(self.spark, f"{self.root}/added/batch_id={i}/_SUCCESS"))

    def _paths(self, kind: str, before: int | None = None) -> list[str]:
        upto = (self._folded() or [None])[-1]
        paths = [f"{self.root}/folded/upto={upto}/{kind}"] if upto is not None else []
        return paths + [f"{self.root}/{kind}/batch_id={i}" for i in self._loose(upto) if before is None or i < before]

    # ---------------------------------------------------------------- loading

    def _counted(self, batch: DataFrame) -> DataFrame:
        rows = batch.select(*self.columns)
        if not self.nulls:
            rows = rows.dropna(subset=self.columns)
        whole = len(self.columns) == 1 and isinstance(rows.schema[0].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
        bucket = F.shiftright(F.col(self.columns[0]).cast("long"), KEY_BITS) if whole else F.pmod(F.xxhash64(*self.columns), F.lit(HASH_BUCKETS))
        return rows.groupBy(bucket.cast("long").alias("bucket"), *self.columns).agg(F.count(F.lit(1)).alias("n"))

    def seen(self, own: DataFrame, n: int, lo: int | None, hi: int | None, before: int) -> DataFrame:
        """The keys of ``own`` that batches before ``before`` hold: n, and n_before in those."""
        old = self.spark.read.schema(own.schema).parquet(*self._paths("counts", before)).where(
            F.col("bucket").between(F.lit(lo).cast("long"), F.lit(hi).cast("long")))
        mine = own.withColumnRenamed("n", "n_own").select(*(F.col(c).alias(f"_{c}") for c in ("bucket", *self.columns)), "n_own")
        if n <= BROADCAST_KEYS_MAX:
            mine = F.broadcast(mine)
        same = F.col("bucket").eqNullSafe(F.col("_bucket"))
        for c in self.columns:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        return old.join(mine, same).groupBy("bucket", *self.columns).agg(F.max("n_own").alias("n"), F.sum("n").alias("n_before"))

    def load(self, batch: DataFrame, batch_id: int) -> bool:
        """Count a batch; false if it was folded before. Raises ValueError for a new batch older than a counted one."""
        upto = (self._folded() or [None])[-1]
        if upto is not None and batch_id <= upto:
            return False
        done = self._loose(upto)
        if done and batch_id < done[-1] and batch_id not in done:
            raise ValueError(f"batch {batch_id} comes after batch {done[-1]}: batches are counted in order of their ids")
        at = f"{self.root}/counts/batch_id={batch_id}"
        remove_dir(self.spark, f"{self.root}/added/batch_id={batch_id}")  # unfinished until its failures are written
        counted = self._counted(batch)
        counted.repartitionByRange("bucket").sortWithinPartitions("bucket").write.mode("overwrite").parquet(at)
        own = self.spark.read.schema(counted.schema).parquet(at)
        n, twice, lo, hi = own.agg(F.count(F.lit(1)), F.count_if(F.col("n") > 1), F.min("bucket"), F.max("bucket")).first()
        old = (0, 0, 0)
        if n and self._paths("counts", batch_id):
            old = self.seen(own, n, lo, hi, batch_id).agg(
                F.count(F.lit(1)), F.count_if(F.col("n") > 1), F.count_if(F.col("n_before") == 1)).first()
        # a key met before fails now if it occurred once so far, whatever the batch holds of it
        row = (int(batch_id), int(n - old[0]), int(twice - old[1] + old[2]))
        self.spark.createDataFrame([row], ADDED_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/added/batch_id={batch_id}")
        return True

    # ---------------------------------------------------------------- reading

    def added(self) -> DataFrame:
        """One small row a batch: batch_id, n_keys and failures that it added."""
        paths = self._paths("added")
        return self.spark.read.schema(ADDED_SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], ADDED_SCHEMA)

    def _named(self, rows: DataFrame, test: str, model: str, *first: str) -> DataFrame:
        return rows.select(*first, F.lit(test).alias("test"), F.lit(model).alias("model"), F.lit(",".join(self.columns)).alias("column_name"),
                           "failures", _status(F.col("failures")).alias("status"))

    def report(self, test: str, model: str) -> DataFrame:
        """The row that the full report of ``operators.quality`` gives over all batches."""
        return self._named(self.added().agg(F.coalesce(F.sum("failures"), F.lit(0)).alias("failures")), test, model)

    def history(self, test: str, model: str) -> DataFrame:
        """The report as it stood after each batch."""
        upto = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)  # a row a batch
        return self._named(self.added().select("batch_id", F.sum("failures").over(upto).alias("failures")), test, model, "batch_id")

    # ---------------------------------------------------------------- folding

    def fold(self, min_batches: int = 64) -> int:
        """Fold the loose batches into one set of counts once there are ``min_batches``; returns how many.

        The marker comes last: a crash before it leaves the state as it was.
        What the fold before held already is removed, so its readers' files stay
        until the next one.
        """
        folds = self._folded()
        before = folds[-1] if folds else None
        loose = self._loose(before)
        if not loose or len(loose) < min_batches:
            return 0
        at = f"{self.root}/folded/upto={loose[-1]}"
        counts = self.spark.read.parquet(*self._paths("counts"))
        merged = counts.groupBy("bucket", *self.columns).agg(F.sum("n").alias("n"))
        merged.repartitionByRange("bucket").sortWithinPartitions("bucket").write.mode("overwrite").parquet(f"{at}/counts")
        self.added().coalesce(1).write.mode("overwrite").parquet(f"{at}/added")
        create_file(self.spark, f"{at}/published")
        for kind in ("added", "counts"):
            for d in list_dirs(self.spark, f"{self.root}/{kind}"):
                if before is not None and int(d.split("=")[1]) <= before:
                    remove_dir(self.spark, f"{self.root}/{kind}/{d}")
        for k in folds[:-1]:
            remove_dir(self.spark, f"{self.root}/folded/upto={k}")
        return len(loose)
