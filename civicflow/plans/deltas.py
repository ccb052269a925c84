"""Raw table and aggregates maintained by deltas: a batch costs its own rows, not the history.

Layout under one root (shared storage):

    raw/batch_id=N       rows a batch added (first write of a key wins), replaced whole by its replay
    deltas/batch_id=N    the same rows' additive aggregate state and dimension values
    state/v=K/...        folded state: one combined delta, and the batches' rows as a segment of few files
    state/v=K/manifest   the batches and segments that version K holds; written last, so it publishes the version
    keys/batch_id=N, segment_keys/K    bitmap index of the keys of those rows (``operators.keyindex``)

All measures of the three aggregates are additive (counts, exact microsecond
sums, the newest creation time), so the tables are the sum of the published
state and the deltas that it does not hold. Every directory belongs to one batch
or version and is replaced as a whole, so replays and crashes leave each batch
counted exactly once: a batch whose id is in the manifest is known, any other is
written again from the same rows. A batch meets the stored keys through their
index; stored rows are opened only where a crash left them without one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keyindex import BROADCAST_WORDS_MAX, KEYS_SCHEMA, absent_rows, bit_of, key_words, stored_words, word_of, write_index
from ..operators.load import LoadResult
from ..operators.normalize import batch_dedupe
from ..schema import CREATED, EXPECTED_COLUMNS, KEY, RAW_SCHEMA
from ..session import list_dirs, path_exists, remove_dir
from . import models

BATCH = "batch_id"
_ADDED = ("complaint_count", "closed_count", "resolution_us_sum")
MANIFEST_SCHEMA = T.StructType([T.StructField("kind", T.StringType(), False), T.StructField("id", T.LongType(), False)])


def combine(sets: DataFrame) -> DataFrame:
    """Partial aggregate states (``models.aggregate_sets``) summed to one row per group."""
    types = {f.name: f.dataType for f in sets.schema.fields}
    return sets.groupBy(*models._AGG_COLS, "set_id").agg(
        *(F.sum(c).cast(types[c]).alias(c) for c in _ADDED), F.max("latest_created_at").alias("latest_created_at")).select(*sets.columns)


@dataclass
class DeltaWarehouse:
    """Requests loaded by batches with ids, and the aggregates and dimensions over all of them."""

    spark: SparkSession
    root: str

    # ---------------------------------------------------------------- what is there

    def _version(self) -> int | None:
        """Newest published version."""
        found = [int(d.split("=")[1]) for d in list_dirs(self.spark, f"{self.root}/state")]
        return max((v for v in found if path_exists(self.spark, f"{self.root}/state/v={v}/manifest/_SUCCESS")), default=None)

    def _manifest(self, version: int | None) -> tuple[set[int], list[int]]:
        """Batches and segments of a version (one small row each)."""
        if version is None:
            return set(), []
        rows = self.spark.read.schema(MANIFEST_SCHEMA).parquet(f"{self.root}/state/v={version}/manifest").collect()
        return {r["id"] for r in rows if r["kind"] == "batch"}, sorted(r["id"] for r in rows if r["kind"] == "segment")

    def _loose(self, kind: str, held: set[int]) -> list[int]:
        """Finished batch directories that the state does not hold."""
        ids = [int(d.split("=")[1]) for d in list_dirs(self.spark, f"{self.root}/{kind}")]
        return sorted(i for i in ids if i not in held and path_exists(self.spark, f"{self.root}/{kind}/{BATCH}={i}/_SUCCESS"))

    def _union(self, paths: list[str], schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def raw(self, without: int | None = None) -> DataFrame:
        """All loaded rows; ``without`` leaves out one batch that the state does not hold."""
        version = self._version()
        held, segments = self._manifest(version)
        paths = [f"{self.root}/segments/{s}" for s in segments]
        paths += [f"{self.root}/raw/{BATCH}={i}" for i in self._loose("raw", held) if i != without]
        return self._union(paths, RAW_SCHEMA).select(*EXPECTED_COLUMNS)

    def raw_of(self, batch_id: int) -> DataFrame:
        """Rows that a batch added, while its own directory is there."""
        return self._union([f"{self.root}/raw/{BATCH}={batch_id}"], RAW_SCHEMA)

    def key_index(self, without: int | None = None) -> DataFrame:
        """(word, bits) of all stored keys, several rows a word; ``without`` as in ``raw``.

        Rows whose index is missing (a load that died before writing it) give their keys themselves.
        """
        held, segments = self._manifest(self._version())
        indexed, bare = [], []
        for rows, index in [(f"segments/{s}", f"segment_keys/{s}") for s in segments] + [
                (f"raw/{BATCH}={i}", f"keys/{BATCH}={i}") for i in self._loose("raw", held) if i != without]:
            done = path_exists(self.spark, f"{self.root}/{index}/_SUCCESS")
            (indexed if done else bare).append(f"{self.root}/{index if done else rows}")
        index = self._union(indexed, KEYS_SCHEMA)
        return index.unionByName(key_words(self._union(bare, RAW_SCHEMA))) if bare else index

    # ---------------------------------------------------------------- loading

    def load(self, batch: DataFrame, batch_id: int) -> bool:
        """Add the rows of ``batch`` whose key no other batch has; false if the batch was folded before.

        Reads the batch and the key index within the batch's key range; the
        aggregates are computed from the added rows only. Loading a batch again
        replaces what it wrote. The batch is read twice, its keys and then its
        rows, and must give the same rows both times (cache it if it may not).
        """
        return self.load_counted(batch, batch_id) is not None

    def load_counted(self, batch: DataFrame, batch_id: int) -> LoadResult | None:
        """``load``, with its counters: distinct keys of the batch, and what the write itself saw of the added rows."""
        held, _ = self._manifest(self._version())
        if batch_id in held:
            return None
        own, keys = f"{self.root}/raw/{BATCH}={batch_id}", f"{self.root}/keys/{BATCH}={batch_id}"
        remove_dir(self.spark, keys)  # a replay's index must not outlive the rows it was made of
        keyed = batch.where(F.col(KEY).isNotNull())
        key = F.col(KEY).cast("long")
        counted = keyed.groupBy(word_of(key).alias("word")).agg(F.bit_or(bit_of(key)).alias("bits"), F.count(F.lit(1)).alias("n")).persist()
        words = counted.select("word", "bits")
        stored = stored_words(words, self.key_index(without=batch_id)).persist()
        try:
            keys_in, rows_in = counted.agg(F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
            # the wide dedupe runs only when the batch really repeats a key
            deduped = keyed if keys_in == rows_in else batch_dedupe(keyed)
            new = absent_rows(deduped, stored, small=stored.count() <= BROADCAST_WORDS_MAX)
            created, written = F.col(CREATED), Observation()  # behind the last shuffle: a task that runs again counts once
            new.select(*EXPECTED_COLUMNS).sortWithinPartitions(CREATED).observe(
                written, F.count(F.lit(1)).alias("rows"), F.min(created).alias("first"), F.max(created).alias("last"),
                F.count_if(created.isNull()).alias("undated")).write.mode("overwrite").parquet(own)
        finally:
            for df in (stored, counted):
                df.unpersist()
        write_index(key_words(self.spark.read.schema(RAW_SCHEMA).parquet(own)), keys)
        stg = models.staging(self.spark.read.schema(RAW_SCHEMA).parquet(own))
        sets = models.aggregate_sets(models.fact(models.enriched(stg)))
        sets.write.mode("overwrite").parquet(f"{self.root}/deltas/{BATCH}={batch_id}")
        models.dimension_sets(stg).write.mode("overwrite").parquet(f"{self.root}/dimensions/{BATCH}={batch_id}")
        got = written.get
        return LoadResult(int(keys_in), int(got["rows"]), None, (got["first"], got["last"]) if got["first"] is not None else None,
                          int(got["undated"]))

    # ---------------------------------------------------------------- reading

    def _sets(self) -> DataFrame:
        return self._parts("deltas", "sets", self._blank()[0])

    def _blank(self) -> tuple[T.StructType, T.StructType]:
        """Schemas of the aggregate and dimension states."""
        stg = models.staging(self.spark.createDataFrame([], RAW_SCHEMA))
        return models.aggregate_sets(models.fact(models.enriched(stg))).schema, models.dimension_sets(stg).schema

    def _parts(self, kind: str, folded: str, schema: T.StructType) -> DataFrame:
        version = self._version()
        held, _ = self._manifest(version)
        paths = [f"{self.root}/state/v={version}/{folded}"] if version is not None else []
        return self._union(paths + [f"{self.root}/{kind}/{BATCH}={i}" for i in self._loose(kind, held)], schema)

    def aggregates(self) -> dict[str, DataFrame]:
        """daily, geo and agency_perf over everything loaded, equal to a full build."""
        return models.split_aggregates(combine(self._sets()))

    def dimensions(self) -> dict[str, DataFrame]:
        return models.split_dimensions(self._parts("dimensions", "dimensions", self._blank()[1]).distinct())

    # ---------------------------------------------------------------- folding

    def fold(self, min_batches: int = 64) -> int:
        """Fold the loose batches into a new version once there are ``min_batches``; returns how many.

        Their rows become one segment, their deltas one state with the version
        before. The manifest is written last: a crash before it leaves the old
        version in force, and the next fold writes under the same names anew.
        Readers of the version before keep their files: only what that version
        held already is removed, and versions older than it.
        """
        version = self._version()
        held, segments = self._manifest(version)
        loose = [i for i in self._loose("raw", held) if i in set(self._loose("deltas", held)) & set(self._loose("dimensions", held))]
        if not loose or len(loose) < min_batches:
            return 0
        new = 0 if version is None else version + 1
        schemas = self._blank()
        self._union([f"{self.root}/raw/{BATCH}={i}" for i in loose], RAW_SCHEMA).hint("rebalance").sortWithinPartitions(
            CREATED).write.mode("overwrite").parquet(f"{self.root}/segments/{new}")
        write_index(key_words(self._union([f"{self.root}/segments/{new}"], RAW_SCHEMA)), f"{self.root}/segment_keys/{new}")

        def parts(kind: str, folded: str, schema: T.StructType) -> DataFrame:
            before = [f"{self.root}/state/v={version}/{folded}"] if version is not None else []
            return self._union(before + [f"{self.root}/{kind}/{BATCH}={i}" for i in loose], schema)

        at = f"{self.root}/state/v={new}"
        combine(parts("deltas", "sets", schemas[0])).write.mode("overwrite").parquet(f"{at}/sets")
        parts("dimensions", "dimensions", schemas[1]).distinct().write.mode("overwrite").parquet(f"{at}/dimensions")
        rows = [("batch", i) for i in [*held, *loose]] + [("segment", s) for s in [*segments, new]]
        self.spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{at}/manifest")
        for i in held:
            for kind in ("raw", "deltas", "dimensions", "keys"):
                remove_dir(self.spark, f"{self.root}/{kind}/{BATCH}={i}")
        for d in list_dirs(self.spark, f"{self.root}/state"):
            if int(d.split("=")[1]) < new - 1:
                remove_dir(self.spark, f"{self.root}/state/{d}")
        return len(loose)
