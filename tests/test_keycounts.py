"""Uniqueness reports kept by batches equal the full report after every batch, and read only the batch's own keys."""

import random
from functools import reduce

import pytest
from pyspark.sql import DataFrame

from civicflow.operators import keycounts as K
from civicflow.operators import quality as D
from civicflow.session import path_exists, remove_dir


def frame(spark, rows):
    return spark.createDataFrame(rows, "unique_key long, a string, b string")


def some_batches(spark, rng, n):
    """Batches with null keys, repeats within and across batches, keys far apart, one empty."""
    def row():
        key = rng.choice([None, rng.randrange(60), rng.randrange(60), rng.randrange(-2**63, 2**63), 7])
        return key, rng.choice([None, "x", "y", ""]), rng.choice([None, *map(str, range(12))])

    return [frame(spark, [row() for _ in range(0 if i == 2 else rng.randrange(5, 40))]) for i in range(n)]


@pytest.mark.parametrize("columns,nulls,full", [(["unique_key"], False, lambda df: D.unique_failures(df, "unique_key")),
                                                (["a", "b"], True, lambda df: D.unique_combination_failures(df, ["a", "b"]))])
def test_equals_the_full_report_after_every_batch(spark, tmpdir_path, monkeypatch, columns, nulls, full):
    counts = K.KeyCounts(spark, f"{tmpdir_path}/k", columns, nulls)
    assert counts.report("t", "m").first()["failures"] == 0 and counts.history("t", "m").count() == 0 and counts.fold(1) == 0
    batches, want = some_batches(spark, random.Random(len(columns)), 6), []
    for i, b in enumerate(batches):
        if i == 4:
            monkeypatch.setattr(K, "BROADCAST_KEYS_MAX", 0)  # by shuffle
        assert counts.load(b, 10 * i)
        seen = reduce(DataFrame.unionAll, batches[:i + 1])
        want.append(full(seen).count())
        row = counts.report("t", "m").first()
        assert row["failures"] == want[-1] and row["status"] == ("fail" if want[-1] else "pass")
        keys = seen.select(*columns).distinct()
        assert counts.added().agg({"n_keys": "sum"}).first()[0] == (keys if nulls else keys.dropna()).count()
        if i in (1, 3):
            assert counts.fold(2) == 2 and counts.fold(2) == 0
        if i == 2:
            assert counts.load(b, 10 * i)  # a replay
            assert counts.load(batches[0], 0) is False  # folded before
    assert counts.load(batches[4], 40)  # a replay looks at the batches before it only
    assert [(r["batch_id"], r["failures"]) for r in counts.history("t", "m").orderBy("batch_id").collect()] == list(zip(range(0, 60, 10), want))
    assert want[-1] > 3


def test_a_dead_load_and_the_order(spark, tmpdir_path):
    root = f"{tmpdir_path}/k"
    counts = K.KeyCounts(spark, root, ["unique_key"])
    counts.load(frame(spark, [(1, "", ""), (2, "", "")]), 0)
    counts.load(frame(spark, [(2, "", ""), (3, "", "")]), 2)
    remove_dir(spark, f"{root}/added/batch_id=2")  # died before its failures were written
    assert counts.report("t", "m").first()["failures"] == 0
    assert counts.load(frame(spark, [(1, "", "")]), 1) and counts.report("t", "m").first()["failures"] == 1
    counts.load(frame(spark, [(2, "", ""), (3, "", "")]), 2)
    assert counts.report("t", "m").first()["failures"] == 2
    with pytest.raises(ValueError):
        K.KeyCounts(spark, root, ["unique_key"]).load(frame(spark, []), -1)
    for i in (3, 4, 5):
        counts.load(frame(spark, [(3, "", "")]), i)
        assert counts.fold(1)
    assert counts.report("t", "m").first()["failures"] == 3
    assert not path_exists(spark, f"{root}/counts/batch_id=0") and not path_exists(spark, f"{root}/folded/upto=3")


def test_reads_only_the_batch_range(spark, tmpdir_path):
    counts = K.KeyCounts(spark, f"{tmpdir_path}/k", ["unique_key"])
    counts.load(spark.range(0, 400_000).selectExpr("id as unique_key"), 0)
    batch = spark.range(130_000, 130_050).selectExpr("id as unique_key")
    own = counts._counted(batch)
    plan = counts.seen(own, 50, 1, 1, 1)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(bucket,1), LessThanOrEqual(bucket,1)" in plan and "BroadcastHashJoin" in plan
    counts.load(batch, 1)
    assert counts.report("t", "m").first()["failures"] == 50
