"""The bitmap index of stored keys: exact on any keys, and the only thing a load opens of what is stored."""

import random
import tempfile

from conftest import raw_rows
from pyspark.sql import functions as F

from civicflow.operators import keyindex as K
from civicflow.operators.load import insert_absent
from civicflow.plans import deltas
from civicflow.plans.deltas import DeltaWarehouse
from civicflow.session import path_exists, remove_dir

EDGES = [0, 1, 63, 64, 65, -1, -63, -64, -65, 2**63 - 1, -(2**63), 2**62, 4_000_000_000]


def keyed(spark, keys):
    return spark.createDataFrame([(k, f"row {i}") for i, k in enumerate(keys)], "unique_key long, status string")


def bits_of(rows):
    return {r["word"] * 64 + b for r in rows for b in range(64) if r["bits"] >> b & 1}


def test_words_hold_exactly_the_keys(spark):
    keys = EDGES + [random.Random(1).randrange(-10**6, 10**6) for _ in range(500)]
    assert bits_of(K.key_words(keyed(spark, keys + keys[:50] + [None, None])).collect()) == set(keys)
    assert K.key_words(keyed(spark, [None])).collect() == [] and K.key_words(keyed(spark, [])).collect() == []


def indexed_insert(batch, index):
    return K.absent_rows(batch, K.stored_words(K.key_words(batch), index))


def test_equals_insert_absent(spark, monkeypatch):
    rng = random.Random(7)
    stored = sorted({rng.choice([rng.randrange(3000), rng.randrange(-2**63, 2**63)]) for _ in range(2000)}) + EDGES
    batch = list(dict.fromkeys([rng.randrange(4000) for _ in range(900)] + rng.sample(stored, 300) + EDGES + [5, 2**63 - 2]))
    target = keyed(spark, stored).repartition(5)
    halves = [K.key_words(target.where(F.col("status") < "row 5")), K.key_words(target.where(F.col("status") >= "row 5"))]
    index, rows = halves[0].unionByName(halves[1]), keyed(spark, batch)
    want = sorted(map(str, insert_absent(rows, target).collect()))
    assert sorted(map(str, indexed_insert(rows, index).select("unique_key", "status").collect())) == want
    monkeypatch.setattr(K, "BROADCAST_WORDS_MAX", 0)  # by shuffle
    assert sorted(map(str, indexed_insert(rows, index).select("unique_key", "status").collect())) == want
    assert indexed_insert(rows, index.limit(0)).count() == rows.count()
    assert indexed_insert(rows.limit(0), index).count() == 0
    assert indexed_insert(keyed(spark, [None, None]), index).count() == 2


def test_a_load_opens_only_the_index(spark, monkeypatch):
    """Keys in no order of creation: the scan is of index files, within the batch's words; no stored row is read."""
    w = DeltaWarehouse(spark, tempfile.mkdtemp(prefix="civicflow-test-", dir="/tmp") + "/w")
    keys = list(range(0, 20_000, 3))
    random.Random(3).shuffle(keys)
    rows = [{"unique_key": k, "created_date": None, "agency": "A", "status": "Open"} for k in keys]
    w.load(raw_rows(spark, rows[:4000]), 0)
    w.fold(1)
    w.load(raw_rows(spark, rows[4000:]), 1)
    plans = []
    real = deltas.stored_words

    def watched(words, index):
        out = real(words, index)
        plans.append((out._jdf.queryExecution().explainString(out._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")),
                      index.inputFiles()))
        return out

    monkeypatch.setattr(deltas, "stored_words", watched)
    w.load(raw_rows(spark, [{"unique_key": k, "agency": "B"} for k in range(900, 1000)]), 2)
    (plan, files), = plans
    assert files and all("/keys/" in f or "/segment_keys/" in f for f in files)
    assert "GreaterThanOrEqual(word,14)" in plan and "LessThanOrEqual(word,15)" in plan
    got = {r[0] for r in w.raw().where("agency = 'B'").select("unique_key").collect()}
    assert got == {k for k in range(900, 1000) if k % 3}


def test_rows_without_an_index_give_their_keys(spark, monkeypatch):
    """A load that dies before its index is written, and the replay that follows."""
    w = DeltaWarehouse(spark, tempfile.mkdtemp(prefix="civicflow-test-", dir="/tmp") + "/w")
    first = raw_rows(spark, [{"unique_key": k, "agency": "A"} for k in range(10)])
    real = deltas.write_index

    def dies(words, path):
        raise RuntimeError("killed before the index")

    monkeypatch.setattr(deltas, "write_index", dies)
    try:
        w.load(first, 0)
    except RuntimeError:
        pass
    monkeypatch.setattr(deltas, "write_index", real)
    assert not path_exists(spark, f"{w.root}/keys/batch_id=0") and w.raw().count() == 10
    w.load(raw_rows(spark, [{"unique_key": k, "agency": "B"} for k in range(5, 15)]), 1)
    w.load(first, 0)
    assert w.raw().where("agency = 'A'").count() == 10 and w.raw().count() == 15
    w.fold(1)
    remove_dir(spark, f"{w.root}/segment_keys/0")  # a segment of a library without indexes
    w.load(raw_rows(spark, [{"unique_key": k, "agency": "C"} for k in range(12, 18)]), 2)
    assert sorted(r[0] for r in w.raw().where("agency = 'C'").select("unique_key").collect()) == [15, 16, 17]
