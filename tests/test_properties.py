"""Properties of the watermark and the load: order and split do not matter."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from civicflow.operators import load as L
from civicflow.schema import META_SCHEMA

BASE = dt.datetime(2026, 1, 1)
row = st.tuples(st.integers(0, 3), st.integers(0, 1200))          # (hour offset, key)
batches = st.lists(st.lists(row, min_size=1, max_size=4), min_size=1, max_size=4)


@settings(max_examples=12, deadline=None)
@given(batches)
def test_merge_sequence_equals_lexicographic_max(spark, seq):
    state = spark.createDataFrame([], META_SCHEMA)
    seen = []
    for i, b in enumerate(seq):
        frame = spark.createDataFrame([(k, BASE + dt.timedelta(hours=h)) for h, k in b],
                                      "unique_key bigint, created_date timestamp_ntz")
        merged = L.merge_watermark(state, L.batch_max(frame), BASE + dt.timedelta(days=i))
        state = spark.createDataFrame(merged.collect(), META_SCHEMA)  # a one-row table: keep the plan short
        seen += b
        top = max((BASE + dt.timedelta(hours=h), k) for h, k in seen)
        got = L.read_watermark(state)
        assert got == top  # never behind the newest row seen, never ahead of it


@settings(max_examples=8, deadline=None)
@given(st.permutations(list(range(6))), st.integers(1, 3))
def test_log_order_and_replay_do_not_matter(spark, order, repeat):
    """Appending batch maxima in any order, with replays, reads back as the same watermark."""
    import tempfile
    log = L.WatermarkLog(tempfile.mkdtemp(prefix="civicflow-prop-", dir="/tmp") + "/wm")
    maxima = [(BASE + dt.timedelta(hours=i % 3), 100 + i) for i in range(6)]
    for i in order[:3] + order[:repeat]:
        log.append_values(spark, "s", maxima[i][0], maxima[i][1], BASE)
    expect = max(maxima[i] for i in order[:3])
    assert L.read_watermark(log.read(spark), "s") == expect


def test_log_compaction_keeps_the_watermark(spark):
    import tempfile
    log = L.WatermarkLog(tempfile.mkdtemp(prefix="civicflow-prop-", dir="/tmp") + "/wm")
    for i in range(5):
        log.append_values(spark, "a", BASE + dt.timedelta(hours=i % 3), 10 + i, BASE + dt.timedelta(days=i))
        log.append_values(spark, "b", BASE, i, BASE)
    before = sorted(map(tuple, log.read(spark).collect()))
    assert len(log.data_files(spark)) == 10
    assert log.compact(spark, min_files=4) == 10
    assert len(log.data_files(spark)) == 1
    assert sorted(map(tuple, log.read(spark).collect())) == before
    assert log.compact(spark, min_files=4) == 0
