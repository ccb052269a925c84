"""Plan shapes that the scale design depends on (checked on the physical plan text)."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from civicflow.operators import load as L
from civicflow.operators.normalize import batch_dedupe, conform
from civicflow.plans import marts as M
from civicflow.plans import models
from civicflow.plans import queries as Q
from civicflow.sources import testdata

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def tree(text: str) -> list[str]:
    lines = text.splitlines()
    start = next(i for i, x in enumerate(lines) if x.startswith("== Physical Plan ==")) + 1
    end = next(i for i in range(start, len(lines)) if not lines[i].strip())
    return lines[start:end]


def test_dedupe_aggregates_partially_before_the_shuffle(spark):
    p = plan(batch_dedupe(conform(testdata.requests(spark, SF))))
    assert "partial_max" in p  # map-side combine: a hot key is reduced in each task
    assert "Window" not in p


def test_aggregates_one_scan_partial_before_shuffle(spark):
    fct = M.from_testdata(spark, SF).fct
    p = plan(models.aggregate_sets(fct))
    assert "Expand" in p and "partial_count" in p and "partial_sum" in p
    assert p.count("Scan parquet") == len(re.findall(r"Scan parquet", plan(fct)))  # the fact is read once


def test_collision_probe_broadcasts_the_batch_keys(spark, tmpdir_path):
    raw = conform(testdata.requests(spark, SF))
    raw.write.parquet(tmpdir_path + "/t")
    target = spark.read.parquet(tmpdir_path + "/t")
    batch = batch_dedupe(raw.where(F.col("created_date") >= F.lit("2001-01-01").cast("timestamp_ntz")))
    t = tree(plan(L.colliding_keys(batch, target)))
    semi = next(i for i, x in enumerate(t) if "LeftSemi" in x)
    assert "BroadcastHashJoin LeftSemi BuildRight" in t[semi]
    # the target scan sits right under the join (Filter/Scan only): it is never shuffled
    below = [x.strip(" :+-") for x in t[semi + 1: semi + 3]]
    assert below[0].startswith(("Filter", "Scan")) and any(b.startswith("Scan parquet") for b in below)
    anti = tree(plan(L.insert_absent(batch, target, batch_rows=10)))
    assert any("BroadcastHashJoin LeftAnti BuildRight" in x for x in anti)


def test_scans_prune_columns_and_push_filters(spark):
    m = M.from_testdata(spark, SF)
    p = plan(Q.recent_requests(m, 10, borough="EUROPE"))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderdate" in p
    assert "c_acctbal" not in p and "o_totalprice" not in p  # unused columns are not read
    p2 = plan(Q.heatmap_by_month(m))
    assert "BroadcastHashJoin" in p2 and "BroadcastExchange" in p2
