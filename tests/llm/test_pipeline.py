"""The pipeline's stages over the smallest testdata, and the registered queries with SQL."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import __spark_entry__ as E  # noqa: E402
import corpus_pipeline  # noqa: E402
from civicflow.llm import exact, neardup, pii, quality, registry  # noqa: E402
from civicflow.llm.common import stored  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_registered():
    names = E.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_matches_sql(spark, name):
    con = duck(SF)
    ok, msg = compare(spark, con, name, registry.QUERIES[name], registry.SQL[name], SF)
    con.close()
    assert ok, msg


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, labels = docs.columns, spark.read.parquet(f"{SF}/labels.parquet")

    def ids(df):
        return sorted(r[0] for r in df.select("doc_id").collect())

    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality_rules", "exact_dedup", "near_dedup", "surrogates", "packing"]
    good = stored(steps["quality_rules"](spark, docs, SF), "t")
    assert good.columns == columns and ids(good) == ids(quality.quality(docs, labels).where("kept"))
    unique = stored(steps["exact_dedup"](spark, good, SF), "t")
    assert unique.columns == columns and ids(unique) == ids(exact.exact_dedup(good, exact.incoming_half()).where("kept"))
    near = stored(steps["near_dedup"](spark, unique, SF), "t")
    assert near.columns == columns and ids(near) == ids(neardup.near_groups(unique).where("kept"))
    safe = stored(steps["surrogates"](spark, near, SF), "t")
    assert safe.columns == columns and ids(safe) == ids(near)
    before = dict(near.select("doc_id", "text").collect())
    for i, t in safe.select("doc_id", "text").collect():
        mentions = [before[i][a:z] for a, z, _, _ in pii.detect(before[i])]
        assert (t != before[i]) == bool(mentions) and not any(m in t for m in mentions)
    packed = steps["packing"](spark, safe, SF)
    assert sorted(set(ids(packed))) == ids(safe)
