import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from civicflow.operators.normalize import conform  # noqa: E402
from civicflow.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="civicflow-tests", shuffle_partitions=4)
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="civicflow-test-ckpt-", dir="/tmp")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="civicflow-test-", dir="/tmp")


def ts(text):
    return dt.datetime.fromisoformat(text)


def raw_rows(spark, rows, columns=None):
    """Raw-contract frame from a few dicts (missing keys -> NULL)."""
    from pyspark.sql import types as T
    cols = columns or sorted({k for r in rows for k in r})
    typ = {"unique_key": T.LongType(), "latitude": T.DoubleType(), "longitude": T.DoubleType()}
    schema = T.StructType([
        T.StructField(c, typ.get(c, T.TimestampNTZType() if c.endswith("_date") else T.StringType()), True)
        for c in cols])
    df = spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], schema)
    return conform(df)
