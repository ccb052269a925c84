"""JSON arrays read in byte ranges: the rows and rejections of the whole-file reader, at any split."""

import collections
import json
import os
import random
import string

import pytest
from pyspark.sql import functions as F

from civicflow.sources import files
from civicflow.sources.arrays import NOT_ARRAY, _lines, split_json_arrays
from civicflow.streaming.ingest import backfill_json, read_failures


def nasty(rng):
    """A request whose values hold braces, brackets, quotes, escapes, newlines and nested parts."""
    text = "".join(rng.choice('{}[]",:\\ \n\té' + string.ascii_letters) for _ in range(rng.randrange(30)))
    return {"unique_key": rng.randrange(10**6), "status": text, "agency": rng.choice([None, "", "}", "\\", '\\"}', '"'])} | rng.choice(
        [{}, {"location": {"a": [1, {"b": "]}"}], "c": text}}, {"borough": ["}{", [[]], {}]}, {"latitude": 1.50, "extra": {"x": text}}])


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("split", [37, 1000, 10**7])
def test_rows_equal_the_whole_file_reader(spark, tmpdir_path, split):
    rng = random.Random(split)
    os.makedirs(f"{tmpdir_path}/in")
    for name, n, indent in [("a", 60, None), ("b", 25, 2), ("c", 0, None), ("d", 1, 1)]:
        with open(f"{tmpdir_path}/in/{name}.json", "w") as f:
            json.dump([nasty(rng) for _ in range(n)] + ([{"status": "}" * 500 + '"' + "{" * 300}] if n > 1 else []), f, indent=indent,
                      ensure_ascii=rng.random() < 0.5)
            f.write(rng.choice(["", "\n", " \n\n"]))
    want = rows_of(files.read_json_array(spark, f"{tmpdir_path}/in"))
    got = split_json_arrays(spark, f"{tmpdir_path}/in", split)
    assert rows_of(got.rows()) == want and len(want) == 88
    assert got.problems().collect() == []
    if split == 37:  # the larger files were read in many blocks, some without an end of an element
        assert got.pieces.where("length(text) > 400").count() >= 2


BAD = {
    "blank": " \n", "object": '{"a": 1}', "scalar": "3", "open": '[{"a": 1}', "cut": '[{"a": 1', "cut_string": '[{"a": "1}',
    "extra_brace": '[{"a": 1}]}', "two": '[{"a": 1}],[{"a": 2}]', "no_comma": '[{"a": 1} {"a": 2}]', "trailing": '[{"a": 1},]',
    "number": '[{"a": 1}, 5, {"a": 2}]', "numbers": "[1, 2]", "tail_number": '[{"a": 1}, 5]', "null": "[null]", "nested": '[[{"a": 1}]]',
    "string": '["}", {"a": 1}]', "broken": '[{"a": 1}, {"a" 2}]', "junk": '[{"a": 1}] x', "lead": 'x [{"a": 1}]', "comma": "[,]",
}
GOOD = {"none": "[]", "space": " [ ] \n", "one": '[{"a": "}{"}]', "empty_objects": "[{},{}]", "mark": '﻿[{"a": 1}]'}


@pytest.mark.parametrize("split", [3, 10**7])
def test_rejections_equal_the_whole_file_check(spark, tmpdir_path, split):
    os.makedirs(f"{tmpdir_path}/in")
    for name, text in (BAD | GOOD).items():
        with open(f"{tmpdir_path}/in/{name}.json", "w") as f:
            f.write(text)

    def by_name(df):
        return {os.path.basename(r["path"])[:-5]: r["problem"] for r in df.collect()}

    want = by_name(files.json_array_problems(spark, f"{tmpdir_path}/in"))
    got = by_name(split_json_arrays(spark, f"{tmpdir_path}/in", split).problems())
    assert set(got) == set(BAD)
    after = {"extra_brace", "two", "junk"}  # text after the array, which the whole-file check does not look at
    assert {k: v for k, v in got.items() if k not in after} == {k: v for k, v in want.items() if k != "mark"}
    assert all(got[k] == NOT_ARRAY for k in after)


def test_many_tasks_read_one_file(spark, tmpdir_path):
    with open(f"{tmpdir_path}/a.json", "w") as f:
        json.dump([{"unique_key": k, "status": "}{" * (k % 7)} for k in range(20_000)], f)
    size = os.path.getsize(f"{tmpdir_path}/a.json")
    lines = _lines(spark, f"{tmpdir_path}/a.json")
    got = split_json_arrays(spark, f"{tmpdir_path}/a.json", size // 8)
    assert lines.select("path").distinct().count() == 1 and got.files.first()["elements"] == 20_000
    assert got.pieces.select("element").distinct().count() == 20_001 == got.pieces.count()
    assert rows_of(got.rows()) == rows_of(files.read_json_array(spark, f"{tmpdir_path}/a.json"))
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != str(size // 8)  # the session's own setting is back


def test_backfill_by_splits(spark, tmpdir_path):
    good = [{"unique_key": str(k), "created_date": "2026-01-02T03:04:05", "status": "}"} for k in range(50)] + [{"unique_key": "K-7"}]
    with open(f"{tmpdir_path}/a.json", "w") as f:
        json.dump(good, f)
    res = backfill_json(spark, f"{tmpdir_path}/a.json", f"{tmpdir_path}/raw", f"{tmpdir_path}/wm", split_bytes=300)
    assert (res.rows_in, res.rows_loaded, res.quarantined) == (50, 50, 1)
    assert [r["raw_text"] for r in read_failures(spark, f"{tmpdir_path}/raw").collect()] == ["K-7"]
    with open(f"{tmpdir_path}/a.json", "w") as f:
        f.write('[{"unique_key": 1}, 2]')
    with pytest.raises(ValueError, match="not a JSON object"):
        backfill_json(spark, f"{tmpdir_path}/a.json", f"{tmpdir_path}/raw", f"{tmpdir_path}/wm", split_bytes=300)


def test_arrays_of_bounded_size(spark, tmpdir_path):
    rows = spark.range(0, 2500, 1, 3).select(F.col("id").cast("string").alias("unique_key"), F.lit('"}').alias("status"))
    files.write_json_array(rows, f"{tmpdir_path}/out", rows_per_file=400)
    assert files.json_array_problems(spark, f"{tmpdir_path}/out").collect() == []
    back = files.read_json_array(spark, f"{tmpdir_path}/out")
    assert back.count() == 2500 and back.select("unique_key").distinct().count() == 2500
    assert back.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 400


@pytest.mark.parametrize("per_file", [1, 7, 400, 1009, 2000, 10_000])
def test_arrays_are_written_line_by_line(spark, tmpdir_path, per_file):
    """All objects of a task, and then all of a file, were gathered in memory."""
    rows = spark.range(0, 2500, 1, 3).select(F.col("id").cast("string").alias("unique_key"), F.lit('a\n"}é').alias("status"))
    rows = rows.where("unique_key < 700 or unique_key >= 1700")  # tasks of 700, 0 and 800 rows
    files.write_json_array(rows, f"{tmpdir_path}/out", rows_per_file=per_file)
    assert files.json_array_problems(spark, f"{tmpdir_path}/out").collect() == []
    back = files.read_json_array(spark, f"{tmpdir_path}/out").select("unique_key", "status", F.input_file_name().alias("f")).collect()
    assert sorted(r[:2] for r in map(tuple, back)) == sorted(map(tuple, rows.collect()))
    of = collections.Counter(r["f"] for r in back)
    assert sorted(of.values(), reverse=True) == sorted([n for t in (700, 800) for n in [per_file] * (t // per_file) + [t % per_file] * (t % per_file > 0)], reverse=True)
    lines = [r[0] for r in spark.read.text(f"{tmpdir_path}/out").collect()]
    assert max(x.count("unique_key") for x in lines) <= files.LINE_ROWS and (per_file < 2000 or len(lines) == 2)
    files.write_json_array(rows.where("false"), f"{tmpdir_path}/none", rows_per_file=per_file)
    assert files.read_json_array(spark, f"{tmpdir_path}/none").count() == 0


def test_array_files_are_written_without_a_shuffle(spark, tmpdir_path, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    plans, real = [], DataFrameWriter.text
    monkeypatch.setattr(DataFrameWriter, "text", lambda self, path, *a, **k: plans.append(
        self._df._jdf.queryExecution().executedPlan().toString()) or real(self, path, *a, **k))
    files.write_json_array(spark.range(2500).select(F.col("id").alias("unique_key")), f"{tmpdir_path}/out", rows_per_file=1000)
    assert len(plans) == 1 and "collect_list" not in plans[0] and "Exchange" not in plans[0]


def test_the_text_is_shuffled_once(spark, tmpdir_path, monkeypatch):
    import civicflow.sources.arrays as A

    seen, real = [], A._started
    monkeypatch.setattr(A, "_started", lambda lines, start: seen.append("value" in lines.columns) or real(lines, start))
    spark.createDataFrame([('[{"a": "1}é"},{"a": "2"}]',)], "value string").coalesce(1).write.text(f"{tmpdir_path}/in")
    got = A.split_json_arrays(spark, f"{tmpdir_path}/in", 4)
    assert got.pieces.where("element < 2").count() == 2 and got.problems().count() == 0
    assert seen == [False, False, True]  # the first window sorted the text as well
