"""Each operator against brute force on small tables: nulls, empty and long texts, ties, repeats, extra columns."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from civicflow.llm import (bpe, components, edit_counts, exact, neardup, pack, pii, pitman_yor, quality, urls, warc)
from civicflow.llm.common import ship, stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def _texts():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdeéßя'") for _ in range(rng.randint(1, 8))) for _ in range(400)]
    texts = [None, "", " \n\t", "one", "Äpfel und 中文 <|endoftext|> x", "a" * 3000, "tie tie tie tie"]
    base = [rng.choice(vocabulary) for _ in range(120)]
    texts += [" ".join(base), "  ".join(base) + "\n", " ".join(base[:60] + ["new"] + base[61:])]
    texts += [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 300))).capitalize() for _ in range(30)]
    texts.append("\n".join(["same line here"] * 5 + [" ".join(rng.choice(vocabulary) for _ in range(4000))]))
    return texts


TEXTS = _texts()


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    """Stored table with a null id, a repeated row, and columns named like the operators' own."""
    rows = [(i, t, "x", i) for i, t in enumerate(TEXTS)] + [(None, "null id", "x", 0), (7, TEXTS[7], "x", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, row long")
    path = str(tmp_path_factory.mktemp("docs") / "docs")
    df.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id < -1")


def _rows(df):
    return [r.asDict() for r in df.collect()]


def _library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe.VOCABULARY)


def _ids(text):
    return _library().encode(text or "", add_special_tokens=False).ids


# ---------------------------------------------------------------- 1, 6, 7: tokens

def test_bpe_equals_library(docs, none):
    rows = _rows(bpe.encode_decode(docs))
    assert len(rows) == docs.count() and bpe.encode_decode(none).count() == 0
    t = _library()
    by_id = dict(enumerate(TEXTS)) | {None: "null id"}
    for r in rows:
        ids = t.encode(by_id[r["doc_id"]] or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == ids and r["n_tokens"] == len(ids)
        assert r["decoded"] == t.decode(ids, skip_special_tokens=False)


def test_bpe_odd_characters():
    rng = random.Random(1)
    odd = [chr(i) for i in range(0x180)] + ["<|endoftext|>", "<|end", "ͮ", "Ⅷ", "²", "\u3000", "\U0001f600", "\u0558", "  "]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randint(0, 20))) for _ in range(3000)]
    v, t = bpe.vocabulary(bpe.VOCABULARY), _library()
    want = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    got = v.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == want
    assert [v.decode(x) for x in got] == t.decode_batch(want, skip_special_tokens=False)


@pytest.mark.parametrize("make", [bpe.Vocabulary, pack.RankVocabulary])
def test_forgetting_changes_nothing(make):
    v, t = make(bpe.VOCABULARY), _library()
    v.remember = 3
    for text in TEXTS[7:12] + ["aaaa", "aaaa b"]:
        assert np.frombuffer(v.encode([text])[0], "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_batches_are_bounded_by_bytes(spark):
    conf = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(conf)
    try:
        spark.conf.set(conf, "7m")
        ship(spark)
        assert spark.conf.get(conf) == "7m"  # the session's own bound stays
        spark.conf.unset(conf)
        ship(spark)

        def sizes(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])

        long = spark.range(9000, numPartitions=1).select(F.repeat(F.lit("x"), 2000).alias("text"))
        assert max(r["n"] for r in long.mapInArrow(sizes, "n long").collect()) <= 2200
    finally:
        spark.conf.set(conf, before)


def test_rank_vocabulary_equals_library():
    rng = random.Random(2)
    odd = [chr(i) for i in range(0x180)] + ["<|endoftext|>", "<|end", "ͮ", "Ⅷ", "\u3000", "\U0001f600", "\u0558", "  ", "中", "\x1c\x1f"]
    texts = TEXTS[:7] + ["".join(rng.choice(odd) for _ in range(rng.randint(0, 20))) for _ in range(2000)]
    texts += ["a" + c * 6000 + "b" for c in (" ", "\n", "x", "!", "\u3000")]
    v, t = pack.RankVocabulary(bpe.VOCABULARY), _library()
    texts = [x or "" for x in texts]
    want = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in v.encode(texts)] == want
    long = " " * 2_000_000 + "x"  # beyond what tiktoken's pattern engine can hold
    assert np.frombuffer(v.encode([long])[0], "<u4").tolist() == t.encode(long, add_special_tokens=False).ids


def test_pack_ranks_without_a_broadcast(spark, docs):
    """Many blocks, one hot length; counts joined by shuffle place every piece as well."""
    many = docs.select("doc_id", "text").unionByName(
        spark.range(3000, numPartitions=17).select((F.col("id") + 10_000).alias("doc_id"), F.lit("one two three").alias("text")))
    cut = stored(pack.pieces(many, numbered=True), "pack_test")
    assert cut.select("_block").distinct().count() > 8
    out = pack.assign(cut, broadcast_counts=0)
    rows = _rows(out)
    assert len(rows) == cut.count() and set(out.columns) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    places = collections.defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 1024


def test_edit_counts_equal_full_encoding(docs, none):
    rows = _rows(edit_counts.apply_edits(edit_counts.trees(docs), edit_counts.sample_edits(F.col("text"))))
    t = _library()
    for r in rows:
        assert r["n_tokens"] == len(t.encode(r["text"], add_special_tokens=False).ids)
    assert edit_counts.trees(none).count() == 0
    same = _rows(edit_counts.apply_edits(edit_counts.trees(docs), F.lit(None).cast("array<struct<at:int,delete:int,insert:string>>")))
    assert all(r["n_tokens"] == r["before"] and r["encoded"] == 0 for r in same)


def test_edits_anywhere():
    rng = random.Random(5)
    v = bpe.vocabulary(bpe.VOCABULARY)
    letters = "ab 1'stre  \n.,éß中Ⅷ"
    for _ in range(300):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 400)))
        tree = edit_counts.build(v, text)
        for _ in range(4):
            insert = "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 30, 300])))
            text, tree, _ = edit_counts.edit(v, text, tree, rng.randint(0, len(text) + 3), rng.choice([0, 1, 2, 50]), insert)
            whole = edit_counts.build(v, text)
            assert whole.pairs() == tree.pairs() and whole.n_tokens == tree.n_tokens


def test_edits_of_a_block_are_encoded_together():
    rng = random.Random(6)
    v = bpe.Vocabulary(bpe.VOCABULARY)
    tokens, calls = v._tokens, []
    v._tokens = lambda words: calls.append(len(words)) or tokens(words)
    texts = ["".join(rng.choice("ab 1'stre  \n.,éß中Ⅷ") for _ in range(n)) for n in [0, 1, 40, *[500] * 40, 40_000]]
    texts += ["one <|endoftext|> two", "\U0001cc00 x"]
    docs = [(t, edit_counts.build(v, t), rng.randint(0, len(t)), rng.choice([0, 3]), rng.choice(["", f" new{i} word", "<|endoftext|>"]))
            for i, t in enumerate(texts)]
    calls.clear()
    for remember in (v.remember, 3):
        v.remember = remember
        out = edit_counts.edit_each(v, docs)
        for (t, _, at, delete, insert), (new, tree, _) in zip(docs, out, strict=True):
            assert new == t[:at] + insert + t[at + delete:]
            assert tree.n_tokens == len(_ids(new)) and tree.pairs() == edit_counts.build(v, new).pairs()
        docs = [(new, tree, rng.randint(0, len(new)), 2, f"x{i}") for i, (new, tree, _) in enumerate(out)]
        assert remember == 3 or calls[0] > 20 and len(calls) <= 1 + len(docs)  # one for all edits, then the test's own


def test_counted_tokens_equal_encoded_ones():
    rng = random.Random(7)
    v = bpe.Vocabulary(bpe.VOCABULARY)
    letters = "aaabeest hrn19.,\n\x00éß中Ⅷ"
    words = {"", "a", "<|endoftext|>", "a" * 8, "a" * 33, "the" * 5, *map(chr, range(1, 256))}
    words |= {"".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(4000)}
    words |= {" " + "".join(rng.choice(["th", "ing", "er", "on", "re"]) for _ in range(rng.randint(1, 9))) for _ in range(2000)}
    v.measure(words)
    v.learn(words)
    assert v.sizes == {p: len(ids) >> 2 for p, ids in v.ids.items()}
    assert max(len(p.encode()) for p in words) > max(bpe.WIDTHS)
    v._merge = lambda words: iter([b""] * len(list(words)))  # short words do not need the index
    v.sizes.clear()
    v.measure(["there", "a" * 32])
    assert v.sizes == {p: len(_ids(p)) for p in ("there", "a" * 32)}


def test_an_edit_leaves_other_leaves_alone():
    v = bpe.vocabulary(bpe.VOCABULARY)
    text = "a few words, " * 2000
    tree = edit_counts.build(v, text)
    before = list(tree.leaves)
    _, after, encoded = edit_counts.edit(v, text, tree, len(text) // 2, 3, " edited")
    assert len(after.leaves) == len(before) and encoded < 10
    assert sum(not np.shares_memory(a, b) for a, b in zip(before, after.leaves, strict=True)) <= 2


def test_documents_with_different_numbers_of_edits(spark):
    rows = [(0, "one two three", []), (1, None, [(0, 0, "new")]), (2, "x <|endoftext|> y", [(3, 2, None), (None, 1, "é")]), (3, "", None),
            (4, "some more words here", [(4, 1, ""), (2, None, "  "), (99, 9, "end"), (0, 99, ""), (0, 0, "again")])]
    schema = "doc_id long, text string, edits array<struct<at:int,delete:int,insert:string>>"
    df = spark.createDataFrame(rows, schema).coalesce(1)
    kept = edit_counts.trees(df).join(df.select("doc_id", "edits"), "doc_id")
    out = {r["doc_id"]: r for r in _rows(edit_counts.apply_edits(kept, F.col("edits")))}
    for key, text, edits in rows:
        new = text or ""
        for at, delete, insert in edits or ():
            at, delete = min(at or 0, len(new)), delete or 0
            new = new[:at] + (insert or "") + new[at + delete:]
        r = out[key]
        tree = edit_counts.build(bpe.vocabulary(bpe.VOCABULARY), new)
        assert (r["text"], r["n_tokens"], r["before"]) == (new, len(_ids(new)), len(_ids(text)))
        assert list(zip(np.frombuffer(r["lengths"], "<u4").tolist(), np.frombuffer(r["counts"], "<u4").tolist(), strict=True)) == tree.pairs()


def test_pack_is_gapless_and_complete(docs, none):
    rows = _rows(pack.pack(docs))
    by_id = dict(enumerate(TEXTS)) | {None: "null id"}
    places, seen = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        ids = (_ids(by_id[r["doc_id"]]) + [2])[r["start"]:r["start"] + r["length"]]
        assert len(ids) == r["length"] and zlib.crc32(np.array(ids, "<u4").tobytes()) == r["ids_crc32"]
        assert r["piece"] == 0 or r["length"] == 1024
        places[r["sequence_id"]].append((r["offset"], r["length"]))
        seen[r["doc_id"]].append(r["length"])
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 1024
    for i, t in enumerate(TEXTS):
        assert sum(seen[i]) == (len(_ids(t)) + 1) * (2 if i == 7 else 1)
    assert pack.pack(none).count() == 0


@pytest.mark.parametrize("low,high,n", [(1, 1024, 3000), (250, 520, 900), (500, 1024, 400), (300, 400, 90)])
def test_bin_completion_uses_every_piece_once(low, high, n):
    lengths = np.random.default_rng(n).integers(low, high + 1, n)
    counts = np.bincount(lengths, minlength=1025)
    plan = pack.complete(counts, 1024)
    used = np.zeros(1025, int)
    for times, pieces in plan:
        assert sum(pieces) <= 1024
        for s in pieces:
            used[s] += times
    assert (used == counts).all()
    assert -(-lengths.sum() // 1024) <= pack.bins(plan) <= pack.bins(pack.best_fit(counts, 1024))


def test_bin_completion_beats_best_fit():
    counts = np.bincount([6, 4, 3, 3, 2, 2], minlength=11)  # 6+4 | 3+3+2+2
    assert pack.bins(pack.complete(counts, 10)) == 2


def test_search_improves_a_plan_of_many_patterns():
    lengths = np.random.default_rng(0).lognormal(np.log(400), 0.6, 100_000).astype(int).clip(1, 1024)
    counts = np.bincount(lengths, minlength=1025)
    first = pack.best_fit(counts, 1024)
    assert len(first) > 1000  # a dive takes a filling for each
    assert pack.lower_bound(counts, 1024) <= pack.bins(pack.complete(counts, 1024)) < pack.bins(first)


@pytest.mark.parametrize("lengths,size,least", [([6, 4, 3, 3, 2, 2], 10, 2), ([4] * 6, 10, 3), ([5, 5, 5], 10, 2), ([6, 6, 6], 10, 3), ([3] * 7, 10, 3)])
def test_lower_bound(lengths, size, least):
    counts = np.bincount(lengths, minlength=size + 1)
    assert pack.lower_bound(counts, size) <= least == pack.bins(pack.complete(counts, size))


def test_pack_dives_compare_no_fillings(monkeypatch):
    """A dive takes the first filling only, so it need not know which of the others are dominated."""
    rng = np.random.default_rng(7)
    for _ in range(60):
        counts = np.bincount(rng.integers(1, 41, rng.integers(1, 30)), minlength=41)
        every = pack.fillings(counts, 40, few=12)
        assert [pack.fillings(counts, 40, few=12, most=k) for k in (1, 2, 4)] == [every[:k] for k in (1, 2, 4)]
    calls, real = [], pack._dominates
    monkeypatch.setattr(pack, "_dominates", lambda a, b: calls.append(1) or real(a, b))
    counts = np.bincount(np.clip(rng.lognormal(6, 0.8, 20_000), 1, 1024).astype(int), minlength=1025)
    assert pack.bins(pack.complete(counts, 1024)) <= pack.bins(pack.best_fit(counts, 1024))
    assert len(calls) < 200_000  # every filling of every dive was compared: some millions of times


# ---------------------------------------------------------------- 2: urls

def test_host_path_and_rules(spark):
    cases = [("HTTP://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
             ("http://a.net", "a.net", "", None, None), ("http://x.net/?u=http://b.org/fr/", "x.net", "/", "net/", "block"),
             ("nothing", "", "", None, None), (None, "", "", None, None), ("", "", "", None, None),
             ("x://notexample.com/de/1", "notexample.com", "/de/1", None, None),
             ("x://example.com/de/1://y", "example.com", "/de/1://y", "example.com/de/", "block"),
             ("x://É.Org/fr/", "É.org", "/fr/", "org/fr/", "allow")]
    pages = spark.createDataFrame([(i, c[0], "html", "h") for i, c in enumerate(cases)] + [(None, "x://a.net/", "", "h")],
                                  "page_id long, url string, html string, host string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: r for r in _rows(urls.judge_urls(pages, labels))}
    assert len(got) == len(cases) + 1
    for i, (_, host, path, rule, verdict) in enumerate(cases):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] == (verdict or "allow")  # without labels every mean is one half
    assert urls.judge_urls(pages.limit(0), labels).count() == 0


def test_bad_host_is_blocked_and_small_one_shrinks(spark):
    pages = [(i, "x://bad.example.com/") for i in range(60)] + [(i, "x://good.example.com/") for i in range(60, 200)] + [(200, "x://new.example.com/")]
    labels = [(i, int(i >= 60), 0) for i in range(200)] + [(200, 0, 0), (None, 1, 0), (3, None, 0)]
    out = _rows(urls.judge_urls(spark.createDataFrame(pages, "page_id long, url string"),
                                spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rules=()))
    verdict = {r["host"]: r["verdict"] for r in out}
    mean = {r["host"]: r["mean"] for r in out}
    assert verdict == {"bad.example.com": "block", "good.example.com": "allow", "new.example.com": "allow"}
    assert mean["bad.example.com"] < mean["new.example.com"] < mean["good.example.com"]


# ---------------------------------------------------------------- 3: quality

def _counts(text):
    text = text or ""
    w = WORD.findall(text)
    grams = collections.Counter(zip(w, w[1:], w[2:]))
    hit = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)]


def test_statistics(docs):
    by_id = dict(enumerate(TEXTS)) | {None: "null id"}
    for r in _rows(quality.statistics(docs)):
        assert [r[c] for c in quality.BASE] == _counts(by_id[r["doc_id"]])


def test_trees_learn_and_are_monotone():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3)).astype(np.float32)
    y = ((x[:, 0] < 0.5) ^ (rng.random(3000) < 0.05)).astype(float)
    trees = quality.fit(x[:2000], y[:2000], [-1, 0, 0])
    assert ((trees.score(x[2000:]) > 0.5) == (y[2000:] > 0.5)).mean() > 0.9
    line = np.tile(x[:1], (200, 1))
    line[:, 0] = np.linspace(-1, 2, 200)
    assert (np.diff(trees.score(line)) <= 1e-12).all()
    assert (quality.fit(x, np.ones(3000), [0, 0, 0]).score(x) > 0.99).all()


def test_quality_rows_and_pipeline_stage(docs, none, spark):
    labels = spark.createDataFrame([(8, 1), (9, 0), (8, 1), (None, 1), (10, None)], "doc_id long, quality int")
    rows = _rows(quality.quality(docs, labels))
    assert len(rows) == docs.count()
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in rows)
    assert quality.quality(none, labels).count() == 0


# ---------------------------------------------------------------- 4, 10: duplicates

def _shingles(text, size):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def _brute_groups(texts, size):
    sets, parent = [_shingles(t, size) for t in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return sets, [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("size", [2, 5])
def test_near_groups_equal_brute_force(spark, docs, none, size, tmp_path):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = list(TEXTS)
    for _ in range(4):  # families whose copies drift, so that similarities fall on both sides of the bound
        base = [rng.choice(vocabulary) for _ in range(100)]
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.randint(0, 12)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    path = str(tmp_path / "t")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4).write.parquet(path)
    sets, want = _brute_groups(texts, size)
    rows = _rows(neardup.near_groups(spark.read.parquet(path), size=size))
    assert {r["doc_id"]: r["component_id"] for r in rows} == dict(enumerate(want))
    assert all(r["n_shingles"] == len(sets[r["doc_id"]]) and r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    if size == 5:
        assert neardup.near_groups(none).count() == 0
        rows = _rows(neardup.near_groups(docs))  # a null id and a repeated row
        assert len(rows) == docs.count() and sum(r["stays"] for r in rows if r["doc_id"] == 7) == 1
        assert neardup.drop_near_copies(docs).columns == docs.columns


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(5, 5), (39, 3), (3, 39)]
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 100 for i in range(100, 161)} | {i: 3 for i in [3, 7, *range(8, 40)]}


@pytest.mark.parametrize("digest_bytes", [32, 1])
def test_exact_groups(docs, none, digest_bytes):
    by_id = list(enumerate(TEXTS)) + [(None, "null id"), (7, TEXTS[7])]
    groups = collections.defaultdict(list)
    for i, t in by_id:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0))
    rows = _rows(exact.exact_dedup(docs, exact.incoming_half(), digest_bytes=digest_bytes))
    assert len(rows) == len(by_id) and sum(r["kept"] for r in rows) == len(groups)
    for r in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", dict(by_id)[r["doc_id"]] or "")
        assert r["text_sha256"] == hashlib.sha256(norm.encode()).hexdigest()
        assert r["group_size"] == len(groups[norm])
        best = min(groups[norm])
        assert r["keep_id"] == (None if best[1] else best[2])
    if digest_bytes == 32:
        left = exact.drop_copies(docs)
        assert left.columns == docs.columns and left.count() == len(groups)
        assert exact.exact_dedup(none, exact.incoming_half()).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 10, 500, 20000])
def test_fuse_filter(n):
    rng = np.random.default_rng(n)
    keys, others = rng.integers(0, 2**63, n, dtype=np.uint64), rng.integers(0, 2**63, 50000, dtype=np.uint64)
    f = exact.FuseFilter.build(np.concatenate([keys, keys]))
    assert f.probe(keys).all() and f.probe(others).mean() < 0.001


# ---------------------------------------------------------------- 5: language model

def test_language_model(docs, none):
    rows = _rows(pitman_yor.score_documents(docs, contexts=5))
    by_id = dict(enumerate(TEXTS)) | {None: "null id"}

    def tokens(t):
        return [*WORD.findall((t or "").translate(LOWER)), None]

    def out(i):
        return zlib.crc32((str(i) if i is not None else "").encode()) % 10 == 0

    c = collections.Counter()
    for i, t in [*by_id.items(), (7, TEXTS[7])]:
        if not out(i):
            c.update(tokens(t))
    n, v = sum(c.values()), len(c)
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        t = tokens(by_id[r["doc_id"]])
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            out(r["doc_id"]), len(t), sum(c[x] > 0 for x in t), n)
        assert r["base_score"] == pytest.approx(sum(np.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t))
        assert r["score"] < 0
    assert pitman_yor.score_documents(none).count() == 0


def test_model_is_a_distribution_and_stirling_numbers():
    s = np.exp(pitman_yor.log_stirling(0.5, 4))
    assert s[3, 1:4] == pytest.approx([0.75, 1.5, 1.0])  # 3 customers: (1-d)(2-d), 3(1-d), 1
    rng = np.random.default_rng(1)
    w = np.arange(1, 301, dtype=np.uint64)
    row = np.repeat(np.arange(300), 2)
    n = rng.integers(1, 200, 600)
    direct = rng.integers(0, 5, 300)
    totals = pitman_yor.Totals(np.array([n[::2].sum(), n[1::2].sum()], float), np.array([300.0, 300.0]), direct.sum() + 600.0, 300.0, 300, 0.6, 0.5)
    for _ in range(6):  # passes with refreshed totals, as between the table-wide passes
        s = pitman_yor.Seating(w, direct + np.bincount(row, n, 300).astype(int), row, np.tile([0, 1], 300), n, totals)
        for k in range(3):
            s.sweep(k)
        totals = totals._replace(tables=np.bincount(s.ctx, s.tables, 2).astype(float), parent_customers=float(s.parent_customers.sum()),
                                 parent_tables=float(s.parent_tables.sum()))
    p, q = s.predictive()
    unknown = s.base / (pitman_yor.THETA + s.t.parent_customers)
    assert p.sum() + unknown == pytest.approx(1, abs=0.05)
    for k in (0, 1):
        back = (pitman_yor.THETA + s.t.discount * s.t.tables[k]) / (pitman_yor.THETA + s.t.customers[k])
        assert q[s.ctx == k].sum() + back * unknown == pytest.approx(1, abs=0.05)


def test_every_context_has_a_restaurant(spark, tmp_path):
    """Each of 150 words is followed by a word of its own in training; held out, that one is likelier than another."""
    held = [i for i in range(5000) if zlib.crc32(str(i).encode()) % 10 == 0]
    train = [i for i in range(5000) if zlib.crc32(str(i).encode()) % 10]
    rows = [(train[3 * i + k], f"a{i} b{i}") for i in range(150) for k in range(3)]
    rows += [(held[2 * i + k], f"a{i} b{(i + k) % 150}") for i in range(150) for k in range(2)]
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(2).write.parquet(path)
    score = {r["doc_id"]: r["score"] for r in _rows(pitman_yor.score_documents(spark.read.parquet(path)))}
    assert all(score[held[2 * i]] > score[held[2 * i + 1]] + 1 for i in range(150))
    assert all(score[train[3 * i]] == pytest.approx(score[held[2 * i]]) for i in range(150))  # the same text, in and out of training


def test_language_model_packs_pairs(spark, tmp_path, monkeypatch):
    """20,000 pairs and as many words, most met once: nothing stored has a row for each, whatever the number of cells and blocks."""
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{x}" for x in np.minimum(rng.integers(0, 40000, 100), rng.integers(0, 40000, 100) ** 2))) for i in range(200)]
    rows += [(7, rows[7][1]), (None, "the the the"), (1000, None), (1001, "the end")]
    path, kept = str(tmp_path / "t"), []
    spark.createDataFrame(rows, "doc_id long, text string").repartition(2).write.parquet(path)
    store = pitman_yor.stored
    monkeypatch.setattr(pitman_yor, "stored", lambda df, name: kept.append(store(df, name)) or kept[-1])

    def scored():
        return sorted(tuple(r) for r in _rows(pitman_yor.score_documents(spark.read.parquet(path)).fillna(-1)))

    one = scored()
    assert len(one) == len(rows) and kept and all(k.count() < 100 for k in kept)
    monkeypatch.setattr(pitman_yor, "BLOCK_DOCS", 20)
    monkeypatch.setattr(pitman_yor, "CELL_BYTES", 20_000)
    assert scored() == one
    assert all(k.count() < 2000 for k in kept)


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_packed_arrays(n):
    rng = np.random.default_rng(n)
    any_, small, zero = rng.integers(0, 2**64, n, dtype=np.uint64), rng.integers(0, 300, n), np.zeros(n, np.int64)
    sent = [any_, np.sort(any_), small, np.sort(small), zero]
    got = pitman_yor.unpack(pitman_yor.pack(*sent))
    assert len(got) == 5 and all((a.astype(np.uint64) == b).all() for a, b in zip(sent, got))


def test_held_out_perplexity_beats_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = {r["held_out"]: r for r in _rows(pitman_yor.perplexity(pitman_yor.score_documents(docs)))}
    assert out[True]["perplexity"] < out[True]["base_perplexity"]


# ---------------------------------------------------------------- 8: WARC

def test_warc_round_trip(spark, tmp_path):
    html = [None, "", "é" * 50, "same", "same", "x\x1f\x8b\x08y", "<html>" + "long " * 30000, "same"]
    rows = [(i, f"http://h/{i}\r\n", h, "c") for i, h in enumerate(html)] + [(None, None, "same", "c"), (3, "u", "same", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_type string").repartition(3)
    got = _rows(warc.round_trip(pages, split=100))
    assert len(got) == len(rows)
    for r in got:
        h = ("same" if r["page_id"] is None else html[r["page_id"]] or "").encode()
        first = {b"": 0, b"same": 3}.get(h, r["page_id"])
        assert r["payload_digest"] == warc.payload_digest(h) and r["payload_bytes"] == len(h)
        assert r["record_type"] == ("response" if first == r["page_id"] else "revisit")
        assert r["refers_to"] == (None if first == r["page_id"] else first)
        assert r["payload"] is None if r["record_type"] == "revisit" else bytes(r["payload"]) == h
    assert all(r["record_type"] == "response" for r in _rows(warc.round_trip(pages, min_bytes=10**9)))
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_false_magic_is_no_record():
    import io

    data = warc.record(1, "u", "D", 3, None, b"abc")
    junk = b"\x1f\x8b\x08\x00junk" + zlib.compress(b"WARC/1.1")
    raw = junk + data + b"\x1f\x8b\x08" + data
    w = warc._Window(io.BytesIO(raw), len(raw))
    assert [(o, n) for o, _, _, n in warc.scan_range(w, 0, len(raw))] == [(len(junk), len(data)), (len(junk) + len(data) + 3, len(data))]
    assert [o for o, *_ in warc.scan_range(w, len(junk) + 1, len(raw))] == [len(junk) + len(data) + 3]


def test_url_longer_than_a_read(spark):
    long = random.Random(2).randbytes(1_500_000).hex()
    pages = spark.createDataFrame([(1, "http://a/", "x"), (2, "data:" + long, "y"), (3, "http://b/", "z")], "page_id long, url string, html string")
    got = {r["page_id"]: (r["url"], bytes(r["payload"])) for r in _rows(warc.round_trip(pages.coalesce(1), split=1 << 18))}
    assert got == {1: ("http://a/", b"x"), 2: ("data:" + long, b"y"), 3: ("http://b/", b"z")}


def test_missing_record_fails(spark, tmp_path):
    data = [warc.record(i, "u", "D", 3, None, b"abc") for i in range(3)]
    (tmp_path / "a.warc.gz").write_bytes(data[0] + b"\0" * len(data[1]) + data[2])
    size = sum(map(len, data))
    starts = [0, len(data[0]), len(data[0]) + len(data[1])]
    manifest = spark.createDataFrame([(str(tmp_path / "a.warc.gz"), size, 3, starts)], "path string, bytes long, records long, starts array<long>")
    with pytest.raises(Exception, match="2 records read, 3 written"):
        warc.read_archives(manifest).collect()


# ---------------------------------------------------------------- 9: surrogates

PRIVATE = ("Mr John Smith wrote to und.34@mail7.example.com; Mrs. Smith to UND.34@MAIL7.EXAMPLE.COM. Call +1 (017) 555-7713 or "
           "4111 1111 1111 1111, 4111111111111111, 97.51.17.173, token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" and 078-05-1120")


def test_surrogates_keep_type_format_and_coreference(spark):
    rows = [(1, PRIVATE, 5), (2, "again und.34@mail7.example.com and 4111-1111-1111-1111", 5), (3, None, 5), (4, "", 5),
            (5, "The GNU General Public License, version 3. CC BY-NC 4.0", 5), (None, PRIVATE, 5), (1, PRIVATE, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_entities long")
    out = pii.replace_all(docs)
    assert out.columns == docs.columns
    got = collections.defaultdict(list)
    for r in _rows(out):
        got[r["doc_id"]].append(r["text"])
    assert got[3] == [None] and got[4] == [""] and got[5] == [rows[4][1]] and got[1][0] == got[1][1] == got[None][0]
    text = got[1][0]
    for a, z, _, value in pii.detect(PRIVATE):
        assert PRIVATE[a:z] not in text, value
    emails = re.findall(r"[\w.]+@[\w.]+\.\w+", text, re.I)
    assert emails[0] == emails[1].lower() and emails[1].isupper() and emails[0] in got[2][0]
    assert re.fullmatch(r"[a-z]{3}\.\d\d@[a-z]{4}\d\.example\.com", emails[0])
    assert re.search(r"\+\d \(\d{3}\) \d{3}-\d{4}", text) and re.search(r'token = "[0-9a-f]{40}"', text)
    card = re.search(r"(\d{4}) (\d{4}) (\d{4}) (\d{4}), (\d{16})", text).groups()
    assert "".join(card[:4]) == card[4] and "-".join(card[:4]) in got[2][0]
    assert int(card[4][-1]) == pii.luhn(card[4][:-1])
    names = re.search(r"Mr (\w+) (\w+) wrote .*Mrs\. (\w+) to", text).groups()
    assert names[1] == names[2] and names[0].endswith("rn")
    assert pii.replace_all(docs.limit(0)).count() == 0


def test_permutation_is_one_to_one_and_collisions_are_redrawn(spark):
    s = pii.Surrogates(b"k")
    assert len({tuple(s.permute([i // 10, i % 10, 0], [10, 10, 1], "x")) for i in range(100)}) == 100
    values = [f"{i:02}" for i in range(40)]
    entities = spark.createDataFrame([("few", v) for v in values], "kind string, value string")

    def small(kind, value, n, s):  # two digits from a space of 300, many collisions at first
        return str(s._number(kind, value, n) % 300)

    again = {r["value"]: r["draw"] for r in pii.redraws(entities, b"k", small).collect()}
    final = [small("few", v, again.get(v, 0), s) for v in values]
    assert again and len(set(final)) == len(values) and not set(final) & set(values)


def test_many_redraws_are_joined(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"Mr Abc{chr(97 + i % 26)} Def{chr(97 + i % 7)} here") for i in range(40)] + [(None, None)], "doc_id long, text string")
    a = {(r["doc_id"], r["text"]) for r in _rows(pii.replace_all(docs))}
    monkeypatch.setattr(pii, "INLINE_REDRAWS", -1)
    assert {(r["doc_id"], r["text"]) for r in _rows(pii.replace_all(docs))} == a


def test_more_entities_than_values_of_their_format(spark):
    rows = [("name/family/n/latin", f"name{i:x}") for i in range(60_000)]  # three syllables make 46,656
    rows += [("email", f"{i}@mail.example") for i in range(10)] + [("secret", "********"), ("secret", "-------1")]
    entities = spark.createDataFrame(rows, "kind string, value string")
    again = {(r["kind"], r["value"]): r["draw"] for r in pii.redraws(entities, b"k").collect()}
    s = pii.Surrogates(b"k")
    final = [(k, s.canonical(k, v, again.get((k, v), 0))) for k, v in rows]
    assert len(set(final)) == len(rows) and not set(final) & set(rows)


@pytest.mark.parametrize("phone", ["(743)555-3824", "(743)5553824", "+1(743)555-3824", "+44 20 7946 0958", "+33 1 23 45 67 89", "+49 30 12345678",
                                   "+44 (0)20 7946 0958", "+91 98765 43210", "+33.1.23.45.67.89", "+1-743-555-3824", "+442079460958"])
def test_phones_of_other_formats(phone):
    text = f"Write or call {phone}, any day."
    (found,) = pii.detect(text)
    assert text[found[0]:found[1]] == phone and found[2:] == ("phone", re.sub(r"\D", "", phone))
    new = pii.Surrogates(b"k").render("phone", phone, pii.Surrogates(b"k").canonical(*found[2:]))
    assert new != phone and re.sub(r"\d", "0", new) == re.sub(r"\d", "0", phone)


def test_plain_digits_are_a_phone_where_a_word_says_so():
    for text in ("Tel. 7435553824", "phone: 17435553824", "call me at 7435553824"):
        assert [f[2] for f in pii.detect(text)] == ["phone"]
    for text in ("id 7435553824", "at 1700000000 ms", "+0.123456789", "+1.23456789", "f(x)(2)34", "a + 12 345"):
        assert not pii.detect(text)


def test_registered_domains(spark):
    want = {"a.b.com.mx": ("com.mx", "b.com.mx"), "com.mx": ("com.mx", "com.mx"), "www.gov.uk": ("gov.uk", "www.gov.uk"),
            "me.github.io": ("github.io", "me.github.io"), "x.y.s3.amazonaws.com": ("s3.amazonaws.com", "y.s3.amazonaws.com"),
            "b.s3-website.us-east-1.amazonaws.com": ("s3-website.us-east-1.amazonaws.com", "b.s3-website.us-east-1.amazonaws.com"),
            "www.example.com": ("com", "example.com"), "xcom.mx": ("mx", "xcom.mx"), "localhost": ("localhost", "localhost"),
            "10.0.0.1": ("10.0.0.1", "10.0.0.1"), "": ("", ""), "a.b.c.test": ("c.test", "b.c.test")}
    rows = spark.createDataFrame([(h,) for h in want], "host string")
    suffix = urls.suffix_of(F.col("host"), [*urls.SUFFIXES, "c.test"])
    got = {r["host"]: (r["s"], r["d"]) for r in rows.select("host", suffix.alias("s"), urls.domain_of(F.col("host"), suffix).alias("d")).collect()}
    assert got == want
