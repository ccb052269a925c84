"""Operators 11 to 13 against brute force: nulls, empty and long texts, ties, repeats, extra columns, empty tables."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from civicflow.llm import conversations as C
from civicflow.llm import components, fim, simhash

# ---------------------------------------------------------------- 11: fill in middle

FIM_TEXTS = [None, "", "a", "ab", "é😀\U0001f468‍\U0001f469́ 中\n\r \0x", "$1\\E.{2}", "holds <S> itself", "<", "<P", "a<" * 40,
             "<<<", "x" * 4096, "😀" * 4097, "long " * 60_000, "tail\n", "\n"] + [f"text number {i} < {i * i}" for i in range(60)]


def fim_by_hand(key, text, marks=("<P>", "<S>", "<M>")):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(text)
    if not text or any(m in text for m in marks) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, marks[1] + s + marks[0] + p + marks[2] + m
    return n, "psm", a, b - a, marks[0] + p + marks[1] + s + marks[2] + m


@pytest.mark.parametrize("marks", [("<P>", "<S>", "<M>"), ("$1\\E", ".*", "[q")])
def test_fim(spark, marks):
    data = [(i, t, "own", i) for i, t in enumerate(FIM_TEXTS)] + [(None, "null key", "own", 0), (3, FIM_TEXTS[3], "own", 0)]
    docs = spark.createDataFrame(data, "doc_id long, text string, form string, n int")
    out = fim.transform(docs, marks=marks).withColumn("back", fim.restore(F.col("output"), F.col("form"), marks))
    got = sorted(tuple(r) for r in out.na.fill(-1, ["doc_id"]).collect())
    want = sorted((-1 if k is None else k, *fim_by_hand(k, t, marks), t or "") for k, t, *_ in data)
    assert [tuple(x if x is not None else -1 for x in r) for r in got] == [tuple(x if x is not None else -1 for x in r) for r in want]
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert fim.transform(docs.where("n < 0")).count() == 0


def test_fim_marks_must_be_found_again():
    for marks in (("", "<S>", "<M>"), ("<P>", "<P>", "<M>"), ("<P>", "x<P>", "<M>"), ("aba", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fim.transform(None, marks=marks)


# ---------------------------------------------------------------- 12: conversations

FITS = re.compile("(s?(ua)+)?")


def damaged(rows):
    """Rows (conv, turn, role, text) by conversation after damage, in order."""
    out = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        fate = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        here = out.setdefault(conv, [])
        if fate:
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fate, text)
            here += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    for here in out.values():
        here.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def repaired_by_hand(here):
    """Every sequence of edits within a bound is tried; the cheapest, then least, wins."""
    marks, seen = [], set()
    for _, role, text in here:
        bare = text.strip(" \t\n\x0b\x0c\r")
        marks.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    best = None
    def go(i, cost, audit, lines, roles):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(here) and FITS.fullmatch(roles):
            best = min(best or (cost, audit, lines), (cost, audit, lines))
        if audit[-2:] != "II":
            for role in ("user", "assistant"):
                if not roles.endswith(role[0]):
                    go(i, cost + 5, audit + "I", [*lines, f"{role}:"], roles + role[0])
        if i < len(here):
            _, role, text = here[i]
            go(i + 1, cost + 2, audit + "D", lines, roles)
            if marks[i] not in ("blank", "duplicate"):
                extra = 5 if marks[i] == "truncated" else 0
                go(i + 1, cost + extra, audit + "K", [*lines, f"{role}:{text}"], roles + (role[:1] or "?"))
                for new in ("user", "assistant"):
                    go(i + 1, cost + 1 + extra, audit + "R", [*lines, f"{new}:{text}"], roles + new[0])
    best = (2 * len(here), "D" * len(here), [])
    go(0, 0, "", [], "")
    turns = [t for t, *_ in here if t is not None]
    pairs = ["".join(r[1][:1] for r in pair) for pair in itertools.pairwise(here)]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(marks.count(m) for m in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), best[0], best[1], hashlib.sha256("\n".join(best[2]).encode()).hexdigest())


def conversation_rows():
    rng = random.Random(5)
    rows = []
    for conv in [*range(60), None, -4]:
        for turn in range(rng.randint(0, 6)):
            role = rng.choice(["user", "assistant", "system", "user", "assistant", None, "", "tool", "User"])
            text = rng.choice(["Fine.", "Fine.", "No end", "", None, " \n", "Ends! \t\n", "Ü? ", "a.b", "x" * 2000 + "."])
            rows.append((conv, rng.choice([turn, turn, turn, 2 * turn, None]), role, text))
    return rows + [rows[0], rows[-1], (7, None, None, None)]


def test_conversations(spark):
    rows = conversation_rows()
    df = spark.createDataFrame([(*r, "own") for r in rows], "conv_id long, turn long, role string, text string, fault string")
    got = {r[0]: tuple(r)[1:] for r in C.repair(C.damage(df)).collect()}
    want = {conv: repaired_by_hand(here) for conv, here in damaged(rows).items()}
    assert got == want
    assert {"D", "K", "R"} <= set("".join(r[6] for r in got.values()))  # at these costs deleting is always cheaper than inserting
    assert C.repair(C.damage(df.where("conv_id < -9"))).count() == 0


def test_conversation_across_batches_and_spills(spark):
    """One conversation of many rows in batches of 7, with back pointers of 3 rows in memory, equals the plain walk."""
    rng = random.Random(8)
    rows = [(1, t, rng.choice(["user", "assistant", "user"]), rng.choice(["Yes.", f"no {t}", f"Well {t}!"])) for t in range(400)]
    rows += [(2, t, "user", f"same {t}.") for t in range(301)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = sorted(map(tuple, C.repair(C.damage(df)).collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert sorted(map(tuple, C.repair(C.damage(df), spill_rows=3).collect())) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_programme_against_strings():
    """The ranks choose as a programme over whole strings does, on long random rows."""
    rng = random.Random(11)
    for _ in range(40):
        rows = [(rng.choice("suat"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randint(1, 40))]
        layer = {0: (0, "")}
        for initial, fault in rows:
            after = {}
            for p, (cost, audit) in layer.items():
                for k in range(3):
                    q = p
                    for _ in range(k):
                        q = 3 if q == 2 else 2
                    moves = [("D", q, 2)]
                    if fault in (0, 3):
                        extra = 5 * (fault == 3)
                        moves.append(("R", 3 if q == 2 else 2, 1 + extra))
                        if initial == "s" and q == 0 or initial == "u" and q != 2 or initial == "a" and q == 2:
                            moves.append(("K", {"s": 1, "u": 2, "a": 3}[initial], extra))
                    for letter, to, price in moves:
                        new = (cost + 5 * k + price, audit + "I" * k + letter)
                        after[to] = min(after.get(to, new), new)
            layer = after
        ends = [layer[q] for q in (0, 3) if q in layer]
        ends += [(layer[2][0] + 5, layer[2][1] + "I")] if 2 in layer else []
        ends += [(layer[1][0] + 10, layer[1][1] + "II")] if 1 in layer else []
        one = C.Repair(spill_rows=4)
        for initial, fault in rows:
            one.add(None, initial, "x", fault)
        assert one.result()[5:7] == min(ends)


# ---------------------------------------------------------------- 13: SimHash

def fingerprint_by_hand(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    words = [re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), w) for w in words]
    if not words:
        return 0
    grams = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(fps, keys, distance=4):
    group = list(range(len(fps)))
    def root(x):
        while group[x] != x:
            x = group[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                group[root(i)] = root(j)
    least = {}
    for i, k in enumerate(keys):
        if k is not None:
            least[root(i)] = min(least.get(root(i), k), k)
    return [least.get(root(i)) for i in range(len(fps))]


def simhash_texts():
    rng = random.Random(9)
    words = ["".join(rng.choice("abcÄß😀") for _ in range(rng.randint(1, 6))) for _ in range(50)]
    texts = [None, "", " \t", "One", "one", "ONE two", "É é", "a b c", "a b c d", "A\x0bB\x0cc  d\n", "x" * 5000 + " y z w v", "no break"]
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randint(4, 400))]
        texts += [" ".join(base), " ".join([*base[:-1], "changed"]), "  ".join(base[1:])]
    return texts + [" ".join(rng.choice(words) for _ in range(30_000))]


def test_simhash(spark):
    texts = simhash_texts()
    data = [(i + 5, t, "own", 1) for i, t in enumerate(texts)] + [(None, "a lone null key", "own", 1), (None, "", "own", 1), (8, texts[3], "own", 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, fp string, component_id int").repartition(3)
    path = C.tempfile.mkdtemp(prefix="civicflow-test-", dir="/tmp") + "/docs"
    docs.write.parquet(path)
    out = simhash.simhash_groups(spark.read.parquet(path))
    key = lambda r: tuple((x is not None, x) if x is not None else (False, 0) for x in r)
    fps = [fingerprint_by_hand(t) for _, t, *_ in data]
    want = [(k, f"{f:016x}", c) for (k, *_), f, c in zip(data, fps, components_by_hand(fps, [d[0] for d in data]), strict=True)]
    assert sorted(map(tuple, out.collect()), key=key) == sorted(want, key=key)
    assert simhash.simhash_groups(spark.read.parquet(path).where("doc_id < 0")).count() == 0


def test_simhash_broadcasts_by_counts_only(spark, monkeypatch):
    """Spark took the probed keys for as few bytes as the nodes and broadcast them where the crowds' keys were too many to be."""
    rng = np.random.default_rng(4)
    fps = np.unique(rng.integers(0, 2**14, 800, dtype=np.uint64) << np.uint64(30))
    nodes = spark.createDataFrame(pd.DataFrame({"fp": fps.view(np.int64)}))
    plans, real = {}, simhash.stored

    def stored(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, name)

    monkeypatch.setattr(simhash, "stored", stored)
    want = {tuple(r) for r in components.components(simhash.links(nodes)).collect()}
    assert "BroadcastHashJoin" in plans["simhash_crowds"]  # few keys, counted
    monkeypatch.setattr(simhash, "BROADCAST_KEYS", 0)
    plans.clear()
    assert {tuple(r) for r in components.components(simhash.links(nodes)).collect()} == want
    assert {"simhash_crowds", "simhash_members", "simhash_mixed", "simhash_more_links"} <= set(plans)
    assert not [k for k, p in plans.items() if "Broadcast" in p]


@pytest.mark.parametrize("kind", ["uniform", "clustered", "skewed"])
def test_links_lose_no_component(spark, kind):
    rng = np.random.default_rng({"uniform": 1, "clustered": 2, "skewed": 3}[kind])
    if kind == "uniform":
        fps = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    elif kind == "clustered":  # chains of neighbours about few centres
        fps = []
        for _ in range(12):
            x = int(rng.integers(0, 2**63))
            for _ in range(60):
                fps.append(x)
                for b in rng.choice(64, int(rng.integers(1, 6)), replace=False):
                    x ^= 1 << int(b)
        fps = np.array(fps, np.uint64)
    else:  # most bits the same for all, so that keys hold many nodes
        fps = rng.integers(0, 2**14, 1500, dtype=np.uint64) << np.uint64(30)
    fps = np.unique(fps)
    nodes = spark.createDataFrame(pd.DataFrame({"fp": fps.view(np.int64)}))
    found = {(a % 2**64, b % 2**64) for a, b in (tuple(r) for r in simhash.links(nodes).collect())}
    assert all((a ^ b).bit_count() <= 4 and a != b for a, b in found)
    place = {int(x): i for i, x in enumerate(fps)}
    got = list(range(len(fps)))
    def root(x):
        while got[x] != x:
            got[x] = got[got[x]]
            x = got[x]
        return x
    for a, b in found:
        got[root(place[a])] = root(place[b])
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= 4) + i + 1:
            assert root(i) == root(int(j))


def test_thresholds_cover_and_follow_the_counts():
    rng = np.random.default_rng(4)
    blocks = [list(range(8 * k, 8 * k + 8)) for k in range(8)]
    flat = np.full((8, 256), 100)
    for n in (10, 10_000, 10_000_000, 10**10):
        parts = simhash.allocate(blocks, flat, n)
        assert sum(p.threshold + 1 for p in parts) == 5
        assert sorted(b for p in parts for b in p.bits) == sorted({b for p in parts for b in p.bits})
        assert all(len(p.flips()) == len(set(p.flips())) == simhash.probes(len(p.bits), p.radius) for p in parts)
    skewed = flat.copy()
    skewed[:2] = 0
    skewed[:2, 7] = 25_600  # two blocks say nothing: no partition of them alone has a threshold
    for p in simhash.allocate(blocks, skewed, 100_000):
        assert not set(p.bits) <= set(range(16))
    joint = np.zeros((64, 64), np.int64)
    x = (rng.random((4000, 8)) < 0.5)[:, np.arange(64) % 8].astype(np.int64)  # bit b equals bit b + 8
    x ^= (rng.random(x.shape) < 0.1)
    joint = x.T @ x
    assert all(len({b % 8 for b in block}) == 1 for block in simhash.correlated_blocks(joint, 4000))
    shares = simhash.distance_shares(np.bincount(rng.integers(0, 256, 500), minlength=256))
    assert abs(shares.sum() - 1) < 1e-9


# ---------------------------------------------------------------- spans and digits of any script (3, 4, 5, 9)

def thue_morse(n):
    s = "a"
    while len(s) < n:
        s += s.translate(str.maketrans("ab", "ba"))
    return s


def test_long_alternating_words_differ(spark):
    """Two words of 1,024 letters whose polynomials modulo 2**64 agree are different words."""
    from civicflow.llm import neardup, pitman_yor, quality, textnp

    x = thue_morse(1024)
    y = x.translate(str.maketrans("ab", "ba"))
    (s,) = textnp.slices(textnp.pa.array([f"{x} {y} {x.upper()}"]))
    h = textnp.words(s).hash
    assert h[0] != h[1] and h[0] == h[2]
    docs = spark.createDataFrame([(1, f"{x} q"), (2, f"{y} q"), (3, f"{x}\n{y}\n{x}")], "doc_id long, text string")
    path = C.tempfile.mkdtemp(prefix="civicflow-test-", dir="/tmp") + "/docs"
    docs.write.parquet(path)
    docs = spark.read.parquet(path)
    groups = {r["doc_id"]: r["component_id"] for r in neardup.near_groups(docs, size=2).collect()}
    assert groups[1] == 1 and groups[2] == 2
    stats = {r["doc_id"]: r["n_dup_lines"] for r in quality.statistics(docs).collect()}
    assert stats == {1: 0, 2: 0, 3: 1}
    assert pitman_yor.words is textnp.words  # the language model's words have the same hashes


def test_span_hashes_tell_spans_apart():
    from civicflow.llm import textnp

    rng = random.Random(2)
    words = list({"".join(rng.choice("abÄß\0") for _ in range(n)) for n in range(1, 40) for _ in range(300)})
    (s,) = textnp.slices(textnp.pa.array([" ".join(words)]), 1 << 30)
    assert len(set(textnp.words(s).hash.tolist())) == len(words)


def test_surrogates_in_every_script(spark):
    from civicflow.llm import pii

    texts = ["ssn ١٢٣-٤٥-٦٧٨٩ x", "card ４１１１１１１１１１１１１１１１", "same 4111111111111111 card", "article 4111111111111112 stays",
             "phone +1 (२१२) ५५५-०१९८", 'password = "пароль-секрет"', "at 10.0.٠.١ now", "key " + "0f" * 300, 'token = "' + "Xy9" * 100 + '"',
             "again ١٢٣-٤٥-٦٧٨٩ and 123-45-6789"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: (r["text"], r["found"]) for r in pii.replace_all(df, count="found").collect()}
    s = pii.Surrogates(pii.KEY)
    for i, text in enumerate(texts):  # by hand: the mentions, spliced
        want, end = "", 0
        for a, z, kind, value in pii.detect(text):
            want += text[end:a] + s.render(kind, text[a:z], s.canonical(kind, value))
            assert len(s.render(kind, text[a:z], s.canonical(kind, value))) == z - a or kind == "ip"
            end = z
        assert out[i] == (want + text[end:], len(pii.detect(text)))
    assert out[3][1] == 0 and all(out[i][1] for i in range(len(texts)) if i != 3)
    new = re.search(r"\d{3}-\d{2}-\d{4}", out[0][0])[0]
    assert all("٠" <= c <= "٩" for c in new if c != "-") and "١٢٣" not in out[0][0]
    first, second = re.findall(r"\d{3}-\d{2}-\d{4}", out[9][0])  # one entity, in the digits of each mention
    assert pii.digits_of(first) == second == pii.digits_of(new)
    assert pii.digits_of(re.search(r"\d{16}", out[1][0])[0]) == re.search(r"\d{16}", out[2][0])[0]


def test_a_full_format_gets_longer(spark):
    """Every value of a format occurs: its surrogates find room beside it, and the rounds end."""
    from civicflow.llm import pii

    entities = spark.createDataFrame([("ssn", f"{i}") for i in range(10)], "kind string, value string")
    again = {r["value"]: r["draw"] for r in pii.redraws(entities, b"k").collect()}
    s = pii.Surrogates(b"k")
    made = [s.canonical("ssn", str(i), again.get(str(i), 0)) for i in range(10)]
    assert len(set(made)) == 10 and all(len(x) > 1 for x in made)


# ---------------------------------------------------------------- dealing (3, 10)

def test_a_large_batch_on_a_small_snapshot_is_dealt(spark):
    """The batch's digests meet the filters in groups of bounded size, however few parts the snapshot has."""
    from civicflow.llm import exact

    digest = lambda lo, hi: spark.range(lo, hi).select(F.unhex(F.sha2(F.col("id").cast("string").cast("binary"), 256)).alias("_digest"))
    filters = exact.build_filters(digest(0, 100), 1)
    out = exact.screen(digest(50, 4000), filters, 1, salts=8)
    rows = out.collect()
    assert len(rows) == 3950 and sum(r["maybe"] for r in rows) >= 50
    known = {bytes(r[0]) for r in digest(50, 100).collect()}
    assert all(r["maybe"] for r in rows if bytes(r["_digest"]) in known)
    salts = digest(50, 4000).select(F.pmod(F.xxhash64(F.lit(7), "_digest"), F.lit(8)).alias("s")).groupBy("s").count().collect()
    assert len(salts) == 8 and max(r["count"] for r in salts) < 700


def test_the_training_sample_is_the_smallest_hashes(spark, monkeypatch):
    from civicflow.llm import quality

    texts = [" ".join(f"w{(i * j) % 97}" for j in range(60 + i % 7)) for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(20)
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, y, m: seen.append((x.tolist(), y.tolist())) or "trees")
    stats = quality.statistics(docs)
    quality.train(stats, labels, rows=40)
    want = stats.join(labels.withColumnRenamed("quality", "_y"), "doc_id").orderBy(F.xxhash64("doc_id")).limit(40).select(
        *quality.FEATURES, "_y").toPandas()
    assert len(seen[0][1]) == 40 and seen[0][1] == want["_y"].astype(float).tolist()
    quality.train(stats, labels.limit(0), rows=40)
    assert seen[1][1] == []
