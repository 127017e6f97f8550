import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from mailshape.llm import periodic
from mailshape.llm.queries import QUERIES, planted_words


def brute(words, min_length=24, exponent=3):
    """Every period in turn, every maximal stretch of it."""
    n, runs = len(words), set()
    for q in range(1, n // exponent + 1):
        x = 0
        while x < n - q:
            if words[x] != words[x + q]:
                x += 1
                continue
            y = x
            while y < n - q and words[y] == words[y + q]:
                y += 1
            root = words[x:x + q]
            primitive = all(q % p or root[:q - p] != root[p:] for p in range(1, q))
            if y + q - x >= max(min_length, exponent * q) and primitive:
                runs.add((x, y + q - x, q))
            x = y + 1
    return sorted(runs)


def test_equals_brute_force():
    rng = random.Random(3)
    for _ in range(1500):
        n, v = rng.randint(0, 200), rng.randint(1, 4)
        words = [str(rng.randrange(v)) for _ in range(n)]
        if n and rng.random() < 0.5:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randint(3, 10)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        length, exponent = rng.choice([24, 5, 1]), rng.choice([3, 4])
        assert periodic.find_runs(np.array(words, dtype=object), length, exponent) == \
            brute(words, length, exponent)


def test_long_and_empty():
    assert periodic.find_runs(np.array(["a"] * 100000, dtype=object)) == [(0, 100000, 1)]
    assert periodic.find_runs(np.array([], dtype=object)) == []
    with pytest.raises(ValueError):
        periodic.find_runs(np.array(["a"]), 24, 2)


def test_collapse():
    words = list("xy") + list("abc") * 10 + ["z"]
    runs = periodic.find_runs(np.array(words, dtype=object))
    assert runs == [(2, 30, 3)]
    assert periodic.collapse(words, runs) == list("xyabcz")


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    if best:  # exact ratios
        top = [r for r in runs if r[1] * best[2] == best[1] * r[2]]
        best = min(top, key=lambda r: (r[0], r[2]))
    drop = set()
    for s, length, q in runs:
        drop.update(range(s + q, s + length))
    kept = " ".join(w for i, w in enumerate(words) if i not in drop)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *(best or (None,) * 3),
            None if best is None else 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_query_on_table(spark):
    got = {r.doc_id: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    planted = 0
    for d in docs:
        want = expected(d.doc_id, d.text)
        assert got[d.doc_id] == want
        planted += want[1] > 0
    assert planted > 0


def test_odd_rows(spark):
    rows = [(None, None), (1, ""), (2, "a " * 50), (2, "a " * 50), (3, "x y " * 40 + "z"),
            (4, " ".join(str(i) for i in range(30)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(1))
    made = periodic.periodic_runs(docs).select(
        "doc_id", "runs.n_runs", "runs.starts", "runs.periods", "runs.collapsed",
        periodic.best_run(F.col("runs")).alias("best")).collect()
    by = [(r.doc_id, r.n_runs, list(r.starts), list(r.periods), r.collapsed) for r in made]
    assert sorted(by, key=str) == sorted([
        (None, 0, [], [], ""), (1, 0, [], [], ""), (2, 1, [0], [1], "a"), (2, 1, [0], [1], "a"),
        (3, 1, [0], [2], "x y z"), (4, 0, [], [], " ".join(str(i) for i in range(30)))], key=str)
    assert sorted(str(r.best) for r in made).count("None") == 3


def test_planting_is_native(spark):
    docs = spark.createDataFrame([(i, "w%d " % i * 3 + " ".join(map(str, range(40)))) for i in range(60)],
                                 "doc_id long, text string")
    got = docs.select("doc_id", "text", planted_words(F.col("doc_id"), F.col("text")).alias("w")).collect()
    for r in got:
        words = r.text.split()
        h = zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        assert list(r.w) == words
