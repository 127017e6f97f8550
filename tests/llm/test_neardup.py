import random

import pytest

from mailshape.llm import neardup
from mailshape.llm.components import components
from mailshape.llm.queries import op3_minhash

SCHEMA = "doc_id bigint, text string, extra string"


def sets_of(text):
    words = (text or "").encode().lower().split()
    width = min(5, len(words))
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if words else set()


def brute(rows):
    """Row number to (n, component) by comparing all pairs."""
    sets = [sets_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= 75 * len(sets[i] | sets[j]):
                    root[find(i)] = find(j)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[find(i)] = min(doc, ids.get(find(i), doc))
    return [(doc, len(sets[i]), ids.get(find(i)) if sets[i] else doc)
            for i, (doc, _) in enumerate(rows)]


def run(spark, rows):
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA).repartition(3)
    out = neardup.near_duplicates(frame).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    key = lambda r: tuple(-1 if x is None else x for x in r)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=key), \
        sorted(brute(rows), key=key)


def test_copies_edits_and_odd_rows(spark):
    rng = random.Random(3)
    rows = []
    for group in range(12):
        base = [rng.choice("abcdefghij") + str(rng.randrange(400)) for _ in range(80)]
        for copy in range(rng.randrange(1, 9)):
            words = list(base)
            for _ in range(copy):
                words[rng.randrange(80)] = "edit%d" % rng.randrange(99)
            rows.append((len(rows) + 100, " ".join(words)))
    rows += [(3, None), (4, ""), (5, " \t\n"), (6, "a b"), (7, "A  b"), (8, "a b c"),
             (9, "one two three four five"), (9, "one two three four five"), (9, "other text"),
             (2, "ONE two\nthree four five"), (None, "a b c"), (None, "lone words here")]
    mine, want = run(spark, rows)
    assert mine == want


def test_chain_in_one_group(spark):
    """Neighbours are similar, ends are not: the class is found over links."""
    words = ["w%d" % i for i in range(400)]
    rows = [(i, " ".join(words[6 * i:6 * i + 100])) for i in range(40)]
    mine, want = run(spark, rows)
    assert mine == want
    assert {c for _, _, c in mine} == {0}


def test_empty_table(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_posterior_bounds():
    assert neardup.posterior(32, 32, 0.75) == pytest.approx(1 - 0.75 ** 33)
    ends = neardup.least_matches()
    assert [n for n, _ in ends] == [32, 64, 96, 128]
    assert all(neardup.posterior(m, n, 0.75) >= 1e-6 > neardup.posterior(m - 1, n, 0.75)
               for n, m in ends)


def test_components(spark):
    links = spark.createDataFrame(
        [(b"b", b"a"), (b"c", b"b"), (b"d", b"c"), (b"e", b"d"), (b"x", b"y"), (b"z", b"z")],
        "a binary, b binary")
    found = {bytes(r.node): bytes(r.root) for r in components(links).collect()}
    assert found == {b"a": b"a", b"b": b"a", b"c": b"a", b"d": b"a", b"e": b"a",
                     b"x": b"x", b"y": b"x"}


def test_query_on_generated_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet")
            .select("doc_id", "text").collect()]
    mine = sorted(tuple(r) for r in op3_minhash(spark, folder)
                  .select("doc_id", "n_shingles", "component_id").collect())
    assert mine == sorted(brute(rows))
