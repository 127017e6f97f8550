import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from mailshape.llm import decontam
from mailshape.llm.memos import alone
from mailshape.llm.queries import op2_decontamination

DOCS = "doc_id bigint, text string, cosine string"
ITEMS = "item_id bigint, text string"


def by_table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=12), st.lists(st.integers(0, 4), max_size=14))
def test_common_subsequence(a, b):
    assert decontam.common_subsequence(a, b) == by_table(a, b)


def test_windows_cover_all_words():
    for n in (1, 16, 31, 32, 33, 100):
        covered = {i for s in decontam.window_starts(n) for i in range(s, s + decontam.WINDOW)}
        assert covered >= set(range(n))


def test_basis_equals_svd(spark):
    rng = np.random.default_rng(0)
    matrix = rng.normal(size=(80, 4)) @ rng.normal(size=(4, 30)) + 1e-4 * rng.normal(size=(80, 30))
    rows = [([*range(30)], r.tolist()) for r in matrix]
    frame = spark.createDataFrame(rows, "places array<bigint>, weights array<double>").repartition(3)
    basis = decontam.latent_basis(frame, 30, dimensions=4)
    right = np.linalg.svd(matrix, full_matrices=False)[2][:4]
    assert np.abs(right @ basis @ basis.T - right).max() < 1e-6


@pytest.fixture(scope="module")
def case():
    rng = random.Random(5)
    common = ["the", "of", "and", "to", "in"]

    def prose(n):
        return [rng.choice(common) if rng.random() < 0.4 else "w%d" % rng.randrange(9000)
                for _ in range(n)]

    items = [(i, " ".join(prose(25)) + ". The " + " ".join(prose(5)) + ".") for i in range(30)]
    rows, leaks = [], set()
    for doc in range(120):
        words = prose(rng.choice([5, 60, 300]))
        if doc % 4 == 0:
            item, text = items[doc // 4]
            body = text.split()
            if doc % 8 == 0:  # a paraphrase: words changed, case and marks too
                for k in rng.sample(range(24), 6):
                    body[k] = "other%d" % k
                body = [w.upper() + "!!" for w in body]
            at = rng.randrange(len(words))
            words[at:at] = body
            leaks.add((doc, item))
        rows.append((doc, " ".join(words), "x"))
    return items, rows, leaks


def test_finds_leaks_and_leaves_the_rest(spark, case):
    items, rows, leaks = case
    docs, bench = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS)
    found = {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, bench).collect()}
    assert found == leaks
    # In parts of a few items the same pairs are found.
    parts = decontam.find_leaks(docs, bench, most=10)
    assert {(r.doc_id, r.item_id) for r in parts.collect()} == leaks
    held = docs.filter(decontam.holds_item(decontam.index_parts(bench, docs), docs["text"]))
    assert {r.doc_id for r in held.collect()} == {d for d, _ in leaks}


@pytest.mark.parametrize("kind", ["int", "smallint", "string"])
def test_item_ids_of_any_type(spark, case, kind):
    items, rows, leaks = case
    bench = spark.createDataFrame(items, ITEMS).withColumn("item_id", F.col("item_id").cast(kind))
    found = decontam.find_leaks(spark.createDataFrame(rows, DOCS), bench)
    assert dict(found.dtypes)["item_id"] == kind
    assert {(r.doc_id, int(r.item_id)) for r in found.collect()} == leaks


def test_finds_long_items(spark):
    rng = random.Random(7)
    common = ["the", "of", "and", "to", "in"]

    def prose(n):
        return [rng.choice(common) if rng.random() < 0.4 else "w%d" % rng.randrange(9000)
                for _ in range(n)]

    items = [(i, " ".join(prose(n))) for i, n in enumerate([100, 112, 160, 225, 300, 379, 500] * 3)]
    rows, leaks = [], set()
    for doc in range(100):
        words = prose(rng.choice([5, 60, 300]))
        if doc < len(items):
            at = rng.randrange(len(words))
            words[at:at] = items[doc][1].split()
            leaks.add((doc, doc))
        rows.append((doc, " ".join(words), "x"))
    found = decontam.find_leaks(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == leaks


@pytest.mark.parametrize("rare_first", [False, True])
def test_finds_paraphrases_with_answer(spark, rare_first):
    folder = "/root/testdata/sf0.001"
    rng = random.Random(3)
    texts = [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").orderBy(
        "doc_id").limit(400).collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    spread = {}
    for words in map(set, map(decontam.normal_words, texts)):
        for w in words:
            spread[w] = spread.get(w, 0) + 1
    rows, leaks = [], set()
    for doc, text in enumerate(texts):
        number, original = items[doc % len(items)]
        body, answer = decontam.normal_words(original), decontam.answer_words(original)
        places = list(range(len(body) - len(answer)))
        rng.shuffle(places)
        if rare_first:
            places.sort(key=lambda k: spread.get(body[k], 0))
        for k in places[:(len(body) * (40 if rare_first else 50)) // 100]:
            body[k] = "other%d" % rng.randrange(10 ** 6)
        words = (text or "").split()
        at = rng.randrange(len(words) + 1)
        words[at:at] = body
        rows.append((doc, " ".join(words), "x"))
        item = decontam.normal_words(original)
        near = decontam.normal_words(" ".join(words[max(0, at - len(item)):at + 2 * len(item)]))
        if answer and by_table(item, near) >= 0.5 * len(item) \
                and by_table(answer, near) >= 0.8 * len(answer):
            leaks.add((doc, number))
    found = decontam.find_leaks(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS))
    found = {(r.doc_id, r.item_id) for r in found.collect()}
    print(rare_first, len(leaks), len(found & leaks), len(found))
    assert len(leaks) > 100 and len(found & leaks) >= 0.9 * len(leaks)


def test_only_items_within_reach_are_compared(case):
    items, rows, leaks = case
    words = [decontam.normal_words(t) for _, t in items]
    vocabulary = {w: k for k, w in enumerate(sorted({w for ws in words for w in ws}))}
    places = lambda ws: np.array([vocabulary[w] for w in ws], dtype=np.int64)
    rng = np.random.default_rng(1)
    index = decontam.LatentIndex(
        [i for i, _ in items], [places(ws) for ws in words],
        [places(decontam.answer_words(t)) for _, t in items], vocabulary,
        np.ones(len(vocabulary)), rng.normal(size=(len(vocabulary), 8)), 0.5).prepare()
    reader = decontam._WordIds(vocabulary)
    every = list(range(len(items)))
    within = 0
    for doc, text, _ in rows:
        ids = reader.of(text)
        wanted = []
        for c, (item, answer) in enumerate(zip(index.items, index.answers)):
            share = by_table(item.tolist(), ids.tolist()) / len(item)
            there = by_table(answer.tolist(), ids.tolist()) >= 0.8 * len(answer)
            if share >= 0.8 or share >= 0.5 and there:
                wanted.append(c)
        found = index.reachable(ids)
        assert set(found) <= set(wanted)
        # What is left out has no hit, whatever its cosine.
        hits = index.hits(ids)
        index.reachable = lambda _: every
        assert [h[0] for h in index.hits(ids)] == [h[0] for h in hits]
        del index.reachable
        within += len(found)
    assert within < 0.1 * len(items) * len(rows)


@pytest.mark.parametrize("text", ["The, THE! the-of x1 ?! \x1c\x85 \xa0.", "ΑΣ. ΑΣ-Β ΑΣ'Β ς", "É.l-É ½² 日本 İx é́",
                                  "", None])
def test_words_are_read_as_normal_words(text):
    vocabulary = {w: k for k, w in enumerate(sorted({*decontam.normal_words(text), "the", "of"}))}
    reader = decontam._WordIds(vocabulary)
    for _ in range(2):
        assert reader.of(text).tolist() == [vocabulary[w] for w in decontam.normal_words(text)]
        assert reader.of("the unknown of").tolist() == [vocabulary["the"], -1, vocabulary["of"]]
        reader.clear()


def test_odd_rows(spark, case):
    items, _, _ = case
    text = items[0][1]
    rows = [(1, None, "x"), (2, "", "x"), (3, "?! ...", "x"), (4, text, "x"), (4, text, "x"),
            (None, text, "x"), (5, "word " * 40_000 + text, "x")]
    docs = spark.createDataFrame(rows, DOCS)
    bench = spark.createDataFrame(items[:3] + [(None, "--"), (7, None), (8, "")], ITEMS)
    found = sorted((r.doc_id or 0, r.item_id) for r in decontam.find_leaks(docs, bench).collect())
    assert found == [(0, 0), (4, 0), (4, 0), (5, 0)]
    assert decontam.find_leaks(docs, bench.limit(0)).count() == 0
    assert decontam.find_leaks(docs.limit(0), bench).count() == 0


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    found = {(r.doc_id, r.item_id) for r in op2_decontamination(spark, folder).collect()}
    near = set()
    for d in docs:
        words = decontam.normal_words(d.text)
        for i in items:
            item = decontam.normal_words(i.text)
            known = set(item) & set(words)
            if len(known) >= 0.8 * len(set(item)):
                size = 3 * len(item)
                if any(decontam.common_subsequence(item, words[s:s + size]) >= 0.8 * len(item)
                       for s in range(0, len(words), len(item))):
                    near.add((d.doc_id, i.item_id))
    assert near and len(found & near) >= 0.9 * len(near)
    assert len(found - near) <= 0.1 * len(found)


def test_every_document_shapes_the_latent_space(spark, monkeypatch):
    seen = []

    def basis(passages, width, *_):
        seen.append(passages.count())
        return np.zeros((width, 1))

    monkeypatch.setattr(decontam, "latent_basis", basis)
    items = [(i, " ".join(f"w{i}x{k}" for k in range(10))) for i in range(200)]
    docs = spark.createDataFrame([(d, items[d % 200][1], "x") for d in range(6000)], DOCS)
    index = decontam.build_index(items, docs)
    assert seen == [6000 + 200]
    assert index.idf == pytest.approx(np.log(6001 / 31) + 1e-3)


def test_one_memo_at_a_time():
    one, two = {"a": 1}, {"b": 2}
    assert alone(one) is one and alone(one) == {"a": 1}
    assert alone(two) == {"b": 2} and one == {}


def test_windows_without_rare_words_shape_the_latent_space(spark, monkeypatch):
    seen = []

    def basis(passages, width, *_):
        seen.extend(tuple(r.places) for r in passages.collect())
        return np.zeros((width, 1))

    monkeypatch.setattr(decontam, "latent_basis", basis)
    items = [(i, f"the of rare{i} seldom{i}") for i in range(20)]
    # A common word at three places, else words outside the vocabulary: six windows, five of which hold it.
    text = " ".join("the" if k in (0, 40, 90) else f"other{k}" for k in range(100))
    docs = spark.createDataFrame([(d, text, "x") for d in range(50)], DOCS)
    index = decontam.build_index(items, docs)
    the = index.vocabulary["the"]
    assert sorted(seen) == sorted([(the,)] * 5 * 50 + [tuple(sorted(index.vocabulary[w] for w in t.split()))
                                                       for _, t in items])


def test_windows_of_a_batch():
    rng = np.random.default_rng(4)
    texts = [rng.integers(-1, 6, n).astype(np.int32) for n in (0, 1, 31, 32, 33, 48, 49, 100, 0, 7)]
    words, counts = decontam.window_words(texts)
    wanted = [t[s:s + decontam.WINDOW] for t in texts if len(t) for s in decontam.window_starts(len(t))]
    wanted = [w[w >= 0] for w in wanted]
    assert counts.tolist() == [len(w) for w in wanted]
    assert words.tolist() == np.concatenate(wanted).tolist()
    assert [x.tolist() for x in decontam.window_words([])] == [[], []]


@pytest.mark.parametrize("dense", [True, False])
def test_sums_by_pair_with_words_that_come_twice(monkeypatch, dense):
    monkeypatch.setattr(decontam, "_DENSE_PAIRS", 10 ** 6 if dense else 0)
    monkeypatch.setattr(decontam, "_PAIRS_AT_ONCE", 20)
    rng = np.random.default_rng(2)
    width, rows = 9, [(rng.integers(0, 9, (30, n)), rng.normal(size=(30, n))) for n in (1, 2, 5, 12)]
    matrix, pairs = np.zeros((0, width)), decontam._PairSums(width)
    for places, weights in rows:
        pairs.add(places, weights)
        part = np.zeros((30, width))
        np.add.at(part, (np.arange(30)[:, None], places), weights)
        matrix = np.concatenate([matrix, part])
    at, sums = pairs.result()
    one, two = np.triu_indices(width)
    assert (pairs.first[one] + two).tolist() == list(range(45))
    found = np.zeros(45)
    found[at] = sums
    assert found == pytest.approx((matrix.T @ matrix)[one, two])
    assert (np.diff(at) > 0).all()


def test_basis_of_blocks_of_words(spark, monkeypatch):
    monkeypatch.setattr(decontam, "_PAIRS_A_ROW", 60)  # read on the driver, where blocks are made
    rng = np.random.default_rng(3)
    matrix = rng.normal(size=(50, 3)) @ rng.normal(size=(3, 30))
    frame = spark.createDataFrame([([*range(30)][::-1], r[::-1].tolist()) for r in matrix],
                                  "places array<int>, weights array<double>").repartition(3)
    basis = decontam.latent_basis(frame, 30, dimensions=3)
    right = np.linalg.svd(matrix, full_matrices=False)[2][:3]
    assert np.abs(right @ basis @ basis.T - right).max() < 1e-6


def test_every_window_is_compared_with_every_item(case):
    items, rows, _ = case
    words = [decontam.normal_words(t) for _, t in items]
    vocabulary = {w: k for k, w in enumerate(sorted({w for ws in words for w in ws}))}
    places = lambda ws: np.array([vocabulary[w] for w in ws], dtype=np.int64)
    rng = np.random.default_rng(1)
    index = decontam.LatentIndex(
        [i for i, _ in items], [places(ws) for ws in words],
        [places(decontam.answer_words(t)) for _, t in items], vocabulary,
        1 + rng.random(len(vocabulary)), rng.normal(size=(len(vocabulary), 8))).prepare()
    seen, sums = [], index._sums
    index._sums = lambda steps: seen.append(len(steps) - 1) or sums(steps)
    reader, without = decontam._WordIds(vocabulary), 0
    for _, text, _ in rows:
        ids = reader.of(text)
        seen.clear()
        index.hits(ids)
        starts = range(0, max(1, 16 * (-(-len(ids) // 16) - 1)), 16)
        assert sum(seen) == len(starts)
        without += not index.reachable(ids)
        near = set()
        for s in starts:
            window = index.by_place[ids[s:s + 32]].sum(axis=0)
            cosines = index.vectors @ window / max(np.linalg.norm(window), 1e-12)
            near |= {(int(index.owners[k]), s) for k in np.flatnonzero(cosines > 0.401)}
        assert near <= set(zip(*(x.tolist() for x in index.candidates(ids)[:2])))
    assert without > 50
