import numpy as np
import pytest

from mailshape.llm import toxicity
from mailshape.llm.queries import op7_toxicity

SCHEMA = "doc_id bigint, text string, expected string"


def test_gradient_finds_a_minimum():
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(300):
        found = [f for f in (1, 2, 3) if rng.random() < 0.4]
        margin = {1: 2.0, 2: 4.0, 3: 0.0}
        noise = rng.logistic()
        value = sum(margin[f] for f in found) + noise
        rows.append((int(value > 2) + int(value > 5), found, 1))
    model = toxicity.fit_ordinal(rows, 3, steps=3000)

    def loss(weights, cuts):
        total = 0.0
        for grade, found, count in rows:
            margin = sum(weights[f] for f in found)
            edges = [-np.inf, *cuts, np.inf]
            low, high = (1 / (1 + np.exp(-(edges[grade + k] - margin))) for k in (0, 1))
            total -= count * np.log(high - low)
        steps = [cuts[0], np.log(cuts[1] - cuts[0])]
        return total + 0.01 * (sum(w * w for w in weights.values()) + sum(s * s for s in steps))

    best = loss(model.weights, model.thresholds)
    for f in model.weights:
        for d in (-0.1, 0.1):
            assert loss({**model.weights, f: model.weights[f] + d}, model.thresholds) > best - 1e-6
    for k in range(2):
        for d in (-0.1, 0.1):
            cuts = list(model.thresholds)
            cuts[k] += d
            assert loss(model.weights, cuts) > best - 1e-6
    assert model.weights[2] > model.weights[1] > abs(model.weights[3])


def test_empty_grade_and_no_rows():
    model = toxicity.fit_ordinal([(0, [], 50), (1, [7], 20)], 3)
    assert model.thresholds == sorted(model.thresholds)
    assert (model.exceedance(np.array([0.0, model.weights[7]]))[:, 0] > 0.5).tolist() == [False, True]
    empty = toxicity.fit_ordinal([], 3)
    assert empty.exceedance(np.zeros(2)).sum() < 1e-6


def test_evidence_sign():
    found = toxicity.evidence(np.array([9.0, 0.0, 5.0]), np.array([1.0, 9.0, 50.0]), 10, 100)
    assert found[0] > 3.5 and found[1] < 0 and abs(found[2]) < 1e-9


def test_odd_rows_and_held_out(spark):
    rng = np.random.default_rng(1)
    plain = ["w%s" % "abcdefghij"[i] * 2 for i in range(10)]

    def text(bad):
        words = list(rng.choice(plain, 20))
        return " ".join(words + ["Stupid!!", "vejuadoa"[:5] + "xyz"[rng.integers(3)]] * bad)

    rows = [(i, text(i % 4 == 0), "x") for i in range(400)]
    docs = spark.createDataFrame(rows + [(1000, None, "x"), (1001, "", "x"), (None, "stupid", "x"),
                                         (5, "twice", "x")], SCHEMA)
    grades = spark.createDataFrame(
        [(i, int(i % 4 == 0)) for i in range(200)] + [(0, 0), (None, 1), (7, None)],
        "id bigint, grade int")
    model = toxicity.fit(docs, grades, 3)
    out = docs.select("doc_id", "text", toxicity.severity(model, docs["text"]).alias("s")).collect()
    for r in out:
        toxic = r.text is not None and "stupid" in r.text.lower()
        if r.doc_id is not None and r.doc_id >= 200:
            assert (r.s.grade > 0) == toxic, r
            assert r.s.expected == pytest.approx(r.s.expected) and 0 <= r.s.expected <= 2
    nothing = toxicity.fit(docs, grades.filter("id < 0"), 3)
    assert docs.select(toxicity.severity(nothing, docs["text"]).alias("s")).filter(
        "s.grade > 0").count() == 0
    empty = spark.createDataFrame([], SCHEMA)
    assert empty.select(toxicity.severity(model, empty["text"])).count() == 0


def test_query(spark):
    """Every row is scored; labelled rows are told apart."""
    folder = "/root/testdata/sf0.01"
    out = op7_toxicity(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    assert out.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    wrong = out.join(labels, "doc_id").filter("kept = (toxic = 1)").count()
    assert wrong <= 0.03 * labels.count()
