import random

import numpy as np
import pytest

from mailshape.operators import evaluate, folds


@pytest.fixture
def predictions(spark):
    def make(rows):
        return spark.createDataFrame(rows, "label int, prediction int, score double").repartition(3)
    return make


ROWS = [(1, 1, .9), (1, 0, .4), (0, 1, .9), (0, 0, .1), (0, 0, .4), (1, 1, .8)]


def test_binary_metrics(predictions):
    row = evaluate.binary_metrics(predictions(ROWS)).first()
    assert tuple(row) == pytest.approx((4 / 6, 2 / 3, 2 / 3, 2 / 3))
    row = evaluate.binary_metrics(predictions([(1, 0, .1), (0, 0, .2)])).first()
    assert tuple(row) == (0.5, 0.0, 0.0, 0.0)


def test_confusion_matrix_lists_zero_cells(predictions):
    rows = evaluate.confusion_matrix(predictions([(1, 1, .5)] * 3)).collect()
    assert {(r.label, r.prediction): r.n_rows for r in rows} == {
        (0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 3}


def test_report(predictions):
    rows = {r.row: tuple(r)[1:] for r in evaluate.classification_report(
        predictions(ROWS + [(0, 0, .0)] * 2)).collect()}
    assert rows["Ham"] == pytest.approx((4 / 5, 4 / 5, 4 / 5, 5))
    assert rows["Spam"] == pytest.approx((2 / 3, 2 / 3, 2 / 3, 3))
    assert rows["accuracy"] == (None, None, 6 / 8, 8)
    assert rows["macro avg"][:3] == pytest.approx((11 / 15,) * 3)
    assert rows["weighted avg"][:3] == pytest.approx(((5 * 4 / 5 + 3 * 2 / 3) / 8,) * 3)


def python_curve(rows):
    points, positives = [], sum(l for l, _, _ in rows)
    for t in sorted({s for _, _, s in rows}, reverse=True):
        hit = [l for l, _, s in rows if s >= t]
        points.append((t, sum(hit) / len(hit), sum(hit) / positives if positives else 1.0))
    return points


@pytest.mark.parametrize("levels", [3, 40, 100000])
def test_pr_curve_and_average_precision(predictions, levels):
    rng = random.Random(levels)
    rows = [(rng.randint(0, 1), 0, rng.randrange(levels) / levels) for _ in range(600)]
    want = python_curve(rows)
    got = evaluate.pr_curve(predictions(rows)).collect()
    mine = sorted((tuple(r) for r in got if r.threshold is not None), reverse=True)
    assert np.allclose(mine, want)
    assert [tuple(r) for r in got if r.threshold is None] == [(None, 1.0, 0.0)]
    area, before = 0.0, 0.0
    for _, p, r in want:
        area, before = area + (r - before) * p, r
    assert evaluate.average_precision(predictions(rows)).first()[0] == pytest.approx(area)


def test_curve_without_positives(predictions):
    got = evaluate.pr_curve(predictions([(0, 0, .5), (0, 0, .2)])).filter("threshold is not null")
    assert {(r.precision, r.recall) for r in got.collect()} == {(0.0, 1.0)}
    assert evaluate.average_precision(predictions([(0, 0, .5)])).first()[0] == 0.0


@pytest.mark.parametrize("seed,partitions", [(1, 1), (1, 8), (2, 5), (3, 3)])
def test_folds_match_allocation_rule(spark, seed, partitions):
    rng = random.Random(seed)
    labels = [int(rng.random() < 0.2 * seed) for _ in range(rng.randint(60, 120))]
    ids = sorted(rng.sample(range(10_000), len(labels)))
    rows = list(zip(ids, labels))
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "mail_id bigint, label int").repartition(partitions)
    got = {r.mail_id: r.fold for r in folds.with_folds(frame).collect()}

    order = list(dict.fromkeys(labels))
    codes = np.array([order.index(l) for l in labels])
    sorted_codes = np.sort(codes)
    sizes = np.array([np.bincount(sorted_codes[i::5], minlength=2) for i in range(5)])
    want = np.empty(len(labels), int)
    for c in range(2):
        want[codes == c] = np.arange(5).repeat(sizes[:, c])
    assert got == dict(zip(ids, want.tolist()))
