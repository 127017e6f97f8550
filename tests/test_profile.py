import math
import random

import numpy as np
import pytest

from mailshape.operators import profile

RNG = random.Random(11)
ROWS = [(i, " ".join(["word"] * RNG.choice([0, 1, 2, 3, 7, 50, RNG.randint(1, 400)])), i % 3 == 0)
        for i in range(500)]
ROWS = [(i, t, int(l)) for i, t, l in ROWS]
LENGTHS = {label: [len(t.split()) for _, t, l in ROWS if l == label] for label in (0, 1)}
ALL = LENGTHS[0] + LENGTHS[1]


def test_histogram_matches_numpy(mails):
    got = profile.length_histogram(profile.length_counts(mails(ROWS))).orderBy("label", "bin").collect()
    for label in (0, 1):
        counts, edges = np.histogram(LENGTHS[label], bins=50, range=(min(ALL), max(ALL)))
        mine = [r for r in got if r.label == label]
        assert [r.n_rows for r in mine] == counts.tolist()
        assert [r.bin_start for r in mine] == pytest.approx(edges[:-1].tolist())


@pytest.mark.parametrize("top", [49, 50, 77, 123])
def test_histogram_edges_match_numpy(mails, top):
    rows = [(i, " ".join(["w"] * i), 0) for i in range(1, top + 1)]
    got = profile.length_histogram(profile.length_counts(mails(rows))).orderBy("bin").collect()
    counts, _ = np.histogram(range(1, top + 1), bins=50, range=(1, top))
    assert [r.n_rows for r in got] == counts.tolist()


def test_histogram_of_one_length(mails):
    got = profile.length_histogram(profile.length_counts(mails([(1, "a b", 0), (2, "c d", 0)]))).filter("n_rows > 0").collect()
    assert [(r.bin, r.n_rows) for r in got] == [(25, 2)]


def test_density_matches_formula(mails):
    got = profile.length_density(profile.length_counts(mails(ROWS))).orderBy("label", "point").collect()
    grid = np.linspace(min(ALL), max(ALL), 200)
    for label in (0, 1):
        x = np.array(LENGTHS[label], float)
        h = x.std(ddof=1) * len(x) ** -0.2
        want = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(1) / (len(x) * h * math.sqrt(2 * math.pi))
        mine = [r for r in got if r.label == label]
        assert [r.density for r in mine] == pytest.approx(want.tolist(), rel=1e-9)
        width = (max(ALL) - min(ALL)) / 50
        assert [r.scaled for r in mine] == pytest.approx((want * len(x) * width).tolist(), rel=1e-9)


def test_density_needs_spread(mails):
    rows = [(1, "a b", 0), (2, "c d", 0), (3, "a", 1), (4, "a b c", 1)]
    assert {r.label for r in profile.length_density(profile.length_counts(mails(rows))).collect()} == {1}


def test_quantile_matches_numpy(mails):
    assert profile.length_quantile(profile.length_counts(mails(ROWS))).first()[0] == pytest.approx(np.quantile(ALL, 0.95))


def test_top_terms(mails):
    rows = [(1, "zeta beta beta the of ox me alpha", 0), (2, "alpha zeta now! now", 0),
            (3, "spam spam", 1), (4, "ignored", None)]
    got = profile.top_terms(mails(rows), k=3).orderBy("label", "rank").collect()
    assert [(r.class_name, r.rank, r.term, r.n) for r in got] == [
        ("Ham", 1, "alpha", 2), ("Ham", 2, "beta", 2), ("Ham", 3, "zeta", 2), ("Spam", 1, "spam", 2)]


def test_counts_and_profile(mails):
    df = mails(ROWS)
    counts = {r.corpus: (r.n_rows, r.n_spam) for r in profile.sample_counts(a=df, b=df).collect()}
    assert counts == {"a": (500, 167), "b": (500, 167)}
    tables = profile.profile(df)
    assert {r.class_name: r.n_rows for r in tables["class_distribution"].collect()} == {
        "Ham": 333, "Spam": 167}
    assert set(tables) == {
        "class_distribution", "length_histogram", "length_density", "length_p95", "top_terms"}
