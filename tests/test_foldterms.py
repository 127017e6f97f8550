import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from mailshape.operators import evaluate, folds, foldterms, models, vectorize
from mailshape.plans import compare
from mailshape.session import land
from tests.test_models import corpus


@pytest.fixture(scope="module")
def folded(spark):
    return compare.landed_folds(land(corpus(spark, 90, 5, 0.15), "cv_train"))


@pytest.mark.parametrize("size", [3, 40, 10_000])
def test_every_side_equals_a_fit_on_its_rows(spark, folded, size):
    counts = foldterms.fold_term_counts(folded, (1, 2))
    vocabulary = foldterms.fold_vocabulary(counts, foldterms.fold_sizes(folded), 5, size).collect()
    for held_out in [foldterms.ALL_ROWS, *range(5)]:
        rows = folded if held_out < 0 else folded.filter(F.col("fold") != held_out)
        fitted = Pipeline(stages=vectorize.text_stages("tfidf", (1, 2), size=size)[:-1]).fit(rows)
        want = fitted.stages[-2].vocabulary
        got = sorted((r.rank, r.term, r.idf) for r in vocabulary if r.held_out == held_out)
        assert [t for _, t, _ in got] == list(want)
        assert np.allclose([i for *_, i in got], fitted.stages[-1].getScalingVec().toArray())
        scalers = foldterms.side_scalers(foldterms.fold_moments(folded), 5)
        moments = foldterms.side_moments(scalers, held_out)
        assert len(moments) == 21
        for c, (mean, spread) in moments.items():
            m, s = rows.agg(F.avg(c), F.stddev_pop(c)).first()
            assert mean == pytest.approx(m, abs=1e-9) and spread == pytest.approx(s, abs=1e-9)


def test_empty_fold_table(spark, folded):
    empty = folded.limit(0)
    counts = foldterms.fold_term_counts(empty, (1, 2))
    assert foldterms.fold_vocabulary(counts, foldterms.fold_sizes(empty), 5).count() == 0


@pytest.mark.parametrize("settings", compare.TEXT_MODELS, ids=lambda m: m.name)
def test_cross_validation_from_tables_equals_refits(spark, folded, settings):
    tables = compare.fold_tables(folded, [m.ngram_range for m in compare.TEXT_MODELS])
    validated = compare.cross_validate_model(settings, tables)
    scores = [evaluate.binary_metrics(models.predict(
        compare.pipeline_for(settings).fit(folded.filter(F.col("fold") != k)),
        folded.filter(F.col("fold") == k))).first().f1 for k in range(folds.FOLDS)]
    assert validated.scores == pytest.approx(scores, abs=1e-9)
    whole = compare.pipeline_for(settings).fit(folded)
    same = lambda m: sorted(map(tuple, models.predict(m, folded).select("mail_id", "prediction").collect()))
    assert same(validated.model) == same(whole)


@pytest.mark.parametrize("size", [1, 4, 9, 10_000])
def test_left_out_grams_are_on_no_list(spark, folded, size):
    every = foldterms.fold_term_counts(folded, (1, 2))
    some = foldterms.fold_term_counts(folded, (1, 2), None, size, 5)
    sizes = foldterms.fold_sizes(folded)
    lists = [sorted(map(tuple, foldterms.fold_vocabulary(c, sizes, 5, size).collect()))
             for c in (every, some)]
    assert lists[0] == lists[1]
    assert some.exceptAll(every).isEmpty()
    assert size > 4 or some.count() < every.count()


@pytest.mark.parametrize("size", [1, 3, 7, 60, 10_000])
def test_vocabulary_counts_only_grams_that_can_be_on_it(spark, size):
    rows = [("aa bb aa bb cc",), ("aa bb dd ee",), ("ee ff",), ("gg hh ii jj",), ("",)]
    texts = spark.createDataFrame(rows, "text string").union(spark.createDataFrame(
        [("bb aa " * 3 + f"x{i % 3} y{i}",) for i in range(12)], "text string"))
    terms = Pipeline(stages=vectorize.term_stages((1, 3), [])).fit(texts).transform(texts)
    want = vectorize.top_vocabulary(terms, size)
    got = vectorize.top_vocabulary(terms, size, words_col="_grams1")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    counted = vectorize.candidate_totals(terms, size, "terms", "_grams1").count()
    assert size > 4 or counted < vectorize.term_totals(terms).count()


def test_a_word_of_one_fold_does_not_undo_the_bounds(spark):
    rows = [(fold, term, n) for fold in range(5) for term, n in [("aa", 9), ("bb", 8), ("cc", 7), ("dd", 1)]]
    rows += [(0, "only here", 99)]
    counts = spark.createDataFrame(rows, "fold int, term string, n bigint")
    bounds = foldterms.side_bounds(counts, 5, 3)
    assert bounds == {foldterms.ALL_ROWS: 40, 0: 28, 1: 32, 2: 32, 3: 32, 4: 32}


def test_vectors_of_every_side_come_from_listed_terms(spark, folded):
    stop = ["aa"]
    tables = compare.fold_tables(folded, [(1, 1), (1, 2)], stop)
    assert "text" not in tables.terms.columns and tables.terms.columns[-1] == "fold"
    for ngram_range, side in (((1, 1), 0), ((1, 2), foldterms.ALL_ROWS)):
        model = foldterms.side_text_model(tables.vocabulary[ngram_range], side, "tfidf", ngram_range,
                                          stop, foldterms.side_moments(tables.scalers, side))
        wanted = {r.mail_id: r.features for r in model.transform(folded).collect()}
        found = {r.mail_id: r.features for r in compare.on_terms(model).transform(tables.terms).collect()}
        assert found == wanted and found
