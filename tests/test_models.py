import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from mailshape.operators import folds, models, vectorize
from mailshape.operators.prepare import preprocess
from mailshape.plans import compare
from mailshape.session import land

HAM = ["meeting", "report", "project", "team", "lunch", "review", "agenda"]
SPAM = ["winner", "cash", "prize", "viagra", "offer", "click", "bonus"]


def corpus(spark, n, seed, noise=0.0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        label = int(rng.random() < 0.4)
        words = [rng.choice(SPAM if (label == 1) != (rng.random() < noise) else HAM) for _ in range(12)]
        body = " ".join(words + rng.choices(["common", "shared", "words"], k=6)) + "!" * label
        rows.append((i, "Subject " + rng.choice(words), body, f"user{i % 7}@ex.org", label))
    return preprocess(spark.createDataFrame(
        rows, "mail_id bigint, subject string, body string, sender string, label int"))


@pytest.fixture(scope="module")
def train(spark):
    return land(corpus(spark, 80, 1, 0.1), "train")


@pytest.fixture(scope="module")
def test_set(spark):
    return land(corpus(spark, 40, 2, 0.1), "test")


def test_terms_bridge_removed_words(spark):
    stages = Pipeline(stages=vectorize.term_stages((1, 2), ["the", "of"]))
    df = spark.createDataFrame([("the cat, of x sat!! a1",), ("one",), ("",)], "text string")
    assert [r.terms for r in stages.fit(df).transform(df).collect()] == [
        ["cat", "sat", "a1", "cat sat", "sat a1"], ["one"], []]


def test_vocabulary_ties_and_limit(spark):
    df = spark.createDataFrame([(["b", "a", "c"],), (["c", "d"],)], "terms array<string>")
    rows = vectorize.top_vocabulary(df, 3).orderBy("rank").collect()
    assert [(r.rank, r.term, r.n) for r in rows] == [(1, "c", 2), (2, "a", 1), (3, "b", 1)]


def test_tfidf_formula_and_unknown_terms(spark):
    train = spark.createDataFrame([(1, "aa bb bb"), (2, "aa cc")], "mail_id int, text string")
    model = Pipeline(stages=vectorize.text_stages("tfidf", (1, 1), [])).fit(train)
    names = model.stages[3].vocabulary
    test = spark.createDataFrame([(3, "bb zz aa"), (4, "zz")], "mail_id int, text string")
    rows = vectorize.matrix_cells(model.transform(test), "text_features", names).collect()
    idf = {"aa": 1.0, "bb": np.log(3 / 2) + 1}
    norm = np.hypot(idf["aa"], idf["bb"])
    assert {(r.mail_id, r.term): r.value for r in rows} == pytest.approx(
        {(3, t): idf[t] / norm for t in idf})


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    scaler = vectorize.PopulationScaler(["a", "b"])
    rows = scaler.fit(df).transform(df).select(*scaler.output_columns()).collect()
    assert sorted(map(tuple, rows)) == [(-1.0, 0.0), (1.0, 0.0)]


def test_centroids_average_known_words_only(spark):
    df = spark.createDataFrame([(1, "a b b zz"), (2, "zz"), (3, "")], "mail_id int, text string")
    vectors = spark.createDataFrame([("a", [3.0, 0.0]), ("b", [0.0, 3.0])], "word string, vector array<double>")
    rows = vectorize.centroids(df, vectors, 2).orderBy("mail_id").collect()
    assert [(r.n_known, r.centroid) for r in rows] == [(3, [1.0, 2.0]), (0, [0.0, 0.0]), (0, [0.0, 0.0])]


def test_centroids_in_blocks_shuffle_sums_only(spark, monkeypatch):
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(40)]
    table = {w: rng.normal(size=3).tolist() for w in words[:30]}
    vectors = spark.createDataFrame(list(table.items()), "word string, vector array<double>")
    texts = [(i, " ".join(rng.choice(words, 50))) for i in range(20)]
    # Mails of one key share their sums, those without a key have none.
    rows = [*texts, (3, "w1 w1"), (None, "w2"), (30, None), (31, "w39")]
    df = spark.createDataFrame(rows, "mail_id int, text string").repartition(4)
    wanted = []
    for key, _ in rows:
        known = [np.array(table[w]) for k, t in rows if k == key and key is not None
                 for w in (t or "").split(" ") if w in table]
        wanted.append((key, len(known), np.mean(known, axis=0).tolist() if known else [0.0] * 3))
    for block in (vectorize.VECTOR_BLOCK, 700):
        monkeypatch.setattr(vectorize, "VECTOR_BLOCK", block)
        made = vectorize.centroids(df, vectors, 3)
        found = sorted(((r.mail_id, r.n_known, r.centroid) for r in made.collect()), key=str)
        for (key, n, mean), (key_, n_, mean_) in zip(found, sorted(wanted, key=str), strict=True):
            assert (key, n) == (key_, n_) and mean == pytest.approx(mean_)
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate [mail_id" in plan and ", word#" not in "".join(
            line for line in plan.splitlines() if "Aggregate [" in line)


def test_rows_without_a_label_are_refused_on_both_paths(spark):
    df = spark.createDataFrame([(1, "aa bb", 1), (2, "cc dd", 0), (3, "ee ff", None)],
                               "mail_id bigint, text string, label int")
    with pytest.raises(ValueError, match="label"):
        models.train_text_model(df, use_structural=False, ngram_range=(1, 1))
    with pytest.raises(ValueError, match="label"):
        folds.with_folds(df, 2)


def test_trained_centroids_match_their_word_vectors(spark, train):
    model = Pipeline(stages=vectorize.embedding_stages(vector_size=8)).fit(train)
    mails = train.select("mail_id", F.concat("text", F.lit(" neverseen")).alias("text"))
    known = {r.word: np.array(r.vector.toArray())
             for r in model.stages[1].embedding.getVectors().collect()}
    for row in model.transform(mails).limit(5).collect():
        want = np.mean([known[w] for w in row.text.split() if w in known], axis=0)
        assert row.text_features.toArray() == pytest.approx(want, abs=1e-6)
    nothing = spark.createDataFrame([("neverseen",), ("",)], "text string")
    assert {tuple(r.text_features.toArray()) for r in model.transform(nothing).collect()} == {(0.0,) * 8}


def test_logistic_solves_the_summed_loss_objective(spark, train):
    stages = models.text_pipeline(use_structural=False).getStages()
    features = Pipeline(stages=stages[:-1]).fit(train).transform(train)
    for balanced in (False, True):
        old, models.TOLERANCE = models.TOLERANCE, 1e-10
        try:
            model = models.RidgeClassifier("logistic", balanced).fit(features)
        finally:
            models.TOLERANCE = old
        rows = features.select("label", vector_to_array("features").alias("x")).collect()
        x, y = np.array([r.x for r in rows]), np.array([r.label for r in rows])
        weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum()))) if balanced else 1.0
        p = 1 / (1 + np.exp(-(x @ model.coefficients.toArray() + model.intercept)))
        gradient = x.T @ (weight * (p - y)) + model.coefficients.toArray()
        assert np.abs(gradient).max() < 1e-3 and abs((weight * (p - y)).sum()) < 1e-3


@pytest.mark.parametrize("settings", compare.TEXT_MODELS, ids=lambda m: m.name)
def test_text_models_separate_clear_classes(spark, settings):
    clear, other = land(corpus(spark, 60, 3), "clear"), land(corpus(spark, 30, 4), "other")
    run = compare.run_text_model(settings, clear, other)
    assert run.metrics.first().f1 == 1.0
    again = models.predict(compare.pipeline_for(settings).fit(clear), other)
    same = lambda df: sorted((r.mail_id, r.prediction, round(r.score, 9)) for r in df.collect())
    assert same(again) == same(run.predictions)
    assert all((r.score > 0) == (r.prediction == 1) for r in again.collect())


def test_nothing_is_learned_from_the_test_corpus(spark, train, test_set):
    model = models.train_text_model(train)
    before = models.predict(model, test_set).collect()
    longer = test_set.unionByName(corpus(spark, 20, 9).withColumn("mail_id", F.col("mail_id") + 1000))
    after = models.predict(model, longer).filter("mail_id < 1000").collect()
    assert sorted(map(tuple, before)) == sorted(map(tuple, after))


def test_fitted_text_model_is_plain_mllib(spark, train, test_set, tmp_path):
    model = models.train_text_model(train)
    model.write().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    assert sorted(map(tuple, models.predict(loaded, test_set).collect())) == sorted(
        map(tuple, models.predict(model, test_set).collect()))


def test_cross_validation(train):
    settings = compare.TEXT_MODELS[1]
    folded = compare.landed_folds(train)
    assert folded.columns == ["mail_id", "label", *vectorize.feature_columns(), "fold"]
    validated = compare.cross_validate(compare.pipeline_for(settings), folded)
    row = compare.cv_summary(validated, settings.name, train).first()
    assert 0.5 < row.cv_f1_mean <= 1.0 and row.cv_f1_spread >= 0.0

    from mailshape.operators.evaluate import binary_metrics
    from mailshape.operators.folds import with_folds
    parts = land(with_folds(train), "parts")
    scores = [binary_metrics(models.predict(
        compare.pipeline_for(settings).fit(parts.filter(F.col("fold") != k)),
        parts.filter(F.col("fold") == k))).first().f1 for k in range(5)]
    assert (row.cv_f1_mean, row.cv_f1_spread) == pytest.approx((np.mean(scores), 2 * np.std(scores)))


def test_comparison_reports_a_failing_embedding_leg(spark, train, test_set, monkeypatch):
    def broken(*_, **__):
        raise RuntimeError("no vectors today")
    monkeypatch.setattr(compare, "run_embedding_model", broken)
    rows = compare.compare_models(train, test_set, do_cv=False).collect()
    assert [r.model for r in rows] == [m.name for m in compare.TEXT_MODELS] + ["Word2Vec"]
    assert [r.status for r in rows] == ["ok"] * 4 + ["failed: no vectors today"]


def test_embedding_model(spark, train, test_set):
    run = compare.run_embedding_model(train, test_set)
    assert run.metrics.first().f1 > 0.8
    scores = [r.score for r in run.predictions.collect()]
    assert all(0 <= s <= 1 for s in scores)
    tables = compare.evaluation_tables(run.predictions)
    assert tables["pr_curve"].count() == len(set(scores)) + 1


def test_rejections_and_tags(train):
    with pytest.raises(ValueError, match="both classes"):
        models.train_text_model(train.filter("label = 1"))
    with pytest.raises(ValueError, match="model_type"):
        models.text_pipeline(model_type="tree")
    with pytest.raises(ValueError, match="vectorizer_type"):
        models.text_pipeline(vectorizer_type="hash")
    with pytest.raises(ValueError, match="occurs"):
        vectorize.CentroidVectorizer(min_count=10**6).fit(train.selectExpr("split(text, ' ') AS tokens"))
    assert compare.model_tag("TFIDF Unigram (1+2)") == "tfidf_unigram_12"
    assert vectorize.feature_columns(False) == ["text"] and len(vectorize.feature_columns()) == 22


def test_solver_tasks_go_by_cells(spark, train, monkeypatch):
    seen = []

    class Solver:
        def __init__(self, **settings):
            pass

        def fit(self, rows):
            seen.append((rows.rdd.getNumPartitions(), rows.count()))

    monkeypatch.setattr(models, "LinearSVC", Solver)
    rows = train.select("label", F.array(F.lit(1.0), F.col("label") * 1.0).alias("x"))
    many = rows.withColumn("features", array_to_vector("x")).repartition(16)
    models.RidgeClassifier("svm").fit(many)
    monkeypatch.setattr(models, "CELLS_PER_TASK", 40)
    models.RidgeClassifier("svm").fit(many)
    assert seen == [(1, 80), (4, 80)]


def test_embedding_partitions_grow_with_the_tokens(spark, monkeypatch):
    seen = []

    class Trainer:
        def __init__(self, numPartitions, **settings):
            seen.append(numPartitions)

        def fit(self, tokens):
            raise RuntimeError("not trained here")

    monkeypatch.setattr(vectorize, "Word2Vec", Trainer)
    tokens = spark.createDataFrame([(["aa", "bb"] * 10,)] * 5, "tokens array<string>")
    for settings in ({}, {"partition_tokens": 9}):
        with pytest.raises(RuntimeError):
            vectorize.CentroidVectorizer(**settings).fit(tokens)
    assert seen == [vectorize.TRAINING_PARTITIONS, 12]
