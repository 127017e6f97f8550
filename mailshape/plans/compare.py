"""Cross-validation, single model runs and the comparison of five models on a foreign corpus."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from statistics import fmean, pstdev

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame, functions as F

from mailshape.operators import evaluate, foldterms, models
from mailshape.operators.folds import FOLDS, with_folds
from mailshape.operators.vectorize import MAX_TERMS, feature_columns
from mailshape.session import land


@dataclass(frozen=True)
class TextModel:
    name: str
    model_type: str
    ngram_range: tuple[int, int]
    use_structural: bool
    vectorizer_type: str


# Fixed settings of the four term-based runs; the fifth is the embedding model.
TEXT_MODELS = [
    TextModel("Keyword Baseline", "logistic", (1, 1), False, "count"),
    TextModel("TFIDF Unigram", "logistic", (1, 1), False, "tfidf"),
    TextModel("Logistic", "logistic", (1, 2), True, "tfidf"),
    TextModel("SVM", "svm", (1, 2), True, "tfidf"),
]
EMBEDDING_MODEL = "Word2Vec"


def model_tag(name: str) -> str:
    """Name used for output folders: lower case, blanks to underscores, no plus or parentheses."""
    return name.lower().replace(" ", "_").translate(str.maketrans("", "", "+()"))


def pipeline_for(settings: TextModel, stop_words: Sequence[str] | None = None) -> Pipeline:
    return models.text_pipeline(settings.model_type, settings.ngram_range,
                                settings.use_structural, settings.vectorizer_type, stop_words)


@dataclass(frozen=True)
class CrossValidation:
    """The model fitted on all rows and the F1 of class 1 in every fold."""

    model: PipelineModel
    scores: list[float]

    @property
    def mean(self) -> float:
        return fmean(self.scores)

    @property
    def spread(self) -> float:
        """Twice the population deviation."""
        return 2.0 * pstdev(self.scores)


def landed_folds(train: DataFrame, k: int = FOLDS) -> DataFrame:
    """What a fit needs of ``train``, with its fold, landed by fold: once for all models."""
    columns = ["mail_id", "label", *feature_columns()]
    return land(with_folds(train.select(*columns), k), "folded", partition_by="fold")


def cross_validate(pipeline: Pipeline, folded: DataFrame, k: int = FOLDS,
                   parallelism: int = FOLDS) -> CrossValidation:
    """Refit the whole pipeline per fold of :func:`landed_folds` and on all rows, several fits at a
    time. (The built-in validator would check its fold column with a Python function per row and cache
    every fold's rows.)
    """
    held = F.col("fold")

    def score(fold: int) -> float:
        model = pipeline.fit(folded.filter(held != fold))
        return evaluate.binary_metrics(
            models.predict(model, folded.filter(held == fold))).first().f1

    session = folded.sparkSession
    with ThreadPoolExecutor(parallelism) as pool:
        scores = [pool.submit(inheritable_thread_target(session)(score), fold) for fold in range(k)]
        model = pool.submit(inheritable_thread_target(session)(pipeline.fit), folded)
        return CrossValidation(model.result(), [s.result() for s in scores])


@dataclass(frozen=True)
class FoldTables:
    """Landed folds with their listed terms, vocabularies by n-gram range and column moments."""

    folded: DataFrame
    terms: DataFrame
    vocabulary: dict[tuple[int, int], DataFrame]
    scalers: DataFrame
    stop_words: Sequence[str] | None
    k: int


def fold_tables(folded: DataFrame, ngram_ranges: Sequence[tuple[int, int]],
                stop_words: Sequence[str] | None = None, k: int = FOLDS) -> FoldTables:
    """One pass over the text of :func:`landed_folds` for all models: counts per fold and term up
    to the longest n-gram, from which every side's vocabulary and weights follow."""
    high = max(h for _, h in ngram_ranges)
    size = MAX_TERMS if all(low == 1 for low, _ in ngram_ranges) else None
    counts = land(foldterms.fold_term_counts(folded, (1, high), stop_words, size, k), "cv_terms")
    sizes = land(foldterms.fold_sizes(folded), "cv_sizes")
    scalers = land(foldterms.side_scalers(foldterms.fold_moments(folded), k), "cv_scalers")
    grams = F.size(F.split("term", " "))
    vocabulary = {
        (low, high): land(foldterms.fold_vocabulary(
            counts.filter(grams.between(low, high)), sizes, k), "cv_vocabulary")
        for low, high in set(ngram_ranges)}
    terms = land(foldterms.listed_terms(folded, (1, high), stop_words, vocabulary.values()),
                 "cv_listed", partition_by="fold")
    return FoldTables(folded, terms, vocabulary, scalers, stop_words, k)


def side_model(settings: TextModel, tables: FoldTables, held_out: int) -> PipelineModel:
    """The model of one training side: its term stages from the tables, a classifier fitted anew on
    the mails' listed terms."""
    moments = foldterms.side_moments(tables.scalers, held_out) if settings.use_structural else None
    text = foldterms.side_text_model(
        tables.vocabulary[settings.ngram_range], held_out, settings.vectorizer_type,
        settings.ngram_range, tables.stop_words, moments)
    rows = tables.terms
    if held_out != foldterms.ALL_ROWS:
        rows = rows.filter(F.col("fold") != held_out)
    fitted = models.RidgeClassifier(settings.model_type).fit(on_terms(text).transform(rows))
    return PipelineModel(stages=[*text.stages, fitted])


def on_terms(model: PipelineModel) -> PipelineModel:
    """The stages of a text model from the one that reads ``terms`` on."""
    first = next(i for i, s in enumerate(model.stages) if isinstance(s, CountVectorizerModel))
    return PipelineModel(stages=model.stages[first:])


def cross_validate_model(settings: TextModel, tables: FoldTables,
                         parallelism: int = FOLDS) -> CrossValidation:
    """As :func:`cross_validate`, with vocabularies, weights and scalers of all sides from
    :func:`fold_tables`: only the classifier is fitted per side, and no text is read again."""
    held = F.col("fold")

    def score(fold: int) -> float:
        model = side_model(settings, tables, fold)
        return evaluate.binary_metrics(
            models.predict(on_terms(model), tables.terms.filter(held == fold))).first().f1

    session = tables.folded.sparkSession
    run = inheritable_thread_target(session)
    with ThreadPoolExecutor(parallelism) as pool:
        scores = [pool.submit(run(score), fold) for fold in range(tables.k)]
        model = pool.submit(run(side_model), settings, tables, foldterms.ALL_ROWS)
        return CrossValidation(model.result(), [s.result() for s in scores])


def cross_validate_models(settings: Sequence[TextModel], tables: FoldTables) -> list[CrossValidation]:
    """:func:`cross_validate_model` of several models at once: their solvers' many small jobs
    interleave instead of waiting for one another."""
    run = inheritable_thread_target(tables.folded.sparkSession)
    with ThreadPoolExecutor(len(settings)) as pool:
        made = [pool.submit(run(cross_validate_model), m, tables) for m in settings]
        return [m.result() for m in made]


def cv_summary(validated: CrossValidation, name: str, folded: DataFrame) -> DataFrame:
    """Mean F1 over the folds and twice its population deviation."""
    return folded.sparkSession.range(1).select(
        F.lit(name).alias("model"), F.lit(validated.mean).alias("cv_f1_mean"),
        F.lit(validated.spread).alias("cv_f1_spread"))


def evaluation_tables(predictions: DataFrame) -> dict[str, DataFrame]:
    """Every table of one evaluated model, for :func:`mailshape.sources.sinks.write_chart_tables`."""
    return {
        "metrics": evaluate.binary_metrics(predictions),
        "classification_report": evaluate.classification_report(predictions),
        "confusion_matrix": evaluate.confusion_matrix(predictions),
        "pr_curve": evaluate.pr_curve(predictions),
        "average_precision": evaluate.average_precision(predictions),
    }


@dataclass(frozen=True)
class ModelRun:
    """One model on the foreign corpus. A failed run has neither model nor predictions."""

    name: str
    metrics: DataFrame
    model: PipelineModel | None = None
    predictions: DataFrame | None = None


def _run(name: str, model: PipelineModel, predictions: DataFrame, cv_mean: float | None = None,
         cv_spread: float | None = None) -> ModelRun:
    # Four narrow columns, landed: every table of the evaluation starts from them, not from the mails.
    predictions = land(predictions, "predictions")
    metrics = evaluate.binary_metrics(predictions).select(
        F.lit(name).alias("model"), "accuracy", "precision", "recall", "f1",
        F.lit(cv_mean).cast("double").alias("cv_f1_mean"),
        F.lit(cv_spread).cast("double").alias("cv_f1_spread"), F.lit("ok").alias("status"))
    return ModelRun(name, metrics, model, predictions)


def run_text_model(settings: TextModel, train: DataFrame, test: DataFrame,
                   tables: FoldTables | None = None,
                   stop_words: Sequence[str] | None = None,
                   validated: CrossValidation | None = None) -> ModelRun:
    """Fit on ``train`` and score ``test``; with :func:`fold_tables` of it, cross-validate on the
    way (the tables then hold the stop words), unless ``validated`` is given already."""
    mean = spread = None
    if tables is not None or validated is not None:
        validated = validated or cross_validate_model(settings, tables)
        model, mean, spread = validated.model, validated.mean, validated.spread
    else:
        model = pipeline_for(settings, stop_words).fit(train)
    return _run(settings.name, model, models.predict(model, test), mean, spread)


def run_embedding_model(train: DataFrame, test: DataFrame, **settings) -> ModelRun:
    model = models.train_embedding_model(train, **settings)
    return _run(EMBEDDING_MODEL, model, models.predict_probability(model, test))


def run_models(train: DataFrame, test: DataFrame, do_cv: bool = True,
               stop_words: Sequence[str] | None = None) -> list[ModelRun]:
    """The five runs. If the embedding model fails, its metrics row says so and the rest stands."""
    validated = [None] * len(TEXT_MODELS)
    if do_cv:
        tables = fold_tables(landed_folds(train), [m.ngram_range for m in TEXT_MODELS], stop_words)
        validated = cross_validate_models(TEXT_MODELS, tables)
    runs = [run_text_model(m, train, test, None, stop_words, v)
            for m, v in zip(TEXT_MODELS, validated)]
    try:
        runs.append(run_embedding_model(train, test))
    except Exception as error:  # any failure of this leg is reported in its row
        nothing = F.lit(None).cast("double")
        runs.append(ModelRun(EMBEDDING_MODEL, train.sparkSession.range(1).select(
            F.lit(EMBEDDING_MODEL).alias("model"),
            *[nothing.alias(c) for c in ("accuracy", "precision", "recall", "f1",
                                         "cv_f1_mean", "cv_f1_spread")],
            F.lit(f"failed: {error}").alias("status"))))
    return runs


def comparison(runs: Sequence[ModelRun]) -> DataFrame:
    """The metrics rows of several runs under one another."""
    return reduce(DataFrame.unionByName, [run.metrics for run in runs])


def compare_models(train: DataFrame, test: DataFrame, do_cv: bool = True,
                   stop_words: Sequence[str] | None = None) -> DataFrame:
    """One metrics row per model."""
    return comparison(run_models(train, test, do_cv, stop_words))
