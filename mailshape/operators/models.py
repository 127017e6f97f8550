"""Classifiers and pipeline factories on MLlib.

Two deviations are MLlib's: its linear SVM has the plain hinge loss with a free intercept (not the
squared hinge), and its word vectors are skip-gram with hierarchical softmax (not CBOW).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from mailshape.operators.vectorize import assembly_stages, embedding_stages, text_stages
from mailshape.session import land

LOGISTIC_ITERATIONS = 1000
SVM_ITERATIONS = 2000
TOLERANCE = 1e-4
# Every iteration of a solver is a job over the features, about a hundredth of a second of work on this
# many non-zero cells: a task for each, and not one for each small file the text stages left.
CELLS_PER_TASK = 2_000_000


class RidgeClassifier(Estimator):
    """A linear classifier with penalty strength C = 1 on the summed loss.

    MLlib minimises the mean loss, so its ``regParam`` is 1 / (C n) with the size n of the very frame
    being fitted. ``balanced`` weights a row by n / (2 n_class); these weights sum to n again.
    """

    def __init__(self, model_type: str = "logistic", balanced: bool = False, c: float = 1.0):
        super().__init__()
        if model_type not in ("logistic", "svm"):
            raise ValueError(f"unsupported model_type {model_type!r}: use 'logistic' or 'svm'")
        self.model_type, self.balanced, self.c = model_type, balanced, c

    def _fit(self, dataset: DataFrame) -> Model:
        # Hundreds of iterations follow, each a job over these rows: landed, they have a lineage of one
        # scan, to repeat if an executor is lost, and a task description without the text stages.
        rows = land(dataset.select("label", "features"), "features")
        n, positives, unlabelled, cells = rows.agg(
            F.count(F.lit(1)), F.count_if(F.col("label") == 1),
            F.count_if(F.col("label").isNull()),
            F.sum(F.size(F.unwrap_udt("features")["values"]))).first()
        if unlabelled:
            raise ValueError(f"{unlabelled} rows have no label: drop or label them first")
        if not 0 < positives < n:
            raise ValueError("training needs mails of both classes")
        rows = rows.coalesce(max(1, -(-(cells or 0) // CELLS_PER_TASK)))
        settings = dict(regParam=1.0 / (self.c * n), standardization=False, tol=TOLERANCE,
                        featuresCol="features", labelCol="label")
        if self.balanced:
            weight = F.when(F.col("label") == 1, n / (2.0 * positives)).otherwise(
                n / (2.0 * (n - positives)))
            rows = rows.withColumn("_weight", weight)
            settings["weightCol"] = "_weight"
        if self.model_type == "logistic":
            return LogisticRegression(maxIter=LOGISTIC_ITERATIONS, elasticNetParam=0.0,
                                      family="binomial", **settings).fit(rows)
        return LinearSVC(maxIter=SVM_ITERATIONS, **settings).fit(rows)


def text_pipeline(model_type: str = "logistic", ngram_range: tuple[int, int] = (1, 2),
                  use_structural: bool = True, vectorizer_type: str = "tfidf",
                  stop_words: Sequence[str] | None = None) -> Pipeline:
    """Term vectors, optionally the scaled structural block, and a linear classifier."""
    classifier = RidgeClassifier(model_type)
    return Pipeline(stages=[
        *text_stages(vectorizer_type, ngram_range, stop_words),
        *assembly_stages(use_structural), classifier])


def embedding_pipeline(use_structural: bool = True, **settings) -> Pipeline:
    """Word-vector centroids, optionally the structural block, and a balanced logistic classifier."""
    return Pipeline(stages=[
        *embedding_stages(**settings), *assembly_stages(use_structural),
        RidgeClassifier("logistic", balanced=True)])


def train_text_model(train: DataFrame, model_type: str = "logistic",
                     ngram_range: tuple[int, int] = (1, 2), use_structural: bool = True,
                     vectorizer_type: str = "tfidf",
                     stop_words: Sequence[str] | None = None) -> PipelineModel:
    return text_pipeline(
        model_type, ngram_range, use_structural, vectorizer_type, stop_words).fit(train)


def train_embedding_model(train: DataFrame, use_structural: bool = True,
                          **settings) -> PipelineModel:
    return embedding_pipeline(use_structural, **settings).fit(train)


def predict(model: PipelineModel, df: DataFrame, key: str = "mail_id") -> DataFrame:
    """``(key, label, prediction, score)`` with the signed margin as score."""
    return model.transform(df).select(
        key, "label", F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("rawPrediction")[1].alias("score"))


def predict_probability(model: PipelineModel, df: DataFrame, key: str = "mail_id") -> DataFrame:
    """``(key, label, prediction, score)`` with the probability of class 1 as score."""
    return model.transform(df).select(
        key, "label", F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("score"))
