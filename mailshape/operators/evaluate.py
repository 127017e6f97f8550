"""Scores of predictions: ``label`` (0/1), ``prediction`` (0/1) and, for curves, ``score``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mailshape.functions.text import safe_ratio
from mailshape.operators.profile import class_name
from mailshape.operators.scale import range_blocks, with_running_totals


def confusion_counts(predictions: DataFrame) -> DataFrame:
    """One row: tn, fp, fn, tp."""
    truth, guess = F.col("label"), F.col("prediction")
    return predictions.agg(
        F.count_if((truth == 0) & (guess == 0)).alias("tn"),
        F.count_if((truth == 0) & (guess == 1)).alias("fp"),
        F.count_if((truth == 1) & (guess == 0)).alias("fn"),
        F.count_if((truth == 1) & (guess == 1)).alias("tp"))


def _f1(precision, recall):
    return safe_ratio(2 * precision * recall, precision + recall)


def binary_metrics(predictions: DataFrame) -> DataFrame:
    """Accuracy, and precision, recall and F1 of class 1; 0 where a denominator is 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    rates = confusion_counts(predictions).select(
        safe_ratio(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        safe_ratio(tp, tp + fp).alias("precision"), safe_ratio(tp, tp + fn).alias("recall"))
    return rates.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    """Four cells (true label, predicted label), zeros included."""
    return confusion_counts(predictions).select(F.inline(F.array(*[
        F.struct(F.lit(truth).alias("label"), F.lit(guess).alias("prediction"),
                 F.col(cell).alias("n_rows"))
        for cell, truth, guess in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))])))


def classification_report(predictions: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages."""
    # One pass over the predictions; everything else is arithmetic on its four counts.
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    per_class = confusion_counts(predictions).select(
        F.inline(F.array(
            F.struct(F.lit(0).alias("label"), tn.alias("hit"), (tn + fn).alias("guessed"),
                     (tn + fp).alias("support")),
            F.struct(F.lit(1).alias("label"), tp.alias("hit"), (tp + fp).alias("guessed"),
                     (tp + fn).alias("support"))))
    ).select(
        class_name(F.col("label")).alias("row"), "hit", "support",
        safe_ratio(F.col("hit"), F.col("guessed")).alias("precision"),
        safe_ratio(F.col("hit"), F.col("support")).alias("recall"),
    ).withColumn("f1_score", _f1(F.col("precision"), F.col("recall")))
    scores = ["precision", "recall", "f1_score"]

    def summary(row: str, *values) -> DataFrame:
        return per_class.agg(
            *[v.alias(c) for v, c in zip(values, scores)], F.sum("support").alias("support")
        ).select(F.lit(row).alias("row"), *scores, "support")

    accuracy = safe_ratio(F.sum("hit"), F.sum("support"))
    nothing = F.lit(None).cast("double")
    return (
        per_class.select("row", *scores, "support")
        .unionByName(summary("accuracy", nothing, nothing, accuracy))
        .unionByName(summary("macro avg", *[F.avg(c) for c in scores]))
        .unionByName(summary("weighted avg", *[
            safe_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")) for c in scores]))
    )


def _cumulative(predictions: DataFrame) -> DataFrame:
    """Per distinct score, from the highest down: own and cumulative positives and rows."""
    per_score = predictions.groupBy("score").agg(
        F.count_if(F.col("label") == 1).alias("positives"), F.count(F.lit(1)).alias("rows"))
    order = [F.desc("score")]
    blocks = range_blocks(per_score, order, "scores")
    return with_running_totals(
        blocks, order, {"tp": F.col("positives"), "retrieved": F.col("rows")})


def pr_curve(predictions: DataFrame) -> DataFrame:
    """Precision and recall at every distinct score as threshold, and the end point (1, 0).

    The running counts go through range blocks with offsets, never through one global window.
    """
    running = _cumulative(predictions)
    positives = running.agg(F.sum("positives")).scalar()
    points = running.withColumn("_all", positives).select(
        F.col("score").alias("threshold"),
        safe_ratio(F.col("tp"), F.col("retrieved")).alias("precision"),
        F.when(F.col("_all") == 0, 1.0).otherwise(
            F.col("tp") / F.col("_all")).alias("recall"))
    end = predictions.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"))
    return points.unionByName(end)


def average_precision(predictions: DataFrame) -> DataFrame:
    """Sum over thresholds of (gain in recall) x precision, without interpolation.

    The gain of a threshold is its own share of the positives, so no look at the previous row is
    needed.
    """
    return _cumulative(predictions).agg(
        safe_ratio(F.sum(F.col("positives") * F.col("tp") / F.col("retrieved")),
                   F.sum("positives")).alias("average_precision"))
