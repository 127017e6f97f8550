"""Stratified folds as contiguous blocks per class, in row order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from mailshape.operators.scale import range_blocks, with_running_totals

FOLDS = 5


def fold_ranges(df: DataFrame, k: int = FOLDS, key: str = "mail_id") -> DataFrame:
    """``(label, fold, first_key, last_key)``: the key range of every class in every fold.

    Classes count in the order of their first appearance. If the labels were sorted in that order,
    row ``j`` would belong to fold ``j mod k``; the number of rows a class gets in a fold follows
    from this, and then each class hands its rows out in blocks of these sizes. Rows without a label
    are refused, as in training.
    """
    if not df.filter("label is null").isEmpty():
        raise ValueError("folds need a label in every row: drop or label the others first")
    order = [F.col(key)]
    blocks = range_blocks(df.select(key, "label"), order, "folds")
    sizes = blocks.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.min(key).alias("_first"))
    # One row per class from here on.
    earlier = Window.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    cells = sizes.withColumn("o", F.coalesce(F.sum("n").over(earlier), F.lit(0))).select(
        "label", "n", "o", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("fold"))
    n, o, fold = F.col("n"), F.col("o"), F.col("fold")
    size = F.floor((o + n + k - 1 - fold) / k) - F.floor((o + k - 1 - fold) / k)
    upto = Window.partitionBy("label").orderBy("fold")
    bounds = cells.withColumn("size", size).select(
        "label", "fold", (F.sum("size").over(upto) - F.col("size") + 1).alias("_from"),
        F.sum("size").over(upto).alias("_to"))
    ranked = with_running_totals(blocks, order, {"_rank": F.lit(1)}, ["label"])
    # k cells per class; every row meets the k cells of its class only.
    return (
        ranked.join(F.broadcast(bounds), "label")
        .filter(F.col("_rank").between(F.col("_from"), F.col("_to")))
        .groupBy("label", "fold")
        .agg(F.min(key).alias("first_key"), F.max(key).alias("last_key"))
    )


def with_folds(df: DataFrame, k: int = FOLDS, key: str = "mail_id") -> DataFrame:
    """Append ``fold`` (0..k-1). Only (key, label) is ranked; the full rows are not shuffled."""
    ranges = fold_ranges(df, k, key)
    held = (F.col("_label").eqNullSafe(F.col("label"))
            & F.col(key).between(F.col("first_key"), F.col("last_key")))
    return df.join(
        F.broadcast(ranges.withColumnRenamed("label", "_label")), held
    ).drop("_label", "first_key", "last_key")
