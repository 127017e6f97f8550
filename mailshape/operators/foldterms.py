"""One pass of term counts per fold, from which every cross-validation side follows.

The table ``(fold, term, n, df)`` holds the occurrences of a term and the mails holding it within
one fold. It is mergeable: the training side of held-out fold ``h`` has ``total - fold h`` of every
count, so the vocabulary and document frequencies of all ``k`` training sides and of all rows come
from this table, without reading the text again. Likewise the moments of the structural columns
(count, mean and sum of squared deviations per fold) merge exactly into every side's scaler.

The ``size`` most frequent terms of a side (equal counts ranked by term) are found exactly without
ranking all terms in one task: the most frequent terms overall give a lower bound of each side's
last count, and a side's count never exceeds the total, so only terms of at least that total can
be on the side's list.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel, ElementwiseProduct, Normalizer, SQLTransformer, VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, Window, functions as F

from mailshape.functions.structural import STRUCTURAL_COLUMNS
from mailshape.operators.scale import exploded
from mailshape.operators.vectorize import MAX_TERMS, between_words, term_stages
from mailshape.session import land

# Fold number of the side that holds every row.
ALL_ROWS = -1


def _cells(terms: DataFrame, terms_col: str) -> DataFrame:
    """``(fold, term, o, d)``: every occurrence counts towards n, every distinct term of a mail
    towards df."""
    cells = F.concat(
        F.transform(terms_col, lambda t: F.struct(t.alias("term"), F.lit(1).alias("o"),
                                                  F.lit(0).alias("d"))),
        F.transform(F.array_distinct(terms_col), lambda t: F.struct(
            t.alias("term"), F.lit(0).alias("o"), F.lit(1).alias("d"))))
    return terms.select("fold", F.inline(cells))


def _summed(cells: DataFrame) -> DataFrame:
    return cells.groupBy("fold", "term").agg(F.sum("o").alias("n"), F.sum("d").alias("df"))


def fold_term_counts(folded: DataFrame, ngram_range: tuple[int, int] = (1, 2),
                     stop_words: Sequence[str] | None = None, size: int | None = None,
                     k: int | None = None) -> DataFrame:
    """``(fold, term, n, df)`` of ``(fold, text)`` rows, combined map-side.

    With ``size`` and the number of folds ``k``, and n-grams from words on, n-grams are left out that
    cannot be among the ``size`` most frequent terms of any side: an n-gram occurs no oftener than
    each of its words, and a side's last count is no less than the ``size``-th of its words alone.
    """
    low, high = ngram_range
    terms = PipelineModel(stages=term_stages(ngram_range, stop_words)).transform(
        folded.select("fold", "text"))
    if size is None or low > 1 or high == 1:
        return _summed(_cells(terms, "terms"))
    words = land(exploded(terms, ["fold"], "_grams1", "term").groupBy("fold", "term").agg(
        F.count(F.lit(1)).alias("n")), "fold_words")
    floor = min(side_bounds(words, k, size).values())
    if not floor:
        return _summed(_cells(terms, "terms"))
    frequent = land(words.groupBy(F.col("term").alias("word")).agg(F.sum("n").alias("n")).filter(
        F.col("n") >= floor).select("word"), "fold_frequent")
    return _summed(between_words(_cells(terms, "terms"), frequent))


def listed_terms(folded: DataFrame, ngram_range: tuple[int, int], stop_words: Sequence[str] | None,
                 vocabularies: Iterable[DataFrame]) -> DataFrame:
    """``folded`` with ``terms`` in place of ``text``: those of a mail, with repeats, that are on the
    list of some side. A vectoriser of any side counts the same in them as in all terms of the text,
    so the text is split into terms once for all fits. ``fold`` is the last column.

    The lists hold a bounded number of terms per side, so they are collected.
    """
    listed = sorted({r.term for v in vocabularies for r in v.select("term").distinct().collect()})
    rows = PipelineModel(stages=term_stages(ngram_range, stop_words)).transform(folded)
    kept = F.filter("terms", lambda t: t.isin(listed))
    return rows.select(*[c for c in folded.columns if c not in ("text", "fold")], kept.alias("terms"),
                       "fold")


def fold_sizes(folded: DataFrame) -> DataFrame:
    """``(fold, rows)``."""
    return folded.groupBy("fold").agg(F.count(F.lit(1)).alias("rows"))


def _side(totals: DataFrame, counts: DataFrame, k: int) -> DataFrame:
    """``(held_out, term, n, df)`` of the terms of ``totals`` on every side with a count there."""
    every = F.array(*[F.lit(h) for h in [ALL_ROWS, *range(k)]])
    sides = totals.withColumn("held_out", F.explode(every))
    held = counts.select(F.col("fold").alias("held_out"), "term", F.col("n").alias("n_h"),
                         F.col("df").alias("df_h"))
    made = sides.join(held, ["held_out", "term"], "left").select(
        "held_out", "term", (F.col("n") - F.coalesce("n_h", F.lit(0))).alias("n"),
        (F.col("df") - F.coalesce("df_h", F.lit(0))).alias("df"))
    return made.filter(F.col("n") > 0)


def side_counts(counts: DataFrame, k: int) -> DataFrame:
    """``(held_out, term, n, df)`` of every side: all rows (:data:`ALL_ROWS`), and all but fold h."""
    totals = counts.groupBy("term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    return _side(totals, counts, k)


def side_bounds(counts: DataFrame, k: int, size: int) -> dict[int, int]:
    """Per side, a lower bound of the count of its ``size``-th term: the ``size``-th count among the
    top terms overall. Twice as many of these are taken, for some may occur in one fold only and so
    be missing on a side. A side with fewer terms has none (0)."""
    counts = counts.select("fold", "term", "n", F.lit(0).alias("df"))
    totals = counts.groupBy("term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    top = totals.orderBy(F.desc("n"), "term").limit(2 * size).select("term")
    ranked = _side(totals.join(top, "term"), counts.join(top, "term"), k).select(
        "held_out", "n", F.row_number().over(
            Window.partitionBy("held_out").orderBy(F.desc("n"), "term")).alias("r"))
    least = {r.held_out: r.n for r in ranked.filter(F.col("r") == size).collect()}
    return {h: least.get(h, 0) for h in [ALL_ROWS, *range(k)]}


def fold_vocabulary(counts: DataFrame, sizes: DataFrame, k: int,
                    size: int = MAX_TERMS) -> DataFrame:
    """``(held_out, rank, term, n, df, idf)``: the ``size`` most frequent terms of every side.

    ``idf`` is ``ln((1 + rows) / (1 + df)) + 1`` over the side's rows, as the vectoriser weighs.
    """
    spark = counts.sparkSession
    totals = counts.groupBy("term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    least = side_bounds(counts, k, size)
    floor = min(least.values())
    bounds = spark.createDataFrame(list(least.items()), "held_out int, least long")
    candidates = _side(totals.filter(F.col("n") >= floor), counts, k).join(
        F.broadcast(bounds), "held_out").filter(F.col("n") >= F.col("least"))
    order = Window.partitionBy("held_out").orderBy(F.desc("n"), "term")
    chosen = candidates.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)
    per_fold = {r.fold: r.rows for r in sizes.select("fold", "rows").collect()}
    everything = sum(per_fold.values())
    side_rows = spark.createDataFrame(
        [(h, everything - per_fold.get(h, 0)) for h in [ALL_ROWS, *range(k)]],
        "held_out int, side_rows long")
    return chosen.join(F.broadcast(side_rows), "held_out").select(
        "held_out", F.col("rank").cast("int").alias("rank"), "term", "n", "df",
        (F.log((F.col("side_rows") + 1) / (F.col("df") + 1)) + 1).alias("idf"))


def fold_moments(folded: DataFrame,
                 columns: Sequence[str] = tuple(STRUCTURAL_COLUMNS)) -> DataFrame:
    """``(fold, feature, rows, mean, m2)``: count, mean and sum of squared deviations per fold and
    column, each from Spark's stable one-pass aggregates."""
    per_fold = folded.groupBy("fold").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.avg(c).alias(f"m_{c}") for c in columns],
        *[(F.var_pop(c) * F.count(c)).alias(f"v_{c}") for c in columns])
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"m_{c}").alias("mean"),
                               F.col(f"v_{c}").alias("m2")) for c in columns])
    return per_fold.select("fold", "rows", F.inline(cells))


def side_scalers(moments: DataFrame, k: int) -> DataFrame:
    """``(held_out, feature, mean, std)`` of every side, by the exact merge of its folds' moments:
    ``mean = sum(n_i m_i) / N`` and ``M2 = sum(M2_i + n_i (m_i - mean)^2)``, ``std = sqrt(M2 / N)``."""
    every = F.array(*[F.lit(h) for h in [ALL_ROWS, *range(k)]])
    parts = moments.withColumn("held_out", F.explode(every)).filter(F.col("fold") != F.col("held_out"))
    merged = parts.groupBy("held_out", "feature").agg(
        F.sum("rows").alias("n"), (F.sum(F.col("rows") * F.col("mean")) / F.sum("rows")).alias("mean"))
    spread = parts.withColumnRenamed("mean", "mean_p").join(merged, ["held_out", "feature"])
    spread = spread.groupBy("held_out", "feature").agg(
        F.first("mean").alias("mean"), F.first("n").alias("n"),
        F.sum(F.col("m2") + F.col("rows") * (F.col("mean_p") - F.col("mean")) ** 2).alias("m2"))
    return spread.select("held_out", "feature", "mean", F.sqrt(F.col("m2") / F.col("n")).alias("std"))


def side_moments(scalers: DataFrame, held_out: int,
                 columns: Sequence[str] = tuple(STRUCTURAL_COLUMNS)) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of the columns on one side, in their order, from
    :func:`side_scalers`."""
    rows = {r.feature: (r.mean, r.std) for r in
            scalers.filter(F.col("held_out") == held_out).collect()}
    return {c: rows[c] for c in columns}


def side_text_model(vocabulary: DataFrame, held_out: int, vectorizer_type: str,
                    ngram_range: tuple[int, int], stop_words: Sequence[str] | None,
                    moments: dict[str, tuple[float, float]] | None) -> PipelineModel:
    """The fitted term and assembly stages of one side, built from its rows of the tables."""
    rows = vocabulary.filter(F.col("held_out") == held_out).orderBy("rank").select(
        "term", "idf").collect()
    if not rows:
        raise ValueError("empty vocabulary: no terms are left after stop-word removal")
    terms = [r.term for r in rows]
    stages = list(term_stages(ngram_range, stop_words))
    if vectorizer_type == "count":
        stages.append(CountVectorizerModel.from_vocabulary(terms, "terms", "text_features"))
    elif vectorizer_type == "tfidf":
        stages += [CountVectorizerModel.from_vocabulary(terms, "terms", "counts"),
                   ElementwiseProduct(scalingVec=Vectors.dense([r.idf for r in rows]),
                                      inputCol="counts", outputCol="weighted"),
                   Normalizer(p=2.0, inputCol="weighted", outputCol="text_features")]
    else:
        raise ValueError(f"unsupported vectorizer_type {vectorizer_type!r}: use 'tfidf' or 'count'")
    if moments is None:
        stages.append(VectorAssembler(inputCols=["text_features"], outputCol="features"))
    else:
        scaled = ", ".join(f"(`{c}` - ({m!r}D)) / {s or 1.0!r}D AS `{c}_scaled`"
                           for c, (m, s) in moments.items())
        stages += [SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__"),
                   VectorAssembler(inputCols=["text_features", *[f"{c}_scaled" for c in moments]],
                                   outputCol="features")]
    return PipelineModel(stages=stages)
