"""Toxicity by cumulative-link ordinal regression over sparse text features.

``P(grade <= k) = s(t_k - x.w)`` with one weight vector for all ordered thresholds ``t_k``. Features
are hashed words and word beginnings; a text has each at most once. The fit uses a bounded sample of
labelled rows: feature counts come from Spark, features that go with higher grades are chosen, and
the few weights are found by gradient descent. Every row of a table is then scored by itself.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mailshape.llm.memos import alone
from mailshape.session import land

FEATURE_BITS = 18
BEGINNINGS = range(3, 9)
# Bound of the labelled sample, about: rows are taken by a hash of their id.
MAX_LABELLED = 20_000
MAX_FEATURES = 4096
# Signed root of the likelihood ratio that a feature's share among graded rows is the others'.
LEAST_EVIDENCE = 3.5
MEMO = 300_000

_LETTERS = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> set[int]:
    """Hashed features of the runs of letters in a lower-case word."""
    found = set()
    for run in _LETTERS.findall(word):
        names = [run] + ["^" + run[:k] for k in BEGINNINGS if k <= len(run)]
        found.update(zlib.crc32(n.encode("utf-8", "surrogatepass")) >> (32 - FEATURE_BITS)
                     for n in names)
    return found


def text_words(text: str | None) -> set[str]:
    return set((text or "").lower().split())


class FeatureMemo(dict):
    """Features of words that ``chosen`` holds (all if it is None), as tuples; emptied when full."""

    def __init__(self, chosen: frozenset[int] | None = None):
        super().__init__()
        self._chosen = chosen

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= MEMO:
            self.clear()
        found = word_features(word)
        value = tuple(sorted(found if self._chosen is None else found & self._chosen))
        if len(word) < 64:
            self[word] = value
        return value

    def of(self, text: str | None) -> list[int]:
        return sorted(set().union(*map(self.__getitem__, text_words(text))))


@dataclass
class OrdinalModel:
    """Weights by feature and increasing thresholds; ``grades`` is one more than thresholds."""

    weights: dict[int, float] = field(default_factory=dict)
    thresholds: list[float] = field(default_factory=list)

    def exceedance(self, margins: np.ndarray) -> np.ndarray:
        """P(grade > k) per row and threshold."""
        gap = np.asarray(margins)[:, None] - np.asarray(self.thresholds)[None, :]
        return 1 / (1 + np.exp(-np.clip(gap, -500, 500)))


def fit_ordinal(rows: list[tuple[int, list[int], int]], grades: int, penalty: float = 0.02,
                steps: int = 400) -> OrdinalModel:
    """Fit ``(grade, features, count)`` rows by full-gradient AdaGrad with an L2 penalty.

    Thresholds are the first one and the logarithms of the steps to the next, so they stay ordered;
    the penalty also keeps those of a grade without rows finite. Without rows every threshold is far
    above any margin.
    """
    if not rows:
        return OrdinalModel({}, [50.0 + k for k in range(grades - 1)])
    names = sorted({f for _, found, _ in rows for f in found})
    place = {f: i for i, f in enumerate(names)}
    grade = np.array([g for g, _, _ in rows])
    weight = np.array([c for _, _, c in rows], dtype=float)
    owner = np.repeat(np.arange(len(rows)), [len(f) for _, f, _ in rows])
    index = np.array([place[f] for _, found, _ in rows for f in found], dtype=np.int64)
    w, cuts = np.zeros(len(names)), np.zeros(grades - 1)
    w_sum, cut_sum = np.full(len(names), 1e-6), np.full(grades - 1, 1e-6)
    scale = 1 / weight.sum()
    for _ in range(steps):
        gaps = np.exp(cuts[1:])
        bounds = np.concatenate([[-np.inf], cuts[0] + np.concatenate([[0], np.cumsum(gaps)]),
                                 [np.inf]])
        margin = np.bincount(owner, w[index], len(rows))
        low, high = (1 / (1 + np.exp(-np.clip(bounds[grade + k] - margin, -500, 500)))
                     for k in (0, 1))
        chance = np.maximum(high - low, 1e-12)
        at_low, at_high = low * (1 - low) * weight / chance, high * (1 - high) * weight / chance
        by_row = at_high - at_low
        g_w = scale * np.bincount(index, by_row[owner], len(names)) + penalty * scale * w
        by_bound = (np.bincount(grade, at_low, grades)[1:] - np.bincount(grade, at_high, grades)[:-1])
        g_cut = np.concatenate([[by_bound.sum()], np.cumsum(by_bound[::-1])[::-1][1:] * gaps])
        g_cut = scale * (g_cut + penalty * cuts)
        w_sum += g_w ** 2
        cut_sum += g_cut ** 2
        w -= 0.3 * g_w / np.sqrt(w_sum)
        cuts -= 0.3 * g_cut / np.sqrt(cut_sum)
    bounds = cuts[0] + np.concatenate([[0], np.cumsum(np.exp(cuts[1:]))])
    return OrdinalModel(dict(zip(names, w.tolist())), bounds.tolist())


def evidence(with_high: np.ndarray, with_low: np.ndarray, high: int, low: int) -> np.ndarray:
    """Signed root of G^2 of each feature's two-by-two table."""
    total, n = with_high + with_low, high + low

    def part(seen, wanted):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(seen > 0, seen * np.log(seen / wanted), 0.0)

    ratio = 2 * (part(with_high, total * high / n) + part(with_low, total * low / n)
                 + part(high - with_high, (n - total) * high / n)
                 + part(low - with_low, (n - total) * low / n))
    return np.sqrt(np.maximum(ratio, 0)) * np.sign(with_high * low - with_low * high)


def _feature_counts(sample: DataFrame) -> DataFrame:
    """``(feature, high, low)``: rows above grade 0, and others, that have the feature."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = FeatureMemo()
        counts = np.zeros((2, 1 << FEATURE_BITS), dtype=np.int64)
        for batch in batches:
            for text, grade in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[int(grade == 0), memo.of(text)] += 1
        found = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(found), pa.array(counts[0, found]), pa.array(counts[1, found])],
            ["feature", "high", "low"])

    return sample.select("text", "grade").mapInArrow(
        count, "feature bigint, high bigint, low bigint").groupBy("feature").agg(
            F.sum("high").alias("high"), F.sum("low").alias("low"))


def _patterns(sample: DataFrame, chosen: frozenset[int]) -> DataFrame:
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = FeatureMemo(chosen)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([memo.of(t) for t in batch.column(0).to_pylist()],
                                           pa.list_(pa.int64()))], ["grade", "features"])

    return sample.select("text", "grade").mapInArrow(
        extract, "grade int, features array<bigint>").groupBy("grade", "features").count()


def fit(docs: DataFrame, grades_of: DataFrame, grades: int, id_col: str = "doc_id",
        text_col: str = "text", max_labelled: int = MAX_LABELLED) -> OrdinalModel:
    """Fit on rows of ``docs`` whose id has a grade (0 to ``grades`` - 1) in ``grades_of`` (``id``,
    ``grade``). Null ids and grades are left out; of several grades the highest counts.

    About ``max_labelled`` rows are used, by a hash of the id, so what reaches the driver (chosen
    features, distinct patterns of the sample) is bounded whatever the table's size.
    """
    labelled = grades_of.filter("id is not null and grade is not null").groupBy("id").agg(
        F.max("grade").cast("int").alias("grade"))
    share = int((1 << 31) * min(1.0, max_labelled / max(1, labelled.count())))
    labelled = labelled.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 31)) < share)
    # Broadcast: the sample of ids is bounded by max_labelled.
    sample = land(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(labelled), "id").select("text", "grade"), "graded")
    high, rows = sample.agg(F.coalesce(F.sum((F.col("grade") > 0).cast("bigint")), F.lit(0)),
                            F.count("*")).first()
    if not high or high == rows:
        return fit_ordinal([], grades)
    # At most 2^FEATURE_BITS rows of three numbers, whatever the texts hold.
    counts = _feature_counts(sample).filter("high > 1").toPandas().sort_values("feature")
    found = evidence(counts["high"].to_numpy(float), counts["low"].to_numpy(float), high, rows - high)
    order = np.argsort(-found, kind="stable")[:MAX_FEATURES]
    chosen = frozenset(int(f) for f in counts["feature"].to_numpy()[
        order[found[order] >= LEAST_EVIDENCE]])
    patterns = [(r["grade"], r["features"], r["count"])
                for r in _patterns(sample, chosen).collect()]
    return fit_ordinal(sorted(patterns), grades)


def severity(model: OrdinalModel, text: Column) -> Column:
    """Struct ``(expected double, grade int, toxic_chance double)`` of a text.

    ``expected`` is the sum of P(grade > k), ``grade`` the number of thresholds more likely exceeded
    than not, ``toxic_chance`` P(grade > 0). A null or empty text has no features.
    """
    weights, chosen = model.weights, frozenset(model.weights)

    @F.pandas_udf("expected double, grade int, toxic_chance double")
    def score(texts: pd.Series) -> pd.DataFrame:
        if chosen not in _memos:
            _memos.clear()
            _memos[chosen] = FeatureMemo(chosen)
        memo = alone(_memos[chosen])
        margins = np.array([sum(weights[f] for f in memo.of(t)) for t in texts], dtype=float)
        above = model.exceedance(margins)
        return pd.DataFrame({"expected": above.sum(axis=1), "grade": (above > 0.5).sum(axis=1),
                             "toxic_chance": above[:, 0]})

    return score(text)


# The memo of a Python worker's last model, so that a new batch finds the words of the one before.
_memos: dict[frozenset[int], FeatureMemo] = {}


def label_grades(labels: DataFrame) -> DataFrame:
    """Grades from 0/1 labels: 0 not toxic, 1 toxic, 2 toxic and of low quality."""
    return labels.select(F.col("doc_id").alias("id"), F.when(
        F.col("toxic") == 1, F.when(F.col("quality") == 0, 2).otherwise(1)).when(
            F.col("toxic") == 0, 0).alias("grade"))


GRADES = 3
