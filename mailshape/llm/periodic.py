"""Periodic runs of words, found with a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are
identical), at least ``max(MIN_LENGTH, MIN_EXPONENT * q)`` words long, that no neighbouring word
extends keeping period ``q``. Collapsing keeps the first ``q`` words of every run and drops the rest
of it.

Method: for every power of two ``L``, factors of ``L`` words are named so that equal factors have
equal names (names of length ``2L`` are ranks of pairs of names of length ``L``). The successor of
an occurrence (next occurrence of the same name) at most ``2L`` words on proposes the period of that
distance; successive occurrences at one distance form an arithmetic progression, which is extended
once to the maximal stretch of that period and not again. A run of smallest period ``q`` is proposed
at the ``L`` with ``q <= L < 2q``: inside it the factor at its start occurs next exactly ``q`` words
on, since a primitive root differs from its rotations. Stretches are deduplicated and kept where
their period is the smallest (a smaller one would divide it) and they are long enough.

Spark deals documents out as they lie; each is worked on in one task with numpy, in time about
``n log^2 n`` for ``n`` words.

Edge cases: a null or empty word list has no runs; ties of the best run go to the smallest start,
then period; repeated rows give equal results each; very long texts are worked on whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.functions import pandas_udf
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

MIN_LENGTH = 24
MIN_EXPONENT = 3
WORD = r"[^\x20\x09-\x0D]+"

RUNS = StructType([StructField("n_runs", LongType()),
                   *[StructField(k, ArrayType(LongType())) for k in ("starts", "lengths", "periods")],
                   StructField("collapsed", StringType())])


def _stretch(ids: np.ndarray, i: int, d: int, known: int) -> tuple[int, int]:
    """Maximal stretch of period ``d`` about ``[i, i + d + known)`` where that already has it."""
    n = len(ids)
    left, step = i, 64
    while left > 0:
        lo = max(0, left - step)
        bad = np.flatnonzero(ids[lo:left] != ids[lo + d:left + d])
        if len(bad):
            left = lo + bad[-1] + 1
            break
        left, step = lo, step * 2
    right, step = i + known, 64
    while right + d < n:
        hi = min(n - d, right + step)
        bad = np.flatnonzero(ids[right:hi] != ids[right + d:hi + d])
        if len(bad):
            right = right + bad[0]
            break
        right, step = hi, step * 2
    else:
        right = max(right, n - d)
    return left, right + d


# Proposals of one gap from which all stretches of that period are found in one pass.
WHOLE_PASS = 16


def _progressions(ids: np.ndarray, at: np.ndarray, d: int, width: int):
    """Maximal stretches of period ``d`` through the proposals at ``at`` (ascending)."""
    n = len(ids)
    if len(at) >= WHOLE_PASS:
        # Every maximal stretch of period d at once, kept where a proposal lies in it.
        equal = np.concatenate([[False], ids[:n - d] == ids[d:], [False]]).astype(np.int8)
        edges = np.diff(equal)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        hit = np.searchsorted(ends, at, side="right")
        for k in np.unique(hit):
            yield int(starts[k]), int(ends[k] + d - starts[k]), d
        return
    k = 0
    while k < len(at):
        s, e = _stretch(ids, int(at[k]), d, width)
        yield int(s), int(e - s), d
        k = max(k + 1, int(np.searchsorted(at, e - d, side="left")))


def _primitive(ids: np.ndarray, start: int, d: int) -> bool:
    root = ids[start:start + d]
    for p in range(1, d // 2 + 1):
        if d % p == 0 and np.array_equal(root[:d - p], root[p:]):
            return False
    return True


def find_runs(ids: np.ndarray, min_length: int = MIN_LENGTH,
              min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """Runs ``(start, length, period)`` of a sequence (of words or ids), by start, then period.

    ``min_exponent`` must be at least 3: the proposal at ``q <= L < 2q`` needs ``q + L`` words of the
    run.
    """
    if min_exponent < 3:
        raise ValueError("runs are proposed for exponents of 3 and more")
    ids = np.unique(np.asarray(ids), return_inverse=True)[1].astype(np.int64).reshape(-1)
    n = len(ids)
    # Starts whose factor of the current width occurs more than once, ascending, with its name.
    # A factor met once is met once at every greater width, so such starts are left out.
    pos, names = np.arange(n), ids
    found: set[tuple[int, int, int]] = set()
    width = 1
    while len(pos) > 1:
        order = np.argsort(names, kind="stable")
        ranked, named = pos[order], names[order]
        same = named[1:] == named[:-1]
        at, gap = ranked[:-1][same], ranked[1:][same] - ranked[:-1][same]
        near = gap <= 2 * width
        at, gap = at[near], gap[near]
        # Progressions of one gap: after a stretch is extended, every start inside it is passed by.
        by = np.lexsort((at, gap))
        at, gap = at[by], gap[by]
        bounds = np.flatnonzero(np.diff(gap)) + 1
        for part in np.split(np.arange(len(at)), bounds):
            if len(part):
                found.update(_progressions(ids, at[part], int(gap[part[0]]), width))
        repeated = np.zeros(n + 1, dtype=bool)
        repeated[ranked[:-1][same]] = repeated[ranked[1:][same]] = True
        full = np.full(n + 1, -1, dtype=np.int64)
        full[pos] = names
        pos = np.flatnonzero(repeated)
        pos = pos[(pos + 2 * width <= n)]
        pos = pos[repeated[pos + width]]
        pairs = full[pos] * (int(names.max()) + 1) + full[pos + width]
        names = np.unique(pairs, return_inverse=True)[1].astype(np.int64).reshape(-1)
        width *= 2
    runs = [(s, length, d) for s, length, d in found
            if length >= max(min_length, min_exponent * d) and _primitive(ids, s, d)]
    return sorted(runs)


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """Words outside every run's part after its first period."""
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    for s, length, d in runs:
        drop[s + d] += 1
        drop[s + length] -= 1
    keep = np.cumsum(drop)[:len(words)] == 0
    return [w for w, k in zip(words, keep) if k]


@pandas_udf(RUNS)
def word_runs(words: pd.Series) -> pd.DataFrame:
    """Column function over arrays of words: runs as parallel arrays, and the collapsed text."""
    rows = {"n_runs": [], "starts": [], "lengths": [], "periods": [], "collapsed": []}
    for w in words:
        w = [] if w is None else list(w)
        runs = find_runs(np.array(w, dtype=object)) if w else []
        rows["n_runs"].append(len(runs))
        rows["starts"].append([r[0] for r in runs])
        rows["lengths"].append([r[1] for r in runs])
        rows["periods"].append([r[2] for r in runs])
        rows["collapsed"].append(" ".join(collapse(w, runs)))
    return pd.DataFrame(rows)


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), 0), F.array().cast("array<string>"))


def best_run(found: Column) -> Column:
    """The run of greatest length/period (ties: smallest start, then period), or null; native."""
    runs = F.arrays_zip(found["starts"].alias("start"), found["lengths"].alias("length"),
                        found["periods"].alias("period"))

    def better(a, b):
        cross = a["length"] * b["period"] - b["length"] * a["period"]
        return F.when(b.isNull(), a).when(cross > 0, a).when(cross < 0, b).when(
            (a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["period"] < b["period"])),
            a).otherwise(b)

    empty = F.lit(None).cast("struct<start:long,length:long,period:long>")
    return F.aggregate(runs, empty, lambda acc, r: better(r, acc))


def runs_digest(found: Column) -> Column:
    """sha256 of every run's ``start,length,period`` and a line feed, by start then period."""
    runs = F.arrays_zip(found["starts"].alias("s"), found["lengths"].alias("l"),
                        found["periods"].alias("p"))
    lines = F.transform(runs, lambda r: F.concat_ws(",", *[r[k].cast("string") for k in "slp"]))
    return F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size(lines) > 0, "\n").otherwise("")),
                  256)


def periodic_runs(docs: DataFrame, words: Column | None = None) -> DataFrame:
    """Rows of ``docs`` with the struct ``runs`` of :data:`RUNS` for ``words`` (default: of text)."""
    return docs.withColumn("runs", word_runs(words if words is not None else words_of(F.col("text"))))
