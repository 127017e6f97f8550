"""Host-level quality rules, in DataFrame functions only.

Per text a few counts and two fixed rules; per host the share of texts that fail, shrunk towards the
corpus by an empirical beta prior; hosts whose shrunk share is too high lose all their texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mailshape.session import land

# Fixed values of the base rules.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

MAX_HOST_RATE = 0.5
# Low bits of a sorted key that hold a window's place; a text has fewer words than 2^28.
_PLACE_BITS = 28


def _neighbours(array: str, same) -> Column:
    """Elements of a sorted array column for which ``same(element, previous or next)`` holds."""
    return F.filter(array, lambda x, i: F.coalesce(
        same(x, F.get(array, i + 1)) | same(x, F.get(array, i - 1)), F.lit(False)))


def rule_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                host_col: str = "source") -> DataFrame:
    """``(id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)`` per input row.

    Words are maximal runs without ASCII white space. Repeated windows are found inside the row:
    window hashes are sorted with their places, so time is n log n in the words of a text and nothing
    is exploded or shuffled. A null or empty text counts zero everywhere; a null host is a host of
    its own; repeated rows stay; other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    frame = docs.select(F.col(id_col).alias("_id"), F.col(host_col).alias("_host"),
                        text.alias("_t"))
    frame = frame.select(
        "_id", "_host", "_t",
        F.filter(F.split("_t", r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("_w"),
        F.filter(F.split("_t", "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"))
    frame = frame.select(
        "_id", "_host", F.size("_w").cast("bigint").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("bigint").alias("word_chars"),
        (F.length("_t") - F.length(F.regexp_replace("_t", r"[#*$%&|<>]", ""))).cast("bigint")
        .alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint")
        .alias("n_dup_lines"),
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"))
    counts = ["_id", "_host", "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    places = F.when(F.col("n_words") > WINDOW, F.sequence(
        F.lit(0), F.col("n_words").cast("int") - WINDOW)).otherwise(
            F.array().cast("array<int>"))
    frame = frame.select(*counts, F.transform(places, lambda i: F.xxhash64(
        *[F.get("_h", i + k) for k in range(WINDOW)])).alias("_win"))
    low = (1 << _PLACE_BITS) - 1
    # Windows whose upper hash bits meet: few beyond the real repeats, which the full hash confirms.
    frame = frame.select(*counts, "_win", F.sort_array(F.transform(
        "_win", lambda x, i: x.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("bigint")))).alias("_key"))
    frame = frame.select(*counts, "_win", _neighbours("_key", lambda a, b: F.shiftright(
        a, _PLACE_BITS) == F.shiftright(b, _PLACE_BITS)).alias("_key"))
    frame = frame.select(*counts, F.sort_array(F.transform("_key", lambda k: F.struct(
        F.get("_win", k.bitwiseAND(F.lit(low)).cast("int")).alias("h"),
        k.bitwiseAND(F.lit(low)).alias("i")))).alias("_full"))
    frame = frame.select(*counts, _neighbours("_full", lambda a, b: a["h"] == b["h"]).alias("_rep"))
    frame = frame.select(*counts, F.sort_array(F.transform("_rep", lambda x: x["i"])).alias("_at"))
    # Each repeated window covers its words up to the start of the next repeated one.
    covered = F.aggregate(
        F.transform("_at", lambda x, i: F.least(
            F.lit(WINDOW).cast("bigint"), F.coalesce(F.get("_at", i + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("bigint"), lambda a, b: a + b)
    return frame.select(
        F.col("_id").alias(id_col), F.col("_host").alias(host_col), *counts[2:],
        covered.alias("n_repeat_words"))


def with_base_rules(counts: DataFrame) -> DataFrame:
    return counts.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """Beta parameters by the method of moments over hosts' failure rates.

    ``hosts`` has ``n`` and ``failed`` per host. The spread of the true rates is the spread seen,
    weighted by ``n``, less what counting alone makes. One row of sums reaches the driver. Without
    rows the prior is uniform; without spread it is as strong as all rows together.
    """
    row = hosts.agg(
        F.sum("n").alias("n"), F.sum("failed").alias("f"), F.count("*").alias("k"),
        F.sum(F.col("failed") * F.col("failed") / F.col("n")).alias("q")).first()
    if not row["n"]:
        return 1.0, 1.0
    n, k, mean = float(row["n"]), row["k"], row["f"] / row["n"]
    noise = mean * (1 - mean)
    if noise == 0:
        return mean * n + 1, (1 - mean) * n + 1
    seen = max(0.0, row["q"] / n - mean * mean)
    spread = max(seen - noise * k / n, noise / (n + 1))
    strength = max(noise / spread - 1, 1e-3)
    return mean * strength, (1 - mean) * strength


def host_verdicts(rules: DataFrame, host_col: str = "source",
                  max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``(host, n, failed, shrunk_rate, host_failed)``: a host fails with a shrunk rate above
    ``max_rate``. Sums are made before the shuffle, so a host with most rows is no hot key."""
    hosts = land(rules.groupBy(host_col).agg(
        F.count("*").alias("n"), F.sum(F.col("base_failed").cast("bigint")).alias("failed")),
        "quality-hosts")
    alpha, beta = beta_prior(hosts)
    rate = (F.col("failed") + F.lit(alpha)) / (F.col("n") + F.lit(alpha + beta))
    return hosts.withColumn("shrunk_rate", rate).withColumn(
        "host_failed", F.col("shrunk_rate") > max_rate)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  host_col: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Counts, base verdict, host rate and ``kept`` per row of ``docs``.

    Null and empty texts fail the base rules; a row is kept if neither it nor its host fails. An
    empty table gives an empty result. The counts are landed once, so texts are read once; the host
    table is joined back without a hint, by whatever its size allows, and a hot host is split by
    adaptive execution.
    """
    rules = land(with_base_rules(rule_counts(docs, id_col, text_col, host_col)), "quality-rules")
    hosts = host_verdicts(rules, host_col, max_rate).select(
        F.col(host_col).alias("_host"), F.col("shrunk_rate").alias("host_rate"), "host_failed")
    return rules.join(hosts, F.col(host_col).eqNullSafe(F.col("_host"))).select(
        *rules.columns, "host_rate", "host_failed",
        (~F.col("base_failed") & ~F.col("host_failed")).alias("kept"))
