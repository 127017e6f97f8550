"""Profile of a corpus by class: the tables behind the charts.

All length statistics start from one small table, the number of mails per (label, word count), so
the corpus itself is read once for them, and what is shuffled is already counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from mailshape.functions import text as T
from mailshape.session import land

CLASS_NAMES = {0: "Ham", 1: "Spam"}
BINS = 50
GRID_POINTS = 200
TOP_TERMS = 20

# Fixed list of 32 words left out of the top terms.
COMMON_WORDS = [
    "the", "and", "to", "of", "a", "in", "is", "it", "i", "for", "you", "on", "this", "that",
    "with", "be", "are", "as", "at", "if", "we", "have", "your", "was", "not", "but", "by", "me",
    "from", "my", "or", "an",
]


def class_name(label: Column) -> Column:
    return F.when(label == 0, CLASS_NAMES[0]).when(label == 1, CLASS_NAMES[1])


def sample_counts(**corpora: DataFrame) -> DataFrame:
    """Rows and spam rows of each named corpus."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("label").alias("n_spam"))
        .select(F.lit(name).alias("corpus"), "n_rows", "n_spam")
        for name, df in corpora.items()
    ]
    merged = counts[0]
    for part in counts[1:]:
        merged = merged.unionByName(part)
    return merged


def class_distribution(df: DataFrame) -> DataFrame:
    """Mails per class; mails without a label are in none."""
    return df.filter(F.col("label").isNotNull()).groupBy("label").agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "class_name", class_name(F.col("label")))


def with_word_count(df: DataFrame) -> DataFrame:
    return df.withColumn("word_count", T.cleaned_token_count(F.col("text")))


def length_counts(df: DataFrame) -> DataFrame:
    """Landed: mails per (label, word count), at most one row per class and different length.

    Every statistic below combines several aggregates of this table. Left unwritten, each of them
    would read the whole corpus again.
    """
    return land(with_word_count(df).groupBy("label", "word_count").agg(
        F.count(F.lit(1)).alias("n")), "lengths")


def length_histogram(lengths: DataFrame, bins: int = BINS) -> DataFrame:
    """From :func:`length_counts`: mails per class in equal-width bins over the range of all mails; empty bins are listed.

    A bin holds its left edge, the last one both. Edges are ``low + i * width`` in double
    arithmetic, and a length is placed by comparing it with these very edges.
    """
    lengths = lengths.filter(F.col("label").isNotNull())
    bounds = lengths.agg(F.min("word_count").alias("lo"), F.max("word_count").alias("hi"))
    # A single length gets a range of one around it.
    pad = F.when(F.col("lo") == F.col("hi"), 0.5).otherwise(0.0)
    bounds = bounds.select((F.col("lo") - pad).alias("lo"), (F.col("hi") + pad).alias("hi")).select(
        F.struct("lo", ((F.col("hi") - F.col("lo")) / bins).alias("width")).alias("b"))
    framed = lengths.withColumn("_b", bounds.scalar())
    low, width, x = F.col("_b.lo"), F.col("_b.width"), F.col("word_count")
    guess = F.least(F.floor((x - low) / width), F.lit(bins - 1))
    placed = framed.withColumn("_g", guess).withColumn(
        "bin",
        F.when(x < low + F.col("_g") * width, F.col("_g") - 1)
        .when((x >= low + (F.col("_g") + 1) * width) & (F.col("_g") < bins - 1), F.col("_g") + 1)
        .otherwise(F.col("_g")).cast("int"))
    filled = placed.groupBy("label", "bin").agg(F.sum("n").alias("n"))
    cells = lengths.select("label").distinct().select(
        "label", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return cells.join(filled, ["label", "bin"], "left").withColumn("_b", bounds.scalar()).select(
        "label", "bin", (low + F.col("bin") * width).alias("bin_start"),
        (low + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n_rows"))


def length_density(lengths: DataFrame, points: int = GRID_POINTS, bins: int = BINS) -> DataFrame:
    """From :func:`length_counts`: Gaussian kernel density of the word count per class, on one grid over the range of all mails.

    Bandwidth is the class's sample deviation times n^(-1/5). ``density`` integrates to one per class;
    ``scaled`` has the area of the class's histogram bars. Classes without spread have no curve.
    """
    lengths = lengths.filter(F.col("label").isNotNull())
    bounds = lengths.agg(F.struct(F.min("word_count").alias("lo"),
                                  F.max("word_count").alias("hi")).alias("b"))
    # Exact sums (decimals cannot overflow here), so that the variance does not cancel.
    n, x = F.col("n").cast("decimal(19,0)"), F.col("word_count").cast("decimal(10,0)")
    moments = lengths.groupBy("label").agg(
        F.sum("n").alias("rows"), F.sum((n * x).cast("decimal(38,0)")).alias("s1"),
        F.sum((n * x * x).cast("decimal(38,0)")).alias("s2"))
    rows, s1, s2 = (F.col(c).cast("double") for c in ("rows", "s1", "s2"))
    variance = F.when(F.col("rows") > 1, (s2 - s1 * s1 / rows) / (rows - 1))
    classes = moments.select(
        "label", "rows", (F.sqrt(variance) * F.pow(rows, F.lit(-0.2))).alias("h")
    ).filter(F.col("h") > 0)
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    # One row per class on the small side, a fixed number of grid points per distinct length.
    spread = lengths.join(F.broadcast(classes), "label").withColumn("_b", bounds.scalar()).select(
        "label", "rows", "h", "n", "word_count", "_b", grid.alias("point"))
    step = (F.col("_b.hi") - F.col("_b.lo")).cast("double") / (points - 1)
    at = F.col("_b.lo") + F.col("point") * step
    z = (at - F.col("word_count")) / F.col("h")
    summed = spread.groupBy("label", "point").agg(
        F.first("rows").alias("rows"), F.first("h").alias("h"), F.first(at).alias("word_count"),
        F.first((F.col("_b.hi") - F.col("_b.lo")).cast("double") / bins).alias("width"),
        F.sum(F.col("n") * F.exp(-z * z / 2)).alias("k"))
    density = F.col("k") / (F.col("rows") * F.col("h") * F.sqrt(F.lit(2.0) * F.pi()))
    return summed.select("label", "point", "word_count", density.alias("density"),
                         (density * F.col("rows") * F.col("width")).alias("scaled"))


def length_quantile(lengths: DataFrame, q: float = 0.95) -> DataFrame:
    """From :func:`length_counts`: exact quantile of the word count with linear interpolation.

    Runs over the counts per length: what one task holds is bounded by the number of different mail
    lengths, not by the number of mails.
    """
    return lengths.groupBy("word_count").agg(F.sum("n").alias("n")).agg(
        F.percentile("word_count", F.lit(q), F.col("n")).alias("quantile"))


def term_filter(term: Column) -> Column:
    return ~term.isin(COMMON_WORDS) & (F.length(term) > 2)


def top_terms(df: DataFrame, k: int = TOP_TERMS) -> DataFrame:
    """The ``k`` most frequent terms per class; equal counts are ranked by term.

    Counts are combined map-side; for the ranking each task forwards at most ``k`` rows per class.
    """
    terms = (
        df.filter(F.col("label").isin(list(CLASS_NAMES)))
        .select("label", F.explode(F.split("text", " ")).alias("term"))
        .filter(term_filter(F.col("term")))
        .groupBy("label", "term").agg(F.count(F.lit(1)).alias("n")))
    order = Window.partitionBy("label").orderBy(F.desc("n"), "term")
    return terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "label", class_name(F.col("label")).alias("class_name"), "rank", "term", "n")


def profile(df: DataFrame) -> dict[str, DataFrame]:
    """All chart tables of a prepared corpus; ``df`` should be landed or cached."""
    lengths = length_counts(df)
    return {
        "class_distribution": class_distribution(df),
        "length_histogram": length_histogram(lengths),
        "length_density": length_density(lengths),
        "length_p95": length_quantile(lengths),
        "top_terms": top_terms(df),
    }
