"""Preprocessing, cleaning and de-duplication of mail frames.

A mail frame has ``mail_id, subject, sender, body, label``. ``mail_id`` is unique and carries the
order of the source, which "keep the first copy" depends on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from mailshape.functions import text as T
from mailshape.functions.structural import with_structural_features
from mailshape.operators.lemma import corpus_words, lemma_map, lemmatize

TEXT_COLUMNS = ["subject", "body", "sender"]


def clean_columns(df: DataFrame, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """Clean text columns in place, up to but without lemmas."""
    return df.withColumns({c: T.clean_characters(F.col(c)) for c in columns})


def preprocess(df: DataFrame, lexicon: DataFrame | None = None,
               exceptions: DataFrame | None = None, key: str = "mail_id") -> DataFrame:
    """Keep raw copies, derive the 21 features from them, clean, lemmatise, and join ``text``.

    Without a ``lexicon`` no word is known and therefore none changes.
    """
    raw = df.withColumns({f"raw_{c}": F.coalesce(F.col(c), F.lit("")) for c in TEXT_COLUMNS})
    cleaned = clean_columns(with_structural_features(raw))
    if lexicon is not None:
        words = corpus_words(clean_columns(df), TEXT_COLUMNS)
        cleaned = lemmatize(cleaned, TEXT_COLUMNS, lemma_map(words, lexicon, exceptions), key)
    return cleaned.withColumn("text", T.joined_text(F.col("subject"), F.col("body")))


def drop_repeated_columns(df: DataFrame) -> DataFrame:
    """Keep the first of several columns of the same name."""
    names = df.columns
    if len(set(names)) == len(names):
        return df
    unique = [f"{name}__{i}" if name in names[:i] else name for i, name in enumerate(names)]
    return df.toDF(*unique).select(*dict.fromkeys(names))


def require_text(df: DataFrame) -> None:
    if "text" not in df.columns:
        raise ValueError("expected a preprocessed frame with a 'text' column")


def drop_empty_text(df: DataFrame) -> DataFrame:
    """Rows with a non-blank ``text``.

    Written as the expansion of a list of at most one text. A plain filter would sink below the
    cleaning step, so that every text would be cleaned twice.
    """
    require_text(df)
    some = F.filter(F.array("text"), lambda text: ~T.is_blank(text))
    return df.select(*[F.explode(some).alias(c) if c == "text" else c for c in df.columns])


def _compact(df: DataFrame, column: str) -> Column:
    """Stand-in for a grouping column: long text becomes its 32-byte SHA-256 digest, so that what is
    shuffled and compared does not grow with the mails. Null stays null."""
    if isinstance(df.schema[column].dataType, StringType):
        return F.unhex(F.sha2(F.col(column), 256))
    return F.col(column)


def first_copies(df: DataFrame, subset: Sequence[str] = ("text", "label"),
                 key: str = "mail_id", skip: Column | None = None) -> DataFrame:
    """Keep the row of the smallest ``key`` among rows equal in ``subset`` (nulls are equal).

    Copies are pre-aggregated to one ``min(key)`` per group before any shuffle, so a text that makes
    up a large part of the corpus costs one row per task; the full rows are then picked by their
    unique key. A window over the group would send all its copies to one task.

    Rows for which ``skip`` holds are left out. They only lose their key here instead of meeting a
    filter: a filter would sink below the cleaning step and evaluate it a second time.
    """
    names = [f"_k{i}" for i in range(len(subset))]
    candidate = F.col(key) if skip is None else F.when(~skip, F.col(key))
    narrow = df.select(
        candidate.alias(key), *[_compact(df, c).alias(n) for c, n in zip(subset, names)])
    firsts = narrow.groupBy(*names).agg(F.min(key).alias(key)).select(key)
    return df.join(firsts.filter(F.col(key).isNotNull()), key, "left_semi")


def conflicting_groups(df: DataFrame) -> DataFrame:
    """One row per non-empty text with more than one label: its smallest key, rows and label range."""
    return (
        df.select("mail_id", "label", _compact(df, "text").alias("_text"),
                  T.is_blank(F.col("text")).alias("_blank"))
        .groupBy("_text")
        .agg(F.min("mail_id").alias("first_mail_id"), F.count(F.lit(1)).alias("n_rows"),
             F.min("label").alias("min_label"), F.max("label").alias("max_label"),
             F.max("_blank").alias("_blank"))
        .filter((F.col("min_label") != F.col("max_label")) & ~F.col("_blank"))
        .drop("_text", "_blank")
    )


def conflicting_label_count(df: DataFrame) -> DataFrame:
    return conflicting_groups(df).agg(F.count(F.lit(1)).alias("conflicting_groups"))


def cleaning_summary(df: DataFrame, dataset: str, drop_empty: bool = True,
                     deduplicate: bool = True,
                     subset: Sequence[str] = ("text", "label")) -> DataFrame:
    """One row on what :func:`clean_dataset` removes and leaves.

    With ``text`` in the subset, one pass over the mails: copies within a group, then groups within
    a text, then the totals, each level on what the level before left over.
    """
    require_text(df)
    kept = ~T.is_blank(F.col("text")) if drop_empty else F.lit(True)
    names = [f"_k{i}" for i in range(len(subset))]
    rows = df.select(
        kept.alias("_kept"), _compact(df, "text").alias("_text"), F.col("label").alias("_label"),
        *[_compact(df, c).alias(n) for c, n in zip(subset, names) if c != "text"])
    others = [n for c, n in zip(subset, names) if c != "text"]
    is_kept, n = F.col("_kept"), F.col("_n")
    labels = (F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    sizes = (
        F.sum(n).alias("_n"), F.sum(F.when(~is_kept, n)).alias("_dropped"),
        F.sum(F.when(is_kept, n - 1)).alias("_copies"))

    copies = rows.withColumn("_seen", F.when(is_kept, F.col("_label")))
    counted = (F.count(F.lit(1)).alias("_n"), F.min("_seen").alias("_lo"), F.max("_seen").alias("_hi"))
    conflict = F.count_if((F.col("_lo") != F.col("_hi")) & F.col("_text").isNotNull()).alias("_conflicts")
    totals = (F.sum("_n").alias("_n"), F.sum("_dropped").alias("_dropped"),
              F.sum("_copies").alias("_copies"))
    if "text" in subset:
        result = (
            copies.groupBy("_kept", "_text", *others).agg(*counted)
            .groupBy("_text").agg(*sizes, *labels).agg(*totals, conflict))
    else:
        conflicts = copies.groupBy("_text").agg(*counted).agg(conflict)
        result = copies.groupBy("_kept", *others).agg(*counted).agg(*sizes).withColumn(
            "_conflicts", conflicts.scalar())

    def number(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0).cast("bigint"))

    removed = number("_copies") if deduplicate else F.lit(0).cast("bigint")
    return result.select(
        F.lit(dataset).alias("dataset"), number("_n").alias("initial_rows"),
        number("_dropped").alias("dropped_empty"), removed.alias("removed_duplicates"),
        (number("_conflicts") if deduplicate else F.lit(0).cast("bigint")).alias("conflicting_groups"),
        (number("_n") - number("_dropped") - removed).alias("remaining"))


def clean_dataset(df: DataFrame, dataset: str, *, drop_empty: bool = True,
                  deduplicate: bool = True, dedupe_subset: Sequence[str] | None = None,
                  key: str = "mail_id") -> tuple[DataFrame, DataFrame]:
    """Return the cleaned frame and its one-row summary. Conflicting labels are counted, not removed."""
    df = drop_repeated_columns(df)
    require_text(df)
    subset = tuple(dedupe_subset) if dedupe_subset is not None else ("text", "label")
    summary = cleaning_summary(df, dataset, drop_empty, deduplicate, subset)
    if deduplicate:
        skip = T.is_blank(F.col("text")) if drop_empty else None
        return first_copies(df, subset, key, skip), summary
    return (drop_empty_text(df) if drop_empty else df), summary


def label_diversity(df: DataFrame, dataset: str) -> DataFrame | None:
    """Rows, distinct texts and their ratio per label; ``None`` where a column is missing."""
    if "label" not in df.columns or "text" not in df.columns:
        return None
    return (
        df.filter(F.col("label").isNotNull())
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("total_rows"),
             F.countDistinct(_compact(df, "text")).alias("unique_texts"))
        .select(F.lit(dataset).alias("dataset"), "label", "total_rows", "unique_texts",
                (F.col("unique_texts") / F.col("total_rows")).alias("unique_ratio"))
    )


def prepare_datasets(train: DataFrame, test: DataFrame
                     ) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Clean both corpora separately: (train, test, summaries, label diversity after cleaning)."""
    train, train_summary = clean_dataset(train, "Train")
    test, test_summary = clean_dataset(test, "Test")
    diversity = label_diversity(train, "Train").unionByName(label_diversity(test, "Test"))
    return train, test, train_summary.unionByName(test_summary), diversity


def corpus_union(train: DataFrame, test: DataFrame) -> DataFrame:
    """Both corpora under one another; (corpus, mail_id) is the key of the result."""
    return train.withColumn("corpus", F.lit("train")).unionByName(
        test.withColumn("corpus", F.lit("test")))
