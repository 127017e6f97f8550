"""The query registry: every query reads the tables of one folder and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mailshape.functions import text as T
from mailshape.functions.structural import STRUCTURAL_COLUMNS, with_structural_features
from mailshape.operators import evaluate, folds, foldterms, lemma, models, prepare, profile, vectorize
from mailshape.plans import compare
from mailshape.session import land
from mailshape.sources import csv_mail, tables

Query = Callable[[SparkSession, str], DataFrame]

# A word counts as known (for the lemma queries) from this many mails on.
LEXICON_MAILS = 3


def r6(column: Column | str) -> Column:
    return F.round(column, 6)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six decimals."""
    return df.select(*[r6(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# -- inputs ---------------------------------------------------------------------------------------

def prepared_all(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as cleaned mail with a joined ``text``, features left out."""
    cleaned = prepare.clean_columns(tables.all_mail(spark, folder))
    return cleaned.withColumn("text", T.joined_text(F.col("subject"), F.col("body")))


def body_only(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without their first line, so that one-line documents are empty mails."""
    return tables.all_mail(spark, folder).select(
        "mail_id", "label", T.clean_characters(F.col("body")).alias("text"))


def prepared_corpora(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Preprocessed, cleaned and landed train and test mail."""
    train, test, _, _ = prepare.prepare_datasets(
        prepare.preprocess(tables.train_mail(spark, folder)),
        prepare.preprocess(tables.test_mail(spark, folder)))
    return land(train, "train"), land(test, "test")


def prepared_train(spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    """The given columns of the training mail of :func:`prepared_corpora`, landed."""
    train, _ = prepare.clean_dataset(prepare.preprocess(tables.train_mail(spark, folder)), "Train")
    return land(train.select("mail_id", "label", *columns), "train")


def lexicon(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = prepare.clean_columns(tables.all_mail(spark, folder))
    per_mail = F.array_distinct(F.concat(
        *[T.cleaned_tokens(F.col(c)) for c in prepare.TEXT_COLUMNS]))
    return (cleaned.select(F.explode(per_mail).alias("word")).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEXICON_MAILS).select("word"))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled mail with a fixed linear score of structural features."""
    mails = prepare.preprocess(tables.labelled_mail(spark, folder))
    score = r6(F.col("exclamation_count") * 0.25 + F.col("uppercase_ratio") * 3
               - F.col("text_word_count") / 400 + F.col("punctuation_ratio") * 10)
    return mails.select("mail_id", "label", score.alias("score")).withColumn(
        "prediction", (F.col("score") > 0).cast("int"))


# -- sources and text -----------------------------------------------------------------------------

def enron_mapping(spark: SparkSession, folder: str) -> DataFrame:
    mails = tables.documents_as_mail(tables.text_table(spark, folder, "documents"))
    labels = tables.table(spark, folder, "labels").withColumnRenamed("doc_id", "mail_id")
    label = F.when(F.col("toxic") == 1, "unsure").when(F.col("quality") == 0, "Spam").otherwise("HAM")
    mapped = csv_mail.to_mail_frame(mails.join(labels, "mail_id").select(
        "mail_id", F.col("subject").alias("Subject"), F.col("body").alias("Message"),
        label.alias("Spam/Ham"), F.lit("7").alias("Unnamed: 0")))
    # Unmapped labels are null; -1 shows them as a plain integer.
    return mapped.fillna(-1, ["label"])


def trec_mapping(spark: SparkSession, folder: str) -> DataFrame:
    mails = tables.labelled_mail(spark, folder)
    return csv_mail.to_mail_frame(mails.select(
        "mail_id", F.col("label").cast("string").alias("label"), "subject",
        F.nullif("sender", F.lit("src1")).alias("email_from"), F.col("body").alias("message")))


def clean_text_pages(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.clean_columns(tables.page_mail(spark, folder), ["subject", "body"]).select(
        "mail_id", "subject", "body", T.cleaned_token_count(F.col("body")).alias("n_tokens"))


def clean_text_documents(spark: SparkSession, folder: str) -> DataFrame:
    return prepared_all(spark, folder).select(
        "mail_id", "subject", "body", "sender", "text", T.cleaned_token_count(F.col("text")).alias("n_tokens"))


def lemmatize_terms(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = prepare.clean_columns(tables.all_mail(spark, folder))
    words = lemma.corpus_words(cleaned, prepare.TEXT_COLUMNS)
    return lemma.lemma_map(words, lexicon(spark, folder))


def preprocess_text(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.preprocess(tables.all_mail(spark, folder), lexicon(spark, folder)).select(
        "mail_id", "raw_subject", "raw_sender", "subject", "body", "sender", "text")


def structural_features_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = tables.page_mail(spark, folder)
    return rounded(with_structural_features(pages, "subject", "body", "sender").select(
        "mail_id", *STRUCTURAL_COLUMNS))


def structural_features_mail(spark: SparkSession, folder: str) -> DataFrame:
    mails = tables.all_mail(spark, folder)
    return rounded(prepare.preprocess(mails).select("mail_id", *STRUCTURAL_COLUMNS))


def sender_features_conversations(spark: SparkSession, folder: str) -> DataFrame:
    mails = tables.conversation_mail(spark, folder)
    return rounded(with_structural_features(mails, "subject", "body", "sender").select(
        "conv_id", "turn", *STRUCTURAL_COLUMNS))


# -- cleaning -------------------------------------------------------------------------------------

def drop_empty(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.drop_empty_text(body_only(spark, folder))


def conflicting_labels(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.conflicting_groups(prepared_all(spark, folder))


def dedupe_first(spark: SparkSession, folder: str) -> DataFrame:
    cleaned, _ = prepare.clean_dataset(prepared_all(spark, folder), "All")
    return cleaned.select("mail_id", "label", "text")


def cleaning_summary(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.cleaning_summary(body_only(spark, folder), "All")


def label_diversity(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(prepare.label_diversity(prepared_all(spark, folder), "All"))


def prepare_datasets(spark: SparkSession, folder: str) -> DataFrame:
    _, _, summary, diversity = prepare.prepare_datasets(
        prepare.preprocess(tables.train_mail(spark, folder)),
        prepare.preprocess(tables.test_mail(spark, folder)))
    return rounded(summary.join(diversity, "dataset"))


def corpus_union(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.corpus_union(
        tables.train_mail(spark, folder), tables.test_mail(spark, folder)).select(
            "corpus", *csv_mail.MAIL_COLUMNS)


# -- profile --------------------------------------------------------------------------------------

def sample_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.sample_counts(
        train=tables.train_mail(spark, folder), test=tables.test_mail(spark, folder))


def class_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return profile.class_distribution(tables.labelled_mail(spark, folder))


def length_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.length_histogram(profile.length_counts(prepared_all(spark, folder))))


def length_density(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.length_density(profile.length_counts(prepared_all(spark, folder))))


def length_p95(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.length_quantile(profile.length_counts(prepared_all(spark, folder))))


def top_terms(spark: SparkSession, folder: str) -> DataFrame:
    mails = prepare.preprocess(tables.labelled_mail(spark, folder).drop("lang"))
    cleaned, _ = prepare.clean_dataset(mails, "All")
    return profile.top_terms(cleaned)


# -- vectors --------------------------------------------------------------------------------------

def _terms(spark: SparkSession, folder: str, ngram_range: tuple[int, int]) -> DataFrame:
    df = prepared_all(spark, folder).select("mail_id", "text")
    if ngram_range != (1, 1):  # words are counted first, n-grams in a second pass
        df = land(df, "prepared")
    return _terms_of(df, ngram_range)


def _terms_of(df: DataFrame, ngram_range: tuple[int, int]) -> DataFrame:
    stages = Pipeline(stages=vectorize.term_stages(ngram_range, profile.COMMON_WORDS))
    return stages.fit(df).transform(df)


def vocab_unigram(spark: SparkSession, folder: str) -> DataFrame:
    return vectorize.top_vocabulary(_terms(spark, folder, (1, 1)))


def vocab_bigram(spark: SparkSession, folder: str) -> DataFrame:
    return vectorize.top_vocabulary(_terms(spark, folder, (1, 2)), words_col="_grams1")


def _matrix(spark: SparkSession, folder: str, vectorizer_type: str,
            ngram_range: tuple[int, int]) -> DataFrame:
    # Cleaned once, and counted into vectors once: weights and norms start from these.
    df = land(prepared_all(spark, folder).select("mail_id", "text"), "prepared")
    stages = vectorize.text_stages(vectorizer_type, ngram_range, profile.COMMON_WORDS)
    counting = next(i for i, s in enumerate(stages)
                    if isinstance(s, vectorize.TopTermVectorizer)) + 1
    counted = Pipeline(stages=stages[:counting]).fit(df)
    rows = counted.transform(df)
    if stages[counting:]:
        rows = land(rows.select("mail_id", stages[counting - 1].output_col), "counts")
        rows = Pipeline(stages=stages[counting:]).fit(rows).transform(rows)
    return rounded(vectorize.matrix_cells(rows, "text_features", counted.stages[-1].vocabulary))


def count_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return _matrix(spark, folder, "count", (1, 1))


def tfidf_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return _matrix(spark, folder, "tfidf", (1, 2))


def scaled_features(spark: SparkSession, folder: str) -> DataFrame:
    train = prepare.preprocess(tables.train_mail(spark, folder))
    test = prepare.preprocess(tables.test_mail(spark, folder))
    scaler = vectorize.PopulationScaler()
    model = scaler.fit(train)
    return rounded(prepare.corpus_union(model.transform(train), model.transform(test)).select(
        "corpus", "mail_id", *scaler.output_columns()))


def doc_centroid(spark: SparkSession, folder: str) -> DataFrame:
    # Cleaned once: the words are counted and the vectors summed from these.
    mails = land(prepared_all(spark, folder).select("mail_id", "text"), "prepared")
    given = tables.table(spark, folder, "embeddings").withColumn("rank", F.col("vec_id") + 1)
    vectors = land(
        vectorize.top_vocabulary(_terms_of(mails, (1, 1)), size=given.count())
        .join(given, "rank").select(F.col("term").alias("word"), F.col("embedding").alias("vector")),
        "word_vectors")
    size = vectors.select(F.max(F.size("vector"))).first()[0]
    return vectorize.centroids(mails, vectors, size).select(
        "mail_id", "n_known", F.posexplode("centroid").alias("dim", "value")).select(
        "mail_id", "n_known", "dim", r6("value").alias("value"))


def stratified_folds(spark: SparkSession, folder: str) -> DataFrame:
    mails = tables.labelled_mail(spark, folder)
    return folds.with_folds(mails).select("mail_id", "label", "fold")


def fold_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    """Top terms and their weights on every training side of the folds, from one pass of counts."""
    train = prepared_train(spark, folder, ["text"])
    folded = land(folds.with_folds(train), "vocabulary_folds")
    counts = land(foldterms.fold_term_counts(
        folded, (1, 2), profile.COMMON_WORDS, vectorize.MAX_TERMS, folds.FOLDS), "fold_terms")
    vocabulary = foldterms.fold_vocabulary(counts, foldterms.fold_sizes(folded), folds.FOLDS)
    return vocabulary.withColumn("idf", r6("idf"))


def fold_scalers(spark: SparkSession, folder: str) -> DataFrame:
    """Mean and population deviation of every structural column on every training side."""
    train = prepared_train(spark, folder, STRUCTURAL_COLUMNS)
    folded = land(folds.with_folds(train), "scaler_folds")
    scalers = foldterms.side_scalers(foldterms.fold_moments(folded), folds.FOLDS)
    return scalers.select("held_out", "feature", r6("mean").alias("mean"), r6("std").alias("std"))


# -- evaluation -----------------------------------------------------------------------------------

def binary_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.binary_metrics(scored(spark, folder)))


def classification_report(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.classification_report(scored(spark, folder)))


def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.confusion_matrix(scored(spark, folder))


def pr_curve(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.pr_curve(scored(spark, folder)))


def average_precision(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.average_precision(scored(spark, folder)))


# -- models ---------------------------------------------------------------------------------------

def _text_model(settings: compare.TextModel) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        train, test = prepared_corpora(spark, folder)
        return models.predict(compare.pipeline_for(settings).fit(train), test)
    return query


def model_word2vec(spark: SparkSession, folder: str) -> DataFrame:
    train, test = prepared_corpora(spark, folder)
    return models.predict_probability(models.train_embedding_model(train), test)


def cross_validation(spark: SparkSession, folder: str) -> DataFrame:
    """All four term models over the same folds."""
    folded = compare.landed_folds(prepared_train(spark, folder, vectorize.feature_columns()))
    tables = compare.fold_tables(folded, [m.ngram_range for m in compare.TEXT_MODELS])
    validated = compare.cross_validate_models(compare.TEXT_MODELS, tables)
    return reduce(DataFrame.unionByName, [
        compare.cv_summary(v, m.name, folded) for m, v in zip(compare.TEXT_MODELS, validated)])


def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """The five models on the foreign corpus, four of them cross-validated."""
    return compare.compare_models(*prepared_corpora(spark, folder))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        enron_mapping, trec_mapping, clean_text_pages, clean_text_documents, lemmatize_terms,
        preprocess_text, structural_features_pages, structural_features_mail,
        sender_features_conversations, drop_empty, conflicting_labels, dedupe_first,
        cleaning_summary, label_diversity, prepare_datasets, corpus_union, sample_counts,
        class_distribution, length_histogram, length_density, length_p95, top_terms,
        vocab_unigram, vocab_bigram, count_matrix, tfidf_matrix, scaled_features, doc_centroid,
        stratified_folds, fold_vocabulary, fold_scalers, binary_metrics, classification_report, confusion_matrix, pr_curve,
        average_precision,
    )
}
QUERIES |= {
    f"model_{name}": _text_model(settings)
    for name, settings in zip(("keyword", "tfidf_unigram", "logistic", "svm"), compare.TEXT_MODELS)
}
QUERIES |= {f.__name__: f for f in (model_word2vec, cross_validation, model_comparison)}
