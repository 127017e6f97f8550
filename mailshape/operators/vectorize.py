"""Text and numeric feature transforms as ``pyspark.ml`` stages.

Stages hold what they learned from the frame they were fitted on, so that refitting a whole pipeline
per fold leaks nothing. The estimators of terms and scaling return built-in JVM models and
transformers: applying and saving their pipelines needs none of this code. The model of centroids is a
transformer of this module over built-in ones; no row ever goes through Python.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Estimator, Transformer
from pyspark.ml.feature import (
    IDF, CountVectorizerModel, ElementwiseProduct, NGram, Normalizer, RegexTokenizer, SQLTransformer,
    StopWordsRemover, VectorAssembler, Word2Vec, Word2VecModel,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, Window, functions as F

from mailshape.functions.structural import STRUCTURAL_COLUMNS
from mailshape.operators.scale import exploded
from mailshape.session import land

MAX_TERMS = 5000
# Fixed pattern: words of two or more characters on cleaned (ASCII, lower-case) text.
TERM_PATTERN = r"\p{Alnum}{2,}"

# Fixed settings of the embedding.
VECTOR_SIZE, WINDOW_SIZE, MIN_COUNT, EPOCHS, SEED = 50, 5, 5, 5, 12345
# Partitions are trained apart and averaged every epoch, so their number is a setting of the model. It
# is the least one: a larger corpus is trained in partitions of about as many tokens as given here, for
# with a fixed number a task's time would grow with the corpus.
TRAINING_PARTITIONS = 4
PARTITION_TOKENS = 2_000_000
# Longer texts are windows of this many tokens: no word is lost, contexts across a cut are.
SENTENCE_LIMIT = 10_000
# Bytes of the words and vectors of a block that a task holds, about.
VECTOR_BLOCK = 64_000_000
# The trainer keeps two float vectors per word on the driver and in every task, so the rows it learns
# from are bounded, about, by a hash of the tokens; None takes all.
FIT_ROWS: int | None = None


def default_stop_words() -> list[str]:
    """Spark's own English list; the vectorisers take any other list as a parameter."""
    return StopWordsRemover.loadDefaultStopWords("english")


def feature_columns(use_structural: bool = True) -> list[str]:
    return ["text", *STRUCTURAL_COLUMNS] if use_structural else ["text"]


def term_stages(ngram_range: tuple[int, int] = (1, 1), stop_words: Sequence[str] | None = None,
                text_col: str = "text", out_col: str = "terms") -> list[Transformer]:
    """Tokens, stop-word removal, then n-grams over what is left (so they bridge removed words)."""
    words = list(stop_words) if stop_words is not None else default_stop_words()
    low, high = ngram_range
    stages: list[Transformer] = [
        RegexTokenizer(inputCol=text_col, outputCol="_words", pattern=TERM_PATTERN, gaps=False),
        StopWordsRemover(inputCol="_words", outputCol="_grams1", stopWords=words),
    ]
    stages += [NGram(n=n, inputCol="_grams1", outputCol=f"_grams{n}")
               for n in range(low, high + 1) if n > 1]
    grams = ", ".join(f"_grams{n}" for n in range(low, high + 1))
    stages.append(SQLTransformer(statement=f"SELECT *, concat({grams}) AS {out_col} FROM __THIS__"))
    return stages


def term_totals(df: DataFrame, terms_col: str = "terms") -> DataFrame:
    """Total occurrences of every term, combined map-side."""
    return exploded(df, [], terms_col, "term").groupBy("term").agg(
        F.count(F.lit(1)).alias("n"))


def between_words(df: DataFrame, frequent: DataFrame, term_col: str = "term") -> DataFrame:
    """Rows whose term, a word or n-gram, begins and ends with a word of ``frequent`` (``word``)."""
    for end in (1, -1):
        df = df.join(frequent, F.substring_index(term_col, " ", end) == F.col("word"), "left_semi")
    return df


def candidate_totals(df: DataFrame, size: int, terms_col: str, words_col: str) -> DataFrame:
    """:func:`term_totals` of all terms that can be among the ``size`` most frequent, where the terms
    are the words and n-grams of them.

    An n-gram occurs no oftener than each of its words, and the last count of the list is no less
    than the ``size``-th of the words alone. So only n-grams of words with that count are counted,
    and the many that occur once or twice are never shuffled.
    """
    words = land(term_totals(df, words_col), "words")
    least = words.select("n").orderBy(F.desc("n")).limit(size).agg(
        F.count("n").alias("words"), F.min("n").alias("n")).first()
    if least.words < size:
        return term_totals(df, terms_col)
    words = words.filter(F.col("n") >= least.n)
    frequent = land(words.select(F.col("term").alias("word")), "frequent")
    grams = between_words(exploded(df, [], terms_col, "term").filter(
        F.contains("term", F.lit(" "))), frequent)
    return words.unionByName(grams.groupBy("term").agg(F.count(F.lit(1)).alias("n")))


def top_vocabulary(df: DataFrame, size: int = MAX_TERMS, terms_col: str = "terms",
                   words_col: str | None = None) -> DataFrame:
    """``(rank, term, n)`` of the ``size`` most frequent terms; equal counts are ranked by term.

    ``words_col`` names the words, where the terms are these and n-grams of them. Spark plans the
    sort with the limit as a top-k per task, so ``size`` rows per task meet.
    """
    totals = term_totals(df, terms_col) if words_col is None else candidate_totals(
        df, size, terms_col, words_col)
    top = totals.orderBy(F.desc("n"), "term").limit(size)
    return top.select(
        F.row_number().over(Window.orderBy(F.desc("n"), "term")).alias("rank"), "term", "n")


class TopTermVectorizer(Estimator):
    """Fits a count vectoriser on :func:`top_vocabulary`. Its size bounds what the driver gets."""

    def __init__(self, size: int = MAX_TERMS, input_col: str = "terms", output_col: str = "counts",
                 words_col: str | None = None):
        super().__init__()
        self.size, self.input_col, self.output_col = size, input_col, output_col
        self.words_col = words_col

    def _fit(self, dataset: DataFrame) -> CountVectorizerModel:
        ranked = top_vocabulary(dataset, self.size, self.input_col, self.words_col).orderBy("rank")
        vocabulary = [row.term for row in ranked.select("term").collect()]
        if not vocabulary:
            raise ValueError("empty vocabulary: no terms are left after stop-word removal")
        return CountVectorizerModel.from_vocabulary(vocabulary, self.input_col, self.output_col)


class SmoothIdf(Estimator):
    """Inverse document frequency ``ln((1 + n) / (1 + df)) + 1``: the built-in one plus one."""

    def __init__(self, input_col: str = "counts", output_col: str = "weighted"):
        super().__init__()
        self.input_col, self.output_col = input_col, output_col

    def _fit(self, dataset: DataFrame) -> ElementwiseProduct:
        plain = IDF(inputCol=self.input_col, outputCol=self.output_col).fit(
            dataset.select(self.input_col))
        return ElementwiseProduct(
            scalingVec=Vectors.dense(plain.idf.toArray() + 1.0),
            inputCol=self.input_col, outputCol=self.output_col)


class PopulationScaler(Estimator):
    """Standardises columns with mean and population deviation; a constant column is only centred."""

    def __init__(self, columns: Sequence[str] = tuple(STRUCTURAL_COLUMNS), suffix: str = "_scaled"):
        super().__init__()
        self.columns, self.suffix = list(columns), suffix

    def output_columns(self) -> list[str]:
        return [c + self.suffix for c in self.columns]

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        stats = dataset.agg(
            *[F.avg(c).alias(f"m_{c}") for c in self.columns],
            *[F.stddev_pop(c).alias(f"s_{c}") for c in self.columns]).first()
        scaled = ", ".join(
            f"(`{c}` - ({stats[f'm_{c}']!r}D)) / {stats[f's_{c}'] or 1.0!r}D AS `{c}{self.suffix}`"
            for c in self.columns)
        return SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__")


def text_stages(vectorizer_type: str = "tfidf", ngram_range: tuple[int, int] = (1, 2),
                stop_words: Sequence[str] | None = None, size: int = MAX_TERMS) -> list:
    """Terms to ``text_features``: raw counts, or IDF-weighted counts of unit length."""
    stages = term_stages(ngram_range, stop_words)
    words_col = "_grams1" if ngram_range[0] == 1 < ngram_range[1] else None
    if vectorizer_type == "count":
        return [*stages, TopTermVectorizer(size, output_col="text_features", words_col=words_col)]
    if vectorizer_type == "tfidf":
        return [*stages, TopTermVectorizer(size, words_col=words_col), SmoothIdf(),
                Normalizer(p=2.0, inputCol="weighted", outputCol="text_features")]
    raise ValueError(f"unsupported vectorizer_type {vectorizer_type!r}: use 'tfidf' or 'count'")


def assembly_stages(use_structural: bool) -> list:
    """Text block first, then the scaled structural block, as ``features``."""
    if not use_structural:
        return [VectorAssembler(inputCols=["text_features"], outputCol="features")]
    scaler = PopulationScaler()
    return [scaler, VectorAssembler(
        inputCols=["text_features", *scaler.output_columns()], outputCol="features")]


def matrix_cells(df: DataFrame, vector_col: str, vocabulary: Sequence[str],
                 key: str = "mail_id") -> DataFrame:
    """Non-zero cells of a sparse vector column as ``(key, term, value)``, without a shuffle."""
    sparse = df.select(key, F.unwrap_udt(vector_col).alias("_v")).select(
        key, F.col("_v.indices").alias("_at"), F.col("_v.values").alias("_value"))
    cells = sparse.select(key, F.explode(F.arrays_zip("_at", "_value")).alias("_cell")).select(
        key, F.col("_cell._at").alias("_at"), F.col("_cell._value").alias("value"))
    # The vocabulary is bounded by the size of the vectoriser, so it may always be broadcast.
    names = df.sparkSession.createDataFrame(list(enumerate(vocabulary)), "_at int, term string")
    return cells.join(F.broadcast(names), "_at").select(key, "term", "value")


class CentroidModel(Transformer):
    """Mean of the word vectors of a mail's known words, with repeats; zeros if none is known."""

    def __init__(self, embedding: Word2VecModel, counter: CountVectorizerModel,
                 input_col: str = "tokens", output_col: str = "text_features"):
        super().__init__()
        self.embedding, self.counter = embedding, counter
        self.input_col, self.output_col = input_col, output_col

    def _transform(self, dataset: DataFrame) -> DataFrame:
        # The built-in transform divides by all tokens; rescale to the known ones. Everything stays
        # inside the row: the model broadcasts its vectors, whose size was checked at training.
        summed = self.counter.transform(self.embedding.transform(dataset))
        known = F.aggregate(F.unwrap_udt(self.counter.getOutputCol())["values"], F.lit(0.0),
                            lambda total, value: total + value)
        mean = vector_to_array(self.embedding.getOutputCol())
        factor = F.when(F.col("_known") > 0, F.size(self.input_col) / F.col("_known")).otherwise(0.0)
        return (
            summed.withColumn("_known", known).withColumn("_factor", factor)
            .withColumn(self.output_col, array_to_vector(
                F.transform(mean, lambda value: value * F.col("_factor"))))
            .drop("_known", "_factor", self.embedding.getOutputCol(), self.counter.getOutputCol()))


class CentroidVectorizer(Estimator):
    """Trains word vectors on a token column and averages them per mail."""

    def __init__(self, vector_size: int = VECTOR_SIZE, window: int = WINDOW_SIZE,
                 min_count: int = MIN_COUNT, epochs: int = EPOCHS, seed: int = SEED,
                 num_partitions: int = TRAINING_PARTITIONS, fit_rows: int | None = FIT_ROWS,
                 input_col: str = "tokens", output_col: str = "text_features",
                 partition_tokens: int = PARTITION_TOKENS):
        super().__init__()
        self.vector_size, self.window, self.min_count = vector_size, window, min_count
        self.epochs, self.seed = epochs, seed
        self.num_partitions, self.fit_rows = num_partitions, fit_rows
        self.partition_tokens = partition_tokens
        self.input_col, self.output_col = input_col, output_col

    def _fit(self, dataset: DataFrame) -> CentroidModel:
        tokens = dataset.select(self.input_col)
        if self.fit_rows is not None:
            share = int((1 << 31) * min(1.0, self.fit_rows / max(1, tokens.count())))
            tokens = tokens.filter(F.pmod(F.xxhash64(self.input_col), F.lit(1 << 31)) < share)
        words = exploded(tokens, [], self.input_col, "word").groupBy("word").agg(
            F.count(F.lit(1)).alias("n"))
        most, total = words.agg(F.max("n"), F.sum("n")).first()
        if (most or 0) < self.min_count:
            raise ValueError(f"no word occurs {self.min_count} times: nothing to embed")
        embedding = Word2Vec(
            vectorSize=self.vector_size, windowSize=self.window, minCount=self.min_count,
            maxIter=self.epochs, seed=self.seed, maxSentenceLength=SENTENCE_LIMIT,
            numPartitions=max(self.num_partitions, -(-total // self.partition_tokens)),
            inputCol=self.input_col, outputCol="_mean").fit(tokens)
        known = [row.word for row in embedding.getVectors().select("word").collect()]
        counter = CountVectorizerModel.from_vocabulary(known, self.input_col, "_hits")
        return CentroidModel(embedding, counter, self.input_col, self.output_col)


def embedding_stages(**settings) -> list:
    """White-space tokens (punctuation and stop words kept) to ``text_features``."""
    split = SQLTransformer(
        statement="SELECT *, filter(split(text, ' '), t -> t <> '') AS tokens FROM __THIS__")
    return [split, CentroidVectorizer(**settings)]


def centroids(df: DataFrame, word_vectors: DataFrame, size: int, text_col: str = "text",
              key: str = "mail_id") -> DataFrame:
    """Centroids from a given table ``(word, vector)``: ``(key, n_known, centroid)`` for every mail.

    The dimensions are summed as ``size`` columns, not as exploded rows, and in the task that reads the
    mail: one row of sums per mail and block of the vectors is shuffled. The blocks are of about
    ``VECTOR_BLOCK`` bytes each, so they may be broadcast however many words there are; the texts are
    read once per block.
    """
    rows, held = word_vectors.agg(F.count(F.lit(1)), F.sum(
        F.octet_length("word") + 8 * F.size("vector"))).first()
    blocks = max(1, -(-((held or 0) + 64 * rows) // VECTOR_BLOCK))
    tokens = df.select(key, F.explode(F.split(text_col, " ")).alias("word"))
    found = reduce(DataFrame.unionAll, [tokens.join(F.broadcast(word_vectors.filter(
        F.pmod(F.xxhash64("word"), F.lit(blocks)) == b)), "word").select(key, "vector")
        for b in range(blocks)])
    sums = found.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_known"),
        *[F.sum(F.col("vector")[i].cast("double")).alias(f"_d{i}") for i in range(size)])
    mean = F.array(*[F.coalesce(F.col(f"_d{i}") / F.col("n_known"), F.lit(0.0))
                     for i in range(size)])
    return df.select(key).join(sums, key, "left").select(
        key, F.coalesce("n_known", F.lit(0)).alias("n_known"), mean.alias("centroid"))
