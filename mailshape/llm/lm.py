"""Language-model scoring of whole documents with a gated recurrent model.

Counts of all training tokens come from the whole corpus. The most frequent words are symbols of the
recurrent model; all others fall into a few classes by their look, in which a word's chance is its
smoothed count, so the model gives every token a probability. Each training task trains on its share
of the corpus from common weights, which are then averaged.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from mailshape.llm import gru
from mailshape.session import land

# Fixed values of the contract.
FOLDS, HELD_OUT = 5, 1
SMOOTHING = 0.5
# The end of a text, counted as a token; no word can hold white space.
END = "\n"

# Words whose counts every task holds; the first HEAD of them are symbols of the recurrent model.
# The counts of all other words are joined.
LEXICON, HEAD = 131_072, 8192
CLASSES = 48
# Training: passes with averaged weights between them, each over its own part of the training
# documents (one in so many), so together they see every one; tasks of a pass at most.
ROUNDS, ONE_IN, TRAINERS = 2, 1, 12
RATE = 0.1
_COUNTED_AT_ONCE = 500_000
_TOKENS_AT_ONCE = 4_000_000

LOOKS = 30
_LOG10 = math.log(10.0)


def words(text: str | None) -> list[bytes]:
    """Runs without ASCII white space, A-Z lower-cased."""
    return (text or "").encode("utf-8", "replace").lower().split()


def look(word: bytes) -> int:
    """One of ``LOOKS`` classes by a word's last byte and its first letter beyond ASCII."""
    last = word[-1]
    ending = (0 if 97 <= last <= 122 else 1 if last == 46 else 2 if last == 44
              else 3 if 48 <= last <= 57 else 4 if last >= 128 else 5)
    if word.isascii():
        return ending * 5
    first = next(i for i, b in enumerate(word) if b >= 0xC2)
    return ending * 5 + 1 + (word[first + 1] & 3)


def held_out(id_col: str) -> Column:
    """Whether ``crc32(id as text) mod 5`` is 1; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) \
        % FOLDS == HELD_OUT


def token_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(word, look, c)`` of all tokens of ``docs``, the ends included; pre-counted by task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            found = list(counts)
            made = pa.RecordBatch.from_arrays(
                [pa.array(found, pa.binary()).cast(pa.string()),
                 pa.array([look(w) for w in found], pa.int32()),
                 pa.array(list(counts.values()), pa.int64())], ["word", "look", "c"])
            counts.clear()
            return made

        for batch in batches:
            for text in batch.column(0):
                counts.update(words(text.as_py()))
                counts[END.encode()] += 1
                if len(counts) > _COUNTED_AT_ONCE:
                    yield flushed()
        yield flushed()

    return docs.select(text_col).mapInArrow(count, "word string, look int, c bigint").groupBy(
        "word", "look").agg(F.sum("c").alias("c"))


@dataclass
class Lexicon:
    """Counts of the most frequent words and of all; ``symbols`` of the recurrent model."""

    ids: dict[bytes, int]      # a word's place, by falling count; 0 is the end
    counts: np.ndarray
    symbol: np.ndarray         # by place: the model's symbol
    symbol_counts: np.ndarray  # by symbol: tokens of it in training
    looks: np.ndarray          # by look: smoothed tokens of all words outside the head, one unseen
    tokens: int
    types: int

    @property
    def head(self) -> int:
        return len(self.symbol_counts) - LOOKS

    def encode(self, found: list[bytes]) -> np.ndarray:
        """Places of words, and of the end; a word outside the lexicon is -1 - its look."""
        get = self.ids.get
        places = [get(w) for w in found]
        return np.array([p if p is not None else -1 - look(w) for p, w in zip(places, found)] + [0],
                        dtype=np.int64)

    def symbols(self, places: np.ndarray) -> np.ndarray:
        return np.where(
            places >= 0, self.symbol[np.maximum(places, 0)], self.head - 1 - places).astype(np.int32)


def build_lexicon(counts: DataFrame, lexicon: int = LEXICON, head: int = HEAD) -> Lexicon:
    """From landed :func:`token_counts`; at most ``lexicon`` words and ``LOOKS`` sums are collected."""
    tokens, types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = counts.filter(F.col("word") != END).orderBy(F.col("c").desc(), "word").limit(
        lexicon - 1).select(F.encode("word", "utf-8").alias("w"), "look", "c").toArrow()
    ends = counts.filter(F.col("word") == END).select("c").first()
    found = [END.encode(), *top.column("w").to_pylist()]
    own = np.array([ends[0] if ends else 0, *top.column("c").to_pylist()], dtype=np.int64)
    look_of = np.array([0, *top.column("look").to_pylist()])
    sums = {r["look"]: (r["c"], r["n"]) for r in counts.filter(F.col("word") != END).groupBy(
        "look").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()}
    size = min(head, len(found))
    look_tokens = np.array([sums.get(k, (0, 0))[0] for k in range(LOOKS)], dtype=float)
    look_types = np.array([sums.get(k, (0, 0))[1] for k in range(LOOKS)], dtype=float)
    np.subtract.at(look_tokens, look_of[1:size], own[1:size])
    np.subtract.at(look_types, look_of[1:size], 1)
    symbol = np.concatenate([np.arange(size), size + look_of[size:]])
    return Lexicon({w: i for i, w in enumerate(found)}, own, symbol.astype(np.int64),
                   np.concatenate([own[:size], look_tokens]),
                   look_tokens + SMOOTHING * (look_types + 1), tokens, types)


def _packed(p: dict) -> list[bytes]:
    return [p[k].astype("<f4").tobytes() for k in sorted(p)]


def train(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text",
          rounds: int = ROUNDS, one_in: int = ONE_IN, trainers: int = TRAINERS):
    """Weights and classes after ``rounds`` passes with averaging, by tokens, between them."""
    classes = gru.Classes.by_frequency(lexicon.symbol_counts, CLASSES, LOOKS)
    p = gru.initial(lexicon.symbol_counts, classes)
    slot = F.pmod(F.xxhash64(F.lit("train"), id_col, text_col), F.lit(one_in * rounds))
    for number in range(rounds):
        start = p

        def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mine = {k: v.copy() for k, v in start.items()}
            optimiser, seen, held, size = gru.AdaGrad(mine, RATE), 0, [], 0
            for batch in batches:
                for text in batch.column(0):
                    held.append(lexicon.symbols(lexicon.encode(words(text.as_py()))))
                    size += len(held[-1])
                    if size >= _TOKENS_AT_ONCE:
                        seen += gru.train(mine, classes, held, optimiser)[1]
                        held, size = [], 0
            seen += gru.train(mine, classes, held, optimiser)[1]
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([seen], pa.int64()), pa.array([_packed(mine)], pa.list_(pa.binary()))],
                    ["tokens", "weights"])

        # At most `trainers` rows of the weights' fixed size come back.
        made = docs.filter(slot == number).select(text_col).coalesce(trainers).mapInArrow(
            fit, "tokens bigint, weights array<binary>").collect()
        every = sum(r["tokens"] for r in made)
        if every:
            made = sorted(made, key=lambda r: (r["tokens"], bytes(r["weights"][0][:64])))
            p = {k: sum(np.frombuffer(r["weights"][i], "<f4").astype(np.float64) * r["tokens"]
                        for r in made).reshape(p[k].shape).astype(np.float32) / np.float32(every)
                 for i, k in enumerate(sorted(p))}
    return p, classes


def score(docs: DataFrame, lexicon: Lexicon, p: dict, classes: gru.Classes, counts: DataFrame,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, n_known, base_score, score)`` per row, both scores in log10."""
    id_type = docs.schema[id_col].dataType.simpleString()
    known = (lexicon.counts > 0).astype(np.int64)
    logs = np.log10(lexicon.counts + SMOOTHING)
    look_logs = np.log10(lexicon.looks)
    beyond = lexicon.head

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 36
        ids, texts, others, numbers, size = [], [], [], [], 0
        id_arrow = None

        def scored() -> pa.RecordBatch:
            nonlocal number
            streams = [lexicon.symbols(t) for t in texts]
            found = gru.score(p, classes, streams) / _LOG10
            base, sure = [], []
            for i, places in enumerate(texts):
                inside = places[places >= 0]
                base.append(logs[inside].sum())
                sure.append(known[inside].sum())
                # A symbol of rare words: the word's smoothed count within its look.
                rare = streams[i][streams[i] >= beyond] - beyond
                found[i] += logs[inside[inside >= beyond]].sum() - look_logs[rare].sum()
            rows = range(number, number + len(ids))
            number += len(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(ids, id_arrow),
                 pa.array([len(t) for t in texts], pa.int64()), pa.array(sure, pa.int64()),
                 pa.array(base, pa.float64()), pa.array(found, pa.float64()),
                 pa.array(others, pa.list_(pa.string())), pa.array(numbers, pa.list_(pa.int64()))],
                ["_row", "_id", "n_tokens", "n_known", "base", "found", "others", "numbers"])

        for batch in batches:
            id_arrow = batch.schema.field(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = words(text.as_py())
                places = lexicon.encode(raw)
                rest = Counter(raw[i] for i in np.flatnonzero(places[:-1] < 0).tolist())
                ids.append(key)
                texts.append(places)
                others.append([w.decode() for w in rest])
                numbers.append(list(rest.values()))
                size += len(places)
                if size >= _TOKENS_AT_ONCE:
                    yield scored()
                    ids, texts, others, numbers, size = [], [], [], [], 0
        if ids:
            yield scored()

    made = land(docs.select(id_col, text_col).mapInArrow(
        run, f"_row bigint, _id {id_type}, n_tokens bigint, n_known bigint, base double, "
        "found double, others array<string>, numbers array<bigint>"), "scored")
    # Words outside the lexicon are rare by its making; their counts are joined by word.
    pairs = made.select("_row", F.explode(F.arrays_zip("others", "numbers")).alias("o")).select(
        "_row", F.col("o.others").alias("word"), F.col("o.numbers").alias("n"))
    rest = pairs.join(counts.select("word", "c"), "word", "left").groupBy("_row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("sure"),
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(SMOOTHING))).alias("logs"))
    total = lexicon.tokens + SMOOTHING * (lexicon.types + 1)
    more = F.coalesce("logs", F.lit(0.0))
    return made.drop("others", "numbers").join(rest, "_row", "left").select(
        F.col("_id").alias(id_col), "n_tokens",
        (F.col("n_known") + F.coalesce("sure", F.lit(0))).alias("n_known"),
        (F.col("base") + more - F.col("n_tokens") * F.lit(math.log10(total))).alias("base_score"),
        (F.col("found") + more).alias("score"))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    lexicon: int = LEXICON, head: int = HEAD, one_in: int = ONE_IN) -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row of ``docs``.

    Learns from rows that are not held out. A null or empty text is its end alone. Rows with the same
    or a null id are rows of their own; other columns are not read; an empty table gives no rows.
    """
    training = docs.filter(~held_out(id_col))
    counts = land(token_counts(training, text_col), "token-counts")
    words_held = build_lexicon(counts, lexicon, head)
    p, classes = train(training, words_held, id_col, text_col, one_in=one_in)
    scored = score(docs, words_held, p, classes, counts, id_col, text_col)
    return scored.select(
        id_col, held_out(id_col).alias("held_out"), "n_tokens", "n_known",
        F.lit(words_held.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
