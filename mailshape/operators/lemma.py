"""Noun lemmas through joins with a lexicon table.

The lexicon is a table ``(word)`` of known nouns and the exceptions a table ``(word, lemma)`` of
irregular forms; both are inputs. A word's lemma is the shortest known form among the word itself and
what the rules make of it (the earlier one on a tie). If none is known the rules are applied again
to their own results, until a form is known or none is left, and then the word stays as it is. A word
listed as an exception is matched against its listed lemmas only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from mailshape.functions import text as T
from mailshape.operators.scale import lookup_join
from mailshape.session import land

# Fixed noun rules in fixed order: (ending, what replaces it).
NOUN_RULES = [
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
    ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
]

# Changed words of one mail per lookup map, and the most maps one mail gets.
WORDS_PER_MAP = 32
MAPS_PER_MAIL = 1024


def detached_forms(word: Column) -> Column:
    """Array of the forms the rules make of ``word``, in rule order."""
    made = [
        F.when(F.endswith(word, F.lit(ending)),
               F.concat(F.left(word, F.length(word) - len(ending)), F.lit(new)))
        for ending, new in NOUN_RULES
    ]
    return F.array_compact(F.array(*made))


def candidate_forms(word: Column) -> Column:
    """Array of ``(round, form)`` in the order of preference within a round.

    Round 1 holds the word and its detached forms, each later round what the rules make of the
    round before. A rule takes its ending from the trailing run of "s" and "e" (apart from "men",
    which can only come last), so the length of that run bounds the number of rounds.
    """
    first = detached_forms(word)
    rounds = F.length(F.regexp_extract(word, "[es]*$", 0)) + 2

    def numbered(forms: Column, number: Column) -> Column:
        return F.transform(forms, lambda f: F.struct(number.alias("round"), f.alias("form")))

    def next_round(state: Column, number: Column) -> Column:
        made = F.array_distinct(F.flatten(F.transform(state["last"], detached_forms)))
        return F.struct(made.alias("last"),
                        F.concat(state["all"], numbered(made, number)).alias("all"))

    start = F.struct(
        first.alias("last"), numbered(F.concat(F.array(word), first), F.lit(1)).alias("all"))
    return F.aggregate(F.sequence(F.lit(2), rounds), start, next_round, lambda state: state["all"])


def lemma_map(words: DataFrame, lexicon: DataFrame,
              exceptions: DataFrame | None = None) -> DataFrame:
    """Landed ``(word, lemma)`` for those distinct ``words`` whose lemma differs from them.

    Works on the vocabulary, never on running text, and only words that a rule or an exception
    applies to meet the lexicon.
    """
    regular = words.select("word").filter(F.size(detached_forms(F.col("word"))) > 0)
    candidates = regular.select("word", candidate_forms(F.col("word")).alias("forms"))
    if exceptions is not None:
        listed = exceptions.groupBy("word").agg(F.array_sort(F.collect_set("lemma")).alias("_l"))
        irregular = words.join(listed, "word").select("word", F.transform(
            F.concat(F.array("word"), F.col("_l")),
            lambda f: F.struct(F.lit(1).alias("round"), f.alias("form"))).alias("forms"))
        candidates = candidates.join(listed, "word", "left_anti").unionByName(irregular)

    forms = candidates.select("word", F.posexplode_outer("forms").alias("rank", "_f")).select(
        "word", "rank", "_f.round", "_f.form")
    known = forms.join(lexicon.select(F.col("word").alias("form")), "form", "left_semi")
    best = known.groupBy("word").agg(
        F.min_by("form", F.struct("round", F.length("form"), "rank")).alias("lemma"))
    return land(best.filter(F.col("lemma") != F.col("word")), "lemma_map")


def corpus_words(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct tokens of cleaned text columns as ``(word)``."""
    per_mail = F.array_distinct(F.concat(*[T.cleaned_tokens(F.col(c)) for c in columns]))
    return df.select(F.explode(per_mail).alias("word")).distinct()


def lemmatize(df: DataFrame, columns: Sequence[str], lemmas: DataFrame,
              key: str = "mail_id") -> DataFrame:
    """Replace every token of the cleaned ``columns`` by its lemma.

    Token order is kept without exploding whole texts through a shuffle: the words of a mail that
    change (distinct, and only those) are gathered per mail, come back by ``key`` and are applied
    inside the row. Looking a word up in a Spark map is a linear search, so a mail with many changes
    has them split over several maps by hash.
    """
    per_mail = F.array_distinct(F.concat(*[T.cleaned_tokens(F.col(c)) for c in columns]))
    words = df.select(key, F.explode(per_mail).alias("word"))
    gathered = lookup_join(words, lemmas, "word").groupBy(key).agg(
        F.collect_list(F.struct("word", "lemma")).alias("_all"))
    count = F.least(F.greatest(F.size("_all") / WORDS_PER_MAP, F.lit(1)), F.lit(MAPS_PER_MAIL))

    def slot(word: Column) -> Column:
        return F.pmod(F.xxhash64(word), F.col("_count")).cast("int")

    split = F.transform(
        F.sequence(F.lit(0), F.col("_count") - 1),
        lambda number: F.map_from_entries(
            F.filter("_all", lambda change: slot(change["word"]) == number)))
    changes = gathered.withColumn("_count", count.cast("int")).select(
        key, "_count", split.alias("_maps"))

    def lemma_of(token: Column) -> Column:
        found = F.try_element_at(F.element_at(F.col("_maps"), slot(token) + 1), token)
        return F.coalesce(found, token)

    def replaced(column: str) -> Column:
        return F.when(F.col("_maps").isNull(), F.col(column)).otherwise(
            F.array_join(F.transform(T.cleaned_tokens(F.col(column)), lemma_of), " "))

    return df.join(changes, key, "left").withColumns(
        {column: replaced(column) for column in columns}).drop("_maps", "_count")
