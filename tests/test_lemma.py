import random

import pytest

from mailshape.operators.lemma import NOUN_RULES, lemma_map, lemmatize
from mailshape.operators.scale import lookup_join

LEXICON = ["dog", "class", "bus", "box", "wolf", "buzz", "church", "dish", "man", "fly", "glasses",
           "glass", "mouse", "ox", "axis", "axe", "s", "men", "policeman", "xs", "ab"]
EXCEPTIONS = [("mice", "mouse"), ("oxen", "ox"), ("axes", "axis"), ("axes", "axe"), ("dogs", "hound")]


def python_lemma(word):
    listed = dict()
    for w, l in EXCEPTIONS:
        listed.setdefault(w, []).append(l)

    def best(forms):
        known = [f for f in forms if f in LEXICON]
        return min(known, key=len) if known else None

    def apply(forms):
        return [f[:-len(e)] + n for f in forms for e, n in NOUN_RULES if f.endswith(e)]

    if word in listed:
        return best([word, *sorted(listed[word])]) or word
    forms = apply([word])
    found = best([word, *forms])
    while found is None and forms:
        forms = apply(forms)
        found = best(forms)
    return found or word


def words_to_try():
    rng = random.Random(3)
    ends = ["s", "ses", "ves", "xes", "zes", "ches", "shes", "men", "ies", "ss", "sses", "seses", ""]
    made = {w + "".join(rng.choice(ends) for _ in range(rng.randint(0, 3)))
            for w in LEXICON + ["wol", "fl", "zz", "q"] for _ in range(12)}
    return sorted(made | {w for w, _ in EXCEPTIONS} | {"sssssssss", "bosses", "glasses", "now!"})


def test_lemmas_match_brute_force(spark):
    words = words_to_try()
    got = lemma_map(spark.createDataFrame([(w,) for w in words], "word string"),
                    spark.createDataFrame([(w,) for w in LEXICON], "word string"),
                    spark.createDataFrame(EXCEPTIONS, "word string, lemma string"))
    want = {w: python_lemma(w) for w in words if python_lemma(w) != w}
    assert {r.word: r.lemma for r in got.collect()} == want
    assert want["sssssssss"] == "s" and want["mice"] == "mouse" and "dogs" not in want


def test_lemmatize_keeps_token_order(spark):
    mail = spark.createDataFrame(
        [(1, "dogs and mice dogs", "the boxes"), (2, "nothing here", ""), (3, "", "dogs")],
        "mail_id bigint, subject string, body string")
    lemmas = spark.createDataFrame(
        [("dogs", "dog"), ("mice", "mouse"), ("boxes", "box")], "word string, lemma string")
    rows = {r.mail_id: (r.subject, r.body)
            for r in lemmatize(mail, ["subject", "body"], lemmas).collect()}
    assert rows == {1: ("dog and mouse dog", "the box"), 2: ("nothing here", ""), 3: ("", "dog")}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_lookup_gives_the_same_rows(spark, how):
    facts = spark.createDataFrame(
        [(i, "hot" if i % 3 else f"k{i}") for i in range(300)], "id bigint, key string")
    lookup = spark.createDataFrame([("hot", 1), ("k0", 2), ("k9", 3)], "key string, v int")
    small = lookup_join(facts, lookup, "key", how)
    large = lookup_join(facts, lookup, "key", how, salts=5)
    key = lambda r: (r.id, r.key, r.v or 0)
    assert sorted(map(key, small.collect())) == sorted(map(key, large.collect()))
    assert large.count() == (202 if how == "inner" else 300)


def test_many_changes_in_one_mail(spark):
    words = [f"w{i}s" for i in range(3000)]
    mail = spark.createDataFrame([(1, " ".join(words + ["keep"] + words)), (2, "w5s")],
                                 "mail_id bigint, body string")
    lemmas = spark.createDataFrame([(w, w[:-1]) for w in words], "word string, lemma string")
    rows = {r.mail_id: r.body for r in lemmatize(mail, ["body"], lemmas).collect()}
    short = [w[:-1] for w in words]
    assert rows == {1: " ".join(short + ["keep"] + short), 2: "w5"}
