import re
import string

import pytest
from pyspark.sql import functions as F

from mailshape.functions import text as T
from mailshape.functions.chars import DIGIT_LIKE_CHARACTERS, WHITE_CHARACTERS
from mailshape.functions.structural import STRUCTURAL_COLUMNS
from mailshape.operators.prepare import preprocess

TRAPS = [
    ("Hello", "plain body", "a@b.org"),
    ("", "", ""),
    ("   ", "　", "  "),
    ("A1! NOW FREE 123 I OK", "Buy NOW!!! why? VISIT HTTP://X.Y and https://a.b/c www.d.e", "BOSS 99 <Boss.9@Ex-1.co.uk>"),
    ("tabs\tand\x1cfs", "nb sp em sp line sep", "no at sign here"),
    ("ÉCOLE Straße ǅ ªº ⅣX", "naïve café ١٢٣ ²³ ① x", "josé@exämple.ñet"),
    ("<a href='http://in.tag'>link</a>", "a < b and c > d <br\n/> httpfoo http HTTP://y http://z", "x@y"),
    ("content type text html", "Content-Type: text/html; CONTENT TYPE TEXT HTML text/htmltext/html", "@"),
    ("".join(string.punctuation), "a.b,c!d?e", "q.w-e_r@t.y1"),
    ("ABİ KelvinK ǅA", "\U0001F600 emoji \U0001D400", "É@É.É"),
    ("one\r\ntwo", "trailing \n", "a @ b . c"),
]


KEPT = set(string.ascii_letters + string.digits + "!?.,")
MARKED = [("<[^>]+>", " "), (r"http\S+|www\.\S+", " URL ")]


def python_clean(raw):
    for pattern, mark in MARKED:
        raw = mark.join(re.split(pattern, raw))
    return " ".join("".join(c if c in KEPT else " " for c in raw).lower().split())


def python_features(subject, body, sender):
    whole = f"{subject} {body}".strip()
    share = lambda n, d: n / d if d else 0.0
    letters = [c for c in whole if c.isalpha()]
    sender_letters = [c for c in sender if c.isalpha()]
    punctuation = lambda s: sum(c in string.punctuation for c in s)
    digits = lambda s: sum(c.isdigit() for c in s)
    urls = len(re.findall(r"https?://\S+|www\.\S+", whole, re.I))
    words = len(whole.split())
    return [
        urls, share(urls, words), whole.count("!"), whole.count("?"),
        share(sum(c.isupper() for c in letters), len(letters)), share(digits(whole), len(whole)),
        share(punctuation(whole), len(whole)),
        share(sum(len(w) > 1 and w.isupper() for w in whole.split()), words),
        body.lower().count("content type text html") + body.lower().count("text/html"),
        len(subject), len(body), len(sender), len(subject.split()), len(body.split()), words,
        len(sender.split()), bool(re.search(r"[\w.-]+@[\w.-]+\.\w+", sender)), "@" in sender,
        share(digits(sender), len(sender)),
        share(sum(c.isupper() for c in sender_letters), len(sender_letters)),
        share(punctuation(sender), len(sender)),
    ]


def test_character_tables_match_python():
    every = [chr(i) for i in range(0x110000)]
    assert set(WHITE_CHARACTERS) == {c for c in every if c.isspace()}
    assert set(DIGIT_LIKE_CHARACTERS) == {c for c in every if c.isdigit() and not c.isdecimal()}


@pytest.fixture(scope="module")
def prepared(spark):
    rows = [(i, *t, 0) for i, t in enumerate(TRAPS)]
    frame = spark.createDataFrame(
        rows, "mail_id bigint, subject string, body string, sender string, label int")
    return {r.mail_id: r for r in preprocess(frame).collect()}


@pytest.mark.parametrize("i", range(len(TRAPS)))
def test_features_and_cleaning_match_python(prepared, i):
    subject, body, sender = TRAPS[i]
    row = prepared[i]
    got = dict(zip(STRUCTURAL_COLUMNS, [row[c] for c in STRUCTURAL_COLUMNS]))
    want = dict(zip(STRUCTURAL_COLUMNS, map(float, python_features(*TRAPS[i]))))
    assert got == pytest.approx(want, abs=1e-12)
    assert (row.subject, row.body, row.sender) == tuple(map(python_clean, TRAPS[i]))
    assert row.text == f"{row.subject} {row.body}".strip()
    assert (row.raw_subject, row.raw_body, row.raw_sender) == (subject, body, sender)


def test_long_generated_texts_match_python(spark):
    import random
    rng = random.Random(7)
    alphabet = "aAbZ09 \t !?.,<>@/:é²É -_'"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 400))) for _ in range(300)]
    frame = spark.createDataFrame(
        [(i, t, texts[-i], t[:40], 0) for i, t in enumerate(texts)],
        "mail_id bigint, subject string, body string, sender string, label int")
    for row in preprocess(frame).collect():
        want = python_features(row.raw_subject, row.raw_body, row.raw_sender)
        assert [row[c] for c in STRUCTURAL_COLUMNS] == pytest.approx(list(map(float, want)))
        assert row.subject == python_clean(row.raw_subject)


def test_nulls_count_as_empty(spark):
    frame = spark.createDataFrame(
        [(1, None, None, None, 1)],
        "mail_id bigint, subject string, body string, sender string, label int")
    row = preprocess(frame).first()
    assert row.text == row.raw_body == row.sender == ""
    assert all(row[c] == 0.0 for c in STRUCTURAL_COLUMNS)
    assert len(row) == 30


def test_url_marking_and_ratio(spark):
    frame = spark.createDataFrame(
        [("see https://x and httpfoo http HTTP://y www.z",)], "t string").select(
        T.clean_characters(F.col("t")).alias("c"), T.safe_ratio(F.lit(1), F.lit(0)).alias("r"),
        T.cleaned_tokens(F.lit("")).alias("none"), T.cleaned_tokens(F.lit("now! a.b")).alias("two"),
        T.cleaned_token_count(F.lit("")).alias("n0"), T.cleaned_token_count(F.lit("a b c")).alias("n3"))
    row = frame.first()
    assert row.c == "see url and url http http y url"
    assert (row.r, row.none, row.two, row.n0, row.n3) == (0.0, [], ["now!", "a.b"], 0, 3)


def test_tags_around_the_last_bracket(spark):
    import time
    texts = ["<a>x<b", "a > b < c", "<<>>x<y>", "no tags", ">", "<>", "<\n>é<", "<" * 5 + "é>" + "<" * 5,
             "<" * 400_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    start = time.time()
    got = [r.c for r in frame.orderBy("i").select(T.clean_characters(F.col("t")).alias("c")).collect()]
    assert time.time() - start < 20
    assert got == [python_clean(t) for t in texts[:-1]] + [""]
