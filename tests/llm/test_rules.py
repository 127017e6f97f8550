"""Quality rules and URL filters beyond what the SQL of their queries shows."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mailshape.llm import quality, urlfilter

DOCS = "doc_id bigint, text string, source string, kept string"
PAGES = "page_id bigint, url string, host string"


def by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    spots = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    repeated = {i + k for i in range(len(words) - 4) if spots[tuple(words[i:i + 5])] > 1
                for k in range(5)}
    lines = [s for s in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(repeated))


TEXTS = [None, "", " \n\t\x0b\x0c\r ", "a b c d", "a b c d e", "a b c d e a b c d e",
         "x " * 30, "l one\nl two\nl one\n\n \nl one", "é\u00a0ß # $| <b>", "a\x1cb a\x85b \u2003",
         "a b c d e f " * 3, "😀 w " * 9, " ".join("w%d" % (i % 700) for i in range(20_000))]


def test_counts(spark):
    frame = spark.createDataFrame([(i, t, "s", "x") for i, t in enumerate(TEXTS)], DOCS)
    out = quality.rule_counts(frame).collect()
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == by_hand(
            TEXTS[r.doc_id]), r.doc_id


def test_host_verdicts(spark):
    good = "ten different words are in this text so it passes all"
    rows = [(i, good, "good", "x") for i in range(40)] + [(i, "bad", "bad", "x") for i in range(40)]
    rows += [(90, "bad", "small", "x"), (91, good, "bad", "x"), (92, good, None, "x"),
             (93, None, None, "x"), (94, good, "good", "x"), (94, good, "good", "x")]
    out = quality.quality_rules(spark.createDataFrame(rows, DOCS)).collect()
    assert len(out) == len(rows)
    rates = {r.source: r.host_rate for r in out}
    assert rates["bad"] > 0.9 and rates["good"] < 0.1 and rates["small"] < 0.95
    for r in out:
        assert r.kept == (not r.base_failed and rates[r.source] <= 0.5)
    assert not next(r for r in out if r.doc_id == 91).kept
    assert quality.quality_rules(spark.createDataFrame([], DOCS)).count() == 0


def test_prior_by_moments(spark):
    hosts = spark.createDataFrame([(1000, 100), (1000, 300)], "n bigint, failed bigint")
    alpha, beta = quality.beta_prior(hosts)
    noise, k, n = 0.2 * 0.8, 2, 2000
    spread = 0.01 - noise * k / n
    assert alpha / (alpha + beta) == pytest.approx(0.2)
    assert alpha + beta == pytest.approx(noise / spread - 1)
    assert quality.beta_prior(hosts.limit(0)) == (1.0, 1.0)
    assert quality.beta_prior(hosts.select("n", F.lit(0).cast("bigint").alias("failed"))) == (1, 2001)


def judged(spark, urls, rules, listed=()):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], PAGES)
    frame = spark.createDataFrame([(u,) for u in listed], "url string") if listed else None
    out = urlfilter.filter_urls(pages, urlfilter.rule_table(spark, rules), frame).collect()
    assert len(out) == len(urls)
    return {urls[r.page_id]: (r.rule, r.verdict) for r in out}


def test_given_rules(spark):
    cases = {
        "http://a.net/x": ("net/", "block"), "http://a.net": (None, "allow"),
        "http://NET/": ("net/", "block"), "http://anet/": (None, "allow"),
        "https://m.example.net/en/5?q#f": ("example.net/en/", "allow"),
        "https://m.example.net/en": ("net/", "block"), "https://badexample.net/en/": ("net/", "block"),
        "x://example.com/de/": ("example.com/de/", "block"), "x://example.com/DE/": (None, "allow"),
        "x://a.org/fr/": ("org/fr/", "allow"), "x://a.org?/fr/": (None, "allow"),
        "no scheme.net/": (None, "allow"), None: (None, "allow"), "": (None, "allow"),
        "://": (None, "allow"), "a://b://c.net/": (None, "allow"), "x://..net/": ("net/", "block")}
    assert judged(spark, list(cases), urlfilter.RULES) == cases


def test_longest_rule_and_ties(spark):
    rules = [("a.b", "/", "block"), ("b", "/cc/", "allow"), ("b", "/", "block"), ("b", "/", "allow"),
             (None, "/", "block"), ("", "/", "block"), ("b", None, "block"), ("b", "cc", "block")]
    assert judged(spark, ["x://a.b/cc/d", "x://a.b/d", "x://c.b/d"], rules) == {
        "x://a.b/cc/d": ("b/cc/", "allow"), "x://a.b/d": ("a.b/", "block"),
        "x://c.b/d": ("b/", "block")}


def test_listed_urls(spark):
    found = judged(spark, ["http://www.q.org/p.html?x", "http://q.org/p/", "http://q.org/pp",
                           "http://q.org/fr/p"], urlfilter.RULES,
                   ["https://m.q.org/p", "http://q.org/fr/p", "none", None])
    assert found == {"http://www.q.org/p.html?x": (None, "block"), "http://q.org/p/": (None, "block"),
                     "http://q.org/pp": (None, "allow"), "http://q.org/fr/p": ("org/fr/", "allow")}


def test_many_rules_against_a_scan(spark):
    """No listed URL is lost by the filter, and its false hits change nothing."""
    rules = [("h%d.org" % (i % 50), "/p%d/" % i, "block" if i % 3 else "allow") for i in range(900)]
    urls = ["http://w.h%d.org/p%d/x" % (i % 60, i % 1000) for i in range(1500)]
    held = {(h, p): v for h, p, v in rules}
    for url, (rule, verdict) in judged(spark, sorted(set(urls)), rules).items():
        host, path = re.match(r"http://w\.([^/]*)(/p\d+/)", url).groups()
        want = held.get((host, path))
        assert (rule, verdict) == ((host + path, want) if want else (None, "allow"))


def test_no_rules_no_pages(spark):
    assert judged(spark, ["http://a.net/"], []) == {"http://a.net/": (None, "allow")}
    assert judged(spark, [], urlfilter.RULES) == {}
