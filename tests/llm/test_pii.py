import hashlib
import math
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from mailshape.llm import pii
from mailshape.llm.queries import op6_pii
from mailshape.llm.semicrf import Region, SemiCRF

SCHEMA = "doc_id bigint, text string, spans string"


def by_pattern(text):
    """The base patterns as they are written, with the re module."""
    found = [(*m.span(), "email") for m in re.finditer(
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(*m.span(), "ip") for m in re.finditer(
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
        if all(int(p) <= 255 for p in m.group().split("."))]
    for kind, pattern, low, high in (("card", r"[0-9]([\x20-]?[0-9])+", 12, 19),
                                     ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if low <= len(digits) <= high and (kind == "phone" or pii.luhn(digits)):
                found.append((*m.span(), kind))
    return sorted(found, key=lambda s: (s[0], pii.KINDS.index(s[2])))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab0123459.@+- ()_é", max_size=60))
def test_base_equals_patterns(text):
    assert pii.base_spans(text) == by_pattern(text)


@pytest.mark.parametrize("text", [
    "a@b.c@d.e x@y a@@b.c .@-.- é@b.c", "1.2.3.4.5 256.1.1.1 01.02.003.0004 1.2.3", "+1 (2) 3-4 5",
    "4111 1111 1111 1111 4111-1111-1111-1112", "+14111111111111111 4111111111111111", "9" * 5000])
def test_base_cases(text):
    assert pii.base_spans(text) == by_pattern(text)


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 300_000,
                                  "+1" * 150_000, "a." * 100_000 + "@", "1 " * 150_000])
def test_long_runs_take_linear_time(text):
    pii.base_spans(text)
    assert len(pii.regions(text)) < 200_000


def weighted(kinds=("x", "y")):
    model, rng = SemiCRF(kinds), np.random.default_rng(2)
    region = Region("to +12 3.4 b")
    for features in [f for _, _, f in region.segments] + region.outside:
        for f in features:
            model.weights.setdefault(f, rng.normal(size=model.width))
    model.turns = rng.normal(size=model.turns.shape)
    return model, region


def every_path(model, region):
    """All segmentations with their scores."""
    lattice = model._lattice(region)

    def walk(at, kind):
        if at == len(lattice) - 1:
            yield 0.0, ()
            return
        for end in range(at + 1, len(lattice)):
            for first, score, _ in lattice[end]:
                if first == at:
                    for k in np.flatnonzero(np.isfinite(score)):
                        for rest, path in walk(end, k):
                            step = ((region.starts[at], region.ends[end - 1], model.kinds[k - 1]),)
                            yield score[k] + model.turns[kind, k] + rest, (step if k else ()) + path

    yield from walk(0, 0)


def test_decoding_and_likelihood_equal_enumeration():
    model, region = weighted()
    paths = list(every_path(model, region))
    assert len(paths) > 100
    best = max(paths)
    assert model.decode(region) == list(best[1])
    norm = math.log(sum(math.exp(s) for s, _ in paths))
    for score, gold in paths[:20]:
        assert model.gradient(region, list(gold))[0] == pytest.approx(score - norm)


def test_gradient_by_differences():
    model, region = weighted()
    gold = [(3, 6, "x")]
    _, grad, turns = model.gradient(region, gold)
    for f in list(grad)[::7]:
        for k in range(model.width):
            model.weights[f][k] += 1e-5
            up = model.gradient(region, gold)[0]
            model.weights[f][k] -= 2e-5
            down = model.gradient(region, gold)[0]
            model.weights[f][k] += 1e-5
            assert grad[f][k] == pytest.approx((up - down) / 2e-5, abs=1e-5)
    model.turns[0, 1] += 1e-5
    up = model.gradient(region, gold)[0]
    model.turns[0, 1] -= 2e-5
    assert turns[0, 1] == pytest.approx((up - model.gradient(region, gold)[0]) / 2e-5, abs=1e-5)


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_model_adds_what_patterns_miss(model):
    finder = pii.Finder(model)
    for text, wanted in (("call (603) 555-8791 now", [("(603) 555-8791", "phone")]),
                         ("words only, nothing at all", []), ("paid 12345 in 2024", [])):
        assert [(text[a:b], k) for a, b, k in finder.spans(text)[1]] == wanted
    text = "x@y.org and 1.2.3.4"
    assert set(finder.spans(text)[0]) <= set(finder.spans(text)[1])


@pytest.mark.parametrize("address", [
    "jane.doe (at) mail (dot) example (dot) org", "jane [at] host (dot) com",
    "jane (at) mail (dot) example (dot) co (dot) uk", "j.r.doe (at) a (dot) b (dot) c (dot) d (dot) org",
    "x" * 60 + " (at) mail (dot) org", "jane (at) " + "b" * 60 + " (dot) example (dot) org"])
def test_spaced_addresses_are_whole(model, address):
    text = f"write to {address} today or tomorrow"
    assert any(a <= 9 and b >= 9 + len(address) for a, b in pii.regions(text))
    assert pii.redacted(text, pii.Finder(model).spans(text)[1]) == "write to [EMAIL] today or tomorrow"


def test_redaction():
    assert pii.redacted("a x@y.z b", [(2, 7, "email")]) == "a [EMAIL] b"
    assert pii.redacted("123456 7", [(0, 4, "ip"), (2, 6, "card"), (7, 8, "ip")]) == "[IP] [IP]"


def test_odd_rows(spark, model):
    rows = [(1, None, "x"), (2, "", "x"), (3, "é x@y.org", "x"), (3, "é x@y.org", "x"),
            (None, "+1 (609) 555-7932", "x"), (4, "word " * 50_000 + "1.2.3.4", "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = docs.select("doc_id", pii.find_spans(model, docs["text"]).alias("f"),
                      pii.redact(model, docs["text"]).alias("t")).collect()
    found = [(r.doc_id, r.f.base) for r in out]
    assert found == [(1, ""), (2, ""), (3, "email:2:9"), (3, "email:2:9"),
                     (None, "phone:0:17"), (4, "ip:250000:250007")]
    assert [r.t for r in out][:4] == [None, "", "é [EMAIL]", "é [EMAIL]"]
    empty = docs.limit(0)
    assert not pii.fit(empty).weights
    assert empty.select(pii.find_spans(model, empty["text"])).count() == 0
    nothing = pii.Finder(pii.fit(docs.filter("doc_id = 1")))
    assert nothing.spans("(603) 555-8791") == ([], [])


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = dict(map(tuple, spark.read.parquet(f"{folder}/documents.parquet")
                     .select("doc_id", "text").collect()))
    out = op6_pii(spark, folder).collect()
    assert sorted(r.doc_id for r in out) == sorted(texts)
    for r in out:
        base = by_pattern(texts[r.doc_id])
        written = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert set(written.split(",")) <= set(r.spans.split(",")) or not written
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(s[2] == k for s in base) for k in pii.KINDS]
