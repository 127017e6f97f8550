"""Personal data by fixed patterns and a semi-Markov conditional random field.

The patterns give the base spans, which always stay. The random field is trained on regions of a
bounded sample with their base spans, on rewritten forms of them that the patterns miss, and on
spoilt ones; what it finds beside the base spans is added.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mailshape.llm.semicrf import Region, SemiCRF, luhn
from mailshape.session import land

# Fixed kinds, in the order that breaks ties.
KINDS = ("email", "ip", "card", "phone")
_ORDER = {kind: i for i, kind in enumerate(KINDS)}

# Bounds of the training sample: about so many rows, then so many distinct regions of each sort.
SAMPLE_ROWS = 4000
SAMPLE_REGIONS = 60

_DIGIT = re.compile(r"[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Fixed patterns. A digit before the first part is ruled out since a try from there fails as well.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

_ANCHOR = re.compile(r"[0-9@]+|[\[(](?:at|AT|dot|DOT)[\])]")
_LEFT = re.compile(r"(?:\S+\s)?\S*\Z")
_RIGHT = re.compile(r"\S*(?:\s\S+)?")
_REACH = 48
# An address goes on around these without a limit of characters.
_ADDRESS = re.compile(r"@|[\[(](?:at|AT|dot|DOT)[\])]")
_HOST = re.compile(r"\s?[A-Za-z0-9.-]*")

Span = tuple[int, int, str]


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches around each @, in time linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            done = match.end()
            yield start, done, "email"
        else:
            done = max(done, at + 1)
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """``(start, end, kind)`` of the fixed patterns in code points, by start, then kind."""
    found = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = (p.lstrip("0") for p in m.group().split("."))
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                found.append((*m.span(), "ip"))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = _NOT_DIGIT.sub("", m.group())
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append((*m.span(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                    found.append((*m.span(), "phone"))
    return sorted(found, key=lambda s: (s[0], _ORDER[s[2]]))


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches around digits, at signs and spelt-out ones and dots, with a word on either side; they do not overlap."""
    found: list[tuple[int, int]] = []
    for m in _ANCHOR.finditer(text):
        address = _ADDRESS.search(m.group())
        if found and not address and m.end() <= found[-1][1] and m.end() + 12 < found[-1][1]:
            continue
        start = m.start() - len(_LEFT.search(text[max(0, m.start() - _REACH):m.start()]).group())
        end = m.end() + _RIGHT.match(text[m.end():m.end() + _REACH]).end()
        if address:
            name, floor = m.start(), found[-1][1] if found else 0
            if name > floor and text[name - 1].isspace():
                name -= 1
            while name > floor and text[name - 1] in _LOCAL:
                name -= 1
            start, end = min(start, name), max(end, _HOST.match(text, m.end()).end())
        if found and start <= found[-1][1]:
            found[-1] = (found[-1][0], max(end, found[-1][1]))
        else:
            found.append((start, end))
    return found


def rewritten(text: str, gold: list[Span], seed: int) -> list[tuple[str, list[Span]]]:
    """Other forms of a region with one entity, and spoilt forms without any."""
    if len(gold) != 1:
        return []
    rng = random.Random(seed)
    start, end, kind = gold[0]
    span = text[start:end]

    def put(new: str, stays: bool):
        whole = text[:start] + new + text[end:]
        return whole, [(start, start + len(new), kind)] if stays else []

    if kind == "email":
        name, _, host = span.partition("@")
        # Names and hosts with and without digits, hosts of two labels and more.
        plain = "".join(c for c in name if not "0" <= c <= "9").strip("._%+-") or name
        letters = "".join(c for c in host if not "0" <= c <= "9")
        hosts = [host, letters if _DOMAIN.fullmatch(letters) else host, ".".join(host.split(".")[-2:])]
        forms = [put(rng.choice([name, plain]) + at + rng.choice(hosts).replace(
            ".", dot), True) for at in (" (at) ", "(at)", " [at] ", "[at]")
            for dot in (" (dot) ", ".", "[dot]")]
        return [*forms, put(name + "@" + host.split(".")[0], False)]
    digits = _NOT_DIGIT.sub("", span)
    if kind == "phone":
        local = digits[-10:]
        if len(local) < 10:
            return []
        form = rng.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}"])
        return [put(form.format(local[:3], local[3:6], local[6:]), True),
                put(local[:rng.randrange(3, 6)], False), put("%s-%s" % (local[:4], local[4:6]), False)]
    if kind == "card":
        wrong = digits[:-1] + str((int(digits[-1]) + rng.randrange(1, 10)) % 10)
        return [put(" ".join(digits[i:i + 4] for i in range(0, len(digits), 4)), True),
                put(wrong, False)]
    parts = span.split(".")
    return [put(".".join(parts[:3]), False), put(".".join([str(256 + rng.randrange(700)), *parts[1:]]),
                                                 False)]


def _training_regions(docs: DataFrame, id_col: str, text_col: str, rows: int) -> DataFrame:
    """``(region, spans, found)`` of a sample of about ``rows`` rows by a hash of the id."""
    share = int((1 << 31) * min(1.0, rows / max(1, docs.count())))
    sample = docs.filter(F.pmod(F.xxhash64(id_col), F.lit(1 << 31)) < share).select(
        F.col(text_col).alias("t"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = [], []
            for text in batch.column(0).to_pylist():
                base = base_spans(text or "")
                for start, end in regions(text or ""):
                    if end - start <= 160:
                        inner = [s for s in base if start <= s[0] and s[1] <= end]
                        texts.append(text[start:end])
                        spans.append(",".join(f"{k}:{a - start}:{b - start}" for a, b, k in inner))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()),
                                              pa.array(spans, pa.string())], ["region", "spans"])

    return sample.mapInArrow(cut, "region string, spans string").distinct()


def _parsed(spans: str) -> list[Span]:
    parts = (s.split(":") for s in spans.split(",") if s)
    return [(int(a), int(b), k) for k, a, b in parts]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS,
        most: int = SAMPLE_REGIONS) -> SemiCRF:
    """Train on the sample's regions: ``most`` with an entity of each kind and as many without.

    Regions whose base spans overlap are left out. Without any region the model finds nothing.
    """
    sample = land(_training_regions(docs, id_col, text_col, rows), "pii-regions")
    picked: list[tuple[str, list[Span]]] = []
    for only in [F.col("spans").startswith(kind + ":") for kind in KINDS] + [F.col("spans") == ""]:
        picked += [(r["region"], _parsed(r["spans"])) for r in sample.filter(only).orderBy(
            F.xxhash64("region"), "region").limit(most).collect()]
    examples = []
    for number, (text, gold) in enumerate(picked):
        if all(a[1] <= b[0] for a, b in zip(gold, gold[1:])):
            examples.append((text, gold))
            examples += rewritten(text, gold, number)
    random.Random(0).shuffle(examples)
    return SemiCRF(KINDS).fit(examples)


_memo: dict[str, list[Span]] = {}
_memo_of: list[str] = []


@dataclass
class Finder:
    """Base spans and added ones of whole texts."""

    model: SemiCRF

    def added(self, text: str, base: list[Span]) -> list[Span]:
        if not self.model.weights:
            return []
        if _memo_of != [self.model.key] or len(_memo) > 50_000:
            _memo.clear()
            _memo_of[:] = [self.model.key]
        found = []
        for start, end in regions(text):
            part = text[start:end]
            spans = _memo.get(part)
            if spans is None:
                spans = self.model.decode(Region(part))
                if len(part) <= 200:
                    _memo[part] = spans
            found += [(start + a, start + b, k) for a, b, k in spans]
        return [s for s in found if not any(s[0] < b and a < s[1] for a, b, _ in base)]

    def spans(self, text: str | None) -> tuple[list[Span], list[Span]]:
        """Base spans and all spans, both by start, then kind."""
        if not text:
            return [], []
        base = base_spans(text)
        every = sorted(base + self.added(text, base), key=lambda s: (s[0], _ORDER[s[2]]))
        return base, every


def _written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_spans(model: SemiCRF, text: Column) -> Column:
    """Struct ``(base string, spans string)``: ``kind:start:end`` lists, comma-joined, in code points
    with exclusive ends. Null and empty texts have none."""
    finder = Finder(model)

    @F.pandas_udf("base string, spans string")
    def find(texts: pd.Series) -> pd.DataFrame:
        made = [finder.spans(t) for t in texts]
        return pd.DataFrame({"base": [_written(b) for b, _ in made],
                             "spans": [_written(s) for _, s in made]})

    return find(text)


def span_array(spans: Column) -> Column:
    """A written list as ``array<struct<kind, start, end>>``."""
    return F.transform(F.filter(F.split(spans, ","), lambda s: s != ""), lambda s: F.struct(
        F.split_part(s, F.lit(":"), F.lit(1)).alias("kind"),
        F.split_part(s, F.lit(":"), F.lit(2)).cast("bigint").alias("start"),
        F.split_part(s, F.lit(":"), F.lit(3)).cast("bigint").alias("end")))


def redacted(text: str, spans: list[Span]) -> str:
    """``text`` with each stretch of overlapping spans replaced by its first kind in brackets."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(model: SemiCRF, text: Column) -> Column:
    """The text without its spans; null stays null."""
    finder = Finder(model)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([t if t is None else redacted(t, finder.spans(t)[1]) for t in texts],
                         dtype=object)

    return clean(text)
