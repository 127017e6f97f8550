"""A semi-Markov conditional random field over the segments of a short region of text.

A segmentation covers the region's tokens with entities of a kind, of at most ``MAX_TOKENS`` tokens
or a whole address, and single outside tokens. Its score sums weights of features of whole segments and of neighbouring
kinds. Training maximises the likelihood of given segmentations; decoding takes the best one.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from uuid import uuid4

import numpy as np

MAX_TOKENS = 18
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\s+|.", re.DOTALL)
_AT = re.compile(r"\s?[\[(](?:at|AT)[\])]\s?|@")
_DOT = re.compile(r"\s?[\[(](?:dot|DOT)[\])]\s?|\.")
_PARTS = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
_NUMBER = re.compile(r"[0-9](?:[ -]?[0-9])+")
_NAME = re.compile(r"[A-Za-z0-9._%+-]+")
_LABEL = re.compile(r"[A-Za-z0-9-]+")
_HOST = re.compile(rf"{_LABEL.pattern}(?:(?:{_DOT.pattern}){_LABEL.pattern})+")
# A spelt-out sign right after a candidate or right before it: it is but a part of an address.
_GOES_ON = re.compile(r"\s?[\[(](?:at|AT|dot|DOT)[\])]")
_BEGUN = re.compile(r"[\[(](?:at|AT|dot|DOT)[\])]\s?\Z")
_MORE_HOST = re.compile(rf"(?:{_DOT.pattern}){_LABEL.pattern}")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _piece(token: str) -> str:
    if token[0].isdigit():
        return "d%d" % min(len(token), 5)
    if token[0].isalpha():
        return "w"
    return "_" if token.isspace() else token


def _side(char: str) -> str:
    if not char:
        return "none"
    return "space" if char.isspace() else _piece(char)[0] if char.isalnum() else char


def span_features(text: str, start: int, end: int, pieces: Sequence[str], before: str) -> list[str]:
    """Features of ``text[start:end]`` as one candidate, its tokens' shapes and the word before."""
    span = text[start:end]
    digits = "".join(c for c in span if "0" <= c <= "9")
    found = ["shape " + "".join(pieces), "digits %d" % min(len(digits), 20),
             "made " + "".join(sorted({p[0] for p in pieces})), "from " + _side(text[start - 1:start]),
             "to " + _side(text[end:end + 1]), "after " + before, "any"]
    if _NUMBER.fullmatch(span) and 12 <= len(digits) <= 19:
        found.append("luhn" if luhn(digits) else "not luhn")
    if _PARTS.fullmatch(span):
        found.append("parts" if all(int(p) <= 255 for p in span.split(".")) else "not parts")
    if _GOES_ON.match(text, end) or _BEGUN.search(text[max(0, start - 7):start]):
        found.append("cut")
    halves = _AT.split(span)
    if len(halves) == 2 and _NAME.fullmatch(halves[0]):
        labels = _DOT.split(halves[1])
        if len(labels) > 1 and all(_LABEL.fullmatch(x) for x in labels) \
                and not _MORE_HOST.match(text, end):
            found.append("address")
    return found


class Region:
    """Tokens of a region and its candidate segments ``(first, last + 1, features)``."""

    def __init__(self, text: str):
        self.text = text
        spans = [m.span() for m in _TOKEN.finditer(text)]
        self.starts = [s for s, _ in spans]
        self.ends = [e for _, e in spans]
        pieces = [_piece(text[s:e]) for s, e in spans]
        anchors = [p[0] == "d" or p == "@" or text[s:e].lower() == "at"
                   for p, (s, e) in zip(pieces, spans)]
        self.outside = [["out " + p] if a else [] for p, a in zip(pieces, anchors)]
        self.segments: list[tuple[int, int, list[str]]] = []
        word, words = "", []
        for i, piece in enumerate(pieces):
            words.append(word)
            if piece[0] in "dw+(":
                seen = False
                for j in range(i, min(i + MAX_TOKENS, len(pieces))):
                    seen = seen or anchors[j]
                    if seen and pieces[j][0] in "dw":
                        self.segments.append((i, j + 1, span_features(
                            text, self.starts[i], self.ends[j], pieces[i:j + 1], word)))
            if piece == "w":
                word = text[self.starts[i]:self.ends[i]].lower()[:12]
        # Whole addresses are candidates however many tokens they have.
        first_at = {s: i for i, s in enumerate(self.starts)}
        last_at = {e: i for i, e in enumerate(self.ends)}
        done = 0
        for m in _AT.finditer(text):
            start, host = m.start(), _HOST.match(text, m.end())
            while start > done and _NAME.match(text[start - 1]):
                start -= 1
            done = m.end()
            i, j = first_at.get(start), last_at.get(host.end()) if host else None
            if i is not None and j is not None and j - i >= MAX_TOKENS \
                    and pieces[i][0] in "dw" and pieces[j][0] in "dw":
                self.segments.append((i, j + 1, span_features(
                    text, start, host.end(), pieces[i:j + 1], words[i])))


class SemiCRF:
    """Weights per feature: one number for outside and one for each kind."""

    def __init__(self, kinds: Sequence[str]):
        self.key = uuid4().hex
        self.kinds = list(kinds)
        self.width = len(kinds) + 1
        self.weights: dict[str, np.ndarray] = {}
        self.turns = np.zeros((self.width, self.width))

    def _score(self, features: list[str]) -> np.ndarray:
        total = np.zeros(self.width)
        for f in features:
            w = self.weights.get(f)
            if w is not None:
                total += w
        return total

    def _lattice(self, region: Region):
        """By end: ``(first, kinds scores)``; outside tokens have kind 0, segments the others."""
        by_end: list[list[tuple[int, np.ndarray, list[str]]]] = [[] for _ in range(
            len(region.starts) + 1)]
        for i, features in enumerate(region.outside):
            score = np.full(self.width, -np.inf)
            score[0] = self._score(features)[0]
            by_end[i + 1].append((i, score, features))
        for first, last, features in region.segments:
            score = self._score(features)
            score[0] = -np.inf
            by_end[last].append((first, score, features))
        return by_end

    def decode(self, region: Region) -> list[tuple[int, int, str]]:
        """Best segmentation's entities as ``(start, end, kind)`` offsets in the region's text."""
        by_end = self._lattice(region)
        n = len(by_end) - 1
        best = np.full((n + 1, self.width), -np.inf)
        best[0, 0] = 0.0
        back: list[list] = [[None] * self.width for _ in range(n + 1)]
        for end in range(1, n + 1):
            for first, score, _ in by_end[end]:
                ways = best[first][:, None] + self.turns
                previous = ways.argmax(axis=0)
                total = ways[previous, range(self.width)] + score
                for k in np.flatnonzero(total > best[end]):
                    best[end, k] = total[k]
                    back[end][k] = (first, int(previous[k]))
        found, end, kind = [], n, int(best[n].argmax()) if n else 0
        while end:
            first, previous = back[end][kind]
            if kind:
                found.append((region.starts[first], region.ends[end - 1], self.kinds[kind - 1]))
            end, kind = first, previous
        return found[::-1]

    def gradient(self, region: Region, gold: list[tuple[int, int, str]]):
        """Log-likelihood of a segmentation and its gradient ``({feature: array}, turns)``.

        None if a gold entity is no candidate of the region.
        """
        by_end = self._lattice(region)
        n = len(by_end) - 1
        places = {(region.starts[f], region.ends[e - 1]): (f, e) for e in range(1, n + 1)
                  for f, s, _ in by_end[e] if np.isfinite(s[1])}
        entity = {}
        for start, end, kind in gold:
            if (start, end) not in places:
                return None
            first, last = places[start, end]
            entity[last] = (first, self.kinds.index(kind) + 1)
        forward = np.full((n + 1, self.width), -np.inf)
        forward[0, 0] = 0.0
        with np.errstate(divide="ignore", invalid="ignore"):
            for end in range(1, n + 1):
                ways = [_log_sum_safe(forward[first][:, None] + self.turns) + score
                        for first, score, _ in by_end[end]]
                forward[end] = _log_sum_safe(np.array(ways))
            backward = np.full((n + 1, self.width), -np.inf)
            backward[n] = 0.0
            following: list[list] = [[] for _ in range(n + 1)]
            for end in range(1, n + 1):
                for first, score, features in by_end[end]:
                    following[first].append((end, score, features))
            for at in range(n - 1, -1, -1):
                ways = [_log_sum_safe((self.turns + (score + backward[end])[None, :]).T)
                        for end, score, _ in following[at]]
                backward[at] = _log_sum_safe(np.array(ways))
        norm = float(_log_sum_safe(forward[n]))
        grad: dict[str, np.ndarray] = {}
        turns = np.zeros_like(self.turns)

        def add(features, amount):
            for f in features:
                if f in grad:
                    grad[f] = grad[f] + amount
                else:
                    grad[f] = amount.copy()

        for end in range(1, n + 1):
            for first, score, features in by_end[end]:
                joint = np.exp(forward[first][:, None] + self.turns + (
                    score + backward[end] - norm)[None, :])
                turns -= joint
                add(features, -joint.sum(axis=0))
        # The gold path from the end backwards.
        value, end, path = 0.0, n, []
        while end:
            first, kind = entity.get(end, (end - 1, 0))
            path.append((first, end, kind))
            end = first
        previous = 0
        for first, end, kind in reversed(path):
            score, features = next((s, f) for g, s, f in by_end[end]
                                   if g == first and np.isfinite(s[kind]))
            value += score[kind] + self.turns[previous, kind]
            turns[previous, kind] += 1
            unit = np.zeros(self.width)
            unit[kind] = 1.0
            add(features, unit)
            previous = kind
        return value - norm, grad, turns

    def fit(self, examples: list[tuple[str, list[tuple[int, int, str]]]], epochs: int = 4,
            rate: float = 0.3, penalty: float = 1e-3) -> "SemiCRF":
        """AdaGrad over ``(text, entities)`` in the given order; unusable examples are passed over."""
        regions = [(Region(text), gold) for text, gold in examples]
        seen: dict[str, np.ndarray] = {}
        turn_seen = np.full_like(self.turns, 1e-6)
        for _ in range(epochs):
            for region, gold in regions:
                made = self.gradient(region, gold)
                if made is None:
                    continue
                _, grad, turns = made
                for f, g in grad.items():
                    w = self.weights.setdefault(f, np.zeros(self.width))
                    g = g - penalty * w
                    s = seen.setdefault(f, np.full(self.width, 1e-6))
                    s += g * g
                    w += rate * g / np.sqrt(s)
                turns = turns - penalty * self.turns
                turn_seen += turns ** 2
                self.turns += rate * turns / np.sqrt(turn_seen)
        return self


def _log_sum_safe(values: np.ndarray) -> np.ndarray:
    """Log of the sum of exponentials over the first axis; all minus infinity stays so."""
    if not len(values):
        return np.array(-math.inf)
    top = values.max(axis=0)
    shift = np.where(np.isfinite(top), top, 0.0)
    return np.where(np.isfinite(top), shift + np.log(np.exp(values - shift).sum(axis=0)), -math.inf)
