"""Benchmark decontamination by latent semantic retrieval.

Items and all windows of all documents are TF-IDF vectors over the benchmark's words; a randomised SVD
of them, from sums over pairs of words made by Spark in one pass, gives a latent space. Windows of every document are compared with the
items by cosine there; candidates are confirmed by the longest common subsequence of words and, where
that is short of near-verbatim, by the item's answer.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import repeat
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from mailshape.llm.memos import alone
from mailshape.llm.shingles import slices
from mailshape.session import land

WINDOW = 32
STEP = 16
DIMENSIONS = 256
POWER_STEPS = 2
MIN_COSINE = 0.4
_AT_ONCE = 64
# Pairs of words with a place of their own in a task's array of sums (eight bytes each); beyond these only
# the pairs that occur have one. Pairs summed at once, and pairs of a row of the summed table.
_DENSE_PAIRS, _PAIRS_AT_ONCE, _PAIRS_A_ROW = 1 << 23, 1 << 20, 1 << 20
VERBATIM, PARAPHRASE, ANSWER = 0.8, 0.5, 0.8
# Bound: windows of items held at once by a task (about).
ITEMS_AT_ONCE = 20_000
_MEMO = 300_000


def normal_word(raw: bytes) -> str:
    """A word's letters and digits in lower case, without the marks around and within."""
    text = raw.decode("utf-8", "replace").lower()
    return text if text.isalnum() else "".join(c for c in text if c.isalnum())


def normal_words(text: str | None) -> list[str]:
    return [w for w in map(normal_word, (text or "").encode("utf-8", "replace").split()) if w]


def answer_words(text: str) -> list[str]:
    """Words of the last sentence: what follows the last ., ! or ? that more words follow."""
    tail = text.rstrip()
    cut = max(tail[:-1].rfind(mark) for mark in (". ", "! ", "? ", ".\n", "!\n", "?\n"))
    return normal_words(tail[cut + 1:])


def word_places(item: list) -> dict:
    """For each word of an item a number with a bit for each of its places."""
    places: dict = {}
    for i, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << i
    return places


def _subsequence(size: int, hits: list[int]) -> int:
    """Length of the longest common subsequence of an item of ``size`` words and a region, given as
    the places of each of its words in the item; bit-parallel over the places."""
    full = (1 << size) - 1
    rows = full
    for places in hits:
        hit = rows & places
        if hit:
            rows = ((rows + hit) | (rows - hit)) & full
    return size - rows.bit_count()


def common_subsequence(item: list, region: list) -> int:
    """Length of the longest common subsequence."""
    places = word_places(item)
    return _subsequence(len(item), [places[w] for w in region if w in places])


# Of ASCII, letters and digits stay in lower case, white space stays, all else goes.
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_GONE = bytes(c for c in range(128) if not chr(c).isalnum() and c not in b"\t\n\v\f\r ")


class _WordIds(dict):
    """Memo from words in lower case to places in the vocabulary, -1 for words outside, -2 for no word.
    It always holds the vocabulary's ASCII words; of others it learns what each is."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self._vocabulary = vocabulary
        self._plain = {w.encode(): k for w, k in vocabulary.items() if w.isascii()}
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.update(self._plain)

    def _place(self, raw: bytes) -> int:
        word = normal_word(raw)
        return self._vocabulary.get(word, -1) if word else -2

    def __missing__(self, raw: bytes) -> int:
        if raw.isascii():
            return -1
        value = self._place(raw)
        if len(self) >= _MEMO + len(self._plain):
            self.clear()
        if len(raw) < 64:
            self[raw] = value
        return value

    def of(self, text: str | None) -> np.ndarray:
        raw = (text or "").encode("utf-8", "replace")
        if "\u03a3" in (text or ""):
            # The lower case of this letter depends on the marks around it.
            words = raw.split()
            found = map(self._place, words)
        else:
            words = raw.translate(_LOWER, _GONE).split()
            found = map(self.get, words, repeat(-1)) if raw.isascii() else map(
                self.__getitem__, words)
        found = np.fromiter(found, dtype=np.int32, count=len(words))
        return found[found > -2] if len(found) and found.min() == -2 else found


def window_starts(words: int) -> np.ndarray:
    """Starts of windows that cover every word: each ``STEP`` words, the last one at the end."""
    last = max(0, words - WINDOW)
    starts = np.arange(0, last + 1, STEP)
    return np.append(starts, last) if starts[-1] != last else starts


def window_words(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The vocabulary's places in all windows of all texts, with repeats, one window after the other; and
    how many each window holds."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    last = np.maximum(sizes - WINDOW, 0)
    counts = np.where(sizes > 0, -(-last // STEP) + 1, 0)
    text = np.repeat(np.arange(len(texts)), counts)
    starts = (np.cumsum(sizes) - sizes)[text] + np.minimum(_steps(counts) * STEP, last[text])
    at = starts[:, None] + np.arange(WINDOW)
    words = np.concatenate([np.zeros(0, dtype=np.int32), *texts, np.full(WINDOW, -1, dtype=np.int32)])[at]
    held = (words >= 0) & (np.arange(WINDOW) < sizes[text][:, None])
    return words[held], held.sum(axis=1)


@dataclass
class LatentIndex:
    """Items with their latent vectors, and what a document's window needs to be compared."""

    item_ids: list = field(default_factory=list)
    items: list[np.ndarray] = field(default_factory=list)
    answers: list[np.ndarray] = field(default_factory=list)
    vocabulary: dict[str, int] = field(default_factory=dict)
    idf: np.ndarray = field(default_factory=lambda: np.zeros(0))
    basis: np.ndarray = field(default_factory=lambda: np.zeros((0, DIMENSIONS)))
    key: str = field(default_factory=lambda: uuid4().hex)

    def prepare(self) -> "LatentIndex":
        self.by_place = np.append(self.idf[:, None] * self.basis,
                                  np.zeros((1, self.basis.shape[1])), axis=0).astype(np.float32)
        # Items are cut into windows as documents are; `owners` has each window's item.
        cut = [(c, i[s:s + WINDOW]) for c, i in enumerate(self.items) for s in window_starts(len(i))]
        self.owners = np.array([c for c, _ in cut], dtype=np.int64)
        self.vectors = np.array([self.by_place[w].sum(axis=0) for _, w in cut]).reshape(
            len(cut), self.basis.shape[1])
        self.vectors /= np.maximum(np.linalg.norm(self.vectors, axis=1), 1e-12)[:, None]
        self.item_places = [word_places(i.tolist()) for i in self.items]
        self.answer_places = [word_places(a.tolist()) for a in self.answers]
        self._prepare_places()
        return self

    def _prepare_places(self) -> None:
        """For each occurrence of a word, the items (then the answers) that have as many of it."""
        lists = [*self.items, *self.answers]
        self.sizes = np.array([len(i) for i in lists], dtype=np.int64).reshape(2, -1)
        counted = [np.unique(i, return_counts=True) for i in lists]
        self.most = np.zeros(len(self.idf), dtype=np.int64)
        for words, counts in counted:
            self.most[words] = np.maximum(self.most[words], counts)
        self.first_place = np.cumsum(self.most) - self.most
        places = [np.repeat(self.first_place[w], n) + _steps(n) for w, n in counted]
        owners = np.repeat(np.arange(len(lists)), [len(p) for p in places])
        places = np.concatenate([np.zeros(0, dtype=np.int64), *places])
        order = np.argsort(places, kind="stable")
        self.place_owners = owners[order].astype(np.int32)
        ends = np.searchsorted(places[order], np.arange(int(self.most.sum()) + 1))
        self.place_firsts, self.place_counts = ends[:-1], np.diff(ends)

    def reachable(self, ids: np.ndarray) -> list[int]:
        """Items that some region of a document could hold by the rule of :meth:`hits`.

        A region has no more of an item's words, and no longer a subsequence in common, than its
        document. So no item is lost that the rule would find: first by counts of words, then by the
        longest common subsequence of the document and of parts of it that hold every region.
        """
        if not len(self.items):
            return []
        known = ids[ids >= 0]
        words, counts = np.unique(known, return_counts=True)
        counts = np.minimum(counts, self.most[words])
        places = np.repeat(self.first_place[words], counts) + _steps(counts)
        counts = self.place_counts[places]
        owners = self.place_owners[np.repeat(self.place_firsts[places], counts) + _steps(counts)]
        item, answer = np.bincount(owners, minlength=self.sizes.size).reshape(2, -1)
        share = item / self.sizes[0]
        there = (self.sizes[1] > 0) & (answer >= ANSWER * self.sizes[1])
        found, listed = [], None
        for c in np.flatnonzero((share >= VERBATIM) | (share >= PARAPHRASE) & there).tolist():
            listed = known.tolist() if listed is None else listed
            # No region is longer than this; parts of twice its length, each a length on, hold any.
            most = 4 * len(self.items[c]) + WINDOW
            if self._agreement(c, listed)[0] and (len(ids) <= 2 * most or any(
                    self._agreement(c, ids[s:s + 2 * most].tolist())[0]
                    for s in range(0, len(ids) - most, most))):
                found.append(c)
        return found

    def _agreement(self, c: int, region: list) -> tuple[bool, float, bool]:
        """Whether words are sure to hold item ``c``; the share in common, and whether the answer is."""
        size, asked = len(self.items[c]), len(self.answers[c])
        # Only words of the item can align; fewer than PARAPHRASE asks for cannot reach it.
        hits = [p for p in map(self.item_places[c].get, region) if p]
        share = _subsequence(size, hits) / size if len(hits) >= PARAPHRASE * size else 0.0
        if share < PARAPHRASE:
            return False, share, False
        there = bool(asked) and _subsequence(asked, [
            p for p in map(self.answer_places[c].get, region) if p]) >= ANSWER * asked
        return share >= VERBATIM or there, share, there

    def weights(self, ids: np.ndarray) -> list[tuple[int, float]]:
        """TF-IDF of word places."""
        return [(i, n * float(self.idf[i])) for i, n in sorted(Counter(
            ids[ids >= 0].tolist()).items())]

    def candidates(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Items, starts and cosines of the windows near one of the item's own in the latent space; every
        window is compared with every item's.

        Windows begin at each ``STEP`` words; the last ones may reach past the end.
        """
        steps = max(1, -(-len(ids) // STEP))
        padded = np.full((steps + 1) * STEP, -1, dtype=ids.dtype)
        padded[:len(ids)] = ids
        padded = padded.reshape(-1, STEP)
        near = []
        for first in range(0, max(1, steps - 1), _AT_ONCE):
            part = padded[first:min(first + _AT_ONCE, max(1, steps - 1)) + 1]
            sums = self._sums(part)
            latent = sums[:-1] + sums[1:]
            latent /= np.maximum(np.linalg.norm(latent, axis=1), 1e-12)[:, None]
            cosines = latent @ self.vectors.T
            at = np.flatnonzero(cosines >= MIN_COSINE)
            if len(at):
                rows, columns = np.divmod(at, len(self.owners))
                near.append((self.owners[columns], (first + rows) * STEP, cosines.ravel()[at]))
        if not near:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
        return tuple(np.concatenate(c) for c in zip(*near))

    def _sums(self, steps: np.ndarray) -> np.ndarray:
        """Sums of the latent vectors of each row of places; words outside the vocabulary add nothing."""
        return self.by_place[steps].sum(axis=1)

    def hits(self, ids: np.ndarray) -> list[tuple[int, float, float, bool]]:
        """``(item, cosine, share of the item in common, answer found)`` of the items in a document.

        Of the candidates, those out of reach of every region are not aligned region by region.
        """
        found = []
        items, starts, cosines = self.candidates(ids)
        for c in self.reachable(ids) if len(items) else []:
            own = items == c
            near = list(zip(starts[own].tolist(), cosines[own].tolist()))
            item = self.items[c]
            best = (False, 0.0, 0.0, False)
            # Regions around the candidate windows, an item's length to either side; joined if they
            # meet, but never longer than a few items.
            regions: list[list[int]] = []
            for start, _ in near:
                low, high = max(0, start - len(item)), start + WINDOW + len(item)
                if regions and low <= regions[-1][1] and high - regions[-1][0] <= 4 * len(item) + WINDOW:
                    regions[-1][1] = high
                else:
                    regions.append([low, high])
            for low, high in regions:
                sure, share, there = self._agreement(c, ids[low:high].tolist())
                if share >= PARAPHRASE and (sure, share) > best[:2]:
                    best = (sure, share, max(v for _, v in near), there)
            if best[0]:
                found.append((c, best[2], best[1], best[3]))
        return found


def _steps(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each count, one run after the other."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)


def _lists(column: pa.ListArray) -> Iterator[np.ndarray]:
    """The lists of a column as parts of one array; none is null."""
    ends = column.offsets.to_numpy()
    ends = (ends - ends[0]).tolist()
    every = column.flatten().to_numpy(zero_copy_only=False)
    return (every[a:b] for a, b in zip(ends, ends[1:]))


_ids_memo: list = [None, None]


def _reader(index: LatentIndex) -> _WordIds:
    """The memo of a Python worker's last index."""
    if _ids_memo[0] != index.key:
        _ids_memo[:] = [index.key, _WordIds(index.vocabulary)]
    return alone(_ids_memo[1])


def _places(docs: DataFrame, id_col: str, text_col: str, vocabulary: dict[str, int]) -> DataFrame:
    """``(id, ids)`` per row: places of its words in the vocabulary, -1 for words outside; landed, since
    the counts, the windows and the search start from them."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = alone(_WordIds(vocabulary))
        for batch in slices(batches):
            found = [reader.of(t) for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            words = np.concatenate([np.zeros(0, dtype=np.int32), *found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(words))],
                ["id", "ids"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return land(docs.select(id_col, text_col).mapInArrow(place, f"id {id_type}, ids array<int>"),
                "places")


def _document_counts(placed: DataFrame, width: int) -> tuple[int, np.ndarray]:
    """Documents in all, and those that hold each of the ``width`` words, over all rows."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows = np.zeros(width + 1, dtype=np.int64), 0
        for batch in batches:
            for ids in _lists(batch.column(0)):
                found = np.unique(ids)
                counts[found[found >= 0]] += 1
                rows += 1
        counts[-1] = rows
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], ["w", "n"])

    total = placed.select("ids").mapInArrow(count, "w bigint, n bigint").groupBy("w").agg(
        F.sum("n").alias("n")).toPandas()
    counts = np.zeros(width + 1, dtype=np.int64)
    counts[total["w"].to_numpy()] = total["n"].to_numpy()
    return int(counts[-1]), counts[:-1]


def _first_pairs(width: int) -> np.ndarray:
    """For each word, what the number of a pair is besides its second word, which is no smaller; all
    pairs of ``width`` words are numbered without gaps, by their first word, then by the second."""
    word = np.arange(width + 1)
    return word * width - word * (word + 1) // 2


class _PairSums:
    """Sums by pair of words: an array of all pairs, or where these are too many of those that occur."""

    def __init__(self, width: int):
        self.first = _first_pairs(width)
        pairs = width * (width + 1) // 2
        self.dense = np.zeros(pairs) if pairs <= _DENSE_PAIRS else None
        self.at, self.sums = np.zeros(0, dtype=np.int64), np.zeros(0)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, places: np.ndarray, weights: np.ndarray) -> None:
        """Adds the products of the weights of each row's pairs of places; rows of one length."""
        order = np.argsort(places, axis=1)
        places = np.take_along_axis(places, order, axis=1)
        weights = np.take_along_axis(weights, order, axis=1)
        one, two = np.triu_indices(places.shape[1])
        rows = max(1, _PAIRS_AT_ONCE // max(1, len(one)))
        for f in range(0, len(places), rows):
            word, weight = places[f:f + rows], weights[f:f + rows]
            at = (self.first[word][:, one] + word[:, two]).ravel()
            # Of a word that comes twice in a row, both orders of the pair fall on the same number.
            both = np.where((one != two) & (word[:, one] == word[:, two]), 2.0, 1.0)
            products = (weight[:, one] * weight[:, two] * both).ravel()
            if self.dense is not None:
                np.add.at(self.dense, at, products)
                continue
            self.waiting.append((at, products))
            self.held += len(at)
            if self.held > max(4 * _PAIRS_AT_ONCE, len(self.at)):
                self._merge()

    def _merge(self) -> None:
        at, self.sums = _summed(*zip((self.at, self.sums), *self.waiting))
        self.at, self.waiting, self.held = at, [], 0

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pairs, ascending, and their sums."""
        if self.dense is None:
            self._merge()
            return self.at, self.sums
        at = np.flatnonzero(self.dense)
        return at, self.dense[at]


def _summed(at: Sequence[np.ndarray], sums: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers, ascending and each once, with the sums of their parts."""
    found, where = np.unique(np.concatenate(at), return_inverse=True)
    return found, np.bincount(where, weights=np.concatenate(sums), minlength=len(found))


def _gram(passages: DataFrame, width: int) -> DataFrame:
    """``A' A`` of the sparse rows of ``passages`` (``places``, ``weights``), landed: ``(first, at, sums)``
    for each block of words from ``first`` on, with the pairs as :func:`_first_pairs` numbers them.

    The rows are read once. A core holds one table of sums, so what is shuffled does not grow with the
    number of splits.
    """
    block = max(1, _PAIRS_A_ROW // width)
    first = _first_pairs(width)
    schema = "first bigint, at array<bigint>, sums array<double>"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = _PairSums(width)
        for batch in batches:
            ends = batch.column(0).offsets.to_numpy().astype(np.int64)
            places, weights = (c.flatten().to_numpy(zero_copy_only=False).astype(t) for c, t in zip(
                batch.columns, (np.int64, np.float64)))
            starts, sizes = ends[:-1] - ends[0], np.diff(ends)
            for size in np.unique(sizes[sizes > 0]).tolist():
                at = starts[sizes == size][:, None] + np.arange(size)
                pairs.add(places[at], weights[at])
        at, sums = pairs.result()
        firsts = np.arange(0, width, block)
        cuts = np.searchsorted(at, first[firsts] + firsts).tolist() + [len(at)]
        for f, a, b in zip(firsts.tolist(), cuts, cuts[1:]):
            if a < b:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f]), pa.ListArray.from_arrays([0, b - a], pa.array(at[a:b])),
                     pa.ListArray.from_arrays([0, b - a], pa.array(sums[a:b]))],
                    ["first", "at", "sums"])

    def add(table: pa.Table) -> pa.Table:
        at, sums = _summed(*([p.values.to_numpy() for p in table.column(c)] for c in ("at", "sums")))
        return pa.table({"first": table.column("first")[:1],
                         "at": pa.array([at], pa.list_(pa.int64())),
                         "sums": pa.array([sums], pa.list_(pa.float64()))})

    cores = passages.sparkSession.sparkContext.defaultParallelism
    return land(passages.select("places", "weights").coalesce(max(1, cores)).mapInArrow(
        count, schema).groupBy("first").applyInArrow(add, schema), "pairs")


def _gram_product(gram: DataFrame, width: int, right: np.ndarray) -> np.ndarray:
    """``A' A right`` from :func:`_gram`, by Spark.

    Each task sums its rows' parts in blocks of vocabulary rows; blocks are summed by key.
    """
    block = 256
    rows_held = max(1, _PAIRS_A_ROW // width)
    number = _first_pairs(width)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, right.shape[1]))
        for batch in batches:
            for low, at, sums in zip(batch.column(0).to_pylist(), _lists(batch.column(1)),
                                     _lists(batch.column(2))):
                words = np.arange(low, min(low + rows_held, width))
                one = words[np.searchsorted(number[words] + words, at, side="right") - 1]
                two = at - number[one]
                part = np.zeros((len(words), width - low))
                part[one - low, two - low] = sums
                total[words] += part @ right[low:]
                part[words - low, words - low] = 0.0
                total[low:] += part.T @ right[words]
        firsts = range(0, width, block)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(firsts)), pa.array([total[f:f + block].ravel() for f in firsts],
                                              pa.list_(pa.float64()))], ["first", "part"])

    def add(table: pa.Table) -> pa.Table:
        parts = [np.asarray(p.values) for p in table.column("part")]
        return pa.table({"first": table.column("first")[:1],
                         "part": pa.array([np.sum(parts, axis=0)], pa.list_(pa.float64()))})

    schema = "first bigint, part array<double>"
    rows = gram.mapInArrow(multiply, schema).groupBy("first").applyInArrow(add, schema).collect()
    total = np.zeros((width, right.shape[1]))
    for r in rows:
        part = np.array(r["part"]).reshape(-1, right.shape[1])
        total[r["first"]:r["first"] + len(part)] = part
    return total


def latent_basis(passages: DataFrame, width: int, dimensions: int = DIMENSIONS,
                 steps: int = POWER_STEPS) -> np.ndarray:
    """The leading right singular vectors of all rows by the randomised method with power steps."""
    size = min(width, dimensions + 8)
    gram = _gram(passages, width)
    basis = np.linalg.qr(np.random.default_rng(0).normal(size=(width, size)))[0]
    for _ in range(steps):
        basis = np.linalg.qr(_gram_product(gram, width, basis))[0]
    small = basis.T @ _gram_product(gram, width, basis)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    return (basis @ vectors[:, np.argsort(-values)])[:, :dimensions]


def build_index(items: list[tuple], docs: DataFrame, id_col: str = "doc_id",
                text_col: str = "text") -> LatentIndex:
    """Index of ``(item_id, text)``: weights from all documents, the latent space from all items and
    all windows of all documents that hold a word of theirs. Items without words are left out."""
    return _indexed(items, docs, id_col, text_col)[0]


def _indexed(items: list[tuple], docs: DataFrame, id_col: str,
             text_col: str) -> tuple[LatentIndex, DataFrame | None]:
    """:func:`build_index`, and the documents' words as :func:`_places` in its vocabulary."""
    words = [(i, normal_words(t), answer_words(t or "")) for i, t in items]
    words = [w for w in words if w[1]]
    vocabulary = {w: k for k, w in enumerate(sorted({x for _, ws, _ in words for x in ws}))}
    if not vocabulary:
        return LatentIndex().prepare(), None
    placed = _places(docs, id_col, text_col, vocabulary)
    total, counts = _document_counts(placed, len(vocabulary))
    index = LatentIndex(
        [i for i, _, _ in words], [np.array([vocabulary[w] for w in ws]) for _, ws, _ in words],
        [np.array([vocabulary[w] for w in ws], dtype=np.int64) for _, _, ws in words], vocabulary,
        np.log((total + 1) / (counts + 1)) + 1e-3)
    idf = index.idf

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, counts = window_words(list(_lists(batch.column(0))))
            ends = pa.array(np.cumsum([0, *counts[counts > 0]]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(ends, pa.array(words)),
                 pa.ListArray.from_arrays(ends, pa.array(idf[words]))], ["places", "weights"])

    schema = "places array<int>, weights array<double>"
    own = [index.weights(i) for i in index.items]
    passages = land(placed.select("ids").mapInArrow(cut, schema).unionAll(
        docs.sparkSession.createDataFrame(
            [([i for i, _ in r], [float(w) for _, w in r]) for r in own], schema)), "passages")
    index.basis = latent_basis(passages, len(vocabulary))
    return index.prepare(), placed


def _item_parts(benchmark: DataFrame, item_col: str, item_text_col: str,
                most: int) -> Iterator[list[tuple]]:
    """Items in parts of about ``most`` windows each."""
    usable = benchmark.select(F.col(item_col).alias("i"), F.col(item_text_col).alias("t")).filter(
        "t is not null").distinct()
    windows = F.greatest(F.lit(1), F.ceil((F.size(F.split("t", r"\s+")) - WINDOW) / STEP) + 1)
    parts = max(1, -(-int(usable.agg(F.sum(windows)).first()[0] or 0) // most))
    for part in range(parts):
        yield [tuple(r) for r in usable.filter(
            F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == part).orderBy("i", "t").collect()]


def index_parts(benchmark: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                item_col: str = "item_id", item_text_col: str = "text",
                most: int = ITEMS_AT_ONCE) -> list[LatentIndex]:
    """Indexes of about ``most`` windows of items each; together they hold every item with words. A task
    holds one at a time."""
    return [build_index(items, docs, id_col, text_col)
            for items in _item_parts(benchmark, item_col, item_text_col, most)]


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text",
               most: int = ITEMS_AT_ONCE) -> DataFrame:
    """``(id, item, cosine, common, answer_found)``: one row per document row and item it holds.

    ``common`` is the share of the item's words in the longest common subsequence. Documents or items
    that are null, empty or without letters and digits have no rows; empty tables give none; repeated
    rows repeat theirs; other columns are not read. Whole texts are searched.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    item_type = benchmark.schema[item_col].dataType
    arrow_item = to_arrow_type(item_type)
    schema = (f"`{id_col}` {id_type}, `{item_col}` {item_type.simpleString()}, cosine double, "
              "common double, answer_found boolean")

    def search(index: LatentIndex, placed: DataFrame):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, found = [], []
                for row, words in enumerate(_lists(batch.column(1))):
                    for hit in index.hits(words):
                        rows.append(row)
                        found.append(hit)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())),
                     pa.array([index.item_ids[h[0]] for h in found], arrow_item),
                     pa.array([h[1] for h in found], pa.float64()),
                     pa.array([h[2] for h in found], pa.float64()),
                     pa.array([h[3] for h in found], pa.bool_())],
                    [id_col, item_col, "cosine", "common", "answer_found"])

        return placed.select("id", "ids").mapInArrow(run, schema)

    found = docs.sparkSession.createDataFrame([], schema)
    for items in _item_parts(benchmark, item_col, item_text_col, most):
        index, placed = _indexed(items, docs, id_col, text_col)
        if placed is not None:
            found = found.unionAll(search(index, placed))
    return found


def holds_item(indexes: list[LatentIndex], text: Column) -> Column:
    """Whether a text holds an item of any of the indexes; false for null."""
    @F.pandas_udf("boolean")
    def held(texts: pd.Series) -> pd.Series:
        out = np.zeros(len(texts), dtype=bool)
        for index in indexes:
            reader = _reader(index)
            out |= np.array([bool(index.hits(reader.of(t))) for t in texts], dtype=bool)
        return pd.Series(out)

    return held(text)
