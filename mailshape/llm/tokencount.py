"""Token counts of texts as a table of exact counts at every word prefix.

A tokenizer's pre-tokenizer cuts a text into words that it never merges across, so the exact token
count of every prefix that ends at a word end follows by a prefix recurrence:
``P[0] = 0, P[j] = P[j-1] + tokens(word j)``. One encoding of the whole text gives ``P``; truncation
to a budget (the longest prefix with ``P[j] <= budget``) and budget checks are then array lookups in
Spark, with no second encoding. The counts are exact (tested against encoding each prefix anew)
where the pre-tokenizer drops white space between words, as the word-level BPE and sentencepiece
files do; for byte-level BPE, which joins a space to the word after it, a count at a cut is that of
the words ending there.

Files are those of public tokenizers: ``.json`` for the tokenizers library, ``.model`` for
sentencepiece. No begin, end or added special tokens are put around a text; special strings inside
a text are handled as the library does by default; nothing is truncated or padded.

Edge cases: a null text counts as the empty text (no words, ``P = [0]``, zero tokens). Very long
texts are encoded whole, in one call of the library per text; the prefix arrays grow with the
number of words. Repeated rows and tied counts each keep their own row; extra columns pass through.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.functions import pandas_udf

LIMIT = 2048
# Texts handed to the library in one call: bounds the memory of its encodings.
CHUNK = 256
# Bytes held by a Python worker for words and their counts (with a dictionary entry's own cost,
# taken as ENTRY_BYTES); emptied when full.
MEMO_BYTES = 128 << 20
ENTRY_BYTES = 120
# ASCII white space, which every pre-token of a white-space-dropping vocabulary lies between.
_SPACE = np.array([9, 10, 11, 12, 13, 32], dtype=np.uint32)

PREFIXES = "n_tokens long, cut_chars array<int>, prefix_tokens array<int>"

_tokenizers: dict[str, object] = {}


class _Counter:
    """One tokenizer file; gives per text the word ends (in code points) and counts there."""

    def __init__(self, path: str):
        self.piece = path.endswith(".model")
        if self.piece:
            import sentencepiece
            self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            # A task has its own core; the library's own threads would take the others'.
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer
            self._model = Tokenizer.from_file(path)
            self.spaced = _drops_space(path)
        self._memo: dict[bytes, int] = {}
        self._held = 0

    def prefixes(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        if self.piece:
            return self._pieces(texts)
        return self._spaced(texts) if self.spaced else self._words(texts)

    def _spaced(self, texts):
        """Recurrence over white-space words: each distinct word is encoded once (memo)."""
        split = [t.encode().split() for t in texts]
        new = set().union(*split).difference(self._memo)
        size = sum(map(len, new)) + ENTRY_BYTES * len(new)
        if self._held + size > MEMO_BYTES:
            self._memo, self._held = {}, 0
            new = set().union(*split)
            size = sum(map(len, new)) + ENTRY_BYTES * len(new)
        new = list(new)
        made = self._model.encode_batch_fast([w.decode() for w in new], add_special_tokens=False)
        self._memo.update(zip(new, (len(e.ids) for e in made)))
        self._held += size
        memo, tables = self._memo, []
        for text, words in zip(texts, split):
            counts = np.fromiter(map(memo.__getitem__, words), dtype=np.int64, count=len(words))
            code = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
            space = np.isin(code, _SPACE)
            ends = np.flatnonzero(~space & np.append(space[1:], True)) + 1
            tables.append(_table(ends, np.cumsum(counts)))
        return tables

    def _words(self, texts):
        made = []
        for e in self._model.encode_batch(texts, add_special_tokens=False):
            words = np.array([-1 if w is None else w for w in e.word_ids], dtype=np.int64)
            ends = np.array([o[1] for o in e.offsets], dtype=np.int32).reshape(-1)
            # A word ends where the next token belongs to another word (or none follows).
            last = np.ones(len(words), dtype=bool)
            if len(words) > 1:
                last[:-1] = (words[1:] != words[:-1]) | (words[1:] < 0)
            made.append(_table(ends[last], np.flatnonzero(last) + 1))
        return made

    def _pieces(self, texts):
        made = []
        for text, proto in zip(texts, self._model.encode(texts, return_type="proto")):
            pieces = proto.pieces
            # Byte offsets of piece ends, in code points; a word ends before a piece that opens one.
            code = np.frombuffer(text.encode(), dtype=np.uint8)
            starts = np.concatenate([[0], np.cumsum((code & 0xC0) != 0x80)])
            ends = np.array([starts[p.end] for p in pieces], dtype=np.int32)
            opens = np.array([p.piece.startswith("▁") for p in pieces] + [True], dtype=bool)
            last = opens[1:]
            made.append(_table(ends[last], np.flatnonzero(last) + 1))
        return made


def _drops_space(path: str) -> bool:
    """Whether the file's pre-tokenizer keeps only matches of a pattern that white space ends, as
    word-level vocabularies do, and no added token holds white space: then a text's tokens are
    those of its white-space words in a row."""
    import json
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    steps = pre.get("pretokenizers", [pre]) if pre.get("type") == "Sequence" else [pre]
    first = steps[0] if steps else {}
    pattern = (first.get("pattern") or {}).get("Regex", "")
    splits = (first.get("type") == "Split" and first.get("behavior") == "Removed"
              and first.get("invert") and r"\s" in pattern and "[^\\s" in pattern)
    words = first.get("type") in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer")
    clean = not any(any(c.isspace() for c in t["content"]) for t in spec.get("added_tokens", []))
    return bool(splits or words) and clean


def _table(ends: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``P`` with its leading 0 at character 0."""
    return (np.concatenate([[0], ends]).astype(np.int32),
            np.concatenate([[0], counts]).astype(np.int32))


def _counter(path: str) -> _Counter:
    """One tokenizer per Python worker: only the file last asked for is held."""
    if path not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[path] = _Counter(path)
    return _tokenizers[path]


def token_prefixes(path: str):
    """Column function: a text's struct ``(n_tokens, cut_chars, prefix_tokens)``.

    ``prefix_tokens[j]`` is the exact token count of the text's first ``cut_chars[j]`` code points;
    both start with 0, and the last count is the whole text's.
    """

    @pandas_udf(PREFIXES)
    def prefixes(texts: pd.Series) -> pd.DataFrame:
        counter = _counter(path)
        values = texts.fillna("").tolist()
        cuts, counts = [], []
        for at in range(0, len(values), CHUNK):
            for ends, totals in counter.prefixes(values[at:at + CHUNK]):
                cuts.append(ends)
                counts.append(totals)
        return pd.DataFrame({"n_tokens": [int(c[-1]) for c in counts], "cut_chars": cuts,
                             "prefix_tokens": counts})

    return prefixes


def prefix_for_budget(prefixes: Column, budget: Column | int) -> Column:
    """Index (0-based) of the longest prefix of at most ``budget`` tokens; native."""
    budget = F.lit(budget) if isinstance(budget, int) else budget
    return F.size(F.filter(prefixes["prefix_tokens"], lambda n: n <= budget)) - 1


def truncated(text: Column, prefixes: Column, budget: Column | int) -> Column:
    """The longest word prefix of ``text`` of at most ``budget`` tokens, from the table alone."""
    at = prefix_for_budget(prefixes, budget)
    return F.substring(F.coalesce(text, F.lit("")), 1, F.get(prefixes["cut_chars"], at))


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, text: str = "text") -> DataFrame:
    """Rows of ``docs`` with ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` and ``prefixes``.

    Every word boundary of every text is kept in ``prefixes``; counts come from its last entry.
    Columns of these names in ``docs`` are replaced.
    """
    made = docs.withColumn("prefixes", token_prefixes(path)(F.col(text)))
    n_tokens = F.element_at(F.col("prefixes.prefix_tokens"), -1).cast("bigint")
    return made.withColumns({
        "n_bytes": F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("bigint"),
        "n_tokens": n_tokens, "over_limit": n_tokens > limit})


def batches(texts: Iterator[str], path: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Prefix tables of plain texts without Spark, for tests and brute force."""
    counter = _Counter(path)
    for t in texts:
        yield counter.prefixes([t or ""])[0]
