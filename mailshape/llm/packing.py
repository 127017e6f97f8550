"""Packing of tokenised documents into sequences by Karmarkar-Karp multiway differencing.

A document's ids are cut into full sequences and pieces of halving sizes. The pieces of a block of
documents go to near-equal windows (:mod:`mailshape.llm.kk`). A block lies within one input split, so
nothing is shuffled, and a task holds one block.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from mailshape.llm.kk import windows
from mailshape.llm.memos import alone

CAPACITY = 2048
BLOCK_DOCUMENTS = 1024
# Cuts of what is left of a document after its full sequences: a divisor of the capacity each.
CUTS = (2, 4, 8, 16)
END_ID = 1
VOCABULARY = "word_bpe_49k.json"

# Fixed pattern of the vocabulary's word split, for lower-case text.
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# Marks that end many words; an apostrophe may begin a part of its own.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# Other words outside these letters go to the tokenizer as they are.
_PLAIN = regex.compile(r"[\x21-\x7e¡-¬®-įı-ňŊ-ž]+")
_TEXTS_AT_ONCE = 256
# Words and parts held by a worker: about 150 MB when full.
_WORDS_MEMO, _PARTS_MEMO = 500_000, 300_000


class WordEncoder:
    """Ids of a text as little-endian 32-bit bytes, with memos of words and word parts.

    The vocabulary drops white space and never joins across it, so a text's ids are those of its
    words in a row. Memos are emptied when full.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._mark, = self._tokenizer.encode("!", add_special_tokens=False).ids
        # The vocabulary's own model, for lower-case runs of letters that are split already.
        self._letters = Tokenizer(self._tokenizer.model)
        self._letters.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._bytes = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0x80, 0x17F)
                       if chr(c).isalpha()}
        self._words: dict[bytes, bytes] = {}
        self._parts: dict[str, bytes] = {}

    def clear(self) -> None:
        self._words, self._parts = {}, {}

    def _encoded(self, texts: list[str]) -> list[bytes]:
        # One call for all: batching saves most of the cost of a call.
        made = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [_little_endian(m.ids) for m in made]

    def _encoded_heads(self, heads: list[str]) -> list[bytes]:
        """Ids of lower-case runs of letters, given as the characters that the model has for their
        bytes. They are one text with a mark after each: no run of letters has that mark's id, so the
        ids between two marks are those of one run."""
        ids = np.array(self._letters.encode_batch_fast(
            [" ! ".join([*heads, ""])], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.flatnonzero(ids == self._mark).tolist()
        raw = ids.tobytes()
        return [raw[4 * first:4 * end] for first, end in zip([0, *[e + 1 for e in ends]], ends)]

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        if len(self._parts) > _PARTS_MEMO:
            self._parts = {}
        known = self._parts
        texts = b"\n".join(words).decode().split("\n")
        heads = [t.rstrip(_MARKS) for t in texts]
        lower = "\n".join(heads).lower().split("\n")
        plain, odd, whole = [], [], []
        for i, head in enumerate(heads):
            if head.isalpha() and (head.isascii() or (
                    max(head) <= "\u017e" and "\u0130" not in head and "\u0149" not in head)):
                plain.append(i)
            elif _PLAIN.fullmatch(texts[i]):
                odd.append(i)
            else:
                whole.append(i)
        new = set([lower[i] for i in plain]).difference(known)
        ascii_only = [low for low in new if low.isascii()]
        if ascii_only:
            known.update(zip(ascii_only, self._encoded_heads(ascii_only)))
        other = [low for low in new if not low.isascii()]
        if other:
            known.update(zip(other, self._encoded_heads(
                "\n".join(other).translate(self._bytes).split("\n"))))
        # What is left of a word is one run of marks.
        tails = [texts[i][len(heads[i]):] for i in plain]
        split = [_SPLIT.findall(texts[i].lower()) for i in odd]
        new = list(set(tails).union(*split).difference(known, ("",)))
        if new:
            known.update(zip(new, self._encoded(new)))
        found = {words[i]: known[lower[i]] + known[tail] if tail else known[lower[i]]
                 for i, tail in zip(plain, tails)}
        found.update([(words[i], b"".join([known[p] for p in parts]))
                      for i, parts in zip(odd, split)])
        if whole:
            found.update(zip([words[i] for i in whole], self._encoded([texts[i] for i in whole])))
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = [(t or "").encode().split() for t in texts]
        every = set().union(*split)
        new = every.difference(self._words)
        if len(self._words) + len(new) > _WORDS_MEMO:
            self._words, new = {}, every
        if new:
            self._words.update(self._learn(list(new)))
        known = self._words
        return [b"".join(map(known.__getitem__, words)) for words in split]


def _little_endian(ids: list[int]) -> bytes:
    made = array("I", ids)
    if sys.byteorder == "big":
        made.byteswap()
    return made.tobytes()


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker and file; workers are used again from task to task."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return alone(_encoders[path])


def cut(tokens: int, capacity: int) -> list[int]:
    """Piece sizes of a document in order: full sequences, then halving cuts, then the rest."""
    full, left = divmod(tokens, capacity)
    sizes = [capacity] * full
    for share in CUTS:
        unit = capacity // share
        while unit and left > unit:
            sizes.append(unit)
            left -= unit
    return sizes + [left] * (left > 0)


def pack_block(lengths: list[int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """``(document, start, length, sequence, offset)`` of each piece, in document order."""
    pieces, small = [], []
    for document, tokens in enumerate(lengths):
        start = 0
        for size in cut(tokens, capacity):
            if size < capacity:
                small.append(len(pieces))
            pieces.append([document, start, size, -1, 0])
            start += size
    sequence = 0
    for piece in pieces:
        if piece[2] == capacity:
            piece[3] = sequence
            sequence += 1
    for group in windows([pieces[p][2] for p in small], capacity):
        offset = 0
        for index in group:
            piece = pieces[small[index]]
            piece[3], piece[4] = sequence, offset
            offset += piece[2]
        sequence += bool(group)
    return [tuple(p) for p in pieces]


def pack_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id",
                   text_col: str = "text", capacity: int = CAPACITY,
                   block_documents: int = BLOCK_DOCUMENTS, end_id: int = END_ID,
                   with_ids: bool = True) -> DataFrame:
    """One row per piece: ``id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and,
    if ``with_ids``, ``ids`` (array<int>).

    Each document ends with ``end_id``, so a null or empty text is one piece of one id. Each row is a
    document of its own, repeated or null ids included; other columns are not read; no rows give no
    pieces. ``sequence_id`` joins the number of the input split with a count, so a task that runs
    again gives the same rows.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = ", ".join([f"`{id_col}` {id_type}", *[f"{n} bigint" for n in names],
                        *(["ids array<int>"] if with_ids else [])])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary)
        base = TaskContext.get().partitionId() << 36
        end = np.array([end_id], dtype="<u4").tobytes()
        ids: list = []
        kept: list[bytes] = []
        id_arrow = None

        def packed(keys: list, texts: list[bytes]) -> pa.RecordBatch:
            nonlocal base
            pieces = pack_block([len(t) // 4 for t in texts], capacity)
            views = [texts[d][4 * s:4 * (s + n)] for d, s, n, _, _ in pieces]
            columns = [
                pa.array([keys[p[0]] for p in pieces], id_arrow),
                *[pa.array(x, pa.int64()) for x in (
                    [p[1] for p in pieces], [p[2] for p in pieces], [zlib.crc32(v) for v in views],
                    [len(texts[p[0]]) // 4 for p in pieces], [base + p[3] for p in pieces],
                    [p[4] for p in pieces])]]
            if with_ids:
                ends = np.cumsum([0, *[p[2] for p in pieces]], dtype=np.int32)
                columns.append(pa.ListArray.from_arrays(
                    pa.array(ends), pa.array(np.frombuffer(b"".join(views), "<i4"))))
            base += max((p[3] for p in pieces), default=-1) + 1
            return pa.RecordBatch.from_arrays(
                columns, [id_col, *names, *(["ids"] if with_ids else [])])

        for batch in batches:
            id_arrow = batch.schema.field(0).type
            for first in range(0, batch.num_rows, _TEXTS_AT_ONCE):
                part = batch.slice(first, _TEXTS_AT_ONCE)
                ids += part.column(0).to_pylist()
                kept += [t + end for t in words.encode(part.column(1).to_pylist())]
                while len(ids) >= block_documents:
                    yield packed(ids[:block_documents], kept[:block_documents])
                    del ids[:block_documents], kept[:block_documents]
        if ids:
            yield packed(ids, kept)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(pack, schema)
