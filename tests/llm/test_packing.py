import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from mailshape.llm import kk, packing
from mailshape.llm.queries import op8_packing

PATH = public_tokenizers.path(packing.VOCABULARY)
SCHEMA = "doc_id bigint, text string, start string"


def token_ids(texts):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return [e.ids + [1] for e in tokenizer.encode_batch(
        [t or "" for t in texts], add_special_tokens=False)]


def check_pieces(pieces, wanted, capacity=2048):
    """Every id in exactly one piece; sequences gapless from 0 and within the capacity."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    assert set(by_doc) == set(wanted)
    for doc, ids in wanted.items():
        at = 0
        for p in sorted(by_doc[doc], key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"]) == (at, len(ids)) and p["length"] > 0
            part = np.array(ids[at:at + p["length"]], dtype="<u4")
            assert p["ids_crc32"] == zlib.crc32(part.tobytes())
            at += p["length"]
        assert at == len(ids)
    for members in by_sequence.values():
        at = 0
        for p in sorted(members, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
    return len(by_sequence)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=40), st.integers(1, 9))
def test_partition_keeps_every_size(sizes, parts):
    groups = kk.partition(sizes, parts)
    assert len(groups) == parts
    assert sorted(i for g in groups for i in g) == list(range(len(sizes)))


def test_differencing_example():
    # The textbook case: 8 7 6 5 4 has a two-way difference of 2 by differencing.
    sums = [sum([8, 7, 6, 5, 4][i] for i in g) for g in kk.partition([8, 7, 6, 5, 4], 2)]
    assert abs(sums[0] - sums[1]) == 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_windows_hold_the_capacity(sizes):
    groups = kk.windows(sizes, 64)
    assert all(sum(sizes[i] for i in g) <= 64 for g in groups)
    assert sorted(i for g in groups for i in g) == list(range(len(sizes)))


def test_window_rejects_large_sizes():
    with pytest.raises(ValueError):
        kk.windows([65], 64)


@pytest.mark.parametrize("text", [
    "It's we'll 'stop' ''s ½²³ 日本 don't,,,'s x1y22", "ΣΑΣ ΑΣ. İstanbul á é ŉa ſ µ ª \x1cq\x1f",
    "<|endoftext|> <|startoftext|>x", "a" * 3000, "", " \n\t", "é́ ́x &&&*** the&&&",
    "Élan!! Straße. ((x)) İx. ŉ, ž; a'. don't.. 'tis a'b' ÀÉ-x_ -- x\u0301. \u0130\u0149"])
def test_encoder_equals_tokenizer(text):
    made = packing.WordEncoder(PATH).encode([text, None, text])
    want = token_ids([text])[0][:-1]
    assert [np.frombuffer(m, "<u4").tolist() for m in made] == [want, [], want]


def test_encoder_with_full_memos(monkeypatch):
    monkeypatch.setattr(packing, "_WORDS_MEMO", 5)
    monkeypatch.setattr(packing, "_PARTS_MEMO", 5)
    encoder = packing.WordEncoder(PATH)
    texts = ["one two three four five six seven", "six one eight, nine. ten", "zehn élan one two"]
    for _ in range(2):
        made = encoder.encode(texts)
        assert [np.frombuffer(m, "<u4").tolist() + [1] for m in made] == token_ids(texts)


def test_new_words_take_one_call_of_the_tokenizer(monkeypatch):
    encoder, calls = packing.WordEncoder(PATH), []
    monkeypatch.setattr(encoder, "_encoded", lambda texts, one=encoder._encoded: (
        calls.append(len(texts)), one(texts))[1])
    letters = [chr(c) for c in range(0x80, 0x17F) if chr(c).isalpha()]
    texts = [" ".join(f"w{c}ord{i}"[:6] for i, c in enumerate(letters)), " ".join(letters),
             " ".join(f"{c}a{c}" * 3 for c in letters), "plain words only! and, more."]
    assert [np.frombuffer(m, "<u4").tolist() + [1] for m in encoder.encode(texts)] == token_ids(texts)
    calls.clear()
    encoder.encode(["a thousand unseen runs of letters élan straße", "letters alone"])
    assert not calls


def test_memos_stay_small():
    # A worker of the pipeline holds its other stages' models too: 1,000,000 words were too many.
    assert packing._WORDS_MEMO <= 500_000 and packing._PARTS_MEMO <= 300_000


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "word " * 9000, "x"), (4, "a b c", "x"),
            (None, "null id", "x")]
    pieces = packing.pack_documents(spark.createDataFrame(rows, SCHEMA).coalesce(1), PATH)
    found = [r.asDict() for r in pieces.collect()]
    wanted = dict(zip([r[0] for r in rows], token_ids([r[1] for r in rows])))
    check_pieces(found, wanted)
    for p in found:
        assert p["ids"] == wanted[p["doc_id"]][p["start"]:p["start"] + p["length"]]
    again = packing.pack_documents(spark.createDataFrame([(1, "a", "x")] * 3, SCHEMA), PATH)
    assert again.count() == 3
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    wanted = dict(zip([r.doc_id for r in docs], token_ids([r.text for r in docs])))
    sequences = check_pieces([r.asDict() for r in op8_packing(spark, folder).collect()], wanted)
    tokens = sum(map(len, wanted.values()))
    assert tokens > 0.99 * 2048 * sequences
