import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mailshape.llm import tokencount
from mailshape.llm.queries import QUERIES

WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", "a", "Hello, wörld!!  It's <|endoftext|>abc123 Ünïcødé 😀x", "x\n\n y  z\t",
         "word " * 3000, "Ab" * 5000, "<|startoftext|><|endoftext|>"]


def brute(path):
    if path.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda s: len(model.encode(s))
    model = Tokenizer.from_file(path)
    return lambda s: len(model.encode(s, add_special_tokens=False).ids)


@pytest.mark.parametrize("path", [WORD, PIECE])
def test_every_prefix_is_exact(path):
    count = brute(path)
    for text, (cuts, totals) in zip(TEXTS, tokencount.batches(TEXTS, path)):
        assert cuts[0] == 0 and totals[0] == 0 and totals[-1] == count(text)
        assert list(totals) == sorted(totals)
        for at in range(0, len(cuts), max(1, len(cuts) // 40)):
            assert totals[at] == count(text[:cuts[at]])


def test_counts_budget_and_truncation(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(99, None), (100, "a"), (100, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit(-1))
    made = tokencount.count_tokens(docs, WORD, limit=3).withColumn(
        "cut", tokencount.truncated(F.col("text"), F.col("prefixes"), 3)).collect()
    count = brute(WORD)
    assert len(made) == len(rows)
    for r in made:
        text = r.text or ""
        assert r.n_tokens == count(text) and r.n_bytes == len(text.encode())
        assert r.over_limit == (r.n_tokens > 3)
        assert count(r.cut) <= 3 and text.startswith(r.cut)
        if r.n_tokens <= 3:
            assert r.cut.strip() == text.strip()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tokencount.count_tokens(docs, WORD).count() == 0


def test_query_equals_library(spark):
    got = QUERIES["op11_token_counts"](spark, "/root/testdata/sf0.001").toPandas()
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").toPandas()
    count = brute(WORD)
    want = {d: count(t or "") for d, t in zip(texts.doc_id, texts.text)}
    assert list(got.columns) == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert len(got) == len(texts)
    assert all(want[d] == n for d, n in zip(got.doc_id, got.n_tokens))
    assert (got.over_limit == (got.n_tokens > 2048)).all()
