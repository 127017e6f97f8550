import corpus_pipeline
from mailshape.llm import decontam, neardup, pii
from mailshape.llm.queries import QUERIES, op7_toxicity
from tests.llm.test_neardup import brute
from tests.llm.test_packing import check_pieces, token_ids

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_stages_take_effect(spark):
    """Every stage against what its own decisions say of its own input."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    left = {r.doc_id: r.text for r in docs.collect()}
    columns = docs.columns
    kept = {r.doc_id for r in op7_toxicity(spark, FOLDER).filter("kept").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == columns
        rows = docs.collect()
        if name == "toxicity":
            left = {k: v for k, v in left.items() if k in kept}
        elif name == "near_duplicates":
            found = brute(list(left.items()))
            left = {i: left[i] for i, _, component in found if i == component}
        elif name == "decontamination":
            items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
            frame = spark.createDataFrame(list(left.items()), "doc_id bigint, text string")
            bad = {r.doc_id for r in decontam.find_leaks(frame, items).collect()}
            left = {k: v for k, v in left.items() if k not in bad}
        else:
            for r in rows:
                assert pii.base_spans(r.text) == [] and r.n_chars == len(r.text)
            left = {r.doc_id: r.text for r in rows} if {r.doc_id for r in rows} == set(left) else {}
        assert {r.doc_id: r.text for r in rows} == left
    pieces = corpus_pipeline.pack(spark, docs, FOLDER).collect()
    ids = dict(zip(left, token_ids(left.values())))
    check_pieces([r.asDict() for r in pieces], ids)


def test_run_is_registered(spark):
    assert QUERIES["pipeline"](spark, FOLDER).count() > 0
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "pii", "packing"]


def test_copies_with_odd_ids(spark):
    text = "one two three four five six seven"
    rows = [(1, text, "en", "a", 1), (1, text, "en", "a", 1), (2, text.title(), "en", "a", 1),
            (1, "another text of its own here", "en", "a", 1), (None, text, "en", "a", 1),
            (3, None, "en", "a", None), (3, None, "en", "a", None), (3, "", "en", "a", 0),
            (4, text.upper(), "en", "a", 1), (None, "no id and no copy of it", None, None, None)]
    out = neardup.without_copies(spark.createDataFrame(rows, SCHEMA)).collect()
    got = sorted(((r.doc_id, r.text) for r in out), key=str)
    assert len(got) == len(set(got))
    assert (1, text) in got and (1, "another text of its own here") in got
    assert (None, "no id and no copy of it") in got and (None, text) not in got
    assert sum(i == 3 for i, _ in got) == 1 and sum(t == text.upper() for _, t in got) == 0
    empty = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, empty, FOLDER)
        assert made.count() == 0 and (name == "packing" or made.columns == empty.columns)
