import random

import pytest

from mailshape.operators import prepare


ROWS = [
    (1, "a b", 0), (2, "a b", 0), (3, "a b", 1), (4, "", 0), (5, None, 1), (6, " \t　", 0),
    (7, "c", None), (8, "c", None), (9, "c", 1), (10, "d", 1),
]


def test_drop_empty(mails):
    left = prepare.drop_empty_text(mails(ROWS))
    assert sorted(r.mail_id for r in left.collect()) == [1, 2, 3, 7, 8, 9, 10]


def test_clean_dataset_and_summary(mails):
    cleaned, summary = prepare.clean_dataset(mails(ROWS), "X")
    assert sorted(r.mail_id for r in cleaned.collect()) == [1, 3, 7, 9, 10]
    assert summary.first().asDict() == {
        "dataset": "X", "initial_rows": 10, "dropped_empty": 3, "removed_duplicates": 2,
        "conflicting_groups": 1, "remaining": 5}


def test_flags_and_other_subset(mails):
    kept, summary = prepare.clean_dataset(mails(ROWS), "X", drop_empty=False, deduplicate=False)
    assert kept.count() == 10
    assert tuple(summary.first())[1:] == (10, 0, 0, 0, 10)
    kept, summary = prepare.clean_dataset(mails(ROWS), "X", dedupe_subset=["label"])
    assert sorted(r.mail_id for r in kept.collect()) == [1, 3, 7]
    assert tuple(summary.first())[1:] == (10, 3, 4, 1, 3)
    kept, summary = prepare.clean_dataset(mails(ROWS), "X", drop_empty=False)
    assert sorted(r.mail_id for r in kept.collect()) == [1, 3, 4, 5, 6, 7, 9, 10]
    assert tuple(summary.first())[1:] == (10, 0, 2, 1, 8)


def test_empty_frame(mails):
    cleaned, summary = prepare.clean_dataset(mails([(1, "", 0)]).filter("false"), "X")
    assert cleaned.count() == 0
    assert tuple(summary.first()) == ("X", 0, 0, 0, 0, 0)


def test_result_does_not_depend_on_partitions_or_row_order(mails):
    rng = random.Random(5)
    rows = [(i, "hot copy" if i % 3 == 0 else f"t{rng.randint(0, 40)}", rng.randint(0, 1))
            for i in range(400)]
    want = None
    for partitions in (1, 8):
        shuffled = rows[:]
        rng.shuffle(shuffled)
        cleaned, summary = prepare.clean_dataset(mails(shuffled, partitions), "X")
        got = (sorted(map(tuple, cleaned.collect())), tuple(summary.first()))
        want = want or got
        assert got == want
    firsts = {}
    for row in rows:
        firsts.setdefault(row[1:], row)
    assert want[0] == sorted(firsts.values())


def test_required_and_repeated_columns(spark, mails):
    with pytest.raises(ValueError, match="text"):
        prepare.clean_dataset(mails(ROWS).drop("text"), "X")
    twice = mails(ROWS).selectExpr("mail_id", "text", "label", "'later' AS text", "9 AS label")
    once = prepare.drop_repeated_columns(twice)
    assert once.columns == ["mail_id", "text", "label"]
    assert once.filter("mail_id = 10").first() == (10, "d", 1)


def test_label_diversity(mails):
    rows = {r.label: tuple(r)[2:] for r in prepare.label_diversity(mails(ROWS), "X").collect()}
    assert rows[0] == (4, 3, 0.75) and rows[1] == (4, 3, 0.75) and set(rows) == {0, 1}
    assert prepare.label_diversity(mails(ROWS).drop("label"), "X") is None


def test_prepare_keeps_corpora_apart(mails):
    train, test, summary, diversity = prepare.prepare_datasets(
        mails([(1, "a", 0), (2, "a", 0)]), mails([(1, "a", 0)]))
    assert (train.count(), test.count()) == (1, 1)
    assert [(r.dataset, r.removed_duplicates) for r in summary.orderBy("dataset").collect()] == [
        ("Test", 0), ("Train", 1)]
    assert {r.unique_ratio for r in diversity.collect()} == {1.0}
    union = prepare.corpus_union(train, test)
    assert sorted((r.corpus, r.mail_id) for r in union.collect()) == [("test", 1), ("train", 1)]
