import csv
import random

from mailshape.plans.full_run import full_run
from mailshape.sources.csv_mail import load_training_mails
from mailshape.sources.raw_mail import load_raw_mails

HAM = "meeting report project team lunch review agenda".split()
SPAM = "winner cash prize pills offer click bonus".split()


def test_from_files_to_tables(spark, tmp_path):
    rng = random.Random(1)
    with open(tmp_path / "train.csv", "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(["", "label", "subject", "email_from", "message"])
        for i in range(60):
            label = i % 2
            body = " ".join(rng.choices(SPAM if label else HAM, k=15)) + ("\nSee http://x.y" if label else "")
            out.writerow([i, label, "Hello, you", f"u{i}@e.org", body])
    for folder, words in (("easy_ham", HAM), ("spam_2", SPAM)):
        (tmp_path / "mail" / folder).mkdir(parents=True)
        for i in range(12):
            text = " ".join(rng.choices(words, k=15))
            (tmp_path / "mail" / folder / f"{i:03}").write_text(f"Subject: Hello\nFrom: a@b.c\n\n{text}\n")
    lexicon = spark.createDataFrame([("prize",), ("winner",)], "word string")
    reports = full_run(
        load_training_mails(spark, str(tmp_path / "train.csv")),
        load_raw_mails(spark, str(tmp_path / "mail")), str(tmp_path / "out"),
        lexicon=lexicon)

    assert {r.corpus: (r.n_rows, r.n_spam) for r in reports["sample_counts"].collect()} == {
        "train": (60, 30), "test": (24, 12)}
    back = lambda name: spark.read.parquet(str(tmp_path / "out" / name))
    scores = {r.model: r for r in back("comparison").collect()}
    assert len(scores) == 5 and all(r.status == "ok" for r in scores.values())
    assert scores["TFIDF Unigram"].f1 == 1.0
    assert [r.cv_f1_mean is not None for r in scores.values()].count(True) == 4
    assert back("top_terms").count() > 0 and back("length_histogram").count() == 100
    assert {r.model for r in back("models/confusion_matrix").select("model").distinct().collect()} == {
        "keyword_baseline", "tfidf_unigram", "logistic", "svm", "word2vec"}
