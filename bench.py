"""Headline timings: prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores (default 8).
Every query runs to its last row (the ``noop`` sink); the first, untimed one only warms up the JVM.
"""

from __future__ import annotations

import json
import os
import time

from mailshape.operators import prepare, profile
from mailshape.plans import compare, queries as Q
from mailshape.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Registered queries timed as they are.
REGISTERED = [
    "clean_text_documents", "clean_text_pages", "structural_features_mail", "lemmatize_terms",
    "preprocess_text", "conflicting_labels", "dedupe_first", "cleaning_summary", "label_diversity",
    "length_histogram", "length_density", "length_p95", "top_terms", "vocab_unigram", "vocab_bigram",
    "count_matrix", "tfidf_matrix", "scaled_features", "doc_centroid", "stratified_folds",
    "classification_report", "pr_curve", "average_precision",
]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", {
        "spark.sql.shuffle.partitions": CPUS, "mailshape.text.partitions": CPUS,
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    drain(Q.QUERIES["structural_features_pages"](spark, FOLDER))

    times: dict[str, float] = {}

    def timed(name, action):
        start = time.perf_counter()
        result = action()
        times[name] = round(time.perf_counter() - start, 3)
        return result

    for name in REGISTERED:
        timed(name, lambda: drain(Q.QUERIES[name](spark, FOLDER)))

    # The model runs share one preparation, as in a full run.
    train, test = timed("prepare_corpora", lambda: Q.prepared_corpora(spark, FOLDER))
    timed("profile", lambda: [drain(t) for t in profile.profile(
        prepare.corpus_union(train, test)).values()])
    # As in a full run: one set of folds, four models with cross-validation, then the word vectors.
    tables = timed("folds", lambda: compare.fold_tables(
        compare.landed_folds(train), [m.ngram_range for m in compare.TEXT_MODELS]))
    for settings in compare.TEXT_MODELS:
        timed(f"cv_fit_score_{compare.model_tag(settings.name)}", lambda: drain(
            compare.run_text_model(settings, train, test, tables).metrics))
    timed("fit_score_word2vec", lambda: drain(compare.run_embedding_model(train, test).metrics))

    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
