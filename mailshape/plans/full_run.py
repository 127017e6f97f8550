"""The whole job: two raw corpora in, every report and chart table out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from mailshape.operators import prepare, profile
from mailshape.plans import compare
from mailshape.session import land
from mailshape.sources.sinks import write_chart_tables, write_report


def full_run(train: DataFrame, test: DataFrame, output: str | None = None, *,
             lexicon: DataFrame | None = None, exceptions: DataFrame | None = None,
             stop_words: Sequence[str] | None = None, do_cv: bool = True) -> dict[str, DataFrame]:
    """Prepare, profile, fit and compare; returns the reports and, given ``output``, writes all tables.

    The raw frames are landed first and the prepared ones once more after cleaning; everything else
    reads one of the two.
    """
    train, test = land(train, "raw_train"), land(test, "raw_test")
    counts = profile.sample_counts(train=train, test=test)
    prepared = [prepare.preprocess(df, lexicon, exceptions) for df in (train, test)]
    train, test, summary, _ = prepare.prepare_datasets(*prepared)
    train, test = land(train, "train"), land(test, "test")
    charts = profile.profile(prepare.corpus_union(train, test))
    runs = compare.run_models(train, test, do_cv, stop_words)
    reports = {
        "sample_counts": counts, "cleaning_summary": summary,
        "label_diversity": prepare.label_diversity(train, "Train").unionByName(
            prepare.label_diversity(test, "Test")),
        "comparison": compare.comparison(runs), **charts,
    }
    if output is not None:
        for name, report in reports.items():
            write_report(report, f"{output}/{name}")
        for run in runs:
            if run.predictions is not None:
                write_chart_tables(compare.evaluation_tables(run.predictions),
                                   f"{output}/models", compare.model_tag(run.name))
    return reports
