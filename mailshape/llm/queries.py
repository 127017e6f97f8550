"""Queries of the subpackage over the generated tables, with production parameters."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mailshape.llm import decontam, htmltree, lm, merkle, neardup, packing, periodic, pii, quality, tokencount, toxicity, urlfilter, warc
from mailshape.sources.tables import table

# Words in the hosts whose pages make up the list of single blocked URLs.
LISTED_HOSTS = r"ads|adult|bets|casino|pills|spam"


def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score_documents(table(spark, folder, "documents"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op3_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents")).drop("text_hash", "group")


def op4_revisits(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.resolve_revisits(warc.captures(table(spark, folder, "pages")))
    return found.withColumn("headers", warc.header_lines(F.col("headers")))


def op5_html(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return htmltree.extract(pages, htmltree.fit(pages))


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = pii.fit(docs)
    found = docs.select("doc_id", pii.find_spans(model, F.col("text")).alias("f"))
    kinds = F.transform(pii.span_array(F.col("f.base")), lambda s: s["kind"])
    return found.select(
        "doc_id", *[(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("bigint")
                    .alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2("f.base", 256).alias("base_sha256"), F.col("f.spans").alias("spans"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, toxicity.label_grades(table(spark, folder, "labels")),
                         toxicity.GRADES)
    scored = docs.select("doc_id", toxicity.severity(model, F.col("text")).alias("s"))
    return scored.select(
        "doc_id", F.col("s.grade").alias("severity"),
        F.col("s.expected").alias("expected_severity"), (F.col("s.grade") == 0).alias("kept"))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"),
                                  public_tokenizers.path(packing.VOCABULARY), with_ids=False)


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = quality.quality_rules(table(spark, folder, "documents"))
    return rules.withColumn("host_rate", F.round("host_rate", 6))


def op10_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    host, _ = urlfilter.url_parts(F.col("url"))
    return urlfilter.filter_urls(pages, urlfilter.rule_table(spark),
                                 pages.filter(host.rlike(LISTED_HOSTS)))


def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = tokencount.count_tokens(table(spark, folder, "documents"),
                                      public_tokenizers.path(packing.VOCABULARY))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def planted_words(doc_id: Column, text: Column) -> Column:
    """Words of a text, where crc32 of the decimal id ends in 0 made periodic from a word on: word
    ``i >= a`` becomes word ``a + (i - a) % p``, the block ``[a, a + p)`` repeated."""
    words = periodic.words_of(text)
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size(words)
    a = (g % n).cast("int")
    p = (F.floor((n - a) / (F.lit(3) + g % 8)) + 1).cast("int")
    block = F.slice(words, a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int"))), 1, n - a)
    return F.when((h % 10 == 0) & (n > 0), F.concat(F.slice(words, 1, a), tail)).otherwise(words)


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = periodic.periodic_runs(docs, planted_words(F.col("doc_id"), F.col("text")))
    best = found.select("doc_id", "runs", periodic.best_run(F.col("runs")).alias("best"))
    return best.select(
        "doc_id", F.col("runs.n_runs").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").cast("bigint").alias("exponent_milli"),
        periodic.runs_digest(F.col("runs")).alias("runs_sha256"),
        F.sha2(F.col("runs.collapsed"), 256).alias("collapsed_sha256"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(table(spark, folder, "documents"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


QUERIES = {f.__name__: f for f in [
    op1_lm_scoring, op2_decontamination, op3_minhash, op4_revisits, op5_html, op6_pii, op7_toxicity, op8_packing,
    op9_quality_rules, op10_url_filters, op11_token_counts, op12_periodic_runs, op13_merkle_manifest, pipeline]}
