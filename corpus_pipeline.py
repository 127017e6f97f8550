"""From raw documents to packed training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from mailshape.llm import decontam, neardup, packing, pii, toxicity
from mailshape.session import land
from mailshape.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of severity grade 0. The model is fitted on the labelled ones among ``docs``."""
    model = toxicity.fit(docs, toxicity.label_grades(table(spark, sf_dir, "labels")),
                         toxicity.GRADES)
    return docs.filter(toxicity.severity(model, F.col("text"))["grade"] == 0)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return neardup.without_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    indexes = decontam.index_parts(table(spark, sf_dir, "benchmark"), docs)
    return docs.filter(~decontam.holds_item(indexes, F.col("text")))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind in brackets; ``n_chars`` is counted anew."""
    model = pii.fit(docs)
    return docs.withColumn("text", pii.redact(model, F.col("text"))).withColumn(
        "n_chars", F.length("text").cast("bigint"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, with their token ids."""
    return packing.pack_documents(docs, public_tokenizers.path(packing.VOCABULARY))


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates),
          ("decontamination", drop_contaminated), ("pii", redact_personal_data),
          ("packing", pack)]

# Learnt models and signatures are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), name)
    return docs
