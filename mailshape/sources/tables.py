"""Mail views over the generated tables (documents, labels, pages, conversations)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Splits that a text table is read in, where the caller or the configuration names a number.
PARTITIONS_CONF = "mailshape.text.partitions"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_table(spark: SparkSession, folder: str, name: str,
               partitions: int | None = None) -> DataFrame:
    """A table whose rows are heavy to work on, dealt out over ``partitions`` tasks if that is given
    (or set as ``mailshape.text.partitions``), as for a file of one row group; else as it lies."""
    rows = table(spark, folder, name)
    partitions = partitions or int(spark.conf.get(PARTITIONS_CONF, "0"))
    return rows.repartition(partitions) if partitions else rows


def documents_as_mail(documents: DataFrame) -> DataFrame:
    """First line as subject, the rest as body, the source as sender; ``lang`` is kept."""
    subject = F.substring_index("text", "\n", 1)
    return documents.select(
        F.col("doc_id").alias("mail_id"), subject.alias("subject"),
        F.col("source").alias("sender"),
        F.substr("text", F.length(subject) + 2).alias("body"), "lang")


def labelled_mail(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents as mail: label 1 is a document of quality 0."""
    labels = table(spark, folder, "labels").select(
        F.col("doc_id").alias("mail_id"), (F.lit(1) - F.col("quality")).alias("label"))
    return documents_as_mail(text_table(spark, folder, "documents")).join(labels, "mail_id")


def train_mail(spark: SparkSession, folder: str) -> DataFrame:
    return labelled_mail(spark, folder).filter(F.col("lang") == "en").drop("lang")


def test_mail(spark: SparkSession, folder: str) -> DataFrame:
    """Mail in the other languages: a foreign corpus for models fitted on :func:`train_mail`."""
    return labelled_mail(spark, folder).filter(F.col("lang") != "en").drop("lang")


def all_mail(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as mail. The label is the parity of the id, so that copies can conflict."""
    return documents_as_mail(text_table(spark, folder, "documents")).drop("lang").withColumn(
        "label", (F.col("mail_id") % 2).cast("int"))


def page_mail(spark: SparkSession, folder: str) -> DataFrame:
    """Web pages as mail: the URL as subject, the HTML source as body."""
    return text_table(spark, folder, "pages").select(
        F.col("page_id").alias("mail_id"), F.col("url").alias("subject"),
        F.lit("").alias("sender"), F.col("html").alias("body"), F.lit(None).cast("int").alias("label"))


def conversation_mail(spark: SparkSession, folder: str) -> DataFrame:
    """Turns as mail with an address made of role and conversation as sender."""
    return text_table(spark, folder, "conversations").select(
        "conv_id", "turn", F.lit("").alias("subject"), F.col("text").alias("body"),
        F.concat(F.col("role"), F.lit("@"), F.col("conv_id").cast("string"),
                 F.lit(".Example.org")).alias("sender"))
