"""Labelled mail from CSV files in one of two column layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

MAIL_COLUMNS = ["mail_id", "subject", "sender", "body", "label"]

# Fixed strings that count as missing in a CSV cell.
NA_STRINGS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Fixed column sets; the first one that is contained in the header decides.
TEXT_LABEL_LAYOUT = {"Subject", "Message", "Spam/Ham"}
NUMBER_LABEL_LAYOUT = {"label", "subject", "email_from", "message"}


def scan_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw string columns of one file or a folder of files, plus ``mail_id`` in file order.

    Bodies may span lines, so one file is one task: keep files of moderate size and land the result
    as parquet once. All files of a folder must have the same header, else reading fails; read folders
    of another layout apart and take the union. ``mail_id`` is (rank of the file name, position in the file) in one number.
    """
    reader = (spark.read.option("header", True).option("multiLine", True)
              .option("quote", '"').option("escape", '"').option("nullValue", ""))
    names = reader.csv(path).columns
    # Each file's header is held against the first one's: another order of columns is an error. A
    # blank name, which Spark replaces by a number, has to be blank again for that.
    header = StructType([StructField("" if n == f"_c{i}" else n, StringType())
                         for i, n in enumerate(names)])
    raw = reader.schema(header).option("enforceSchema", False).csv(path).toDF(*names)
    cells = raw.select(
        *[F.when(~F.col(f"`{c}`").isin(NA_STRINGS), F.col(f"`{c}`")).alias(c)
          for c in raw.columns],
        F.monotonically_increasing_id().alias("_position"), F.input_file_name().alias("_file"))
    files = sorted(raw.inputFiles())
    # A file is never split, and positions rise within a task, hence within a file. Their lower 33
    # bits count the rows of the task, so they fit under the rank of the file.
    ranks = spark.createDataFrame(list(enumerate(files)), "_rank bigint, _file string")
    position = F.col("_position").bitwiseAND(F.lit((1 << 33) - 1))
    return cells.join(ranks, "_file").select(
        (F.shiftleft("_rank", 33) + position).alias("mail_id"),
        *[F.col(f"`{c}`") for c in raw.columns])


def drop_index_columns(df: DataFrame) -> DataFrame:
    """Drop nameless index columns (``Unnamed: 0`` and the like, or Spark's name for a blank header)."""
    return df.drop(*[c for c in df.columns if c.startswith("Unnamed:") or c == "_c0"])


def text_label(label: Column) -> Column:
    """``ham`` -> 0, ``spam`` -> 1 in any case, anything else null."""
    lowered = F.lower(label)
    return F.when(lowered == "ham", 0).when(lowered == "spam", 1)


def from_text_label_layout(df: DataFrame) -> DataFrame:
    """Subject / Message / Spam/Ham -> mail frame. There is no sender in this layout."""
    return df.select(
        "mail_id", F.col("Subject").alias("subject"), F.lit("").alias("sender"),
        F.col("Message").alias("body"), text_label(F.col("`Spam/Ham`")).alias("label"))


def from_number_label_layout(df: DataFrame) -> DataFrame:
    """label / subject / email_from / message -> mail frame."""
    return df.withColumnsRenamed({"email_from": "sender", "message": "body"}).withColumn(
        "label", F.col("label").try_cast("double").cast("int"))


def to_mail_frame(df: DataFrame, source_name: str = "input") -> DataFrame:
    """Recognise the layout by its columns, rename, fill missing text, project to the mail frame."""
    df = drop_index_columns(df)
    present = set(df.columns)
    if TEXT_LABEL_LAYOUT <= present:
        mails = from_text_label_layout(df)
    elif NUMBER_LABEL_LAYOUT <= present:
        mails = from_number_label_layout(df)
    else:
        raise ValueError(
            f"unsupported training schema in {source_name}: expected the columns "
            f"{sorted(TEXT_LABEL_LAYOUT)} or {sorted(NUMBER_LABEL_LAYOUT)}")
    return mails.fillna("", ["subject", "sender", "body"]).select(*MAIL_COLUMNS)


def load_training_mails(spark: SparkSession, path: str) -> DataFrame:
    """Mail frame from CSV at ``path``; ``ValueError`` if its columns fit neither layout."""
    return to_mail_frame(scan_csv(spark, path), path)
