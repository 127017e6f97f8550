"""Labelled mail from folders of raw RFC 822 messages, one file per mail."""

from __future__ import annotations

import email
import io
import warnings
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from mailshape.operators.scale import lookup_join, range_blocks, with_running_totals
from mailshape.session import land
from mailshape.sources.csv_mail import MAIL_COLUMNS

# Fixed (folder, label) pairs; their order is the order of the resulting rows.
LABELLED_FOLDERS = [("easy_ham", 0), ("spam_2", 1)]
FALLBACK_FOLDER = "test"


def _scan_folder(spark: SparkSession, path: str) -> DataFrame | None:
    """Files directly inside ``path``, or ``None`` if there is no such folder.

    Spark's file listing leaves out names starting with a dot, as wanted, and also those starting
    with an underscore.
    """
    try:
        return spark.read.format("binaryFile").load(path).select("path", "content")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def scan_labelled_folders(spark: SparkSession, root: str) -> DataFrame:
    """``(path, content, label)`` over the labelled folders below ``root`` (or ``root/test``)."""
    first = LABELLED_FOLDERS[0][0]
    if (_scan_folder(spark, f"{root}/{first}") is None
            and _scan_folder(spark, f"{root}/{FALLBACK_FOLDER}") is not None):
        root = f"{root}/{FALLBACK_FOLDER}"
    found = spark.createDataFrame([], "path string, content binary, label int")
    for folder, label in LABELLED_FOLDERS:
        files = _scan_folder(spark, f"{root}/{folder}")
        if files is None:
            warnings.warn(f"folder {root}/{folder} does not exist", stacklevel=2)
            continue
        found = found.unionByName(files.withColumn("label", F.lit(label)))
    return found


def mail_fields(content: bytes) -> tuple[str, str, str]:
    """Subject, sender and body of one raw message.

    Header values that are not plain strings (raw 8-bit bytes) count as empty; encoded words and
    folds stay as they are. Bodies are read as UTF-8 whatever charset is declared. HTML parts only
    count if there is no plain part at all, even an empty one.
    """
    # Read as a file, so that line ends are unified as they are for a mail read from disk.
    message = email.message_from_binary_file(io.BytesIO(content))
    subject, sender = (
        value if isinstance(value, str) else ""
        for value in (message.get("Subject", ""), message.get("From", "")))
    texts: dict[str, list[str]] = {"text/plain": [], "text/html": []}
    for part in message.walk():
        kind = part.get_content_type()
        if kind in texts:
            content_bytes = part.get_payload(decode=True) or b""
            texts[kind].append(content_bytes.decode("utf-8", "replace"))
    return subject, sender, " ".join(texts["text/plain"] or texts["text/html"])


def decode_mails(files: DataFrame) -> DataFrame:
    """``(path, content, label)`` -> ``(path, subject, sender, body, label)``, Arrow batch by batch."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fields = [mail_fields(content.as_py()) for content in batch.column("content")]
            subjects, senders, bodies = zip(*fields) if fields else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), pa.array(subjects, pa.string()),
                 pa.array(senders, pa.string()), pa.array(bodies, pa.string()),
                 batch.column("label")],
                names=["path", "subject", "sender", "body", "label"])

    return files.mapInArrow(
        decode, "path string, subject string, sender string, body string, label int")


def load_raw_mails(spark: SparkSession, root: str) -> DataFrame:
    """Landed mail frame over the labelled folders, numbered by (folder, file name).

    Numbers are made from the file names alone, which does not read any file; then every file is read
    and decoded once, and many small files become few columnar ones.
    """
    files = scan_labelled_folders(spark, root)
    order = [F.col("label"), F.col("path")]
    blocks = range_blocks(files.select("label", "path"), order, "file_names")
    numbers = land(
        with_running_totals(blocks, order, {"_row": F.lit(1)})
        .select("path", (F.col("_row") - 1).alias("mail_id")), "file_numbers")
    mails = lookup_join(decode_mails(files), numbers, "path").select(*MAIL_COLUMNS)
    return land(mails, "raw_mail")
