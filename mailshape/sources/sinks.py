"""Writers for reports and chart tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_report(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Write a report frame; its name is the last part of ``path``."""
    df.write.mode("overwrite").format(file_format).save(path)


def write_chart_tables(tables: dict[str, DataFrame], root: str, model: str) -> None:
    """Write each chart's table to ``root/<chart>``, partitioned by model.

    Only the partition of ``model`` is replaced, so runs of several models share one folder.
    """
    for chart, data in tables.items():
        (data.withColumn("model", F.lit(model)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("model")
         .parquet(f"{root}/{chart}"))
