"""Building blocks that keep skewed or global steps distributed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from mailshape.session import land

def exploded(df: DataFrame, keep: Sequence[str], array_col: str, item: str) -> DataFrame:
    """One row per array element, with the columns ``keep``.

    Same rows as ``explode``. That one makes Spark test the array for being empty in a filter of its
    own, which moves below the projection and computes the whole array expression a second time; the
    outer form with a test on the element does not.
    """
    return df.select(*keep, F.explode_outer(array_col).alias(item)).filter(
        F.col(item).isNotNull())


def lookup_join(facts: DataFrame, lookup: DataFrame, key: str, how: str = "inner",
                salts: int = 1) -> DataFrame:
    """Join ``facts`` with a ``lookup`` that has one row per ``key``.

    Without a hint: Spark broadcasts the lookup by its size in bytes, and else splits a key that
    holds a large part of ``facts`` at run time. With ``salts`` above 1 the lookup is repeated once
    per salt and joined on (key, salt), for clusters that run without adaptive execution.
    """
    if salts == 1:
        return facts.join(lookup, key, how)
    # The salt hangs on the row's content, not on chance, so that a re-run task repeats it.
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int"))
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")


def range_blocks(df: DataFrame, order_by: Sequence[Column], name: str) -> DataFrame:
    """Range-partition ``df`` by ``order_by`` and land it with its block number ``_block``.

    Blocks are ordered: all rows of block i sort before those of block i+1. Range bounds come from
    sampling, so the numbers are only usable once they are written down, hence the landing.
    """
    ranged = df.repartitionByRange(*order_by).withColumn("_block", F.spark_partition_id())
    return land(ranged, name)


def with_running_totals(blocks: DataFrame, order_by: Sequence[Column],
                        totals: dict[str, Column],
                        partition_by: Sequence[str] = ()) -> DataFrame:
    """Append inclusive running sums over the global order of :func:`range_blocks` output.

    ``totals`` maps a new column name to the bigint expression to sum. Two passes instead of one
    task for everything: sums per block, whose running sums (one row per block and partition key)
    are joined back as offsets, then a window inside each block. Meant for few partition keys, such
    as labels: the offsets are broadcast.
    """
    keys = ["_block", *partition_by]
    per_block = blocks.groupBy(*keys).agg(
        *[F.sum(value).alias(name) for name, value in totals.items()])
    before = (Window.partitionBy(*partition_by).orderBy("_block")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_block.select(
        *keys,
        *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(f"_before_{name}")
          for name in totals],
    )
    within = (Window.partitionBy(*keys).orderBy(*order_by)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    running = blocks.withColumns(
        {f"_within_{name}": F.sum(value).over(within) for name, value in totals.items()})
    # One offset row per block: as many as there were shuffle partitions.
    return running.join(F.broadcast(offsets), keys).select(
        *[c for c in blocks.columns if c != "_block"],
        *[(F.col(f"_before_{name}") + F.col(f"_within_{name}")).alias(name) for name in totals],
    )
