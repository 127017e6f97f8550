"""Merkle manifest of a document table: ternary hash trees per source, then over the sources.

Hashes are lowercase hex SHA-256; an inner node is the hash of its children's hex digests written
one after another. A level's nodes are taken three at a time in order, the last run possibly
shorter (a lone node is hashed alone); levels are built while more than one node remains.

Method: cogrouped subtree exchange. Leaves are numbered per source by a range split (no task holds
a whole source). A superblock is ``SPAN = 3**LEVELS`` consecutive nodes of one key; its subtree is
reduced in one ``applyInPandas`` group, and superblock roots are the next round's nodes, so a
source of any size takes ``log(n) / log(SPAN)`` rounds. Going down, every superblock is cogrouped
with the one row of outer nodes it needs (siblings of its root on the way to the root), and the
group finishes together: local reduction again, joining of local and outer proof, and folding of
each leaf's (possibly tampered) digest up to the root.

Edge cases: a null field is written ``-`` in the leaf; a null ``doc_id`` sorts first and is never
tampered; a null source is a source of its own, first among sources; repeated rows are separate
leaves (ties by the leaf digest, which then agree); a single document is its own subroot and root,
with the hash of the empty text as proof; an empty table gives no rows. Very long texts are hashed
in the JVM and never reach Python. Only the five named columns are read; other columns, of any
name, are not carried.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from mailshape.session import land

LEVELS = 8
SPAN = 3 ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# One key for the tree over the sources.
ALL = "*"

NODES = "key string, sb long, n long, digest string, top boolean, source string"
PATHS = "key string, idx long, pos array<int>, sibs array<string>, subroot string, root string"
LEAVES = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
          "folded_root string, verified boolean")


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(*fields: Column) -> Column:
    """Leaf of the given fields: each ``-`` if null, else its UTF-8 byte count, ``:`` and value."""
    parts = []
    for c in fields:
        value = c.cast("string")
        parts.append(F.when(value.isNull(), F.lit("-"))
                     .otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def tampered_text(doc_id: Column, text: Column) -> Column:
    """``text`` without its ``\\n`` where 2 divides the unsigned crc32 of the decimal ``doc_id``."""
    hit = (F.crc32(doc_id.cast("string").cast("binary")) % 2) == 0
    return F.when(hit, F.regexp_replace(text, "\n", "")).otherwise(text)


def _height(n: int) -> int:
    """Levels from ``n`` nodes to one."""
    levels = 0
    while n > 1:
        n, levels = -(-n // 3), levels + 1
    return levels


def _levels(digests: list[str], height: int) -> list[list[str]]:
    made = [digests]
    for _ in range(height):
        below = made[-1]
        made.append([_h("".join(below[i:i + 3])) for i in range(0, len(below), 3)])
    return made


def _local(n: int, levels: int) -> int:
    return levels if n > 3 ** levels else _height(n)


def _reduce(levels: int, members: pd.DataFrame) -> pd.DataFrame:
    """Root of one superblock; ``top`` where it is the root of its key."""
    members = members.sort_values("idx")
    n = int(members["n"].iloc[0])
    root = _levels(members["digest"].tolist(), _local(n, levels))[-1][0]
    return pd.DataFrame({"key": [members["key"].iloc[0]], "sb": [int(members["sb"].iloc[0])],
                         "n": [n], "digest": [root], "top": [n <= 3 ** levels],
                         "source": [members["source"].iloc[0]]})


def _paths(span: int, members: pd.DataFrame, outer: pd.DataFrame):
    """Per member: siblings by level (position, their digests in a row), through the outer path."""
    n = int(members["n"].iloc[0])
    levels = _levels(members["digest"].tolist(), _local(n, _height(span)))
    own = levels[-1][0]
    if len(outer):
        o = outer.iloc[0]
        up_pos, up_sibs = list(o["pos"]), list(o["sibs"])
        subroot = own if n <= span else o["subroot"]
        root = o["root"]
    else:  # The top of the tree over the sources.
        up_pos, up_sibs, subroot, root = [], [], own, own
    for at in range(len(members)):
        pos, sibs = [], []
        for below in levels[:-1]:
            start = at - at % 3
            run = below[start:start + 3]
            pos.append(at % 3)
            sibs.append("".join(run[:at % 3] + run[at % 3 + 1:]))
            at //= 3
        yield pos + up_pos, sibs + up_sibs, subroot, root


def _fold(digest: str, pos: list[int], sibs: list[str]) -> str:
    for p, s in zip(pos, sibs):
        digest = _h(s[:64 * p] + digest + s[64 * p:])
    return digest


def _down(span: int, members: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    if not len(members):
        return pd.DataFrame({c: [] for c in ("key", "idx", "pos", "sibs", "subroot", "root")})
    members = members.sort_values("idx")
    made = list(_paths(span, members, outer))
    return pd.DataFrame({
        "key": members["key"].tolist(), "idx": members["idx"].tolist(),
        "pos": [m[0] for m in made], "sibs": [m[1] for m in made],
        "subroot": [m[2] for m in made], "root": [m[3] for m in made]})


def _finish(span: int, members: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    members = members.sort_values("idx")
    rows = []
    paths = _paths(span, members, outer) if len(members) else []
    for (pos, sibs, subroot, root), leaf, tampered, doc_id in zip(
            paths, members["digest"], members["tampered"], members["doc_id"]):
        folded = _fold(tampered, pos, sibs)
        rows.append((doc_id, leaf, subroot, root, _h("".join(sibs)), folded, folded == root))
    made = pd.DataFrame(rows, columns=["doc_id", "leaf", "subroot", "root", "proof_sha256",
                                       "folded_root", "verified"])
    made["doc_id"] = made["doc_id"].astype("Int64")
    return made


def _ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Rows with ``idx`` (from 0, by ``order`` within ``key``) and ``n`` (rows of the key).

    A range split deals the rows out by (key, order); counts per split and key give offsets, so a
    key of any size lies over many tasks.
    """
    spread = land(rows.repartitionByRange(F.col("key"), *order)
                  .withColumn("_part", F.spark_partition_id()), "merkle-spread")
    by = ["_part", "key"]
    sizes = spread.groupBy(*by).agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy("key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*by, F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"),
                         F.sum("_c").over(Window.partitionBy("key")).alias("n"))
    number = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1
    return (spread.withColumn("_at", number).join(sizes, by)
            .withColumn("idx", F.col("_off") + F.col("_at")).drop("_part", "_off", "_at"))


def _up(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of nodes from the given ones up to each key's top, and the tops with their round."""
    rounds, tops, r = [], [], 0
    while True:
        rounds.append(nodes)
        reduced = land(nodes.select("key", "idx", "n", "digest", "source")
                       .withColumn("sb", F.floor(F.col("idx") / 3 ** levels))
                       .groupBy("key", "sb").applyInPandas(lambda m: _reduce(levels, m), NODES),
                       "merkle-up")
        tops.append(reduced.filter("top").withColumn("round", F.lit(r)))
        nodes = reduced.filter(~F.col("top")).select(
            "key", F.col("sb").alias("idx"), F.ceil(F.col("n") / 3 ** levels).alias("n"), "digest",
            "source")
        r += 1
        if nodes.isEmpty():
            break
    made = tops[0]
    for t in tops[1:]:
        made = made.unionByName(t)
    return rounds, made


def _down_rounds(rounds: list[DataFrame], outer_top: DataFrame | None, last, span: int) -> DataFrame:
    """Paths of the members of the first round, from the top round down; ``last`` finishes it."""
    spark = rounds[0].sparkSession
    below = spark.createDataFrame([], PATHS)
    for r in range(len(rounds) - 1, -1, -1):
        outer = below.withColumnRenamed("idx", "sb")
        if outer_top is not None:
            outer = outer.unionByName(outer_top.filter(F.col("round") == r).drop("round"))
        members = rounds[r].withColumn("sb", F.floor(F.col("idx") / span))
        grouped = members.groupBy("key", "sb").cogroup(outer.groupBy("key", "sb"))
        if r == 0:
            return grouped.applyInPandas(lambda m, o: last(span, m, o),
                                         LEAVES if last is _finish else PATHS)
        below = land(grouped.applyInPandas(lambda m, o: _down(span, m, o), PATHS), "merkle-down")
    raise AssertionError("no rounds")


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``proof_sha256`` hashes the siblings of the leaf's path, level by level to the subroot and on to
    the root, left to right; ``folded_root`` folds the tampered leaf (:func:`tampered_text`) with the
    original siblings, and ``verified`` says whether it equals ``root``. ``levels``: tree levels
    reduced in one group (a superblock holds ``3 ** levels`` nodes).
    """
    d = docs.select(*[F.col(f"`{f}`") for f in FIELDS])
    cols = [F.col(f) for f in FIELDS]
    tampered = [tampered_text(F.col("doc_id"), F.col("text")) if f == "text" else F.col(f)
                for f in FIELDS]
    leaves = d.select(
        F.coalesce(F.concat(F.lit("v"), F.col("source")), F.lit("n")).alias("key"),
        "doc_id", "source", leaf_digest(*cols).alias("digest"),
        leaf_digest(*tampered).alias("tampered"))
    leaves = _ranked(leaves, [F.col("doc_id").asc_nulls_first(), F.col("digest")])
    rounds, tops = _up(land(leaves, "merkle-leaves"), levels)
    subroots = land(_ranked(tops.select(F.lit(ALL).alias("key"), "digest", "source",
                                   F.col("key").alias("of"), "round"),
                    [F.col("source").asc_nulls_first()]), "merkle-subroots")
    top_rounds, _ = _up(subroots, levels)
    over_sources = land(_down_rounds(top_rounds, None, _down, 3 ** levels), "merkle-top")
    # A source's top group is cogrouped with its subroot's path in the tree over the sources.
    outer_top = over_sources.join(
        subroots.select("idx", "of", "round").withColumn("key", F.lit(ALL)), ["key", "idx"]).select(
        F.col("of").alias("key"), F.lit(0).cast("long").alias("sb"), "pos", "sibs",
        F.lit(None).cast("string").alias("subroot"), "root", "round")
    return _down_rounds(rounds, outer_top, _finish, 3 ** levels)
