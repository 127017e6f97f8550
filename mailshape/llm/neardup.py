"""MinHash near-duplicate detection with sequential Bayesian verification.

Equal shingle sets are one class from the start. Classes that share a band of the signature are
candidates. A candidate pair's signatures are compared batch by batch; a pair leaves as soon as the
posterior chance that its similarity reaches the threshold falls below the miss probability; what is
left is checked on full sets. Each class is compared with one hub first; what is then still apart in a
bucket is compared in blocks, so a group of many copies does not make a row for each of its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from mailshape.llm.components import components
from mailshape.llm.shingles import mixed, shingle_set, slices
from mailshape.session import land

# Fixed threshold of the contract: 100 * intersection >= 75 * union.
PERCENT = 75
HASHES = 128
BAND_ROWS = 4
BATCH = 32
MISS_PROBABILITY = 1e-6
# Classes of a component held at once while others stream past.
BLOCK = 1024

_seeds = mixed(np.arange(1, 2 * HASHES + 1, dtype=np.uint64))
_FACTORS, _SHIFTS = _seeds[:HASHES] | np.uint64(1), _seeds[HASHES:]


def signature(found: np.ndarray) -> np.ndarray:
    """``HASHES`` upper halves of minima of multiply-add hashes over a non-empty set."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for first in range(0, len(found), 1024):
        block = np.multiply.outer(_FACTORS, found[first:first + 1024])
        block += _SHIFTS[:, None]
        np.minimum(least, block.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def posterior(matches: int, compared: int, threshold: float) -> float:
    """P(similarity >= threshold) after ``matches`` of ``compared`` with a uniform prior.

    The posterior is Beta(matches + 1, compared - matches + 1); its tail is a binomial sum.
    """
    n = compared + 1
    return math.fsum(math.comb(n, k) * threshold ** k * (1 - threshold) ** (n - k)
                     for k in range(matches + 1))


def least_matches(percent: int = PERCENT, miss: float = MISS_PROBABILITY) -> list[tuple[int, int]]:
    """Per batch end: hashes compared so far, and the fewest matches that keep a pair."""
    return [(n, next(m for m in range(n + 1) if posterior(m, n, percent / 100) >= miss))
            for n in range(BATCH, HASHES + 1, BATCH)]


def _profiles(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, hash, n, key, sig)`` per row: hash of the text, set size, 128-bit key of the set and
    signature (both null if it is empty)."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, keys, signatures = [], [], []
            for text in batch.column(2):
                found = shingle_set(text.as_py())
                sizes.append(len(found))
                keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                signatures.append(signature(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                 pa.array(keys, pa.binary()), pa.array(signatures, pa.binary())],
                ["id", "hash", "n", "key", "sig"])

    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"),
                       F.col(text_col).alias("t")).mapInArrow(
        profile, f"id {id_type}, hash bigint, n bigint, key binary, sig binary")


def _members(classes: DataFrame) -> DataFrame:
    """``(band, key)``: buckets with two or more classes."""
    width = 4 * BAND_ROWS
    bands = F.array(*[F.xxhash64(F.lit(i), F.substring("sig", i * width + 1, width))
                      for i in range(HASHES // BAND_ROWS)])
    rows = classes.select("key", F.explode(bands).alias("band"))
    many = rows.groupBy("band").agg(F.count("*").alias("_n")).filter("_n > 1").select("band")
    return rows.join(many, "band")


def _kept_by_posterior(pairs: DataFrame, classes: DataFrame, percent: int, miss: float) -> DataFrame:
    """Pairs ``(a, b)`` that no batch of their signatures rules out."""
    needed = least_matches(percent, miss)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u4")
                           .reshape(batch.num_rows, HASHES) for i in (2, 3))
            alive = np.arange(batch.num_rows)
            matches = np.zeros(batch.num_rows, dtype=np.int64)
            for end, least in needed:
                part = slice(end - BATCH, end)
                matches[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
                alive = alive[matches[alive] >= least]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).take(pa.array(alive)) for i in (0, 1)], ["a", "b"])

    return (pairs.join(classes.select(F.col("key").alias("a"), F.col("sig").alias("s")), "a")
            .join(classes.select(F.col("key").alias("b"), F.col("sig").alias("t")), "b")
            .select("a", "b", "s", "t").mapInArrow(compare, "a binary, b binary"))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            good = []
            for left, right in zip(batch.column(2), batch.column(3)):
                one, two = (np.frombuffer(x.as_py(), "<u8") for x in (left, right))
                common = len(np.intersect1d(one, two, assume_unique=True))
                good.append(100 * common >= percent * (len(one) + len(two) - common))
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).filter(mask) for i in (0, 1)], ["a", "b"])

    return (pairs.join(sets.select(F.col("key").alias("a"), F.col("set").alias("s")), "a")
            .join(sets.select(F.col("key").alias("b"), F.col("set").alias("t")), "b")
            .select("a", "b", "s", "t").mapInArrow(verify, "a binary, b binary"))


def _sets(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame) -> DataFrame:
    """``(key, set)``, once per class in ``wanted`` (``key``, ``id`` of one row, ``repeated``)."""
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw = [shingle_set(text.as_py()).tobytes() for text in batch.column(2)]
            # Of rows with the same id only those that have this very set count.
            mask = pa.array([xxhash.xxh3_128_digest(r) == k.as_py()
                             for r, k in zip(raw, batch.column(0))], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [x.filter(mask) for x in (batch.column(0), batch.column(1),
                                          pa.array(raw, pa.binary()))], ["key", "repeated", "set"])

    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
    filled = land(
        texts.join(wanted, texts["_id"].eqNullSafe(wanted["id"])).select("key", "repeated", "_t")
        .mapInArrow(fill, "key binary, repeated boolean, set binary"), "sets")
    again = filled.filter("repeated").groupBy("key").agg(F.first("set").alias("set"))
    return filled.filter("not repeated").select("key", "set").unionAll(again)


def _hub_pairs(members: DataFrame) -> DataFrame:
    """Each class with the smallest class of its buckets that it shares most buckets with."""
    hubs = members.groupBy("band").agg(F.min("key").alias("hub"))
    shared = (members.join(hubs, "band").filter("key <> hub").groupBy("hub", "key")
              .agg(F.count("*").alias("n")))
    return shared.groupBy(F.col("key").alias("b")).agg(
        F.max_by("hub", F.struct("n", "hub")).alias("a")).select("a", "b")


def _shared_counts(sets: DataFrame) -> DataFrame:
    """``(key, n, shared)``: a set's size, and how many of its shingles any other set has."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, raw in zip(batch.column(0), batch.column(1)):
                found = np.frombuffer(raw.as_py(), "<i8")
                high, low = np.frombuffer(key.as_py(), "<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), pa.array(np.full(len(found), high)),
                     pa.array(np.full(len(found), low))], ["s", "high", "low"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            halves = np.column_stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
            yield pa.RecordBatch.from_arrays(
                [pa.array([h.astype("<i8").tobytes() for h in halves], pa.binary()),
                 batch.column(2)], ["key", "own"])

    # A shingle of one set only is that set's own; counts are made before the shuffle.
    own = (sets.select("key", "set").mapInArrow(spread, "s bigint, high bigint, low bigint")
           .groupBy("s").agg(F.count("*").alias("n"), F.min("high").alias("high"),
                             F.min("low").alias("low"))
           .filter("n = 1").groupBy("high", "low").agg(F.count("*").alias("own"))
           .mapInArrow(whole, "key binary, own bigint"))
    return sets.select("key", (F.length("set") / 8).cast("bigint").alias("n")).join(
        own, "key", "left").select("key", "n", (F.col("n") - F.coalesce("own", F.lit(0)))
                                   .alias("shared"))


def _apart(state: DataFrame) -> DataFrame:
    """Rows of ``(band, key, root, ...)`` whose bucket has more than one root."""
    mixed_up = state.groupBy("band").agg(F.min("root").alias("_x"), F.max("root").alias("_y"))
    return state.join(mixed_up.filter("_x <> _y").select("band"), "band")


def _against_components(state: DataFrame, classes: DataFrame, sets: DataFrame, percent: int,
                        miss: float) -> DataFrame:
    """Links ``(a, b)`` of classes with other components of their buckets, at most one for each
    block of a component.

    A class is compared with all of a component's classes, in blocks of ``BLOCK``: the block is held,
    the classes stream past it. No pair becomes a row unless it is a link.
    """
    members = state.select("root", "key").distinct()
    sizes = members.groupBy("root").agg(F.count("*").alias("size"))
    state = state.join(sizes, "root")
    # The smaller component's classes go to the larger one, ties by name.
    targets = state.groupBy("band", F.col("root").alias("_root")).agg(
        F.first("size").alias("_size"), F.min("n").alias("_least"), F.max("shared").alias("_most"))
    # The same bound as for a bucket, for the sizes and shared shingles of the component there.
    common = F.least("shared", "_most")
    seekers = (state.join(targets, "band")
               .filter(F.struct("size", "root") < F.struct("_size", "_root"))
               .filter(100 * common >= percent * (
                   F.col("n") + F.greatest("_least", common) - common))
               .select("key", F.col("_root").alias("root"), F.col("_size").alias("size")).distinct())
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    held = members.join(sizes, "root").join(
        seekers.select("root").distinct(), "root").select(
            "root", F.pmod(F.xxhash64("key"), blocks).cast("int").alias("block"),
            F.lit(0).alias("side"), "key")
    passing = seekers.select("root", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"),
                             F.lit(1).alias("side"), "key")
    rows = held.unionAll(passing)
    full = sets.join(classes.select("key", "sig"), "key")
    needed = least_matches(percent, miss)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, keys, found, held_signatures, index = None, [], [], [], None

        def indexed():
            """The block's signatures, its shingles in order with their owners, and its sets' sizes."""
            every = np.concatenate(found)
            owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
            order = np.argsort(every, kind="stable")
            return (np.array(held_signatures), every[order], owner[order],
                    np.array([len(f) for f in found]))

        def links(sig, own):
            signatures, every, owner, sizes = index
            alive, matches = np.arange(len(keys)), np.zeros(len(keys), dtype=np.int64)
            for end, least in needed:
                part = slice(end - BATCH, end)
                matches[alive] += (signatures[alive, part] == sig[part]).sum(axis=1)
                alive = alive[matches[alive] >= least]
            if not len(alive):
                return None
            # Intersections with the whole block at once: each shingle's run of owners.
            first, last = (np.searchsorted(every, own, side) for side in ("left", "right"))
            runs = last - first
            at = np.repeat(first - np.concatenate([[0], np.cumsum(runs)[:-1]]), runs) \
                + np.arange(runs.sum())
            common = np.bincount(owner[at], minlength=len(keys))[alive]
            good = alive[100 * common >= percent * (sizes[alive] + len(own) - common)]
            return keys[good[0]] if len(good) else None

        for batch in slices(batches):
            a, b = [], []
            for root, block, side, key, sig, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if (root, block) != place:
                    place, keys, found, held_signatures = (root, block), [], [], []
                    index = None
                own, sig = np.frombuffer(raw, "<u8"), np.frombuffer(sig, "<u4")
                if side == 0:
                    keys.append(key)
                    found.append(own)
                    held_signatures.append(sig)
                elif keys:
                    if index is None:
                        index = indexed()
                    other = links(sig, own)
                    if other is not None:
                        a.append(min(key, other))
                        b.append(max(key, other))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    tasks = int(state.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.join(full, "key").select("root", "block", "side", "key", "sig", "set")
            .repartition(tasks, "root", "block").sortWithinPartitions("root", "block", "side")
            .mapInArrow(compare, "a binary, b binary"))


def link_classes(members: DataFrame, classes: DataFrame, sets: DataFrame, percent: int,
                 miss: float) -> DataFrame:
    """``(node, root)`` of classes that links reach: the candidates' exact components.

    First each class with one hub, which joins most of any group of copies. Then, in buckets whose
    classes are not all together, each class with the other components there. A class that cannot
    reach the threshold with anything of its bucket's sizes, as too few of its shingles occur in any
    other class, drops out before.
    """
    candidates = land(_kept_by_posterior(_hub_pairs(members), classes, percent, miss), "candidates")
    links = land(_linked(candidates, sets, percent), "found")
    roots = land(components(links), "roots")
    state = members.join(roots, members["key"] == roots["node"], "left").select(
        "band", "key", F.coalesce("root", "key").alias("root"))
    state = land(_apart(state), "apart")
    counts = land(_shared_counts(sets.join(state.select("key").distinct(), "key")), "shared")
    state = state.join(counts, "key")
    least = state.groupBy("band").agg(F.min("n").alias("least"))
    # Its intersection is at most `shared`, its union at least both sizes less that.
    state = state.join(least, "band").filter(
        100 * F.col("shared") >= percent * (
            F.col("n") + F.greatest("least", "shared") - F.col("shared")))
    state = land(_apart(state.select("band", "key", "root", "n", "shared")), "apart")
    more = land(_against_components(state, classes, sets, percent, miss), "found")
    return land(components(links.unionAll(more)), "roots")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = PERCENT, miss: float = MISS_PROBABILITY) -> DataFrame:
    """``(id, n_shingles, component_id, kept, text_hash, group)`` per row of ``docs``.

    ``component_id`` is the smallest id reachable over links of a Jaccard similarity of ``percent``
    or more. Texts without words have an empty set and are linked with nothing. Rows with the same id
    are documents of their own; a null id never names a component unless all its ids are null.
    ``kept`` is true where the id is the component's; ``text_hash`` is Spark's ``xxhash64`` of the
    text, ``group`` names the component whatever its ids, null without words. Other columns are not
    read.
    """
    profiles = land(_profiles(docs, id_col, text_col), "profiles")
    classes = land(profiles.filter("key is not null").groupBy("key").agg(
        F.min("id").alias("id"), F.first("sig").alias("sig")), "classes")
    members = land(_members(classes), "members")
    copies = profiles.groupBy("id", "key").agg(F.count("*").alias("_n")).filter("_n > 1")
    wanted = members.select("key").distinct().join(classes.select("key", "id"), "key").join(
        copies.select(F.col("key").alias("_key"), F.col("id").alias("_copy")),
        (F.col("key") == F.col("_key")) & F.col("id").eqNullSafe(F.col("_copy")), "left").select(
            "key", "id", F.col("_key").isNotNull().alias("repeated"))
    sets = _sets(docs, id_col, text_col, wanted)
    roots = link_classes(members, classes, sets, percent, miss)
    placed = classes.select("key", "id").join(roots, classes["key"] == roots["node"], "left").select(
        "key", "id", F.coalesce("root", "key").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("id").alias("component"))
    component = placed.join(smallest, "root").select(
        F.col("key").alias("_key"), "component", F.col("root").alias("group"))
    component = land(component, "components")
    return profiles.select("id", "hash", "n", "key").join(
        component, F.col("key") == F.col("_key"), "left").select(
            F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
            F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component"))
            .alias("component_id"), F.col("hash").alias("text_hash"), "group").withColumn(
                "kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   percent: int = PERCENT) -> DataFrame:
    """``docs`` with all its columns, one row of each component: one with the component's id.

    Of several texts with that id one is taken by its hash, of equal rows one; texts without words,
    linked with nothing, are groups by their id.
    """
    found = land(near_duplicates(docs, id_col, text_col, percent), "decisions")
    # Without words a row's group is its id.
    alone = F.when(F.col("group").isNull(), F.col(id_col))
    found = found.select(F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash"), "kept", "group",
                         alone.alias("_alone"))
    first = found.filter("kept").groupBy("group", "_alone").agg(F.min("_hash").alias("_first"))
    kept = found.filter("kept").join(
        first.select(F.col("group").alias("_g"), F.col("_alone").alias("_a"), "_first"),
        F.col("group").eqNullSafe(F.col("_g")) & F.col("_alone").eqNullSafe(F.col("_a")))
    lost = found.filter("not kept").select("_id", "_hash").unionAll(
        kept.filter("_hash <> _first").select("_id", "_hash")).distinct()
    again = land(found.groupBy("_id", "_hash").agg(F.count("*").alias("_n")).filter("_n > 1").select(
        F.col("_id").alias("_again"), F.col("_hash").alias("_again_hash")), "again")
    mark = docs.withColumn("_text_hash", F.xxhash64(text_col))
    stay = mark.join(lost, F.col(id_col).eqNullSafe(F.col("_id"))
                     & (F.col("_text_hash") == F.col("_hash")), "left_anti")
    if again.isEmpty():
        return stay.drop("_text_hash")
    # Some rows stand in the table more than once: one of each stays.
    same = F.col(id_col).eqNullSafe(F.col("_again")) & (F.col("_text_hash") == F.col("_again_hash"))
    single = stay.join(again, same, "left_anti")
    repeated = stay.join(again, same, "left_semi").dropDuplicates([id_col, "_text_hash"])
    return single.unionAll(repeated).drop("_text_hash")
