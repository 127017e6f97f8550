"""URL filters: a blocked Bloom filter of listed canonical URLs before an exact hash join.

The list holds rules, that is URL prefixes ``host/path`` with a verdict, and single blocked URLs in
canonical form. A page's candidate keys are its canonical URL, and its host and parent domains each
with the path prefixes whose lengths occur in the rules. The filter lets through what may be listed;
only that is exploded, shuffled and joined. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mailshape.session import land

# The given rules, host and path.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BITS_PER_KEY = 16
PROBES = 5
# The filter never has more words of 64 bits than this (8 MB); beyond it the exact join has more to do.
MAX_BLOCKS = 1 << 20


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _UPPER.lower())
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def canonical_url(host: Column, path: Column) -> Column:
    """Key of a single URL: no scheme, query, fragment, ``www.`` or ``m.``, no final / or .html."""
    return F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), F.lit(" ="),
                    F.regexp_replace(path, r"(/|\.html?)$", ""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _mask(key: Column) -> Column:
    """The bits of a key in its block's word: ``PROBES`` fields of six bits of a second hash."""
    hashed = F.xxhash64(F.lit("bits"), key)
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(
        hashed, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(PROBES)]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return mask


def bloom_words(keys: DataFrame, blocks: int) -> DataFrame:
    """One row with the filter, an array of ``blocks`` words, for the column ``key``."""
    words = keys.groupBy(_block(F.col("key"), blocks).alias("b")).agg(
        F.bit_or(_mask(F.col("key"))).alias("m"))
    every = keys.sparkSession.range(blocks).select(F.col("id").cast("int").alias("b"))
    return every.join(words, "b", "left").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("b", F.coalesce("m", F.lit(0).cast("bigint"))
                                             .alias("m")))), lambda x: x["m"]).alias("words"))


def canonical_rules(rules: DataFrame) -> DataFrame:
    """Distinct, usable entries as ``(host, path, rule, verdict, key)``.

    Hosts are lower-cased; entries with a null or empty host, a null verdict or no leading ``/``
    in the path are left out. Of entries that differ in the verdict only, ``block`` stays.
    """
    host = F.translate("host", _UPPER, _UPPER.lower())
    return (rules.select(host.alias("host"), "path", "verdict")
            .filter("host <> '' and path like '/%' and verdict is not null")
            .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
            .select("host", "path", "verdict", F.concat("host", "path").alias("rule"),
                    F.concat("host", F.lit(" "), "path").alias("key")))


def listed_keys(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Distinct canonical keys of ``urls``; those without a host are left out."""
    host, path = url_parts(F.col(url_col))
    return (urls.select(host.alias("host"), path.alias("path")).filter("host <> ''")
            .select(canonical_url(F.col("host"), F.col("path")).alias("key")).distinct())


def filter_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame | None = None,
                id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(id, host, path, rule, verdict, listed)`` per row of ``pages``.

    ``rules`` has host, path and verdict (``allow`` or ``block``), ``listed`` blocked URLs in
    ``url_col``. The longest fitting rule wins, of equally long ones that with the longer host.
    Pages that no rule fits, among them those with a null or relative URL, have a null rule; they
    are blocked if their canonical URL is listed, else allowed. Repeated rows stay, other columns
    are not read, an empty list allows everything. Only distinct (host, path) pairs that pass the
    filter are joined; a pair that many pages share is split by adaptive execution.
    """
    spark = pages.sparkSession
    entries = canonical_rules(rules).withColumn("ruled", F.lit(True))
    if listed is not None:
        entries = entries.unionByName(listed_keys(listed, url_col).withColumn(
            "ruled", F.lit(False)), allowMissingColumns=True)
    entries = land(entries, "url-list")
    # A few bounded figures: number of entries, most labels of a host, lengths of paths in rules.
    shape = entries.agg(
        F.count("*").alias("n"), F.max(F.size(F.split("host", r"\."))).alias("labels"),
        F.collect_set(F.length("path")).alias("lengths")).first()
    blocks = 1
    while blocks < min(shape["n"] * BITS_PER_KEY / 64, MAX_BLOCKS):
        blocks *= 2
    words = bloom_words(entries, blocks).scalar()
    host, path = url_parts(F.col(url_col))
    parsed = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    labels = F.split("host", r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(shape["labels"] or 1))),
        lambda k: F.array_join(F.slice(labels, -k, k), "."))
    lengths = F.array(*[F.lit(n) for n in sorted(shape["lengths"])]).cast("array<int>")
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.length("path")),
                           lambda n: F.substring(F.col("path"), F.lit(1), n))
    keys = F.array_append(
        F.flatten(F.transform(domains, lambda d: F.transform(
            prefixes, lambda p: F.concat(d, F.lit(" "), p)))),
        canonical_url(F.col("host"), F.col("path")))
    # One row per candidate key, dropped before the shuffle unless the filter knows it.
    candidates = (parsed.select("host", "path", F.explode(keys).alias("key"))
                  .filter(F.get(words, _block(F.col("key"), blocks)).bitwiseAND(
                      _mask(F.col("key"))) == _mask(F.col("key"))).distinct())
    best = F.max(F.when(F.col("ruled"), F.struct(
        F.length("rule").alias("size"), "_long", "rule", "verdict")))
    hits = (candidates.join(entries.select("key", "rule", "verdict", "ruled",
                                           F.length("host").alias("_long")), "key")
            .groupBy(F.col("host").alias("_host"), F.col("path").alias("_path"))
            .agg(best.alias("_best"), F.bool_or(~F.col("ruled")).alias("_listed")))
    joined = parsed.join(hits, (F.col("host") == F.col("_host"))
                         & (F.col("path") == F.col("_path")), "left")
    in_list = F.coalesce("_listed", F.lit(False))
    return joined.select(
        id_col, "host", "path", F.col("_best.rule").alias("rule"),
        F.coalesce(F.col("_best.verdict"), F.when(in_list, "block").otherwise("allow"))
        .alias("verdict"), in_list.alias("listed"))


def rule_table(spark, rules=RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")
