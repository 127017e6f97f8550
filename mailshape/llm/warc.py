"""Not-modified revisits of a web archive resolved to the response they stand for.

A revisit (status 304) is joined, as of its time and by canonical URL, to the latest earlier full
response. Validators decide whether it stands for that response; the headers that a not-modified
answer may change are merged into the response's. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from mailshape.session import land

# Fields that a not-modified answer sends in place of the stored ones.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
RESPONSE, REVISIT = "response", "revisit"


def canonical(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path without a final / or .html, query
    without tracking fields; no scheme, no fragment. Null where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.regexp_replace(F.substr(url, at + 3), r"#.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1)), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"(/|\.html?)$", "")
    query = F.array_join(F.array_sort(F.filter(
        F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&"),
        lambda f: (f != "") & ~f.rlike(r"^(utm_[a-z]+|ref|fbclid|gclid)="))), "&")
    whole = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(at > 0, whole)


def plain_headers(headers: Column) -> Column:
    """Names in lower case; of a repeated name the last value; null counts as none."""
    entries = F.map_entries(headers)
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    values = F.transform(names, lambda n: F.element_at(
        F.filter(entries, lambda e: F.lower(e["key"]) == n), -1)["value"])
    return F.coalesce(F.map_from_arrays(names, values), F.create_map().cast("map<string,string>"))


def _tag(value: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.nullif(F.regexp_replace(F.trim(value), r"^W/", ""), F.lit(""))


def verdict(revisit: Column, response: Column, found: Column) -> Column:
    """``resolved``, ``no_response``, ``changed`` (a validator differs) or ``unverified`` (no validator
    that both have). Entity tags, compared weakly, come before dates."""
    tags = _tag(revisit["etag"]), _tag(response["etag"])
    dates = F.trim(revisit["last-modified"]), F.trim(response["last-modified"])
    both_tags = tags[0].isNotNull() & tags[1].isNotNull()
    both_dates = dates[0].isNotNull() & dates[1].isNotNull()
    same = F.when(both_tags, tags[0] == tags[1]).when(both_dates, dates[0] == dates[1])
    return F.when(~found, "no_response").when(same.isNull(), "unverified").when(
        same, "resolved").otherwise("changed")


def resolve_revisits(records: DataFrame, id_col: str = "record_id", url_col: str = "url",
                     time_col: str = "time", kind_col: str = "kind",
                     headers_col: str = "headers") -> DataFrame:
    """One row per revisit: ``(id, url_key, time, response_id, response_time, verdict, headers)``.

    A revisit sees responses of its canonical URL with an earlier (time, id). ``headers`` are the
    response's with the permitted ones of the revisit, if it is resolved, else the revisit's own.
    Revisits without a usable URL or time have no response; records of other kinds and responses
    without a time are passed over; repeated rows stay; other columns are not read.

    Records are dealt out in blocks by (URL, time), so a URL with most of the records fills many
    blocks. In a block a window finds the latest response; before the first one there, the last
    response of the URL's earlier blocks counts, found among one row per URL and block.
    """
    rows = records.filter(F.col(kind_col).isin(RESPONSE, REVISIT)).select(
        F.col(id_col).alias("id"), canonical(F.col(url_col)).alias("key"), F.col(time_col).alias("t"),
        (F.col(kind_col) == RESPONSE).alias("full"), plain_headers(F.col(headers_col)).alias("h"))
    rows = rows.filter("not full or (key is not null and t is not null)")
    usable = rows.filter("key is not null and t is not null")
    # Bounds come from a sample, so block numbers hold only once they are written.
    blocks = land(usable.repartitionByRange("key", "t", "id").withColumn(
        "b", F.spark_partition_id()), "records")
    response = F.when(F.col("full"), F.struct("t", "id", "h"))
    within = Window.partitionBy("b", "key").orderBy("t", "id", F.col("full")).rowsBetween(
        Window.unboundedPreceding, -1)
    seen = blocks.withColumn("r", F.last(response, ignorenulls=True).over(within)).filter("not full")
    ends = blocks.filter("full").groupBy("key", "b").agg(
        F.max_by(F.struct("t", "id", "h"), F.struct("t", "id")).alias("e"))
    spans = seen.filter("r is null").select("key", "b").distinct()
    before = Window.partitionBy("key").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    carried = (ends.join(spans, ["key", "b"], "full").withColumn(
        "c", F.last("e", ignorenulls=True).over(before)).filter("c is not null")
        .select(F.col("key").alias("_key"), F.col("b").alias("_b"), "c"))
    found = seen.join(carried, (F.col("key") == F.col("_key")) & (F.col("b") == F.col("_b")), "left")
    found = found.select("id", "key", "t", "h", F.coalesce("r", "c").alias("r"))
    missing = rows.filter("key is null or t is null").select(
        "id", "key", "t", "h", F.lit(None).cast(found.schema["r"].dataType).alias("r"))
    found = found.unionAll(missing)
    judged = found.withColumn("v", verdict(F.col("h"), F.col("r.h"), F.col("r").isNotNull()))
    fresh = F.map_filter("h", lambda k, _: k.isin(PERMITTED))
    merged = F.map_zip_with(F.col("r.h"), fresh, lambda _, old, new: F.coalesce(new, old))
    return judged.select(
        F.col("id").alias(id_col), F.col("key").alias("url_key"), F.col("t").alias(time_col),
        F.col("r.id").alias("response_id"), F.col("r.t").alias("response_time"),
        F.col("v").alias("verdict"),
        F.when(F.col("v") == "resolved", merged).otherwise(F.col("h")).alias("headers"))


def header_lines(headers: Column) -> Column:
    """Headers as ``name: value`` lines in order of their names."""
    return F.array_join(F.array_sort(F.transform(
        F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), "\n")


def captures(pages: DataFrame) -> DataFrame:
    """Archive records of pages: each is fetched in full at twice its id, and asked for again up to
    two hundred ticks later, with the tag of its own text, which is answered by not-modified.

    Other pages of the same canonical URL may have been fetched in between.
    """
    tag = F.concat(F.lit('"'), F.substring(F.md5("html"), 1, 12), F.lit('"'))
    full = pages.select(
        (2 * F.col("page_id")).alias("record_id"), "url", (2 * F.col("page_id")).alias("time"),
        F.lit(RESPONSE).alias("kind"), F.create_map(
            F.lit("Content-Type"), F.lit("text/html"), F.lit("ETag"), tag,
            F.lit("Content-Length"), F.length("html").cast("string"),
            F.lit("Date"), (2 * F.col("page_id")).cast("string")).alias("headers"))
    later = 2 * F.col("page_id") + 1 + 2 * (37 * F.col("page_id") % 100)
    again = pages.select(
        (2 * F.col("page_id") + 1).alias("record_id"), "url", later.alias("time"),
        F.lit(REVISIT).alias("kind"), F.create_map(
            F.lit("etag"), F.concat(F.lit("W/"), tag), F.lit("Date"), later.cast("string"),
            F.lit("Content-Length"), F.lit("0"), F.lit("Cache-Control"), F.lit("max-age=60"))
        .alias("headers"))
    return full.unionAll(again)
