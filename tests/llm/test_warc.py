import random

from pyspark.sql import functions as F

from mailshape.llm import warc

SCHEMA = ("record_id bigint, url string, time bigint, kind string, headers map<string,string>, "
          "verdict string")


def brute(records):
    """Revisits by a scan over all responses."""
    out = []
    for rid, key, time, kind, headers in records:
        if kind != "revisit":
            continue
        headers = {k.lower(): v for k, v in (headers or {}).items()}
        full = [r for r in records if r[3] == "response" and key is not None and r[1] == key
                and time is not None and r[2] is not None
                and (r[2], r[0], True) < (time, rid, False) and (r[2], r[0]) < (time, rid)]
        if not full:
            out.append((rid, None, "no_response", headers))
            continue
        best = max(full, key=lambda r: (r[2], r[0]))
        stored = {k.lower(): v for k, v in (best[4] or {}).items()}
        tags = [(h.get("etag") or "").strip().removeprefix("W/") or None for h in (headers, stored)]
        dates = [h["last-modified"].strip() if h.get("last-modified") else None
                 for h in (headers, stored)]
        same = tags[0] == tags[1] if all(tags) else dates[0] == dates[1] if all(dates) else None
        verdict = {None: "unverified", True: "resolved", False: "changed"}[same]
        if same:
            stored.update({k: v for k, v in headers.items() if k in warc.PERMITTED})
            headers = stored
        out.append((rid, best[0], verdict, headers))
    return out


def run(spark, records, partitions=4):
    frame = spark.createDataFrame(
        [(i, u, t, k, h, "x") for i, u, t, k, h in records], SCHEMA).repartition(partitions)
    return [(r.record_id, r.response_id, r.verdict, r.headers)
            for r in warc.resolve_revisits(frame).collect()]


def order(rows):
    return sorted(((i, f, v, tuple(sorted(h.items()))) for i, f, v, h in rows), key=str)


def test_against_scan_with_a_hot_url(spark):
    rng = random.Random(4)
    records = []
    for i in range(400):
        url = "http://a.org/hot" if rng.random() < 0.5 else "http://b.org/%d" % rng.randrange(9)
        headers = {"ETag": rng.choice(['"1"', 'W/"1"', '"2"', "", None]), "X": str(i), "Vary": str(i),
                   "Last-Modified": rng.choice(["mon", " mon", "tue", None])}
        headers = {k: v for k, v in headers.items() if v is not None}
        kind = rng.choice(["response", "revisit", "revisit", "request"])
        records.append((i, url, rng.randrange(150), kind, headers))
    records += [(500, None, 3, "revisit", {}), (501, "no scheme", 3, "revisit", None),
                (502, "http://a.org/hot", None, "revisit", {"ETag": '"1"'}),
                (503, "http://a.org/hot", None, "response", {"ETag": '"1"'}),
                (504, "http://new.org/", 9, "revisit", {"A": "b"})]
    keyed = [(i, u.removeprefix("http://").removesuffix("/") if u and "://" in u else None, t, k, h)
             for i, u, t, k, h in records]
    assert order(run(spark, records)) == order(brute(keyed))


def test_repeated_rows_stay(spark):
    records = [(1, "http://a.org/", 1, "response", {"ETag": '"1"', "etag": '"0"'})] * 2 + [
        (2, "HTTPS://www.A.org:443/?utm_source=x#top", 5, "revisit", {"etag": '"0"'})] * 3
    found = run(spark, records)
    assert len(found) == 3 and {(f, v) for _, f, v, _ in found} == {(1, "resolved")}


def test_empty_table(spark):
    assert run(spark, []) == []


def test_canonical_urls(spark):
    cases = {"http://X.org/a/": "x.org/a", "https://www.x.org:443/a.html#t": "x.org/a",
             "http://x.org?b=2&a=1&utm_source=z": "x.org?a=1&b=2", "no": None, None: None,
             "http://": ""}
    rows = spark.createDataFrame([(u,) for u in cases], "u string").select(
        "u", warc.canonical(F.col("u")).alias("c")).collect()
    assert {r.u: r.c for r in rows} == cases
