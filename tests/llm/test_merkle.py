import hashlib
import zlib

import pytest

from mailshape.llm import merkle
from mailshape.llm.queries import QUERIES


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """Levels of a ternary tree up to one node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h("".join(below[i:i + 3])) for i in range(0, len(below), 3)])
    return levels


def path(levels, at):
    steps = []
    for below in levels[:-1]:
        start = at - at % 3
        run = below[start:start + 3]
        steps.append((at % 3, "".join(run[:at % 3] + run[at % 3 + 1:])))
        at //= 3
    return steps


def brute(rows):
    """Expected result per row (in input order), rows as (doc_id, source, lang, n_chars, text)."""
    by = {}
    for i, r in enumerate(rows):
        by.setdefault(r[1], []).append(i)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    leaves = [leaf(r) for r in rows]
    inner = {}
    for s in sources:
        order = sorted(by[s], key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaves[i]))
        inner[s] = (order, tree([leaves[i] for i in order]))
    top = tree([inner[s][1][-1][0] for s in sources])
    made = {}
    for k, s in enumerate(sources):
        order, levels = inner[s]
        for at, i in enumerate(order):
            steps = path(levels, at) + path(top, k)
            d, text = rows[i][0], rows[i][4]
            if d is not None and text is not None and zlib.crc32(str(d).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = leaf((*rows[i][:4], text))
            for p, sibs in steps:
                folded = h(sibs[:64 * p] + folded + sibs[64 * p:])
            made[i] = (d, leaves[i], levels[-1][0], top[-1][0], h("".join(x for _, x in steps)),
                       folded, folded == top[-1][0])
    return [made[i] for i in range(len(rows))]


def frame(spark, rows):
    return spark.createDataFrame(
        rows, "doc_id long, source string, lang string, n_chars int, text string")


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda t: (t[0] is not None, t[0] or 0, t))


def check(spark, rows, levels):
    assert ordered(merkle.manifest(frame(spark, rows), levels).collect()) == ordered(brute(rows))


ROWS = ([(i, "big", "en", i % 7, f"line {i}\nnext") for i in range(40)]
        + [(100 + i, f"s{i % 5}", None, None, "a\nb" if i % 2 else None) for i in range(11)]
        + [(200, None, "de", 3, "x\ny"), (None, "big", "en", 1, "z\n"), (201, "Ünï", "fr", 0, ""),
           (7, "big", "en", 0, "line 7\nnext"), (7, "big", "en", 0, "line 7\nnext")])


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_equals_brute_force(spark, levels):
    check(spark, ROWS, levels)


def test_single_and_empty(spark):
    check(spark, [(5, "a", "en", 3, "a\nb")], 1)
    assert merkle.manifest(frame(spark, []), 1).count() == 0


def test_extra_columns_with_clashing_names(spark):
    rows = [(i, "s", "en", 1, f"t{i}\n", "x", 3) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, "
                                       "text string, key string, idx int")
    assert ordered(merkle.manifest(docs, 1).collect()) == ordered(brute([r[:5] for r in rows]))


def test_query_on_table(spark):
    got = QUERIES["op13_merkle_manifest"](spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select(*merkle.FIELDS).collect()]
    made = got.collect()
    assert ordered(made) == ordered(brute(rows))
    assert 0 < sum(not r.verified for r in made) < len(made)
