import math
import zlib
from collections import Counter

import numpy as np
import pytest

from mailshape.llm import gru, lm
from mailshape.llm.queries import op1_lm_scoring

SCHEMA = "doc_id bigint, text string, score string"


def tiny(seed=0, dtype=np.float64):
    counts = np.array([9.0, 5, 4, 3, 2, 2, 1, 1])
    classes = gru.Classes.by_frequency(counts, 3, 2)
    p = {k: v.astype(dtype) for k, v in gru.initial(counts, classes, 4, seed).items()}
    rng = np.random.default_rng(seed)
    for k in ("c", "w"):
        p[k] = rng.normal(size=p[k].shape).astype(dtype) * 0.5
    return p, classes


def test_gradient_by_differences():
    p, classes = tiny()
    rng = np.random.default_rng(1)
    inputs, targets = rng.integers(0, 8, (5, 3)), rng.integers(0, 8, (5, 3))
    starts = rng.random((5, 3)) < 0.3
    live = rng.random((5, 3)) < 0.9
    h = rng.normal(size=(3, 4))
    loss, grad, _ = gru.window_gradient(p, classes, h, inputs, starts, targets, live)
    for k, g in grad.items():
        full = np.zeros_like(p[k])
        if isinstance(g, tuple):
            full[g[0]] = g[1]
        else:
            full = g
        for i in rng.choice(p[k].size, min(12, p[k].size), replace=False):
            at = np.unravel_index(i, p[k].shape)
            p[k][at] += 1e-6
            up = gru.window_gradient(p, classes, h, inputs, starts, targets, live)[0]
            p[k][at] -= 2e-6
            down = gru.window_gradient(p, classes, h, inputs, starts, targets, live)[0]
            p[k][at] += 1e-6
            assert full[at] == pytest.approx((up - down) / 2e-6, abs=1e-4)


def one_by_one(p, classes, text):
    """Likelihood of one text without lanes or windows; checks that chances sum to one."""
    h, before, total = np.zeros((1, p["u"].shape[0]), dtype=p["u"].dtype), gru.END, 0.0
    for symbol in text:
        h = gru._step(p, p["x"][[before]], h)[0]
        every = np.exp(gru.log_chances(p, classes, np.repeat(h, 8, axis=0), np.arange(8)))
        assert every.sum() == pytest.approx(1, abs=1e-5)
        total += math.log(every[symbol])
        before = symbol
    return total


def test_lanes_and_windows_carry_the_state(monkeypatch):
    p, classes = tiny(3)
    rng = np.random.default_rng(2)
    texts = [np.append(rng.integers(1, 8, n), 0).astype(np.int32) for n in (0, 30, 3, 7, 12, 1)]
    monkeypatch.setattr(gru, "SCORE_WINDOW", 4)
    for width in (1, 2, 256):
        made = gru.score(p, classes, texts, width)
        assert made == pytest.approx([one_by_one(p, classes, t) for t in texts], abs=1e-4)


def test_training_lowers_the_loss():
    p, classes = tiny(dtype=np.float32)
    texts = [np.array([1, 2, 3, 4] * 6 + [0], dtype=np.int32)] * 40
    before = -gru.score(p, classes, texts).sum()
    gru.train(p, classes, texts, gru.AdaGrad(p, 0.2), width=8)
    assert -gru.score(p, classes, texts).sum() < 0.5 * before


def by_hand(rows):
    """Base scores by definition."""
    training = [lm.words(t) for i, t in rows if zlib.crc32(str(i or "").encode()) % 5 != 1]
    counts = Counter(w for ws in training for w in ws)
    counts["end"] = len(training)
    if not training:
        del counts["end"]
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        tokens = [*lm.words(t), "end"]
        out.append((i, zlib.crc32(str(i or "").encode()) % 5 == 1, len(tokens),
                    sum(counts[w] > 0 for w in tokens), n,
                    sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)))
    return out


@pytest.mark.parametrize("sizes", [(10_000, 9000), (40, 8), (2, 1)])
def test_odd_rows_and_small_lexicons(spark, sizes):
    rng = np.random.default_rng(0)
    rows = [(i, " ".join("W%d" % k for k in rng.zipf(1.3, 40) if k < 500)) for i in range(60)]
    rows += [(70, None), (71, ""), (72, " \n"), (73, "é. Ñandú x9 a, ZZ!"), (75, "unseen words " * 2000)]
    rows += [(0, "twice"), (None, "no id")]
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA).repartition(3)
    out = lm.score_documents(frame, lexicon=sizes[0], head=sizes[1], one_in=1).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    for mine, want in zip(sorted(map(tuple, out), key=key), sorted(by_hand(rows), key=key)):
        assert mine[:5] == want[:5]
        assert mine[5] == pytest.approx(want[5], rel=1e-9)
        assert math.isfinite(mine[6]) and mine[6] < 0


def test_all_training_documents_are_learnt_from(spark, monkeypatch):
    frame = spark.createDataFrame([(i, "w%d x" % i, "x") for i in range(300)], SCHEMA).repartition(3)
    training = frame.filter(~lm.held_out("doc_id"))
    lexicon = lm.build_lexicon(lm.token_counts(training))
    plain, rounds = type(frame).coalesce, []

    def noted(self, n):
        rounds.append([r[0] for r in self.collect()])
        return plain(self, n)

    monkeypatch.setattr(type(frame), "coalesce", noted)
    lm.train(training, lexicon)
    assert sorted(t for r in rounds for t in r) == sorted(r.text for r in training.collect())
    assert len(rounds) == lm.ROUNDS and all(rounds)


def test_empty_table(spark):
    assert lm.score_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet")
            .select("doc_id", "text").collect()]
    out = {r.doc_id: r for r in op1_lm_scoring(spark, folder).collect()}
    held = base = 0.0
    for i, held_out, n, known, train, score in by_hand(rows):
        r = out[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held_out, n, known, train)
        assert r.base_score == pytest.approx(score, rel=1e-9)
        if held_out:
            held, base = held + r.score, base + score
    assert held > base  # the recurrent model beats the counts on texts it has not seen
    print("held out, log10:", held, base)
