"""Operators 2 and 9 against brute force."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm_fixtures import make  # noqa: F401
from shoplens.llm import mixing as M
from shoplens.llm import ngram_lm as N
from shoplens.llm.common import held_out


def brute_lm(rows, min_share):
    cut = lambda t: [*(t or "").encode().lower().split(), b""]
    train = [cut(t) for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 5 != 1]
    c = Counter(w for d in train for w in d)
    n, v = sum(c.values()), len(c)
    freq = {w for w in c if w and c[w] >= n * min_share}
    bi = Counter((a, b) for d in train for a, b in zip(d, d[1:]) if a in freq and b in freq)
    disc = lambda xs: (lambda o, t: min(0.9, max(0.1, o / (o + 2 * t))) if o + t else 0.5)(sum(x == 1 for x in xs), sum(x == 2 for x in xs))
    d1, d2 = disc(list(c.values())), disc(list(bi.values()))
    mass, kinds = Counter(), Counter()
    for (a, _), k in bi.items():
        mass[a] += k
        kinds[a] += 1
    p1 = lambda w: (c[w] - d1) / n if c[w] else d1 * v / n

    def p(prev, w):
        if prev not in freq:
            return p1(w)
        left = 1 - (mass[prev] - d2 * kinds[prev]) / c[prev] if mass[prev] else 1
        return (bi[prev, w] - d2 if bi[prev, w] else 0) / c[prev] + left * p1(w)

    out = []
    for i, t in rows:
        d = cut(t)
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in d)
        score = sum(math.log10(p(prev, w)) for prev, w in zip([None, *d], d)) if n else 0.0
        out.append((i, len(d), sum(c[w] > 0 for w in d), n, base, score))
    return out


LM_ROWS = [(i, f"the Cat sat on the mat {i} the cat ran\tand the dog {i % 3} sat") for i in range(40)]
LM_ROWS += [(50, None), (51, ""), (52, "é È the"), (53, "the cat " * 20_000), (3, LM_ROWS[3][1]), (None, "the end"), (None, None)]


@pytest.mark.parametrize("min_share", [1e-4, 0.05, 2.0])
def test_scores_match_brute_force(make, min_share):
    out = N.score_documents(make(LM_ROWS), ~held_out(F.col("doc_id"), 1), min_share=min_share)
    got = [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in out.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    for a, b in zip(sorted(got, key=key), sorted(brute_lm(LM_ROWS, min_share), key=key), strict=True):
        assert a[:4] == b[:4]
        assert a[4:] == pytest.approx(b[4:], rel=1e-9)


def test_small_blocks_give_the_same(make, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_CHARS", 400)
    test_scores_match_brute_force(make, 0.02)


def test_every_bigram_counts_by_default(make, monkeypatch):
    """Words of less than 1/10,000 of the tokens are contexts too, in one bucket or several."""
    rows = LM_ROWS + [(200 + i, f"rare{i % 4} pair{i % 4} follows rare{i % 4}") for i in range(12)]
    want = {(r[0], r[1]): r[5] for r in brute_lm(rows, 0)}
    cut = {(r[0], r[1]): r[5] for r in brute_lm(rows, 1e-4)}
    assert want[205, 5] > cut[205, 5] + 1
    for block in (N.BLOCK_CHARS, 300):
        monkeypatch.setattr(N, "BLOCK_CHARS", block)
        got = {(r.doc_id, r.n_tokens): r.score for r in N.score_documents(make(rows), ~held_out(F.col("doc_id"), 1)).collect()}
        assert got == pytest.approx(want, rel=1e-9)


def test_no_training_rows_and_no_rows(make):
    assert N.score_documents(make([]), F.lit(True)).collect() == []
    (row,) = N.score_documents(make([(1, "a b")]), F.lit(False)).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.score) == (3, 0, 0, 0.0)


def test_beats_the_base_on_held_out_rows(spark):
    out = N.op2_ngram_lm(spark, "/root/testdata/sf0.01").filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > out[1]


def brute_targets(sizes, weights, percent, cap):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total = sum(sizes.values()) * percent / 100
    full, target = set(), {}
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        share = sum(w[s] for s in sizes if s not in full)
        target = {s: cap * sizes[s] if s in full else left * w[s] / share for s in sizes}
        over = {s for s in sizes if s not in full and target[s] > cap * sizes[s]}
        if not over:
            return target
        full |= over


def test_mix(make):
    rows = [(i, "word " * (1 + i * 7 % 90), f"s{i % 7}" if i % 7 else None) for i in range(700)]
    rows += [(800, None, "s1"), (801, "", "s1"), (802, "a b", "empty?"), (None, "a b c", "s2"), (5, rows[5][1], rows[5][2]), (900, "w " * 20_000, "big")]
    out = [r.asDict() for r in M.pareto_mix(make(rows)).collect()]
    assert len(out) == len(rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in out:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] == r["n_copies"] * r["size"] <= 2 * r["size"]
    assert all(r["source_size"] == sizes[r["source"]] for r in out)
    want = brute_targets(sizes, [5, 2, 1], 150, 2)
    largest = {s: max(r["size"] for r in out if r["source"] == s) for s in sizes}
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= largest[s]
    again = [r.asDict() for r in M.pareto_mix(make(rows[::-1])).collect()]
    key = lambda r: str(sorted(r.items(), key=str))
    assert sorted(out, key=key) == sorted(again, key=key)


def test_inclusion_follows_the_weights(make):
    rows = [(i, "w " * (2 if i % 2 else 200), "s") for i in range(3000)]
    out = M.pareto_mix(make(rows), weights=[1], budget_percent=50).collect()
    short = [r.n_copies for r in out if r["size"] == 2]
    long = [r.n_copies for r in out if r["size"] == 200]
    ratio = (sum(short) / len(short)) / (sum(long) / len(long))
    assert ratio == pytest.approx((2 / 10) / (200 / 208), rel=0.25)
    assert max(short + long) == 1


def test_mix_of_an_empty_table(make):
    assert M.pareto_mix(make([])).collect() == []
