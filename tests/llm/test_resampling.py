import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from llm_fixtures import make  # noqa: F401
from shoplens.llm import resampling as R

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return w, [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, target, share=(5, 100)):
    """docs: (doc_id, text); (doc_id, n_features, weight, score, rank) of each, sorted."""
    def counts(texts):
        out = [0] * 10_000
        for t in texts:
            for f in runs(t)[1]:
                out[zlib.crc32(f.encode("utf-8")) % 10_000] += 1
        return out

    s, t = counts(x for _, x in docs), counts(target)
    S, T = float(sum(s)), float(sum(t))
    gain = [math.floor(1000 * math.log((b + 1) * (S + 10_000) / ((a + 1) * (T + 10_000)))) for a, b in zip(s, t)]
    rows, fit = [], []
    for at, (i, text) in enumerate(docs):
        words, feats = runs(text)
        weight = sum(gain[zlib.crc32(f.encode("utf-8")) % 10_000] for f in feats)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(feats), weight, score, None])
        if len(words) >= 20:
            fit.append((-score, i is None, i or 0, at))
    for rank, (*_, at) in enumerate(sorted(fit)[:share[0] * len(fit) // share[1]], 1):
        rows[at][4] = rank
    return sorted(map(tuple, rows), key=repr)


def test_crc_of_runs_from_their_words():
    texts = ["Some words, and MORE words of müsli 1999", None, "", "one", "a b", "x" * 70 + " " + "y" * 5000 + " z " + "q" * 64, "ü " * 30]
    sizes, found = R.Features(10_000, 3).of(texts)
    for i, text in enumerate(texts):
        words, feats = runs(text)
        assert sizes[i] == len(words)
        assert sorted(b for at, bucket in found for a, b in zip(at, bucket) if a == i) == sorted(zlib.crc32(f.encode()) % 10_000 for f in feats)


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = sorted((tuple(r) for r in R.op12_importance_resample(spark, SF).collect()), key=repr)
    assert got == brute(docs, target) and any(r[4] for r in got)


@pytest.mark.parametrize("n,pivots", [(1, 3), (40, 1), (500, 3), (2000, 15)])
def test_quickselect(spark, n, pivots):
    rng = np.random.default_rng(n)
    rows = [(int(rng.integers(0, 5)), bool(i % 9 == 0), None if i % 9 == 0 else int(rng.integers(0, 4)), i) for i in range(n)]
    df = spark.createDataFrame(rows, "__down long, __no_id boolean, __id long, __tie long")
    order = sorted(rows, key=lambda r: (r[0], r[1], r[2] or 0, r[3]))
    for k in sorted({1, n // 2 + 1, n}):
        assert tuple(R.kth_key(df, k, pivots)) == order[k - 1]
    assert R.kth_key(df, 0) is None and R.kth_key(df, n + 1) is None


def test_hard_rows(spark, make):
    long = " ".join(f"w{i % 700}" for i in range(60_000))
    rows = [(None, "no id at all " * 9), (None, None), (1, None), (2, ""), (3, long), (4, "!!! --- ...")]
    rows += [(5, "copies of one row , with words enough to be drawn if the draw so falls out " * 2)] * 120
    rows += [(i, f"plain words {i} " * 12) for i in range(10, 90)]
    target = spark.createDataFrame([("x", "copies of one row and plain words"), (None, None)], "item_id string, text string")
    out = R.resample(make(rows), target, share=(50, 100))
    assert "__drop" in out.columns and "digest" in out.columns
    got = sorted(((r.doc_id, r["__features"], r["__weight"], r["__score"], r["__rank"]) for r in out.collect()), key=repr)
    # among rows alike in id and score any may be drawn, and these are alike in all that is compared
    assert got == brute(rows, ["copies of one row and plain words", None], (50, 100))


def test_no_rows(spark, make):
    empty = spark.createDataFrame([], "item_id string, text string")
    assert R.resample(make([]), empty).collect() == []
    got = R.resample(make([(1, "too few words"), (2, None)]), empty).collect()
    assert [r["__rank"] for r in got] == [None, None]
