import numpy as np
import pytest

from shoplens.llm import vector_graph as V

SCHEMA = "vec_id long, embedding array<float>, dim int, node string"


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, every=50, k=5):
    """{query: [(vec_id, score)]}; of rows of one id the nearest counts, the smallest asks."""
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and usable(v)]
    asks = {}
    for i, v in good:
        if i % every == 0 and (i not in asks or tuple(v) < tuple(asks[i])):
            asks[i] = v
    out = {}
    for q, v in asks.items():
        best = {}
        for i, w in good:
            if i != q and len(w) == len(v):
                best[i] = max(best.get(i, -9), float(v @ w / np.sqrt(v @ v) / np.sqrt(w @ w)))
        out[q] = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
    return {q: x for q, x in out.items() if x}


def answers(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for x in out.values():
        x.sort()
        assert [r for r, _, _ in x] == list(range(1, len(x) + 1))
    return {q: [(i, s) for _, i, s in x] for q, x in out.items()}


def recall(got, want):
    assert set(got) == set(want)
    hit = 0
    for q, x in want.items():
        assert len(got[q]) == len(x)
        # a score as good as the last wanted one is as near: ties differ by rounding
        hit += sum(s >= x[-1][1] - 1e-9 for _, s in got[q])
    return hit / sum(map(len, want.values()))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_against_brute_force(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()]
    got, want = answers(V.op11_vector_graph(spark, f"/root/testdata/{sf}")), brute(rows)
    assert recall(got, want) >= 0.97
    exact = {(q, i): s for q, x in want.items() for i, s in x}
    assert all(abs(exact[q, i] - s) < 1e-12 for q, x in got.items() for i, s in x if (q, i) in exact)


def test_shards_and_clusters(spark):
    """Tight clusters, over several shards: pruned edges must lead from one cluster to another."""
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((30, 24))
    rows = [(i, [float(x) for x in np.float32(centres[i % 30] + rng.standard_normal(24) * 0.05)]) for i in range(6000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    index, kind = V.build_index(df, shard_rows=1500)
    assert index.select("shard").distinct().count() == 4 and index.count() == 6000
    got = answers(V.search_index(index, kind, df.filter("vec_id % 50 = 0")))
    assert recall(got, brute(rows)) >= 0.95


def test_copies_and_hard_rows(spark):
    """A third of all rows are one vector, another part are multiples of it; one id fills many rows."""
    rng = np.random.default_rng(8)
    base = [float(x) for x in np.float32(rng.standard_normal(8))]
    rows = [(i, base) for i in range(900)]
    rows += [(i, [float(np.float32(x * (1 + i / 7))) for x in base]) for i in range(900, 1100)]
    rows += [(5000 + i, [float(x) for x in np.float32(rng.standard_normal(8))]) for i in range(1500)]
    rows += [(4950, base)] * 200 + [(4950, [-x for x in base])] * 3
    rows += [(50_000, None), (50_050, []), (50_100, [0.0] * 8), (50_150, [1.0, None] * 4), (50_200, [float("nan")] * 8),
             (50_250, [float("inf")] * 8), (None, base), (50_300, [1.0, 2.0]), (50_350, [2.0, 1.0]), (50_400, [3.0]), (50_450, [3e38] * 8)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    index, kind = V.build_index(df, shard_rows=700)
    got, want = answers(V.search_index(index, kind, df.filter("vec_id % 50 = 0"))), brute(rows)
    assert recall(got, want) >= 0.95
    # exact copies tie, and the smallest ids win
    assert [i for i, _ in got[50]] == [i for i, _ in got[850]][:5] == [0, 1, 2, 3, 4] and [i for i, _ in got[0]] == [1, 2, 3, 4, 5]
    assert 50_400 not in got and got[50_300] == [(50_350, pytest.approx(0.8))]


def test_wide_numbers_and_no_rows(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e-200, 0.0]), (2, [5e-324, 5e-324])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index, kind = V.build_index(df)
    got = answers(V.search_index(index, kind, df.filter("vec_id = 0")))
    assert [i for i, _ in got[0]] == [2, 1] and got[0][0][1] == pytest.approx(1) and got[0][1][1] == pytest.approx(2 ** -0.5)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    index, kind = V.build_index(empty)
    assert V.search_index(index, kind, empty).collect() == []


def test_pruning_keeps_diverse_edges():
    x = np.float32([[1, 0, 0], [0.99, 0.14, 0], [0.98, 0.2, 0], [0, 0, 1]])
    x /= np.linalg.norm(x, axis=1)[:, None]
    dist = -(x[:1] @ x[1:].T)
    assert V._prune(x, np.array([[1, 2, 3]]), dist, 4, 1.2).tolist() == [[1, 3, -1, -1]]
