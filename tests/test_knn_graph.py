import numpy as np
import pandas as pd
import pytest

from tabprep.operators import knn, knn_graph
from tabprep.plans import q_balance
from tests.conftest import SF_SMALL


def test_recall_on_the_embeddings(spark):
    row = q_balance.q_knn_graph_recall(spark, SF_SMALL).first()
    assert row["exact_pairs"] == 125 and row["recall"] >= 0.9


def test_descent_covers_every_row_inside_its_class(spark, monkeypatch):
    monkeypatch.setattr(knn_graph, "START", 16)
    monkeypatch.setattr(knn_graph, "LEAF", 24)
    monkeypatch.setattr(knn_graph, "EXTRA", 6)
    monkeypatch.setattr(knn, "_meet", lambda *a: pytest.fail("an exact join"))
    rng = np.random.default_rng(3)
    x, c = rng.normal(size=(300, 3)), rng.integers(0, 2, size=300)
    rows = [(i, *map(float, v), "uv"[z]) for i, (v, z) in enumerate(zip(x, c))] + [(300, 0.0, 0.0, 0.0, None), (301, 0.0, 0.0, 0.0, "w")]
    df = spark.createDataFrame(rows, "k long, a double, b double, c double, s string")
    got: dict = {}
    for r in knn.knn_join(df, df, ["a", "b", "c"], 4, "k", method="approx", within="s").collect():
        got.setdefault(r["q_key"], []).append((r["rank"], r["c_key"], r["dist"]))
    hits = 0
    for i in range(300):
        own = [j for j in np.flatnonzero(c == c[i]) if j != i]
        near = sorted(own, key=lambda j: ((x[i] - x[j]) ** 2).sum())[:4]
        assert [n for n, _, _ in sorted(got[i])] == [1, 2, 3, 4] and all(c[j] == c[i] for _, j, _ in got[i])
        assert all(d == pytest.approx(np.linalg.norm(x[i] - x[j])) for _, j, d in got[i])
        hits += len({j for _, j, _ in got[i]} & set(near))
    assert hits >= 0.9 * 1200 and 300 not in got and 301 not in got


def test_other_queries_than_candidates(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 2))
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "k long, a double, b double")
    few, rest = df.where("k < 20"), df.where("k >= 20")
    got = knn.knn_join(few, rest, ["a", "b"], 3, "k", method="approx").collect()
    assert len(got) == 60 and {r["q_key"] for r in got} == set(range(20)) and all(r["c_key"] >= 20 for r in got)
    assert knn.knn_join(few, rest.where("false"), ["a", "b"], 3, "k", method="approx").count() == 0


@pytest.mark.parametrize("limited", [False, True])
@pytest.mark.parametrize("scale", [1.0, 1e-6, 1e160])
def test_nearest_is_the_full_comparison_to_the_bit(monkeypatch, limited, scale):
    """Ties, equal rows and limits; values whose squares overflow go the long way."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(120, 12)).round(1) * scale
    x[40:80] = x[:40]
    ids = rng.permutation(120).astype(np.int64)
    full = knn_graph._distances(x, x)
    full[np.arange(120), np.arange(120)] = np.inf
    limit = np.full(120, np.median(full)) if limited else None
    if scale < 1e100:
        monkeypatch.setattr(knn_graph, "_distances", lambda *a: pytest.fail("every distance summed feature by feature"))
    got = knn_graph._best(ids, ids, x, x, 7, False, limit)
    want = []
    for i in range(120):
        near = sorted((full[i, j], ids[j]) for j in range(120) if np.isfinite(full[i, j]) and (limit is None or full[i, j] < limit[i]))
        want += [(ids[i], n, d) for d, n in near[:7]]
    assert list(got.itertuples(index=False, name=None)) == want


def test_wide_blocks_keep_the_exact_neighbours():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(90, 16)).round(1)
    x[60:] = x[:30]
    cols = {f"{p}v{i}": x[:, i] for i in range(16) for p in "qc"}
    rows = pd.DataFrame({"qk": np.arange(90), "ck": np.arange(90), "cl": np.arange(90) % 3, **cols})
    got = knn._block_topk(4, True, True, 16)(rows, rows)
    full = knn_graph._distances(x, x)
    want = {(i, j, full[i, j], j % 3) for i in range(90) for j in sorted((j for j in range(90) if j != i), key=lambda j: (full[i, j], j))[:4]}
    assert set(got.itertuples(index=False, name=None)) == want and len(got) == 360
