import numpy as np
import pytest

from tabprep.operators import knn
from tabprep.operators.knn import knn_join


def _rows(spark, kind, n=3000, seed=11):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1.0, 20.0, 0.1]
    if kind == "copies":
        x = np.repeat(x[: n // 6], 6, axis=0)
    elif kind == "grid":
        x = np.round(x, 0)
    names = ["x", "y", "z"]
    return x, spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "key long, " + ", ".join(f"{c} double" for c in names)), names


def _true(x, k, metric):
    out = []
    for i, row in enumerate(x):
        apart = row - x
        d = np.abs(apart).max(axis=1) if metric == "max" else apart[:, 0] ** 2 + apart[:, 1] ** 2 + apart[:, 2] ** 2
        d[i] = np.inf
        out.append([int(j) for j in np.lexsort((np.arange(len(x)), d))[:k]])
    return out


@pytest.mark.parametrize("kind,metric", [("spread", "euclid"), ("copies", "euclid"), ("grid", "euclid"), ("grid", "max")])
def test_neighbours_across_cells_equal_brute_force(spark, monkeypatch, kind, metric):
    monkeypatch.setattr(knn, "CELL_ROWS", 64)
    monkeypatch.setattr(knn, "FAN", 8)
    x, df, names = _rows(spark, kind, 1200)
    got: dict = {}
    for r in knn_join(df, df, names, 4, "key", metric=metric).collect():
        got.setdefault(r["q_key"], {})[r["rank"]] = r["c_key"]
    want = _true(x, 4, metric)
    assert [[got[i][r] for r in range(1, 5)] for i in range(len(x))] == want


@pytest.mark.parametrize("kind,metric,most", [("copies", "euclid", 1.5), ("copies", "max", 1.5), ("spread", "euclid", 3.0)])
def test_a_query_meets_few_cells(spark, monkeypatch, kind, metric, most):
    # balls of neighbouring cells overlap: by radius alone a query met two to five
    monkeypatch.setattr(knn, "FAN", 8)
    x, df, names = _rows(spark, kind)
    rows = knn._prep(df, "key", names, None, "c", knn._class_index(df, None)[1])
    tree, c, counts = knn._plant(rows, 3, 1, 64, metric=metric)
    pdf = c.toPandas().sort_values("ck")
    m = pdf[["cv0", "cv1", "cv2"]].to_numpy()
    near = _true(x, 5, metric)
    apart = m - m[[n[-1] for n in near]]
    bound = np.abs(apart).max(axis=1) if metric == "max" else np.sqrt((apart ** 2).sum(axis=1))
    met = np.zeros(len(m))
    own = np.zeros(len(m), bool)
    for at, leaf in tree.reach(m, np.zeros(len(m), np.int64), bound * (1 + knn.SLACK)):
        met[at] += 1
        own[at[pdf["cell"].to_numpy()[at] == leaf]] = True
    assert len(counts) > 30 and own.all()
    assert met.mean() < most
