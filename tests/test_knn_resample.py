import numpy as np
from pyspark.sql import functions as F

from tabprep.operators import resample as R
from tabprep.operators.knn import knn_join


def _points(n=60, seed=3):
    rng = np.random.default_rng(seed)
    xy = np.round(rng.normal(size=(n, 2)), 1)  # rounding plants distance ties
    lab = (rng.random(n) < 0.25).astype(int)
    return [(i + 1, float(x), float(y), int(l)) for i, ((x, y), l) in enumerate(zip(xy, lab))]


def test_knn_blocked_equals_brute_force(spark):
    pts = _points()
    df = spark.createDataFrame(pts, "key long, x double, y double, label int")
    got = {(r["q_key"], r["rank"]): r["c_key"]
           for r in knn_join(df, df, ["x", "y"], 3, "key", block_rows=40).collect()}
    for k, x, y, _ in pts:
        d = sorted(((x - a) ** 2 + (y - b) ** 2, kk) for kk, a, b, _ in pts if kk != k)
        for rank in range(3):
            assert got[(k, rank + 1)] == d[rank][1]


def test_smote_counts_and_segments(spark):
    pts = _points()
    df = spark.createDataFrame(pts, "key long, x double, y double, label int")
    out = R.smote(df, "key", ["x", "y"], "label", k=3)
    counts = dict(out.groupBy("label").count().collect())
    assert counts[0] == counts[1]
    syn = out.where(F.col("key") < 0).collect()
    mino = [(x, y) for _, x, y, l in pts if l == 1]
    xs, ys = [p[0] for p in mino], [p[1] for p in mino]
    for r in syn:  # inside the minority bounding box
        assert min(xs) - 1e-9 <= r["x"] <= max(xs) + 1e-9 and min(ys) - 1e-9 <= r["y"] <= max(ys) + 1e-9
    assert out.where(F.col("key") > 0).count() == len(pts)


def test_tomek_removes_mutual_cross_pairs(spark):
    pts = [(1, 0.0, 0.0, 0), (2, 0.1, 0.0, 1), (3, 5.0, 5.0, 0), (4, 5.0, 6.0, 0), (5, 9.0, 9.0, 1), (6, 9.0, 10.5, 1)]
    df = spark.createDataFrame(pts, "key long, x double, y double, label int")
    kept = sorted(r["key"] for r in R.tomek_links(df, "key", ["x", "y"], "label").collect())
    assert kept == [3, 4, 5, 6]


def test_enn_and_nearmiss_subsets(spark):
    pts = _points()
    df = spark.createDataFrame(pts, "key long, x double, y double, label int")
    keys = {p[0] for p in pts}
    enn = {r["key"] for r in R.edited_nearest_neighbours(df, "key", ["x", "y"], "label").collect()}
    nm = R.nearmiss(df, "key", ["x", "y"], "label")
    assert enn <= keys
    c = dict(nm.groupBy("label").count().collect())
    assert c[0] == c[1]
    assert {r["key"] for r in nm.collect()} <= keys


def test_adasyn_chunked_expansion_matches(spark, monkeypatch):
    pts = _points(80, seed=5)
    df = spark.createDataFrame(pts, "key long, x double, y double, label int")
    a = sorted((r["key"], r["x"], r["y"]) for r in R.adasyn(df, "key", ["x", "y"], "label").collect())
    monkeypatch.setattr(R, "EXPLODE_CHUNK", 2)
    b = sorted((r["key"], r["x"], r["y"]) for r in R.adasyn(df, "key", ["x", "y"], "label").collect())
    assert a == b
    keys = [k for k, _, _ in a]
    assert len(keys) == len(set(keys))
