import numpy as np
import pytest

from tabprep.operators import resample as R


def three(spark, sizes=(30, 15, 10), names=("a", "b", "c")):
    rng = np.random.default_rng(7)
    rows, key = [], 0
    for n, name in zip(sizes, names):
        for x in rng.normal(0 if name == names[0] else 0.5, 1, size=(n, 2)):
            rows.append((key, float(x[0]), float(x[1]), name))
            key += 1
    return spark.createDataFrame(rows, "k long, x double, y double, s string")


def sizes(df):
    return {r["label"]: r["count"] for r in df.groupBy("label").count().collect()}


@pytest.mark.parametrize("method, strategy, want", [
    ("smote", "auto", (30, 30, 30)), ("smote", "minority", (30, 15, 30)), ("smote", "not minority", (30, 30, 10)), ("smote", {"c": 12}, (30, 15, 12)),
    ("nearmiss", "auto", (10, 10, 10)), ("nearmiss", "majority", (10, 15, 10)), ("nearmiss", {"a": 20}, (20, 15, 10)), ("class_weight", "auto", (30, 15, 10))])
def test_every_class_moves_as_told(spark, method, strategy, want):
    got = R.Resampler(method, sampling_strategy=strategy).resample(three(spark), "k", ["x", "y"], "s")
    assert sizes(got) == dict(zip("abc", want)) and got.select("key").distinct().count() == sum(want)


def test_adasyn_grows_every_class(spark):
    got = sizes(R.Resampler("adasyn", k=4).resample(three(spark), "k", ["x", "y"], "s"))
    assert got["a"] == 30 and 26 <= got["b"] <= 34 and 26 <= got["c"] <= 34  # shares are rounded row by row


def test_synthetic_rows_lie_between_neighbours_of_their_class(spark):
    df = three(spark)
    own = {r["k"]: (np.array([r["x"], r["y"]]), r["s"]) for r in df.collect()}
    for r in R.smote(df, "k", ["x", "y"], "s").where("key < 0").collect():
        p = np.array([r["x"], r["y"]])
        mates = [v for v, s in own.values() if s == r["label"]]
        assert min(abs(np.linalg.norm(p - a) + np.linalg.norm(p - b) - np.linalg.norm(a - b)) for a in mates for b in mates) < 1e-9


def test_ratio_and_wrong_strategies(spark):
    two = three(spark, (40, 10), ("a", "b"))
    assert sizes(R.smote(two, "k", ["x", "y"], "s", sampling_strategy=0.5)) == {"a": 40, "b": 20}
    assert sizes(R.nearmiss(two, "k", ["x", "y"], "s", sampling_strategy=0.5)) == {"a": 20, "b": 10}
    for strategy, text in ((0.5, "two classes"), ("sideways", "sideways"), ({"z": 3}, "no rows"), ({"a": 3}, "shrink")):
        with pytest.raises(ValueError, match=text):
            R.smote(three(spark), "k", ["x", "y"], "s", sampling_strategy=strategy)
    with pytest.raises(ValueError, match="no resampler"):
        R.Resampler("other")


def test_the_dispatcher_reaches_the_approximate_join(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(R, "knn_join", lambda *a, method, **k: seen.append((method, a[3])) or (_ for _ in ()).throw(StopIteration))
    for name in ("smote", "adasyn", "nearmiss", "smote_enn", "smote_tomek"):
        with pytest.raises(StopIteration):
            R.Resampler(name, neighbours="approx", k=2).resample(three(spark), "k", ["x", "y"], "s")
    assert seen == [("approx", 2)] * 5
