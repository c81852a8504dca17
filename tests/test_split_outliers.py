from pyspark.sql import functions as F

from tabprep.operators.outliers import OutlierHandler, iqr_bounds
from tabprep.operators.split import assign_folds, stratified_split


def test_folds_disjoint_covering_balanced(spark):
    rows = [(i, int(i % 7 == 0)) for i in range(700)]
    df = spark.createDataFrame(rows, "key long, label int")
    f = assign_folds(df, "label", "key", 5, 42)
    assert f.count() == 700 and f.select("key").distinct().count() == 700
    per = f.groupBy("fold", "label").count().collect()
    for lab in (0, 1):
        counts = [r["count"] for r in per if r["label"] == lab]
        assert max(counts) - min(counts) <= 1


def test_holdout_share(spark):
    rows = [(i, int(i % 5 == 0)) for i in range(1000)]
    df = spark.createDataFrame(rows, "key long, label int")
    tr, te = stratified_split(df, "label", "key", 0.2, 42)
    c = dict(te.groupBy("label").count().collect())
    assert c == {0: 160, 1: 40} and tr.count() == 800


def test_remove_outliers_is_fixpoint(spark):
    vals = [float(v) for v in list(range(100)) + [1000, 2000, -500]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    h = OutlierHandler(1.5)
    kept = h.remove_outliers(df, ["v"], "any", 10)
    b = iqr_bounds(kept, ["v"])
    lo, hi = b["v"]
    assert kept.where((F.col("v") < lo) | (F.col("v") > hi)).count() == 0
    assert h.rounds[-1]["v"][0] == 0


def test_cap_keeps_null_and_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0), (4, 100.0), (5, None), (6, float("nan"))],
                               "id long, v double")
    out = {r["id"]: r["v"] for r in OutlierHandler(1.5).cap_outliers(df, ["v"]).collect()}
    assert out[5] is None and out[6] != out[6] and out[4] < 100.0
