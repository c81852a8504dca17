"""The multi-bucket (large-input) paths give the same answers as the
single-bucket path: forced by a tiny bucket size."""

from tabprep.operators import ranks
from tabprep.operators.evaluate import metric_row
from tabprep.operators.split import assign_folds
from tabprep.plans.fixtures import scored
from tests.conftest import SF_SMALL


def _collect(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_metrics_and_folds_bucketed_equal(spark, monkeypatch):
    sc = scored(spark, SF_SMALL).persist()
    cols = ["Accuracy", "F1", "Precision", "Recall", "ROC_AUC", "PR_AUC"]
    base_m = _collect(metric_row(sc), cols)
    base_f = _collect(assign_folds(sc, "label", "key", 5, 42), ["key", "fold"])
    monkeypatch.setattr(ranks, "ROWS_PER_BUCKET", 7)
    small_m = _collect(metric_row(sc), cols)
    small_f = _collect(assign_folds(sc, "label", "key", 5, 42), ["key", "fold"])
    assert small_f == base_f
    assert all(abs(a - b) < 1e-12 for x, y in zip(base_m, small_m) for a, b in zip(x, y))


def test_ranges_beyond_the_sketch_give_the_same_totals(spark, monkeypatch):
    from pyspark.sql import functions as F

    df = spark.range(3000).select((F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 1009).cast("double").alias("v"))
    for descending in (False, True):
        cols = ["g", "v", "cnt", "cum_cnt", "before_cnt"]
        want = _collect(ranks.running_totals(df, "v", ["g"], descending=descending)[0], cols)
        monkeypatch.setattr(ranks, "SKETCH_BUCKETS", 2)
        got = _collect(ranks.running_totals(df, "v", ["g"], rows_per_bucket=50, descending=descending)[0], cols)
        monkeypatch.undo()
        assert got == want


def test_too_many_categories_raise_and_fit_sparsely(spark, monkeypatch):
    import pytest
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F

    from tabprep.operators import create, transform

    df = spark.range(100000).select(F.concat(F.lit("c"), F.col("id")).alias("s"))
    with pytest.raises(ValueError, match="more than 2000 categories"):
        transform.TableTransformer(onehot=["s"]).fit(df)
    with pytest.raises(ValueError, match="more than 2000 categories"):
        create.dummies(df, ["s"])
    new = spark.createDataFrame([("c7",), ("unseen",), (None,)], "s string")
    rows = transform.sparse_onehot(df, ["s"]).transform(new).select(F.size(vector_to_array("onehot")).alias("n"), F.aggregate(vector_to_array("onehot"), F.lit(0.0), lambda a, x: a + x).alias("sum")).collect()
    assert [(r["n"], r["sum"]) for r in rows] == [(100000, 1.0), (100000, 0.0), (100000, 0.0)]
