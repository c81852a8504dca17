import pytest

from tabprep.operators.outliers import OutlierHandler
from tabprep.operators.resample import Resampler, class_weights
from tabprep.operators.select import FeatureSelector, FeatureSelectorModel
from tabprep.operators.transform import TableTransformerModel


def test_guard_errors(spark):
    df = spark.createDataFrame([(1, 1.0, 0), (2, 2.0, 1), (3, 3.0, 0)], "key long, x double, label int")
    with pytest.raises(ValueError):
        OutlierHandler().remove_outliers(df, ["x"], strategy="most")
    with pytest.raises(ValueError):
        FeatureSelector(method="chi2")
    with pytest.raises(ValueError):
        FeatureSelector(method="mutual_info").fit(df)  # needs a target
    with pytest.raises(ValueError):
        FeatureSelectorModel(None).transform(df)
    with pytest.raises(ValueError):
        TableTransformerModel(None).transform(df)
    with pytest.raises(ValueError):
        Resampler("random")
    with pytest.raises(ValueError):
        class_weights(df, "label", how="balanced_subsample")


def test_outlier_summary_empty_before_fit(spark):
    assert OutlierHandler().get_outlier_summary(spark) is None


def test_value_counts_percent(spark):
    from tabprep.operators.profile import value_counts
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "g string")
    got = {r["g"]: (r["count"], r["percent"]) for r in value_counts(df, "g").collect()}
    assert got == {"a": (2, 50.0), "b": (1, 25.0), "c": (1, 25.0)}
