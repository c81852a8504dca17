from pyspark.sql import functions as F

from tabprep.functions import exprs
from tabprep.functions.bins import bin_expr
from tabprep.spec import AGE_EDGES, AGE_LABELS


def test_right_closed_lowest_included(spark):
    df = spark.createDataFrame([(v,) for v in (17.9, 18.0, 30.0, 30.5, 60.0, 100.0, 100.1, None)], "x double")
    got = [r[0] for r in df.select(bin_expr("x", AGE_EDGES, AGE_LABELS)).collect()]
    assert got == [None, "18-30", "18-30", "30-40", "50-60", "60+", None, None]


def test_left_closed_last_edge_open(spark):
    df = spark.createDataFrame([(v,) for v in (18.0, 29.99, 30.0, 99.9, 100.0)], "x double")
    got = [r[0] for r in df.select(bin_expr("x", AGE_EDGES, right=False, include_lowest=False)).collect()]
    assert got == ["18-30", "18-30", "30-40", "60-100", None]


def test_cross_and_number_text(spark):
    df = spark.createDataFrame([("France", "Male", 2), (None, "Male", None)], "g string, s string, n int")
    r = df.select(exprs.cross("g", "s").alias("c"), exprs.cross_number("n", "s").alias("t")).collect()
    assert r[0]["c"] == "France_Male" and r[0]["t"] == "2.0_Male"
    assert r[1]["c"] is None and r[1]["t"] == "nan_Male"


def test_value_map_default_and_ratio(spark):
    df = spark.createDataFrame([("Female", 1.0, 0.0), ("Other", 2.0, 4.0), (None, 0.0, 0.0)], "g string, a double, b double")
    r = df.select(exprs.value_map("g", {"Female": 0, "Male": 1}, -1).alias("m"),
                  exprs.safe_ratio("a", "b").alias("q")).collect()
    assert [x["m"] for x in r] == [0, -1, -1]
    assert r[0]["q"] == 1.0 / 1e-6 and r[2]["q"] == 0.0
