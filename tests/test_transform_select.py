import numpy as np
from pyspark.sql import functions as F

from tabprep.operators import select as C
from tabprep.operators import transform as T


def test_standardize_population(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 10)], "x double")
    z = [r[0] for r in T.standardize(df, ["x"]).collect()]
    assert abs(np.mean(z)) < 1e-12 and abs(np.std(z) - 1) < 1e-12


def test_quantile_paths_agree(spark):
    rng = np.random.default_rng(0)
    vals = np.round(rng.gamma(2, 3, 500), 1)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "id long, x double")
    knots = T.quantile_knots(df, "x", max_knots=50)
    a = {r["id"]: r["q"] for r in df.select("id", T.quantile_uniform_expr(F.col("x"), knots).alias("q")).collect()}
    b = {r["id"]: r["x"] for r in T.quantile_uniform(df, "x", knots).collect()}
    assert all(abs(a[i] - b[i]) < 1e-12 for i in a)
    assert min(a.values()) >= 0 and max(a.values()) <= 1


def test_yeo_johnson_lambda_on_normal_data(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(float(v),) for v in rng.normal(0, 1, 2000)], "x double")
    lam = T.fit_power_lambda(df, "x", "yj")
    assert abs(lam - 1.0) < 0.2


def test_onehot_drop_first_unseen_zero(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "g string")
    test = spark.createDataFrame([("b",), ("z",)], "g string")
    m = T.TableTransformer(onehot=["g"]).fit(train)
    rows = m.transform(test).collect()
    assert m.params.onehot["g"] == ["a", "b", "c"]
    assert rows[0].asDict() == {"g_b": 1.0, "g_c": 0.0} and rows[1].asDict() == {"g_b": 0.0, "g_c": 0.0}


def test_correlation_drop_order_and_keep_top(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=300)
    df = spark.createDataFrame([(float(x), float(2 * x + 1), float(y)) for x, y in zip(a, rng.normal(size=300))],
                               "a double, b double, c double")
    drop, _ = C.correlation_drop(df, ["a", "b", "c"], 0.95)
    assert drop == ["b"]
    keep, dropped = C.keep_top(["x", "y", "z"], {"x": 1.0, "y": 3.0, "z": 3.0}, k=2)
    assert keep == ["y", "z"] and dropped == ["x"]


def test_selection_never_drops_target(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=200)
    rows = [(float(a), float(2 * a), float(b), int(a > 0)) for a, b in zip(x, rng.normal(size=200))]
    df = spark.createDataFrame(rows, "a double, b double, c double, y int")
    for method, kw in (("correlation", {}), ("variance", {"threshold": 10.0}), ("mutual_info", {"k": 1}),
                       ("f_score", {"k": 1})):
        out = C.FeatureSelector(method, target="y", **kw).fit_transform(df)
        assert "y" in out.columns, method


def test_transformer_save_load_roundtrip(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(float(a), float(abs(b)) + 1.0, ["x", "y", "z"][i % 3], ["F", "M"][i % 2])
            for i, (a, b) in enumerate(zip(rng.normal(size=300), rng.normal(size=300)))]
    df = spark.createDataFrame(rows, "a double, b double, g string, s string")
    m = T.TableTransformer(yeo_johnson=["a"], box_cox=["b"], quantile=["a"], standard=["b"],
                           value_maps={"s": ({"F": 0, "M": 1}, -1)}, onehot=["g"], max_knots=20).fit(df)
    m.save(spark, str(tmp_path / "tf"))
    m2 = T.TableTransformerModel.load(spark, str(tmp_path / "tf"))
    a = sorted(tuple(r) for r in m.transform(df).collect())
    b = sorted(tuple(r) for r in m2.transform(df).collect())
    assert a == b
