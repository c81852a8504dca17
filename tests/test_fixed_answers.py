"""Answers that once were wrong, each with the case that showed it."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.operators import evaluate, fit, knn, profile, project, ranks, resample, select, split, transform
from tabprep.sources import files


def test_csv_sources_match_columns_by_name(spark, tmp_path):
    from pyspark.sql.types import IntegerType, StructField, StructType
    one, two = tmp_path / "p.csv", tmp_path / "t.csv"
    one.write_text("a,b,c\n1,10,100\n")
    two.write_text("a,c\n2,200\n")
    s = lambda *names: StructType([StructField(n, IntegerType()) for n in names])
    got = files.load_sources(spark, str(one), str(two), str(one), schema={"primary": s("a", "b", "c"), "train": s("a", "c"), "test": s("a")})
    assert sorted(tuple(r) for r in got["combined"].collect()) == [(1, 100), (2, 200)]
    assert got["combined"].columns == ["a", "c"]
    with pytest.raises(ValueError, match="lacks declared columns"):
        files.read_table(spark, str(two), s("a", "b"))


def test_union_keeps_decimals(spark):
    a = spark.sql("select cast(1.75 as decimal(5,2)) as x, 1 as k")
    b = spark.sql("select 2 as x, cast(2 as bigint) as k")
    got = project.union_sources(a, b)
    assert sorted(float(r["x"]) for r in got.collect()) == [1.75, 2.0] and dict(got.dtypes)["k"] == "bigint"


@pytest.mark.parametrize("labels", [[True, False], [None, "", "x"], [None, 1, 0]])
def test_split_of_boolean_and_null_labels(spark, labels):
    kind = {bool: "boolean", str: "string", int: "int"}[type(labels[-1])]
    df = spark.createDataFrame([(i, labels[i % len(labels)]) for i in range(60)], f"k long, y {kind}")
    train, test = split.stratified_split(df, "y", "k", 0.25)
    n = 60 // len(labels)
    assert {r["count"] for r in test.groupBy("y").count().collect()} == {int(math.floor(0.25 * n + 0.5))}
    assert train.count() + test.count() == 60
    folds = split.assign_folds(df, "y", "k", 5)
    assert {r["count"] for r in folds.groupBy("y", "fold").count().collect()} <= {n // 5, n // 5 + 1}


def test_f_scores_with_nulls_and_large_means(spark):
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=60), rng.normal(size=60)
    rows = [(float(a) if i % 3 else None, float(b), float(a) + 1e9, float(a), i % 3) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "x double, y double, big double, small double, g int")
    keep = [i for i in range(60) if i % 3]
    r = np.corrcoef(x[keep], y[keep])[0, 1]
    assert select.f_regression(df, ["x"], "y")["x"] == pytest.approx(r * r / (1 - r * r) * (len(keep) - 2))
    f = select.f_anova(df, ["big", "small"], "g")
    assert f["big"] == pytest.approx(f["small"], rel=1e-4)


def test_power_lambda_outside_the_first_bracket(spark):
    rng = np.random.default_rng(3)
    v = (1 + 4.5 * rng.normal(6, 1, 2000).clip(2, 10)) ** (1 / 4.5)
    df = spark.createDataFrame([(float(a),) for a in v], "v double")
    best = max(((-len(v) / 2 * math.log(np.var((v**k - 1) / k)) + (k - 1) * np.log(v).sum()), k) for k in np.arange(0.01, 9, 0.01))[1]
    got = transform.fit_power_lambda(df, "v", "bc")
    assert best > 3.5 and got == pytest.approx(best, abs=0.03)


def test_confusion_counts_every_class(spark):
    df = spark.createDataFrame([(0, 0), (1, 2), (2, 2), (3, 0)], "label int, prediction int")
    got = {r["label"]: r.asDict() for r in evaluate.confusion_matrix(df).collect()}
    assert sum(v for r in got.values() for k, v in r.items() if k != "label") == 4 and set(got) == {0, 1, 2, 3}
    norm = {r["label"]: r.asDict() for r in evaluate.confusion_normalized(df).collect()}
    assert norm[1]["pred_2"] == 1.0 and norm[0]["pred_0"] == 1.0
    names = spark.createDataFrame([("a", "b"), ("a", "a")], "label string, prediction string")
    assert evaluate.confusion_matrix(names, classes=None).count() == 2


def test_vif_has_every_column(spark):
    rng = np.random.default_rng(5)
    m = rng.normal(size=(80, 31)) + 1
    df = spark.createDataFrame([tuple(map(float, r)) for r in m], ", ".join(f"c{i} double" for i in range(31)))
    got = {r["feature"]: r["vif"] for r in profile.vif(df, df.columns).collect()}
    g = m.T @ m
    want = np.diag(g) * np.diag(np.linalg.inv(g))
    assert len(got) == 31 and np.allclose([got[f"c{i}"] for i in range(31)], want, atol=1e-4)


def test_profiles_of_null_and_nan_columns(spark):
    none = spark.createDataFrame([(None,), (None,)], "x double")
    assert profile.histogram_equal(none, "x").count() == profile.histogram_nice(none, "x").count() == profile.density(none, "x").count() == 0
    some = spark.createDataFrame([(float("nan"),), (1.0,), (2.0,), (None,)], "x double")
    got = [r["density"] for r in profile.density(some, "x", 5).collect()]
    assert len(got) == 5 and all(math.isfinite(d) for d in got)


def test_knn_rejects_missing_features(spark):
    df = spark.createDataFrame([(1, 0.0), (2, float("nan")), (3, 2.0)], "k long, x double")
    with pytest.raises(Exception, match="impute or drop"):
        knn.knn_join(df, df, ["x"], 1, "k").collect()


def _meets(spark, monkeypatch, df, k, **options):
    """(result, query-candidate distances that the exact join computes)."""
    seen, real = [], knn._meet

    def counted(q, c, parts, fn, schema):
        n = q.groupBy("to").count().join(c.groupBy(F.col("cell").alias("to")).agg(F.count("*").alias("m")), "to").agg(F.sum(F.col("count") * F.col("m"))).first()[0]
        seen.append(n or 0)
        return real(q, c, parts, fn, schema)

    monkeypatch.setattr(knn, "_meet", counted)
    monkeypatch.setattr(knn, "CELL_ROWS", options.pop("cell_rows", 64))
    got = {(r["q_key"], r["rank"]): r["c_key"] for r in knn.knn_join(df, df, ["x", "y"], k, "k", **options).collect()}
    return got, sum(seen)


def _nearest(m, k):
    d = ((m[:, None, :] - m[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    order = np.lexsort((np.broadcast_to(np.arange(len(m)), d.shape), d), axis=1)
    return {(i, r + 1): int(order[i, r]) for i in range(len(m)) for r in range(min(k, len(m) - 1))}


def test_knn_prunes_clustered_rows_and_stays_exact(spark, monkeypatch):
    rng = np.random.default_rng(1)
    m = np.concatenate([rng.normal(c, 0.3, size=(120, 2)) for c in rng.uniform(-100, 100, size=(12, 2))])
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(m)], "k long, x double, y double")
    got, met = _meets(spark, monkeypatch, df, 4)
    assert got == _nearest(m, 4) and met < len(m) ** 2 / 4


def test_knn_distances_grow_with_the_rows_not_their_square(spark, monkeypatch):
    def rows(n):
        rng = np.random.default_rng(6)
        centres = rng.uniform(-1e4, 1e4, size=(n // 40, 2))
        m = np.concatenate([rng.normal(c, 0.5, size=(40, 2)) for c in centres])
        return m, spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(m)], "k long, x double, y double")

    few, df = rows(400)
    got, met = _meets(spark, monkeypatch, df, 3, cell_rows=16)
    assert got == _nearest(few, 3)
    many, df = rows(6400)
    got, more = _meets(spark, monkeypatch, df, 3, cell_rows=16)
    assert got == _nearest(many, 3) and more < 16 * met * 4


def test_knn_within_classes(spark, monkeypatch):
    rng = np.random.default_rng(8)
    m, c = rng.normal(size=(500, 2)), rng.integers(0, 3, size=500)
    names = ["u", "v", None]
    df = spark.createDataFrame([(i, float(x), float(y), names[z]) for i, ((x, y), z) in enumerate(zip(m, c))], "k long, x double, y double, s string")
    monkeypatch.setattr(knn, "CELL_ROWS", 20)
    got = {(r["q_key"], r["rank"]): r["c_key"] for r in knn.knn_join(df, df, ["x", "y"], 3, "k", within="s").collect()}
    want = {}
    for z in (0, 1):
        own = np.flatnonzero(c == z)
        want.update({(int(own[q]), r): int(own[x]) for (q, r), x in _nearest(m[own], 3).items()})
    assert got == want


def test_knn_of_a_dense_cell_ties_and_few_rows(spark, monkeypatch):
    rng = np.random.default_rng(2)
    m = np.concatenate([np.zeros((150, 2)), rng.integers(0, 4, size=(100, 2)).astype(float), [[500.0, 500.0]]])
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(m)], "k long, x double, y double")
    got, _ = _meets(spark, monkeypatch, df, 3, block_rows=20)
    assert got == _nearest(m, 3)
    few = df.where("k < 3")
    assert knn.knn_join(few, few, ["x", "y"], 5, "k").count() == 6
    assert knn.knn_join(few, few.where("false"), ["x", "y"], 5, "k").count() == 0


def test_lsh_gives_k_neighbours_to_every_query(spark):
    rng = np.random.default_rng(3)
    m = np.concatenate([rng.normal(0, 1, size=(195, 2)), rng.uniform(500, 900, size=(5, 2))])
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(m)], "k long, x double, y double")
    got = knn.knn_join(df, df, ["x", "y"], 3, "k", method="approx").groupBy("q_key").count().collect()
    assert len(got) == 200 and {r["count"] for r in got} == {3}


def test_nearmiss_with_fewer_minority_rows_than_k(spark):
    rows = [(i, float(i), 0) for i in range(18)] + [(100, 3.0, 1), (101, 9.0, 1)] + [(200 + i, 5.0 + i, 2) for i in range(4)]
    got = resample.nearmiss(spark.createDataFrame(rows, "k long, x double, y int"), "k", ["x"], "y", k=3, sampling_strategy="majority")
    assert {r["label"]: r["count"] for r in got.groupBy("label").count().collect()} == {0: 2, 1: 2, 2: 4}
    every = resample.nearmiss(spark.createDataFrame(rows, "k long, x double, y int"), "k", ["x"], "y", k=3)
    assert {r["label"]: r["count"] for r in every.groupBy("label").count().collect()} == {0: 2, 1: 2, 2: 2}


def test_trials_take_any_integer_between_and_scoring_names_are_checked(spark):
    trials = fit.sample_trials(spark, {"d": {"values": [3, 10]}}, 200)
    assert {t["d"] for t in trials} == set(range(3, 11))
    with pytest.raises(ValueError, match="scoring"):
        fit.tune(spark.createDataFrame([(1.0, 0, 0)], "x double, y int, fold int"), ["x"], "y", "gbt", {}, 1, scoring="nonsense")


def test_quantiles_of_many_columns_in_one_pass_without_a_value_shuffle(spark):
    rng = np.random.default_rng(7)
    m = np.round(rng.exponential(5, size=(500, 40)), 1)
    df = spark.createDataFrame([tuple(map(float, r)) for r in m], ", ".join(f"c{i} double" for i in range(40)))
    for most in (2, 100_000):
        q = ranks.exact_quantiles(df, df.columns, [0, 0.25, 0.5, 0.75, 1], collect_values=most)
        assert all(np.allclose(q[f"c{i}"], np.quantile(m[:, i], [0, 0.25, 0.5, 0.75, 1])) for i in range(40))


def test_no_cached_tables_are_left(spark):
    spark.catalog.clearCache()
    df = spark.createDataFrame([(i, float(i % 7), i % 2) for i in range(80)], "k long, x double, y int")
    split.holdout_flag(df, "y", "k").count()
    resample.smote(df.where("y = 0 or k < 20"), "k", ["x"], "y").count()
    resample.nearmiss(df.where("y = 0 or k < 20"), "k", ["x"], "y").count()
    evaluate.roc_auc(df.select(F.col("y").alias("label"), F.col("x").alias("score")))[0].count()
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == 0


def test_features_of_the_study_spec(spark):
    from tabprep.operators.create import create_features
    from tabprep.spec import ACCOUNT_SPEC
    df = spark.createDataFrame([(1, 35, 650, 2, 1000.0, 2, 1, 1, 2000.0, "France", "Male", 0)],
                               "CustomerId long, Age int, CreditScore int, Tenure int, Balance double, NumOfProducts int, HasCrCard int, "
                               "IsActiveMember int, EstimatedSalary double, Geography string, Gender string, Exited int")
    r = create_features(df, ACCOUNT_SPEC).first().asDict()
    assert r["Total_Products_Used"] == 3 and r["Balance_Salary_Ratio"] == pytest.approx(0.5, abs=1e-6)
    assert "France" in r["Geo_Gender"] and "Male" in r["Geo_Gender"] and str(r["Tp_Gender"]).startswith("3")
    assert {"Age_Category", "Credit_Score_Range"} <= set(r)
