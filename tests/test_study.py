import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tabprep.operators import boosting as B
from tabprep.operators import evaluate, fit, moments, profile, select, stages, study, transform
from tabprep.plans import q_model
from tabprep.session import stored
from tabprep.sources.tables import customer_profile
from tabprep.spec import PROFILE_SPEC, SEARCH_SPACE, FeatureSpec
from tests.conftest import SF_SMALL


def points(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=n) * 0.5 > 0).astype(int)
    x[rng.random(n) < 0.1, 1] = np.nan
    return spark.createDataFrame([(i, *map(float, r), int(v), i % 3) for i, (r, v) in enumerate(zip(x, y))], "k long, a double, b double, c double, y int, f int")


def folded(df):
    rows = df.withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(2))))
    return B.as_rows(rows, ["a", "b", "c"], "y", "k", fold=F.col("v"), val=F.col("f") == F.col("v"))


TRIALS = [B.Params(6, 3, 0.3), B.Params(4, 5, 0.1, 0.8, 0.7), B.Params(9, 2, 0.2, 1.0, 0.5)]


def grown(rows, trials):
    search = B.Search(rows, ["a", "b", "c"], trials)
    trees = search.fit()
    scores = {(r["trial"], r["fold"], r["key"]): r["score"] for r in search.scores().collect()}
    search.release()
    return trees, scores


def test_search_grows_the_same_trees_together_alone_and_over_many_blocks(spark, monkeypatch):
    df = points(spark)
    rows = folded(df).persist()
    trees, scores = grown(rows, TRIALS)
    assert len(scores) == 3 * 400 and len(trees[(2, 0)].feature) == 9
    for i, t in enumerate(TRIALS):  # one fit after another
        alone, own = grown(rows, [t])
        for f in range(3):
            x = np.column_stack([df.orderBy("k").toPandas()[c] for c in "abc"])
            assert np.allclose(alone[(0, f)].margin(x), trees[(i, f)].margin(x), atol=1e-12)
        assert all(abs(scores[(i, f, k)] - s) < 1e-12 for (_, f, k), s in own.items())
    monkeypatch.setattr(B, "BLOCK_CELLS", 300)  # a trial's rows lie in many blocks: one aggregate a level
    monkeypatch.setattr(B, "CUT", 3)
    _, apart = grown(rows, TRIALS)
    assert apart.keys() == scores.keys() and all(abs(apart[k] - scores[k]) < 1e-9 for k in scores)


def test_trees_against_a_plain_version(spark):
    df = points(spark, 200, 3).toPandas()
    p = B.Params(5, 3, 0.3)
    trees = B.fit_trees(spark.createDataFrame(df), ["a", "b", "c"], "y", "k", p, bins=250)
    x, y = df[["a", "b", "c"]].to_numpy(), df["y"].to_numpy(float)
    margin = np.zeros(len(y))

    def grow(rows, depth, g, h, out):
        value = lambda r: -0.3 * g[r].sum() / (h[r].sum() + 1)
        best = (1e-9, None, None)
        if depth < 3:
            for j in range(3):
                for cut in [-np.inf, *np.unique(x[rows, j][~np.isnan(x[rows, j])])]:
                    right = rows[x[rows, j] >= cut]
                    left = np.setdiff1d(rows, right)
                    if not len(left) or not len(right) or h[left].sum() < 1 or h[right].sum() < 1:
                        continue
                    part = lambda r: g[r].sum() ** 2 / (h[r].sum() + 1)
                    gain = part(left) + part(right) - part(rows)
                    if gain > best[0] + 1e-9:
                        best = (gain, left, right)
        if best[1] is None:
            out[rows] += value(rows)
        else:
            grow(best[1], depth + 1, g, h, out)
            grow(best[2], depth + 1, g, h, out)

    for _ in range(5):
        prob = 1 / (1 + np.exp(-margin))
        grow(np.arange(len(y)), 0, prob - y, prob * (1 - prob), margin)
    assert np.allclose(trees.margin(x), margin, atol=1e-6)


def test_tune_query_runs_unstubbed(spark):
    table = q_model.q_tune(spark, SF_SMALL).collect()
    assert len(table) == 20 and all(0 < r["score"] < 1 for r in table)
    assert all('"n_estimators": ' in r["params"] and '"colsample_bytree": 0.' in r["params"] for r in table)


def test_best_trial_is_that_of_separate_fits(spark):
    parts = [study.Part(f, points(spark).where(F.col("f") != f), points(spark).where(F.col("f") == f), ["a", "b", "c"], None) for f in range(3)]
    space = {**SEARCH_SPACE, "n_estimators": {"low": 3, "high": 9}}
    best, table = study.search(parts, "k", "y", space, 3)
    scores = {r["trial"]: r["score"] for r in table.collect()}
    drawn = [B.Params(**{k: v for k, v in t.items() if k != "trial"}) for t in fit.sample_trials(spark, space, 3)]
    for i, t in enumerate(drawn):
        aucs = []
        for p in parts:
            trees = B.fit_trees(p.train, p.features, "y", "k", t)
            aucs.append(evaluate.roc_auc(B.predict_trees(trees, p.val).select(F.col("y").alias("label"), "score"))[0].first()[0])
        assert scores[i] == pytest.approx(np.mean(aucs), abs=1e-9)
    assert best == drawn[max(scores, key=lambda i: (scores[i], -i))]


def test_saved_pipeline_scores_raw_columns(spark, tmp_path):
    cp = customer_profile(spark, SF_SMALL)
    model = study.scoring_pipeline(cp, PROFILE_SPEC, B.Params(5, 3), {"method": "correlation", "threshold": 0.95})
    model.write().overwrite().save(str(tmp_path / "p"))
    raw = cp.drop("churned")
    got = {r["c_custkey"]: (r["score"], r["tier"], r["risk_label"]) for r in PipelineModel.load(str(tmp_path / "p")).transform(raw).collect()}
    assert got == {r["c_custkey"]: (r["score"], r["tier"], r["risk_label"]) for r in model.transform(raw).collect()} and len(got) == cp.count()
    one = model.transform(raw.limit(1)).first()
    assert got[one["c_custkey"]][0] == one["score"]


def test_outlier_stage_keeps_rows(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i % 5), 1) for i in range(40)] + [(40, 99.0, 0), (41, None, 0)], "k long, x double, y int")
    for how in ("cap", "flag"):
        Pipeline(stages=[stages.OutlierBounds(columns=["x"], target="y", how=how)]).fit(df).write().overwrite().save(str(tmp_path / how))
    capped = PipelineModel.load(str(tmp_path / "cap")).transform(df)
    flagged = PipelineModel.load(str(tmp_path / "flag")).transform(df)
    assert capped.count() == 42 and capped.agg(F.max("x")).first()[0] < 99 and flagged.where("x_outlier").count() == 1
    with pytest.raises(ValueError, match="capped"):
        stages.OutlierBounds(how="drop")


def test_no_fit_sees_validation_rows(spark):
    spec = FeatureSpec(key="k", target="y", standard=["a"], onehot=["s"])
    rows = [(i, float(i % 7), i % 2, "u" if i % 3 else "w") for i in range(60)]
    train, val = spark.createDataFrame(rows, "k long, a double, y int, s string"), spark.createDataFrame([(100, 1e6, 1, "new")], "k long, a double, y int, s string")
    part = study.prepare(train, val, spec, balance="class_weight")
    a = np.array([r[1] for r in rows])
    got = part.val.first()
    assert got["a"] == pytest.approx((1e6 - a.mean()) / a.std()) and part.features == ["a", "s_w"] and got["s_w"] == 0.0
    assert part.train.agg(F.sum("weight")).first()[0] == pytest.approx(60)


def test_run_reports_both_models(spark):
    cp = customer_profile(spark, SF_SMALL)
    space = {**SEARCH_SPACE, "n_estimators": {"low": 3, "high": 5}}
    metrics, verdict, tuned = study.run(cp, PROFILE_SPEC, [study.BOOSTED, "LogisticRegression"], space, 3, 2, {study.BOOSTED: {"n_estimators": 4}, "LogisticRegression": {"maxIter": 5}})
    rows = {(r["Model"], r["Type"]): r for r in metrics.collect()}
    assert set(rows) == {("BoostedTrees_baseline", "test"), ("BoostedTrees_tuned", "test"), ("BoostedTrees", "cv"), ("LogisticRegression", "cv")}
    v = verdict.first()
    assert v["delta"] == pytest.approx(v["test_tuned"] - v["test_baseline"]) and v["verdict"] in ("improved", "minimal", "worse") and 3 <= tuned.n_estimators <= 5


def test_a_failed_fit_is_raised(spark):
    with pytest.raises(ZeroDivisionError):
        study.at_once([lambda: 1, lambda: 1 / 0, lambda: 2])


# co-moments, missing values


def test_correlations_are_pairwise_complete(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 6)) * [1, 1e3, 1e-3, 1, 1, 1] + [0, 1e6, 5, 0, 0, 0]
    x[:, 4] = x[:, 0] * 2 + 1e-3 * x[:, 3]
    x[:, 5] = 7.0
    x[rng.random((300, 6)) < 0.2] = np.nan
    rows = [tuple(None if np.isnan(v) and (i + j) % 2 else float(v) for j, v in enumerate(r)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(6))).repartition(7)
    want = pd.DataFrame(x).corr().to_numpy()
    got = moments.correlations(df, df.columns)
    assert np.allclose(got[:5, :5], want[:5, :5], atol=1e-9) and np.isnan(got[5, :5]).all()
    assert np.isnan(moments.correlations(df.limit(0), df.columns)).all()


def test_wide_correlations_and_nearly_collinear_inflation(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 300))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"c{i} double" for i in range(300)))
    assert np.allclose(moments.correlations(df, df.columns), np.corrcoef(x.T), atol=1e-9)
    a = rng.normal(size=500)
    b, c = a + 1e-7 * rng.normal(size=500), rng.normal(size=500)
    m = np.column_stack([a, b, c])
    df = spark.createDataFrame([tuple(map(float, r)) for r in m] + [(None, 1.0, 2.0)], "a double, b double, c double").repartition(5)
    got = {r["feature"]: r["vif"] for r in profile.vif(df, ["a", "b", "c"]).collect()}
    q, r = np.linalg.qr(m)
    inv = np.linalg.inv(r)
    want = (inv ** 2).sum(axis=1) * (m ** 2).sum(axis=0)
    assert np.allclose([got["a"], got["b"], got["c"]], want, rtol=1e-4)
    exact = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)], "a double, b double")
    assert all(r["vif"] == float("inf") for r in profile.vif(exact, ["a", "b"]).collect())


NAN = float("nan")


def test_nan_is_skipped_column_by_column(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0), (2.0, NAN, 0), (3.0, 6.0, 1), (NAN, 8.0, 1), (5.0, 1.0, 1), (6.0, 3.0, 0)], "a double, b double, y int")
    z = [r["a"] for r in transform.standardize(df, ["a"]).collect()]
    a = np.array([1, 2, 3, NAN, 5, 6.0])
    assert np.allclose(z, (a - np.nanmean(a)) / np.nanstd(a), equal_nan=True)
    assert select.variances(df, ["a"])["a"][0] == pytest.approx(np.nanvar(a)) and select.variance_drop(df, ["a", "b"])[0] == []
    ok = df.where("not isnan(a)")
    assert select.f_regression(df, ["a"], "y")["a"] == pytest.approx(select.f_regression(ok, ["a"], "y")["a"])
    assert select.f_anova(df, ["a"], "y")["a"] == pytest.approx(select.f_anova(ok, ["a"], "y")["a"])
    assert select.mutual_info(df, ["a"], "y", 2)["a"] == pytest.approx(select.mutual_info(ok, ["a"], "y", 2)["a"])
    assert profile.corr_matrix(df, ["a", "b"])[("a", "b")] == pytest.approx(df.toPandas()[["a", "b"]].corr().iloc[0, 1])
    hist = {r["bin"]: r["count"] for r in profile.histogram_equal(df, "a", 5).collect()}
    assert sum(hist.values()) == 5 and hist[4] == 2
    assert sum(r["count"] for r in profile.histogram_nice(df, "a").collect()) == 5


def test_confusion_of_text_and_other_labels(spark):
    text = spark.createDataFrame([("a", "b"), ("a", "a"), ("c", "a")], "label string, prediction string")
    got = {r["label"]: r.asDict() for r in evaluate.confusion_matrix(text).collect()}
    assert set(got) == {"a", "b", "c"} and got["a"] == {"label": "a", "pred_a": 1, "pred_b": 1, "pred_c": 0}
    some = evaluate.confusion_matrix(spark.createDataFrame([(2, 3), (3, 3)], "label int, prediction int"))
    assert {r["label"] for r in some.collect()} == {2, 3} and some.columns == ["label", "pred_2", "pred_3"]
    with pytest.raises(ValueError, match="type of the labels"):
        evaluate.confusion_matrix(spark.createDataFrame([(2, 3)], "label int, prediction int"), classes=["x"])


def test_folds_are_written_once_and_equal_values_have_no_lambda(spark, monkeypatch):
    names = []
    monkeypatch.setattr(study, "stored", lambda df, name: names.append(name) or stored(df, name))
    rows = spark.createDataFrame([(i, float(i % 7), i % 2, i % 3) for i in range(60)], "k long, a double, y int, fold int")
    parts = study.prepare_folds(rows, FeatureSpec(key="k", target="y", standard=["a"]))
    # every pass of every fold's fits ranked the rows again
    assert names[0] == "folds" and names.count("folds") == 1 and [p.train.count() for p in parts] == [40] * 3
    # rounding of merged sums passed for a variance
    assert transform.fit_power_lambda(spark.createDataFrame([(0.1,)] * 7 + [(None,), (NAN,)], "v double").repartition(3), "v") == 1.0
