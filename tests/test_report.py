from pyspark.sql import functions as F

from tabprep.operators import report as Q


def _metrics(spark):
    rows = [("smote", "baseline", "GBT_baseline", 0.80, 0.81, 0.82, 0.80, 0.880, 0.70),
            ("smote", "tuned", "GBT_tuned_optuna", 0.81, 0.83, 0.82, 0.81, 0.885, 0.71),
            ("adasyn", "baseline", "GBT_baseline", 0.79, 0.78, 0.80, 0.79, 0.870, 0.69),
            ("adasyn", "tuned", "GBT_tuned_optuna", 0.78, 0.77, 0.80, 0.78, 0.867, 0.68)]
    return spark.createDataFrame(rows, "method string, kind string, Model string, Accuracy double, F1 double, "
                                       "Precision double, Recall double, ROC_AUC double, PR_AUC double")


def test_ranks_deltas_verdicts(spark):
    mt = _metrics(spark)
    r = {(x["method"], x["kind"]): x["rank"] for x in Q.rank_models(mt, ["method", "kind", "Model"])
         .where("metric = 'ROC_AUC'").collect()}
    assert r[("smote", "tuned")] == 1 and r[("adasyn", "tuned")] == 4
    d = {x["method"]: x["delta"] for x in Q.metric_deltas(mt, ["method"], "kind", "baseline", "tuned")
         .where("metric = 'ROC_AUC'").collect()}
    assert abs(d["smote"] - 0.005) < 1e-9 and abs(d["adasyn"] + 0.003) < 1e-9
    v = {x["method"]: x["verdict"] for x in Q.tuned_verdict(
        Q.metric_deltas(mt, ["method"], "kind", "baseline", "tuned").where("metric = 'ROC_AUC'"), "delta").collect()}
    assert v == {"smote": "improved", "adasyn": "minimal"}


def test_best_quality_compare(spark):
    mt = _metrics(spark)
    best = Q.best_row(mt, "ROC_AUC", [], ["method", "kind", "Model"]).collect()
    assert len(best) == 1 and best[0]["method"] == "smote" and best[0]["kind"] == "tuned"
    q = {(x["method"], x["kind"]): x["quality"] for x in Q.quality_class(mt).collect()}
    assert q[("smote", "tuned")] == "good" and q[("adasyn", "tuned")] == "acceptable"
    cmp = {x["method"]: x for x in Q.method_compare(mt).collect()}
    assert cmp["smote"]["Model"] == "GBT" and cmp["smote"]["best_ROC_AUC"] == 1 and cmp["adasyn"]["best_ROC_AUC"] == 0


def test_stability(spark):
    df = spark.createDataFrame([("a", 0.01, 0.01), ("b", 0.03, 0.01), ("c", 0.06, 0.0)], "m string, f double, r double")
    got = {x["m"]: x["stability"] for x in Q.stability_class(df, "f", "r").collect()}
    assert got == {"a": "excellent", "b": "good", "c": "overfit"}


def test_readiness_has_all_of_describe(spark):
    df = spark.createDataFrame([(i, float(i), i * i % 7 + 0.5, i % 2) for i in range(40)], "k long, a double, b double, y int")
    got = {r["item"]: r["value"] for r in Q.readiness_report(df, "y", "k").where("section = 'describe'").collect()}
    assert len(got) == 16 and got["a:count"] == 40 and got["a:min"] == 0 and got["a:max"] == 39 and got["a:p50"] == 19.5
