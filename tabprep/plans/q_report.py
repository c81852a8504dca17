"""Catalog: metric reports (Q1-Q8, V5, V6, M8, P16) on metrics that Spark
derives from ``customer_profile`` (see ``fixtures``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabprep.functions.exprs import strip_suffixes
from tabprep.operators import report as Q
from tabprep.plans.fixtures import (FAMILIES, cv_summary, fold_metrics, fold_metrics_sql_ctes,
                                    metrics_table, metrics_table_sql_ctes, test_metrics)
from tabprep.plans.registry import query
from tabprep.spec import MODEL_SUFFIXES

M6 = ["Accuracy", "F1", "Precision", "Recall", "ROC_AUC", "PR_AUC"]
MT = metrics_table_sql_ctes()
FM = fold_metrics_sql_ctes()


@query("fold_metrics", "V4,E1", sql=FM + "\nSELECT * FROM fm")
def q_fold_metrics(spark, d):
    return fold_metrics(spark, d)


@query("cv_mean", "V5", sql=FM + """
SELECT method, Model, round(avg(F1), 6) AS F1, round(avg(Precision), 6) AS Precision, round(avg(Recall), 6) AS Recall,
  round(avg(ROC_AUC), 6) AS ROC_AUC, round(avg(PR_AUC), 6) AS PR_AUC FROM fm GROUP BY method, Model
""")
def q_cv_mean(spark, d):
    from tabprep.operators.fit import cv_mean
    means = cv_mean(fold_metrics(spark, d), ["method", "Model"])
    return means.select("method", "Model", *[F.round(c, 6).alias(c) for c in ("F1", "Precision", "Recall", "ROC_AUC", "PR_AUC")])


@query("pick_best", "V6", sql=FM + """,
cv AS (SELECT method, Model, round(avg(ROC_AUC), 6) AS ROC_AUC FROM fm GROUP BY method, Model)
SELECT method, Model, ROC_AUC FROM (SELECT *, row_number() OVER (PARTITION BY method ORDER BY ROC_AUC DESC, Model) AS r
  FROM cv) WHERE r = 1
""")
def q_pick_best(spark, d):
    cv = cv_summary(fold_metrics(spark, d)).select("method", "Model", "ROC_AUC")
    return Q.best_row(cv, "ROC_AUC", ["method"], ["Model"])


@query("metrics_union", "Q1", sql=MT + """
SELECT *, CASE WHEN kind = 'cv' THEN 'cv' ELSE 'test' END AS Type FROM mt
""")
def q_metrics_union(spark, d):
    cv = cv_summary(fold_metrics(spark, d)).withColumn("kind", F.lit("cv"))
    return Q.union_metrics(cv, test_metrics(spark, d))


UNPIV = "UNPIVOT mt ON Accuracy, F1, Precision, Recall, ROC_AUC, PR_AUC INTO NAME metric VALUE value"


@query("metric_ranks", "Q2", sql=MT + f"""
SELECT method, kind, Model, metric, value,
  CAST(row_number() OVER (PARTITION BY metric ORDER BY value DESC, method, kind, Model) AS INTEGER) AS rank
FROM ({UNPIV}) WHERE value IS NOT NULL
""")
def q_metric_ranks(spark, d):
    return Q.rank_models(metrics_table(spark, d), ["method", "kind", "Model"])


@query("metric_deltas", "Q3", sql=MT + f""",
lm AS (SELECT method, kind, metric, value FROM ({UNPIV}))
SELECT b.method, b.metric, round(b.value, 6) AS base, round(o.value, 6) AS other,
  round(o.value - b.value, 6) AS delta, round((o.value - b.value) / b.value * 100, 6) AS delta_pct
FROM lm b JOIN lm o ON b.method = o.method AND b.metric = o.metric
WHERE b.kind = 'baseline' AND o.kind = 'tuned'
""")
def q_metric_deltas(spark, d):
    t = test_metrics(spark, d)
    return Q.metric_deltas(t, ["method"], "kind", "baseline", "tuned")


@query("best_row", "Q4", sql=MT + """
SELECT * FROM (SELECT *, row_number() OVER (ORDER BY ROC_AUC DESC, method, kind, Model) AS r FROM mt
  WHERE kind <> 'cv' AND ROC_AUC IS NOT NULL) WHERE r = 1
""".replace("SELECT * FROM (SELECT *,", "SELECT method, kind, Model, Accuracy, F1, Precision, Recall, ROC_AUC, PR_AUC FROM (SELECT *,"))
def q_best_row(spark, d):
    return Q.best_row(test_metrics(spark, d), "ROC_AUC", [], ["method", "kind", "Model"])


@query("stability_class", "Q5", sql=MT + """
SELECT t.method, round(t.F1 - c.F1, 6) AS f1_diff, round(t.ROC_AUC - c.ROC_AUC, 6) AS roc_diff,
  CASE WHEN abs(t.F1 - c.F1) < 0.02 AND abs(t.ROC_AUC - c.ROC_AUC) < 0.02 THEN 'excellent'
       WHEN abs(t.F1 - c.F1) < 0.05 AND abs(t.ROC_AUC - c.ROC_AUC) < 0.05 THEN 'good' ELSE 'overfit' END AS stability
FROM mt t JOIN mt c ON t.method = c.method WHERE t.kind = 'tuned' AND c.kind = 'cv' AND c.Model = 'GBT'
""")
def q_stability_class(spark, d):
    mt = metrics_table(spark, d)
    t = mt.where(F.col("kind") == "tuned").select("method", F.col("F1").alias("tf1"), F.col("ROC_AUC").alias("troc"))
    c = mt.where((F.col("kind") == "cv") & (F.col("Model") == "GBT")).select(
        "method", F.col("F1").alias("cf1"), F.col("ROC_AUC").alias("croc"))
    j = t.join(c, "method").select("method", (F.col("tf1") - F.col("cf1")).alias("f1_raw"),
                                    (F.col("troc") - F.col("croc")).alias("roc_raw"))
    out = Q.stability_class(j, "f1_raw", "roc_raw")
    return out.select("method", F.round("f1_raw", 6).alias("f1_diff"), F.round("roc_raw", 6).alias("roc_diff"),
                      "stability")


@query("quality_class", "Q6", sql=MT + """
SELECT method, kind, Model, F1, CASE WHEN F1 > 0.85 THEN 'excellent' WHEN F1 > 0.8 THEN 'good'
  WHEN F1 > 0.75 THEN 'acceptable' ELSE 'poor' END AS quality FROM mt
""")
def q_quality_class(spark, d):
    return Q.quality_class(metrics_table(spark, d).select("method", "kind", "Model", "F1"))


@query("method_compare", "Q7", sql=MT + """
SELECT method, kind, regexp_replace(Model, '(_tuned_optuna|_baseline)$', '') AS Model,
  Accuracy, F1, Precision, Recall, ROC_AUC, PR_AUC,
  CAST(Accuracy = max(Accuracy) OVER () AS INTEGER) AS best_Accuracy, CAST(F1 = max(F1) OVER () AS INTEGER) AS best_F1,
  CAST(Precision = max(Precision) OVER () AS INTEGER) AS best_Precision,
  CAST(Recall = max(Recall) OVER () AS INTEGER) AS best_Recall,
  CAST(ROC_AUC = max(ROC_AUC) OVER () AS INTEGER) AS best_ROC_AUC, CAST(PR_AUC = max(PR_AUC) OVER () AS INTEGER) AS best_PR_AUC
FROM mt WHERE kind = 'tuned'
""")
def q_method_compare(spark, d):
    return Q.method_compare(metrics_table(spark, d))


@query("wide_lookup", "Q8", sql=MT + """,
cvm AS (SELECT Model, F1, Precision, Recall, ROC_AUC, PR_AUC FROM mt WHERE kind = 'cv' AND method = 'smote'),
lm AS (UNPIVOT cvm ON F1, Precision, Recall, ROC_AUC, PR_AUC INTO NAME metric VALUE value)
SELECT metric, """ + ", ".join(f"max(CASE WHEN Model = '{m}' THEN value END) AS {m}" for m in FAMILIES)
    + " FROM lm GROUP BY metric")
def q_wide_lookup(spark, d):
    mt = metrics_table(spark, d).where((F.col("kind") == "cv") & (F.col("method") == "smote"))
    return Q.wide_lookup(mt, "Model", FAMILIES, ["F1", "Precision", "Recall", "ROC_AUC", "PR_AUC"])


@query("tuned_verdict", "M8", sql=MT + f""",
lm AS (SELECT method, kind, metric, value FROM ({UNPIV}))
SELECT b.method, round(o.value - b.value, 6) AS delta,
  CASE WHEN o.value - b.value > 0 THEN 'improved' WHEN abs(o.value - b.value) < 0.005 THEN 'minimal' ELSE 'worse' END
  AS verdict
FROM lm b JOIN lm o ON b.method = o.method AND b.metric = o.metric
WHERE b.kind = 'baseline' AND o.kind = 'tuned' AND b.metric = 'ROC_AUC'
""")
def q_tuned_verdict(spark, d):
    t = test_metrics(spark, d)
    wide = (t.groupBy("method").agg(F.max(F.when(F.col("kind") == "baseline", F.col("ROC_AUC"))).alias("b"),
                                     F.max(F.when(F.col("kind") == "tuned", F.col("ROC_AUC"))).alias("o"))
            .select("method", (F.col("o") - F.col("b")).alias("raw")))
    return Q.tuned_verdict(wide, "raw").select("method", F.round("raw", 6).alias("delta"), "verdict")


@query("model_name_clean", "P16", sql=MT + """
SELECT DISTINCT Model, regexp_replace(Model, '(_tuned_optuna|_baseline)$', '') AS model_clean FROM mt
""")
def q_model_name_clean(spark, d):
    return (metrics_table(spark, d).select("Model").distinct()
            .withColumn("model_clean", strip_suffixes("Model", MODEL_SUFFIXES)))
