"""Catalog: evaluation metrics (E1-E9) on the derived ``scored`` table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabprep.operators import evaluate as E
from tabprep.plans.fixtures import metric_sql, scored, with_scored
from tabprep.plans.registry import query


def r6(df, cols):
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


@query("class_report", "E2", sql=with_scored("""
, cm AS (SELECT label, prediction, count(*) AS n FROM sc GROUP BY ALL),
cls AS (SELECT DISTINCT cls FROM (SELECT label AS cls FROM cm UNION ALL SELECT prediction FROM cm)),
per AS (SELECT c.cls, sum(CASE WHEN label = c.cls THEN n ELSE 0 END) AS support,
   sum(CASE WHEN prediction = c.cls THEN n ELSE 0 END) AS predicted,
   sum(CASE WHEN label = c.cls AND prediction = c.cls THEN n ELSE 0 END) AS tp FROM cls c, cm GROUP BY c.cls),
pr AS (SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS p,
   CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS r FROM per),
f AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f1 FROM pr)
SELECT CAST(cls AS VARCHAR) AS class, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1,
  CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6),
  round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f
"""))
def q_class_report(spark, d):
    return r6(E.class_report(scored(spark, d)), ["precision", "recall", "f1"])


@query("confusion", "E3", sql=with_scored("""
SELECT l.label, CAST(coalesce(sum(CASE WHEN prediction = 0 THEN 1 END), 0) AS BIGINT) AS pred_0,
  CAST(coalesce(sum(CASE WHEN prediction = 1 THEN 1 END), 0) AS BIGINT) AS pred_1
FROM (SELECT 0 AS label UNION ALL SELECT 1) l LEFT JOIN sc ON sc.label = l.label GROUP BY l.label
"""))
def q_confusion(spark, d):
    return E.confusion_matrix(scored(spark, d), classes=(0, 1))


@query("confusion_norm", "E4", sql=with_scored("""
, c AS (SELECT l.label, coalesce(sum(CASE WHEN prediction = 0 THEN 1 END), 0) AS p0,
  coalesce(sum(CASE WHEN prediction = 1 THEN 1 END), 0) AS p1
  FROM (SELECT 0 AS label UNION ALL SELECT 1) l LEFT JOIN sc ON sc.label = l.label GROUP BY l.label)
SELECT label, round(CASE WHEN p0 + p1 = 0 THEN 0.0 ELSE p0 / (p0 + p1) END, 6) AS pred_0,
  round(CASE WHEN p0 + p1 = 0 THEN 0.0 ELSE p1 / (p0 + p1) END, 6) AS pred_1 FROM c
"""))
def q_confusion_norm(spark, d):
    return r6(E.confusion_normalized(scored(spark, d), classes=(0, 1)), ["pred_0", "pred_1"])


SD = """, sd AS (SELECT score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
  sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg FROM sc GROUP BY score),
sr AS (SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - neg AS neg_below,
  sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
  sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg,
  sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM sd)
"""


def _sc(body: str) -> str:
    return with_scored(SD + body)


@query("roc_auc", "E5", sql=_sc("SELECT round(sum(pos * (neg_below + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS ROC_AUC FROM sr"))
def q_roc_auc(spark, d):
    out, _ = E.roc_auc(scored(spark, d))
    return r6(out, ["ROC_AUC"])


@query("avg_precision", "E6", sql=_sc("SELECT round(sum(pos * cum_pos / (cum_pos + cum_neg)) / sum(pos), 6) AS PR_AUC FROM sr"))
def q_avg_precision(spark, d):
    out, _ = E.average_precision(scored(spark, d))
    return r6(out, ["PR_AUC"])


@query("roc_points", "E7", sql=_sc("""
SELECT round(CASE WHEN N = 0 THEN 0.0 ELSE cum_neg / N END, 6) AS fpr,
  round(CASE WHEN P = 0 THEN 0.0 ELSE cum_pos / P END, 6) AS tpr, score AS threshold FROM sr
UNION ALL SELECT 0.0, 0.0, NULL
"""))
def q_roc_points(spark, d):
    out, _ = E.roc_points(scored(spark, d))
    return r6(out, ["fpr", "tpr"])


@query("pr_points", "E8", sql=_sc("""
SELECT round(cum_pos / (cum_pos + cum_neg), 6) AS precision,
  round(CASE WHEN P = 0 THEN 1.0 ELSE cum_pos / P END, 6) AS recall, score AS threshold FROM sr
UNION ALL SELECT 1.0, 0.0, NULL
"""))
def q_pr_points(spark, d):
    out, _ = E.pr_points(scored(spark, d))
    return r6(out, ["precision", "recall"])


@query("metric_row", "E1", sql=with_scored(
    "," + metric_sql("SELECT label, score, prediction FROM sc", []) +
    "\nSELECT 'rule_score' AS Model, * FROM mr"))
def q_metric_row(spark, d):
    out = E.metric_row(scored(spark, d), model_id="rule_score")
    return r6(out, ["Accuracy", "F1", "Precision", "Recall", "ROC_AUC", "PR_AUC"])


@query("plot_tables", "E9", sql=_sc("""
, c AS (SELECT l.label, coalesce(sum(CASE WHEN prediction = 0 THEN 1 END), 0) AS p0,
  coalesce(sum(CASE WHEN prediction = 1 THEN 1 END), 0) AS p1
  FROM (SELECT 0 AS label UNION ALL SELECT 1) l LEFT JOIN sc ON sc.label = l.label GROUP BY l.label)
SELECT 'rule_score' AS model_id, 'confusion' AS plot, round(CAST(label AS DOUBLE), 6) AS x,
  round(CASE WHEN p0 + p1 = 0 THEN 0.0 ELSE p1 / (p0 + p1) END, 6) AS y, CAST(NULL AS DOUBLE) AS threshold FROM c
UNION ALL SELECT 'rule_score', 'roc', round(CASE WHEN N = 0 THEN 0.0 ELSE cum_neg / N END, 6),
  round(CASE WHEN P = 0 THEN 0.0 ELSE cum_pos / P END, 6), score FROM sr
UNION ALL SELECT 'rule_score', 'roc', 0.0, 0.0, NULL
UNION ALL SELECT 'rule_score', 'pr', round(CASE WHEN P = 0 THEN 1.0 ELSE cum_pos / P END, 6),
  round(cum_pos / (cum_pos + cum_neg), 6), score FROM sr
UNION ALL SELECT 'rule_score', 'pr', 0.0, 1.0, NULL
"""))
def q_plot_tables(spark, d):
    from tabprep.operators.report import plot_tables
    return plot_tables(scored(spark, d), "rule_score")
