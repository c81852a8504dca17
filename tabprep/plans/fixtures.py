"""Derived evaluation tables, built from ``customer_profile`` by Spark.

``scored``: one row per customer with a label (``churned``), a score from a
fixed rule over the portable hash, the label and ``has_urgent`` (floored to
two decimals, so ties occur), and a 0.5-threshold prediction. The same rule
runs in DuckDB (``SCORED_SQL``), so every metric has an exact oracle.

``variants``: the same rule with per-(method, model) weights and seeds,
unpivoted with ``stack`` (no join) and grouped into per-fold CV metrics and
test metrics, then into the metrics table the report operators read.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabprep.functions.rng import TWO_53, hash_int, sql_hash_int, sql_uniform, uniform
from tabprep.operators.evaluate import metric_row
from tabprep.sources.tables import CUSTOMER_PROFILE_SQL, customer_profile

METHODS = ["smote", "adasyn", "smote_enn", "smote_tomek", "class_weight"]
FAMILIES = ["GBT", "RandomForest", "LogisticRegression"]
N_FOLDS = 5


def _weights(i: int):
    b = 0.20 + 0.02 * (i % 7)
    return 0.9 - b, b, 0.1


def _score_col(tag: str, i: int):
    a, b, c = _weights(i)
    x = (F.lit(a) * uniform(42, F.col("c_custkey"), tag) + F.lit(b) * F.col("churned").cast("double")
         + F.lit(c) * F.col("has_urgent").cast("double"))
    return F.floor(x * F.lit(100.0)) / F.lit(100.0)


def _score_sql(tag: str, i: int) -> str:
    a, b, c = _weights(i)
    u = sql_uniform(42, "c_custkey", tag)
    x = (f"CAST({a!r} AS DOUBLE) * {u} + CAST({b!r} AS DOUBLE) * CAST(churned AS DOUBLE) "
         f"+ CAST({c!r} AS DOUBLE) * CAST(has_urgent AS DOUBLE)")
    return f"(floor(({x}) * 100.0) / 100.0)"


def scored(spark, d):
    cp = customer_profile(spark, d)
    s = cp.select(F.col("c_custkey").alias("key"), F.col("churned").alias("label"),
                  _score_col("score", 0).alias("score"))
    return s.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


SCORED_SQL = f"""
SELECT c_custkey AS key, churned AS label, {_score_sql('score', 0)} AS score,
       CAST({_score_sql('score', 0)} >= 0.5 AS INTEGER) AS prediction FROM cp
"""


def with_scored(body: str) -> str:
    return f"WITH cp AS ({CUSTOMER_PROFILE_SQL}),\nsc AS ({SCORED_SQL})\n{body}"


def variants():
    """(method, kind, Model, tag, index) for every scored variant."""
    out = []
    i = 0
    for m in METHODS:
        for f in FAMILIES:
            out.append((m, "cv", f, f"{m}:cv:{f}", i))
            i += 1
        out.append((m, "baseline", "GBT_baseline", f"{m}:baseline", i))
        i += 1
        out.append((m, "tuned", "GBT_tuned_optuna", f"{m}:tuned", i))
        i += 1
    return out


def variant_scores(spark, d):
    """cp rows x variants: ``stack`` emits one row per variant with its tag and
    weights (a generator, not a join), then one score expression runs on all."""
    cp = customer_profile(spark, d)
    vs = variants()
    args = ", ".join(f"'{m}', '{k}', '{mod}', '{tag}', CAST({_weights(i)[0]!r} AS DOUBLE), "
                     f"CAST({_weights(i)[1]!r} AS DOUBLE), CAST({_weights(i)[2]!r} AS DOUBLE)"
                     for (m, k, mod, tag, i) in vs)
    long = cp.select("c_custkey", F.col("churned").alias("label"), "has_urgent",
                     (hash_int(42, F.col("c_custkey"), "fold") % N_FOLDS).cast("int").alias("fold"),
                     F.expr(f"stack({len(vs)}, {args}) AS (method, kind, Model, tag, wa, wb, wc)"))
    h = F.conv(F.substring(F.md5(F.concat(F.lit("42:"), F.col("c_custkey").cast("string"), F.lit(":"), F.col("tag"))), 1, 15), 16, 10)
    u = F.shiftright(h.cast("bigint"), 7) / F.lit(TWO_53)
    x = F.col("wa") * u + F.col("wb") * F.col("label").cast("double") + F.col("wc") * F.col("has_urgent").cast("double")
    score = F.floor(x * F.lit(100.0)) / F.lit(100.0)
    return (long.withColumn("score", score)
            .withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
            .drop("tag", "wa", "wb", "wc", "has_urgent"))


def _variant_sql() -> str:
    parts = []
    for (m, k, mod, tag, i) in variants():
        parts.append(f"SELECT c_custkey, churned AS label, CAST({sql_hash_int(42, 'c_custkey', 'fold')} % {N_FOLDS} "
                     f"AS INTEGER) AS fold, '{m}' AS method, '{k}' AS kind, '{mod}' AS Model, "
                     f"{_score_sql(tag, i)} AS score FROM cp")
    u = " UNION ALL ".join(parts)
    return f"SELECT *, CAST(score >= 0.5 AS INTEGER) AS prediction FROM ({u})"


METRICS = ["Accuracy", "F1", "Precision", "Recall", "ROC_AUC", "PR_AUC"]


def _round_metrics(df, cols=METRICS):
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


def fold_metrics(spark, d):
    v = variant_scores(spark, d).where(F.col("kind") == "cv")
    return _round_metrics(metric_row(v, "label", "prediction", "score", ["method", "Model", "fold"]))


def test_metrics(spark, d):
    v = variant_scores(spark, d).where(F.col("kind") != "cv")
    return _round_metrics(metric_row(v, "label", "prediction", "score", ["method", "kind", "Model"]))


def cv_summary(fm):
    """V5: mean per model of F1, Precision, Recall, ROC_AUC, PR_AUC (no Accuracy)."""
    return fm.groupBy("method", "Model").agg(*[F.round(F.avg(c), 6).alias(c) for c in METRICS[1:]])


def metrics_table(spark, d):
    """S8 shape: (method, kind, Model, 6 metrics); Accuracy NULL on CV rows."""
    cv = cv_summary(fold_metrics(spark, d)).withColumn("kind", F.lit("cv"))
    return test_metrics(spark, d).unionByName(cv, allowMissingColumns=True)


# ---- SQL side -------------------------------------------------------------

def metric_sql(src: str, g: list, p: str = "") -> str:
    """E1 in SQL over ``src`` (cols: g..., label, score, prediction)."""
    gl = ", ".join(g)
    gp = (gl + ", ") if g else ""
    on = " AND ".join(f"c.{x} = {p}cm.{x}" for x in g) or "TRUE"
    part = f"PARTITION BY {gl}" if g else ""
    gsel = ", ".join(f"c.{x}" for x in g)
    gsel_p = (gsel + ", ") if g else ""
    join_g = f"USING ({gl})" if g else "ON TRUE"
    return f"""
{p}cm AS (SELECT {gp}label, prediction, count(*) AS n FROM ({src}) GROUP BY ALL),
{p}cls AS (SELECT DISTINCT {gp}cls FROM (SELECT {gp}label AS cls FROM {p}cm UNION ALL SELECT {gp}prediction AS cls FROM {p}cm)),
{p}per AS (SELECT {gsel_p}c.cls,
   sum(CASE WHEN {p}cm.label = c.cls THEN n ELSE 0 END) AS support,
   sum(CASE WHEN {p}cm.prediction = c.cls THEN n ELSE 0 END) AS predicted,
   sum(CASE WHEN {p}cm.label = c.cls AND {p}cm.prediction = c.cls THEN n ELSE 0 END) AS tp
 FROM {p}cls c JOIN {p}cm ON {on} GROUP BY ALL),
{p}pr AS (SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS p,
   CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS r FROM {p}per),
{p}f AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f1 FROM {p}pr),
{p}w AS (SELECT {gp}sum(tp) / sum(support) AS Accuracy, sum(f1 * support) / sum(support) AS F1,
   sum(p * support) / sum(support) AS Precision, sum(r * support) / sum(support) AS Recall FROM {p}f GROUP BY ALL),
{p}sd AS (SELECT {gp}score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
   sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg FROM ({src}) GROUP BY ALL),
{p}sr AS (SELECT *, sum(neg) OVER ({part} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - neg AS neg_below,
   sum(pos) OVER ({part} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
   sum(neg) OVER ({part} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM {p}sd),
{p}a AS (SELECT {gp}sum(pos * (neg_below + neg / 2.0)) / (sum(pos) * sum(neg)) AS ROC_AUC,
   sum(pos * cum_pos / (cum_pos + cum_neg)) / sum(pos) AS PR_AUC FROM {p}sr GROUP BY ALL),
{p}mr AS (SELECT {gp}round(Accuracy, 6) AS Accuracy, round(F1, 6) AS F1, round(Precision, 6) AS Precision,
   round(Recall, 6) AS Recall, round(ROC_AUC, 6) AS ROC_AUC, round(PR_AUC, 6) AS PR_AUC FROM {p}w JOIN {p}a {join_g})"""


VARIANTS_CTE = f"WITH cp AS ({CUSTOMER_PROFILE_SQL}),\nv AS ({_variant_sql()}),"


def fold_metrics_sql_ctes() -> str:
    """CTEs ending in ``fm`` (per-fold metrics)."""
    src = "SELECT method, Model, fold, label, score, prediction FROM v WHERE kind = 'cv'"
    return VARIANTS_CTE + metric_sql(src, ["method", "Model", "fold"]) + ",\nfm AS (SELECT * FROM mr)"


def metrics_table_sql_ctes() -> str:
    """CTEs ending in ``mt`` (method, kind, Model, metrics)."""
    src_cv = "SELECT method, Model, fold, label, score, prediction FROM v WHERE kind = 'cv'"
    src_t = "SELECT method, kind, Model, label, score, prediction FROM v WHERE kind <> 'cv'"
    cv = metric_sql(src_cv, ["method", "Model", "fold"])
    t = metric_sql(src_t, ["method", "kind", "Model"], p="t_")
    return (VARIANTS_CTE + cv + ",\nfm AS (SELECT * FROM mr)," + t +
            ",\ncvs AS (SELECT method, 'cv' AS kind, Model, CAST(NULL AS DOUBLE) AS Accuracy, "
            "round(avg(F1), 6) AS F1, round(avg(Precision), 6) AS Precision, round(avg(Recall), 6) AS Recall, "
            "round(avg(ROC_AUC), 6) AS ROC_AUC, round(avg(PR_AUC), 6) AS PR_AUC FROM fm GROUP BY method, Model),"
            "\nmt AS (SELECT method, kind, Model, Accuracy, F1, Precision, Recall, ROC_AUC, PR_AUC FROM t_mr "
            "UNION ALL SELECT * FROM cvs)")
