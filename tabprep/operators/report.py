"""Metric reporting (Q1-Q8, V5, V6, M8) and bundled reports.

Inputs are metric tables: a handful of rows per model, so windows here run
over aggregated results only.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.functions.exprs import strip_suffixes, tier
from tabprep.spec import (MODEL_SUFFIXES, QUALITY_CUTS, QUALITY_DEFAULT, STABILITY_CUTS,
                          STABILITY_DEFAULT, VERDICT_MINIMAL)

METRICS = ["Accuracy", "F1", "Precision", "Recall", "ROC_AUC", "PR_AUC"]


def union_metrics(cv: DataFrame, test: DataFrame) -> DataFrame:
    """Q1: CV and test rows with a Type tag; Accuracy NULL for CV."""
    return (test.withColumn("Type", F.lit("test"))
            .unionByName(cv.withColumn("Type", F.lit("cv")), allowMissingColumns=True))


def long_metrics(df: DataFrame, id_cols: Sequence[str], metrics: Sequence[str] = METRICS) -> DataFrame:
    have = [m for m in metrics if m in df.columns]
    return df.unpivot(list(id_cols), have, "metric", "value")


def rank_models(df: DataFrame, id_cols: Sequence[str], part_cols: Sequence[str] = (),
                metrics: Sequence[str] = METRICS) -> DataFrame:
    """Q2: per metric, descending position (ties broken by the id columns)."""
    lm = long_metrics(df, id_cols, metrics).where(F.col("value").isNotNull())
    w = Window.partitionBy(*part_cols, "metric").orderBy(F.col("value").desc(), *id_cols)
    return lm.withColumn("rank", F.row_number().over(w))


def metric_deltas(df: DataFrame, key_cols: Sequence[str], kind_col: str, base: str, other: str,
                  metrics: Sequence[str] = METRICS) -> DataFrame:
    """Q3: other - base per metric, and percent of base."""
    lm = long_metrics(df.drop("Model") if "Model" not in key_cols else df, [*key_cols, kind_col], metrics)
    b = lm.where(F.col(kind_col) == base).select(*key_cols, "metric", F.col("value").alias("base"))
    o = lm.where(F.col(kind_col) == other).select(*key_cols, "metric", F.col("value").alias("other"))
    j = b.join(o, [*key_cols, "metric"])
    return j.select(*key_cols, "metric", F.round("base", 6).alias("base"), F.round("other", 6).alias("other"),
                    F.round(F.col("other") - F.col("base"), 6).alias("delta"),
                    F.round(F.try_divide(F.col("other") - F.col("base"), F.col("base")) * 100, 6).alias("delta_pct"))


def best_row(df: DataFrame, by: str, part_cols: Sequence[str] = (), tie: Sequence[str] = ("Model",)) -> DataFrame:
    """Q4 / V6: first row by ``by`` descending (ties: tie columns ascending)."""
    w = Window.partitionBy(*part_cols).orderBy(F.col(by).desc(), *tie)
    return df.where(F.col(by).isNotNull()).withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def stability_class(df: DataFrame, f1_diff: str, roc_diff: str) -> DataFrame:
    """Q5: both |diff| < 0.02 excellent, both < 0.05 good, else overfit."""
    a, b = F.abs(F.col(f1_diff)), F.abs(F.col(roc_diff))
    expr = None
    for cut, lab in STABILITY_CUTS:
        cond = (a < F.lit(cut)) & (b < F.lit(cut))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return df.withColumn("stability", expr.otherwise(F.lit(STABILITY_DEFAULT)))


def quality_class(df: DataFrame, f1: str = "F1") -> DataFrame:
    """Q6: F1 > 0.85 / > 0.80 / > 0.75 / else."""
    return df.withColumn("quality", tier(F.col(f1), QUALITY_CUTS, QUALITY_DEFAULT))


def method_compare(metrics: DataFrame, kind: str = "tuned", metrics_cols: Sequence[str] = METRICS) -> DataFrame:
    """Q7: one row per method (given kind), clean model name, flag column maxima."""
    t = metrics.where(F.col("kind") == kind).withColumn("Model", strip_suffixes("Model", MODEL_SUFFIXES))
    w = Window.partitionBy()
    for m in metrics_cols:
        t = t.withColumn(f"best_{m}", (F.col(m) == F.max(m).over(w)).cast("int"))
    return t


def wide_lookup(metrics: DataFrame, id_col: str, models: Sequence[str], metrics_cols: Sequence[str]) -> DataFrame:
    """Q8: metric x model table (unpivot + pivot on a fixed model list)."""
    lm = long_metrics(metrics, [id_col], metrics_cols)
    return lm.groupBy("metric").pivot(id_col, list(models)).agg(F.first("value"))


def tuned_verdict(df: DataFrame, delta: str = "delta") -> DataFrame:
    """M8: > 0 improved; |delta| < 0.005 minimal; else worse."""
    d = F.col(delta)
    return df.withColumn("verdict", F.when(d > 0, "improved").when(F.abs(d) < VERDICT_MINIMAL, "minimal")
                         .otherwise("worse"))


def plot_tables(scored: DataFrame, model_id: str, label: str = "label", pred: str = "prediction",
                score: str = "score") -> DataFrame:
    """The tables behind the confusion, ROC and PR plots, in one long table."""
    from tabprep.operators.evaluate import confusion_normalized, pr_points, roc_points
    cm = confusion_normalized(scored, label, pred, (0, 1)).select(
        F.lit(model_id).alias("model_id"), F.lit("confusion").alias("plot"),
        F.col("label").cast("double").alias("x"), F.round("pred_1", 6).alias("y"),
        F.lit(None).cast("double").alias("threshold"))
    roc, _ = roc_points(scored, label, score)
    pr, _ = pr_points(scored, label, score)
    r = roc.select(F.lit(model_id).alias("model_id"), F.lit("roc").alias("plot"), F.round("fpr", 6).alias("x"),
                   F.round("tpr", 6).alias("y"), "threshold")
    p = pr.select(F.lit(model_id).alias("model_id"), F.lit("pr").alias("plot"), F.round("recall", 6).alias("x"),
                  F.round("precision", 6).alias("y"), "threshold")
    return cm.unionByName(r).unionByName(p)


def readiness_report(df: DataFrame, target: str, key: str | None = None, test_size: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """Shape, missing, dtypes, class balance, VIF, describe, split shapes
    as one (section, item, value) table."""
    from tabprep.operators.profile import describe, missing, vif
    from tabprep.operators.split import stratified_split
    spark = df.sparkSession
    rows = []
    n = df.count()
    rows += [("shape", "rows", float(n)), ("shape", "columns", float(len(df.columns)))]
    for r in missing(df).collect():
        rows.append(("missing", r["column_name"], float(r["n_missing"])))
    for c, t in df.dtypes:
        rows.append(("dtype", f"{c}:{t}", 1.0))
    for r in df.groupBy(target).count().collect():
        rows.append(("balance", str(r[target]), float(r["count"]) / n if n else 0.0))
    num = [c for c, t in df.dtypes if t in ("int", "bigint", "double", "float") and c not in (target, key)]
    for r in vif(df, num).collect():
        rows.append(("vif", r["feature"], r["vif"]))
    for r in describe(df, num).collect():
        rows += [("describe", f"{r['column_name']}:{k}", None if r[k] is None else float(r[k]))
                 for k in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")]
    if key:
        tr, te = stratified_split(df, target, key, test_size, seed)
        rows += [("split", "train_rows", float(tr.count())), ("split", "test_rows", float(te.count()))]
    return spark.createDataFrame(rows, "section string, item string, value double")
