"""Exact, tie-aware binary classification metrics.

All metrics start from two small aggregates: the confusion counts
``groupBy(group, label, prediction)`` and the per-distinct-score positive and
negative counts. Curves and areas need running sums over scores; those come
from ``ranks.running_totals`` (bucketed, never a single-task window).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.operators.ranks import running_totals


def _safe_div(a, b):
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def confusion_counts(df: DataFrame, label: str = "label", pred: str = "prediction",
                     group_cols: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*group_cols, F.col(label).alias("label"), F.col(pred).alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("count"))


def class_report(df: DataFrame, label: str = "label", pred: str = "prediction",
                 group_cols: Sequence[str] = ()) -> DataFrame:
    """Per class precision, recall, F1, support (0/0 -> 0); classes are the
    union of labels and predictions. Followed by accuracy, macro and weighted
    rows (class = 'accuracy' / 'macro avg' / 'weighted avg').

    One confusion aggregate; each of its cells is emitted twice (as the true
    class and as the predicted class) and summed per class - no joins."""
    g = list(group_cols)
    cm = confusion_counts(df, label, pred, g)
    zero = F.lit(0).cast("long")
    cell = F.explode(F.array(
        F.struct(F.col("label").alias("cls"), F.col("count").alias("s"), zero.alias("p"),
                 F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(zero).alias("t")),
        F.struct(F.col("prediction").alias("cls"), zero.alias("s"), F.col("count").alias("p"), zero.alias("t"))))
    per = (cm.select(*g, cell.alias("x"))
           .groupBy(*g, F.col("x.cls").alias("cls"))
           .agg(F.sum("x.s").alias("support"), F.sum("x.p").alias("predicted"), F.sum("x.t").alias("tp")))
    per = (per.withColumn("precision", _safe_div(F.col("tp"), F.col("predicted")))
           .withColumn("recall", _safe_div(F.col("tp"), F.col("support"))))
    per = per.withColumn("f1", _safe_div(2 * F.col("precision") * F.col("recall"),
                                         F.col("precision") + F.col("recall")))
    per_rows = per.select(*g, F.col("cls").cast("string").alias("class"), "precision", "recall", "f1",
                          F.col("support").cast("long").alias("support"))
    tot = per.groupBy(*g).agg(
        F.sum("support").alias("n"), F.sum("tp").alias("tp"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"),
        F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1") * F.col("support")).alias("wf"))
    n = F.col("n").cast("long").alias("support")
    acc = _safe_div(F.col("tp"), F.col("n"))
    summary = tot.select(*g, F.explode(F.array(
        F.struct(F.lit("accuracy").alias("class"), acc.alias("precision"), acc.alias("recall"), acc.alias("f1"), n),
        F.struct(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("mf").alias("f1"), n),
        F.struct(F.lit("weighted avg").alias("class"), _safe_div(F.col("wp"), F.col("n")).alias("precision"),
                 _safe_div(F.col("wr"), F.col("n")).alias("recall"), _safe_div(F.col("wf"), F.col("n")).alias("f1"),
                 n))).alias("y")).select(*g, "y.*")
    return per_rows.unionByName(summary)


MOST_CLASSES = 1000


def _classes(cm: DataFrame, classes: Sequence | None) -> list:
    """The given classes and every label or prediction that occurs, in order;
    raises where there are too many for a matrix with a column per class."""
    seen = cm.select(F.col("label").alias("c")).union(cm.select("prediction")).where("c is not null").distinct().limit(MOST_CLASSES + 1).collect()
    if len(seen) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes: a confusion matrix has a column per class")
    given = list(classes or ())
    if given:
        kind = cm.schema["label"].dataType
        cast = cm.sparkSession.range(1).select(*[F.lit(c).try_cast(kind).alias(f"c{i}") for i, c in enumerate(given)]).first()
        bad = [c for i, c in enumerate(given) if cast[i] is None]
        if bad:
            raise ValueError(f"classes {bad} are no {kind.simpleString()}, the type of the labels")
        given = list(cast)
    return given + sorted(r["c"] for r in seen if r["c"] not in given)


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction",
                     classes: Sequence | None = None, group_cols: Sequence[str] = ()) -> DataFrame:
    """Label x prediction counts, 0 filled, for labels of any type. Every
    class that occurs as a label or a prediction has a row and a column, after
    ``classes``, which always have them (and must be of the labels' type). Rows without a label or a prediction are not counted."""
    g = list(group_cols)
    cm = confusion_counts(df, label, pred, g)
    classes = _classes(cm, classes)
    kind = cm.schema["label"].dataType
    aggs = [F.sum(F.when(F.col("prediction") == F.lit(c), F.col("count")).otherwise(0)).cast("long").alias(f"pred_{c}")
            for c in classes]
    out = cm.groupBy(*g, "label").agg(*aggs)
    all_classes = F.explode(F.array(*[F.lit(c).cast(kind) for c in classes])).alias("label")
    if g:
        # every group gets every class row: explode the class list per group
        full = cm.select(*g).distinct().select(*g, all_classes)
    else:
        full = df.sparkSession.range(1).select(all_classes)
    return full.join(out, [*g, "label"], "left").fillna(0, [f"pred_{c}" for c in classes])


def confusion_normalized(df: DataFrame, label: str = "label", pred: str = "prediction",
                         classes: Sequence | None = None, group_cols: Sequence[str] = ()) -> DataFrame:
    """Rows divided by their sum, 0 where the row sum is 0."""
    cm = confusion_matrix(df, label, pred, classes, group_cols)
    cols = [c for c in cm.columns if c not in (*group_cols, "label")]
    total = sum((F.col(f"`{c}`") for c in cols), F.lit(0).cast("long"))
    return cm.select(*group_cols, "label", *[_safe_div(F.col(f"`{c}`"), total).alias(c) for c in cols])


def score_table(df: DataFrame, label: str = "label", score: str = "score",
                group_cols: Sequence[str] = ()):
    """Distinct (group, score) rows with pos/neg counts, ascending running
    totals ``before_pos``/``before_neg`` and group totals ``P``/``N``.

    Descending cumulative counts follow without a second pass:
    positives at or above s = P - before_pos(s). Returns (table, info).
    """
    g = list(group_cols)
    sums = {"pos": (F.col(label) == 1).cast("long"), "neg": (F.col(label) != 1).cast("long")}
    ranked, info = running_totals(df, score, g, sums)
    rows = [(k, int(d["total"]["pos"]), int(d["total"]["neg"])) for k, d in info.items()]
    tot = df.sparkSession.createDataFrame(rows, "_g string, P long, N long")
    # one row per group; the group count is bounded inside running_totals
    t = ranked.join(F.broadcast(tot), "_g")
    t = (t.withColumn("cum_pos_desc", F.col("P") - F.col("before_pos"))
         .withColumn("cum_neg_desc", F.col("N") - F.col("before_neg")))
    return t, info


def _auc_expr():
    return F.sum(F.col("pos") * (F.col("before_neg") + F.col("neg") / 2.0))


def _ap_expr():
    prec = F.col("cum_pos_desc") / (F.col("cum_pos_desc") + F.col("cum_neg_desc"))
    return F.sum(F.col("pos") * prec)


def roc_auc(df: DataFrame, label: str = "label", score: str = "score",
            group_cols: Sequence[str] = ()):
    """E5: Mann-Whitney AUC with ties counted half:
    sum_s pos_s * (neg_below_s + neg_s / 2) / (P * N)."""
    g = list(group_cols)
    t, info = score_table(df, label, score, g)
    part = t.groupBy(*g, "P", "N").agg(_auc_expr().alias("u"))
    out = part.select(*g, F.when((F.col("P") == 0) | (F.col("N") == 0), F.lit(None).cast("double"))
                      .otherwise(F.col("u") / (F.col("P") * F.col("N"))).alias("ROC_AUC"))
    return out, info


def average_precision(df: DataFrame, label: str = "label", score: str = "score",
                      group_cols: Sequence[str] = ()):
    """Sum over distinct scores (descending) of (R_i - R_{i-1}) * P_i
    = sum pos_i * precision_i / P."""
    g = list(group_cols)
    t, info = score_table(df, label, score, g)
    part = t.groupBy(*g, "P").agg(_ap_expr().alias("s"))
    out = part.select(*g, F.when(F.col("P") == 0, F.lit(None).cast("double"))
                      .otherwise(F.col("s") / F.col("P")).alias("PR_AUC"))
    return out, info


def _drop_collinear(t: DataFrame, score: str, info: dict) -> DataFrame:
    """Keep a point unless the next lower threshold adds the same (pos, neg)
    increments (then it lies on a straight segment); the highest and lowest
    thresholds always stay. The next lower score is a lag inside the bucket;
    for a bucket's lowest score it is the top score of the nearest non-empty
    lower bucket, from a table of one row per (group, bucket)."""
    from pyspark.sql import Window
    tops = (t.groupBy("_g", "bucket")
            .agg(F.max_by(F.struct("pos", "neg"), F.col(score)).alias("top")).collect())
    top = {(r["_g"], r["bucket"]): (r["top"]["pos"], r["top"]["neg"]) for r in tops}
    rows = []
    for gk, d in info.items():
        buckets = [b for b, _, _ in d["offsets"]]
        for prev, cur in zip(buckets[:-1], buckets[1:]):
            rows.append((gk, cur, *top[(gk, prev)]))
    edge = t.sparkSession.createDataFrame(rows, "_g string, bucket int, _bp long, _bn long")
    w = Window.partitionBy("_g", "bucket").orderBy(score)
    t = (t.withColumn("_lp", F.lag("pos").over(w)).withColumn("_ln", F.lag("neg").over(w))
         .join(F.broadcast(edge), ["_g", "bucket"], "left")  # groups x buckets rows, size-checked
         .withColumn("_lp", F.coalesce("_lp", "_bp")).withColumn("_ln", F.coalesce("_ln", "_bn")))
    highest = (F.col("cum_pos_desc") == F.col("pos")) & (F.col("cum_neg_desc") == F.col("neg"))
    lowest = F.col("_lp").isNull()
    same = (F.col("_lp") == F.col("pos")) & (F.col("_ln") == F.col("neg"))
    return t.where(highest | lowest | ~same)


def roc_points(df: DataFrame, label: str = "label", score: str = "score",
               group_cols: Sequence[str] = (), drop_intermediate: bool = False):
    """(fpr, tpr, threshold) per distinct score (descending), plus the
    (0, 0) start with a NULL threshold. All points are kept unless
    ``drop_intermediate`` removes collinear ones."""
    g = list(group_cols)
    t, info = score_table(df, label, score, g)
    if drop_intermediate:
        t = _drop_collinear(t, score, info)
    body = t.select(*g, _safe_div(F.col("cum_neg_desc"), F.col("N")).alias("fpr"),
                    _safe_div(F.col("cum_pos_desc"), F.col("P")).alias("tpr"),
                    F.col(score).cast("double").alias("threshold"))
    start = t.select(*g).distinct() if g else df.sparkSession.range(1).select()
    start = start.select(*g, F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"),
                         F.lit(None).cast("double").alias("threshold"))
    return body.unionByName(start), info


def pr_points(df: DataFrame, label: str = "label", score: str = "score",
              group_cols: Sequence[str] = ()):
    """(precision, recall, threshold) per distinct score, plus the final
    (1, 0) point with a NULL threshold."""
    g = list(group_cols)
    t, info = score_table(df, label, score, g)
    body = t.select(*g, _safe_div(F.col("cum_pos_desc"), F.col("cum_pos_desc") + F.col("cum_neg_desc")).alias("precision"),
                    F.when(F.col("P") == 0, F.lit(1.0)).otherwise(F.col("cum_pos_desc") / F.col("P")).alias("recall"),
                    F.col(score).cast("double").alias("threshold"))
    end = t.select(*g).distinct() if g else df.sparkSession.range(1).select()
    end = end.select(*g, F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
                     F.lit(None).cast("double").alias("threshold"))
    return body.unionByName(end), info


def metric_row(df: DataFrame, label: str = "label", pred: str = "prediction", score: str = "score",
               group_cols: Sequence[str] = (), model_id: str | None = None) -> DataFrame:
    """Accuracy, support-weighted F1/Precision/Recall, ROC_AUC, PR_AUC.
    One confusion aggregate and one distinct-score table feed everything."""
    g = list(group_cols)
    rep = class_report(df, label, pred, g).where(F.col("class").isin("accuracy", "weighted avg"))
    w = rep.groupBy(*g).agg(
        F.max(F.when(F.col("class") == "accuracy", F.col("f1"))).alias("Accuracy"),
        F.max(F.when(F.col("class") == "weighted avg", F.col("f1"))).alias("F1"),
        F.max(F.when(F.col("class") == "weighted avg", F.col("precision"))).alias("Precision"),
        F.max(F.when(F.col("class") == "weighted avg", F.col("recall"))).alias("Recall"))
    t, _info = score_table(df, label, score, g)
    areas = t.groupBy(*g, "P", "N").agg(_auc_expr().alias("u"), _ap_expr().alias("s")).select(
        *g, F.when((F.col("P") == 0) | (F.col("N") == 0), F.lit(None).cast("double"))
        .otherwise(F.col("u") / (F.col("P") * F.col("N"))).alias("ROC_AUC"),
        F.when(F.col("P") == 0, F.lit(None).cast("double")).otherwise(F.col("s") / F.col("P")).alias("PR_AUC"))
    # both halves have one row per group: union + group-by merges them (no join)
    names = ["Accuracy", "F1", "Precision", "Recall", "ROC_AUC", "PR_AUC"]
    out = (w.unionByName(areas, allowMissingColumns=True)
           .groupBy(*g).agg(*[F.max(c).alias(c) for c in names]))
    if model_id is not None:
        out = out.select(F.lit(model_id).alias("Model"), *out.columns)
    return out
