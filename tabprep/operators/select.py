"""Feature selection.

Scores come from single aggregates over all candidate columns (pairwise
``corr``, ``var_pop``, per-class moments, binned label counts); the choice
itself is made on the driver over a table with one row per column.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from tabprep.functions.exprs import nan_to_null
from tabprep.operators.profile import corr_matrix
from tabprep.operators.ranks import exact_quantiles, search_expr

MOST_CLASSES = 10_000  # label values whose moments reach the driver


def numeric_features(df: DataFrame, target: str | None) -> list:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name != target]


def correlation_drop(df: DataFrame, cols: Sequence[str], threshold: float = 0.95):
    """Drop column j if any earlier column i has |r| > threshold (earlier
    in the given order; an already dropped i still counts; NaN r keeps)."""
    cols = list(cols)
    if len(cols) <= 1:
        return [], {}
    m = corr_matrix(df, cols)
    drop, worst = [], {}
    for j in range(1, len(cols)):
        best = None
        for i in range(j):
            r = m[(cols[i], cols[j])]
            if r is None or (isinstance(r, float) and math.isnan(r)):
                continue
            best = abs(r) if best is None else max(best, abs(r))
        worst[cols[j]] = best
        if best is not None and best > threshold:
            drop.append(cols[j])
    return drop, worst


def variances(df: DataFrame, cols: Sequence[str]) -> dict:
    """C2 scores: population variance and range per column (one aggregate),
    over its numbers (NULL and NaN are skipped)."""
    x = [nan_to_null(c) for c in cols]
    row = df.agg(*[F.var_pop(v).alias(f"v{i}") for i, v in enumerate(x)],
                 *[(F.max(v) - F.min(v)).alias(f"r{i}") for i, v in enumerate(x)]).first()
    return {c: (row[f"v{i}"], row[f"r{i}"]) for i, c in enumerate(cols)}


def variance_drop(df: DataFrame, cols: Sequence[str], threshold: float = 0.0):
    """Keep var_pop > threshold; with threshold 0 a zero range also drops."""
    v = variances(df, cols)
    drop = [c for c, (var, rng) in v.items()
            if var is None or not (var > threshold) or (threshold == 0 and not (rng and rng > 0))]
    return drop, {c: var for c, (var, _) in v.items()}


def binned(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """Quantile bins: bin = number of distinct interior cut points below x;
    NULL for NULL and NaN."""
    probs = [i / bins for i in range(1, bins)]
    q = exact_quantiles(df, cols, probs)
    out = []
    for c in cols:
        cuts = sorted(set(v for v in q[c] if v is not None))
        x = nan_to_null(c)
        # cut points below x: x reaches the next number after them
        out.append(F.when(x.isNotNull(), search_expr(x, [math.nextafter(v, math.inf) for v in cuts])).alias(c))
    return df.select(*out, *[c for c in df.columns if c not in cols])


def mutual_info(df: DataFrame, cols: Sequence[str], target: str, bins: int = 10) -> dict:
    """C3 (re-aimed): plug-in mutual information (nats) between each
    quantile-binned column and the label, from one count per (column, bin, label)
    over the rows that have both."""
    cols = list(cols)
    b = binned(df.select(*cols, target), cols, bins)
    stack = ", ".join(f"'{c}', CAST(`{c}` AS INT)" for c in cols)
    long = b.select(F.col(target).alias("_y"), F.expr(f"stack({len(cols)}, {stack}) AS (col_name, bin)"))
    cells = long.where("bin IS NOT NULL AND _y IS NOT NULL").groupBy("col_name", "bin", "_y").agg(F.count(F.lit(1)).alias("n_by"))
    from pyspark.sql import Window
    wb = Window.partitionBy("col_name", "bin")
    wy = Window.partitionBy("col_name", "_y")
    wn = Window.partitionBy("col_name")
    t = (cells.withColumn("n_b", F.sum("n_by").over(wb)).withColumn("n_y", F.sum("n_by").over(wy))
         .withColumn("n", F.sum("n_by").over(wn)))
    mi = t.groupBy("col_name").agg(F.sum(F.col("n_by") / F.col("n") * F.log(
        F.col("n_by") * F.col("n") / (F.col("n_b") * F.col("n_y")))).alias("mi"))
    return {r["col_name"]: r["mi"] for r in mi.collect()}


def f_regression(df: DataFrame, cols: Sequence[str], target: str) -> dict:
    """C4, numeric label: F = r^2 / (1 - r^2) * (n - 2), with n the rows where
    both the column and the label are present."""
    y = nan_to_null(target)
    x = [nan_to_null(c) for c in cols]
    row = df.agg(*[F.corr(v, y).alias(f"r{i}") for i, v in enumerate(x)],
                 *[F.count(F.when(v.isNotNull() & y.isNotNull(), 1)).alias(f"n{i}") for i, v in enumerate(x)]).first()
    out = {}
    for i, c in enumerate(cols):
        r, n = row[f"r{i}"], row[f"n{i}"]
        out[c] = None if r is None or r * r >= 1 else r * r / (1 - r * r) * (n - 2)
    return out


def f_anova(df: DataFrame, cols: Sequence[str], target: str) -> dict:
    """C4, categorical label: one-way ANOVA F from each class's count, mean and
    variance (per column, over its present values), so large means do not
    cancel."""
    g = df.where(F.col(target).isNotNull()).groupBy(target).agg(
        *[F.count(nan_to_null(c)).alias(f"n{i}") for i, c in enumerate(cols)],
        *[F.avg(nan_to_null(c)).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.var_pop(nan_to_null(c)).alias(f"v{i}") for i, c in enumerate(cols)]).limit(MOST_CLASSES + 1).collect()
    if len(g) > MOST_CLASSES:
        raise ValueError(f"{target} has more than {MOST_CLASSES} values: it is no class label")
    out = {}
    for i, c in enumerate(cols):
        rows = [(r[f"n{i}"], r[f"m{i}"], r[f"v{i}"]) for r in g if r[f"n{i}"]]
        k, n = len(rows), sum(r[0] for r in rows)
        if k < 2 or n <= k:
            out[c] = None
            continue
        # means relative to the first class's: the grand mean keeps its digits
        base = rows[0][1]
        grand = sum(m * (mean - base) for m, mean, _ in rows) / n
        between = sum(m * (mean - base - grand) ** 2 for m, mean, _ in rows)
        within = sum(m * v for m, _, v in rows)
        out[c] = None if within <= 0 else (between / (k - 1)) / (within / (n - k))
    return out


def keep_top(cols: Sequence[str], scores: dict, k: int | None = None, percentile: float | None = None):
    """Sort by score desc (ties: column order); keep k, else
    int(n * percentile / 100), else max(1, n // 2). Returns (keep, drop)."""
    cols = list(cols)
    n = len(cols)
    m = k if k else (int(n * percentile / 100) if percentile else max(1, n // 2))
    order = sorted(range(n), key=lambda i: (-(scores.get(cols[i]) if scores.get(cols[i]) is not None else -math.inf), i))
    keep = [cols[i] for i in order[:m]]
    return keep, [c for c in cols if c not in keep]


class FeatureSelector:
    """``correlation | variance | mutual_info | f_score``; ``fit`` -> model."""

    def __init__(self, method: str = "correlation", threshold: float = 0.95, target: str | None = None,
                 k: int | None = None, percentile: float | None = None, estimator: str = "binned"):
        """``estimator`` of mutual information: ``binned`` or ``nearest``
        (neighbours, as the original's library; text labels are classes)."""
        if estimator not in ("binned", "nearest"):
            raise ValueError(f"mutual information is 'binned' or by 'nearest' neighbours, not {estimator!r}")
        self.estimator = estimator
        if method not in ("correlation", "variance", "mutual_info", "f_score"):
            raise ValueError(f"no selection method {method!r}: correlation, variance, mutual_info or f_score")
        self.method, self.threshold, self.target, self.k, self.percentile = method, threshold, target, k, percentile

    def fit(self, df: DataFrame) -> "FeatureSelectorModel":
        cols = numeric_features(df, self.target)
        if self.method == "correlation":
            drop, scores = correlation_drop(df, cols, self.threshold)
        elif self.method == "variance":
            drop, scores = variance_drop(df, cols, self.threshold)
        else:
            if not self.target:
                raise ValueError("target column required")
            if self.method == "mutual_info" and self.estimator == "nearest":
                from tabprep.operators.mutual import mutual_info_classes, mutual_info_numbers
                text = isinstance(df.schema[self.target].dataType, StringType)
                scores = (mutual_info_classes if text else mutual_info_numbers)(df, cols, self.target)
            elif self.method == "mutual_info":
                scores = mutual_info(df, cols, self.target)
            else:
                tt = df.schema[self.target].dataType
                scores = f_anova(df, cols, self.target) if isinstance(tt, StringType) else \
                    f_regression(df, cols, self.target)
            _, drop = keep_top(cols, scores, self.k, self.percentile)
        return FeatureSelectorModel(drop, scores)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


class FeatureSelectorModel:
    def __init__(self, drop: Sequence[str] | None, scores: dict | None = None):
        self.drop = None if drop is None else list(drop)
        self.scores = scores or {}

    def transform(self, df: DataFrame) -> DataFrame:
        """Drop the fitted columns that exist; everything else passes."""
        if self.drop is None:
            raise ValueError("selector is not fitted")
        return df.drop(*[c for c in self.drop if c in df.columns])
