"""Profiling and dashboard aggregates.

Everything is one or two aggregates whose output is small (per column, per
bin or per facet value); windows only run over such aggregated results.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.functions.exprs import nan_to_null
from tabprep.operators.moments import correlations, inflation, triangular
from tabprep.operators.ranks import exact_quantiles


def without_nan(df: DataFrame, col: str) -> DataFrame:
    """``df`` with NaN of a floating column as NULL: no number, no bin."""
    floating = dict(df.dtypes)[col] in ("double", "float")
    return df.withColumn(col, nan_to_null(col)) if floating else df


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A1: count, mean, sample std, min, exact quartiles, max per column."""
    cols = list(cols)
    spark = df.sparkSession
    aggs = []
    for i, c in enumerate(cols):
        x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    row = df.agg(*aggs).first()
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    rows = []
    for i, c in enumerate(cols):
        q1, q2, q3 = q[c]
        rows.append((c, int(row[f"n{i}"]), row[f"m{i}"], row[f"s{i}"], row[f"lo{i}"], q1, q2, q3, row[f"hi{i}"]))
    return spark.createDataFrame(rows, "column_name string, count long, mean double, std double, min double, "
                                       "p25 double, p50 double, p75 double, max double")


def column_info(df: DataFrame) -> DataFrame:
    """A2: name, type, non-null count (one aggregate)."""
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)]).first()
    rows = [(i, c, t, int(row[f"n{i}"])) for i, (c, t) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, dtype string, non_null long")


def missing(df: DataFrame) -> DataFrame:
    """A3: NULL (or NaN for floating columns) count per column, unpivoted."""
    exprs = []
    for f in df.schema.fields:
        x = F.col(f"`{f.name}`")
        cond = x.isNull()
        if f.dataType.typeName() in ("double", "float"):
            cond = cond | F.isnan(x)
        exprs.append(F.sum(cond.cast("long")).alias(f.name))
    wide = df.agg(*exprs)
    return wide.unpivot([], df.columns, "column_name", "n_missing")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A4: count desc + share of total x 100; the window runs on the aggregate."""
    vc = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    # the total is one aggregate turned into a literal: no window without
    # partitions and no join with a one-row frame
    total = vc.agg(F.sum("count")).first()[0] or 0
    return vc.withColumn("percent", F.round(100.0 * F.col("count") / F.lit(float(total) if total else None), 6))


def two_key_counts(df: DataFrame, dim: str, label: str) -> DataFrame:
    """A5."""
    return df.groupBy(dim, label).agg(F.count(F.lit(1)).alias("count"))


def share_within(counts: DataFrame, group_cols: Sequence[str], value: str = "count",
                 out: str = "percent") -> DataFrame:
    """100 * x / sum(x) by group, on an already aggregated frame."""
    w = Window.partitionBy(*group_cols)
    return counts.withColumn(out, F.round(100.0 * F.col(value) / F.sum(value).over(w), 6))


def histogram_equal(df: DataFrame, col: str, bins: int = 20, label: str | None = None) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed."""
    df = without_nan(df, col)
    mm = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    if mm["lo"] is None:  # no values: no bins
        lo, hi = 0.0, 0.0
    else:
        lo, hi = float(mm["lo"]), float(mm["hi"])
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    keys = [b.alias("bin")] + ([F.col(label)] if label else [])
    return (df.where(F.col(col).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
            .withColumn("bin_lo", F.round(F.lit(lo) + F.col("bin") * F.lit(width), 6))
            .withColumn("bin_hi", F.round(F.lit(lo) + (F.col("bin") + 1) * F.lit(width), 6)))


def histogram_nice(df: DataFrame, col: str, label: str | None = None, max_bins: int = 30) -> DataFrame:
    """Width from {1,2,5}x10^k, bins at multiples of the width, by label."""
    from tabprep.functions.bins import nice_width
    df = without_nan(df, col)
    mm = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    w = nice_width(mm["lo"], mm["hi"], max_bins) if mm["lo"] is not None else 1.0
    start = F.floor(F.col(col) / F.lit(w)) * F.lit(w)
    keys = [F.round(start, 6).alias("bin_start")] + ([F.col(label)] if label else [])
    return df.where(F.col(col).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def density(df: DataFrame, col: str, grid: int = 50) -> DataFrame:
    """Gaussian KDE on a grid with Scott's bandwidth std * n^(-1/5), over
    the values that are numbers; a column without any gives an empty frame.

    One aggregate with a kernel sum per grid point (``grid`` is a fixed small
    bound): partial sums only, no value is shuffled.
    """
    v = F.col(col).cast("double")
    data = df.select(v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    st = data.agg(F.count("v").alias("n"), F.stddev_samp("v").alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if not st["n"]:
        return df.sparkSession.createDataFrame([], "g int, x double, density double")
    n, s, lo, hi = int(st["n"]), float(st["s"] or 0.0), float(st["lo"]), float(st["hi"])
    bw = s * n ** (-0.2) if s > 0 else 1.0
    step = (hi - lo) / (grid - 1) if grid > 1 else 0.0
    xs = [lo + g * step for g in range(grid)]
    norm = bw * math.sqrt(2 * math.pi) * n
    sums = []
    for g, x in enumerate(xs):
        z = (F.lit(x) - F.col("v")) / F.lit(bw)
        sums.append(F.sum(F.exp(F.lit(-0.5) * z * z)).alias(f"d{g}"))
    wide = data.agg(*sums)
    stack = ", ".join(f"{g}, CAST({x!r} AS DOUBLE), d{g}" for g, x in enumerate(xs))
    return wide.select(F.expr(f"stack({grid}, {stack}) AS (g, x, s)")).select(
        F.col("g").cast("int").alias("g"), F.round("x", 6).alias("x"),
        F.round(F.col("s") / F.lit(norm), 9).alias("density"))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> dict:
    """All pairwise-complete Pearson correlations in one pass of
    mergeable co-moments; None where undefined."""
    cols = list(cols)
    if len(cols) < 2:
        return {}
    r = correlations(df, cols)
    out = {(a, b): None if math.isnan(r[i, j]) else float(r[i, j]) for i, a in enumerate(cols) for j, b in enumerate(cols)}
    out.update({(c, c): 1.0 for c in cols})
    return out


def corr_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long form (Feature1, Feature2, Correlation) of the full matrix."""
    m = corr_matrix(df, cols)
    rows = [(a, b, None if m[(a, b)] is None else round(m[(a, b)], 6)) for a in cols for b in cols]
    return df.sparkSession.createDataFrame(rows, "Feature1 string, Feature2 string, Correlation double")


def kpi_row(df: DataFrame, label: str, total_rows: int | None, means: Sequence[str],
            active: str | None = None) -> DataFrame:
    """Row count, filtered share, positive rate, means, active share (one agg)."""
    aggs = [F.count(F.lit(1)).alias("rows"), F.round(100.0 * F.avg(F.col(label).cast("double")), 6).alias("label_rate")]
    aggs += [F.round(F.avg(c), 6).alias(f"mean_{c}") for c in means]
    if active:
        aggs.append(F.round(100.0 * F.avg(F.col(active).cast("double")), 6).alias(f"pct_{active}"))
    out = df.agg(*aggs)
    if total_rows:
        out = out.withColumn("pct_of_total", F.round(100.0 * F.col("rows") / F.lit(float(total_rows)), 6))
    return out


def vif(df: DataFrame, cols: Sequence[str], top: int | None = None) -> DataFrame:
    """VIF without intercept, over the rows where every column is
    present: VIF_j = G_jj * (G^-1)_jj of the Gram matrix, from a triangular
    factor; infinite for a column that others give exactly. ``top`` keeps the
    largest only if the caller asks."""
    cols = list(cols)
    r = triangular(df, cols)
    got = inflation(r) if r is not None else [math.nan] * len(cols)
    rows = sorted(((c, float(v)) for c, v in zip(cols, got)), key=lambda x: (math.isnan(x[1]), -x[1] if not math.isnan(x[1]) else 0.0))
    return df.sparkSession.createDataFrame([(c, None if math.isnan(v) else round(v, 6)) for c, v in (rows if top is None else rows[:top])], "feature string, vif double")
