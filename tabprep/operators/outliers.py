"""IQR outliers.

Bounds are fitted by one exact, distributed quantile job for all columns
(``ranks.exact_quantiles``); masks, counts, removal and capping are lazy
column expressions. Removal iterates on the driver: each round refits bounds
on the survivors, expressed as a growing list of predicates over one base, so
lineage stays flat.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tabprep.operators.ranks import approx_quantiles, exact_quantiles
from tabprep.session import stored


def _clean(c: str) -> Column:
    # NaN -> NULL: pandas skips NaN in nunique/quantile and never flags it.
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def eligible_columns(df: DataFrame, columns: Sequence[str] | None = None,
                     target: str | None = None) -> list[str]:
    """O1: numeric (or given) columns minus target minus <= 2 distinct values.

    Two cheap aggregates instead of count(distinct) per column: min/max, then
    the count of values other than min and max.
    """
    cols = list(columns) if columns is not None else numeric_columns(df)
    cols = [c for c in cols if c != target]
    if not cols:
        return []
    mm = df.agg(*[F.min(_clean(c)).alias(f"mn{i}") for i, c in enumerate(cols)],
                *[F.max(_clean(c)).alias(f"mx{i}") for i, c in enumerate(cols)]).first()
    probe = []
    for i, c in enumerate(cols):
        mn, mx = mm[f"mn{i}"], mm[f"mx{i}"]
        if mn is None or mn == mx:
            probe.append(F.lit(0).alias(f"o{i}"))
        else:
            x = _clean(c)
            probe.append(F.max(F.when((x != F.lit(mn)) & (x != F.lit(mx)), 1).otherwise(0)).alias(f"o{i}"))
    more = df.agg(*probe).first()
    return [c for i, c in enumerate(cols) if more[f"o{i}"] == 1]


def iqr_bounds(df: DataFrame, columns: Sequence[str], multiplier: float = 1.5, method: str = "exact") -> dict:
    """O2: {col: (lower, upper)} from linear-interpolated quartiles; exact by
    default, ``method="approx"`` for a single bounded-memory aggregate."""
    q = (approx_quantiles if method == "approx" else exact_quantiles)(df, columns, [0.25, 0.75])
    out = {}
    for c in columns:
        q1, q3 = q[c]
        if q1 is None:
            out[c] = (None, None)
            continue
        iqr = q3 - q1
        out[c] = (q1 - multiplier * iqr, q3 + multiplier * iqr)
    return out


def outlier_flag(c: str, lower, upper) -> Column:
    """Strict test; NULL/NaN never an outlier."""
    if lower is None:
        return F.lit(False)
    x = _clean(c)
    return F.coalesce((x < F.lit(float(lower))) | (x > F.lit(float(upper))), F.lit(False))


def outlier_mask(df: DataFrame, bounds: dict, suffix: str = "_outlier") -> DataFrame:
    """O3 mask: one boolean column per bounded column."""
    return df.select("*", *[outlier_flag(c, lo, hi).alias(c + suffix) for c, (lo, hi) in bounds.items()])


def outlier_counts(df: DataFrame, bounds: dict) -> dict:
    """O3 counts in one aggregate."""
    if not bounds:
        return {}
    row = df.agg(*[F.sum(outlier_flag(c, lo, hi).cast("long")).alias(f"n{i}")
                   for i, (c, (lo, hi)) in enumerate(bounds.items())]).first()
    return {c: int(row[f"n{i}"] or 0) for i, c in enumerate(bounds)}


def row_flag(bounds: dict, strategy: str) -> Column:
    flags = [outlier_flag(c, lo, hi) for c, (lo, hi) in bounds.items()]
    if not flags:
        return F.lit(False)
    if strategy == "any":
        out = flags[0]
        for f_ in flags[1:]:
            out = out | f_
        return out
    if strategy == "all":
        out = flags[0]
        for f_ in flags[1:]:
            out = out & f_
        return out
    raise ValueError(f"unknown strategy {strategy!r}: a row goes if 'any' or if 'all' of its columns are outliers")


def summary_frame(spark, rounds: list, multiplier: float) -> DataFrame:
    """One row per removal round and column."""
    rows = [(r, c, int(n), lo, hi, float(multiplier)) for r, per in enumerate(rounds, 1) for c, (n, lo, hi) in per.items()]
    return spark.createDataFrame(rows, "round int, column_name string, outlier_count long, lower_bound double, upper_bound double, iqr_multiplier double")


class OutlierHandler:
    """O1-O6 with the original toolkit's call shape; state kept as small dicts."""

    def __init__(self, iqr_multiplier: float = 1.5, target_col: str | None = None, method: str = "exact"):
        self.iqr_multiplier = iqr_multiplier
        self.target_col = target_col
        self.method = method
        self.outlier_bounds: dict = {}
        self.outlier_counts: dict = {}
        self.rounds: list = []

    def detect_outliers(self, df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        cols = eligible_columns(df, columns, self.target_col)
        self.outlier_bounds = iqr_bounds(df, cols, self.iqr_multiplier, self.method)
        self.outlier_counts = outlier_counts(df, self.outlier_bounds)
        return outlier_mask(df, self.outlier_bounds).select(*[c + "_outlier" for c in cols])

    def remove_outliers(self, df: DataFrame, columns: Sequence[str] | None = None,
                        strategy: str = "any", max_iter: int = 10, persist: bool = True) -> DataFrame:
        """O4. Column list fixed once; each round refits on the survivors."""
        if strategy not in ("any", "all"):
            raise ValueError(f"unknown strategy {strategy!r}: a row goes if 'any' or if 'all' of its columns are outliers")
        base = stored(df, "outlier-base") if persist else df
        cols = eligible_columns(base, columns, self.target_col)
        keep: list[Column] = []
        self.rounds = []
        current = base
        for _ in range(max_iter):
            bounds = iqr_bounds(current, cols, self.iqr_multiplier, self.method)
            counts = outlier_counts(current, bounds)
            self.outlier_bounds, self.outlier_counts = bounds, counts
            self.rounds.append({c: (counts[c], bounds[c][0], bounds[c][1]) for c in cols})
            if sum(counts.values()) == 0:
                break
            flag = row_flag(bounds, strategy)
            if strategy == "all" and current.where(flag).limit(1).count() == 0:
                break  # nothing removable: every later round would repeat this one
            keep.append(~flag)
            cond = keep[0]
            for k in keep[1:]:
                cond = cond & k
            current = base.where(cond)
        return current

    def cap_outliers(self, df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        """Clip to bounds fitted once on ``df``; NULL stays NULL."""
        cols = eligible_columns(df, columns, self.target_col)
        bounds = iqr_bounds(df, cols, self.iqr_multiplier, self.method)
        return cap(df, bounds)

    def get_outlier_summary(self, spark=None) -> DataFrame | None:
        """One row per column of the last fit; None before any fit."""
        if not self.outlier_bounds:
            return None
        spark = spark or _active()
        rows = [(c, int(self.outlier_counts.get(c, 0)), lo, hi, float(self.iqr_multiplier))
                for c, (lo, hi) in self.outlier_bounds.items()]
        return spark.createDataFrame(rows, "column string, outlier_count long, lower_bound double, "
                                           "upper_bound double, iqr_multiplier double")


def cap(df: DataFrame, bounds: dict) -> DataFrame:
    exprs = []
    for f in df.schema.fields:
        c = f.name
        if c in bounds and bounds[c][0] is not None:
            lo, hi = bounds[c]
            x = F.col(c).cast("double")
            # greatest/least skip NULL and Spark sorts NaN last: keep both as they are.
            clipped = F.when(x.isNull() | F.isnan(x), x).when(x < F.lit(lo), F.lit(lo)) \
                .when(x > F.lit(hi), F.lit(hi)).otherwise(x)
            exprs.append(clipped.alias(c))
        else:
            exprs.append(F.col(c))
    return df.select(*exprs)


def _active():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()
