"""Projection, union, dedup and row selection."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, NumericType

from tabprep.functions.rng import uniform


def common_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """Intersection of two schemas in the left frame's order."""
    right = set(b.columns)
    return [c for c in a.columns if c in right]


def _wider(a: NumericType, b: NumericType) -> str:
    """A numeric type that holds both: double if either is floating, a decimal
    with both sides' digits if either is decimal (double beyond 38), else bigint."""
    if isinstance(a, (DoubleType, FloatType)) or isinstance(b, (DoubleType, FloatType)):
        return "double"
    if not (isinstance(a, DecimalType) or isinstance(b, DecimalType)):
        return "bigint"
    sides = [(t.precision - t.scale, t.scale) if isinstance(t, DecimalType) else (19, 0) for t in (a, b)]
    whole, scale = max(w for w, _ in sides), max(s for _, s in sides)
    return f"decimal({whole + scale},{scale})" if whole + scale <= 38 else "double"


def union_sources(a: DataFrame, b: DataFrame, drop: Sequence[str] = (), dedup: bool = True) -> DataFrame:
    """Drop identifiers (tolerant), keep common columns, union all by
    name with numeric widening, then full-row dedup (NULLs group together)."""
    a = a.drop(*drop)
    b = b.drop(*drop)
    cols = common_columns(a, b)
    ta, tb = dict(a.dtypes), dict(b.dtypes)
    sel_a, sel_b = [], []
    fa = {f.name: f.dataType for f in a.schema.fields}
    fb = {f.name: f.dataType for f in b.schema.fields}
    for c in cols:
        if ta[c] != tb[c] and isinstance(fa[c], NumericType) and isinstance(fb[c], NumericType):
            wide = _wider(fa[c], fb[c])
            sel_a.append(F.col(c).cast(wide).alias(c))
            sel_b.append(F.col(c).cast(wide).alias(c))
        else:
            sel_a.append(F.col(c))
            sel_b.append(F.col(c))
    out = a.select(*sel_a).unionByName(b.select(*sel_b))
    return out.dropDuplicates() if dedup else out


def duplicate_count(df: DataFrame) -> DataFrame:
    """P5: rows beyond the first of each identical group (one partial agg)."""
    return (df.groupBy(*df.columns).count()
            .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("duplicates")))


def facet_filter(df: DataFrame, members: dict | None = None, ranges: dict | None = None) -> DataFrame:
    """Isin per facet and inclusive ranges; empty selection rejected."""
    cond: Column | None = None
    for c, vals in (members or {}).items():
        vals = list(vals)
        if not vals:
            raise ValueError(f"empty selection for {c}")
        e = F.col(c).isin(vals)
        cond = e if cond is None else cond & e
    for c, (lo, hi) in (ranges or {}).items():
        e = F.col(c).between(F.lit(lo), F.lit(hi))
        cond = e if cond is None else cond & e
    return df if cond is None else df.where(cond)


def align_schema(df: DataFrame, columns: Sequence[str], fill=0) -> DataFrame:
    """Add missing columns as ``fill``, drop extras, fix order."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(fill).alias(c) for c in columns])


def hash_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Deterministic sample of min(n, rows): lowest hash draws (top-k plan)."""
    return (df.withColumn("_u", uniform(seed, F.col(key), "sample"))
            .orderBy("_u", key).limit(int(n)).drop("_u"))


def round_columns(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every floating column (HALF_UP)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            out.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
