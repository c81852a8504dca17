"""Scalar column builders (F4-F7, P9-P17). All JVM-side built-ins."""

from __future__ import annotations

import re
from typing import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_ratio(num, den, eps: float = 1e-6) -> Column:
    """num / (den + eps) on doubles; NULL instead of an ANSI error on zero."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double") + F.lit(float(eps)))


def cross(a, b, sep: str = "_") -> Column:
    """a || sep || b; NULL in gives NULL out (not concat_ws)."""
    return F.concat(_c(a).cast("string"), F.lit(sep), _c(b).cast("string"))


def number_text(x) -> Column:
    """Python-style float text of a number: 2 -> '2.0', NULL -> 'nan'."""
    return F.coalesce(_c(x).cast("double").cast("string"), F.lit("nan"))


def cross_number(x, text, sep: str = "_") -> Column:
    return F.concat(number_text(x), F.lit(sep), _c(text).cast("string"))


def sum_cols(cols: Sequence) -> Column:
    out = None
    for c in cols:
        out = _c(c) if out is None else out + _c(c)
    return out


def value_map(x, mapping: Mapping, default=None) -> Column:
    """Map values through a literal table; unmapped -> default (NULL if None)."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    # try_element_at: absent key -> NULL; NULL input guarded explicitly.
    looked = F.when(_c(x).isNull(), F.lit(None)).otherwise(
        F.try_element_at(F.create_map(*pairs), _c(x)))
    return looked if default is None else F.coalesce(looked, F.lit(default))


def relabel(x, names: Mapping) -> Column:
    """when-chain without otherwise: unmapped -> NULL."""
    expr = None
    for k, v in names.items():
        cond = _c(x) == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr


def tier(x, cuts: Sequence, default: str, strict: bool = True) -> Column:
    """First cut with x > cut (or < cut when strict=False) wins; else default."""
    expr = None
    for cut, lab in cuts:
        cond = (_c(x) > F.lit(float(cut))) if strict else (_c(x) < F.lit(float(cut)))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(default))


def strip_suffixes(x, suffixes: Sequence[str]) -> Column:
    pat = "(" + "|".join(re.escape(s) for s in suffixes) + ")$"
    return F.regexp_replace(_c(x), pat, "")


def parse_number(x) -> Column:
    return F.expr(f"try_cast({x} AS DOUBLE)") if isinstance(x, str) else x.try_cast("double")


def nan_to_null(x) -> Column:
    """NaN -> NULL so that NULL-skipping aggregates and coalesce treat both alike."""
    return F.nanvl(_c(x).cast("double"), F.lit(None).cast("double"))


def round6(x) -> Column:
    return F.round(_c(x).cast("double"), 6)
