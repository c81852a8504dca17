"""Fitted column transforms (T1-T8): an Estimator/Model pair.

Every fit is a handful of aggregates whose one-row results become literals:
means and population std (T4), a power-transform lambda found by a grid
search evaluated in one pass of moments per refinement (T1, T2),
exact quantile knots (T3, via ``ranks.exact_quantiles``), category lists
(T6, one ``collect_set`` aggregate). ``transform`` is a single projection.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.functions.exprs import nan_to_null, value_map
from tabprep.operators.moments import _tree
from tabprep.operators.ranks import exact_quantiles, search_expr

# ------------------------------------------------------------- power maps ---


def yeo_johnson_expr(x: Column, lam: float) -> Column:
    """Yeo & Johnson (2000) transform with a fixed lambda."""
    x = x.cast("double")
    if abs(lam) < 1e-12:
        pos = F.log1p(x)
    else:
        pos = (F.pow(x + 1.0, F.lit(lam)) - 1.0) / F.lit(lam)
    if abs(lam - 2.0) < 1e-12:
        neg = -F.log1p(-x)
    else:
        neg = -(F.pow(-x + 1.0, F.lit(2.0 - lam)) - 1.0) / F.lit(2.0 - lam)
    return F.when(x.isNull(), F.lit(None).cast("double")).when(x >= 0, pos).otherwise(neg)


def box_cox_expr(x: Column, lam: float, shift: float = 0.0) -> Column:
    """Box & Cox (1964) on x + shift; values still <= 0 give NULL."""
    y = x.cast("double") + F.lit(float(shift))
    t = F.log(y) if abs(lam) < 1e-12 else (F.pow(y, F.lit(lam)) - 1.0) / F.lit(lam)
    return F.when(y > 0, t).otherwise(F.lit(None).cast("double"))


def _power_state(lams: np.ndarray, kind: str, shift: float):
    """State of a batch for ``moments._tree``: rows, mean and sum of squares
    around it of every lambda's power transform, (lambdas, 3)."""
    def power(log: np.ndarray, lam: float) -> np.ndarray:
        return log if abs(lam) < 1e-12 else (np.exp(lam * log) - 1.0) / lam

    def state(x: np.ndarray) -> np.ndarray:
        v, out = x[:, 0], np.zeros((len(lams), 3))
        v = v[~np.isnan(v)]
        if kind == "yj":
            at = v >= 0
            up, down = np.log1p(v[at]), np.log1p(-v[~at])
            values = (np.concatenate([power(up, lam), -power(down, 2.0 - lam)]) for lam in lams)
        else:
            log = np.log(v + shift)
            values = (power(log, lam) for lam in lams)
        if len(v):
            with np.errstate(all="ignore"):
                for i, f in enumerate(values):
                    z = f - f[0]  # equal values have no variance at all
                    mean = z.mean()
                    out[i] = len(f), f[0] + mean, ((z - mean) ** 2).sum()
        return out

    return state


def _merged_moments(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if not a[0, 0] or not b[0, 0]:
        return b if not a[0, 0] else a
    with np.errstate(all="ignore"):
        n, d = a[:, 0] + b[:, 0], b[:, 1] - a[:, 1]
        return np.column_stack([n, a[:, 1] + d * b[:, 0] / n, a[:, 2] + b[:, 2] + d * d * a[:, 0] * b[:, 0] / n])


def fit_power_lambda(df: DataFrame, col: str, kind: str = "yj", lo: float = -3.0, hi: float = 3.0,
                     steps: int = 17, rounds: int = 4, shift: float = 0.0, most_widenings: int = 8) -> float:
    """Maximum-likelihood lambda: -n/2 ln(var_pop(f)) + (lambda - 1) * J.

    Each round scores ``steps`` lambdas in one pass of mergeable moments per
    lambda, so nothing but partial sums is moved. While the best lambda sits
    on an edge of the grid the grid moves past that edge, at twice the width;
    then it narrows around the best. Values that the transform does not take
    (Box-Cox: not positive) are left out of all sums.
    """
    v = F.col("v")
    data = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    if kind == "yj":
        jac_e = F.sum(F.signum(v) * F.log1p(F.abs(v)))
    else:
        data = data.where(v + F.lit(float(shift)) > 0)
        jac_e = F.sum(F.log(v + F.lit(float(shift))))

    row = data.agg(F.count("v").alias("n"), jac_e.alias("jac")).first()

    def score(lams: list) -> list:
        got = _tree(data, ["v"], _power_state(np.array(lams), kind, float(shift)), _merged_moments, (len(lams), 3))
        ok = [] if got is None else [(lam, s / n if n else 0.0) for lam, (n, _, s) in zip(lams, got.tolist())]
        return [(-row["n"] / 2.0 * math.log(x) + (lam - 1.0) * row["jac"], lam) for lam, x in ok if x > 0 and math.isfinite(x)]

    best, a, b, widened, r = None, lo, hi, 0, 0
    while r < rounds:
        step = (b - a) / (steps - 1)
        scores = score([a + step * i for i in range(steps)])
        if not scores:
            break
        best = max(scores)[1]
        if r == 0 and widened < most_widenings and min(best - a, b - best) < step / 2:
            a, b = (best - 2 * (b - a), best + step) if best - a < b - best else (best - step, best + 2 * (b - a))
            widened += 1
            continue
        a, b, r = best - step, best + step, r + 1
    return 1.0 if best is None else best


# ------------------------------------------------------------ quantile map ---


def quantile_knots(df: DataFrame, col: str, max_knots: int = 1000) -> list:
    return all_knots(df, [col], max_knots)[col]


def all_knots(df: DataFrame, cols: Sequence[str], max_knots: int = 1000) -> dict:
    """{column: knots}; columns with as many knots are read in one pass."""
    if not cols:
        return {}
    row = df.agg(*[F.count(nan_to_null(c)).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    by_size: dict = {}
    for i, c in enumerate(cols):
        by_size.setdefault(max(2, min(max_knots, row[f"n{i}"])), []).append(c)
    out: dict = {}
    for nq, some in by_size.items():
        out.update(exact_quantiles(df, some, [i / (nq - 1) for i in range(nq)]))
    return out


def quantile_uniform_expr(x: Column, knots: Sequence[float]) -> Column:
    """Map to [0, 1] by interpolating between knots (references i/(nq-1));
    on a repeated knot the value is the middle of its reference span; outside
    the knots 0 and 1."""
    nq = len(knots)
    refs = [i / (nq - 1) for i in range(nq)]
    vals, lo_ref, hi_ref = [], [], []
    for v, r in zip(knots, refs):
        if vals and v == vals[-1]:
            hi_ref[-1] = r
        else:
            vals.append(float(v))
            lo_ref.append(r)
            hi_ref.append(r)
    xd = x.cast("double")
    j = search_expr(xd, vals)  # number of distinct knots <= x
    arr_v = F.array(*[F.lit(v) for v in vals])
    arr_lo = F.array(*[F.lit(r) for r in lo_ref])
    arr_hi = F.array(*[F.lit(r) for r in hi_ref])
    left_v = F.element_at(arr_v, j)
    right_v = F.element_at(arr_v, j + 1)
    at_knot = (F.element_at(arr_lo, j) + F.element_at(arr_hi, j)) / 2.0
    between = F.element_at(arr_hi, j) + (xd - left_v) * (F.element_at(arr_lo, j + 1) - F.element_at(arr_hi, j)) \
        / (right_v - left_v)
    last = len(vals)
    return (F.when(xd.isNull(), F.lit(None).cast("double"))
            .when(j == 0, F.lit(0.0))
            .when(xd == left_v, at_knot)
            .when(j == last, F.lit(1.0))
            .otherwise(between))


def knot_table(knots: Sequence[float]):
    """Distinct knots with their reference span: rows (j, v, lo, hi, v_next, lo_next)."""
    nq = len(knots)
    refs = [i / (nq - 1) for i in range(nq)]
    vals, lo_ref, hi_ref = [], [], []
    for v, r in zip(knots, refs):
        if vals and v == vals[-1]:
            hi_ref[-1] = r
        else:
            vals.append(float(v))
            lo_ref.append(r)
            hi_ref.append(r)
    rows = []
    for j in range(1, len(vals) + 1):
        nxt = (vals[j], lo_ref[j]) if j < len(vals) else (None, None)
        rows.append((j, vals[j - 1], lo_ref[j - 1], hi_ref[j - 1], nxt[0], nxt[1]))
    return vals, rows


def quantile_uniform(df: DataFrame, col: str, knots: Sequence[float], out: str | None = None) -> DataFrame:
    """T3 apply for many knots: ``Bucketizer`` (JVM binary search) finds the
    knot interval, a broadcast join with the knot table (at most
    ``max_knots`` rows, a fixed bound) supplies both ends; same result as
    ``quantile_uniform_expr``."""
    from pyspark.ml.feature import Bucketizer
    out = out or col
    vals, rows = knot_table(knots)
    splits = [-float("inf")] + vals + [float("inf")]
    tmp = f"_qj_{col}"
    b = Bucketizer(splits=splits, inputCol=f"_qx_{col}", outputCol=tmp, handleInvalid="keep")
    withx = df.withColumn(f"_qx_{col}", F.col(col).cast("double"))
    bucketed = b.transform(withx).withColumn(tmp, F.col(tmp).cast("int"))
    spark = df.sparkSession
    kt = spark.createDataFrame(rows, f"{tmp} int, _qv double, _qlo double, _qhi double, _qvn double, _qlon double")
    j = bucketed.join(F.broadcast(kt), tmp, "left")
    xd = F.col(f"_qx_{col}")
    val = (F.when(xd.isNull() | F.isnan(xd), F.lit(None).cast("double"))
           .when(F.col(tmp) == 0, F.lit(0.0))
           .when(xd == F.col("_qv"), (F.col("_qlo") + F.col("_qhi")) / 2.0)
           .when(F.col(tmp) == len(vals), F.lit(1.0))
           .otherwise(F.col("_qhi") + (xd - F.col("_qv")) * (F.col("_qlon") - F.col("_qhi"))
                      / (F.col("_qvn") - F.col("_qv"))))
    keep = [c for c in df.columns if c != out]
    res = j.select(*[F.col(c) for c in keep], val.alias(out))
    return res.select(*[c for c in df.columns] + ([out] if out not in df.columns else []))


# --------------------------------------------------------- the transformer ---


@dataclass
class TransformParams:
    standard: dict = field(default_factory=dict)      # col -> (mean, std)
    yeo_johnson: dict = field(default_factory=dict)   # col -> (lambda, mean, std)
    box_cox: dict = field(default_factory=dict)       # col -> (lambda, shift, mean, std)
    quantile: dict = field(default_factory=dict)      # col -> knots
    value_maps: dict = field(default_factory=dict)    # col -> (mapping, default)
    onehot: dict = field(default_factory=dict)        # col -> categories (sorted, NULL last)

    @classmethod
    def from_values(cls, values: dict) -> "TransformParams":
        """The state as read back from JSON."""
        d = dict(values)
        d["value_maps"] = {c: (dict(m), default) for c, (m, default) in d["value_maps"].items()}
        for k in ("standard", "yeo_johnson", "box_cox"):
            d[k] = {c: tuple(v) for c, v in d[k].items()}
        return cls(**d)


def _moments(df: DataFrame, exprs: Mapping[str, Column]) -> dict:
    if not exprs:
        return {}
    row = df.agg(*[a for c, e in exprs.items()
                   for a in (F.avg(nan_to_null(e)).alias(f"m_{c}"), F.stddev_pop(nan_to_null(e)).alias(f"s_{c}"))]).first()  # NaN is skipped, as NULL is
    out = {}
    for c in exprs:
        m, s = row[f"m_{c}"], row[f"s_{c}"]
        out[c] = (0.0 if m is None else m, s if s else 1.0)   # no value: unchanged; zero std -> divide by 1
    return out


def _z(e: Column, mean: float, std: float) -> Column:
    return (e - F.lit(mean)) / F.lit(std)


class TableTransformer:
    """Estimator: ``fit(df) -> TableTransformerModel``."""

    def __init__(self, yeo_johnson: Sequence[str] = (), box_cox: Sequence[str] = (),
                 quantile: Sequence[str] = (), standard: Sequence[str] = (),
                 value_maps: Mapping | None = None, onehot: Sequence[str] = (),
                 max_knots: int = 1000):
        self.yj, self.bc, self.qt, self.std = list(yeo_johnson), list(box_cox), list(quantile), list(standard)
        self.maps = dict(value_maps or {})
        self.onehot = list(onehot)
        self.max_knots = max_knots

    @classmethod
    def from_spec(cls, spec) -> "TableTransformer":
        return cls(spec.yeo_johnson, spec.box_cox, spec.quantile, spec.standard, spec.value_maps, spec.onehot)

    def fit(self, df: DataFrame) -> "TableTransformerModel":
        cols = set(df.columns)
        p = TransformParams()
        lam_yj = {c: fit_power_lambda(df, c, "yj") for c in self.yj if c in cols}
        shifts = {}
        if any(c in cols for c in self.bc):
            mins = df.agg(*[F.min(c).alias(c) for c in self.bc if c in cols]).first()
            for c in self.bc:
                if c in cols:
                    mn = mins[c]
                    shifts[c] = abs(mn) + 1e-6 if mn is not None and mn <= 0 else 0.0
        lam_bc = {c: fit_power_lambda(df, c, "bc", shift=shifts[c]) for c in shifts}
        mom = _moments(df, {**{f"yj_{c}": yeo_johnson_expr(F.col(c), lam) for c, lam in lam_yj.items()},
                            **{f"bc_{c}": box_cox_expr(F.col(c), lam, shifts[c]) for c, lam in lam_bc.items()},
                            **{f"st_{c}": F.col(c).cast("double") for c in self.std if c in cols}})
        for c, lam in lam_yj.items():
            p.yeo_johnson[c] = (lam, *mom[f"yj_{c}"])
        for c, lam in lam_bc.items():
            p.box_cox[c] = (lam, shifts[c], *mom[f"bc_{c}"])
        for c in self.std:
            if c in cols:
                p.standard[c] = mom[f"st_{c}"]
        p.quantile = all_knots(df, [c for c in self.qt if c in cols], self.max_knots)
        for c, m in self.maps.items():
            if c in cols:
                p.value_maps[c] = m
        p.onehot = fit_categories(df, [c for c in self.onehot if c in cols])
        return TableTransformerModel(p)


MOST_CATEGORIES = 2_000       # a column per category
MOST_SPARSE = 1_000_000       # labels of a fitted sparse encoder


def check_categories(df: DataFrame, cols: Sequence[str], most: int) -> None:
    """Raises where a column has (by a bounded sketch) far more values than
    ``most``, before they are gathered."""
    row = df.agg(*[F.approx_count_distinct(c, 0.02).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    wide = [c for i, c in enumerate(cols) if row[f"n{i}"] > 1.1 * most]
    if wide:
        raise ValueError(f"columns {wide} have more than {most} categories")


def sparse_onehot(df: DataFrame, cols: Sequence[str], out: str = "onehot"):
    """T6, F9 for many categories: a fitted Spark ML pipeline that adds one
    sparse vector column ``out`` with an entry per category of every column in
    ``cols`` (sorted). Unseen values and NULL give zeros; the label lists stay
    in the model, at most ``MOST_SPARSE`` per column."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

    check_categories(df, cols, MOST_SPARSE)
    index, code = [f"{c}__index" for c in cols], [f"{c}__code" for c in cols]
    # unseen values get the last index, which the encoder leaves out
    stages = [StringIndexer(inputCols=list(cols), outputCols=index, stringOrderType="alphabetAsc", handleInvalid="keep"),
              OneHotEncoder(inputCols=index, outputCols=code, dropLast=True), VectorAssembler(inputCols=code, outputCol=out)]
    return Pipeline(stages=stages).fit(df)


def fit_categories(df: DataFrame, cols: Sequence[str]) -> dict:
    """Sorted distinct values per column (one aggregate); NULL appended last if
    present. Each becomes a column of its own, so more than
    ``MOST_CATEGORIES`` raise: ``sparse_onehot`` takes those."""
    if not cols:
        return {}
    check_categories(df, cols, MOST_CATEGORIES)
    row = df.agg(*[F.array_sort(F.collect_set(c)).alias(f"v_{i}") for i, c in enumerate(cols)],
                 *[F.max(F.col(c).isNull().cast("int")).alias(f"n_{i}") for i, c in enumerate(cols)]).first()
    out = {}
    for i, c in enumerate(cols):
        cats = list(row[f"v_{i}"] or [])
        if row[f"n_{i}"]:
            cats.append(None)
        out[c] = cats
    return out


def onehot_columns(cats: Mapping[str, Sequence], drop_first: bool = True) -> list:
    """Encoded (name, Column) pairs: ``col_value``; unseen values give all zeros."""
    out = []
    for c, values in cats.items():
        keep = list(values)[1:] if drop_first else list(values)
        for v in keep:
            name = f"{c}_{'nan' if v is None else v}"
            out.append((name, F.col(c).eqNullSafe(F.lit(v)).cast("double")))
    return out


class TableTransformerModel:
    def __init__(self, params: TransformParams | None):
        self.params = params

    def save(self, spark, path: str) -> None:
        """The fitted state as one JSON row written by Spark (any shared path)."""
        import json
        from dataclasses import asdict
        if self.params is None:
            raise ValueError("transformer is not fitted")
        spark.createDataFrame([(json.dumps(asdict(self.params)),)], "params string") \
            .coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> "TableTransformerModel":
        import json
        return cls(TransformParams.from_values(json.loads(spark.read.parquet(path).first()["params"])))

    def transform(self, df: DataFrame) -> DataFrame:
        if self.params is None:
            raise ValueError("transformer is not fitted")
        p = self.params
        enc_cols = [c for c in p.onehot if c in df.columns]
        out = []
        for f in df.schema.fields:
            c = f.name
            if c in enc_cols:
                continue
            if c in p.yeo_johnson:
                lam, m, s = p.yeo_johnson[c]
                out.append(_z(yeo_johnson_expr(F.col(c), lam), m, s).alias(c))
            elif c in p.box_cox:
                lam, shift, m, s = p.box_cox[c]
                out.append(_z(box_cox_expr(F.col(c), lam, shift), m, s).alias(c))
            elif c in p.quantile:
                out.append(F.col(c))  # mapped below by a bucketed lookup
            elif c in p.standard:
                m, s = p.standard[c]
                out.append(_z(F.col(c).cast("double"), m, s).alias(c))
            elif c in p.value_maps:
                mapping, default = p.value_maps[c]
                out.append(value_map(c, mapping, default).alias(c))
            else:
                out.append(F.col(c))
        out += [e.alias(n) for n, e in onehot_columns({c: p.onehot[c] for c in enc_cols})]
        res = df.select(*out)
        for c, knots in p.quantile.items():
            if c in res.columns:
                res = quantile_uniform(res, c, knots)
        return res


def standardize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """T4 alone: population z-score with moments from ``df``."""
    mom = _moments(df, {c: F.col(c).cast("double") for c in cols})
    return df.select(*[_z(F.col(c).cast("double"), *mom[c]).alias(c) if c in mom else F.col(c) for c in df.columns])
