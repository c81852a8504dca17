"""Stratified hold-out and k-fold assignment (V1, V2).

Both need each row's position inside its class in a seeded hash order. A
``row_number() over (partition by label ...)`` would put a whole class - often
most of the table - into one task. Instead the class-wise rank comes from
bucketed running counts over the hash (``ranks.running_totals``); rows that
share a hash value (rare) are ordered by key in a window over that one value.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.functions.rng import hash_int
from tabprep.operators.ranks import _group_key, running_totals


def hash_rank(df: DataFrame, key: str, group_cols: Sequence[str], seed: int = 42,
              purpose: str = "split", out: str = "_rank"):
    """0-based position of each row within its group, ordered by
    (md5-hash of seed:key:purpose, key). Returns (df with ``out``, totals dict
    {group tuple: n}, info). ``key`` must identify rows (de-duplicate first):
    rows sharing a hash value are ordered in a window over that one value."""
    g = list(group_cols)
    h = hash_int(seed, F.col(key), purpose).alias("_h")
    withh = df.select("*", h, _group_key(g).alias("_g"))
    ranked, info = running_totals(withh, "_h", g, {"cnt": F.lit(1).cast("long")})
    spans = ranked.select("_g", "_h", F.col("before_cnt").alias("_before"))
    tie = Window.partitionBy("_g", "_h").orderBy(key)
    out_df = (withh.join(spans, ["_g", "_h"])
              .withColumn(out, F.col("_before") + F.row_number().over(tie) - 1)
              .select(*df.columns, out))
    totals = {d["key"]: d["total"]["cnt"] for d in info.values()}
    if not g:
        totals.setdefault((), 0)
    return out_df, totals, info


def _half_up(x: float) -> int:
    return int(math.floor(x + 0.5))


def stratified_split(df: DataFrame, target: str, key: str, test_size: float = 0.2, seed: int = 42):
    """V1: per class, the first round(test_size * n_c) rows in hash order go to test."""
    flagged = holdout_flag(df, target, key, test_size, seed).withColumn("_test", F.col("is_test") == 1).drop("is_test")
    return flagged.where(~F.col("_test")).drop("_test"), flagged.where("_test").drop("_test")


def assign_folds(df: DataFrame, target: str, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    """V2: fold = class-wise hash rank mod k (class shares equal within one row)."""
    ranked, _, _ = hash_rank(df, key, [target], seed, "fold")
    return ranked.withColumn("fold", (F.col("_rank") % k).cast("int")).drop("_rank")


def holdout_flag(df: DataFrame, target: str, key: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """V1 as a column: is_test."""
    ranked, totals, _ = hash_rank(df, key, [target], seed, "holdout")
    cut = None
    for (cls,), n in totals.items():
        k = F.lit(_half_up(test_size * n))
        cond = F.col(target).eqNullSafe(F.lit(cls))
        cut = F.when(cond, k) if cut is None else cut.when(cond, k)
    return ranked.withColumn("is_test", (F.col("_rank") < (cut if cut is not None else F.lit(0))).cast("int")).drop("_rank")


__all__ = ["hash_rank", "stratified_split", "assign_folds", "holdout_flag"]
