"""Flagship slice: churn share by geography and balance band after IQR
outlier removal (customer_profile -> O1-O4 -> F1 -> A5/A6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabprep.functions.bins import bin_expr
from tabprep.operators.outliers import OutlierHandler
from tabprep.operators.profile import share_within
from tabprep.sources.tables import customer_profile

NUM = ["balance", "n_orders", "total_spend"]
BAL_EDGES = [-1000, 0, 2500, 5000, 7500, 10000]


def flagship(spark, sf_dir, max_iter: int = 10):
    cp = customer_profile(spark, sf_dir)
    kept = OutlierHandler(1.5, target_col="churned").remove_outliers(cp, NUM, "any", max_iter)
    banded = kept.withColumn("balance_band", bin_expr("balance", BAL_EDGES))
    counts = banded.groupBy("geography", "balance_band", "churned").agg(F.count(F.lit(1)).alias("count"))
    return share_within(counts, ["geography", "balance_band"])
