"""Readers for the test tables and the derived ``customer_profile`` view.

``customer_profile``: one row per customer with an order, a binary label
``churned`` (last order before a cut-off), and a few numeric and categorical
columns. Orders are pre-aggregated per customer (partial aggregation before the
shuffle), then joined to customers on the key; nation and region are
25/5-row dimension tables of the TPC-H schema (broadcast by the planner from
their measured size).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHURN_CUTOFF = "2000-07-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def customer_profile(spark: SparkSession, sf_dir: str, cutoff: str = CHURN_CUTOFF) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    per_cust = (orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).cast("int").alias("n_orders"),
        F.round(F.sum("o_totalprice"), 2).alias("total_spend"),
        F.max(F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)).cast("int").alias("has_urgent"),
        F.max("o_orderdate").alias("last_order")))
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    geo = (table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
           .join(table(spark, sf_dir, "region").select("r_regionkey", "r_name"),
                 F.col("n_regionkey") == F.col("r_regionkey")))
    cutoff_lit = F.lit(cutoff).cast("timestamp_ntz")
    return (cust.join(per_cust, cust.c_custkey == per_cust.o_custkey)
            # nation x region is a small dimension: no hint, the planner broadcasts
            # it from its measured size (autoBroadcastJoinThreshold) and falls back
            # to a shuffle join if it ever grows
            .join(geo, cust.c_nationkey == geo.n_nationkey)
            .select(F.col("c_custkey"),
                    F.col("r_name").alias("geography"),
                    F.col("c_mktsegment").alias("segment"),
                    F.col("c_acctbal").alias("balance"),
                    F.col("n_orders"), F.col("total_spend"), F.col("has_urgent"),
                    (F.col("last_order") < cutoff_lit).cast("int").alias("churned")))


CUSTOMER_PROFILE_SQL = f"""
SELECT c.c_custkey, r.r_name AS geography, c.c_mktsegment AS segment, c.c_acctbal AS balance,
       o.n_orders, o.total_spend, o.has_urgent, o.churned
FROM customer c
JOIN (SELECT o_custkey, CAST(count(*) AS INTEGER) AS n_orders,
             round(sum(o_totalprice), 2) AS total_spend,
             CAST(max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS INTEGER) AS has_urgent,
             CAST(max(o_orderdate) < TIMESTAMP '{CHURN_CUTOFF}' AS INTEGER) AS churned
      FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""


def with_cp(body: str) -> str:
    """Prefix a SQL body with the ``cp`` CTE."""
    return f"WITH cp AS ({CUSTOMER_PROFILE_SQL})\n{body}"
