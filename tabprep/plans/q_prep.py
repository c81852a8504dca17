"""Catalog: sources, projection (P), feature creation (F) and outliers (O)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabprep.functions import exprs
from tabprep.functions.bins import bin_expr, bin_sql
from tabprep.functions.rng import sql_uniform, uniform
from tabprep.operators import outliers as O
from tabprep.operators import project as P
from tabprep.operators.create import create_features
from tabprep.plans.registry import query
from tabprep.sources.tables import CUSTOMER_PROFILE_SQL, customer_profile, table, with_cp
from tabprep.spec import IQR_MULTIPLIER, LABEL_NAMES, PROFILE_SPEC, RISK_CUTS, RISK_DEFAULT

CP_NUM = ["balance", "n_orders", "total_spend"]
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
MAX_ITER = 10


def r6(sql: str) -> str:
    return f"round(CAST({sql} AS DOUBLE), 6)"


# --------------------------------------------------------------------- P ---

@query("union_common_dedup", "P1-P4", sql="""
SELECT DISTINCT nationkey, acctbal FROM (
  SELECT c_nationkey AS nationkey, round(c_acctbal, -2) AS acctbal FROM customer
  UNION ALL
  SELECT s_nationkey AS nationkey, round(s_acctbal, -2) AS acctbal FROM supplier)
""")
def q_union_common_dedup(spark, d):
    cust = table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.round("c_acctbal", -2).alias("acctbal"),
        F.col("c_mktsegment").alias("segment"))
    supp = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"), F.round("s_acctbal", -2).alias("acctbal"))
    return P.union_sources(cust, supp, drop=["key", "name", "not_there"])


@query("duplicate_count", "P5", sql="""
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates FROM (
  SELECT count(*) AS n FROM orders GROUP BY o_custkey, o_orderstatus, o_orderpriority)
""")
def q_duplicate_count(spark, d):
    return P.duplicate_count(table(spark, d, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority"))


FACETS = {"geography": ["EUROPE", "ASIA", "AMERICA"], "segment": ["BUILDING", "MACHINERY", "HOUSEHOLD"]}


@query("facet_filter", "P7", sql=with_cp("""
SELECT * FROM cp WHERE geography IN ('EUROPE','ASIA','AMERICA')
  AND segment IN ('BUILDING','MACHINERY','HOUSEHOLD') AND balance BETWEEN 0.0 AND 5000.0
"""))
def q_facet_filter(spark, d):
    return P.facet_filter(customer_profile(spark, d), FACETS, {"balance": (0.0, 5000.0)})


@query("facet_values", "P8", sql=with_cp("SELECT DISTINCT geography FROM cp"))
def q_facet_values(spark, d):
    return customer_profile(spark, d).select("geography").distinct()


SEG_MAP = {"AUTOMOBILE": 0, "BUILDING": 1, "FURNITURE": 2}


@query("map_default", "P9,T7", sql=with_cp("""
SELECT c_custkey, CAST(CASE segment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1
  WHEN 'FURNITURE' THEN 2 ELSE -1 END AS INTEGER) AS segment_code FROM cp
"""))
def q_map_default(spark, d):
    cp = customer_profile(spark, d)
    return cp.select("c_custkey", exprs.value_map("segment", SEG_MAP, -1).cast("int").alias("segment_code"))


@query("relabel", "P10", sql=with_cp("""
SELECT c_custkey, churned, CASE WHEN churned = 0 THEN 'Stayed' WHEN churned = 1 THEN 'Churned' END AS status
FROM cp
"""))
def q_relabel(spark, d):
    cp = customer_profile(spark, d)
    return cp.select("c_custkey", "churned", exprs.relabel("churned", LABEL_NAMES).alias("status"))


ALIGN = ["c_custkey", "balance", "Geography_Germany", "n_orders", "Age_Category_30-40"]


@query("align_schema", "P11", sql=with_cp("""
SELECT c_custkey, balance, 0 AS "Geography_Germany", n_orders, 0 AS "Age_Category_30-40" FROM cp
"""))
def q_align_schema(spark, d):
    return P.align_schema(customer_profile(spark, d), ALIGN, fill=0)


@query("hash_sample", "P12", sql=with_cp(f"""
SELECT * FROM cp ORDER BY {sql_uniform(42, 'c_custkey', 'sample')}, c_custkey LIMIT 100
"""))
def q_hash_sample(spark, d):
    return P.hash_sample(customer_profile(spark, d), 100, "c_custkey", seed=42)


@query("rounded", "P14", sql=with_cp("""
SELECT c_custkey, round(balance / 7.0, 4) AS balance_7, round(total_spend / 3.0, 4) AS spend_3 FROM cp
"""))
def q_rounded(spark, d):
    cp = customer_profile(spark, d)
    return P.round_columns(cp.select("c_custkey", (F.col("balance") / 7.0).alias("balance_7"),
                                     (F.col("total_spend") / 3.0).alias("spend_3")), 4)


@query("numeric_text", "P15", sql=with_cp("""
SELECT c_custkey, TRY_CAST(CAST(n_orders AS VARCHAR) AS DOUBLE) AS orders_parsed,
       TRY_CAST(segment AS DOUBLE) AS segment_parsed FROM cp
"""))
def q_numeric_text(spark, d):
    cp = customer_profile(spark, d)
    return cp.select("c_custkey", exprs.parse_number(F.col("n_orders").cast("string")).alias("orders_parsed"),
                     exprs.parse_number(F.col("segment")).alias("segment_parsed"))


SCORE_SQL = sql_uniform(42, "c_custkey", "score")


@query("risk_tier", "P17", sql=with_cp(f"""
SELECT c_custkey, {SCORE_SQL} * 100 AS churn_pct,
  CASE WHEN {SCORE_SQL} * 100 > 70.0 THEN 'High' WHEN {SCORE_SQL} * 100 > 40.0 THEN 'Medium' ELSE 'Low' END AS tier,
  CASE WHEN {SCORE_SQL} >= 0.5 THEN 'HIGH RISK' ELSE 'LOW RISK' END AS risk_label
FROM cp
"""))
def q_risk_tier(spark, d):
    from tabprep.operators.score import risk_tier
    cp = customer_profile(spark, d).select("c_custkey", uniform(42, F.col("c_custkey"), "score").alias("p"))
    cp = cp.withColumn("prediction", (F.col("p") >= 0.5).cast("int"))
    out = risk_tier(cp, "p", "prediction", cuts=RISK_CUTS, default=RISK_DEFAULT)
    return out.select("c_custkey", (F.col("p") * 100).alias("churn_pct"), "tier", "risk_label")


# --------------------------------------------------------------------- F ---

SIZE_EDGES = [0, 10, 20, 30, 40, 50]
PRICE_EDGES = [900, 925, 950, 975, 1000]


@query("bins_right_closed", "F1,F2", sql=f"""
SELECT p_partkey, {bin_sql('p_size', SIZE_EDGES)} AS size_band,
       {bin_sql('p_retailprice', PRICE_EDGES, ['low', 'mid', 'high', 'top'])} AS price_band FROM part
""")
def q_bins_right_closed(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", bin_expr("p_size", SIZE_EDGES).alias("size_band"),
                    bin_expr("p_retailprice", PRICE_EDGES, ["low", "mid", "high", "top"]).alias("price_band"))


@query("bins_left_closed", "F3", sql=f"""
SELECT p_partkey, {bin_sql('p_size', SIZE_EDGES, right=False, include_lowest=False)} AS size_band FROM part
""")
def q_bins_left_closed(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", bin_expr("p_size", SIZE_EDGES, right=False, include_lowest=False).alias("size_band"))


@query("ratio_eps", "F4", sql=with_cp("""
SELECT c_custkey, total_spend / (balance + 1e-6) AS spend_balance_ratio FROM cp
"""))
def q_ratio_eps(spark, d):
    cp = customer_profile(spark, d)
    return cp.select("c_custkey", exprs.safe_ratio("total_spend", "balance").alias("spend_balance_ratio"))


@query("cross_text", "F5", sql=with_cp("SELECT c_custkey, geography || '_' || segment AS geo_segment FROM cp"))
def q_cross_text(spark, d):
    return customer_profile(spark, d).select("c_custkey", exprs.cross("geography", "segment").alias("geo_segment"))


@query("sum_cols", "F6", sql=with_cp("SELECT c_custkey, n_orders + has_urgent AS activity FROM cp"))
def q_sum_cols(spark, d):
    return customer_profile(spark, d).select("c_custkey", exprs.sum_cols(["n_orders", "has_urgent"]).alias("activity"))


@query("cross_number_text", "F7", sql=with_cp("""
SELECT c_custkey, coalesce(CAST(CAST(n_orders + has_urgent AS DOUBLE) AS VARCHAR), 'nan') || '_' || segment
  AS activity_segment FROM cp
"""))
def q_cross_number_text(spark, d):
    cp = customer_profile(spark, d)
    return cp.select("c_custkey", exprs.cross_number(exprs.sum_cols(["n_orders", "has_urgent"]), F.col("segment"))
                     .alias("activity_segment"))


def _create_all_sql() -> str:
    s = PROFILE_SPEC
    b0, b1 = s.bins
    return with_cp(f"""
SELECT *, {bin_sql(b0.column, b0.edges)} AS {b0.out}, {bin_sql(b1.column, b1.edges)} AS {b1.out},
  total_spend / (n_orders + 1e-6) AS spend_per_order,
  geography || '_' || segment AS geo_segment,
  n_orders + has_urgent AS activity,
  coalesce(CAST(CAST(n_orders + has_urgent AS DOUBLE) AS VARCHAR), 'nan') || '_' || segment AS activity_segment
FROM cp
""")


@query("create_all", "F8", sql=_create_all_sql())
def q_create_all(spark, d):
    return create_features(customer_profile(spark, d), PROFILE_SPEC)


# --------------------------------------------------------------------- O ---

def _distinct_gt2(col: str, src: str) -> str:
    return f"SELECT '{col}' AS column_name WHERE (SELECT count(DISTINCT {col}) FROM {src}) > 2"


@query("iqr_columns", "O1", sql=with_cp(" UNION ALL ".join(
    _distinct_gt2(c, "cp") for c in ["balance", "n_orders", "total_spend", "has_urgent"])))
def q_iqr_columns(spark, d):
    cp = customer_profile(spark, d)
    cols = O.eligible_columns(cp, ["balance", "n_orders", "total_spend", "has_urgent", "churned"], target="churned")
    return spark.createDataFrame([(c,) for c in cols], "column_name string")


def _bounds_sql(cols, src, m=IQR_MULTIPLIER):
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS column_name,
  quantile_cont({c}, 0.25) - {m} * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lower_bound,
  quantile_cont({c}, 0.75) + {m} * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS upper_bound
FROM {src}""")
    return " UNION ALL ".join(parts)


@query("iqr_bounds", "O2", sql=f"""
SELECT column_name, lower_bound, upper_bound
FROM ({_bounds_sql(LI_NUM, 'lineitem')})
""")
def q_iqr_bounds(spark, d):
    li = table(spark, d, "lineitem")
    b = O.iqr_bounds(li, LI_NUM)
    rows = [(c, lo, hi) for c, (lo, hi) in b.items()]
    return spark.createDataFrame(rows, "column_name string, lower_bound double, upper_bound double")


@query("iqr_mask_counts", "O3", sql=f"""
WITH b AS ({_bounds_sql(LI_NUM, 'lineitem')})
SELECT b.column_name, CAST(sum(CASE
  {' '.join(f"WHEN b.column_name = '{c}' THEN CASE WHEN l.{c} < b.lower_bound OR l.{c} > b.upper_bound THEN 1 ELSE 0 END" for c in LI_NUM)}
  END) AS BIGINT) AS outlier_count
FROM lineitem l, b GROUP BY b.column_name
""")
def q_iqr_mask_counts(spark, d):
    li = table(spark, d, "lineitem")
    b = O.iqr_bounds(li, LI_NUM)
    counts = O.outlier_counts(li, b)
    return spark.createDataFrame([(c, n) for c, n in counts.items()], "column_name string, outlier_count long")


def _remove_sql(cols, strategy, max_iter=MAX_ITER, m=IQR_MULTIPLIER, summary=False):
    ctes = ["r0 AS (SELECT * FROM cp)"]
    joiner = " OR " if strategy == "any" else " AND "
    for i in range(1, max_iter + 1):
        qs = ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in cols)
        ctes.append(f"b{i} AS (SELECT {qs} FROM r{i-1})")
        bnd = ", ".join(f"q1_{c} - {m} * (q3_{c} - q1_{c}) AS lo_{c}, q3_{c} + {m} * (q3_{c} - q1_{c}) AS hi_{c}"
                        for c in cols)
        ctes.append(f"k{i} AS (SELECT {bnd} FROM b{i})")
        flags = [f"coalesce({c} < lo_{c} OR {c} > hi_{c}, false)" for c in cols]
        ctes.append(f"r{i} AS (SELECT r{i-1}.* FROM r{i-1}, k{i} WHERE NOT ({joiner.join(flags)}))")
        cnt = " + ".join(f"sum(CASE WHEN {f} THEN 1 ELSE 0 END)" for f in flags)
        ctes.append(f"n{i} AS (SELECT {i} AS round, {cnt} AS total FROM r{i-1}, k{i})")
        per = " UNION ALL ".join(
            f"SELECT {i} AS round, '{c}' AS column_name, CAST(sum(CASE WHEN {flags[j]} THEN 1 ELSE 0 END) AS BIGINT) "
            f"AS outlier_count, any_value(lo_{c}) AS lower_bound, any_value(hi_{c}) AS upper_bound "
            f"FROM r{i-1}, k{i}" for j, c in enumerate(cols))
        ctes.append(f"s{i} AS ({per})")
    totals = " UNION ALL ".join(f"SELECT * FROM n{i}" for i in range(1, max_iter + 1))
    ctes.append(f"tot AS ({totals})")
    ctes.append(f"stop AS (SELECT coalesce(min(round), {max_iter}) AS last FROM tot WHERE total = 0)")
    if summary:
        allsum = " UNION ALL ".join(f"SELECT * FROM s{i}" for i in range(1, max_iter + 1))
        body = (f"SELECT CAST(round AS INTEGER) AS round, column_name, outlier_count, lower_bound, "
                f"upper_bound, CAST({m} AS DOUBLE) AS iqr_multiplier "
                f"FROM ({allsum}) WHERE round <= (SELECT last FROM stop)")
    else:
        body = f"SELECT * FROM r{max_iter}"
    return f"WITH cp AS ({CUSTOMER_PROFILE_SQL}),\n" + ",\n".join(ctes) + "\n" + body


@query("iqr_remove_any", "O4", sql=_remove_sql(CP_NUM, "any"))
def q_iqr_remove_any(spark, d):
    h = O.OutlierHandler(IQR_MULTIPLIER, target_col="churned")
    return h.remove_outliers(customer_profile(spark, d), CP_NUM, strategy="any", max_iter=MAX_ITER)


@query("iqr_remove_all", "O4", sql=_remove_sql(CP_NUM, "all"))
def q_iqr_remove_all(spark, d):
    h = O.OutlierHandler(IQR_MULTIPLIER, target_col="churned")
    return h.remove_outliers(customer_profile(spark, d), CP_NUM, strategy="all", max_iter=MAX_ITER)


@query("iqr_summary", "O4", sql=_remove_sql(CP_NUM, "any", summary=True))
def q_iqr_summary(spark, d):
    h = O.OutlierHandler(IQR_MULTIPLIER, target_col="churned")
    h.remove_outliers(customer_profile(spark, d), CP_NUM, strategy="any", max_iter=MAX_ITER)
    return O.summary_frame(spark, h.rounds, IQR_MULTIPLIER)


IQR_CTE = f"""
, b AS (SELECT {', '.join(f"quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo_{c}, "
                          f"quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi_{c}" for c in CP_NUM)}
       FROM cp)
"""


@query("outlier_mask", "O3", sql=with_cp(IQR_CTE + f"""
SELECT c_custkey, {', '.join(f"{c} < lo_{c} OR {c} > hi_{c} AS {c}_outlier" for c in CP_NUM)} FROM cp, b
"""))
def q_outlier_mask(spark, d):
    cp = customer_profile(spark, d).select("c_custkey", *CP_NUM)
    return O.outlier_mask(cp, O.iqr_bounds(cp, CP_NUM, IQR_MULTIPLIER)).drop(*CP_NUM)


@query("outlier_summary", "O3,O6", sql=with_cp(IQR_CTE + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", (SELECT count(*) FROM cp WHERE {c} < lo_{c} OR {c} > hi_{c}) AS outlier_count, "
    f"lo_{c} AS lower_bound, hi_{c} AS upper_bound, 1.5::DOUBLE AS iqr_multiplier FROM b" for c in CP_NUM)))
def q_outlier_summary(spark, d):
    h = O.OutlierHandler(IQR_MULTIPLIER, target_col="churned")
    h.detect_outliers(customer_profile(spark, d), CP_NUM)
    return h.get_outlier_summary(spark)


@query("iqr_cap", "O5", sql=f"""
WITH b AS (SELECT {', '.join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in LI_NUM)}
           FROM lineitem)
SELECT l_orderkey, l_linenumber,
  {', '.join(f"CASE WHEN {c} < q1_{c} - 1.5 * (q3_{c} - q1_{c}) THEN q1_{c} - 1.5 * (q3_{c} - q1_{c}) "
             f"WHEN {c} > q3_{c} + 1.5 * (q3_{c} - q1_{c}) THEN q3_{c} + 1.5 * (q3_{c} - q1_{c}) ELSE {c} END AS {c}"
             for c in LI_NUM)}
FROM lineitem, b
""")
def q_iqr_cap(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *LI_NUM)
    h = O.OutlierHandler(IQR_MULTIPLIER)
    capped = h.cap_outliers(li, LI_NUM)
    return capped.select("l_orderkey", "l_linenumber", *LI_NUM)


# -------------------------------------------------------------- flagship ---

def _flagship_sql():
    from tabprep.plans.flagship import BAL_EDGES
    base = _remove_sql(CP_NUM, "any")
    body = f"SELECT * FROM r{MAX_ITER}"
    agg = (f"SELECT geography, balance_band, churned, count, round(100.0 * count / sum(count) OVER "
           f"(PARTITION BY geography, balance_band), 6) AS percent FROM (SELECT geography, "
           f"{bin_sql('balance', BAL_EDGES)} AS balance_band, churned, count(*) AS count FROM r{MAX_ITER} "
           f"GROUP BY ALL)")
    return base[: base.rindex(body)] + agg


@query("churn_share_after_outliers", "O4,F1,A5,A6", sql=_flagship_sql())
def q_flagship(spark, d):
    from tabprep.plans.flagship import flagship
    return flagship(spark, d)
