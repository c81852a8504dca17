"""Catalog: profiling and dashboard aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabprep.functions.bins import bin_expr, bin_sql
from tabprep.operators import profile as A
from tabprep.operators.project import facet_filter, hash_sample
from tabprep.functions.rng import sql_uniform
from tabprep.plans.registry import query
from tabprep.sources.tables import customer_profile, table, with_cp

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CP_COLS = ["c_custkey", "geography", "segment", "balance", "n_orders", "total_spend", "has_urgent", "churned"]


def _describe_sql(cols, src):
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25,
  round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max
FROM {src}""")
    return " UNION ALL ".join(parts)


@query("describe", "A1", sql=_describe_sql(LI_NUM, "lineitem"))
def q_describe(spark, d):
    out = A.describe(table(spark, d, "lineitem"), LI_NUM)
    return out.select("column_name", "count", *[F.round(c, 6).alias(c) for c in
                                                  ["mean", "std", "min", "p25", "p50", "p75", "max"]])


CP_TYPES = {"c_custkey": "bigint", "geography": "string", "segment": "string", "balance": "double",
            "n_orders": "int", "total_spend": "double", "has_urgent": "int", "churned": "int"}


@query("column_info", "A2", sql=with_cp(" UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, '{CP_TYPES[c]}' AS dtype, "
    f"count({c}) AS non_null FROM cp" for i, c in enumerate(CP_COLS))))
def q_column_info(spark, d):
    return A.column_info(customer_profile(spark, d))


@query("missing", "A3", sql=with_cp(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(sum(CASE WHEN {c} IS NULL "
    + ("OR isnan(" + c + ") " if CP_TYPES[c] == "double" else "")
    + f"THEN 1 ELSE 0 END) AS BIGINT) AS n_missing FROM cp" for c in CP_COLS)))
def q_missing(spark, d):
    return A.missing(customer_profile(spark, d))


@query("value_counts", "A4", sql=with_cp("""
SELECT segment, count(*) AS count, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent
FROM cp GROUP BY segment
"""))
def q_value_counts(spark, d):
    return A.value_counts(customer_profile(spark, d), "segment")


@query("two_key_counts", "A5,A10", sql=with_cp(
    "SELECT geography, churned, count(*) AS count FROM cp GROUP BY geography, churned"))
def q_two_key_counts(spark, d):
    return A.two_key_counts(customer_profile(spark, d), "geography", "churned")


@query("share_within", "A6", sql=with_cp("""
SELECT segment, churned, count(*) AS count,
  round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY segment), 6) AS percent
FROM cp GROUP BY segment, churned
"""))
def q_share_within(spark, d):
    counts = A.two_key_counts(customer_profile(spark, d), "segment", "churned")
    return A.share_within(counts, ["segment"])


@query("label_share", "A10", sql=with_cp("""
SELECT churned, count(*) AS count, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent
FROM cp GROUP BY churned
"""))
def q_label_share(spark, d):
    return A.value_counts(customer_profile(spark, d), "churned")


@query("histogram_equal", "A7", sql="""
WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
w AS (SELECT lo, (hi - lo) / 20 AS width FROM s)
SELECT CAST(least(floor((l_extendedprice - lo) / width), 19) AS INTEGER) AS bin, count(*) AS count,
  round(lo + least(floor((l_extendedprice - lo) / width), 19) * width, 6) AS bin_lo,
  round(lo + (least(floor((l_extendedprice - lo) / width), 19) + 1) * width, 6) AS bin_hi
FROM lineitem, w GROUP BY ALL
""")
def q_histogram_equal(spark, d):
    return A.histogram_equal(table(spark, d, "lineitem"), "l_extendedprice", 20)


NICE_SQL = """
, s AS (SELECT min(balance) AS lo, max(balance) AS hi FROM cp),
k AS (SELECT lo, hi, hi - lo AS span, floor(log10((hi - lo) / 30)) AS e FROM s),
w AS (SELECT CASE WHEN span / (1 * power(10, e)) <= 30 THEN 1 * power(10, e)
                  WHEN span / (2 * power(10, e)) <= 30 THEN 2 * power(10, e)
                  WHEN span / (5 * power(10, e)) <= 30 THEN 5 * power(10, e)
                  ELSE 10 * power(10, e) END AS width FROM k)
SELECT round(floor(balance / width) * width, 6) AS bin_start, churned, count(*) AS count
FROM cp, w GROUP BY ALL
"""


@query("histogram_nice", "A8", sql=with_cp(NICE_SQL))
def q_histogram_nice(spark, d):
    return A.histogram_nice(customer_profile(spark, d), "balance", label="churned")


@query("density", "A9", sql="""
WITH st AS (SELECT count(value) AS n, stddev_samp(value) AS s, min(value) AS lo, max(value) AS hi FROM events),
p AS (SELECT n, s * pow(n, -0.2) AS bw, lo, (hi - lo) / 49 AS step FROM st),
g AS (SELECT CAST(i AS INTEGER) AS g, lo + i * step AS x, bw, n FROM p, range(50) t(i)),
vc AS (SELECT value AS v, count(*) AS w FROM events WHERE value IS NOT NULL GROUP BY value)
SELECT g, round(x, 6) AS x,
  round(sum(w * exp(-0.5 * ((x - v) / bw) * ((x - v) / bw))) / (bw * sqrt(2 * pi()) * n), 9) AS density
FROM g, vc GROUP BY g, x, bw, n
""")
def q_density(spark, d):
    return A.density(table(spark, d, "events"), "value", grid=50)


KPI_FILTER = {"geography": ["EUROPE", "ASIA", "AMERICA", "AFRICA"]}


@query("kpi_row", "A11", sql=with_cp("""
SELECT count(*) AS rows, round(100.0 * avg(CAST(churned AS DOUBLE)), 6) AS label_rate,
  round(avg(balance), 6) AS mean_balance, round(avg(total_spend), 6) AS mean_total_spend,
  round(avg(n_orders), 6) AS mean_n_orders, round(100.0 * avg(CAST(has_urgent AS DOUBLE)), 6) AS pct_has_urgent,
  round(100.0 * count(*) / (SELECT count(*) FROM cp), 6) AS pct_of_total
FROM cp WHERE geography IN ('EUROPE','ASIA','AMERICA','AFRICA') AND n_orders BETWEEN 5 AND 30
"""))
def q_kpi_row(spark, d):
    cp = customer_profile(spark, d)
    total = cp.count()
    sel = facet_filter(cp, KPI_FILTER, {"n_orders": (5, 30)})
    return A.kpi_row(sel, "churned", total, ["balance", "total_spend", "n_orders"], active="has_urgent")


def _corr_long_sql():
    parts = []
    for a in LI_NUM:
        for b in LI_NUM:
            e = "max(1.0)" if a == b else f"round(corr({a}, {b}), 6)"
            parts.append(f"SELECT '{a}' AS Feature1, '{b}' AS Feature2, CAST({e} AS DOUBLE) AS Correlation FROM lineitem")
    return " UNION ALL ".join(parts)


@query("corr_long", "A12,A13", sql=_corr_long_sql())
def q_corr_long(spark, d):
    return A.corr_long(table(spark, d, "lineitem"), LI_NUM)


@query("corr_matrix", "A12", sql="SELECT Feature1 AS feature, " + ", ".join(
    f"max(CASE WHEN Feature2 = '{b}' THEN Correlation END) AS {b}" for b in LI_NUM)
    + f" FROM ({_corr_long_sql()}) GROUP BY Feature1")
def q_corr_matrix(spark, d):
    long = A.corr_long(table(spark, d, "lineitem"), LI_NUM)
    return long.groupBy(F.col("Feature1").alias("feature")).pivot("Feature2", LI_NUM).agg(F.max("Correlation"))


AGE_EDGES = [0, 5, 10, 15, 20, 100]


@query("age_groups", "A14,F3,P12", sql=with_cp(f"""
SELECT c_custkey, n_orders, {bin_sql('n_orders', AGE_EDGES, right=False, include_lowest=False)} AS orders_group,
  balance, churned
FROM cp ORDER BY {sql_uniform(42, 'c_custkey', 'sample')}, c_custkey LIMIT 200
"""))
def q_age_groups(spark, d):
    cp = customer_profile(spark, d).withColumn(
        "orders_group", bin_expr("n_orders", AGE_EDGES, right=False, include_lowest=False))
    return hash_sample(cp, 200, "c_custkey", 42).select("c_custkey", "n_orders", "orders_group", "balance", "churned")


def _det(m: list) -> str:
    """Determinant of a small matrix of SQL terms, by the first row."""
    if len(m) == 1:
        return m[0][0]
    return "(" + " + ".join(f"{'-' if j % 2 else ''}{m[0][j]} * {_det([r[:j] + r[j + 1:] for r in m[1:]])}" for j in range(len(m))) + ")"


def _vif_sql(cols: list) -> str:
    """G_jj times the j-th diagonal of the inverse Gram matrix, by cofactors."""
    n = len(cols)
    g = [[f"g{min(i, j)}_{max(i, j)}" for j in range(n)] for i in range(n)]
    sums = ", ".join(f"sum({cols[i]}::DOUBLE * {cols[j]}::DOUBLE) AS g{i}_{j}" for i in range(n) for j in range(i, n))
    minor = lambda k: _det([[g[i][j] for j in range(n) if j != k] for i in range(n) if i != k])
    rows = " UNION ALL ".join(f"SELECT '{c}' AS feature, round({g[k][k]} * {minor(k)} / {_det(g)}, 6) AS vif FROM s" for k, c in enumerate(cols))
    return f"WITH s AS (SELECT {sums} FROM lineitem) {rows}"


@query("vif", "A15", sql=_vif_sql(LI_NUM))
def q_vif(spark, d):
    return A.vif(table(spark, d, "lineitem"), LI_NUM)


@query("readiness", "A16")
def q_readiness(spark, d):
    from tabprep.operators.report import readiness_report
    return readiness_report(customer_profile(spark, d), "churned", key="c_custkey")
