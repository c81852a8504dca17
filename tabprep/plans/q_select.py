"""Catalog: feature selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabprep.operators import select as C
from tabprep.plans.registry import query
from tabprep.sources.tables import customer_profile, table, with_cp

LI_SEL = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "gross"]
CP_SEL = ["balance", "n_orders", "total_spend", "has_urgent"]


def li_view(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_quantity", "l_extendedprice", "l_discount", "l_tax",
                     (F.col("l_extendedprice") * (F.lit(1.0) + F.col("l_tax"))).alias("gross"),
                     (F.col("l_returnflag") == "R").cast("int").alias("returned"))


LI_SQL = """li AS (SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_extendedprice * (1.0 + l_tax) AS gross,
  CAST(l_returnflag = 'R' AS INTEGER) AS returned FROM lineitem)"""


def _corr_sql():
    parts = []
    for j in range(1, len(LI_SEL)):
        terms = ", ".join(f"abs(corr({LI_SEL[i]}, {LI_SEL[j]}))" for i in range(j))
        expr = f"greatest({terms})" if j > 1 else terms
        parts.append(f"SELECT '{LI_SEL[j]}' AS column_name, {expr} AS max_abs_corr FROM li")
    return "WITH " + LI_SQL + ", m AS (" + " UNION ALL ".join(parts) + ")\n" + \
        "SELECT column_name, round(max_abs_corr, 6) AS max_abs_corr, CAST(max_abs_corr > 0.95 AS INTEGER) AS dropped FROM m"


@query("select_correlation", "C1,C6,C8", sql=_corr_sql())
def q_select_correlation(spark, d):
    drop, worst = C.correlation_drop(li_view(spark, d), LI_SEL, 0.95)
    rows = [(c, round(worst[c], 6), int(c in drop)) for c in LI_SEL[1:]]
    return spark.createDataFrame(rows, "column_name string, max_abs_corr double, dropped int")


@query("select_variance", "C2", sql=with_cp(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(var_pop({c}), 2) AS variance, CAST(var_pop({c}) > 0.2 AS INTEGER) AS kept FROM cp"
    for c in CP_SEL)))
def q_select_variance(spark, d):
    drop, var = C.variance_drop(customer_profile(spark, d), CP_SEL, 0.2)
    rows = [(c, round(var[c], 2), int(c not in drop)) for c in CP_SEL]
    return spark.createDataFrame(rows, "column_name string, variance double, kept int")


def _mi_sql(src: str, cols, target: str) -> str:
    probs = [i / 10 for i in range(1, 10)]
    cuts = ", ".join(f"list_distinct(quantile_cont({c}, {probs!r})) AS q_{c}" for c in cols)
    bins = " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, len(list_filter(q_{c}, lambda e: CAST({c} AS DOUBLE) > e)) AS bin, {target} AS y "
        f"FROM {src}, qs" for c in cols)
    return f"""qs AS (SELECT {cuts} FROM {src}),
b AS ({bins}),
cells AS (SELECT col_name, bin, y, count(*) AS n_by FROM b GROUP BY ALL),
t AS (SELECT *, sum(n_by) OVER (PARTITION BY col_name, bin) AS n_b, sum(n_by) OVER (PARTITION BY col_name, y) AS n_y,
        sum(n_by) OVER (PARTITION BY col_name) AS n FROM cells),
mi AS (SELECT col_name, sum(n_by / n * ln(n_by * n / (n_b * n_y))) AS mi FROM t GROUP BY col_name)"""


@query("select_mutual_info", "C3", sql=with_cp(", " + _mi_sql("cp", CP_SEL, "churned") +
                                                "\nSELECT col_name AS column_name, round(mi, 6) AS mi FROM mi"))
def q_select_mutual_info(spark, d):
    mi = C.mutual_info(customer_profile(spark, d), CP_SEL, "churned")
    return spark.createDataFrame([(c, round(mi[c], 6)) for c in CP_SEL], "column_name string, mi double")


@query("select_f_regression", "C4", sql=with_cp(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(corr({c}, churned) * corr({c}, churned) / (1 - corr({c}, churned) * "
    f"corr({c}, churned)) * (count(*) - 2), 6) AS f_score FROM cp" for c in CP_SEL)))
def q_select_f_regression(spark, d):
    f = C.f_regression(customer_profile(spark, d), CP_SEL, "churned")
    return spark.createDataFrame([(c, round(f[c], 6)) for c in CP_SEL], "column_name string, f_score double")


ANOVA_COLS = ["balance", "n_orders", "total_spend"]


@query("select_anova", "C4", sql=with_cp(", g AS (SELECT segment, count(*) AS n, " + ", ".join(
    f"avg({c}) AS m_{c}" for c in ANOVA_COLS) + " FROM cp GROUP BY segment),\n" + "a AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}" for c in ANOVA_COLS) + ", count(*) AS n FROM cp)\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round((SELECT sum(g.n * (g.m_{c} - a.m_{c}) * (g.m_{c} - a.m_{c})) FROM g, a) / "
    f"((SELECT count(*) FROM g) - 1) / ((SELECT sum(({c} - g.m_{c}) * ({c} - g.m_{c})) FROM cp JOIN g USING (segment)) / "
    f"((SELECT n FROM a) - (SELECT count(*) FROM g))), 6) AS f_score" for c in ANOVA_COLS)))
def q_select_anova(spark, d):
    f = C.f_anova(customer_profile(spark, d), ANOVA_COLS, "segment")
    return spark.createDataFrame([(c, round(f[c], 6)) for c in ANOVA_COLS], "column_name string, f_score double")


@query("select_top", "C5", sql=with_cp(", " + _mi_sql("cp", CP_SEL, "churned") + """
SELECT column_name, CAST(rank AS INTEGER) AS rank FROM (SELECT col_name AS column_name,
  row_number() OVER (ORDER BY mi DESC, CASE col_name """ + " ".join(
    f"WHEN '{c}' THEN {i}" for i, c in enumerate(CP_SEL)) + """ END) AS rank FROM mi) WHERE rank <= 2
"""))
def q_select_top(spark, d):
    mi = C.mutual_info(customer_profile(spark, d), CP_SEL, "churned")
    keep, _ = C.keep_top(CP_SEL, mi, k=2)
    return spark.createDataFrame([(c, i + 1) for i, c in enumerate(keep)], "column_name string, rank int")


TWO = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]  # gross is dropped by stage one


@query("select_two_stage", "C7,C9", sql="WITH " + LI_SQL + ", " + _mi_sql("li", TWO, "returned") + """
SELECT column_name FROM (SELECT col_name AS column_name,
  row_number() OVER (ORDER BY mi DESC, CASE col_name """ + " ".join(
    f"WHEN '{c}' THEN {i}" for i, c in enumerate(TWO)) + """ END) AS rank FROM mi) WHERE rank <= 2
""")
def q_select_two_stage(spark, d):
    li = li_view(spark, d)
    stage1 = C.FeatureSelector("correlation", 0.95, target="returned").fit(li)
    reduced = stage1.transform(li)
    stage2 = C.FeatureSelector("mutual_info", target="returned", k=2).fit(reduced)
    kept = [c for c in stage2.transform(reduced).columns if c != "returned"]
    return spark.createDataFrame([(c,) for c in kept], "column_name string")


@query("select_mutual_nearest", "C3")
def q_select_mutual_nearest(spark, d):
    """Mutual information by nearest neighbours: with the label as a class and
    as a number."""
    from tabprep.operators.mutual import mutual_info_classes, mutual_info_numbers
    cp = customer_profile(spark, d)
    classes, numbers = mutual_info_classes(cp, CP_SEL, "churned"), mutual_info_numbers(cp, CP_SEL, "churned")
    return spark.createDataFrame([(c, round(classes[c], 6), round(numbers[c], 6)) for c in CP_SEL], "column_name string, as_class double, as_number double")
