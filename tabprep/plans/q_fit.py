"""Catalog: fitted transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabprep.operators import transform as T
from tabprep.operators.create import create_features
from tabprep.operators.split import stratified_split
from tabprep.plans.registry import query
from tabprep.sources.tables import customer_profile, table, with_cp
from tabprep.spec import PROFILE_SPEC

Z_COLS = ["balance", "total_spend", "n_orders"]


def _z_sql(e: str) -> str:
    return (f"({e} - avg({e}) OVER ()) / CASE WHEN coalesce(stddev_pop({e}) OVER (), 0) = 0 THEN 1 "
            f"ELSE stddev_pop({e}) OVER () END")


@query("standardize", "T4,T5", sql=with_cp("SELECT c_custkey, churned, " + ", ".join(
    f"round({_z_sql(f'CAST({c} AS DOUBLE)')}, 6) AS {c}" for c in Z_COLS) + " FROM cp"))
def q_standardize(spark, d):
    cp = customer_profile(spark, d).select("c_custkey", "churned", *Z_COLS)
    out = T.standardize(cp, Z_COLS)
    return out.select("c_custkey", "churned", *[F.round(c, 6).alias(c) for c in Z_COLS])


YJ_LAMBDA = 0.5
BC_LAMBDA = 0.3


def _yj_sql(x: str, lam: float) -> str:
    return (f"CASE WHEN {x} >= 0 THEN (pow({x} + 1.0, {lam!r}) - 1.0) / {lam!r} "
            f"ELSE -(pow(-{x} + 1.0, {2.0 - lam!r}) - 1.0) / {2.0 - lam!r} END")


@query("yeo_johnson_fixed", "T1", sql=with_cp(f"""
, f AS (SELECT c_custkey, {_yj_sql('CAST(balance AS DOUBLE)', YJ_LAMBDA)} AS v FROM cp)
SELECT c_custkey, round({_z_sql('v')}, 6) AS balance_yj FROM f
"""))
def q_yeo_johnson_fixed(spark, d):
    cp = customer_profile(spark, d).select("c_custkey", T.yeo_johnson_expr(F.col("balance"), YJ_LAMBDA).alias("v"))
    z = T.standardize(cp, ["v"])
    return z.select("c_custkey", F.round("v", 6).alias("balance_yj"))


@query("box_cox_fixed", "T2", sql=with_cp(f"""
, s AS (SELECT CASE WHEN min(total_spend) <= 0 THEN abs(min(total_spend)) + 1e-6 ELSE 0.0 END AS shift FROM cp),
f AS (SELECT c_custkey, CASE WHEN total_spend + shift > 0
        THEN (pow(total_spend + shift, {BC_LAMBDA!r}) - 1.0) / {BC_LAMBDA!r} END AS v FROM cp, s)
SELECT c_custkey, round({_z_sql('v')}, 6) AS spend_bc FROM f
"""))
def q_box_cox_fixed(spark, d):
    cp = customer_profile(spark, d)
    mn = cp.agg(F.min("total_spend")).first()[0]
    shift = abs(mn) + 1e-6 if mn <= 0 else 0.0
    f = cp.select("c_custkey", T.box_cox_expr(F.col("total_spend"), BC_LAMBDA, shift).alias("v"))
    return T.standardize(f, ["v"]).select("c_custkey", F.round("v", 6).alias("spend_bc"))


NQ = 11
PROBS = [i / (NQ - 1) for i in range(NQ)]


@query("quantile_uniform", "T3", sql=f"""
WITH k AS (SELECT quantile_cont(l_extendedprice, {PROBS!r}) AS q FROM lineitem),
j AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS x, q,
        len(list_filter(q, lambda e: e <= l_extendedprice)) AS j FROM lineitem, k)
SELECT l_orderkey, l_linenumber, (CASE WHEN j = 0 THEN 0.0
  WHEN x = q[j] THEN CAST(j - 1 AS DOUBLE) / CAST({NQ - 1} AS DOUBLE)
  WHEN j = {NQ} THEN 1.0
  ELSE CAST(j - 1 AS DOUBLE) / CAST({NQ - 1} AS DOUBLE) + (x - q[j]) * (CAST(j AS DOUBLE) / CAST({NQ - 1} AS DOUBLE)
       - CAST(j - 1 AS DOUBLE) / CAST({NQ - 1} AS DOUBLE)) / (q[j + 1] - q[j]) END) AS price_q
FROM j
""")
def q_quantile_uniform(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    knots = T.quantile_knots(li, "l_extendedprice", max_knots=NQ)
    out = T.quantile_uniform(li, "l_extendedprice", knots, out="price_q")
    return out.select("l_orderkey", "l_linenumber", "price_q")


MANY = [i / 999 for i in range(1000)]


@query("quantile_knots", "T3", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(unnest(range(1000)) AS INTEGER) AS knot, unnest(quantile_cont({c}, {MANY!r})) AS value FROM lineitem"
    for c in ("l_extendedprice", "l_quantity")))
def q_quantile_knots(spark, d):
    """1000 exact knots of two columns (one with long ties) in one pass."""
    got = T.all_knots(table(spark, d, "lineitem"), ["l_extendedprice", "l_quantity"])
    return spark.createDataFrame([(c, i, v) for c, knots in got.items() for i, v in enumerate(knots)], "column_name string, knot int, value double")


@query("onehot_sparse", "T6,F9", sql="""
WITH c AS (SELECT l_shipdate AS v, row_number() OVER (ORDER BY CAST(l_shipdate AS VARCHAR)) - 1 AS i FROM (SELECT DISTINCT l_shipdate FROM lineitem))
SELECT l_orderkey, l_linenumber, CAST(i AS INTEGER) AS position, CAST((SELECT count(*) FROM c) AS INTEGER) AS width FROM lineitem JOIN c ON c.v = l_shipdate""")
def q_onehot_sparse(spark, d):
    """One-hot of every ship date as a sparse vector: its only entry."""
    from pyspark.ml.functions import vector_to_array
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("day"))
    coded = T.sparse_onehot(li, ["day"]).transform(li)
    whole = vector_to_array("onehot")
    return coded.select("l_orderkey", "l_linenumber", (F.array_position(whole, F.lit(1.0)) - 1).cast("int").alias("position"), F.size(whole).alias("width"))


@query("onehot_drop_first", "T6,F9", sql=with_cp("""
, cats AS (SELECT 'geography' AS col, cat, row_number() OVER (ORDER BY cat) AS r
           FROM (SELECT DISTINCT geography AS cat FROM cp)
           UNION ALL SELECT 'segment', cat, row_number() OVER (ORDER BY cat) FROM (SELECT DISTINCT segment AS cat FROM cp))
SELECT c_custkey, col || '_' || cat AS feature,
  CAST(CASE WHEN (col = 'geography' AND geography = cat) OR (col = 'segment' AND segment = cat) THEN 1 ELSE 0 END AS DOUBLE) AS value
FROM cp, cats WHERE r > 1
"""))
def q_onehot_drop_first(spark, d):
    cp = customer_profile(spark, d).select("c_custkey", "geography", "segment")
    model = T.TableTransformer(onehot=["geography", "segment"]).fit(cp)
    wide = model.transform(cp)
    enc = [c for c in wide.columns if c != "c_custkey"]
    return wide.unpivot(["c_custkey"], enc, "feature", "value")


@query("power_lambda_fit", "T1,T2")
def q_power_lambda_fit(spark, d):
    cp = customer_profile(spark, d)
    mn = cp.agg(F.min("total_spend")).first()[0]
    shift = abs(mn) + 1e-6 if mn <= 0 else 0.0
    rows = [("balance", "yeo_johnson", T.fit_power_lambda(cp, "balance", "yj")),
            ("total_spend", "box_cox", T.fit_power_lambda(cp, "total_spend", "bc", shift=shift))]
    return spark.createDataFrame(rows, "column_name string, method string, lambda double")


@query("transformer_fit_apply", "T1-T8,V1")
def q_transformer_fit_apply(spark, d):
    cp = create_features(customer_profile(spark, d), PROFILE_SPEC)
    train, test = stratified_split(cp, "churned", "c_custkey", 0.2, 42)
    model = T.TableTransformer.from_spec(PROFILE_SPEC).fit(train)
    return model.transform(test)


@query("dummies_nonfitted", "F9", sql=with_cp("""
, cats AS (SELECT cat, row_number() OVER (ORDER BY cat) AS r FROM (SELECT DISTINCT segment AS cat FROM cp))
SELECT c_custkey, 'segment_' || cat AS feature, CAST(segment = cat AS INTEGER) AS value FROM cp, cats WHERE r > 1
"""))
def q_dummies_nonfitted(spark, d):
    from tabprep.operators.create import dummies
    wide = dummies(customer_profile(spark, d).select("c_custkey", "segment"), ["segment"], drop_first=True)
    enc = [c for c in wide.columns if c != "c_custkey"]
    return wide.unpivot(["c_custkey"], enc, "feature", "value")
