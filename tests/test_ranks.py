import numpy as np
from pyspark.sql import functions as F

from tabprep.operators.ranks import exact_quantiles, running_totals


def test_exact_quantiles_bucketed_matches_numpy(spark):
    rng = np.random.default_rng(1)
    vals = np.round(rng.exponential(10, 3000), 2)  # many ties
    df = spark.createDataFrame([(float(v), float(v) * 2) for v in vals], "a double, b double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    for most in (1, 7, 10_000_000):  # brackets counted again, and collected at once
        q = exact_quantiles(df, ["a", "b"], probs, collect_values=most)
        assert np.allclose(q["a"], np.quantile(vals, probs), rtol=0, atol=1e-9)
        assert np.allclose(q["b"], np.quantile(vals * 2, probs), rtol=0, atol=1e-9)


def test_quantiles_skip_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,), (2.0,)], "a double")
    assert exact_quantiles(df, ["a"], [0.5])["a"] == [2.0]


def test_running_totals_grouped_descending(spark):
    rows = [(g, float(v), int(v) % 2) for g in ("x", "y") for v in range(40)]
    df = spark.createDataFrame(rows, "g string, v double, w int")
    ranked, info = running_totals(df, "v", ["g"], {"w": F.col("w").cast("long")}, rows_per_bucket=5,
                                  descending=True)
    got = {(r["g"], r["v"]): (r["cum_w"], r["before_w"]) for r in ranked.collect()}
    for g in ("x", "y"):
        acc = 0
        for v in reversed(range(40)):
            w = v % 2
            assert got[(g, float(v))] == (acc + w, acc)
            acc += w


def test_quantiles_many_columns_batched(spark):
    rows = [tuple(float((i * (j + 3)) % 97) for j in range(11)) for i in range(300)]
    schema = ", ".join(f"c{j} double" for j in range(11))
    df = spark.createDataFrame(rows, schema)
    q = exact_quantiles(df, [f"c{j}" for j in range(11)], [0.25, 0.75])
    for j in range(11):
        assert np.allclose(q[f"c{j}"], np.quantile([r[j] for r in rows], [0.25, 0.75]))


def test_search_expr_matches_searchsorted(spark):
    from tabprep.operators.ranks import search_expr
    rng = np.random.default_rng(7)
    splits = sorted(set(np.round(rng.normal(size=37), 1).tolist()))
    vals = np.concatenate([np.round(rng.normal(size=400), 1), np.array(splits)])  # hit every split exactly
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    got = [r[0] for r in df.select(search_expr(F.col("v"), splits)).collect()]
    want = np.searchsorted(np.array(splits), vals, side="right").tolist()
    assert got == want


def test_many_ranks_of_several_columns(spark):
    import numpy as np

    from tabprep.operators import ranks

    rng = np.random.default_rng(8)
    n = 60000
    cols = {"a": rng.normal(size=n), "skew": np.exp(rng.normal(size=n) * 8), "ties": rng.integers(0, 30, size=n).astype(float), "neg": -np.exp(rng.normal(size=n) * 4), "zero": np.where(rng.random(n) < 0.5, 0.0, rng.normal(size=n))}
    cols["a"][::7] = np.nan
    df = spark.createDataFrame([tuple(float(c[i]) for c in cols.values()) for i in range(n)], ", ".join(f"{c} double" for c in cols)).repartition(6).persist()
    probs = [i / 999 for i in range(1000)]
    got = ranks.exact_quantiles(df, list(cols), probs)
    for c, x in cols.items():
        assert np.allclose(got[c], np.nanquantile(x, probs), rtol=1e-12, atol=0), c
    empty = ranks.exact_quantiles(df.where("false"), ["a"], probs)["a"]
    assert empty == [None] * 1000
    one = ranks.exact_quantiles(spark.createDataFrame([(3.0,), (None,)], "a double"), ["a"], probs)["a"]
    assert one == [3.0] * 1000


def test_few_rows_reach_the_driver_for_many_ranks(spark, monkeypatch):
    from pyspark.sql import functions as F
    from pyspark.sql.classic.dataframe import DataFrame

    from tabprep.operators import ranks

    seen, real = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: seen.append(rows := real(self)) or rows)
    df = spark.range(200000).select(((F.col("id") * 7919) % 200003).cast("double").alias("v"))
    got = ranks.exact_quantiles(df, ["v"], [i / 999 for i in range(1000)])["v"]
    assert sum(map(len, seen)) < 5000 and got[0] == 0.0 and got == sorted(got)


def test_cells_do_not_carry_every_wanted_rank(spark, monkeypatch):
    from tabprep.operators.ranks import many_quantiles
    df = spark.range(5000).select((F.col("id") * 7919 % 5000 / 3.0).alias("a"), (F.col("id") % 11).cast("double").alias("b"))
    probs = [i / 999 for i in range(1000)]
    rows = df.toPandas()

    def refused(*a, **k):
        raise AssertionError("a table of all wanted ranks")

    monkeypatch.setattr(type(spark), "createDataFrame", refused)
    got = many_quantiles(df, ["a", "b"], probs)
    for c in "ab":
        assert np.allclose(got[c], np.quantile(rows[c], probs), rtol=1e-12, atol=1e-12)
