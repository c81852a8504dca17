import duckdb

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert df.columns == ["Model", "Accuracy", "F1", "Precision", "Recall", "ROC_AUC", "PR_AUC"]
    assert 0.0 <= rows[0]["ROC_AUC"] <= 1.0


def test_every_query_has_a_callable_and_oracle_keys_match():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 90


def test_sample_of_oracles_at_small_scale(spark):
    from tools.check_oracle import rows_of
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    q, s = E.queries(), E.oracle_sql()
    for name in ("iqr_remove_any", "smote", "metric_row", "kfold_assign", "quantile_uniform", "select_mutual_info"):
        a = rows_of(q[name](spark, SF_SMALL).toPandas())
        b = rows_of(con.execute(s[name]).fetchdf())
        assert a == b, name
