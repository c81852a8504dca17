"""Catalog: model fit, compare, tune, attribute, score, persist (M1-M8,
V3-V6, S4-S9, P18). Learners are iterative, so fits are rows-only checks; what
surrounds them (prepared features, equality after loading) has SQL."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tabprep.operators import boosting
from tabprep.operators import fit as M
from tabprep.operators import resample as R
from tabprep.operators import study
from tabprep.operators.evaluate import metric_row
from tabprep.operators.score import risk_tier
from tabprep.operators.split import assign_folds, stratified_split
from tabprep.functions.rng import sql_hash_int
from tabprep.plans.fixtures import metrics_table, metrics_table_sql_ctes
from tabprep.plans.registry import query
from tabprep.session import stored
from tabprep.sources import files as S
from tabprep.spec import CORR_THRESHOLD, N_FOLDS, N_TRIALS, PROFILE_SPEC, SEARCH_SPACE
from tabprep.sources.tables import customer_profile, with_cp

MT = metrics_table_sql_ctes()

FEATURES = ["balance", "n_orders", "total_spend", "has_urgent"]
# iterations and depth of the original's first learner, which it leaves at their defaults
PARAMS = {"GBT": {"maxIter": 100, "maxDepth": 6}, "RandomForest": {"numTrees": 20, "maxDepth": 5},
          "LogisticRegression": {"maxIter": 20}, study.BOOSTED: {"n_estimators": 100, "max_depth": 6}}
LEARNERS = (study.BOOSTED, "RandomForest", "LogisticRegression")


def _cp(spark, d):
    return customer_profile(spark, d).select("c_custkey", *FEATURES, "churned")


def _weighted_train_test(spark, d):
    cp = _cp(spark, d)
    train, test = stratified_split(cp, "churned", "c_custkey", 0.2, 42)
    train = stored(train, "train")  # read by the class weights and by every pass of a fit
    weights = {r["label"]: r["weight"] for r in R.class_weights(train, "churned").collect()}
    return R.with_row_weights(train, "churned", weights), test


@query("gbt_metrics", "M1,M2,M6,R8,E1")
def q_gbt_metrics(spark, d):
    train, test = _weighted_train_test(spark, d)
    trees = boosting.fit_trees(train, FEATURES, "churned", "c_custkey", boosting.Params(**PARAMS[study.BOOSTED]), "weight")
    return metric_row(boosting.predict_trees(trees, test).withColumnRenamed("churned", "label"), model_id="GBT_baseline")


def _parts(spark, d):
    """Folds of the train part, each prepared on its own training rows:
    creation, transforms, correlation selection, class weights."""
    from tabprep.operators.create import create_features
    made = stored(create_features(customer_profile(spark, d), PROFILE_SPEC), "made")
    train, _ = stratified_split(made, "churned", "c_custkey", 0.2, 42)
    folds = assign_folds(stored(train, "train"), "churned", "c_custkey", N_FOLDS, 42)
    return study.prepare_folds(folds, PROFILE_SPEC, selection={"method": "correlation", "threshold": CORR_THRESHOLD})


@query("model_compare", "M3,V3,V4,V5")
def q_model_compare(spark, d):
    return M.cv_mean(study.compare(_parts(spark, d), "c_custkey", "churned", LEARNERS, PARAMS))


@query("tune", "M4,M5")
def q_tune(spark, d):
    """20 trials on 5 prepared folds; all trees grow together."""
    _, table = study.search(_parts(spark, d), "c_custkey", "churned", SEARCH_SPACE, N_TRIALS)
    return table


@query("study_run", "end-to-end,V3,V4,V5,V6,M3,M4,M5,M6")
def q_study_run(spark, d):
    """Outliers, creation, hold-out, prepared folds, comparison, search,
    refits: cv rows per family, test rows of baseline and tuned trees."""
    metrics, _, _ = study.run(customer_profile(spark, d), PROFILE_SPEC, LEARNERS, SEARCH_SPACE, N_TRIALS, params=PARAMS)
    return metrics


@query("study_verdict", "M6,M8")
def q_study_verdict(spark, d):
    """Baseline against tuned trees of the run's own results."""
    _, verdict, _ = study.run(customer_profile(spark, d), PROFILE_SPEC, LEARNERS, SEARCH_SPACE, N_TRIALS, params=PARAMS)
    return verdict


@query("permutation_importance", "M7")
def q_permutation_importance(spark, d):
    train, test = _weighted_train_test(spark, d)
    model, _ = M.fit_and_score(train, test, FEATURES, "churned", "GBT", PARAMS["GBT"], weight_col="weight")
    return M.permutation_importance(model, test, FEATURES, "churned", "c_custkey")


@query("score_batch", "P17,P18,M2")
def q_score_batch(spark, d):
    train, test = _weighted_train_test(spark, d)
    model, _ = M.fit_and_score(train, test, FEATURES, "churned", "GBT", PARAMS["GBT"], weight_col="weight")
    return risk_tier(M.predict(model, _cp(spark, d)), "score", "prediction")


@query("score_stream", "P18")
def q_score_stream(spark, d):
    from tabprep.streaming.score_stream import score_stream
    import uuid
    train, test = _weighted_train_test(spark, d)
    model, _ = M.fit_and_score(train, test, FEATURES, "churned", "GBT", PARAMS["GBT"], weight_col="weight")
    run = uuid.uuid4().hex
    src = S.out_path(spark, run, "incoming")
    cp = _cp(spark, d)
    cp.repartition(4, "c_custkey").write.mode("overwrite").parquet(src)
    out = S.out_path(spark, run, "scored")
    score_stream(spark, model, src, cp.schema, out, S.out_path(spark, run, "ckpt"))
    return spark.read.parquet(out)


@query("model_roundtrip", "S9")
def q_model_roundtrip(spark, d):
    """Persist the fitted transformer and the fitted pipeline, load both,
    rescore the hold-out, flag equality per row."""
    import uuid
    from tabprep.operators.transform import TableTransformer, TableTransformerModel
    run = uuid.uuid4().hex
    train, test = _weighted_train_test(spark, d)
    tf = TableTransformer(standard=["balance", "n_orders", "total_spend"]).fit(train)
    model, scored = M.fit_and_score(tf.transform(train), tf.transform(test), FEATURES, "churned", "GBT",
                                    PARAMS["GBT"], weight_col="weight")
    tf.save(spark, S.out_path(spark, run, "transformer"))
    tf2 = TableTransformerModel.load(spark, S.out_path(spark, run, "transformer"))
    loaded = M.model_roundtrip(model, S.out_path(spark, run, "model"))
    again = M.predict(loaded, tf2.transform(test)).select("c_custkey", F.col("score").alias("score_loaded"))
    return scored.select("c_custkey", "score").join(again, "c_custkey").withColumn(
        "same", (F.col("score") == F.col("score_loaded")).cast("int"))


FOLD0 = """
, r AS (SELECT churned, (row_number() OVER (PARTITION BY churned ORDER BY {h}, c_custkey) - 1) % 5 AS fold FROM cp)
SELECT churned, CASE WHEN fold = 0 THEN 'val' ELSE 'train' END AS part, count(*) AS count FROM r GROUP BY 1, 2
"""


@query("fold_tables", "S4,S5", sql=with_cp(FOLD0.format(h=sql_hash_int(42, "c_custkey", "fold"))))
def q_fold_tables(spark, d):
    import uuid
    path = S.out_path(spark, uuid.uuid4().hex, "folds")
    S.write_folds(assign_folds(_cp(spark, d), "churned", "c_custkey", 5, 42), path)
    tr, va = S.read_fold(spark, path, 0)
    return (tr.groupBy("churned").count().withColumn("part", F.lit("train"))
            .unionByName(va.groupBy("churned").count().withColumn("part", F.lit("val"))))


@query("metric_files", "S6,S8", sql=MT + "\nSELECT * FROM mt")
def q_metric_files(spark, d):
    """Every method's CV summary and test metrics, written as files per method
    and kind, and read back together."""
    import uuid
    root = S.out_path(spark, uuid.uuid4().hex)
    mt = stored(metrics_table(spark, d), "metrics")
    for r in mt.select("method", "kind").distinct().collect():  # one file per run, a handful
        S.write_metrics(mt.where((F.col("method") == r["method"]) & (F.col("kind") == r["kind"])).drop("method", "kind"),
                        f"{root}/{r['method']}_saved_models/metrics_{r['kind']}.csv")
    return S.read_metric_runs(spark, f"{root}/*_saved_models/*.csv").select(*mt.columns)


@query("churn_model_run", "end-to-end")
def q_churn_model_run(spark, d):
    """prepare -> rebalance (SMOTE) -> fit -> evaluate, fitted on train only."""
    from tabprep.operators.create import create_features
    made = create_features(customer_profile(spark, d), PROFILE_SPEC)
    train, test = stratified_split(stored(made, "made"), "churned", "c_custkey", 0.2, 42)
    part = study.prepare(stored(train, "train"), stored(test, "test"), PROFILE_SPEC, balance="smote")
    trees = boosting.fit_trees(part.train, part.features, "churned", "c_custkey", boosting.Params(**PARAMS[study.BOOSTED]))
    return metric_row(boosting.predict_trees(trees, part.val).withColumnRenamed("churned", "label"), model_id="GBT_smote")


def _raw_to_tier(spark, d):
    cp = customer_profile(spark, d)
    train, _ = stratified_split(cp, "churned", "c_custkey", 0.2, 42)
    return study.scoring_pipeline(stored(train, "train"), PROFILE_SPEC, boosting.Params(**PARAMS[study.BOOSTED]), {"method": "correlation", "threshold": CORR_THRESHOLD})


_Z = {"n_orders": "n_orders", "total_spend": "total_spend", "spend_per_order": "total_spend / (n_orders + 1e-6)"}
_DUMMY = {"geography": ["AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"], "segment": ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]}


@query("pipeline_features", "T8,F8,C6,P18", sql=with_cp("SELECT c_custkey, " + ", ".join(
    [f"round((CAST({e} AS DOUBLE) - avg({e}) OVER ()) / stddev_pop({e}) OVER (), 6) AS {c}" for c, e in _Z.items()]
    + [f"CAST({c} = '{v}' AS DOUBLE) AS \"{c}_{v}\"" for c, values in _DUMMY.items() for v in values]) + " FROM cp"))
def q_pipeline_features(spark, d):
    """Fitted feature stages (creation, z-scores, one-hot, selection) as one
    pipeline, saved and loaded, applied to every customer."""
    import uuid
    from pyspark.ml import Pipeline, PipelineModel
    from tabprep.operators.stages import ColumnSelection, ColumnTransforms, FeatureCreator
    cp = customer_profile(spark, d)
    spec = replace(PROFILE_SPEC, yeo_johnson=[], box_cox=[], quantile=[], standard=["n_orders", "total_spend", "spend_per_order"])
    steps = [FeatureCreator(spec=spec), ColumnTransforms(spec=replace(spec, onehot=list(_DUMMY))),
             ColumnSelection(method="variance", threshold=0.0, target="churned", keep_columns=["c_custkey"])]
    path = S.out_path(spark, uuid.uuid4().hex, "features")
    Pipeline(stages=steps).fit(cp).write().overwrite().save(path)
    out = PipelineModel.load(path).transform(cp)
    return out.select("c_custkey", *[F.round(c, 6).alias(c) for c in _Z], *[f"{c}_{v}" for c, values in _DUMMY.items() for v in values])


@query("pipeline_score", "P17,P18,M6,S9,T8")
def q_pipeline_score(spark, d):
    """One saved and loaded pipeline from raw columns to risk tier, on the
    table and on a stream of it; ``same`` compares both scores."""
    import uuid
    from pyspark.ml import PipelineModel
    from tabprep.streaming.score_stream import stream_through
    run = uuid.uuid4().hex
    path = S.out_path(spark, run, "pipeline")
    _raw_to_tier(spark, d).write().overwrite().save(path)
    model = PipelineModel.load(path)
    cp = customer_profile(spark, d).drop("churned")
    src = S.out_path(spark, run, "incoming")
    cp.repartition(4, "c_custkey").write.mode("overwrite").parquet(src)
    stream_through(spark, model.transform, src, cp.schema, S.out_path(spark, run, "scored"), S.out_path(spark, run, "ckpt"))
    cols = ["c_custkey", "score", "prediction", "tier", "risk_label"]
    streamed = spark.read.parquet(S.out_path(spark, run, "scored")).select("c_custkey", F.col("score").alias("streamed"))
    return model.transform(cp).select(*cols).join(streamed, "c_custkey", "full").withColumn("same", F.col("score").eqNullSafe(F.col("streamed")).cast("int")).drop("streamed")


@query("csv_sources", "S1,S2,S3", sql=with_cp("SELECT DISTINCT * EXCLUDE (c_custkey, has_urgent) FROM cp"))
def q_csv_sources(spark, d):
    """Primary, train and test sources as CSV, each with its own declared
    schema, then the combined set (drop ids, common columns, union by name,
    dedup)."""
    import uuid
    root = S.out_path(spark, uuid.uuid4().hex)
    cp = customer_profile(spark, d)
    # whole tables: the second source repeats the first without one column
    # (so the combined set exercises the schema intersection and the dedup)
    tables = {"primary": cp, "train": cp.drop("has_urgent"), "test": cp.drop("churned")}
    for name, t in tables.items():
        t.write.option("header", True).csv(f"{root}/{name}.csv")
    srcs = S.load_sources(spark, *[f"{root}/{name}.csv" for name in tables], drop=["c_custkey"],
                          schema={name: t.schema for name, t in tables.items()})
    return srcs["combined"]


@query("processed_table", "S7", sql=with_cp("SELECT * FROM cp"))
def q_processed_table(spark, d):
    """The processed set, written and read back."""
    import uuid
    path = S.out_path(spark, uuid.uuid4().hex, "processed.parquet")
    S.write_table(customer_profile(spark, d), path)
    return S.read_table(spark, path)


@query("features_and_label", "P6", sql=with_cp("SELECT c_custkey, balance, n_orders, churned FROM cp"))
def q_features_and_label(spark, d):
    """X and y split by column and re-attached by key."""
    cp = customer_profile(spark, d)
    x, y = cp.select("c_custkey", "balance", "n_orders"), cp.select("c_custkey", "churned")
    return x.join(y, "c_custkey")


@query("shapley_sample", "M7")
def q_shapley_sample(spark, d):
    train, test = _weighted_train_test(spark, d)
    model, _ = M.fit_and_score(train, test, FEATURES, "churned", "GBT", PARAMS["GBT"], weight_col="weight")
    _, summary = M.shapley_sample(model, _cp(spark, d), FEATURES, "c_custkey", n_rows=2000, n_perm=10)
    return summary


@query("gbt_early_stop", "M1")
def q_gbt_early_stop(spark, d):
    """M1 with an evaluation set: 20 % of the train part (stratified hash
    rule) is flagged as validation; GBT stops when it stops improving."""
    from tabprep.operators.split import holdout_flag
    train, test = _weighted_train_test(spark, d)
    flagged = holdout_flag(train, "churned", "c_custkey", 0.2, 7).withColumn(
        "is_val", F.col("is_test") == 1).drop("is_test")
    pipe = M.pipeline(FEATURES, "GBT", PARAMS["GBT"], "churned", "weight", 42, "is_val")
    model = pipe.fit(flagged)
    trees = model.stages[-1].getNumTrees
    scored = M.predict(model, test)
    return metric_row(scored.withColumnRenamed("churned", "label"), model_id="GBT_early_stop").withColumn(
        "n_trees", F.lit(int(trees)))
