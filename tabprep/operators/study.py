"""The whole training run (V3-V6, M1-M6, M8): outliers, creation, hold-out,
folds prepared on their training part only, model comparison, search, refit.

A fold's transforms, selection and balancing see its training rows alone. The
boosted trees of all folds (and of all trials of a search) grow together, see
``boosting``; Spark ML's learners are independent fits and run from a few
driver threads, so that the cluster is not idle between their small jobs.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass
from typing import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.operators import boosting
from tabprep.operators.create import create_features
from tabprep.operators.evaluate import metric_row
from tabprep.operators.outliers import OutlierHandler, numeric_columns
from tabprep.operators.resample import Resampler, class_weights, with_row_weights
from tabprep.operators.split import assign_folds, stratified_split
from tabprep.operators.stages import BoostedTrees, ColumnSelection, ColumnTransforms, FeatureCreator, RiskTier
from tabprep.session import stored
from tabprep.spec import CORR_THRESHOLD, IQR_MULTIPLIER, N_FOLDS, SEED, TEST_SIZE, FeatureSpec

THREADS = 4
BOOSTED = "BoostedTrees"


def at_once(jobs: Sequence[Callable], threads: int = THREADS) -> list:
    """Results of independent driver-side jobs, in order; each thread submits
    to its own scheduler pool."""
    from pyspark import InheritableThread, SparkContext

    sc = SparkContext._active_spark_context
    if len(jobs) < 2:
        return [j() for j in jobs]
    out = [None] * len(jobs)
    failed: list = []

    def worker(first: int):
        def run():
            sc.setLocalProperty("spark.scheduler.pool", f"fits-{first}")
            for i in range(first, len(jobs), threads):
                if failed:
                    return
                try:
                    out[i] = jobs[i]()
                except Exception as e:
                    failed.append(e)
        return run

    pool = [InheritableThread(target=worker(i)) for i in range(min(threads, len(jobs)))]
    for t in pool:
        t.start()
    for t in pool:
        t.join()
    if failed:
        raise failed[0]
    return out


@dataclass
class Part:
    """A fold's prepared training and validation rows (or train and test)."""

    fold: object
    train: DataFrame
    val: DataFrame
    features: list
    weight: str | None
    model: PipelineModel | None = None


def prepare(train: DataFrame, val: DataFrame, spec: FeatureSpec, fold=0, selection: dict | None = None, balance: str | None = "class_weight", seed: int = SEED) -> Part:
    """V3: transforms, selection and balancing fitted on ``train`` only;
    ``val`` is transformed, never fitted and never balanced."""
    steps = [ColumnTransforms(spec=spec)]
    if selection is not None:
        steps.append(ColumnSelection(target=spec.target, keep_columns=[spec.key], **selection))
    model = Pipeline(stages=steps).fit(train)
    tr, va = model.transform(train), model.transform(val)
    features = [c for c in numeric_columns(tr) if c not in (spec.key, spec.target)]
    tr, va = tr.select(spec.key, spec.target, *features), va.select(spec.key, spec.target, *features)
    weight = None
    if balance == "class_weight":
        weights = {r["label"]: r["weight"] for r in class_weights(tr, spec.target).collect()}  # one per class
        tr, weight = with_row_weights(tr, spec.target, weights, "weight"), "weight"
    elif balance is not None:
        tr = (Resampler(balance, seed).resample(tr, spec.key, features, spec.target)
              .withColumnRenamed("key", spec.key).withColumnRenamed("label", spec.target))
    return Part(fold, stored(tr, "part-train"), stored(va, "part-val"), features, weight, model)


def prepare_folds(df: DataFrame, spec: FeatureSpec, fold_col: str = "fold", **how) -> list[Part]:
    df = stored(df, "folds")  # every fit of every fold reads it several times
    folds = sorted(r[0] for r in df.select(fold_col).distinct().collect())
    split = lambda f: (df.where(F.col(fold_col) != f).drop(fold_col), df.where(F.col(fold_col) == f).drop(fold_col))
    return at_once([lambda f=f: prepare(*split(f), spec, f, **how) for f in folds], max(THREADS, min(len(folds), 2 * THREADS)))


def search_rows(parts: Sequence[Part], key: str, label: str) -> tuple[DataFrame, list]:
    """All folds' rows for ``boosting.Search``; where folds chose different
    columns, the shorter ones are filled with missing values."""
    width = max(len(p.features) for p in parts)
    out = None
    for p in parts:
        for df, val in ((p.train, False), (p.val, True)):
            rows = boosting.as_rows(df, p.features, label, key, p.weight if not val else None, F.lit(p.fold), F.lit(val))
            rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(float("nan")), width - len(p.features))))
            out = rows if out is None else out.union(rows)
    return out, [f"x{i}" for i in range(width)]


def trial_metrics(parts: Sequence[Part], key: str, label: str, trials: Sequence[boosting.Params], seed: int = SEED) -> DataFrame:
    """Metric rows per (trial, fold) of trees grown together for all of them."""
    rows, names = search_rows(parts, key, label)
    search = boosting.Search(stored(rows, "search-rows"), names, trials, seed)
    try:
        search.fit()
        scored = search.scores()
    finally:
        search.release()
    return metric_row(scored, "label", "prediction", "score", ["trial", "fold"])


def compare(parts: Sequence[Part], key: str, label: str, families: Sequence[str], params: dict | None = None, seed: int = SEED) -> DataFrame:
    """M3, V4: metric rows per (Model, fold)."""
    from tabprep.operators.fit import fit_and_score

    def one(family: str, p: Part) -> Callable:
        def run():
            _, s = fit_and_score(p.train, p.val, p.features, label, family, (params or {}).get(family), p.weight, seed)
            return stored(s.select(F.lit(family).alias("Model"), F.lit(p.fold).alias("fold"), F.col(label).cast("long").alias("label"), "score", F.col("prediction").cast("long").alias("prediction")), "fold-scores")
        return run

    scored = at_once([one(f, p) for f in families if f != BOOSTED for p in parts])
    out = None
    if scored:
        rows = scored[0]
        for s in scored[1:]:
            rows = rows.union(s)
        out = metric_row(rows, "label", "prediction", "score", ["Model", "fold"])
    if BOOSTED in families:
        own = trial_metrics(parts, key, label, [boosting.Params(**(params or {}).get(BOOSTED, {}))], seed).withColumn("Model", F.lit(BOOSTED)).drop("trial")
        out = own if out is None else out.unionByName(own)
    return out


def search(parts: Sequence[Part], key: str, label: str, space: dict, n_trials: int, metric: str = "ROC_AUC", seed: int = SEED) -> tuple[boosting.Params, DataFrame]:
    """M4, M5: the best trial (ties: the earlier) and (trial, params, score)."""
    from tabprep.operators.fit import sample_trials

    spark = parts[0].train.sparkSession
    drawn = sample_trials(spark, space, n_trials, seed)
    trials = [boosting.Params(**{k: v for k, v in t.items() if k != "trial"}) for t in drawn]
    means = {r["trial"]: r["score"] for r in trial_metrics(parts, key, label, trials, seed).groupBy("trial").agg(F.avg(metric).alias("score")).collect()}
    table = spark.createDataFrame([(i, boosting.describe(t), means[i]) for i, t in enumerate(trials)], "trial int, params string, score double")
    return trials[max(means, key=lambda i: (means[i], -i))], table


def run(df: DataFrame, spec: FeatureSpec, families: Sequence[str], space: dict, n_trials: int = 20, n_folds: int = N_FOLDS, params: dict | None = None,
        selection: dict | None = None, balance: str | None = "class_weight", strategy: str = "any", max_iter: int = 10, metric: str = "ROC_AUC", seed: int = SEED):
    """The run from raw rows to both final models. Returns (metrics, verdict,
    tuned): cv rows per family, test rows of baseline and tuned trees, M8's
    verdict on the test rows, and the best trial."""
    from tabprep.operators.fit import cv_mean
    from tabprep.operators.report import best_row, tuned_verdict

    selection = {"method": "correlation", "threshold": CORR_THRESHOLD} if selection is None else selection
    kept = OutlierHandler(IQR_MULTIPLIER, target_col=spec.target).remove_outliers(df, spec.numeric, strategy, max_iter)
    made = stored(create_features(kept, spec), "study")
    train, test = stratified_split(made, spec.target, spec.key, TEST_SIZE, seed)
    train, test = stored(train, "study-train"), stored(test, "study-test")
    parts = prepare_folds(assign_folds(train, spec.target, spec.key, n_folds, seed), spec, selection=selection, balance=balance, seed=seed)
    cv = cv_mean(compare(parts, spec.key, spec.target, families, params, seed))
    best = best_row(cv, metric).first()["Model"]
    tuned, table = search(parts, spec.key, spec.target, space, n_trials, metric, seed)
    tuned_cv = table.agg(F.max("score")).first()[0]
    whole = prepare(train, test, spec, "test", selection, balance, seed)
    base = boosting.Params(**(params or {}).get(BOOSTED, {}))
    rows = None
    for name, p in ((f"{BOOSTED}_baseline", base), (f"{BOOSTED}_tuned", tuned)):
        trees = boosting.fit_trees(whole.train, whole.features, spec.target, spec.key, p, whole.weight, seed)
        scored = boosting.predict_trees(trees, whole.val)
        row = metric_row(scored.withColumn("label", F.col(spec.target)), model_id=name).withColumn("Type", F.lit("test"))
        rows = row if rows is None else rows.unionByName(row)
    cv_rows = cv.withColumn("Type", F.lit("cv")).withColumn("Accuracy", F.lit(None).cast("double"))
    metrics = rows.unionByName(cv_rows)
    auc = {r["Model"]: r[metric] for r in rows.collect()}
    baseline_cv = [r[metric] for r in cv.collect() if r["Model"] == BOOSTED]
    spark = df.sparkSession
    verdict = tuned_verdict(spark.createDataFrame([(best, boosting.describe(tuned), baseline_cv[0] if baseline_cv else None, tuned_cv, auc[f"{BOOSTED}_baseline"], auc[f"{BOOSTED}_tuned"],
                                                    auc[f"{BOOSTED}_tuned"] - auc[f"{BOOSTED}_baseline"])],
                                                  "best_family string, params string, cv_baseline double, cv_tuned double, test_baseline double, test_tuned double, delta double"))
    return metrics, verdict, tuned


def scoring_pipeline(train: DataFrame, spec: FeatureSpec, params: boosting.Params, selection: dict | None = None, seed: int = SEED) -> PipelineModel:
    """Raw columns to risk tier as one fitted, savable pipeline
    (class weights as in ``prepare``)."""
    weights = {r["label"]: r["weight"] for r in class_weights(train, spec.target).collect()}
    rows = with_row_weights(train, spec.target, weights, "row_weight")
    keep = [spec.key, "row_weight"]
    steps = [FeatureCreator(spec=spec), ColumnTransforms(spec=spec)]
    if selection is not None:
        steps.append(ColumnSelection(target=spec.target, keep_columns=keep, **selection))
    steps += [BoostedTrees(label=spec.target, key=spec.key, weight="row_weight", params=asdict(params), seed=seed), RiskTier()]
    return Pipeline(stages=steps).fit(rows)
