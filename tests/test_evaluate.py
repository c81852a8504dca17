import itertools

from tabprep.operators import evaluate as E


def _brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def _brute_ap(rows):
    P = sum(y for y, _ in rows)
    ap, prev_r = 0.0, 0.0
    for t in sorted({s for _, s in rows}, reverse=True):
        tp = sum(1 for y, s in rows if s >= t and y == 1)
        fp = sum(1 for y, s in rows if s >= t and y == 0)
        r = tp / P
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    return ap


ROWS = [(1, 0.9), (0, 0.9), (1, 0.7), (0, 0.5), (1, 0.5), (0, 0.1), (0, 0.3), (1, 0.3), (0, 0.3)]


def test_auc_and_ap_with_ties(spark):
    df = spark.createDataFrame([(y, s, int(s >= 0.5)) for y, s in ROWS], "label int, score double, prediction int")
    auc = E.roc_auc(df)[0].first()[0]
    ap = E.average_precision(df)[0].first()[0]
    assert abs(auc - _brute_auc(ROWS)) < 1e-12
    assert abs(ap - _brute_ap(ROWS)) < 1e-12
    row = E.metric_row(df).first()
    assert abs(row["ROC_AUC"] - auc) < 1e-12 and abs(row["PR_AUC"] - ap) < 1e-12


def test_auc_invariant_under_monotone_map(spark):
    df = spark.createDataFrame([(y, s) for y, s in ROWS], "label int, score double")
    a = E.roc_auc(df)[0].first()[0]
    b = E.roc_auc(df.selectExpr("label", "exp(3 * score) AS score"))[0].first()[0]
    assert abs(a - b) < 1e-12


def test_class_report_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "label int, prediction int")
    rep = {r["class"]: r for r in E.class_report(df).collect()}
    assert rep["1"]["precision"] == 0.0 and rep["1"]["recall"] == 0.0 and rep["1"]["f1"] == 0.0
    assert abs(rep["accuracy"]["f1"] - 2 / 3) < 1e-12
    cm = {r["label"]: (r["pred_0"], r["pred_1"]) for r in E.confusion_matrix(df).collect()}
    assert cm == {0: (2, 0), 1: (1, 0)}


def _sk_style_roc(rows):
    import numpy as np
    thr = sorted({s for _, s in rows}, reverse=True)
    tps = np.array([sum(1 for y, s in rows if s >= t and y == 1) for t in thr])
    fps = np.array([sum(1 for y, s in rows if s >= t and y == 0) for t in thr])
    keep = np.where(np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True])[0]
    P, N = tps[-1], fps[-1]
    return sorted([(0.0, 0.0)] + [(fps[i] / N, tps[i] / P) for i in keep])


def test_roc_drop_intermediate_bucketed(spark, monkeypatch):
    import numpy as np
    from tabprep.operators import ranks
    rng = np.random.default_rng(11)
    rows = [(int(rng.random() < 0.3), float(np.round(rng.random(), 2))) for _ in range(400)]
    rows += [(1, 0.97), (1, 0.98), (0, 0.5), (0, 0.51)]  # plant collinear runs
    df = spark.createDataFrame(rows, "label int, score double")
    want = _sk_style_roc(rows)
    for rpb in (10_000_000, 7):
        monkeypatch.setattr(ranks, "ROWS_PER_BUCKET", rpb)
        pts, _ = E.roc_points(df, drop_intermediate=True)
        got = sorted((r["fpr"], r["tpr"]) for r in pts.collect())
        assert len(got) == len(want)
        assert all(abs(a[0] - b[0]) < 1e-12 and abs(a[1] - b[1]) < 1e-12 for a, b in zip(got, want))
