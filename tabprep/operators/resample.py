"""Class imbalance treatment.

Resamplers take a frame with a bigint ``key``, numeric ``features`` and a
``label`` and return (key, features..., label): original rows keep their key,
synthetic rows get negative keys. All draws are portable hash draws of
(seed, draw id, purpose), so reruns and retries give identical rows.
Neighbours come from ``knn.knn_join``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.functions.rng import hash_int, uniform
from tabprep.operators.knn import knn_join
from tabprep.operators.ranks import running_totals
from tabprep.operators.split import hash_rank
from tabprep.session import cut_lineage, stored

EXPLODE_CHUNK = 100_000      # synthetic draws expanded per task at most

# ------------------------------------------------------------ class counts ---


def class_counts(df: DataFrame, label: str) -> list:
    """[(label, count)] sorted by label; one tiny aggregate."""
    return sorted(((r[0], int(r[1])) for r in df.groupBy(label).count().collect()), key=lambda t: t[0])


def class_profile(df: DataFrame, label: str) -> DataFrame:
    """Counts, ratios, total, n_classes, max/min imbalance ratio, majority
    and minority label (first label on ties). One aggregate per class; the
    class table (one row per class) is finished on the driver."""
    counts = class_counts(df, label)
    total = sum(n for _, n in counts)
    (min_lab, mn), (maj_lab, mx) = _minority_majority(counts)
    rows = [(lab, n, n / total, total, len(counts), mx / mn, maj_lab, min_lab) for lab, n in counts]
    ltype = dict(df.dtypes)[label]
    return df.sparkSession.createDataFrame(
        rows, f"label {ltype}, count long, ratio double, total long, n_classes long, imbalance_ratio double, "
              f"majority {ltype}, minority {ltype}")


def class_weights(df: DataFrame, label: str, how: str = "balanced") -> DataFrame:
    """N / (n_classes * n_c) per class. ``balanced`` and ``custom`` are the
    same formula; ``balanced_subsample`` is rejected (not valid for a plain
    class-weight vector)."""
    if how not in ("balanced", "custom"):
        raise ValueError(f"class weights are 'balanced' or 'custom', not {how!r}")
    counts = class_counts(df, label)
    n, k = sum(c for _, c in counts), len(counts)
    ltype = dict(df.dtypes)[label]
    return df.sparkSession.createDataFrame([(lab, n / (k * c)) for lab, c in counts], f"label {ltype}, weight double")


def with_row_weights(df: DataFrame, label: str, weights: dict, out: str = "weight") -> DataFrame:
    """Per-row weight from the class-weight map (a literal CASE: the map
    has one entry per class)."""
    e = None
    for cls, w in weights.items():
        cond = F.col(label) == F.lit(cls)
        e = F.when(cond, F.lit(float(w))) if e is None else e.when(cond, F.lit(float(w)))
    return df.withColumn(out, e)


def before_after(before: DataFrame, after: DataFrame, label: str) -> DataFrame:
    """Class counts before and after resampling, tagged by stage."""
    b = before.groupBy(label).agg(F.count(F.lit(1)).alias("count")).withColumn("stage", F.lit("before"))
    a = after.groupBy(label).agg(F.count(F.lit(1)).alias("count")).withColumn("stage", F.lit("after"))
    return b.unionByName(a).select("stage", F.col(label).alias("label"), "count")


# -------------------------------------------------------------- resamplers ---


def _minority_majority(counts: list):  # noqa: E302
    mn = min(counts, key=lambda t: (t[1], t[0]))
    mx = min(counts, key=lambda t: (-t[1], t[0]))
    return mn, mx


def _base(df, key, features, label):
    return df.select(F.col(key).cast("long").alias("key"), *[F.col(f).cast("double").alias(f) for f in features],
                     F.col(label).alias("label"))


def _with_neighbours(rows: DataFrame, nn: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows with ``nn``: their neighbours' features by rank, so that a draw
    needs no further join."""
    near = rows.select(F.col("key").alias("c_key"), F.struct(*features).alias("f"))
    arrays = (nn.select("q_key", "c_key", F.col("rank").cast("int").alias("rank")).join(near, "c_key")
              .groupBy("q_key").agg(F.sort_array(F.collect_list(F.struct("rank", "f"))).alias("nn")))
    return rows.join(arrays, rows["key"] == arrays["q_key"]).drop("q_key")


def _between(features: Sequence[str], rank, gap) -> list:
    """Points between a row and its neighbour of that rank."""
    n = F.element_at("nn", rank)["f"]
    return [(F.col(f) + gap * (n[f] - F.col(f))).alias(f) for f in features]


def class_targets(counts: list, strategy, grow: bool) -> dict:
    """{label: rows wanted} of the classes that a resampler changes.

    Growing: ``auto`` and ``not majority`` bring every class but the largest
    to the largest's count, ``minority`` the smallest alone, ``not minority``
    and ``all`` as named. Shrinking: ``auto`` and ``not minority`` bring every
    class but the smallest to the smallest's count, ``majority`` the largest
    alone. A number is the ratio of smaller to larger class of two; a dict
    gives rows per label. Raises where a class would move the other way."""
    (low, n_low), (high, n_high) = _minority_majority(counts)
    have = dict(counts)
    if isinstance(strategy, dict):
        unknown = [c for c in strategy if c not in have]
        if unknown:
            raise ValueError(f"no rows of the classes {unknown}")
        want = dict(strategy)
    elif isinstance(strategy, str):
        names = {"auto": [c for c in have if c != (high if grow else low)], "not majority": [c for c in have if c != high], "not minority": [c for c in have if c != low],
                 "minority": [low], "majority": [high], "all": list(have)}
        if strategy not in names or (strategy == "majority") == grow and strategy in ("majority", "minority"):
            raise ValueError(f"{strategy!r} does not say which classes {'grow' if grow else 'shrink'}")
        want = {c: n_high if grow else n_low for c in names[strategy]}
    elif len(have) != 2:
        raise ValueError("a ratio needs exactly two classes; give rows per label instead")
    else:
        want = {low: int(n_high * strategy)} if grow else {high: int(n_low / strategy)}
    wrong = [c for c, n in want.items() if (n < have[c] if grow else n > have[c])]
    if wrong:
        raise ValueError(f"classes {wrong} would have to {'shrink' if grow else 'grow'}")
    return {c: n for c, n in sorted(want.items(), key=lambda x: str(x[0])) if n != have[c]}


def _one_of(label, classes) -> Column:
    return F.col(label).isin(list(classes)) if classes else F.lit(False)


def smote(df: DataFrame, key: str, features: Sequence[str], label: str, k: int = 5, seed: int = 42, method: str = "exact", sampling_strategy="auto") -> DataFrame:
    """R1 (Chawla et al. 2002), every class that ``class_targets`` grows, with
    one neighbour join inside the classes. Draw i picks a base row of its
    class (with replacement), one of its k neighbours and a gap u in [0, 1),
    all by hash; draws are numbered class by class. A class of a single row
    has no neighbour and stays."""
    features = list(features)
    data = _base(df, key, features, label)
    counts = class_counts(data, "label")
    have = dict(counts)
    new = {c: n - have[c] for c, n in class_targets(counts, sampling_strategy, True).items() if have[c] > 1}
    if not new:
        return data
    rows = data.where(_one_of("label", new))
    nn = knn_join(rows, rows, features, k, "key", method=method, within="label")
    ranks, _, _ = hash_rank(rows.select("key", "label"), "key", ["label"], seed, "smote_base", out="idx")
    base = _with_neighbours(rows, nn, features).join(ranks.select("key", "idx"), "key")
    off, plan = 0, []
    for c, n in new.items():
        plan.append((c, off, n, have[c], min(k, have[c] - 1)))
        off += n
    # draws per base row may be many: each row stands in as many lots as keep a lot's draws small
    lots = max(-(-n // (have[c] * EXPLODE_CHUNK)) for c, n in new.items())
    plan = df.sparkSession.createDataFrame(plan, f"label {dict(data.dtypes)['label']}, off long, n long, n_c long, kk int")  # a row per class
    chunks = plan.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / EXPLODE_CHUNK).cast("long"))))
    if lots > 1 or off > EXPLODE_CHUNK:
        chunks = chunks.repartition("label", "chunk")
    first = F.col("off") + F.col("chunk") * EXPLODE_CHUNK
    draws = chunks.withColumn("id", F.explode(F.sequence(first, F.least(first + EXPLODE_CHUNK, F.col("off") + F.col("n")) - 1)))
    draws = draws.select("id", "label", (F.col("id") % F.lit(lots)).alias("lot"), (hash_int(seed, F.col("id"), "smote_base") % F.col("n_c")).alias("idx"),
                         (hash_int(seed, F.col("id"), "smote_nn") % F.col("kk") + 1).cast("int").alias("rank"), uniform(seed, F.col("id"), "smote_gap").alias("gap"))
    base = base.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lots - 1).cast("long"))))
    syn = draws.join(base.drop("key"), ["label", "idx", "lot"]).select((-(F.col("id") + 1)).alias("key"), *_between(features, F.col("rank"), F.col("gap")), "label")
    return data.unionByName(syn)


def adasyn(df: DataFrame, key: str, features: Sequence[str], label: str, k: int = 5, seed: int = 42, method: str = "exact", sampling_strategy="auto") -> DataFrame:
    """R2 (He et al. 2008), every class that ``class_targets`` grows by G: per
    row r = share of other-class rows among its k neighbours in all data;
    g = round_half_even(r / sum(r) * G) with the sum over its class; synthetic
    rows interpolate to neighbours of the class."""
    features = list(features)
    data = _base(df, key, features, label)
    counts = class_counts(data, "label")
    have = dict(counts)
    new = {c: n - have[c] for c, n in class_targets(counts, sampling_strategy, True).items() if have[c] > 1}
    if not new:
        return data
    rows = data.where(_one_of("label", new))
    codes = F.create_map(*[F.lit(x) for i, (c, _) in enumerate(counts) for x in (c, i)])  # the join carries numbers
    nn_all = knn_join(rows, data.withColumn("code", codes[F.col("label")]), features, k, "key", cand_label="code", method=method)
    # r_i = m_i / k, so r_i / sum(r) = m_i / sum(m): integer counts keep it exact
    own = rows.select(F.col("key").alias("q_key"), "label", codes[F.col("label")].alias("code"))
    m = stored(nn_all.join(own, "q_key").groupBy("q_key", "label").agg(F.sum((F.col("c_label") != F.col("code")).cast("long")).alias("m")), "adasyn-shares")
    total = {r["label"]: r["t"] or 0 for r in m.groupBy("label").agg(F.sum("m").alias("t")).collect()}
    if any(not total.get(c) for c in new):
        raise ValueError(f"ADASYN needs rows with neighbours of another class; of {[c for c in new if not total.get(c)]} none has any")
    of = lambda d: F.create_map(*[F.lit(x) for c in new for x in (c, d[c])])[F.col("label")]
    g = m.select(F.col("q_key").alias("key"), "label",
                 F.bround((F.col("m") * of(new)).cast("double") / of({c: float(t) for c, t in total.items()}), 0).cast("long").alias("g"))
    # exact offsets of each row's synthetic ids: running sum of g, class by class in key order
    ranked, info = running_totals(g.where(F.col("g") > 0), "key", ["label"], {"g": F.col("g")})
    sums, starts, at = {d["key"][0]: d["total"]["g"] for d in info.values()}, {}, 0
    for c in new:
        starts[c], at = at, at + sums.get(c, 0)
    kk = {c: min(k, have[c] - 1) for c in new}
    nn = knn_join(rows, rows, features, k, "key", method=method, within="label")
    # rows carry their neighbours; two-level explode: one row may own most of
    # G, so chunks of its draws are spread over tasks before they are expanded
    owners = ranked.select("key", (F.col("before_g") + of(starts)).alias("off"), of(kk).alias("kk"), "g").join(_with_neighbours(rows, nn, features), "key")
    chunks = owners.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("g") - 1) / F.lit(EXPLODE_CHUNK)).cast("long"))))
    chunks = chunks.repartition("key", "chunk")
    draws = chunks.withColumn("j", F.explode(F.sequence(
        F.col("chunk") * F.lit(EXPLODE_CHUNK) + 1,
        F.least(F.col("g"), (F.col("chunk") + 1) * F.lit(EXPLODE_CHUNK)))))
    draws = (draws.withColumn("rank", (hash_int(seed, F.col("key"), "adasyn_nn", F.col("j")) % F.col("kk") + 1).cast("int"))
             .withColumn("gap", uniform(seed, F.col("key"), "adasyn_gap", F.col("j"))))
    syn = draws.select((-(F.col("off") + F.col("j"))).alias("key"), *_between(features, F.col("rank"), F.col("gap")), "label")
    return data.unionByName(syn)


def nearmiss(df: DataFrame, key: str, features: Sequence[str], label: str, k: int = 3, method: str = "exact", sampling_strategy="auto") -> DataFrame:
    """R3, NearMiss-1 (Mani & Zhang 2003): of every class that
    ``class_targets`` shrinks, keep the rows with the smallest mean distance
    to their k nearest rows of the smallest class (ties: key); other classes
    stay whole."""
    features = list(features)
    data = _base(df, key, features, label)
    counts = class_counts(data, "label")
    (min_lab, n_min), _ = _minority_majority(counts)
    keep_n = {c: n for c, n in class_targets(counts, sampling_strategy, False).items() if c != min_lab}
    if not keep_n:
        return data
    mino = data.where(F.col("label") == F.lit(min_lab))
    many = data.where(_one_of("label", keep_n))
    k = min(k, n_min)  # a row cannot be nearer to more minority rows than there are
    nn = knn_join(many, mino, features, k, "key", exclude_self=False, method=method)
    parts = [F.sum(F.when(F.col("rank") == i, F.col("dist"))).alias(f"d{i}") for i in range(1, k + 1)]
    md = nn.groupBy("q_key").agg(*parts)
    mean = None
    for i in range(1, k + 1):
        mean = F.col(f"d{i}") if mean is None else mean + F.col(f"d{i}")
    md = stored(md.select(F.col("q_key").alias("key"), (mean / F.lit(float(k))).alias("md")).join(many.select("key", "label"), "key"), "nearmiss-means")
    ranked, info = running_totals(md, "md", ["label"], {"cnt": F.lit(1).cast("long")})
    # rows sharing a mean distance are ordered by key inside that value
    from pyspark.sql import Window
    spans = ranked.select("label", "md", F.col("before_cnt").alias("_b"))
    pos = (md.join(spans, ["label", "md"])
           .withColumn("_r", F.col("_b") + F.row_number().over(Window.partitionBy("label", "md").orderBy("key")) - 1))
    limit = F.create_map(*[F.lit(x) for c, n in keep_n.items() for x in (c, n)])[F.col("label")]
    keep = pos.where(F.col("_r") < limit).select("key")
    return data.where(~_one_of("label", keep_n)).unionByName(many.join(keep, "key", "left_semi"))


def edited_nearest_neighbours(df: DataFrame, key: str, features: Sequence[str], label: str, k: int = 3, method: str = "exact") -> DataFrame:
    """R4 (Wilson 1972), every class: drop rows having any of their k
    neighbours in another class."""
    features = list(features)
    data = _base(df, key, features, label)
    nn = knn_join(data, data, features, k, "key", cand_label="label", method=method)
    lab = data.select(F.col("key").alias("q_key"), F.col("label").alias("q_label"))
    bad = (nn.join(lab, "q_key").where(F.col("c_label") != F.col("q_label"))
           .select(F.col("q_key").alias("key")).distinct())
    return data.join(bad, "key", "left_anti")


def tomek_links(df: DataFrame, key: str, features: Sequence[str], label: str, method: str = "exact") -> DataFrame:
    """R5 (Tomek 1976): mutual nearest neighbours with different labels; both
    ends are removed."""
    features = list(features)
    data = _base(df, key, features, label)
    # stored: the links read it twice, and both ends of a link once more
    nn = stored(knn_join(data, data, features, 1, "key", cand_label="label", method=method).select("q_key", "c_key", "c_label"), "tomek-nearest")
    lab = data.select(F.col("key").alias("q_key"), F.col("label").alias("q_label"))
    a = nn.join(lab, "q_key")
    back = nn.select(F.col("q_key").alias("c_key"), F.col("c_key").alias("q_key"))
    links = a.join(back, ["q_key", "c_key"]).where(F.col("q_label") != F.col("c_label"))
    ends = links.select(F.col("q_key").alias("key")).unionByName(links.select(F.col("c_key").alias("key"))).distinct()
    return data.join(ends, "key", "left_anti")


def smote_enn(df, key, features, label, seed: int = 42, checkpoint: bool = True, method: str = "exact", sampling_strategy="auto", k: int = 5):
    """SMOTE, then ENN over original + synthetic rows (lineage cut between)."""
    s = smote(df, key, features, label, k, seed, method, sampling_strategy)
    if checkpoint:
        s = cut_lineage(s)
    return edited_nearest_neighbours(s, "key", features, "label", 3, method)


def smote_tomek(df, key, features, label, seed: int = 42, checkpoint: bool = True, method: str = "exact", sampling_strategy="auto", k: int = 5):
    s = smote(df, key, features, label, k, seed, method, sampling_strategy)
    if checkpoint:
        s = cut_lineage(s)
    return tomek_links(s, "key", features, "label", method)


class Resampler:
    """Method dispatch; ``class_weight`` returns the frame unchanged.
    ``neighbours`` is the kNN join's method (exact or approx),
    ``sampling_strategy`` as in ``class_targets``, ``k`` the neighbours of a
    draw (default 5; NearMiss 3)."""

    METHODS = ("smote", "adasyn", "nearmiss", "smote_enn", "smote_tomek", "class_weight")

    def __init__(self, method: str = "smote", seed: int = 42, neighbours: str = "exact", sampling_strategy="auto", k: int | None = None):
        if method not in self.METHODS:
            raise ValueError(f"no resampler {method!r}; there are {', '.join(self.METHODS)}")
        self.method, self.seed, self.neighbours, self.sampling_strategy, self.k = method, seed, neighbours, sampling_strategy, k

    def resample(self, df: DataFrame, key: str, features: Sequence[str], label: str) -> DataFrame:
        how = {"method": self.neighbours, "sampling_strategy": self.sampling_strategy}
        at = (df, key, features, label)
        if self.method == "class_weight":
            return _base(*at)
        if self.method == "smote":
            return smote(*at, self.k or 5, self.seed, **how)
        if self.method == "adasyn":
            return adasyn(*at, self.k or 5, self.seed, **how)
        if self.method == "nearmiss":
            return nearmiss(*at, self.k or 3, **how)
        combined = smote_enn if self.method == "smote_enn" else smote_tomek
        return combined(*at, self.seed, k=self.k or 5, **how)


__all__ = ["class_profile", "class_weights", "with_row_weights", "before_after", "smote", "adasyn",
           "nearmiss", "edited_nearest_neighbours", "tomek_links", "smote_enn", "smote_tomek",
           "Resampler", "class_targets"]
