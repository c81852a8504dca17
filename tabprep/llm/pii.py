"""Personal data: base patterns, then candidates judged by boosted trees (native).

Base spans match a fixed pattern per kind (email, ip, card, phone) and a check
(octets, digit counts, Luhn). Wider generators propose further, overlapping
candidates: spelled-out addresses, other separators, numbers without a plus.
Boosted trees score a candidate by its format and by the characters around
it; a threshold per kind, set on held-out rows for ``PRECISION``, selects the
spans that are added. Base spans always stay and an added one never overlaps
them.

The trees and thresholds are fitted on every document: base spans, rewritten in
the ways people write them, are positives; failed matches, other candidates and
damaged spans are negatives. Candidates that look like a rewritten span may be personal data
and are neither, in the fit and on the held-out rows. The fitted trees become one SQL expression, so scoring is a
projection: no shuffle, no Python.

Contracts: positions are code points, end exclusive; a null text is empty and
has no spans; repeated rows are searched each; an empty table, or one
without base spans, adds nothing; all other columns pass untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import apart, stored

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.995
SPAN = "array<struct<start:int,end:int,s:string,prev:string,next:string>>"

# Possessive forms: they match what the plain ones match (no part can give
# back a character to the next) without recursion on long runs. A match may
# begin only where the run begins or the last match ended: later starts in a
# run that failed fail too.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9](?:[\x20().-]*+[0-9])++",
}
WIDE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++\x20?+(?:@|\[at\]|\(at\))\x20?+[A-Za-z0-9-]++(?:\x20?+(?:\.|\[dot\]|\(dot\))\x20?+[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\x20?+[.,:]\x20?+[0-9]++|\[\.\][0-9]++){3}",
    "card": r"[0-9](?:[\x20._/-]{0,2}+[0-9])++",
    "phone": r"(?:\+|\()?+[0-9](?:[\x20()./_-]{0,3}+[0-9])++",
}
#: Text that a kind's patterns cannot do without; texts without it are not searched.
NEEDS = {"email": ("@", "[at]", "(at)"), "phone": ("+",)}


def found(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches with positions and neighbours. The
    pieces between matches give the positions: lengths add up."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.struct(F.length(x).alias("n"), F.right(x, F.lit(1)).alias("last"), F.left(x, F.lit(1)).alias("first")))
    return F.struct(hits.alias("hits"), gaps.alias("gaps"))


def placed(f: Column) -> Column:
    m = F.size(f["hits"])
    parts = F.arrays_zip(f["hits"], F.slice(f["gaps"], 1, m).alias("before"), F.slice(f["gaps"], F.lit(2), m).alias("after"))
    parts = F.transform(parts, lambda p: F.struct(p["hits"].alias("s"), p["before"]["n"].alias("gap"), p["before"]["last"].alias("prev"), p["after"]["first"].alias("next")))
    zero = F.struct(F.lit(0).alias("pos"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, p: Column) -> Column:
        a = acc["pos"] + p["gap"]
        b = a + F.length(p["s"])
        span = F.struct(a.alias("start"), b.alias("end"), p["s"].alias("s"), p["prev"].alias("prev"), p["next"].alias("next"))
        return F.struct(b.alias("pos"), F.concat(acc["out"], F.array(span)).alias("out"))

    return F.when(m > 0, F.aggregate(parts, zero, step, lambda acc: acc["out"])).otherwise(F.array().cast(SPAN))


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def octets_ok(s: Column) -> Column:
    part = lambda x: F.regexp_replace(x, "^0+(?=[0-9])", "")
    return F.forall(F.split(s, "[^0-9]+", -1), lambda x: (F.length(part(x)) <= 3) & (F.length(x) > 0) & (F.try_to_number(F.lpad(part(x), 4, "0"), F.lit("0000")) <= 255))


def valid(kind: str, s: Column) -> Column:
    d = digits(s)
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return octets_ok(s)
    if kind == "card":
        return F.length(d).between(16, 19) & F.call_function("luhn_check", d)
    return F.length(d).between(8, 15)


def as_written(kind: Column, s: Column) -> Column:
    """Whether a wide candidate has a format that ``examples`` gives to
    positives: nobody knows whether it is personal data."""
    d = digits(s)
    email = s.rlike(r"\[at\]|\(at\)|\[dot\]|\(dot\)") | ~s.rlike(r"\x20\.|\.\x20")
    phone = s.rlike(r"^\(?(?:\+|00)") & F.length(F.regexp_replace(d, "^00", "")).between(8, 15)
    return (F.when(kind == "email", email).when(kind == "ip", octets_ok(s) & ~s.rlike("[,:]"))
            .when(kind == "card", valid("card", s)).otherwise(phone))


FEATURES = ("length", "digits", "letters", "at", "dots", "spaces", "round", "dashes", "plus", "zeros", "groups", "longest", "luhn", "octets",
            "kinds_of_digit", "prev_word", "next_word", "prev_mark", "next_mark", *(f"is_{k}" for k in KINDS))


def features(kind: Column, s: Column, prev: Column, following: Column) -> dict[str, Column]:
    """Format and context of a candidate, as doubles."""
    d = digits(s)
    count = lambda pattern: F.length(F.regexp_replace(s, pattern, ""))
    groups = F.filter(F.split(s, "[^0-9]+", -1), lambda x: F.length(x) > 0)
    flag = lambda c: F.when(c, 1).otherwise(0)
    return {k: v.cast("double") for k, v in {
        "length": F.length(s), "digits": F.length(d), "letters": count("[^A-Za-z]"), "at": count("[^@]") + flag(F.contains(s, F.lit("at"))),
        "dots": count("[^.]") + flag(F.contains(s, F.lit("dot"))), "spaces": count("[^ ]"), "round": count("[^()]"), "dashes": count("[^/_-]"),
        "plus": flag(F.startswith(s, F.lit("+"))), "zeros": flag(F.startswith(s, F.lit("00"))), "groups": F.size(groups),
        "longest": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)), "luhn": flag(F.call_function("luhn_check", d)), "octets": flag((F.size(groups) == 4) & octets_ok(s)),
        "kinds_of_digit": F.size(F.array_distinct(F.split(d, ""))), "prev_word": flag(prev.rlike("[A-Za-z0-9]")), "next_word": flag(following.rlike("[A-Za-z0-9]")),
        "prev_mark": flag(prev.rlike("[=\"'#./_-]")), "next_mark": flag(following.rlike("[=\"'#/_-]")), **{f"is_{k}": flag(kind == k) for k in KINDS},
    }.items()}


def spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with _base and _wide: arrays of kind, start, end, s, prev and
    next; base spans are checked ones."""
    t = F.coalesce(F.col(text), F.lit(""))
    checked = lambda kind: lambda x: valid(kind, x["s"])
    out = docs
    for kind in KINDS:
        need = NEEDS.get(kind, ())
        may = lambda marks, t=t: F.coalesce(*[F.when(F.contains(t, F.lit(m)), t) for m in marks], F.lit("")) if marks else t
        out = out.withColumn(f"_b_{kind}", found(may(need[:1]), BASE[kind])).withColumn(f"_w_{kind}", found(may(need if kind == "email" else ()), WIDE[kind]))
    for kind in KINDS:
        out = (out.withColumn(f"_b_{kind}", F.filter(placed(F.col(f"_b_{kind}")), checked(kind)))
               .withColumn(f"_w_{kind}", F.filter(placed(F.col(f"_w_{kind}")), lambda x: F.length(x["s"]) >= 6)))
    tag = lambda c, k: F.transform(F.col(c), lambda x: x.withField("kind", F.lit(k)))
    out = out.withColumn("_base", F.concat(*[tag(f"_b_{k}", k) for k in KINDS])).withColumn("_wide", F.concat(*[tag(f"_w_{k}", k) for k in KINDS]))
    apart = lambda x: ~F.exists("_base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
    return out.withColumn("_wide", F.filter("_wide", apart)).drop(*[f"_{p}_{k}" for p in "bw" for k in KINDS])


def examples(sample: DataFrame) -> DataFrame:
    """Labelled candidates (kind, s, prev, next, label) from documents with spans."""
    base = sample.select(F.inline("_base"))
    wide = sample.select(F.inline("_wide")).filter(~as_written(F.col("kind"), F.col("s"))).select("kind", "s", "prev", "next", F.lit(0.0).alias("label"))
    s, k, d = F.col("s"), F.col("kind"), digits(F.col("s"))
    four = lambda sep: F.concat_ws(sep, *[F.substring(d, 1 + 4 * i, 4) for i in range(4)], F.substring(d, 17, 3))
    written = F.when(k == "email", F.array(s, F.replace(s, F.lit("@"), F.lit(" [at] ")), F.replace(s, F.lit("@"), F.lit("(at)")), F.replace(s, F.lit("."), F.lit(" [dot] "))))
    written = written.when(k == "ip", F.array(s, F.replace(s, F.lit("."), F.lit("[.]")), F.replace(s, F.lit("."), F.lit(" . "))))
    written = written.when(k == "card", F.array(s, four("."), four("/"), four("  ")))
    written = written.otherwise(F.array(s, F.regexp_replace(s, r"[\x20().-]+", "."), F.regexp_replace(s, r"^\+", "00"), F.regexp_replace(s, r"[()]", "")))
    last = F.substring(d, -1, 1).cast("int")
    damaged = F.when(k == "email", F.array(F.regexp_replace(s, "@.*", " [at] home.")))
    damaged = damaged.when(k == "ip", F.array(F.regexp_replace(s, "^[0-9]+", "731"), F.regexp_replace(s, r"\.[0-9]+$", ""), F.regexp_replace(s, r"\.", ", ")))
    damaged = damaged.when(k == "card", F.array(F.concat(F.substring(d, 1, 15), ((last + 5) % 10).cast("string")), F.substring(d, 1, 11), F.concat(F.substring(d, 1, 8), F.lit("/"), F.substring(d, 9, 4))))
    damaged = damaged.otherwise(F.array(F.concat(F.lit("20"), F.substring(d, -6, 2), F.lit("-"), F.substring(d, -4, 2), F.lit("-"), F.substring(d, -2, 2)), F.substring(d, -6, 6), F.substring(d, -9, 9)))
    good = base.select("kind", F.explode(written).alias("s"), "prev", "next", F.lit(1.0).alias("label"))
    bad = base.select("kind", F.explode(damaged).alias("s"), "prev", "next", F.lit(0.0).alias("label"))
    glued = base.select("kind", "s", F.lit("a").alias("prev"), F.lit("f").alias("next"), F.lit(0.0).alias("label"))
    return good.union(bad).union(wide).union(glued)


def fit(docs: DataFrame, precision: float = PRECISION):
    """(trees, weights, thresholds): trees as nested (feature, split, left,
    right) or leaf values; None if the documents have no base spans."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = examples(stored(spans(docs.select("text")).select("_base", "_wide"), "pii-spans"))
    f = features(F.col("kind"), F.col("s"), F.col("prev"), F.col("next"))
    rows = rows.select("label", "kind", F.pmod(F.xxhash64("s", "prev", "next"), F.lit(4)).alias("part"), *[f[c].alias(c) for c in FEATURES])
    rows = stored(rows, "pii-examples")
    seen = {r["label"] for r in rows.filter("part > 0").select("label").distinct().collect()}
    if len(seen) < 2:
        return None
    vec = VectorAssembler(inputCols=list(FEATURES), outputCol="x")
    model = GBTClassifier(featuresCol="x", labelCol="label", maxIter=8, maxDepth=4, stepSize=0.4, seed=1, cacheNodeIds=False).fit(vec.transform(rows.filter("part > 0")))
    trees = [_tree(t._call_java("rootNode")) for t in model.trees]
    weights = list(model.treeWeights)
    score = score_of((trees, weights, None), {c: F.col(c) for c in FEATURES})
    held = rows.filter("part = 0").select("kind", "label", F.round(score, 6).alias("p")).groupBy("kind", "p").agg(F.sum("label").alias("good"), F.count(F.lit(1)).alias("n")).collect()
    thresholds = {}
    for kind in KINDS:
        good = n = 0
        best = 2.0
        for r in sorted((r for r in held if r["kind"] == kind), key=lambda r: -r["p"]):
            good, n = good + r["good"], n + r["n"]
            if good >= precision * n:
                best = r["p"]
        thresholds[kind] = max(best, 0.5)
    return trees, weights, thresholds


def _tree(node):
    if node.getClass().getSimpleName() == "LeafNode":
        return float(node.prediction())
    return (FEATURES[node.split().featureIndex()], float(node.split().threshold()), _tree(node.leftChild()), _tree(node.rightChild()))


def score_of(model, f: dict[str, Column]) -> Column:
    """The trees as one expression: probability of personal data."""
    def of(node) -> Column:
        if isinstance(node, float):
            return F.lit(node)
        name, at, left, right = node
        return F.when(f[name] <= at, of(left)).otherwise(of(right))

    total = sum((of(t) * w for t, w in zip(model[0], model[1], strict=True)), F.lit(0.0))
    return 1 / (1 + F.exp(-2 * total))


def detect(docs: DataFrame, model) -> DataFrame:
    """``docs`` with _base (base spans) and _all (with added spans), arrays of
    kind, start, end by kind as listed, then start (columns of those names
    are replaced)."""
    return apart(docs, ("text",), lambda d: _detect(d, model), ("_base", "_all"))


def _detect(docs: DataFrame, model) -> DataFrame:
    rank = lambda x: F.array_position(F.array(*[F.lit(k) for k in KINDS]), x["kind"])
    brief = lambda c: F.sort_array(F.transform(c, lambda x: F.struct(rank(x).alias("r"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    d = spans(docs)
    if model is None:
        d = d.withColumn("_wide", F.filter("_wide", lambda x: F.lit(False)))
    else:
        def scored(x: Column) -> Column:
            # features once per candidate: the inner array binds them
            f = features(x["kind"], x["s"], x["prev"], x["next"])
            row = F.array(F.struct(*[f[c].alias(c) for c in FEATURES]))
            return x.withField("p", F.get(F.transform(row, lambda r: score_of(model, {c: r[c] for c in FEATURES})), 0))

        limit = F.create_map(*[F.lit(v) for k in KINDS for v in (k, model[2][k])])
        d = d.withColumn("_wide", F.filter(F.transform("_wide", scored), lambda x: x["p"] >= limit[x["kind"]]))
        # of overlapping additions the likeliest stays, then the first, then the first kind
        key = lambda x: F.struct(-x["p"], x["start"], rank(x))
        worse = lambda x: F.exists("_wide", lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]) & (key(y) < key(x)))
        d = d.withColumn("_wide", F.filter("_wide", lambda x: ~worse(x)))
    return d.withColumn("_all", F.concat(brief(F.col("_base")), brief(F.col("_wide")))).withColumn("_all", F.sort_array("_all")).withColumn("_base", brief(F.col("_base"))).drop("_wide")


def listed(c: Column) -> Column:
    return F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """``docs`` with each detected span replaced by its kind in brackets."""
    d = detect(docs, model)
    by_start = F.sort_array(F.transform("_all", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    zero = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))
    step = lambda a, x: F.when(x["start"] >= a["pos"], F.struct(x["end"].alias("pos"), F.concat(a["out"], F.substring(F.col(text), a["pos"] + 1, x["start"] - a["pos"]), F.lit("["), x["kind"], F.lit("]")).alias("out"))).otherwise(a)
    clean = F.aggregate(by_start, zero, step, lambda a: F.concat(a["out"], F.substring(F.col(text), a["pos"] + 1, F.length(text))))
    return d.withColumn(text, F.when(F.size("_all") > 0, clean).otherwise(F.col(text))).drop("_all", "_base")
