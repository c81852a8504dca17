"""Distributed ranks over distinct values: exact quantiles and running sums.

A global ``percentile`` keeps every distinct value of a column in one task, and
a ``Window`` without ``partitionBy`` runs in one task; neither survives large
inputs. Here both are done in buckets:

1. collapse to distinct values with counts (partial aggregation before the shuffle);
2. cut each group's value range into ~``n_buckets`` ranges with
   ``percentile_approx`` (bounded memory) and assign a bucket with a
   binary-search ``CASE`` (codegen, no UDF); where that takes more than
   ``SKETCH_BUCKETS`` ranges, Spark's range partitioning of (group, value) cuts
   them instead, as many as there are;
3. total per (group, bucket), prefixed into offsets: a row per
   ``ROWS_PER_BUCKET`` distinct values and per group;
4. a running sum ``over (partition by group, bucket order by value)`` plus the
   bucket offset gives the exact [rank_lo, rank_hi] of every distinct value.

Exact results, every task bounded by one bucket of distinct values.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.session import stored

ROWS_PER_BUCKET = 2_000_000  # distinct values per window task
SKETCH_BUCKETS = 1024        # per group, by a sketch; CASE tree depth log2(1024) = 10
MAX_OFFSET_ROWS = 200_000    # size check for the broadcast offsets table


def search_expr(value: Column, splits: Sequence[float]) -> Column:
    """Number of splits <= value, as a balanced CASE tree (log2 depth)."""
    splits = sorted(set(float(s) for s in splits if s is not None and not math.isnan(s)))

    def build(lo: int, hi: int) -> Column:
        # answer lies in [lo, hi]; splits[lo:hi] still undecided
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2  # test split index mid
        return F.when(value < F.lit(splits[mid]), build(lo, mid)).otherwise(build(mid + 1, hi))

    return build(0, len(splits)) if splits else F.lit(0)


def _group_key(group_cols: Sequence[str]) -> Column:
    if not group_cols:
        return F.lit("")
    # "-" is a NULL, "=" leads a value: NULL and '' stay apart
    return F.concat_ws("\u0001", *[F.coalesce(F.concat(F.lit("="), F.col(g).cast("string")), F.lit("-")) for g in group_cols])


def running_totals(df: DataFrame, value_col: str, group_cols: Sequence[str] = (),
                   sums: dict | None = None, rows_per_bucket: int | None = None,
                   descending: bool = False):
    """Distinct (group, value) rows with exact running totals in value order.

    ``sums`` maps output name -> Column summed per distinct value (default
    ``{"cnt": 1}``). For each name ``k`` the result has ``k`` (the sum at this
    value), ``cum_k`` (inclusive running total within the group) and
    ``before_k`` (total strictly before this value). Returns ``(ranked, info)``;
    ``info[group_key]`` = {"key": group values, "total": {k: n}, "offsets": [(bucket, {k: off}, {k: n})]}.
    NULL values are dropped.
    """
    group_cols = list(group_cols)
    rows_per_bucket = rows_per_bucket or ROWS_PER_BUCKET
    sums = sums or {"cnt": F.lit(1)}
    names = list(sums)
    v = F.col(value_col)
    vc = (df.where(v.isNotNull())
          .groupBy(*group_cols, value_col).agg(*[F.sum(e).alias(k) for k, e in sums.items()]))
    vc = vc.withColumn("_g", _group_key(group_cols))
    vc = stored(vc, "running-totals")  # read by the size, split and window passes
    # Buckets per group from its distinct count: small groups need no split
    # (bucket 0, no expression), large ones get ~rows_per_bucket values each.
    size_rows = vc.groupBy("_g", *group_cols).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(k).alias(k) for k in names]).collect()
    sizes = {r["_g"]: r["_n"] for r in size_rows}
    keys = {r["_g"]: tuple(r[c] for c in group_cols) for r in size_rows}
    if len(sizes) > MAX_OFFSET_ROWS:
        raise ValueError("too many groups for bucketed running totals")
    want = {g: -(-n // rows_per_bucket) for g, n in sizes.items()}
    big = {g: b for g, b in want.items() if b > 1}
    ranged = max(want.values(), default=0) > SKETCH_BUCKETS
    splits: dict = {}
    if big and not ranged:
        nb = max(big.values())
        fracs = [i / nb for i in range(1, nb)]
        rows = (vc.where(F.col("_g").isin(list(big)))
                .groupBy("_g").agg(F.percentile_approx(v.cast("double"), fracs, 10000).alias("s")).collect())
        splits = {r["_g"]: (r["s"] or []) for r in rows}
    bucket = F.lit(0)
    if splits:
        bucket = None
        for g, sp in splits.items():
            e = search_expr(v.cast("double"), sp)
            bucket = F.when(F.col("_g") == g, e) if bucket is None else bucket.when(F.col("_g") == g, e)
        bucket = bucket.otherwise(F.lit(0))
    if descending:
        bucket = F.lit(SKETCH_BUCKETS + 1) - bucket
    vb = vc.withColumn("bucket", bucket.cast("int"))
    if ranged:
        order = F.col(value_col).desc() if descending else F.col(value_col).asc()
        vb = stored(vc.repartitionByRange(sum(want.values()), F.col("_g"), order).withColumn("bucket", F.spark_partition_id()), "running-ranges")
    if splits or ranged:
        totals = vb.groupBy("_g", "bucket").agg(*[F.sum(k).alias(k) for k in names]).collect()
    else:  # one bucket per group: the size pass already holds the totals
        b0 = (SKETCH_BUCKETS + 1) if descending else 0
        totals = [dict(_g=r["_g"], bucket=b0, **{k: r[k] for k in names}) for r in size_rows]
    info: dict = {}
    for r in sorted(totals, key=lambda r: (r["_g"], r["bucket"])):
        d = info.setdefault(r["_g"], {"key": keys[r["_g"]], "total": {k: 0 for k in names}, "offsets": []})
        d["offsets"].append((r["bucket"], dict(d["total"]), {k: r[k] for k in names}))
        for k in names:
            d["total"][k] += r[k]
    spark = df.sparkSession
    off_rows = [(g, b, *[off[k] for k in names]) for g, d in info.items() for (b, off, _) in d["offsets"]]
    off_schema = "_g string, bucket int, " + ", ".join(f"_off_{k} {_sql_type(vc, k)}" for k in names)
    off_df = spark.createDataFrame(off_rows, off_schema)
    order = v.desc() if descending else v.asc()
    win = Window.partitionBy("_g", "bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    ranked = vb
    for k in names:
        ranked = ranked.withColumn(f"_run_{k}", F.sum(k).over(win))
    # offsets: one row per (group, bucket); broadcast only where that is few
    ranked = ranked.join(F.broadcast(off_df) if len(off_rows) <= MAX_OFFSET_ROWS else off_df, ["_g", "bucket"])
    for k in names:
        ranked = (ranked.withColumn(f"cum_{k}", F.col(f"_run_{k}") + F.col(f"_off_{k}"))
                  .withColumn(f"before_{k}", F.col(f"cum_{k}") - F.col(k))
                  .drop(f"_run_{k}", f"_off_{k}"))
    return ranked, info


def _sql_type(df: DataFrame, col: str) -> str:
    t = dict(df.dtypes)[col]
    return "double" if t in ("double", "float") else "long"


def ranked_distinct(df: DataFrame, value_col: str, group_cols: Sequence[str] = (),
                    rows_per_bucket: int | None = None):
    """Counts per distinct value with [cum_before, cum) rank spans."""
    ranked, info = running_totals(df, value_col, group_cols, {"cnt": F.lit(1).cast("long")}, rows_per_bucket)
    ranked = ranked.withColumnRenamed("cum_cnt", "cum").withColumnRenamed("before_cnt", "cum_before")
    for g, d in info.items():
        d["total"] = d["total"]["cnt"]
        d["offsets"] = [(b, off["cnt"], tot["cnt"]) for b, off, tot in d["offsets"]]
    return ranked, info


def bucket_of_rank(info_g: dict, r: int):
    for b, off, tot in info_g["offsets"]:
        if off <= r < off + tot:
            return b
    return None


COLLECT_VALUES = 100_000  # different values inside a bracket that reach the driver
SKETCH = 10_000           # accuracy of the sketch that proposes brackets
MANY = 64                 # quantiles whose brackets still fit generated code
SPLIT = 32                # parts of a bracket that is counted again


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], collect_values: int = COLLECT_VALUES) -> dict:
    """{col: [q_p for p in probs]} with linear interpolation between order
    statistics (pandas default, DuckDB ``quantile_cont``); NaN/NULL skipped.

    Exact selection by counting, all columns at once, without shuffling column
    values: a quantile sketch proposes a bracket around every wanted rank; one
    pass counts the values between the brackets' edges; the few values inside
    the brackets that hold a wanted rank are collected with their counts. A
    bracket with too many values gets edges from a sketch of its own values
    and is counted again, so its size falls by the sketch's accuracy a pass.
    Many quantiles go to ``many_quantiles``: the same numbers by another plan.
    """
    cols = list(cols)
    if not cols:
        return {}
    if len(set(probs)) > MANY:
        return many_quantiles(df, cols, probs)
    num = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in cols]
    data = df.select(*[x.alias(f"v{i}") for i, x in enumerate(num)])
    eps = 2.0 / SKETCH
    fracs = sorted({min(1.0, max(0.0, float(p) + d)) for p in probs for d in (-eps, eps)})
    row = data.agg(*[F.count(f"v{i}").alias(f"n{i}") for i in range(len(cols))],
                   *[F.percentile_approx(f"v{i}", fracs, SKETCH).alias(f"q{i}") for i in range(len(cols))]).first()
    n = [row[f"n{i}"] for i in range(len(cols))]
    wanted = {i: sorted({r for p in probs for r in (math.floor((n[i] - 1) * float(p)), math.ceil((n[i] - 1) * float(p)))}) for i in range(len(cols)) if n[i]}
    # an edge and the number after it: a value held by many rows gets a bracket of its own
    edges = {i: sorted({e for q in row[f"q{i}"] for e in (q, math.nextafter(q, math.inf))}) for i in wanted}
    value: dict = {}
    while wanted:
        live = list(wanted)
        parts = ", ".join(f"{i}, v{i}, _b{i}" for i in live)
        cut = data.select("*", *[search_expr(F.col(f"v{i}"), edges[i]).alias(f"_b{i}") for i in live])
        cells = cut.select(F.expr(f"stack({len(live)}, {parts}) as (c, v, b)")).where("v is not null")
        counts: dict = {}
        for r in cells.groupBy("c", "b").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect():
            counts.setdefault(r["c"], []).append((r["b"], r["n"], r["lo"], r["hi"]))
        small, large = {}, {}
        for i in live:
            below = 0
            for b, m, lo, hi in sorted(counts[i]):
                ranks = [r for r in wanted[i] if below <= r < below + m]
                if ranks and lo == hi:
                    value.update({(i, r): lo for r in ranks})
                elif ranks:
                    (small if m <= collect_values else large)[(i, b)] = (below, ranks)
                below += m
        if small:
            hit = F.concat_ws(":", "c", "b").isin([f"{i}:{b}" for i, b in small])
            got: dict = {}
            for r in cells.where(hit).groupBy("c", "b", "v").agg(F.count(F.lit(1)).alias("n")).collect():
                got.setdefault((r["c"], r["b"]), []).append((r["v"], r["n"]))
            for (i, b), (at, ranks) in small.items():
                for v, m in sorted(got[(i, b)]):
                    value.update({(i, r): v for r in ranks if at <= r < at + m})
                    at += m
        wanted = {}
        if large:
            hit = F.concat_ws(":", "c", "b").isin([f"{i}:{b}" for i, b in large])
            grid = [k / 500 for k in range(501)]
            for r in cells.where(hit).groupBy("c", "b").agg(F.percentile_approx("v", grid, SKETCH).alias("q")).collect():
                i = r["c"]
                wanted[i] = sorted({*wanted.get(i, []), *large[(i, r["b"])][1]})
                edges[i] = sorted({*edges[i], *(e for q in r["q"] for e in (q, math.nextafter(q, math.inf)))})
    return {c: _interpolated(n[i], probs, {r: v for (j, r), v in value.items() if j == i}) if n[i] else [None] * len(probs) for i, c in enumerate(cols)}


def _interpolated(n: int, probs: Sequence[float], value: dict) -> list:
    out = []
    for p in probs:
        h = (n - 1) * float(p)
        x, y = value[math.floor(h)], value[math.ceil(h)]
        out.append(x + (y - x) * (h - math.floor(h)) if y != x else x)
    return out


def _parts(lo: float, hi: float) -> list:
    """Edges that cut [lo, hi]: even in value and even in the order of the
    floating-point numbers, so that skewed values are parted as well."""
    import struct

    def code(x: float) -> int:
        i = struct.unpack("<q", struct.pack("<d", x))[0]
        return i if i >= 0 else -(i & 0x7FFFFFFFFFFFFFFF)

    def back(i: int) -> float:
        return struct.unpack("<d", struct.pack("<q", i))[0] if i >= 0 else -struct.unpack("<d", struct.pack("<q", -i))[0]

    a, b = code(lo), code(hi)
    even = [lo + (hi / SPLIT - lo / SPLIT) * k for k in range(SPLIT)]
    return sorted({x for x in (lo, *even, *(back(a + (b - a) * k // SPLIT) for k in range(SPLIT)), math.nextafter(lo, math.inf), hi) if lo <= x <= hi})


def many_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict:
    """``exact_quantiles`` for hundreds of ranks, all columns in one pass.

    Brackets are counted in Arrow batches against a sorted array of edges,
    running counts and the choice of the brackets that hold a wanted rank are
    made in Spark, and only those reach the driver, with their smallest and
    largest value: at most a row per wanted rank and pass. A bracket of one
    value is answered, any other is cut into ``SPLIT`` parts and counted again.
    """
    import numpy as np

    cols = list(cols)
    spark = df.sparkSession
    data = df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(f"v{i}") for i, c in enumerate(cols)])
    fracs = sorted({min(1.0, max(0.0, float(p))) for p in probs})
    row = data.agg(*[F.count(f"v{i}").alias(f"n{i}") for i in range(len(cols))], *[F.min(f"v{i}").alias(f"a{i}") for i in range(len(cols))],
                   *[F.max(f"v{i}").alias(f"b{i}") for i in range(len(cols))], *[F.percentile_approx(f"v{i}", fracs, SKETCH).alias(f"q{i}") for i in range(len(cols))]).first()
    n = [row[f"n{i}"] for i in range(len(cols))]
    wanted = {i: sorted({r for p in probs for r in (math.floor((n[i] - 1) * float(p)), math.ceil((n[i] - 1) * float(p)))}) for i in range(len(cols)) if n[i]}
    value: dict = {i: {} for i in wanted}
    # segments: (rows below, edges); an edge begins a part, the last one only ends it
    segments = {i: [(0, sorted({row[f"a{i}"], *(e for q in row[f"q{i}"] for e in (q, math.nextafter(q, math.inf))), row[f"b{i}"]}) + [math.nextafter(row[f"b{i}"], math.inf)])] for i in wanted}
    while segments:
        flat = {i: (np.concatenate([e for _, e in parts]), np.concatenate([np.full(len(e), k) for k, (_, e) in enumerate(parts)])) for i, parts in segments.items()}
        sent = spark.sparkContext.broadcast(flat)  # a few numbers per wanted rank

        def count(batches):
            import pyarrow as pa

            total: dict = {}
            for batch in batches:
                for i, (edges, segment) in sent.value.items():
                    v = batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64)
                    v = v[~np.isnan(v)]
                    at = np.searchsorted(edges, v, "right") - 1
                    ok = (at >= 0) & (at < len(edges) - 1)
                    ok[ok] = segment[at[ok]] == segment[at[ok] + 1]  # not between two segments
                    at, v = at[ok], v[ok]
                    m, lo, hi = total.setdefault(i, (np.zeros(len(edges), np.int64), np.full(len(edges), np.inf), np.full(len(edges), -np.inf)))
                    m += np.bincount(at, minlength=len(edges))
                    np.minimum.at(lo, at, v)
                    np.maximum.at(hi, at, v)
            for i, (m, lo, hi) in total.items():
                b = np.flatnonzero(m)
                seg = sent.value[i][1][b]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b), i)), pa.array(seg.astype(np.int64)), pa.array(b), pa.array(m[b]), pa.array(lo[b]), pa.array(hi[b])], ["c", "s", "b", "n", "lo", "hi"])

        cells = data.mapInArrow(count, "c long, s long, b long, n long, lo double, hi double").groupBy("c", "s", "b").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        before = Window.partitionBy("c", "s").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)  # the parts of one segment
        cells = cells.withColumn("upto", F.sum("n").over(before))
        asked = spark.sparkContext.broadcast({i: (np.array([below for below, _ in segments[i]], np.int64), np.array(wanted[i], np.int64)) for i in segments})

        def pick(batches):
            import pyarrow as pa

            for batch in batches:
                c, s, n, upto = (batch.column(i).to_numpy() for i in range(4))
                first, r = np.zeros(len(c), np.int64), [[]] * len(c)
                for i, (below, ranks) in asked.value.items():
                    at = np.flatnonzero(c == i)
                    first[at] = below[s[at]] + upto[at] - n[at]
                    a, b = np.searchsorted(ranks, first[at]), np.searchsorted(ranks, first[at] + n[at])
                    for j in np.flatnonzero(b > a):
                        r[at[j]] = ranks[a[j]:b[j]].tolist()
                held = pa.array([bool(x) for x in r], pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(first), batch.column(4), batch.column(5), pa.array(r, pa.list_(pa.int64()))], ["c", "first", "lo", "hi", "r"]).filter(held)

        # ranks are found by bisection: a cell against every wanted rank took most of a pass
        held = cells.select("c", "s", "n", "upto", "lo", "hi").mapInArrow(pick, "c long, first long, lo double, hi double, r array<long>")
        segments = {}
        for x in sorted(held.collect(), key=lambda x: (x["c"], x["first"])):
            if x["lo"] == x["hi"]:
                value[x["c"]].update({r: x["lo"] for r in x["r"]})
            else:
                segments.setdefault(x["c"], []).append((x["first"], [*_parts(x["lo"], x["hi"]), math.nextafter(x["hi"], math.inf)]))
    return {c: _interpolated(n[i], probs, value[i]) if n[i] else [None] * len(probs) for i, c in enumerate(cols)}


def approx_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int = 10_000) -> dict:
    """Bounded-memory alternative to ``exact_quantiles`` (one aggregate,
    relative rank error about 1/accuracy); no distinct-value shuffle."""
    cols = list(cols)
    if not cols:
        return {}
    row = df.agg(*[F.percentile_approx(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")),
                                       list(probs), accuracy).alias(f"q{i}") for i, c in enumerate(cols)]).first()
    return {c: list(row[f"q{i}"]) if row[f"q{i}"] is not None else [None] * len(probs) for i, c in enumerate(cols)}
