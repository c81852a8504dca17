"""Approximate nearest neighbours by neighbour-graph descent.

Dong, Charikar & Li (2011): a neighbour of a neighbour is likely a neighbour.
Every row holds a list of its best candidates so far. A round gathers, around
each candidate, the rows that list it and those that it lists, and lets them
compare each other; what is nearer than a row's last entry goes into its list.
The number of rounds is fixed, and so is what a row takes part in (its list,
and at most ``BACK`` rows that list it, drawn by hash), so work is linear in
the rows.

Lists start from random cells (rows dealt by hash, at least a few ``START``
rows each, so every row is covered) and from the leaves of ``TREES`` trees of
pivots drawn by different hashes. With ``within``, cells hold one class, so
lists never leave it. No step is an exact join.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.session import stored

START, LEAF, TREES, ROUNDS, BACK, EXTRA = 256, 512, 3, 4, 32, 25
PAIR = "id long, nb long, d2 double"


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances in feature order, as the exact join sums them."""
    out = (a[:, 0:1] - b[:, 0][None, :]) ** 2
    for f in range(1, a.shape[1]):
        out = out + (a[:, f:f + 1] - b[:, f][None, :]) ** 2
    return out


def _vectors(column) -> np.ndarray:
    return np.stack([np.frombuffer(x, "<f8") for x in column]) if len(column) else np.zeros((0, 1))


def _best(ids, names, x, y, k: int, self_too: bool, limit=None) -> pd.DataFrame:
    """The ``k`` nearest of the candidates ``y`` of each row of ``x``, below
    ``limit`` where given (ties: the smaller key)."""
    from tabprep.operators.knn import nearest

    by_name = np.argsort(names, kind="stable")  # ties go by column
    names, y = names[by_name], y[by_name]
    near = nearest(x, y, k, None if self_too else ids[:, None] == names[None, :], limit)
    if near is not None:
        return pd.DataFrame({"id": ids[near[0]], "nb": names[near[1]], "d2": near[2]})
    d = _distances(x, y)
    if not self_too:
        d[ids[:, None] == names[None, :]] = np.inf
    if limit is not None:
        d[d >= limit[:, None]] = np.inf
    k = min(k, d.shape[1])
    order = np.lexsort((np.broadcast_to(names, d.shape), d), axis=1)[:, :k]
    near = np.take_along_axis(d, order, axis=1)
    rows, cols = np.nonzero(np.isfinite(near))
    return pd.DataFrame({"id": ids[rows], "nb": names[order[rows, cols]], "d2": near[rows, cols]})


def _in_cells(nodes: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    """(id, nb, d2): every row's best candidates of its cell."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x, ids = _vectors(pdf["v"]), pdf["id"].to_numpy()
        have = pdf["cand"].to_numpy(bool)
        if not have.any():
            return pd.DataFrame({"id": [], "nb": [], "d2": []}).astype({"id": "int64", "nb": "int64", "d2": "float64"})
        ask = np.flatnonzero(pdf["asks"].to_numpy(bool) | have)
        parts = [_best(ids[ask[a:a + 512]], ids[have], x[ask[a:a + 512]], x[have], k, not exclude_self) for a in range(0, len(ask), 512)]
        return pd.concat(parts, ignore_index=True)

    return nodes.select("cell", "id", "cand", "asks", "v").groupBy("cell").applyInPandas(run, PAIR)


def _kept(pairs: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("id").orderBy("d2", "nb")
    return pairs.dropDuplicates(["id", "nb"]).withColumn("n", F.row_number().over(best)).where(F.col("n") <= k)


def _round(nodes: DataFrame, lists: DataFrame, k: int, exclude_self: bool, parts: int) -> DataFrame:
    """Pairs found around every candidate."""
    last = lists.groupBy("id").agg(F.max("d2").alias("far"), F.count(F.lit(1)).alias("n"))
    back = Window.partitionBy("v").orderBy(F.xxhash64("member", "v"))
    ahead = lists.select(F.col("id").alias("v"), F.col("nb").alias("member"))
    behind = (lists.select(F.col("nb").alias("v"), F.col("id").alias("member")).withColumn("n", F.row_number().over(back)).where(F.col("n") <= BACK).drop("n"))
    own = nodes.where("cand").select(F.col("id").alias("v"), F.col("id").alias("member"))
    around = ahead.union(behind).union(own).distinct()
    with_rows = (around.join(nodes.select(F.col("id").alias("member"), "cand", "v0"), "member")
                 .join(last.select(F.col("id").alias("member"), F.when(F.col("n") >= k, F.col("far")).otherwise(F.lit(float("inf"))).alias("far")), "member", "left"))
    rows = with_rows.select("v", "member", "cand", F.coalesce("far", F.lit(float("inf"))).alias("far"), "v0").repartition(parts, "v").sortWithinPartitions("v")

    def compare(pdf: pd.DataFrame):
        have = pdf["cand"].to_numpy(bool)
        if not have.any():
            return None
        x, ids = _vectors(pdf["v0"]), pdf["member"].to_numpy()
        return _best(ids, ids[have], x, x[have], k, not exclude_self, pdf["far"].to_numpy())

    def run(batches):
        held = None
        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            cut = int(np.searchsorted(pdf["v"].to_numpy(), pdf["v"].iloc[-1], "left")) if len(pdf) else 0
            held, out = pdf.iloc[cut:], []
            for _, group in pdf.iloc[:cut].groupby("v", sort=False):
                got = compare(group)
                if got is not None and len(got):
                    out.append(got)
            if out:
                yield pd.concat(out, ignore_index=True)
        if held is not None and len(held):
            got = compare(held)
            if got is not None:
                yield got

    return rows.mapInPandas(run, PAIR)


def knn_graph(queries: DataFrame, candidates: DataFrame, features: Sequence[str], k: int, key: str, cand_key: str | None = None,
              exclude_self: bool = True, cand_label: str | None = None, within: str | None = None, rounds: int = ROUNDS) -> DataFrame:
    """q_key, c_key, dist, d2, rank [, c_label], as the exact join returns them."""
    from tabprep.operators.knn import _cells, _class_index, _plant, _prep

    spark = candidates.sparkSession
    cand_key = cand_key or key
    nf, parts = len(features), int(spark.conf.get("spark.sql.shuffle.partitions"))
    classes, index = _class_index(candidates, within)
    one = queries is candidates and key == cand_key
    c = _prep(candidates, cand_key, features, cand_label, "c", index).where("g is not null")
    names = [f"cv{i}" for i in range(nf)]
    both = c.select(F.col("ck").alias("id"), "g", F.lit(True).alias("cand"), F.lit(one).alias("asks"), *names)
    if not one:
        q = _prep(queries, key, features, None, "q", index).where("g is not null")
        both = both.union(q.select(F.col("qk").alias("id"), "g", F.lit(False), F.lit(True), *[f"qv{i}" for i in range(nf)]))
        # a query that is a candidate too is one row
        both = both.groupBy("id").agg(F.first("g").alias("g"), F.max("cand").alias("cand"), F.max("asks").alias("asks"), *[F.first(n).alias(n) for n in names])
    width = k + EXTRA
    nodes = stored(_packed(both, names), "graph-nodes")
    n = {r["g"]: r["n"] for r in nodes.groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n:
        return spark.createDataFrame([], "q_key long, c_key long, dist double, d2 double, rank int" + (", c_label long" if cand_label else ""))
    many = F.create_map(*[F.lit(x) for g, m in n.items() for x in (g, max(1, m // START))])[F.col("g")]
    dealt = nodes.withColumn("cell", F.concat_ws(":", "g", F.pmod(F.xxhash64("id", F.lit(5)), many)))
    found = _in_cells(dealt.withColumnRenamed("v0", "v"), width, exclude_self)
    for t in range(TREES):
        shape = nodes.select(F.col("id").alias("ck"), "g", "cand", "asks", *names)
        tree, _, _ = _plant(shape.where("cand").drop("cand", "asks"), nf, classes, LEAF, t)
        leaves = _cells(shape, "c", nf, tree).select(F.col("ck").alias("id"), "cand", "asks", F.concat_ws(":", F.lit(f"t{t}"), "cell").alias("cell")).join(nodes.select("id", F.col("v0").alias("v")), "id")
        found = found.union(_in_cells(leaves, width, exclude_self))
    lists = stored(_kept(found, width).drop("n"), "graph-lists")
    for _ in range(rounds):
        lists = stored(_kept(lists.union(_round(nodes, lists, width, exclude_self, parts)), width).drop("n"), "graph-lists")
    out = _kept(lists.join(nodes.where("asks").select("id"), "id", "left_semi"), k)
    out = out.select(F.col("id").alias("q_key"), F.col("nb").alias("c_key"), F.sqrt("d2").alias("dist"), "d2", F.col("n").alias("rank"))
    if cand_label:
        out = out.join(c.select(F.col("ck").alias("c_key"), F.col("cl").alias("c_label")), "c_key").select("q_key", "c_key", "dist", "d2", "rank", "c_label")
    return out


def _packed(nodes: DataFrame, names: list) -> DataFrame:
    """Rows with their vector as bytes, ``v0``, beside the columns."""
    kinds = {"id": "long", "g": "long", "cand": "boolean", "asks": "boolean"}

    def run(batches):
        for pdf in batches:
            m = np.ascontiguousarray(pdf[names].to_numpy(np.float64)).astype("<f8")
            yield pdf[[*kinds, *names]].assign(v0=[r.tobytes() for r in m])

    return nodes.mapInPandas(run, ", ".join([*[f"{c} {t}" for c, t in kinds.items()], *[f"{c} double" for c in names], "v0 binary"]))
