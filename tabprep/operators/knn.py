"""k-nearest-neighbour join.

``knn_join(queries, candidates, ...)`` returns, for every query row, its k
nearest candidate rows by Euclidean distance (ties: candidate key), optionally
excluding the row itself.

Exact method, pruned by a tree of pivots:
  * ``within`` names a class column: a query then meets candidates of its own
    class only, and every class has its own tree, so one join serves them all;
  * a cell of more than ``CELL_ROWS`` candidates is cut: some of its rows,
    drawn by hash, are pivots, and its rows go to the nearest one, up to
    ``LEVELS`` times (a projection, no shuffle). Cells stay near that size
    whatever the table holds; a small aggregate gives each cell's row count
    and radius, at most ``FAN ** LEVELS`` numbers;
  * round 1 joins every query with its own cell; the k-th distance found there
    bounds the true one from above (no bound where the cell has fewer rows);
  * round 2 goes down the tree and sends a query only to the cells whose lower
    bound (by the ball and the box around their rows, and by the plane between
    their pivot and the nearest one) does not exceed that k-th distance; a node
    that is too far takes all its cells with it;
  * cells over ``block_rows`` candidates (rows that pivots cannot part) are
    split by hash and their queries meet every part, so a dense cell is never
    one task's; parts emit only their top k, and a window per query keeps the
    best k of all.
On clustered rows most cells are never met; on rows without structure every
query meets every cell, as any exact method must.

Approximate methods: ``approx`` is the neighbour-graph descent of
``knn_graph``; ``lsh`` joins the buckets of ``BucketedRandomProjectionLSH``
(Spark ML) as ``approxSimilarityJoin`` does, but a bucket's rows meet in blocks
that emit their top k, so no pair is a row; queries it leaves short of k are
finished by the exact join.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.session import stored

BLOCK_ROWS = 20_000
CHUNK = 512
TILE = 2048  # candidates of a matrix product
REACH_CHUNK, REACH_ROWS = 4096, 20_000
LOT_ROWS = 80_000  # queries of a hash bucket that a task holds


def _prep(df: DataFrame, key: str, features: Sequence[str], label: str | None, prefix: str, index) -> DataFrame:
    # plain double columns: Arrow hands them to numpy without per-row objects
    cols = [F.col(key).cast("long").alias(f"{prefix}k"),
            *[F.col(f).cast("double").alias(f"{prefix}v{i}") for i, f in enumerate(features)]]
    if label:
        cols.append(F.col(label).cast("long").alias(f"{prefix}l"))
    # a missing feature has no distance: raise instead of losing the row's neighbours
    for i, f in enumerate(features):
        bad = F.raise_error(F.lit(f"kNN feature {f} is NULL or NaN: impute or drop such rows first"))
        cols[1 + i] = F.when(F.col(f).isNull() | F.isnan(F.col(f).cast("double")), bad.cast("double")).otherwise(F.col(f).cast("double")).alias(f"{prefix}v{i}")
    return df.select(*cols, index.alias("g"))


def nearest(x: np.ndarray, y: np.ndarray, k: int, gone=None, limit: np.ndarray | None = None):
    """(row, col, d2) of the ``k`` nearest rows of ``y`` to each row of ``x``,
    by row, distance and column; pairs in ``gone`` (a mask, or rows and columns)
    and those not below the row's ``limit`` do not count. A matrix product
    gives every distance to within ``slip``, tile by tile against the k-th so
    far; what it leaves in doubt is summed in feature order, so that d2 is the
    SQL's to the bit. None where values are too large for it."""
    nf, xx, yy = x.shape[1], np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", y, y)
    slip = 16.0 * (nf + 4) * np.finfo(np.float64).eps * (xx.max(initial=0.0) + yy.max(initial=0.0))
    if not np.isfinite(slip):
        return None
    gone = np.nonzero(gone) if isinstance(gone, np.ndarray) else gone
    k, double = min(k, len(y)), -2.0 * x
    top = np.full((len(x), k), np.inf)  # the least distances so far
    most = np.full(len(x), np.finfo(np.float64).max) if limit is None else np.nextafter(limit + slip, -np.inf)
    held: list = []
    for a in range(0, len(y), TILE):
        about = double @ y[a:a + TILE].T
        about += xx[:, None]
        about += yy[a:a + TILE]
        if gone is not None:
            own = np.flatnonzero((gone[1] >= a) & (gone[1] < a + TILE))
            about[gone[0][own], gone[1][own] - a] = np.inf
        if not a and about.shape[1] >= k:  # a start that most of the later tiles lie above
            rest = np.where(about <= most[:, None], about, np.inf)
            top = np.sort(np.partition(rest, k - 1, axis=1)[:, :k], axis=1)
            rows, cols = np.nonzero(about <= np.minimum(most, top[:, -1] + 2 * slip)[:, None])
            held.append((rows, cols, about[rows, cols]))
            continue
        rows, cols = np.nonzero(about <= np.minimum(most, top[:, -1] + 2 * slip)[:, None])
        if not len(rows):
            continue
        new = about[rows, cols]
        held.append((rows, cols + a, new))
        changed = np.unique(rows)
        at = np.concatenate([np.repeat(changed, k), rows])
        value = np.concatenate([top[changed].ravel(), new])
        order = np.lexsort((value, at))
        at, value = at[order], value[order]
        place = np.arange(len(at)) - np.searchsorted(at, at, "left")
        top[at[place < k], place[place < k]] = value[place < k]
    rows, cols, about = (np.concatenate(z) for z in zip(*held)) if held else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    maybe = about <= top[rows, -1] + 2 * slip
    rows, cols = rows[maybe], cols[maybe]
    d = (x[rows, 0] - y[cols, 0]) ** 2
    for f in range(1, nf):
        d = d + (x[rows, f] - y[cols, f]) ** 2
    if limit is not None:
        below = d < limit[rows]
        rows, cols, d = rows[below], cols[below], d[below]
    order = np.lexsort((cols, d, rows))
    rows, cols, d = rows[order], cols[order], d[order]
    first = np.arange(len(rows)) - np.searchsorted(rows, rows, "left") < k
    return rows[first], cols[first], d[first]


def _same(keys: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the pairs of equal keys; ``order`` is sorted."""
    first, last = np.searchsorted(order, keys, "left"), np.searchsorted(order, keys, "right")
    rows = np.repeat(np.arange(len(keys)), last - first)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(last - first) - last, last - first)


def _block_topk(k: int, exclude_self: bool, with_label: bool, nf: int, metric: str = "euclid"):
    out_cols = ["qk", "ck", "d2"] + (["cl"] if with_label else [])

    def fn(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if q.empty or c.empty:
            return pd.DataFrame({n: pd.Series(dtype="int64" if n != "d2" else "float64") for n in out_cols})
        c = c.sort_values("ck", kind="stable")
        ckeys = c["ck"].to_numpy()
        cmat = c[[f"cv{i}" for i in range(nf)]].to_numpy(dtype=np.float64)
        clab = c["cl"].to_numpy() if with_label else None
        qkeys = q["qk"].to_numpy()
        qmat = q[[f"qv{i}" for i in range(nf)]].to_numpy(dtype=np.float64)
        kk = min(k, len(ckeys))
        parts = []
        for s in range(0, len(qkeys), CHUNK):
            qs = qmat[s:s + CHUNK]
            if metric != "max" and nf > BOX_WIDTH:
                near = nearest(qs, cmat, kk, _same(qkeys[s:s + CHUNK], ckeys) if exclude_self else None)
                if near is not None:
                    part = {"qk": qkeys[s:s + CHUNK][near[0]], "ck": ckeys[near[1]], "d2": near[2]}
                    if with_label:
                        part["cl"] = clab[near[1]]
                    parts.append(pd.DataFrame(part))
                    continue
            # sum of squared differences in feature order (bit-identical to SQL)
            d2 = (qs[:, 0:1] - cmat[:, 0][None, :]) ** 2
            for f in range(1, qs.shape[1]):
                d2 = d2 + (qs[:, f:f + 1] - cmat[:, f][None, :]) ** 2
            if metric == "max":
                d2 = np.max([np.abs(qs[:, f:f + 1] - cmat[:, f][None, :]) for f in range(qs.shape[1])], axis=0)
            if exclude_self:
                d2[qkeys[s:s + CHUNK][:, None] == ckeys[None, :]] = np.inf
            # top-k per row without a full sort: everything below the k-th
            # smallest distance, then equal distances in candidate-key order
            # (candidates are sorted by key) until k are taken
            t = np.partition(d2, kk - 1, axis=1)[:, kk - 1:kk]
            lt = d2 < t
            eq = d2 == t
            need = kk - lt.sum(axis=1, keepdims=True)
            sel = lt | (eq & (np.cumsum(eq, axis=1) <= need))
            rows, cols = np.nonzero(sel)
            dd = d2[rows, cols]
            ok = np.isfinite(dd)
            part = {"qk": qkeys[s:s + CHUNK][rows][ok], "ck": ckeys[cols][ok], "d2": dd[ok]}
            if with_label:
                part["cl"] = clab[cols][ok]
            parts.append(pd.DataFrame(part))
        return pd.concat(parts, ignore_index=True)[out_cols]

    return fn


CELL_ROWS, FAN, LEVELS = 1024, 64, 3
WIDE_CELL_ROWS = 4096  # where distances are a matrix product: a query costs more to send than to compare
MOST_CLASSES = 10_000
SLACK = 1e-9  # relative, for rounding in bounds
ROUNDING = 1e-12  # relative to the squares that a plane's bound is the difference of
BOX_WIDTH = 8  # features up to which a cell's box says more than its ball


class Tree:
    """Pivots as arrays, a node per cell: pivot, radius, box, first child,
    number of children. Nodes 0 .. classes - 1 are the classes' roots and have
    no pivot. Leaves are the cells that rows lie in."""

    def __init__(self, classes: int, width: int, metric: str = "euclid"):
        self.metric = metric
        self.boxed = width <= BOX_WIDTH
        self.pivot = np.zeros((classes, width))
        self.first, self.children, self.parent = np.zeros(classes, np.int64), np.zeros(classes, np.int64), np.full(classes, -1, np.int64)
        self.radius, self.rows = np.full(classes, np.inf), np.zeros(classes, np.int64)
        self.low, self.high = self._no_box(classes), -self._no_box(classes)

    def _no_box(self, more: int) -> np.ndarray:
        return np.full((more if self.boxed else 0, self.pivot.shape[1]), -np.inf)

    def grow(self, pivots: dict) -> None:
        """``pivots``: {leaf: its children's pivots}."""
        for leaf in sorted(pivots):
            self.first[leaf], self.children[leaf] = len(self.pivot), len(pivots[leaf])
            self.pivot = np.concatenate([self.pivot, pivots[leaf]])
            more = len(pivots[leaf])
            self.first, self.children = np.append(self.first, np.zeros(more, np.int64)), np.append(self.children, np.zeros(more, np.int64))
            self.parent, self.rows = np.append(self.parent, np.full(more, leaf)), np.append(self.rows, np.zeros(more, np.int64))
            self.radius = np.append(self.radius, np.full(more, -np.inf))  # until its rows are known
            self.low, self.high = np.concatenate([self.low, self._no_box(more)]), np.concatenate([self.high, -self._no_box(more)])

    def _norm(self, parts) -> np.ndarray:
        """Length of differences given feature by feature."""
        total = None
        for part in parts:
            part = np.abs(part) if self.metric == "max" else part * part
            total = part if total is None else np.maximum(total, part) if self.metric == "max" else total + part
        return total if self.metric == "max" else np.sqrt(total)

    def _distances(self, x: np.ndarray, node: int) -> np.ndarray:
        a = self.first[node]
        pivots = self.pivot[a:a + self.children[node]]
        return self._norm(x[:, f:f + 1] - pivots[:, f] for f in range(x.shape[1]))

    def _bounds(self, x: np.ndarray, node: int) -> np.ndarray:
        """Distances that rows have at least to any row of the node's children:
        by the ball and, with few features, the box around its rows, and by
        the plane that parts it from the child whose pivot is nearest."""
        a = self.first[node]
        b = a + self.children[node]
        d, radius = self._distances(x, node), self.radius[a:b]
        low = np.maximum(d - radius, 0.0)
        if self.boxed:
            low = np.maximum(low, self._norm(np.maximum(np.maximum(self.low[a:b, f] - x[:, f:f + 1], x[:, f:f + 1] - self.high[a:b, f]), 0.0) for f in range(x.shape[1])))
        near = d.argmin(axis=1)
        least = d[np.arange(len(x)), near][:, None]
        if self.metric == "max":
            return np.maximum(low, (d - least) / 2 - ROUNDING * (d + least + radius))
        pivots = self.pivot[a:b]
        apart = self._norm(pivots[:, f:f + 1] - pivots[:, f] for f in range(x.shape[1]))[near]
        over = d * d - least * least - ROUNDING * (d * d + least * least + 2 * radius * radius)
        return np.maximum(low, np.divide(over, 2 * apart, out=np.zeros_like(over), where=apart > 0))

    def descend(self, x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(leaf, distance to its pivot) of rows that are in node ``at``."""
        leaf, dist = at.copy(), np.zeros(len(x))
        while True:
            inner = np.flatnonzero(self.children[leaf] > 0)
            if not len(inner):
                return leaf, dist
            for rows in _alike(leaf, inner):
                node = leaf[rows[0]]
                d = self._distances(x[rows], node)
                best = d.argmin(axis=1)
                leaf[rows], dist[rows] = self.first[node] + best, d[np.arange(len(rows)), best]

    def enough(self, x: np.ndarray, leaf: np.ndarray, need: int) -> np.ndarray:
        """A distance within which each row has ``need`` candidates of its
        class: the balls next to its own cell, or further up, hold as many."""
        out, at = np.full(len(x), np.inf), self.parent[leaf]
        while (at >= 0).any():
            for rows in _alike(at, np.flatnonzero(at >= 0)):
                node = at[rows[0]]
                a = self.first[node]
                b = a + self.children[node]
                far = self._distances(x[rows], node) + np.maximum(self.radius[a:b], 0.0)
                order = np.argsort(far, axis=1, kind="stable")
                held = np.cumsum(self.rows[a:b][order], axis=1)
                full = held[:, -1] >= need
                last = (held >= need).argmax(axis=1)
                best = np.take_along_axis(far, order, axis=1)[np.arange(len(rows)), last]
                out[rows[full]] = best[full] * (1 + SLACK)
                at[rows] = np.where(full, -1, self.parent[node])
        return out

    def reach(self, x: np.ndarray, root: np.ndarray, bound: np.ndarray):
        """Yields (rows, leaf): rows that may have a candidate within their
        bound in that leaf."""
        stack = [(rows, root[rows[0]]) for rows in _alike(root, np.arange(len(root)))]
        while stack:
            rows, node = stack.pop()
            if not self.children[node]:
                yield rows, node
                continue
            may = ~(self._bounds(x[rows], node) * (1 - SLACK) > bound[rows][:, None])
            for j in np.flatnonzero(may.any(axis=0)):
                stack.append((rows[may[:, j]], self.first[node] + j))


def _alike(values: np.ndarray, rows: np.ndarray) -> list:
    """``rows`` in groups of equal value."""
    if not len(rows):
        return []
    rows = rows[np.argsort(values[rows], kind="stable")]
    return np.split(rows, np.flatnonzero(np.diff(values[rows])) + 1)


def _cells(df: DataFrame, prefix: str, nf: int, tree: Tree) -> DataFrame:
    """Rows with their class (g) and cell moved down to the tree's leaves."""
    sent = df.sparkSession.sparkContext.broadcast(tree)  # at most FAN ** LEVELS pivots and the classes
    keep = [f for f in df.schema.simpleString()[7:-1].replace(":", " ").split(",") if f.split(" ")[0] not in ("cell", "dist")]

    def fn(batches):
        tree = sent.value
        for pdf in batches:
            m = pdf[[f"{prefix}v{i}" for i in range(nf)]].to_numpy(dtype=np.float64)
            at = (pdf["cell"] if "cell" in pdf else pdf["g"]).to_numpy(np.int64)
            leaf, dist = tree.descend(m, at)
            pdf["dist"] = np.where(leaf == at, pdf["dist"], dist) if "dist" in pdf else dist
            pdf["cell"] = leaf
            yield pdf

    return df.mapInPandas(fn, ", ".join([*keep, "cell long", "dist double"]))


def _reached(q: DataFrame, nf: int, tree: Tree, need: int) -> DataFrame:
    """(qk, vectors, to): queries (with bound) and the other cells to meet. A
    query whose own cell had too few rows gets its bound from the balls around.
    Queries of one cell come together, so that they go down the tree together."""
    sent = q.sparkSession.sparkContext.broadcast(tree)
    cols = [f"qv{i}" for i in range(nf)]

    def fn(batches):
        tree = sent.value
        for whole in batches:
            for a in range(0, len(whole), REACH_CHUNK):
                pdf = whole.iloc[a:a + REACH_CHUNK]
                keys, m = pdf["qk"].to_numpy(np.int64), pdf[cols].to_numpy(dtype=np.float64)
                own, bound = pdf["cell"].to_numpy(np.int64), pdf["bound"].to_numpy(np.float64).copy()
                short = np.flatnonzero(np.isinf(bound))
                bound[short] = tree.enough(m[short], own[short], need)
                held, n = [], 0
                for rows, leaf in tree.reach(m, pdf["g"].to_numpy(np.int64), bound):
                    rows = rows[own[rows] != leaf]
                    if len(rows):
                        held.append((rows, leaf))
                        n += len(rows)
                    if n >= REACH_ROWS:
                        yield _sent_to(keys, m, cols, held)
                        held, n = [], 0
                if held:
                    yield _sent_to(keys, m, cols, held)

    return q.mapInPandas(fn, "qk long, " + ", ".join(f"{c} double" for c in cols) + ", to long")


def _sent_to(keys: np.ndarray, m: np.ndarray, cols: list, held: list) -> pd.DataFrame:
    rows = np.concatenate([r for r, _ in held])
    return pd.DataFrame({"qk": keys[rows], **{c: m[rows, i] for i, c in enumerate(cols)}, "to": np.repeat([leaf for _, leaf in held], [len(r) for r, _ in held])})


def _draw_pivots(c: DataFrame, nf: int, counts: dict, wide: list, cell_rows: int, turn: int) -> dict:
    """Pivots of the wide cells: the rows of the least hashes, about one per
    ``CELL_ROWS / 2`` rows and at most ``FAN``."""
    want = {w: min(FAN, -(-2 * counts[w] // cell_rows)) for w in wide}
    share = F.create_map(*[F.lit(v) for w in wide for v in (w, min(1.0, 4.0 * want[w] / counts[w] + 16.0 / counts[w]))])
    draw = F.pmod(F.xxhash64("ck", F.lit(turn)), F.lit(1 << 30)) / float(1 << 30)
    rows = (c.select("cell", draw.alias("u"), "ck", *[f"cv{i}" for i in range(nf)]).where(F.col("u") < F.coalesce(F.try_element_at(share, F.col("cell")), F.lit(0.0)))
            .collect())  # a few times the pivots of at most FAN ** (LEVELS - 1) cells
    out: dict = {}
    for r in sorted(rows, key=lambda r: (r["u"], r["ck"])):
        mine = out.setdefault(r["cell"], [])
        if len(mine) < want[r["cell"]]:
            mine.append([r[f"cv{i}"] for i in range(nf)])
    out = {w: np.unique(np.array(v, dtype=np.float64), axis=0) for w, v in out.items()}
    return {w: v for w, v in out.items() if len(v) > 1}  # equal rows cannot be parted


def _plant(c: DataFrame, nf: int, classes: int, cell_rows: int | None = None, turn: int = 0, metric: str = "euclid") -> tuple[Tree, DataFrame, dict]:
    """(tree, candidates in their leaves, rows per leaf)."""
    tree, cell_rows = Tree(classes, nf, metric), cell_rows or (CELL_ROWS if nf <= BOX_WIDTH or metric == "max" else max(CELL_ROWS, WIDE_CELL_ROWS))
    c = c.withColumn("cell", F.col("g"))
    counts = {r["cell"]: r["n"] for r in c.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    wide = [w for w, n in counts.items() if n > cell_rows]
    for _ in range(LEVELS):
        pivots = _draw_pivots(c, nf, counts, sorted(wide), cell_rows, turn) if wide else {}
        if not pivots:
            break
        tree.grow(pivots)
        c = stored(_cells(c, "c", nf, tree), "knn-cells")
        sides = [of(f"cv{i}").alias(f"{name}{i}") for i in range(nf) for of, name in ((F.min, "low"), (F.max, "high"))] if tree.boxed else []
        rows = c.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("r"), *sides).collect()
        counts = {r["cell"]: r["n"] for r in rows}
        for r in rows:
            tree.rows[r["cell"]] = r["n"]
            if r["cell"] >= classes:
                tree.radius[r["cell"]] = r["r"]
            if tree.boxed:
                tree.low[r["cell"]], tree.high[r["cell"]] = [r[f"low{i}"] for i in range(nf)], [r[f"high{i}"] for i in range(nf)]
        wide = [w for w, n in counts.items() if n > cell_rows and w >= classes]
    return tree, c, counts


def _parts_of(parts: dict, cell: str):
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in parts.items() for x in kv]), F.col(cell)), F.lit(1)) if parts else F.lit(1)


def _meet(q: DataFrame, c: DataFrame, parts: dict, fn, schema: str) -> DataFrame:
    """Queries (with ``to``, a cell) against the candidates of that cell; a
    cell cut in parts is met part by part, and its queries in as many lots."""
    n_parts = _parts_of(parts, "to")
    qx = q.withColumn("part", F.explode(F.sequence(F.lit(0), n_parts - 1)))
    cx = c.withColumnRenamed("cell", "to").withColumn("part", F.pmod(F.xxhash64("ck"), n_parts).cast("int"))
    return qx.groupBy("to", "part").cogroup(cx.groupBy("to", "part")).applyInPandas(fn, schema)


def _class_index(df: DataFrame, within: str | None):
    """(number of classes, index column): a class column has few values."""
    if within is None:
        return 1, F.lit(0).cast("long")
    values = df.select(F.col(within).alias("c")).where("c is not null").distinct().limit(MOST_CLASSES + 1).collect()
    if len(values) > MOST_CLASSES:
        raise ValueError(f"{within} has more than {MOST_CLASSES} values: it is no class")
    order = sorted(r["c"] for r in values)
    index = F.create_map(*[F.lit(x) for i, v in enumerate(order) for x in (v, i)]) if order else None
    return len(order), (F.try_element_at(index, F.col(within)).cast("long") if order else F.lit(None).cast("long"))


def knn_join(queries: DataFrame, candidates: DataFrame, features: Sequence[str], k: int,
             key: str, cand_key: str | None = None, exclude_self: bool = True,
             cand_label: str | None = None, method: str = "exact", block_rows: int = BLOCK_ROWS, within: str | None = None, metric: str = "euclid") -> DataFrame:
    """Top-k neighbours: columns q_key, c_key, dist, rank (1..k) [, c_label].
    ``metric`` is ``euclid`` or ``max`` (largest difference of a feature; exact
    method only, ``d2`` is the distance then).
    With ``within`` only candidates of the query's own class count; a row
    without a class has no neighbours."""
    cand_key = cand_key or key
    if metric not in ("euclid", "max") or metric == "max" and method != "exact":
        raise ValueError(f"no {method} neighbours by {metric!r}")
    if method == "approx":
        from tabprep.operators.knn_graph import knn_graph
        return knn_graph(queries, candidates, features, k, key, cand_key, exclude_self, cand_label, within)
    if method == "lsh":
        return knn_lsh(queries, candidates, features, k, key, cand_key, exclude_self, cand_label, within=within)
    nf, with_label = len(features), cand_label is not None
    classes, index = _class_index(candidates, within)
    one = queries is candidates and key == cand_key
    base = stored(_prep(candidates, cand_key, features, cand_label, "c", index).where("g is not null"), "knn-candidates")
    schema = "qk long, ck long, d2 double" + (", cl long" if with_label else "")
    tree, c, counts = _plant(base, nf, classes, metric=metric)
    if not counts:
        return candidates.sparkSession.createDataFrame([], "q_key long, c_key long, dist double, d2 double, rank int" + (", c_label long" if with_label else ""))
    parts = {j: -(-n // block_rows) for j, n in counts.items() if n > block_rows}
    cols = [f"qv{i}" for i in range(nf)]
    if one:  # the candidates are the queries, in their cells already
        q = c.select(F.col("ck").alias("qk"), *[F.col(f"cv{i}").alias(f"qv{i}") for i in range(nf)], "g", "cell")
    else:
        q = stored(_cells(_prep(queries, key, features, None, "q", index).where("g is not null"), "q", nf, tree), "knn-queries").select("qk", *cols, "g", "cell")
    cc = c.select("ck", *[f"cv{i}" for i in range(nf)], *(["cl"] if with_label else []), "cell")
    topk = _block_topk(k, exclude_self, with_label, nf, metric)
    distance = F.col("d2") if metric == "max" else F.sqrt("d2")
    # round 1: the own cell; its k-th distance bounds the others
    best = Window.partitionBy("qk").orderBy("d2", "ck")
    near = _meet(q.select("qk", *cols, F.col("cell").alias("to")), cc, parts, topk, schema)
    if len(counts) == 1 and not parts:
        pairs = near  # all candidates are in one cell
    else:
        near = stored(near, "knn-near")
        bound = near.withColumn("r", F.row_number().over(best)).where(F.col("r") == k).select("qk", distance.alias("bound"))
        far = q.join(bound, "qk", "left").withColumn("bound", F.coalesce(F.col("bound") * (1 + SLACK), F.lit(float("inf"))))
        far = far.repartition("cell", F.pmod(F.xxhash64("qk"), _parts_of(parts, "cell"))).sortWithinPartitions("cell")
        pairs = near.unionByName(_meet(_reached(far, nf, tree, k + exclude_self), cc, parts, topk, schema))
    top = pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    out = [F.col("qk").alias("q_key"), F.col("ck").alias("c_key"), distance.alias("dist"), F.col("d2"), F.col("rank")]
    if with_label:
        out.append(F.col("cl").alias("c_label"))
    return top.select(*out)


def knn_lsh(queries: DataFrame, candidates: DataFrame, features: Sequence[str], k: int,
            key: str, cand_key: str, exclude_self: bool = True, cand_label: str | None = None,
            bucket_length: float | None = None, num_tables: int = 5, threshold: float | None = None,
            sample_rows: int = 1000, seed: int = 42, within: str | None = None) -> DataFrame:
    """Approximate top-k via random-projection LSH (Spark ML).

    The join radius comes from data: the exact blocked join runs for a hash
    sample of at most ``sample_rows`` queries (the sample is the feature), and
    the 0.9 quantile of their k-th neighbour distance is the first radius
    (bucket length likewise). Queries that find fewer than k neighbours within
    it are finished by the exact join, so every query gets k where there are k."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH, VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from tabprep.operators.project import hash_sample
    if threshold is None or bucket_length is None:
        probe = hash_sample(queries.select(key, *features, *([within] if within else [])), sample_rows, key, seed)
        kth = (knn_join(probe, candidates, features, k, key, cand_key, exclude_self, within=within)
               .where(F.col("rank") == k).agg(F.percentile_approx("dist", 0.9, 10000)).first()[0])
        kth = float(kth) if kth else 1.0
        threshold = threshold if threshold is not None else kth
        bucket_length = bucket_length if bucket_length is not None else max(kth, 1e-9)
    nf, label = len(features), ["cl"] if cand_label else []
    classes, index = _class_index(candidates, within)

    def rows(df: DataFrame, by: str, label: str | None, p: str) -> DataFrame:
        out = _prep(df, by, features, label, p, index).where("g is not null").distinct()
        return stored(out.where(f"{p}k is not null") if exclude_self else out, "lsh-rows")

    vectors = lambda df, p: VectorAssembler(inputCols=[f"{p}v{i}" for i in range(nf)], outputCol="_vec").transform(df)
    c, q = rows(candidates, cand_key, cand_label, "c"), rows(queries, key, None, "q")
    lsh = BucketedRandomProjectionLSH(inputCol="_vec", outputCol="_h", bucketLength=bucket_length,
                                      numHashTables=num_tables, seed=seed).fit(vectors(c, "c"))

    def bucketed(df: DataFrame, p: str, *more: str) -> DataFrame:
        """A row per hash table, in its bucket there."""
        out = lsh.transform(vectors(df, p)).select("*", F.posexplode("_h").alias("_t", "_b"))
        return out.select(f"{p}k", *[f"{p}v{i}" for i in range(nf)], *more, F.concat_ws(":", "g", "_t", vector_to_array("_b")[0].cast("string")).alias("cell"))

    def split(df: DataFrame, rows: int) -> dict:
        """{cell of more rows: its parts}"""
        return {r["cell"]: -(-r["n"] // rows) for r in df.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows).collect()}

    # each bucket's queries, in lots, meet its candidates, in parts; a pair of several buckets is found in each and counts once
    asked, held = bucketed(q, "q"), bucketed(c, "c", *label)
    lots, parts = split(asked, LOT_ROWS), split(held, BLOCK_ROWS)
    lot = lambda df, at: df.withColumn("cell", F.concat_ws("/", "cell", at))
    asked = lot(asked, F.pmod(F.xxhash64("qk"), _parts_of(lots, "cell")).cast("string"))
    held = lot(held.withColumn("lot", F.explode(F.sequence(F.lit(0), _parts_of(lots, "cell") - 1))), F.col("lot").cast("string")).drop("lot")
    parts = {f"{j}/{i}": n for j, n in parts.items() for i in range(lots.get(j, 1))}
    met = _meet(asked.withColumnRenamed("cell", "to"), held, parts, _block_topk(k, exclude_self, bool(label), nf), "qk long, ck long, d2 double" + (", cl long" if label else ""))
    pairs = met.select(F.col("qk").alias("q_key"), F.col("ck").alias("c_key"), F.sqrt("d2").alias("dist"), *([F.col("cl").alias("c_label")] if cand_label else [])).where(F.col("dist") < threshold).distinct()
    w = Window.partitionBy("q_key").orderBy("dist", "c_key")
    found = stored(pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k), "lsh-found")
    full = found.where(F.col("rank") == k).select("q_key")
    short = queries.join(full, queries[key] == full["q_key"], "left_anti")
    rest = knn_join(short, candidates, features, k, key, cand_key, exclude_self, cand_label, within=within)
    return (found.join(full, "q_key", "left_semi").withColumn("d2", F.col("dist") * F.col("dist"))
            .unionByName(rest.select("q_key", "c_key", "dist", "rank", "d2", *(["c_label"] if cand_label else []))))
