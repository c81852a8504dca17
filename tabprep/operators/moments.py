"""Co-moments and triangular factors of many columns in one pass (A12, A13,
C1, A15).

A table of c columns has c (c - 1) / 2 pairs; an aggregate expression per pair
costs more to compile than to run. Here a task turns its Arrow batches into
one mergeable state, and states meet in a tree:

* co-moments: for every pair (i, j) the rows where both are present, the mean
  of i over those, and the centred sums of i * i and i * j, merged by the
  pairwise update of Chan, Golub & LeVeque (1979). NULL and NaN leave out a
  row for the pairs they touch only, as pairwise-complete correlation asks;
* triangular factors (Demmel et al. 2012): the R of a QR factorisation of a
  task's complete rows; two R's merge by factorising them on top of each
  other, so nearly collinear columns keep the digits that a Gram matrix loses.

A state has a few c x c numbers whatever the rows; a merging task holds two.
"""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS = 1 << 14  # rows of a matrix at a time


def _matrices(batches, width: int):
    """Arrow batches -> float matrices of at most ``ROWS`` rows, NULL as NaN."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield np.column_stack([part.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(width)])


def pair_state(x: np.ndarray) -> np.ndarray:
    """(4, c, c): rows with both, mean of i over them, sum of squares of i and
    sum of products around those means."""
    have = ~np.isnan(x)
    m = have.astype(np.float64)
    centre = np.where(have.any(axis=0), np.nansum(x, axis=0) / np.maximum(m.sum(axis=0), 1), 0.0)
    z = np.where(have, x - centre, 0.0)
    n = m.T @ m
    safe = np.maximum(n, 1)
    mean = (z.T @ m) / safe  # of i over the rows that have j, from the centre
    squares = (z ** 2).T @ m - n * mean ** 2
    products = z.T @ z - n * mean * mean.T
    return np.stack([n, mean + centre[:, None], squares, products])


def merge_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = a[0] + b[0]
    safe = np.maximum(n, 1)
    d = np.where((a[0] > 0) & (b[0] > 0), b[1] - a[1], 0.0)
    share = a[0] * b[0] / safe
    mean = np.where(a[0] == 0, b[1], np.where(b[0] == 0, a[1], a[1] + d * b[0] / safe))
    return np.stack([n, mean, a[2] + b[2] + d ** 2 * share, a[3] + b[3] + d * d.T * share])


def triangle(x: np.ndarray) -> np.ndarray:
    """R of the complete rows of x, c x c."""
    c = x.shape[1]
    r = np.linalg.qr(x[~np.isnan(x).any(axis=1)], mode="r")
    return np.vstack([r, np.zeros((c - len(r), c))]) if len(r) < c else r


def _tree(df: DataFrame, cols: Sequence[str], state, merge, shape: tuple) -> np.ndarray | None:
    """The merged state of all rows (None without rows): one partial state per
    task, then rounds of a fan-in of about 16."""
    cols, width = list(cols), len(cols)
    data = df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)])

    def partial(batches):
        import pyarrow as pa

        out = None
        for x in _matrices(batches, width):
            s = state(x)
            out = s if out is None else merge(out, s)
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array([out.astype("<f8").tobytes()], pa.binary())], ["s"])

    read = lambda raw: np.frombuffer(bytes(raw), "<f8").reshape(shape)
    states = data.mapInArrow(partial, "s binary").rdd.map(lambda r: read(r[0]))
    depth = max(2, math.ceil(math.log(max(2, states.getNumPartitions()), 16)))
    none = np.zeros(0)
    got = states.treeAggregate(none, lambda a, b: b if not a.size else merge(a, b), lambda a, b: b if not a.size else (a if not b.size else merge(a, b)), depth)
    return got if got.size else None


def correlations(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """Pairwise-complete Pearson correlations; NaN where undefined."""
    c = len(cols)
    s = _tree(df, cols, pair_state, merge_pairs, (4, c, c)) if c else None
    if s is None:
        return np.full((c, c), np.nan)
    n, _, squares, products = s
    with np.errstate(invalid="ignore", divide="ignore"):
        # a constant column leaves rounding noise: nothing to correlate
        scale = np.sqrt(squares * squares.T)
        noise = 1e-14 * np.maximum(n * (s[1] * s[1]), 0)
        flat = (squares <= noise) | (squares.T <= noise.T)
        r = np.where((n > 1) & ~flat, products / scale, np.nan)
    return np.clip(r, -1.0, 1.0)


def triangular(df: DataFrame, cols: Sequence[str]) -> np.ndarray | None:
    """R with R'R = X'X over the rows where every column is present."""
    c = len(cols)
    return _tree(df, cols, triangle, lambda a, b: triangle(np.vstack([a, b])), (c, c)) if c else None


def inflation(r: np.ndarray, tolerance: float = 1e-12) -> np.ndarray:
    """(X'X)_jj * (X'X)^-1_jj from R; infinite for a column that the others
    give exactly, NaN for an empty one."""
    c = r.shape[0]
    length = np.sqrt((r ** 2).sum(axis=0))
    unit = r / np.where(length > 0, length, 1.0)  # columns of length one: the ratio does not change
    out = np.full(c, np.nan)
    live = np.flatnonzero(length > 0)
    if not len(live):
        return out
    u, s, vt = np.linalg.svd(unit[:, live], full_matrices=False)
    small = s <= tolerance * s[0]
    inverse = ((vt[~small] / s[~small][:, None]) ** 2).sum(axis=0)
    out[live] = np.where((vt[small] ** 2).sum(axis=0) > 1e-9, np.inf, inverse) if small.any() else inverse
    return out
