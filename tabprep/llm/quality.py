"""Quality rules: fixed base rules, then a calibrated n-gram classifier.

Features of a text are the shares of its hashed words, word pairs and byte
four-grams (three blocks of 2**16). A logistic regression is fitted on labelled
rows, its scores are calibrated by a two-parameter logistic fit on rows that
it did not see, and a text is kept at a probability of ``KEEP`` or more.

The fit takes at most ``PER_CLASS`` labelled rows of either class, the first
in the order of a hash of their doc_id; everything else reads every row.
Scoring needs no shuffle: Arrow batches meet a broadcast of the weights,
whose size is fixed.

Contracts: a null or empty text has no words, so it fails the base rules;
null labels and labels without a document are left out; without labels of
both classes the base rules alone decide; repeated rows are judged each; all
other columns pass untouched, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import Words, mix64, text_runs

PER_CLASS = 1000
KEEP = 0.5
BITS = 16
DIM = 3 << BITS
SCALE = 30.0
LEAST_WORDS = 50
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CHAR = np.ones(256, bool)
_CHAR[[32, 9, 10, 11, 12, 13]] = False
_CHAR[0x80:0xC0] = False  # continuation bytes


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def base_stats(data: np.ndarray, offsets: np.ndarray, w: Words) -> dict[str, np.ndarray]:
    """The five counts of each text of a run."""
    n = np.diff(w.bounds)
    h, words = w.hash, len(w.hash)
    covered = np.zeros(words + 2, bool)
    if words >= 3:
        text = np.repeat(np.arange(len(n)), n)
        at = np.flatnonzero(text[:-2] == text[2:])
        key = mix64(mix64(mix64(h[at] + text[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) + h[at + 1]) + h[at + 2])
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        at = at[twice]
        for k in range(3):
            covered[at + k] = True
    raw, dup = data.tobytes(), []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        lines = raw[a:b].split(b"\n")
        if len(set(lines)) == len(lines):
            dup.append(0)
            continue
        seen, k = set(), 0
        for line in lines:
            if line in seen:
                k += bool(line.strip())
            else:
                seen.add(line)
        dup.append(k)
    return {"n_words": n, "word_chars": _sums(_CHAR[data], offsets), "n_symbols": _sums(_SYMBOL[data], offsets),
            "n_dup_lines": np.array(dup, np.int64), "n_repeat_words": _sums(covered[:words], w.bounds)}


def blocks(data: np.ndarray, offsets: np.ndarray, w: Words) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(feature index, first, last) for words, word pairs and four-grams; the
    features of text i are index[first[i]:last[i]]."""
    shift = np.uint64(64 - BITS)
    b0, b1 = w.bounds[:-1], w.bounds[1:]
    one = (w.hash >> shift).astype(np.int32)
    two = (mix64(w.hash[:-1] * np.uint64(0x9E3779B97F4A7C15) + w.hash[1:]) >> shift).astype(np.int32) + (1 << BITS)
    d = data.astype(np.uint32)
    if len(d) >= 4:
        g = d[:-3] * np.uint32(0x9E3779B1) + d[1:-2] * np.uint32(0x85EBCA77) + d[2:-1] * np.uint32(0xC2B2AE3D) + d[3:] * np.uint32(0x27D4EB2F)
        g ^= g >> np.uint32(15)
        g *= np.uint32(0x2C1B3C6D)
        four = (g >> np.uint32(32 - BITS)).astype(np.int32) + (2 << BITS)
    else:
        four = np.zeros(0, np.int32)
    return [(one, b0, b1), (two, b0, np.maximum(b0, b1 - 1)), (four, offsets[:-1], np.maximum(offsets[:-1], offsets[1:] - 3))]


@dataclass
class Model:
    weights: np.ndarray  # float32, DIM
    bias: float
    slope: float  # calibration: p = 1 / (1 + exp(-(slope * score + shift)))
    shift: float

    def probability(self, data: np.ndarray, offsets: np.ndarray, w: Words) -> np.ndarray:
        score = np.full(len(offsets) - 1, self.bias)
        for index, a, b in blocks(data, offsets, w):
            total = np.concatenate([np.zeros(1), np.cumsum(self.weights[index], dtype=np.float64)])
            score += SCALE * (total[np.minimum(b, len(index))] - total[np.minimum(a, len(index))]) / np.maximum(b - a, 1)
        return 1 / (1 + np.exp(-np.clip(self.slope * score + self.shift, -60, 60)))


def labelled(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS):
    """Sparse features of the labelled sample, by doc_id: rows of doc_id,
    quality and, as bytes, index (int32) and value (float32)."""
    keep = labels.filter("quality is not null and doc_id is not null").select("doc_id", "quality")
    order = F.xxhash64("doc_id", F.lit(11))
    some = [keep.filter(f"quality {op} 0").groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(order, "doc_id").limit(per_class) for op in ("=", "<>")]
    # at most 2 * per_class ids
    chosen = F.broadcast(some[0].union(some[1]).withColumnRenamed("doc_id", "_id"))
    rows = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("_id")).select("doc_id", (F.col("quality") != 0).cast("int").alias("quality"), "text")

    def features(batches):
        import pyarrow as pa

        for batch in batches:
            for row, data, offsets in text_runs(batch.column(2)):
                w = Words(data, offsets)
                parts = blocks(data, offsets, w)
                index, value = [], []
                for i in range(len(offsets) - 1):
                    got = [np.unique(x[a[i]:b[i]], return_counts=True) + (max(1, b[i] - a[i]),) for x, a, b in parts]
                    index.append(np.concatenate([u for u, _, _ in got]).astype(np.int32))
                    value.append(np.concatenate([c / n for _, c, n in got]).astype(np.float32))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(index)), batch.column(1).slice(row, len(index)), pa.array([x.tobytes() for x in index], pa.binary()),
                                                  pa.array([x.tobytes() for x in value], pa.binary())], ["doc_id", "quality", "index", "value"])

    got = rows.mapInArrow(features, "doc_id long, quality int, index binary, value binary").collect()
    return sorted({r["doc_id"]: r for r in sorted(got, key=lambda r: (r["quality"], len(r["index"]), r["index"]))}.values(), key=lambda r: r["doc_id"])


def train(rows, rounds: int = 80, l2: float = 1e-5) -> Model | None:
    """Logistic regression by full-batch Adam on four fifths of the rows,
    calibrated on the rest. None unless both parts have both classes."""
    y = np.array([r["quality"] for r in rows], np.float64)
    held = np.arange(len(rows)) % 5 == 4
    if len(rows) < 10 or len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        return None

    def matrix(mask):
        some = [r for r, m in zip(rows, mask, strict=True) if m]
        sizes = np.array([len(r["index"]) // 4 for r in some])
        index = np.frombuffer(b"".join([r["index"] for r in some]), np.int32)
        return index, SCALE * np.frombuffer(b"".join([r["value"] for r in some]), np.float32), np.repeat(np.arange(len(some), dtype=np.int32), sizes), len(some)

    index, value, row, n = matrix(~held)
    target = y[~held]
    balance = np.where(target > 0, 0.5 / max(1, (target > 0).sum()), 0.5 / max(1, (target == 0).sum()))
    w, b = np.zeros(DIM), 0.0
    m, v = np.zeros(DIM + 1), np.zeros(DIM + 1)
    for t in range(1, rounds + 1):
        score = np.bincount(row, value * w[index], n) + b
        r = balance * (1 / (1 + np.exp(-np.clip(score, -60, 60))) - target)
        g = np.append(np.bincount(index, value * r[row], DIM) + l2 * w, r.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    index, value, row, n = matrix(held)
    score, target = np.bincount(row, value * w[index], n) + b, y[held]
    # smoothed targets keep the calibration finite on separable rows
    pos, neg = (target > 0).sum(), (target == 0).sum()
    goal = np.where(target > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    weight = np.where(target > 0, 0.5 / pos, 0.5 / neg)
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * score + shift, -60, 60)))
        r, q = weight * (p - goal), weight * np.maximum(p * (1 - p), 1e-9)
        hess = np.array([[(q * score * score).sum() + 1e-9, (q * score).sum()], [(q * score).sum(), q.sum() + 1e-9]])
        step = np.linalg.solve(hess, np.array([(r * score).sum(), r.sum()]))
        scale = min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
        slope, shift = slope - scale * step[0], shift - scale * step[1]
    return Model(w.astype(np.float32), float(b), float(max(slope, 1e-3)), float(shift))


def judge(docs: DataFrame, model: Model | None, keep: float = KEEP, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with the five counts, base_failed, p_quality and kept (columns
    of those names in ``docs`` are replaced)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "p_quality", "kept"]
    kinds = ["long"] * 5 + ["boolean", "double", "boolean"]
    base = docs.select(*[c for c in docs.columns if c not in new])
    at = base.columns.index("text")

    def score(batches):
        import pyarrow as pa

        model = sent.value
        for batch in batches:
            for row, data, offsets in text_runs(batch.column(at)):
                w = Words(data, offsets)
                s = base_stats(data, offsets, w)
                failed = (s["n_words"] < least_words) | (100 * s["n_repeat_words"] > 50 * s["n_words"])
                p = model.probability(data, offsets, w) if model else np.ones(len(failed))
                part = batch.slice(row, len(failed))
                yield pa.RecordBatch.from_arrays([*part.columns, *[pa.array(s[c], pa.int64()) for c in STATS], pa.array(failed), pa.array(p), pa.array(~failed & (p >= keep))], [*part.schema.names, *new])

    from pyspark.sql import types as T

    schema = T.StructType([*base.schema.fields, *[T.StructField(c, {"long": T.LongType(), "boolean": T.BooleanType(), "double": T.DoubleType()}[k]) for c, k in zip(new, kinds, strict=True)]])
    return base.mapInArrow(score, schema)


def fitted(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model | None:
    return train(labelled(docs, labels, per_class))
