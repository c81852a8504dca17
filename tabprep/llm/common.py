"""Shared helpers: the word definition, shared-folder tables, byte-level words.

``words_of`` finds the words of many texts at once in numpy: whitespace is the
set of ASCII bytes 0x20 and 0x09-0x0D, so a UTF-8 text never needs decoding.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.session import checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back, so a
    lost executor costs no recomputation and later branches reread it."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes tables written by ``stored``. Call it once everything that
    reads them is itself stored: a lost executor then recomputes nothing."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.stored_path)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int):
    """Within, jobs hand Python at most ``rows`` rows at a time: for tables
    whose rows are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def apart(docs: DataFrame, own: tuple, work, replaced: tuple = ()) -> DataFrame:
    """``work(docs)`` with the caller's columns other than ``own`` under names
    that no operator uses, and back under their own afterwards; those in
    ``replaced`` give way to new ones of the same name."""
    kept = [c for c in docs.columns if c in own or c not in replaced]
    hidden = {c: f"col{i}__" for i, c in enumerate(kept) if c not in own}
    out = work(docs.select(*[F.col(f"`{c}`").alias(hidden.get(c, c)) for c in kept]))
    back = {v: c for c, v in hidden.items()}
    return out.select(*[F.col(f"`{c}`").alias(back.get(c, c)) for c in out.columns])


def words(text: Column) -> Column:
    """Array of words of a text (null: no words)."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


BITMAP_BITS = 1 << 29


def spot(c: Column, bits: int) -> Column:
    """A value's place in a bitmap of ``bits``."""
    return F.pmod(F.xxhash64(c), F.lit(bits))


def bitmap(df: DataFrame, col: str) -> tuple[int, np.ndarray]:
    """(bits, bytes) of a hashed bitmap of ``col``'s values: a filter without
    false negatives, 16 bits a row and at most ``BITMAP_BITS`` (64 MB)
    whatever the input, so it may be broadcast. Where it is too small it lets
    more rows through; whoever uses it must decide exactly afterwards."""
    n, bits = df.count(), 1 << 15
    while bits < 16 * n and bits < BITMAP_BITS:
        bits *= 2
    at = df.select((spot(F.col(col), bits) + 1).alias("x"))
    rows = at.groupBy(F.expr("bitmap_bucket_number(x)").alias("k")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(x))").alias("b")).collect()
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        first = (r["k"] - 1) * 4096
        out[first:first + len(r["b"])] = np.frombuffer(r["b"], np.uint8)
    return bits, out


def in_bitmap(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_IS_WORD = np.ones(256, bool)
_IS_WORD[[32, 9, 10, 11, 12, 13]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Words:
    """Words of a run of texts: ``start``/``end`` byte offsets into ``data``,
    ``hash`` (64 bits) and ``bounds`` (first word of each text, one more)."""

    __slots__ = ("bounds", "data", "end", "hash", "start")

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, hashes: bool = True):
        if lower:
            data = _LOWER[data]
        n = len(data)
        word = _IS_WORD[data]
        begins = np.zeros(n + 1, bool)
        if n:
            begins[0] = word[0]
            begins[1:n] = word[1:] & ~word[:-1]
            at = offsets[:-1][offsets[:-1] < n]
            begins[at] = word[at]
            ends = np.zeros(n + 1, bool)
            ends[1:n] = word[:-1] & ~word[1:]
            ends[n] = word[n - 1]
            inner = offsets[1:][offsets[1:] > 0]
            ends[inner] = word[inner - 1]
            self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends)
        else:
            self.start = self.end = np.zeros(0, np.int64)
        self.data = data
        self.bounds = np.searchsorted(self.start, offsets)
        self.hash = self._hashes() if hashes else None

    def _hashes(self) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, np.uint64)
        size = self.end - self.start
        first = np.cumsum(size) - size
        total = int(first[-1] + size[-1])
        place = np.arange(total) - np.repeat(first, size)
        chars = self.data[place + np.repeat(self.start, size)]
        odd = (place.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        return mix64(np.add.reduceat(mix64(_BYTE[chars] * odd), first) + size.astype(np.uint64))


def text_runs(texts, most_bytes: int = 1 << 20):
    """Yields (first row, ``data``, ``offsets``) for runs of a pyarrow string
    array of about ``most_bytes`` each (nulls count as empty; one text is
    never split)."""
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most_bytes, "right")) - 1)
        yield row, data[offsets[row]:offsets[to]], offsets[row:to + 1] - offsets[row]
        row = to


def shingle_hashes(hashes: np.ndarray, bounds: np.ndarray, width: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``width``-word shingles; a
    shorter text is one shingle of all its words, an empty one has none."""
    out = []
    runs = None
    if len(hashes) >= width:
        n = len(hashes) - width + 1
        runs = np.zeros(n, np.uint64)
        for k in range(width):
            runs = mix64(runs * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + n])
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= width:
            out.append(np.unique(runs[a:b - width + 1]))
        elif b > a:
            one = np.zeros(1, np.uint64)
            for k in range(a, b):
                one = mix64(one * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + 1])
            out.append(mix64(one + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
