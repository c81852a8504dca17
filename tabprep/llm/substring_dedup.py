"""Substring dedup: suffix automata of reference shards, matching statistics.

A window is ``WINDOW`` consecutive words of one document. A word goes if a
window over it has a word sequence that also starts in a document with a
smaller doc_id. Broadcasting automata of all reference text to all documents
costs shards times corpus, so reference and streamed text meet by anchors
instead. A window's anchor is the least of its ``GRAM``-word hashes: equal
windows have equal anchors, and neighbouring windows mostly share one.

1. Anchors that occur in two documents go into a bitmap of bounded size; it
   only thins the input of the next steps, whatever it lets through is
   decided exactly.
2. Maximal runs of windows with one such anchor are spans (at most
   2 * WINDOW - GRAM words). Equal spans are one reference with its smallest
   and largest doc_id.
3. The spans of an anchor are a reference shard. Its suffix automaton takes
   them in ascending doc_id, so a state knows the smallest document of its
   strings; the shard's spans stream through it, and the state that holds the
   last WINDOW words gives every window's smallest document. An anchor with
   over ``SHARD`` different spans is split: its windows go by the anchor and
   their first and last ``GRAM`` words, which part the windows that only touch
   a common passage; shards still too large go by all their grams. Equal
   windows agree on these, so they stay together.
4. Occurrences look up their span's windows. Documents that lose words meet
   their windows by a join; all others are read and finished in place.

Contracts: words are runs of bytes other than ASCII white space, compared by
64 and 48 bits of hash; a null or wordless text keeps nothing and loses
nothing; rows with the same doc_id do not take words from each other; a null
doc_id neither gives nor takes; other columns pass untouched; an empty table
gives none.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import Words, apart, bitmap, discard, in_bitmap, mix64, spot, stored, text_runs

WINDOW, GRAM = 13, 4
SHARD = 2048  # spans that a task's automaton holds
CODE = 6  # bytes of a word's hash in a span
_ODD = np.uint64(0xD1342543DE82EF95)
_ODD_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def runs_of(w: Words, window: int, gram: int):
    """(text, first word, windows, anchor) of the maximal runs of windows that
    share an anchor at one place."""
    h, n = w.hash, len(w.hash)
    if n < window:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64))
    g = np.zeros(n - gram + 1, np.uint64)
    for k in range(gram):
        g = mix64(g * np.uint64(0x9E3779B97F4A7C15) + h[k:k + len(g)])
    m, last = n - window + 1, window - gram + 1
    best, place = g[:m].copy(), np.arange(m)
    for k in range(1, last):
        x = g[k:k + m]
        less = x < best
        best[less] = x[less]
        place[less] = np.flatnonzero(less) + k
    text = np.repeat(np.arange(len(w.bounds) - 1), np.diff(w.bounds))
    at = np.flatnonzero(text[:m] == text[window - 1:])
    if not len(at):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64))
    new = np.ones(len(at), bool)
    new[1:] = (place[at[1:]] != place[at[:-1]]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    return text[at[first]], at[first], np.diff(np.append(first, len(at))), best[at[first]].view(np.int64)


def anchors(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(anchor, doc) of every run of every document."""

    def build(batches):
        for batch in batches:
            for row, data, offsets in text_runs(batch.column(1)):
                text, _, _, anchor = runs_of(Words(data, offsets), window, gram)
                doc = batch.column(0).slice(row, len(offsets) - 1).to_numpy()[text]
                order = np.lexsort((anchor, doc))
                keep = np.ones(len(order), bool)
                keep[1:] = (anchor[order][1:] != anchor[order][:-1]) | (doc[order][1:] != doc[order][:-1])
                yield pa.RecordBatch.from_arrays([pa.array(anchor[order][keep]), pa.array(doc[order][keep])], ["anchor", "doc"])

    return docs.mapInArrow(build, "anchor long, doc long")


def spans(docs: DataFrame, bits: int, maps, window: int, gram: int, with_words: bool, codes=None) -> DataFrame:
    """Spans of the documents whose anchors are in the bitmap (and whose codes
    are in that of ``codes``: its bits and bytes): anchor, code (a hash of the
    span's words), windows, doc, and either words or the place."""

    def build(batches):
        seen = maps.value
        names = ["anchor", "code", "windows", "doc", *(["words"] if with_words else ["th", "start"])]
        for batch in batches:
            for row, data, offsets in text_runs(batch.column(1)):
                w = Words(data, offsets)
                text, first, count, anchor = runs_of(w, window, gram)
                keep = in_bitmap(seen, _spot64(anchor, bits))
                text, first, count, anchor = text[keep], first[keep], count[keep], anchor[keep]
                if not len(text):
                    continue
                n = len(w.hash)
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w.hash * _powers(_ODD, n), dtype=np.uint64)])
                end = first + count + window - 1
                code = mix64((sums[end] - sums[first]) * _powers(_ODD_INVERSE, n)[first] + count.astype(np.uint64)).view(np.int64)
                if codes is not None:
                    keep = in_bitmap(codes[1].value, _spot64(code, codes[0]))
                    text, first, count, anchor, code, end = text[keep], first[keep], count[keep], anchor[keep], code[keep], end[keep]
                doc = batch.column(0).slice(row, len(offsets) - 1).to_numpy()[text]
                cols = [pa.array(anchor), pa.array(code), pa.array(count), pa.array(doc)]
                if with_words:
                    size = end - first
                    at = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
                    place = np.arange(at[-1]) - np.repeat(at[:-1], size) + np.repeat(first, size)
                    raw = np.ascontiguousarray(w.hash[place].view(np.uint8).reshape(-1, 8)[:, :CODE])
                    cols.append(pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer((at * CODE).astype(np.int32).tobytes()), pa.py_buffer(raw.tobytes())]))
                else:
                    cols += [batch.column(2).slice(row, len(offsets) - 1).take(pa.array(text)), pa.array(first - w.bounds[text])]
                yield pa.RecordBatch.from_arrays(cols, names)

    kinds = "anchor long, code long, windows long, doc long, " + ("words binary" if with_words else "th long, start long")
    return docs.mapInArrow(build, kinds)


def _spot64(anchor: np.ndarray, bits: int) -> np.ndarray:
    return (mix64(anchor.view(np.uint64)) >> np.uint64(64 - (bits.bit_length() - 1))).astype(np.int64)


class Automaton:
    """Suffix automaton of several word sequences, added in ascending order of
    a number; each state keeps the smallest number of its strings."""

    def __init__(self):
        self.next, self.link, self.length, self.first = [{}], [-1], [0], [None]

    def _state(self, length: int, first, follow: dict, link: int) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.next) - 1

    def _split(self, p: int, word, q: int) -> int:
        """A state for the strings of q that p leads to; q keeps the longer."""
        clone = self._state(self.length[p] + 1, self.first[q], dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list, number) -> None:
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
                continue
            state = self._state(self.length[last] + 1, number, {}, 0)
            p = last
            while p != -1 and word not in self.next[p]:
                self.next[p][word] = state
                p = self.link[p]
            if p != -1:
                q = self.next[p][word]
                self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
            last = state

    def smallest(self, words: list, window: int) -> list:
        """For each window of the words the smallest number whose sequence has
        it (None if none): the walk keeps the longest match, and the state of
        its last ``window`` words answers."""
        state, size, out = 0, 0, []
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.next[state]:
                state, size = self.next[state][word], size + 1
            while self.length[self.link[state]] >= window if state else False:
                state = self.link[state]
                size = self.length[state]
            if i >= window - 1:
                out.append(self.first[state] if size >= window else None)
        return out


def shard_minima(batches, window: int):
    """Spans sorted by anchor and smallest doc_id -> (anchor, code, minima) for
    the spans that a smaller document reaches."""

    def solve(group):
        if len(group) == 1:
            anchor, code, lo, hi, raw = group[0]
            return [(anchor, code, [lo] * (len(raw) // CODE - window + 1))] if lo < hi else []
        split = [[g[4][a:a + CODE] for a in range(0, len(g[4]), CODE)] for g in group]
        auto = Automaton()
        for g, words in zip(group, split, strict=True):
            auto.add(words, g[2])
        out = []
        for g, words in zip(group, split, strict=True):
            least = auto.smallest(words, window)
            if min(least) < g[3]:
                out.append((g[0], g[1], least))
        return out

    group, out = [], []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if group and group[0][0] != row[0]:
                out += solve(group)
                group = []
            group.append(row)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.list_(pa.int64())), strict=True)], ["anchor", "code", "minima"])
            out = []
    if group and (out := solve(group)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.list_(pa.int64())), strict=True)], ["anchor", "code", "minima"])


def split_spans(shards: DataFrame, every: bool, window: int, gram: int) -> DataFrame:
    """The windows of the spans: anchor and code of the span, at (the window's
    place in it), key (of the anchor and the window's first and last gram, or
    of ``every`` gram), part (hash of its words), lo, hi and its words."""

    def cut(batches):
        for batch in batches:
            anchor, code, lo, hi = (batch.column(i).to_numpy() for i in range(4))
            raw = batch.column(4).to_pylist()
            size = np.array([len(x) for x in raw], np.int64) // CODE
            flat = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, CODE)
            words = np.zeros((len(flat), 8), np.uint8)
            words[:, :CODE] = flat
            words = words.view(np.uint64).ravel()
            count = size - window + 1
            span = np.repeat(np.arange(len(size)), count)
            at = np.arange(len(span)) - np.repeat(np.cumsum(count) - count, count)
            first = np.repeat(np.cumsum(size) - size, count) + at
            g = np.zeros(max(0, len(words) - gram + 1), np.uint64)
            for k in range(gram):
                g = mix64(g * np.uint64(0x9E3779B97F4A7C15) + words[k:k + len(g)])
            key = anchor[span].view(np.uint64)
            for k in range(window - gram + 1) if every else (0, window - gram):
                key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + g[first + k])
            part = np.zeros(len(span), np.uint64)
            for k in range(window):
                part = mix64(part * np.uint64(0x9E3779B97F4A7C15) + words[first + k])
            text = np.ascontiguousarray(flat[first[:, None] + np.arange(window)]).tobytes()
            step = window * CODE
            own = pa.Array.from_buffers(pa.binary(), len(span), [None, pa.py_buffer((np.arange(len(span) + 1) * step).astype(np.int32)), pa.py_buffer(text)])
            yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in (anchor[span], code[span], at, key.view(np.int64), part.view(np.int64), lo[span], hi[span])], own],
                                             ["anchor", "code", "at", "key", "part", "lo", "hi", "words"])

    return shards.select("anchor", "code", "lo", "hi", "words").mapInArrow(cut, "anchor long, code long, at long, key long, part long, lo long, hi long, words binary")


def window_minima(shards: DataFrame, window: int, gram: int, limit: int, scratch: list, level: int = 1) -> DataFrame:
    """(anchor, code, minima) of the spans (anchor, code, words, lo, hi) that a
    smaller document reaches; shards over the limit are split, twice at most:
    by then their windows have all grams in common. Tables that the result
    reads are added to ``scratch``."""
    n = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = lambda df: (df.select("anchor", "code", "lo", "hi", "words").repartition(n, "anchor").sortWithinPartitions("anchor", "lo", "code")
                       .mapInArrow(lambda b: shard_minima(b, window), "anchor long, code long, minima array<long>"))
    if level > 2:
        return held(shards)
    wide = stored(shards.groupBy("anchor").agg(F.count(F.lit(1)).alias("spans")).filter(F.col("spans") > limit).select("anchor"), "wide-anchors")
    if wide.isEmpty():
        return held(shards)
    parts = stored(split_spans(shards.join(wide, "anchor", "left_semi"), level == 2, window, gram), "span-parts")
    each = parts.groupBy(F.col("key").alias("anchor"), F.col("part").alias("code"), "words").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo < hi")
    inner = stored(each, "part-shards")
    scratch += [wide, parts, inner]
    got = window_minima(inner, window, gram, limit, scratch, level + 1)
    found = (parts.join(got.select(F.col("anchor").alias("key"), F.col("code").alias("part"), F.col("minima")[0].alias("least")), ["key", "part"])
             .groupBy("anchor", "code").agg(F.map_from_entries(F.collect_list(F.struct("at", "least"))).alias("found")))
    # windows that no smaller document has stay without a number
    last = F.octet_length("words") / CODE - window
    whole = (shards.join(found, ["anchor", "code"])
             .select("anchor", "code", F.transform(F.sequence(F.lit(0).cast("long"), last.cast("long")), lambda i: F.try_element_at("found", i)).alias("minima")))
    return held(shards.join(wide, "anchor", "left_anti")).union(whole)


def removals(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc, th, starts): first words of the windows that a document loses;
    th is the hash of its text. Rows are bounded by a document's windows."""
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc"), "text", F.xxhash64("text").alias("th")).filter("doc is not null and text is not null")
    shared = anchors(d, window, gram).groupBy("anchor").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).filter("lo < hi").select("anchor")
    shared = stored(shared, "anchors")
    bits, seen = bitmap_of(shared)
    discard(shared)
    maps = spark.sparkContext.broadcast(seen)
    shards = stored(spans(d, bits, maps, window, gram, True).groupBy("anchor", "code", "words").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")), "shards")
    scratch = [shards]
    least = stored(window_minima(shards, window, gram, SHARD, scratch), "span-minima")
    discard(*scratch)
    # the others' spans have nothing to look up: few places need the join
    code_bits, reached = bitmap_of(least.select("code"))
    codes = code_bits, spark.sparkContext.broadcast(reached)
    hits = (spans(d, bits, maps, window, gram, False, codes).join(least, ["anchor", "code"])
            .withColumn("starts", F.expr("transform(filter(sequence(0, size(minima) - 1), i -> minima[i] < doc), i -> start + i)")).filter("size(starts) > 0"))
    return hits.groupBy("doc", "th").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("starts")))).alias("starts"))


def bitmap_of(shared: DataFrame) -> tuple[int, np.ndarray]:
    """Bitmap of anchors or codes, which are hashes already: their top bits, mixed."""
    from tabprep.llm.common import BITMAP_BITS

    n, bits = shared.count(), 1 << 15
    while bits < 16 * n and bits < BITMAP_BITS:
        bits *= 2

    def place(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_spot64(b.column(0).to_numpy(), bits) + 1)], ["x"])

    rows = (shared.mapInArrow(place, "x long").groupBy(F.expr("bitmap_bucket_number(x)").alias("k"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(x))").alias("b")).collect())
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        first = (r["k"] - 1) * 4096
        out[first:first + len(r["b"])] = np.frombuffer(r["b"], np.uint8)
    return bits, out


def _finish(batches, names, window: int, digest: bool):
    """doc_id.., text, starts -> n_words, n_removed, kept text or its hash."""
    for batch in batches:
        at = batch.schema.names.index("text")
        starts = batch.column(batch.schema.names.index("_starts")) if "_starts" in batch.schema.names else None
        for row, data, offsets in text_runs(batch.column(at)):
            w = Words(data, offsets, hashes=False)
            raw, counts, gone, kept = data.tobytes(), [], [], []
            for i in range(len(offsets) - 1):
                a, b = int(w.bounds[i]), int(w.bounds[i + 1])
                lose = np.zeros(b - a + 1, np.int64)
                some = starts[row + i].as_py() if starts is not None else None
                if some:
                    np.add.at(lose, np.array(some), 1)
                    np.add.at(lose, np.array(some) + window, -1)
                left = np.cumsum(lose)[:-1] == 0
                words = raw[offsets[i]:offsets[i + 1]].split()
                if some:
                    words = [x for x, ok in zip(words, left.tolist(), strict=True) if ok]
                text = b" ".join(words)
                counts.append(b - a)
                gone.append(b - a - len(words))
                kept.append(hashlib.sha256(text).hexdigest() if digest else text.decode("utf-8", "replace"))
            part = batch.slice(row, len(counts))
            yield pa.RecordBatch.from_arrays([*[part.column(part.schema.names.index(c)) for c in names], pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept)],
                                             [*names, "n_words", "n_removed", "kept"])


def dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, digest: bool = False) -> DataFrame:
    """``docs`` without ``text``, with n_words, n_removed and kept (the kept
    words joined by a space, or with ``digest`` their SHA-256); columns of
    those names are replaced."""
    return apart(docs, ("doc_id", "text"), lambda d: _dedup(d, window, gram, digest), ("n_words", "n_removed", "kept"))


def _dedup(docs: DataFrame, window: int, gram: int, digest: bool) -> DataFrame:
    lost = stored(removals(docs, window, gram), "removals")
    bits, seen = bitmap(lost, "doc")
    maps = docs.sparkSession.sparkContext.broadcast(seen)
    names = [c for c in docs.columns if c not in ("text", "n_words", "n_removed", "kept")]
    base = docs.select(*names, "text", F.col("doc_id").cast("long").alias("_doc"), F.xxhash64("text").alias("_th"),
                       F.coalesce(spot(F.col("doc_id").cast("long"), bits), F.lit(0)).alias("_x"))

    def part(inside: bool):
        def pick(batches):
            flags = maps.value
            for b in batches:
                yield b.filter(pa.array(in_bitmap(flags, b.column(len(names) + 3).to_numpy()) == inside))
        return pick

    from pyspark.sql import types as T

    schema = T.StructType([*[docs.schema[c] for c in names], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    whole = base.mapInArrow(lambda b: _finish(part(False)(b), names, window, digest), schema)
    cut = (base.mapInArrow(part(True), base.schema).join(lost.select(F.col("doc").alias("_doc"), F.col("th").alias("_th"), F.col("starts").alias("_starts")), ["_doc", "_th"], "left")
           .select(*names, "text", "_starts").mapInArrow(lambda b: _finish(b, names, window, digest), schema))
    return whole.union(cut)


KEPT_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM d WHERE len(w) >= 13),
h AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM g),
m AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS lo FROM h),
b AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM m WHERE lo < doc_id),
r AS (SELECT doc_id, list(p) AS gone FROM b GROUP BY doc_id),
k AS (SELECT d.doc_id, w, coalesce(gone, []) AS gone FROM d LEFT JOIN r ON r.doc_id = d.doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed,
    sha256(coalesce(array_to_string(list_filter(w, lambda x, i: NOT list_contains(gone, i)), ' '), '')) AS kept_sha256 FROM k"""
