"""N-gram Jaccard join: size-aware, heavy-light, exact.

A document is the set of its distinct word shingles. Two sets link when their
Jaccard similarity is at least ``percent`` / 100. The join finds the classes
of linked documents:

1. A count sketch of all shingles (fixed size) orders shingles, rare first.
   Any order gives the same result; a rare-first one gives short lists.
2. Equal sets are one class; only its smallest document goes on.
3. Linked sets of n and m shingles share at least ceil(percent n / 100)
   shingles, so the first n - that + k shingles of both, in the order, share
   at least k. Small sets enumerate the pairs (k = 2) of that prefix; large
   sets are found by scanning the inverted lists of single shingles (k = 1).
   The boundary size is the one with the least cost: pairs made under it,
   list entries met from it on. Small sets within reach of the boundary
   are in the lists too. Of two linked sets the larger has at least n
   shingles, so they share at least ceil(2 percent n / (100 + percent)), and
   the first n - that + 1 of the smaller do for k = 1. A list counts pairs whose
   smaller set holds its shingle that early: a passage that many sets share,
   most of each but too little for a link, then brings none together.
4. Members of a list that a lossless filter (the L1 distance of their
   shingles counted in cells is at most the symmetric difference) cannot part
   are candidates. Larger sets are counted in more cells (``ladder``), as few
   cells cannot part unlike large sets. A list is never spread into pairs: its members are
   united in place, a row out for a row in. Lists over ``LIST`` members are
   united by size and early shingles alone. The groups of candidates hold every class of linked sets.
5. A group of more than ``BLOCK`` shingles, often long documents that share a
   passage, is filtered again with ``FINE`` cells and falls apart.
6. In every group, in blocks of bounded size, the exact shared counts come
   from the block's inverted lists, and linked sets unite. Groups of several
   blocks join their classes by a few members of each, and then compare the
   members outside the largest class with all other blocks.

Contracts: words are runs of bytes other than ASCII white space, A-Z lowered;
a text with fewer words than the shingle width is one shingle of all; a null
or wordless text has the empty set, linked with nothing; rows that share a
doc_id share a class; extra columns are ignored; an empty table gives none.
Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.common import Words, apart, arrow_batches, bitmap, discard, in_bitmap, shingle_hashes, spot, stored, text_runs
from tabprep.llm.components import components

WIDTH, PERCENT = 3, 90
SKETCH = 18  # bits: 2**18 counters
CELLS = 64
LIST = 1024
FINE, FINE_LIST = 4096, 2048
BLOCK = 1 << 20  # shingles
BOUNDARIES = 256


def least_shared(n, percent: int = PERCENT):
    return -(-percent * n // 100)


def ladder(percent: int = PERCENT) -> list[tuple[int, int]]:
    """(size, cells): from that size on sets are counted in so many cells. The
    counts of two unlike sets of n differ by about 1.13 sqrt(n cells) in all,
    linked ones by 2 n (100 - percent) / (100 + percent); a rung ends where
    the first is 1.4 times the second."""
    part = max(100 - percent, 1) / (100 + percent)
    rungs = [(0, CELLS)]
    while rungs[-1][1] < FINE:
        rungs.append((int(rungs[-1][1] / (6.26 * part * part)), min(8 * rungs[-1][1], FINE)))
    return rungs


def folded(cells: list[bytes], count: int) -> np.ndarray:
    """Rows of counts in ``count`` cells, from as many or more."""
    size = np.array([len(x) for x in cells], np.int64)
    out = np.empty((len(cells), count), np.uint8)
    for c in np.unique(size):
        at = np.flatnonzero(size == c)
        rows = np.frombuffer(b"".join([cells[i] for i in at]), np.uint8).reshape(len(at), c // count, count)
        out[at] = rows[:, 0] if c == count else np.minimum(rows.sum(axis=1, dtype=np.int64), 255)
    return out


def sketch(docs: DataFrame, width: int = WIDTH) -> np.ndarray:
    """Counts of all shingles in 2**SKETCH counters, 2 MB whatever the input;
    every task sends its counters in chunks that are summed in Spark."""
    chunk = 1 << 12

    def count(batches):
        total = np.zeros(1 << SKETCH, np.int64)
        for batch in batches:
            for _, data, offsets in text_runs(batch.column(0)):
                w = Words(data, offsets, lower=True)
                for s in shingle_hashes(w.hash, w.bounds, width):
                    np.add.at(total, (s >> np.uint64(64 - SKETCH)).astype(np.int64), 1)
        if total.any():
            yield pa.RecordBatch.from_pydict({"chunk": pa.array(range((1 << SKETCH) // chunk), pa.int32()), "counts": [total[a:a + chunk].tobytes() for a in range(0, 1 << SKETCH, chunk)]})

    def add(key: tuple[Any, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(chunk, np.int64)
        for b in batches:
            for x in b.column("counts").to_pylist():
                total += np.frombuffer(x, np.int64)
        yield pa.RecordBatch.from_pydict({"chunk": pa.array([key[0].as_py()], pa.int32()), "counts": [total.tobytes()]})

    got = docs.select("text").mapInArrow(count, "chunk int, counts binary").groupBy("chunk").applyInArrow(add, "chunk int, counts binary").collect()
    out = np.zeros(1 << SKETCH, np.int64)
    for r in got:
        out[r["chunk"] * chunk:(r["chunk"] + 1) * chunk] = np.frombuffer(r["counts"], np.int64)
    return out


def prefixes(docs: DataFrame, counts: np.ndarray, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n, digest of the set, prefix (k = 2, rare first) and cells."""
    sent = docs.sparkSession.sparkContext.broadcast(np.minimum(counts, (1 << 32) - 1).astype(np.uint64) << np.uint64(32))

    rungs = [(least_shared(size, percent), cells) for size, cells in ladder(percent)]

    def build(batches):
        rank = sent.value
        for batch in batches:
            for row, data, offsets in text_runs(batch.column(1)):
                w = Words(data, offsets, lower=True)
                sets = shingle_hashes(w.hash, w.bounds, width)
                out = [[], [], [], []]
                for s in sets:
                    n = len(s)
                    k = n - least_shared(n, percent) + 2
                    if n * (100 - percent) >= percent:  # a smaller set links with equal sets only
                        key = rank[(s >> np.uint64(64 - SKETCH)).astype(np.int64)] | (s >> np.uint64(32))
                        if k < n:
                            least = np.partition(key, k - 1)[k - 1]
                            below, ties = np.flatnonzero(key < least), np.flatnonzero(key == least)
                            # of equal keys the smaller hashes, in every set alike
                            first = np.concatenate([below, ties[np.argsort(s[ties], kind="stable")][:k - len(below)]])
                        else:
                            first = np.arange(n)
                        prefix = s[first[np.lexsort((s[first], key[first]))]].view(np.int64)
                    else:
                        prefix = np.zeros(0, np.int64)
                    out[0].append(n)
                    out[1].append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if n else None)
                    out[2].append(prefix)
                    c = max(cells for size, cells in rungs if n >= size)
                    out[3].append(np.minimum(np.bincount((s & np.uint64(c - 1)).astype(np.int64), minlength=c), 255).astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(sets)), pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()),
                                                  pa.array(out[2], pa.list_(pa.int64())), pa.array(out[3], pa.binary())], ["doc_id", "n", "digest", "prefix", "cells"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(build, "doc_id long, n long, digest binary, prefix array<long>, cells binary")


def boundary(reps: DataFrame, lists: DataFrame, percent: int = PERCENT, most: int = BOUNDARIES) -> int:
    """The size under which enumerating prefix pairs costs less than scanning
    lists, from the counts of all sets under ``most`` shingles."""
    made = {r["n"]: r["c"] for r in reps.filter(F.col("n") < most).groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}
    met = {r["n"]: r["c"] for r in lists.filter(F.col("n") < most).groupBy("n").agg(F.sum("members").alias("c")).collect()}
    best, best_cost, small, large = 0, None, 0, sum(met.values())
    for x in range(most):
        cost = small + large
        if best_cost is None or cost < best_cost:
            best, best_cost = x, cost
        p = x - least_shared(x, percent) + 2
        small += made.get(x, 0) * p * (p - 1) // 2
        large -= met.get(x, 0)
    return best


def unite(batches, percent: int, cell_count: int = CELLS, most: int | None = None):
    """Rows of lists (key, doc, n, cells[, early]), sorted by key, n and doc, to
    edges (a, b) that connect the members which the cell filter cannot part. A
    pair counts where its first row is ``early`` (default: every row is)."""
    def edges(key, doc, n, cells, early):
        m = len(key)
        label = np.arange(m)
        for o in range(1, m):
            i = np.flatnonzero(key[:-o] == key[o:])
            if not len(i):
                break
            i = i[early[i] & (label[i] != label[i + o]) & (100 * n[i] >= percent * n[i + o])]
            apart = np.abs(cells[i].astype(np.int16) - cells[i + o]).sum(axis=1, dtype=np.int64)
            i = i[(100 + percent) * apart <= (100 - percent) * (n[i] + n[i + o])]
            if o == 1:  # chains of neighbours
                joined = np.zeros(m, bool)
                joined[i + 1] = True
                label = np.maximum.accumulate(np.where(joined, 0, np.arange(m)))
                continue
            for x in i.tolist():
                p, q = label[x], label[x + o]
                if p != q:
                    part = label[np.searchsorted(key, key[x], "left"):np.searchsorted(key, key[x], "right")]
                    part[part == max(p, q)] = min(p, q)
        at = np.flatnonzero(label != np.arange(m))
        return np.unique(np.stack([doc[at], doc[label[at]]], axis=1), axis=0) if len(at) else np.zeros((0, 2), np.int64)

    def chain(doc, n, early):
        # each row with the last early one before it: of two rows that may
        # pair, all early ones in between are near enough in size to link up
        last = np.maximum.accumulate(np.where(early, np.arange(len(doc)), -1))[:-1]
        at = np.flatnonzero(last >= 0)
        at = at[100 * n[last[at]] >= percent * n[at + 1]]
        return np.stack([doc[at + 1], doc[last[at]]], axis=1)

    def ahead(early):
        """The last early row, or else the last row: it stands for all."""
        return len(early) - 1 - int(early[::-1].argmax()) if early.any() else len(early) - 1

    held, over, most = None, None, most or LIST
    for batch in batches:
        t = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        t.append(folded(batch.column(3).to_pylist(), cell_count))
        t.append(batch.column(4).to_numpy(zero_copy_only=False) if batch.num_columns > 4 else np.ones(len(batch), bool))
        step = max(256, 8192 * CELLS // cell_count)
        for a in range(0, len(t[0]), step):
            part = [x[a:a + step] for x in t]
            if held is not None:
                part = [np.concatenate([x, y]) for x, y in zip(held, part, strict=True)]
            out = np.zeros((0, 2), np.int64)
            if over is not None:  # the rest of a long list
                end = int(np.searchsorted(part[0], over, "right"))
                out = chain(part[1][:end], part[2][:end], part[4][:end])
                one = ahead(part[4][:end])
                part = [np.concatenate([x[one:one + 1], x[end:]]) for x in part]
            cut = int(np.searchsorted(part[0], part[0][-1], "left"))
            if cut:
                out = np.concatenate([out, edges(*[x[:cut] for x in part])])
                over = None
            held = [x[cut:] for x in part]
            if len(held[0]) > most:  # a long list: its members unite without the cells, those in later chunks too
                out = np.concatenate([out, chain(held[1], held[2], held[4])])
                over, one = held[0][-1], ahead(held[4])
                held = [x[one:one + 1] for x in held]
            if len(out):
                yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["a", "b"])
    if held is not None and len(held[0]) > 1:
        out = edges(*held)
        if len(out):
            yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["a", "b"])


def linked_labels(sets: list[np.ndarray], percent: int, label: np.ndarray | None = None) -> np.ndarray:
    """Labels of a block's sets: equal if links join them (or ``label`` had
    them equal). Shared counts come from the block's own inverted lists."""
    m = len(sets)
    label = np.arange(m) if label is None else label.copy()
    size = np.array([len(s) for s in sets])
    token, owner = np.concatenate(sets), np.repeat(np.arange(m), size)
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    new = np.ones(len(token), bool)
    new[1:] = token[1:] != token[:-1]
    start = np.flatnonzero(new)
    which = np.empty(len(token), np.int64)
    which[order] = np.cumsum(new) - 1
    length = np.diff(np.append(start, len(token)))
    at = np.cumsum(size) - size
    for i in range(m - 1):
        if (label == label[0]).all():
            break
        ids = which[at[i]:at[i] + size[i]]
        ids = ids[length[ids] > 1]
        if not len(ids):
            continue
        n = length[ids]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[ids], n)
        shared = np.bincount(owner[place], minlength=m)
        for j in np.unique(label[100 * shared >= percent * (size[i] + size - shared)]):
            if j != label[i]:
                label[label == max(j, label[i])] = min(j, label[i])
    return label


def block_labels(batches, percent: int):
    """Rows (grp, doc, label, shingles) sorted by grp -> edges (a, b) between
    the documents of a group that links join; a and label of a document that
    no link joins to another label are not repeated."""
    def solve(docs, labels, sets):
        if len(docs) < 2:
            return []
        _, label = np.unique(np.array(labels, dtype=np.int64), return_inverse=True)
        first = {}
        start = np.array([first.setdefault(x, i) for i, x in enumerate(label.tolist())])
        got = linked_labels(sets, percent, start)
        return [(docs[i], docs[g]) for i, g in enumerate(got.tolist()) if g != start[i]] + [(docs[start[i]], docs[got[i]]) for i in range(len(docs)) if start[i] != i and got[i] != start[i]]

    key, docs, labels, sets = None, [], [], []
    for batch in batches:
        out = []
        for k, d, lab, raw in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
            if k != key:
                out += solve(docs, labels, sets)
                key, docs, labels, sets = k, [], [], []
            docs.append(d)
            labels.append(lab)
            sets.append(np.frombuffer(raw, np.uint64))
        if out:
            yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})
    out = solve(docs, labels, sets)
    if out:
        yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def member_sets(docs: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """doc, shingles (bytes of sorted hashes) of the documents in ``members``
    (doc) and a few others that the bitmap lets through; a join decides."""
    bits, maps = bitmap(members, "doc")
    sent = docs.sparkSession.sparkContext.broadcast(maps)

    def build(batches):
        maps = sent.value
        for batch in batches:
            kept = batch.filter(pa.array(in_bitmap(maps, batch.column(2).to_numpy())))
            for row, data, offsets in text_runs(kept.column(1)):
                w = Words(data, offsets, lower=True)
                sets = shingle_hashes(w.hash, w.bounds, width)
                yield pa.RecordBatch.from_arrays([kept.column(0).slice(row, len(sets)), pa.array([s.tobytes() for s in sets], pa.binary())], ["doc", "shingles"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc"), "text").filter("doc is not null").withColumn("x", spot(F.col("doc"), bits))
    return d.mapInArrow(build, "doc long, shingles binary")


def fine_cells(batches):
    """(grp, doc, n, shingles) -> (grp, doc, n, cells) with ``FINE`` cells."""
    for batch in batches:
        cells = [np.minimum(np.bincount((np.frombuffer(x, np.uint64) & np.uint64(FINE - 1)).astype(np.int64), minlength=FINE), 255).astype(np.uint8).tobytes()
                 for x in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(cells, pa.binary())], ["grp", "doc", "n", "cells"])


def in_blocks(groups: DataFrame, sets: DataFrame, percent: int, scratch: list) -> DataFrame:
    """(grp, block, doc, shingles): the members of every group in blocks of
    about ``BLOCK`` shingles. A group of several blocks is filtered again with
    finer cells first; members that nothing else reaches then leave. Tables
    that the result reads are added to ``scratch``."""
    large = stored(groups.groupBy("grp").agg(F.sum("n").alias("total")).filter(F.col("total") > BLOCK).select("grp"), "jaccard-large")
    small = sets.join(large, "grp", "left_anti").select("grp", F.lit(0).cast("bigint").alias("block"), "doc", "shingles")
    if not large.limit(1).count():
        return small
    spark = sets.sparkSession
    wide = stored(sets.join(large, "grp", "left_semi"), "jaccard-large-sets")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = wide.select("grp", "doc", "n", "shingles").mapInArrow(fine_cells, "grp long, doc long, n long, cells binary")
    with arrow_batches(spark, 1024):
        met = stored(cells.repartition(parts, "grp").sortWithinPartitions("grp", "n", "doc")
                     .mapInArrow(lambda b: unite(b, percent, FINE, FINE_LIST), "a long, b long"), "jaccard-fine-links")
    again = components(met).withColumnRenamed("node", "doc").withColumnRenamed("component", "grp").join(wide.select("doc", "n"), "doc")
    before = F.sum("n").over(Window.partitionBy("grp").orderBy("n", "doc").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    place = again.select("doc", "grp", F.floor(before / BLOCK).alias("block"))
    narrow = stored(place.join(wide.drop("grp", "n"), "doc").select("grp", "block", "doc", "shingles"), "jaccard-blocks")
    discard(wide, met)
    scratch.append(narrow)
    return small.union(narrow)


def across_blocks(lab: DataFrame, links: DataFrame, done: DataFrame, percent: int, scratch: list) -> DataFrame:
    """Classes once blocks of a group (grp, block, last, doc, shingles) are
    compared too. First a few members of each class found within blocks are
    compared with those of the others, which joins most of them. Then only
    members outside a group's largest class meet the other blocks: two members
    of one class need no comparison."""
    parts = int(lab.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lab = stored(lab.withColumn("n", F.length("shingles") / 8), "jaccard-wide-sets")
    scratch.append(lab)

    def labelled(classes: DataFrame) -> DataFrame:
        return lab.drop("shingles").join(classes.withColumnRenamed("node", "doc"), "doc", "left").withColumn("label", F.coalesce("component", "doc")).drop("component")

    def compare(rows: DataFrame, name: str) -> DataFrame:
        out = stored(rows.select("key", "doc", "label", "shingles").repartition(parts, "key").sortWithinPartitions("key", "doc")
                     .mapInArrow(lambda b: block_labels(b, percent), "a long, b long"), name)
        scratch.append(out)
        return out

    def in_order(rows: DataFrame, name: str) -> DataFrame:
        before = F.sum("n").over(Window.partitionBy("grp").orderBy("n", "doc").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
        return rows.withColumn(name, F.floor(before / BLOCK))

    now = labelled(done)
    few = now.groupBy("grp", "label").agg(F.array_distinct(F.array(F.min("doc"), F.max("doc"), F.min_by("doc", "n"), F.max_by("doc", "n"))).alias("d"))
    few = stored(in_order(few.select("grp", "label", F.explode("d").alias("doc")).join(now.select("doc", "n"), "doc"), "at"), "jaccard-few")
    some = compare(few.select(F.concat_ws(":", "grp", "at").alias("key"), "doc", "label").join(lab.select("doc", "shingles"), "doc"), "jaccard-few-links")
    now = labelled(components(links.union(some)))
    counts = now.groupBy("grp", "label").agg(F.count(F.lit(1)).alias("c"))
    main = counts.groupBy("grp").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.count(F.lit(1)).alias("labels")).filter("labels > 1").drop("labels")
    now = stored(now.join(stored(main, "jaccard-main"), "grp"), "jaccard-open")
    minor = stored(in_order(now.filter("label <> main"), "at"), "jaccard-minor")
    # blocks and lots are in order of size: those whose sizes cannot link do not meet
    lot = minor.groupBy("grp", "at").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    block = now.filter("label = main").groupBy("grp", "block").agg(F.min("n").alias("blo"), F.max("n").alias("bhi"))
    reach = (F.col("hi") * 100 >= F.col("blo") * percent) & (F.col("bhi") * 100 >= F.col("lo") * percent)
    two = lot.select("grp", F.col("at").alias("other"), F.col("lo").alias("blo"), F.col("hi").alias("bhi"))
    meets = stored(lot.join(two, "grp").filter(reach).select("grp", "at", "other"), "jaccard-lots")
    faces = stored(lot.join(block, "grp").filter(reach).select("grp", "at", "block"), "jaccard-faces")
    scratch += [meets, faces]
    own = minor.join(meets, ["grp", "at"]).select(F.concat_ws(":", F.lit("m"), "grp", F.least("at", "other"), F.greatest("at", "other")).alias("key"), "doc", "label")
    out = minor.drop("block").join(faces, ["grp", "at"]).select(F.concat_ws(":", F.lit("b"), "grp", "block", "at").alias("key"), "doc", "label")
    held = now.filter("label = main").select("grp", "block", "doc", "label").join(faces, ["grp", "block"]).select(F.concat_ws(":", F.lit("b"), "grp", "block", "at").alias("key"), "doc", "label")
    cross = compare(own.union(out).union(held).join(lab.select("doc", "shingles"), "doc"), "jaccard-cross-links")
    return components(links.union(some).union(cross))


def groups_wide(blocked: DataFrame) -> DataFrame:
    return blocked.groupBy("grp").agg(F.max("block").alias("last")).filter("last > 0")


def classes(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id that links reach)."""
    rows = stored(prefixes(docs, sketch(docs, width), width, percent), "jaccard-prefixes")
    equal = rows.filter("digest is not null").groupBy("digest")
    same = equal.agg(F.min("doc_id").alias("doc"))
    reps = stored(equal.agg(F.min("doc_id").alias("doc"), F.min("n").alias("n"), F.min_by(F.struct("prefix", "cells"), "doc_id").alias("p"))
                  .filter("doc is not null").select("doc", "n", "p.prefix", "p.cells"), "jaccard-sets")
    p = (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int")
    whole = F.size("prefix") > 0
    listed = reps.filter(whole).select("doc", "n", F.posexplode(F.slice("prefix", F.lit(1), p)).alias("pos", "key"))
    listed = listed.withColumn("early", F.col("pos") <= F.col("n") - F.ceil(F.col("n") * (2 * percent) / (100 + percent))).drop("pos")
    members = F.count(F.lit(1)).over(Window.partitionBy("key"))
    least = F.min(F.when(F.col("early"), F.col("n"))).over(Window.partitionBy("key"))
    lists = stored(listed.withColumn("members", members).withColumn("least", least).filter("members > 1 and n >= least").drop("least"), "jaccard-lists")
    x = boundary(reps.filter(whole), lists, percent)
    pairs = reps.filter(whole & (F.col("n") < x)).select("doc", "n", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(1), F.size("prefix") - 1), lambda i: F.transform(F.slice("prefix", i + 1, F.size("prefix")), lambda t: F.xxhash64(F.element_at("prefix", i), t))))).alias("key"))
    small = pairs.withColumn("members", members).filter("members > 1")
    large = lists.filter(F.col("n") >= least_shared(x, percent))
    large, small = large.select("key", "doc", "n", "early"), small.select("key", "doc", "n", F.lit(True).alias("early"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def found(rows: DataFrame, sets: DataFrame, count: int) -> DataFrame:
        rows = rows.join(sets.select("doc", "cells"), "doc").select("key", "doc", "n", "cells", "early")
        return rows.repartition(parts, "key").sortWithinPartitions("key", "n", "doc").mapInArrow(lambda b: unite(b, percent, count), "a long, b long")

    # a pair is met on the rung of its larger set
    rungs, met = ladder(percent), found(small, reps.filter(F.col("n") < x), CELLS)
    for (size, count), (end, _) in zip(rungs, [*rungs[1:], (None, 0)], strict=True):
        on = (F.col("n") >= least_shared(size, percent)) & (F.lit(True) if end is None else F.col("n") < end)
        met = met.union(found(large.filter(on), reps.filter(on), count))
    groups = components(met)
    groups = stored(groups.join(reps.select(F.col("doc").alias("node"), "n"), "node").select(F.col("node").alias("doc"), F.col("component").alias("grp"), "n"), "jaccard-groups")
    sets = stored(groups.join(member_sets(docs, groups, width).dropDuplicates(["doc"]), "doc"), "jaccard-members")
    scratch: list[DataFrame] = []
    blocked = in_blocks(groups, sets, percent, scratch)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    one = (blocked.select(F.concat_ws(":", "grp", "block").alias("grp"), "doc", F.col("doc").alias("label"), "shingles")
           .repartition(n, "grp").sortWithinPartitions("grp", "doc"))
    links = stored(one.mapInArrow(lambda b: block_labels(b, percent), "a long, b long"), "jaccard-links")
    done = components(links)
    # groups of several blocks; stored, so that their size is known before the blocks are joined with them
    wide = stored(groups_wide(blocked), "jaccard-wide")
    if wide.limit(1).count():
        done = across_blocks(blocked.join(wide, "grp"), links, done, percent, scratch)
    done = stored(done, "jaccard-classes")
    discard(reps, lists, groups, sets, links, *scratch)
    top = same.join(done.withColumnRenamed("node", "doc"), "doc", "left").select("digest", F.coalesce("component", "doc").alias("component_id"))
    return rows.join(top, "digest", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each class: the one with the smallest
    doc_id. Rows that share a doc_id but not their text are documents of their
    own: they go by a hash of both, so that only equal or linked texts leave.
    Rows without a doc_id stay."""
    return apart(docs, ("doc_id", "text"), lambda d: _one_of_each(d, width, percent))


def _one_of_each(docs: DataFrame, width: int, percent: int) -> DataFrame:
    known = docs.filter("doc_id is not null")
    th = F.xxhash64("text")
    clash = stored(known.groupBy("doc_id").agg(F.min(th).alias("a"), F.max(th).alias("b")).filter("a <> b").select("doc_id"), "shared-ids")
    node = F.col("doc_id").cast("long")
    if not clash.isEmpty():
        known = known.join(clash.withColumn("shared", F.lit(True)), "doc_id", "left")
        node = F.when(F.col("shared"), F.xxhash64("doc_id", "text")).otherwise(node)
    known = known.withColumn("node", node)
    first = classes(known.select(F.col("node").alias("doc_id"), "text"), width, percent).filter("doc_id = component_id").select(F.col("doc_id").alias("node")).distinct()
    one = Window.partitionBy("node").orderBy("text")
    kept = known.join(first, "node", "left_semi").withColumn("nth", F.row_number().over(one)).filter("nth = 1").select(*docs.columns)
    return kept.union(docs.filter("doc_id is null"))


CLASS_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM c JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 90 * (nx.n + ny.n - k)),
r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
m AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN m ON m.x = d.doc_id"""
