"""Packing documents into sequences by first-fit decreasing.

A document's ids (with the end id) are cut into pieces of ``LENGTH`` and one
rest. Full pieces are sequences of their own. Documents are dealt at random
(by hash) to groups; in a group the rests, longest first, go each to the
first sequence with room, found in a tournament tree that holds the largest
room under every node. Groups have about ``GROUP`` documents whatever the
corpus, so a task's memory is bounded and no group is hot. Texts are encoded
in runs of about ``RUN`` bytes (one text is never split) with ``REMEMBERED``
pieces in memory, so a worker stays small beside what earlier jobs left.

A sequence is padded to ``LENGTH`` unless its length is a power of two.
Contracts: a null text is empty and packs its end id alone; an empty table
packs nothing; repeated rows are packed each; documents that share a doc_id
(or have none) are dealt by their texts too; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import text_runs
from tabprep.llm.encoding import encoder

LENGTH, END, GROUP = 1024, 0, 4096
RUN, REMEMBERED = 1 << 21, 600_000
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, grp long, ids binary"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def first_fit(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each size, in the order given: the first bin with room.

    ``room`` is a complete binary tree over as many bins as sizes: a leaf is a
    bin's room, an inner node the larger of its children, so the leftmost bin
    with enough room is one walk down, and taking room one walk up.
    """
    leaves = 1
    while leaves < len(sizes):
        leaves *= 2
    room = [length] * (2 * leaves)
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for i, size in enumerate(sizes.tolist()):
        at = 1
        while at < leaves:
            at *= 2
            if room[at] < size:
                at += 1
        bins[i], offsets[i] = at - leaves, length - room[at]
        room[at] -= size
        at //= 2
        while at:
            most = max(room[2 * at], room[2 * at + 1])
            if room[at] == most:
                break
            room[at] = most
            at //= 2
    return bins, offsets


def cut_batches(batches, length: int = LENGTH, end: int = END, vocabulary: str | None = None, with_ids: bool = False):
    """``PIECE`` batches from Arrow batches of (doc_id, text, grp)."""
    import pyarrow as pa

    enc = encoder(vocabulary)
    for batch in batches:
        for row, data, offsets in text_runs(batch.column(1), RUN):
            n = len(offsets) - 1
            ids, bounds = enc.encode_run(data, offsets, REMEMBERED)
            ids = np.insert(ids, bounds[1:], end).astype("<u4")  # every document's end id
            bounds = bounds + np.arange(n + 1)
            total = np.diff(bounds)
            count = -(-total // length)
            doc = np.repeat(np.arange(n), count)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * length
            size = np.minimum(length, total[doc] - start)
            at = bounds[doc] + start
            raw = memoryview(ids).cast("B")
            part = [raw[4 * a:4 * (a + z)] for a, z in zip(at.tolist(), size.tolist(), strict=True)]
            crc = np.fromiter(map(zlib.crc32, part), np.int64, len(part))
            kept = pa.array([ids[a:a + z].astype(enc.dtype).tobytes() for a, z in zip(at.tolist(), size.tolist(), strict=True)], pa.binary()) if with_ids else pa.nulls(len(doc), pa.binary())
            where = pa.array(doc)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, n).cast(pa.int64()).take(where), pa.array(start), pa.array(size), pa.array(crc), pa.array(total[doc]),
                                              batch.column(2).slice(row, n).cast(pa.int64()).take(where), kept], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "grp", "ids"])


def pieces(docs: DataFrame, groups: int, length: int = LENGTH, end: int = END, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """The pieces of every document, dealt to ``groups``; ``ids`` (as bytes of
    the vocabulary's width) only on request, they are most of the volume."""
    group = F.pmod(F.xxhash64("doc_id", "text", F.lit(7)), F.lit(groups))
    return docs.select("doc_id", "text", group.alias("grp")).mapInArrow(lambda b: cut_batches(b, length, end, vocabulary, with_ids), PIECE)


def pack(docs: DataFrame, length: int = LENGTH, end: int = END, vocabulary: str | None = None, group_size: int = GROUP, with_ids: bool = False) -> DataFrame:
    """Every piece with its sequence_id and offset (and ``ids`` on request)."""
    groups = max(1, -(-docs.count() // group_size))

    def place(pdf):
        pdf = pdf.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        sizes = pdf["length"].to_numpy()
        full = int((sizes == length).sum())
        bins = np.arange(len(sizes))
        offsets = np.zeros(len(sizes), np.int64)
        if full < len(sizes):
            b, o = first_fit(sizes[full:], length)
            bins[full:], offsets[full:] = b + full, o
        pdf["sequence_id"] = bins * groups + pdf["grp"].to_numpy()
        pdf["offset"] = offsets
        return pdf[[c.split()[0] for c in schema.split(", ")]]

    schema = PACKED + ", ids binary" if with_ids else PACKED
    cut = pieces(docs, groups, length, end, vocabulary, with_ids)
    return (cut if with_ids else cut.drop("ids")).groupBy("grp").applyInPandas(place, schema)
