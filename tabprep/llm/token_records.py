"""Token ids as length-delimited binary records with a separate offset index.

Data file: an 8-byte magic, the id width in bytes (u32), then records. A
record is its payload's length (u64), the masked checksum of those eight
bytes (u32), the payload, and the masked checksum of the payload (u32). A
payload is doc_id (i64), a null flag (u8) and the ids. The index file holds
each record's offset (u64), so a reader can fetch records in any order. All
integers are little-endian; a checksum is CRC-32, rotated and shifted by a
constant so that checksums of data that hold checksums stay useful.

Files are written by range of doc_id, in ascending order (null first, ties by
text); a file's name holds an id of the attempt, and only files that the
manifest names count, so a task that runs twice leaves no double. Contracts:
a null or empty text is a record of the end id alone; an empty table writes
no file; repeated rows are separate records; extra columns are ignored.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.common import shared_path, stored, text_runs
from tabprep.llm.encoding import RUN, encoder

MAGIC = b"TOKREC01"
END = 2
_MASK = 0xA282EAD8  # fixed value of the mask
MANIFEST = "part long, file string, index string, first_doc long, records long, tokens long, width int"


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def filesystem(path: str):
    """(pyarrow file system, path in it) of a shared-folder path."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def write(docs: DataFrame, folder: str | None = None, vocabulary: str | None = None, end: int = END) -> DataFrame:
    """Writes ``docs`` (doc_id, text) as record files in ``folder`` of the
    shared storage and returns the manifest, one row per file."""
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "tokens")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def put(batches):
        from pyspark import TaskContext

        import pyarrow as pa

        enc, part, out, index, tokens, first = encoder(vocabulary), TaskContext.get().partitionId(), None, [], 0, None
        tail = np.array([end], enc.dtype).tobytes()
        for batch in batches:
            for row, data, offsets in text_runs(batch.column(1), RUN):
                flat, bounds = enc.encode_run(data, offsets)
                raw = memoryview(flat).cast("B")
                got = [raw[a:b] for a, b in zip((bounds[:-1] * enc.dtype.itemsize).tolist(), (bounds[1:] * enc.dtype.itemsize).tolist(), strict=True)]
                ids = batch.column(0).slice(row, len(got)).to_pylist()
                if out is None:
                    fs, base = filesystem(folder)
                    fs.create_dir(base, recursive=True)
                    name = f"{base}/{part:08d}-{uuid.uuid4().hex}"
                    out, at, first = fs.open_output_stream(f"{name}.rec"), 12, ids[0]
                    out.write(MAGIC + struct.pack("<I", enc.dtype.itemsize))
                for doc, own in zip(ids, got, strict=True):
                    rec = frame(struct.pack("<qB", doc or 0, doc is None) + own + tail)
                    out.write(rec)
                    index.append(at)
                    at += len(rec)
                    tokens += len(own) // enc.dtype.itemsize + 1
        if out is not None:
            out.close()
            with fs.open_output_stream(f"{name}.idx") as f:
                f.write(np.array(index, "<u8").tobytes())
            where = folder.rstrip("/") + "/" + os.path.basename(name)
            yield pa.RecordBatch.from_pylist([{"part": part, "file": f"{where}.rec", "index": f"{where}.idx", "first_doc": first,
                                               "records": len(index), "tokens": tokens, "width": enc.dtype.itemsize}], schema=schema)

    import pyarrow as pa

    schema = pa.schema([("part", pa.int64()), ("file", pa.string()), ("index", pa.string()), ("first_doc", pa.int64()),
                        ("records", pa.int64()), ("tokens", pa.int64()), ("width", pa.int32())])
    dealt = docs.select("doc_id", "text").repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    return stored(dealt.mapInArrow(put, MANIFEST), "token-manifest")


def records(path: str, index: str | None = None, order=None):
    """Yields (doc_id, ids) of a file's records, their checksums verified; with
    ``index`` and ``order``, those record numbers in that order."""
    fs, at = filesystem(path)
    with fs.open_input_file(at) as f:
        head = f.read(12)
        if head[:8] != MAGIC:
            raise ValueError(f"{path}: not a token record file")
        dtype = np.dtype(f"<u{struct.unpack("<I", head[8:])[0]}")
        places = iter(())
        if index is not None:
            ifs, iat = filesystem(index)
            with ifs.open_input_stream(iat) as g:
                places = iter(np.frombuffer(g.read(), "<u8")[order].tolist())
        while True:
            if index is not None:
                place = next(places, None)
                if place is None:
                    return
                f.seek(place)
            head = f.read(12)
            if not head:
                return
            size, check = struct.unpack("<QI", head)
            if masked(head[:8]) != check:
                raise ValueError(f"{path}: damaged length")
            payload, check = f.read(size), struct.unpack("<I", f.read(4))[0]
            if masked(payload) != check:
                raise ValueError(f"{path}: damaged record")
            doc, none = struct.unpack_from("<qB", payload)
            yield (None if none else doc), np.frombuffer(payload, dtype, offset=9)


def read(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every record of the manifest's
    files, one task per file; start counts the tokens of all files before."""
    before = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens")

    def get(batches):
        import pyarrow as pa

        for batch in batches:
            for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = []
                for doc, ids in records(file):
                    rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "n_tokens", "ids_crc32"])

    spark = manifest.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = manifest.select("file", "part", "tokens").withColumn("start", before).select("file", "start").repartition(n)
    return files.mapInArrow(get, "doc_id long, start long, n_tokens long, ids_crc32 long")


def roundtrip(docs: DataFrame, folder: str | None = None, vocabulary: str | None = None, end: int = END) -> DataFrame:
    return read(write(docs, folder, vocabulary, end))
