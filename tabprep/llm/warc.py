"""WARC archives: writing captures, and assembling them from their records.

A capture is one transaction: a ``response`` (or, for a payload that an
earlier capture holds, a ``revisit``), its ``request`` and a ``metadata``
record, tied to the response by WARC-Concurrent-To. Reading joins the records
of a capture through those identifiers, wherever they lie, and gives one
nested row per capture; the payload of a revisit is looked up through
WARC-Refers-To.

Archives are gzip members, one per record, as the format recommends. Files
are named by attempt and listed in a manifest, so a task that runs twice
leaves no double. Contracts: a null payload is empty; payloads under
``LEAST`` bytes are always responses; among equal payloads the smallest key
is the response; every row is a capture of its own, known by its key, its
payload and its number among the rows that share both (by uri), so null and
repeated keys lose none; a revisit refers to the first response of its
payload's smallest key; an empty table writes no file; a request or metadata
record without a response is left out, a response without them has nulls
there; extra columns are ignored. A null key takes no part in revisits.
"""

from __future__ import annotations

import uuid
import zlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.common import arrow_batches, shared_path, stored
from tabprep.llm.token_records import filesystem

LEAST = 100
BATCH = 256  # pages that Python holds at a time
RECORD = "kind string, record_id string, concurrent_to string, refers_to string, uri string, digest string, length long, block_sha256 string, block binary"
AGENT = "GET {path} HTTP/1.1\r\nHost: {host}\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def record_id(key, digest: str, number: int, kind: str) -> str:
    """A stable identifier: reruns write the same ids."""
    name = "" if key is None else f"key {key}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'capture:{name}:{digest}:{number}:{kind}')}>"


def plan(pages: DataFrame) -> DataFrame:
    """key, uri, payload, digest, original (key of the response that a revisit
    refers to, else null), number (among the rows of a key and payload, by
    uri). Only keys and digests are shuffled to decide; payloads move once, by
    key and digest."""
    p = (pages.select(F.col("page_id").alias("key"), F.coalesce("url", F.lit("")).alias("uri"), F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
         .withColumn("digest", F.sha2("payload", 256)).withColumn("name", F.coalesce(F.concat(F.lit("k"), F.col("key").cast("string")), F.lit(""))))
    held = p.filter(F.length("payload") >= LEAST).groupBy("digest", "name").agg(F.min("key").alias("_key"))
    first = held.groupBy("digest").agg(F.min("_key").alias("original"))
    again = (held.join(first, "digest").filter(F.col("original") < F.col("_key"))
             .select(F.col("digest").alias("_d"), F.col("name").alias("_n"), "original"))
    same = Window.partitionBy("digest", "name").orderBy("uri")
    return (p.join(again, (F.col("digest") == F.col("_d")) & (F.col("name") == F.col("_n")), "left")
            .withColumn("number", F.row_number().over(same)).drop("_d", "_n", "name"))


def _frame(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in headers], f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def _clean(uri: str) -> str:
    return "".join(c for c in uri if c.isprintable()).strip()


def capture_records(key, uri: str, payload: bytes, digest: str, original, number: int = 1) -> list[bytes]:
    uri = _clean(uri)
    own = lambda kind: record_id(key, digest, number, kind)
    me = own("response")
    common = [("WARC-Date", "2020-01-01T00:00:00Z"), ("WARC-Target-URI", uri)]
    main = [("WARC-Record-ID", me), *common, ("WARC-Payload-Digest", f"sha256:{digest}"), *([] if key is None else [("X-Capture-Key", str(key))])]
    host = uri.split("//")[-1].split("/")[0]
    request = AGENT.format(path=uri, host=host).encode()
    out = [_frame("request", [("WARC-Record-ID", own("request")), *common, ("WARC-Concurrent-To", me)], request)]
    if original is None:
        out.append(_frame("response", main, HTTP + payload))
    else:
        out.append(_frame("revisit", [*main, ("WARC-Refers-To", record_id(original, digest, 1, "response")),
                                      ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")], HTTP))
    out.append(_frame("metadata", [("WARC-Record-ID", own("metadata")), *common, ("WARC-Concurrent-To", me)], b"fetchTimeMs: 0\r\n"))
    return out


def write(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes all captures as archives and returns the manifest (file)."""
    spark = pages.sparkSession
    folder = folder or shared_path(spark, "warc")

    def put(batches):
        import pyarrow as pa

        out = None
        for batch in batches:
            for key, uri, payload, digest, original, number in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if out is None:
                    fs, base = filesystem(folder)
                    fs.create_dir(base, recursive=True)
                    name, count = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                for rec in capture_records(key, uri, payload, digest, original, number):
                    out.write(rec)
                    count += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [folder.rstrip("/") + "/" + name], "records": pa.array([count], pa.int64())})

    rows = plan(pages).select("key", "uri", "payload", "digest", "original", "number")
    with arrow_batches(spark, BATCH):
        return stored(rows.mapInArrow(put, "file string, records long"), "warc-manifest")


def _members(f, size: int = 1 << 16):
    """Decompressed gzip members of a file, one at a time."""
    left = b""
    while True:
        left = left or f.read(size)
        if not left:
            return
        unpack, out = zlib.decompressobj(31), []
        while not unpack.eof:
            left = left or f.read(size)
            if not left:
                raise ValueError("truncated archive")
            out.append(unpack.decompress(left))
            left = unpack.unused_data
        yield b"".join(out)


def parse(record: bytes) -> dict:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    block = rest[:int(fields.get("content-length", 0))]
    fields["block"] = block
    return fields


def records(manifest: DataFrame) -> DataFrame:
    """All records of the archives, with the HTTP body of a response hashed."""

    def get(batches):
        import hashlib

        import pyarrow as pa

        for batch in batches:
            for file in batch.column(0).to_pylist():
                fs, at = filesystem(file)
                rows, held = [], 0
                with fs.open_input_stream(at, compression=None) as f:
                    for raw in _members(f):
                        x = parse(raw)
                        kind, block = x["warc-type"], x["block"]
                        body = block.partition(b"\r\n\r\n")[2] if kind == "response" else b""
                        rows.append((kind, x.get("warc-record-id"), x.get("warc-concurrent-to"), x.get("warc-refers-to"), x.get("warc-target-uri"),
                                     x.get("warc-payload-digest"), len(body), hashlib.sha256(body).hexdigest() if kind == "response" else None,
                                     body if kind == "response" else block, x.get("x-capture-key")))
                        held += len(block)
                        if held > 1 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    import pyarrow as pa

    schema = RECORD + ", capture_key string"
    names = [c.split()[0] for c in schema.split(", ")]
    types = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in schema.split(", ")]
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("file").repartition(n).mapInArrow(get, schema)


def captures(manifest: DataFrame, with_blocks: bool = True) -> DataFrame:
    """One nested row per capture: capture_id, capture_key, uri, record_type,
    payload_bytes, payload_digest, refers_to (capture key), request, metadata
    and, if asked for, payload (null for a revisit).

    Requests and metadata are grouped with their response by the identifier
    they are concurrent to (their own for a response); no group has more than
    the records of one transaction.
    """
    r = records(manifest)
    main = F.col("kind").isin("response", "revisit")
    first = lambda c, k: F.max(F.when(F.col("kind") == k, F.col(c)))
    of = lambda c: F.max(F.when(main, F.col(c)))
    got = (r.withColumn("capture_id", F.when(main, F.col("record_id")).otherwise(F.col("concurrent_to")))
           .withColumn("text", F.when(~main, F.decode("block", "UTF-8"))))
    blocks = [of("block").alias("payload")] if with_blocks else []
    one = got.groupBy("capture_id").agg(
        of("kind").alias("record_type"), of("capture_key").alias("capture_key"), of("uri").alias("uri"), of("refers_to").alias("refers"),
        of("digest").alias("declared"), of("length").alias("length"), of("block_sha256").alias("sha"), first("text", "request").alias("request"),
        first("text", "metadata").alias("metadata"), *blocks).filter("record_type is not null")
    whole = (one.filter("record_type = 'response'")
             .select(F.col("capture_id").alias("_id"), F.col("length").alias("_length"), F.col("sha").alias("_sha"), F.col("capture_key").alias("_key")))
    out = one.join(whole, F.col("refers") == F.col("_id"), "left")
    revisit = F.col("record_type") == "revisit"
    return out.select("capture_id", "capture_key", "uri", "record_type", F.when(revisit, F.col("_length")).otherwise(F.col("length")).alias("payload_bytes"),
                      F.when(revisit, F.col("_sha")).otherwise(F.col("sha")).alias("payload_digest"), F.expr("substring_index(declared, ':', -1)").alias("declared_digest"),
                      F.when(revisit, F.col("_key")).alias("refers_to"), F.struct("request", "metadata").alias("concurrent"), *(["payload"] if with_blocks else []))


PAGE_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, sha256(b) AS payload_digest FROM p),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND first_id < page_id THEN first_id END AS refers_to
FROM m"""
