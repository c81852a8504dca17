"""Conversation prefix trie, built with burst tries.

A conversation is the sequence of its turns; every distinct sequence of first
turns is a node. A turn's id is 16 bytes of the SHA-256 of role and text, so
texts stay where they are read and a sequence is a string of ids.

1. Equal sequences become one with a count, the smallest conv_id and the hash
   of all their ids. Ids are joined in blocks of ``BLOCK`` neighbours first;
   a task streams the blocks of a sequence in order.
2. All sequences are suffixes in one container under the root. A container of
   more than ``LIMIT`` suffixes bursts: its head becomes a node, each suffix
   goes under the head that its next turn id extends. Counts decide in Spark,
   round by round, until no container is over the limit.
3. The other containers are sorted by head and suffix and swept: a stack of
   open nodes follows the shared prefix of neighbours, and a node that closes
   hands its sums to its parent. A task holds one container's nodes.
4. Burst heads sum up their children's top nodes, deepest heads first.

Contracts: turns ascend (null first), equal turn numbers by their id; a null
role or text is empty; rows with a null conv_id belong to no conversation; a
conversation without turns is a member of the root alone; an empty table has
no node; other columns are ignored. A conversation's ids (24 bytes a turn)
are one row.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import discard, stored

LIMIT, BLOCK = 256, 4096
WIDTH = 16  # bytes of a turn id
NODES = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends_sha256 string, top boolean, parent binary")
NONE = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """conv, t: the conversation's turns in order, each with id and chars."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    tid = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * WIDTH)
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv"), F.struct("turn", F.unhex(tid).alias("id"), F.length(text).cast("long").alias("chars")).alias("t"))
    return rows.groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("t"))


def rebuilt(conversations: DataFrame, family: int = 100, most: int = 6) -> DataFrame:
    """Every conversation c with its first h turns taken from conversation
    c - c % family, h = crc32(decimal c) % most."""
    own = stored(turns(conversations), "turns")
    first = own.filter(F.col("conv") % family == 0).select(F.col("conv").alias("root"), F.slice("t", 1, most - 1).alias("head"))
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(most)).cast("int")
    return (own.withColumn("root", F.col("conv") - F.col("conv") % family).join(first, "root", "left").withColumn("h", h)
            .select("conv", F.expr("concat(slice(coalesce(head, array()), 1, h), slice(t, h + 1, size(t)))").alias("t")))


def sequences(conversations: DataFrame) -> DataFrame:
    """One row per different sequence of (conv, t): seq (ids joined), chars,
    m (conversations), conv (the smallest), ends (hash of all)."""
    spark = conversations.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    flat = conversations.select("conv", F.unhex(F.array_join(F.transform("t", lambda x: F.hex(x["id"])), "")).alias("seq"), F.col("t.chars").alias("chars"))
    blocks = (flat.withColumn("key", F.sha2("seq", 256)).withColumn("block", F.floor(F.col("conv") / BLOCK).cast("long"))
              .groupBy("key", "block").agg(F.first("seq").alias("seq"), F.first("chars").alias("chars"), F.array_sort(F.collect_list("conv")).alias("convs"))
              .select("key", "block", "seq", "chars", F.size("convs").cast("long").alias("m"), F.col("convs")[0].alias("conv"), F.array_join(F.transform("convs", lambda c: c.cast("string")), ",").alias("ids")))

    def stream(batches):
        import pyarrow as pa

        last = None
        names = ["seq", "chars", "m", "conv", "ends"]
        for batch in batches:
            done = []
            for key, _, seq, chars, m, conv, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if last and last[0] == key:
                    last[3] += m
                    last[5].update(b"," + ids.encode())
                else:
                    if last:
                        done.append((*last[1:5], last[5].hexdigest()))
                    last = [key, seq, chars, m, conv, hashlib.sha256(ids.encode())]
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(names, d, strict=True)) for d in done], schema=schema(pa))
        if last:
            yield pa.RecordBatch.from_pylist([dict(zip(names, (*last[1:5], last[5].hexdigest()), strict=True))], schema=schema(pa))

    def schema(pa):
        return pa.schema([("seq", pa.binary()), ("chars", pa.list_(pa.int64())), ("m", pa.int64()), ("conv", pa.int64()), ("ends", pa.string())])

    return blocks.repartition(n, "key").sortWithinPartitions("key", "block").mapInArrow(stream, "seq binary, chars array<long>, m long, conv long, ends string")


def burst(seqs: DataFrame, limit: int = LIMIT) -> tuple[list[DataFrame], DataFrame]:
    """(heads, containers): per round the heads that burst (head, depth, conv,
    n, chars, ends, parent, above), and the suffixes of all other containers
    with their head, its depth and its parent's head and smallest conv_id."""
    heads, rest = [], []
    live = seqs.select("*", F.lit(b"").alias("head"), F.lit(None).cast("binary").alias("parent"), F.lit(None).cast("long").alias("above"))
    depth = 0
    while True:
        ended = F.octet_length("seq") == depth * WIDTH
        over = live.groupBy("head").agg(F.count(F.lit(1)).alias("rows"), F.min("conv").alias("low"), F.sum("m").alias("n"), F.first("parent").alias("parent"), F.first("above").alias("above"),
                                        F.max(F.get("chars", F.lit(depth - 1)) if depth else F.lit(0)).alias("own"), F.max(F.when(ended, F.col("ends"))).alias("done")).filter(F.col("rows") > limit)
        over = stored(over, f"heads-{depth}")
        if over.isEmpty():
            rest.append(live.withColumn("depth", F.lit(depth)))
            break
        heads.append(over.withColumn("depth", F.lit(depth)))
        if depth:  # at most rows / limit heads burst; the join is broadcast only where their measured size is small
            rest.append(live.join(over.select("head"), "head", "left_anti").withColumn("depth", F.lit(depth)))
            went = live.drop("parent", "above").join(over.select("head", F.col("low").alias("above")), "head").filter(~ended)
        else:  # every suffix is under the root
            went = live.withColumn("above", F.lit(over.first()["low"])).filter(~ended)
        depth += 1
        at = F.substring("seq", 1, depth * WIDTH)
        live = stored(went.select("seq", "chars", "m", "conv", "ends", at.alias("head"), F.col("head").alias("parent"), "above"), f"containers-{depth}")
    names = ["head", "depth", "parent", "above", "seq", "chars", "m", "conv", "ends"]
    out = rest[0].select(*names)
    for r in rest[1:]:
        out = out.union(r.select(*names))
    return heads, out


def swept(containers: DataFrame) -> DataFrame:
    """The nodes of every container; ``top`` marks a container's head."""
    spark = containers.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def sweep(rows):
        """Nodes of one container's rows, sorted by suffix."""
        _, start, parent, above = rows[0][:4]
        out, stack, last = [], [], None
        # an open node: depth, smallest, members, children, leaves, saved, chars, ends, its closed children's places in out

        def close():
            depth, low, n, kids, leaves, saved, chars, ends, places = stack.pop()
            saved += (n - 1) * chars
            leaves = leaves or 1
            for p in places:
                out[p][2] = low
            out.append([low, depth, None, n, kids, leaves, saved, ends, False, None])
            if stack:
                up = stack[-1]
                up[1] = min(up[1], low)
                up[2] += n
                up[3] += 1
                up[4] += leaves
                up[5] += saved
                up[8].append(len(out) - 1)

        for row in rows:
            seq, chars, m, conv, ends = row[4:]
            size, shared = len(seq) // WIDTH, start
            if last is not None:
                most = min(len(last), len(seq))
                while (shared + 1) * WIDTH <= most and last[shared * WIDTH:(shared + 1) * WIDTH] == seq[shared * WIDTH:(shared + 1) * WIDTH]:
                    shared += 1
                while stack[-1][0] > shared:
                    close()
            for d in range(shared if last is not None else start - 1, size):
                stack.append([d + 1, conv, 0, 0, 0, 0, chars[d] if d >= 0 else 0, NONE, []])
            end = stack[-1]
            end[1], end[7] = min(end[1], conv), ends
            end[2] += m
            last = seq
        while stack:
            close()
        out[-1][2], out[-1][8], out[-1][9] = above, True, parent
        return out

    def run(batches):
        import pyarrow as pa

        schema = pa.schema([*[(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")],
                            ("ends_sha256", pa.string()), ("top", pa.bool_()), ("parent", pa.binary())])

        def batch_of(nodes):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*nodes, strict=True), schema, strict=True)], schema=schema)

        rows, ready = [], []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if rows and rows[0][0] != row[0]:
                    ready += sweep(rows)
                    rows = []
                rows.append(row)
            if ready:
                yield batch_of(ready)
                ready = []
        if rows:
            yield batch_of(sweep(rows))

    return containers.repartition(n, "head").sortWithinPartitions("head", "seq").mapInArrow(run, NODES)


def trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The nodes of (conv, t)."""
    seqs = stored(sequences(conversations), "sequences")
    heads, containers = burst(seqs, limit)
    nodes = stored(swept(containers), "nodes")
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    tops = nodes.filter("top").select("depth", "parent", "n_leaves", "saved_tokens")
    out = nodes.select(*cols)
    for i, over in reversed(list(enumerate(heads))):
        sums = tops.filter(F.col("depth") == i + 1).groupBy(F.col("parent").alias("head")).agg(F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"))
        got = over.join(sums, "head").withColumn("saved_tokens", F.col("below") + (F.col("n") - 1) * F.col("own"))
        got = stored(got.select(F.col("low").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.col("above").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens",
                                F.coalesce("done", F.lit(NONE)).alias("ends_sha256"), "parent"), f"burst-{i}")
        out = out.union(got.select(*cols))
        tops = tops.union(got.select("depth", "parent", "n_leaves", "saved_tokens"))
    discard(seqs)
    return out


def rebuilt_trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    return trie(rebuilt(conversations), limit)


NODE_SQL = """
WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))) AS t),
o AS (SELECT conv_id AS c, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS l FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT c, l, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295) % 6 AS h FROM o, tab),
s AS (SELECT h.c, coalesce(b.l, [])[1:h] || h.l[h + 1:] AS l FROM h LEFT JOIN o b ON b.c = h.c - h.c % 100),
p AS (SELECT c, l[1:d] AS k, d, len(l) AS n, CASE WHEN d > 0 THEN length(l[d].x) ELSE 0 END AS z FROM (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM s)),
v AS (SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, any_value(z) AS z, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (d = n), '')) AS ends_sha256 FROM p GROUP BY k, d),
u AS (SELECT k[1:d - 1] AS k, count(*) AS kids FROM v WHERE d > 0 GROUP BY 1),
w AS (SELECT v.*, coalesce(u.kids, 0) AS kids FROM v LEFT JOIN u ON u.k = v.k),
a AS (SELECT k[1:e] AS k, sum(CASE WHEN kids = 0 THEN 1 ELSE 0 END) AS leaves, sum((n_convs - 1) * z) AS saved FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM w) GROUP BY 1)
SELECT w.conv_id, CAST(w.d AS BIGINT) AS depth, q.conv_id AS parent_conv_id, CAST(w.n_convs AS BIGINT) AS n_convs, CAST(w.kids AS BIGINT) AS n_children,
    CAST(a.leaves AS BIGINT) AS n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens, w.ends_sha256
FROM w JOIN a ON a.k = w.k LEFT JOIN v q ON w.d > 0 AND q.k = w.k[1:w.d - 1]"""
