"""Merkle manifest of a dataset by bitmap-rank indexing.

A row is a leaf: the SHA-256 of its fields, each ``-`` if null, else its UTF-8
length, a colon and the value. Leaves of one group (a source) ascend by key
(doc_id); every ``FAN`` consecutive nodes become one until one is left, the
group's subroot. Subroots in the order of the groups (null first, bytewise)
become the root alike.

1. Texts are hashed where they are read; only keys and digests move on.
2. Keys of a group go into bitmap words (64 keys each, joined by OR before the
   shuffle); words of ``WORDS`` neighbours are a compressed container that
   lists its non-empty words. A directory of counts over containers, and over
   runs of ``RUN`` containers again until one run is left, gives each container
   the number of keys before it. No level has a window over more than ``RUN``
   rows.
3. A leaf's coordinate is its container's count, the counts of the words
   before its own and the population of its word below its bit: no sort. Only
   keys that occur twice (and null keys, which come first) are ranked by their
   leaf, in blocks of ``BLOCK`` rows.
4. Coordinates are cut into run and slot. A run's digests sit in an array by
   slot; its hash is the node of the next level. Paths go down again: a node
   hands its own path and its siblings to its slots.

Contracts: equal keys ascend by leaf; a null key comes first; a null group
comes first and differs from an empty one; an empty table has no rows; other
columns are ignored; texts are hashed whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.common import stored

FAN = 16
WORDS, RUN, BLOCK = 16, 1024, 4096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(c: Column) -> Column:
    """A value as its length and text, or ``-``."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(columns: list[Column]) -> Column:
    return digest(*[field(c) for c in columns])


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass
class Manifest:
    """``nodes[l]``: g, run, n, slots (by slot: digest; at level 0 also key and
    the extra columns) and node, the run's hash; ``groups``: g, place, n, top
    (level of the subroot), subroot; ``crown``: levels over the subroots;
    ``root``: one row. All are written tables."""

    nodes: list[DataFrame]
    groups: DataFrame
    crown: list[DataFrame]
    root: str | None


def directory(words: DataFrame) -> DataFrame:
    """(g, c, base, n, words): per container the keys of its group before it,
    and of the group in all."""
    boxes = words.groupBy("g", F.floor(F.col("w") / WORDS).cast("long").alias("c")).agg(
        F.sort_array(F.collect_list(F.struct("w", "bits", "rows"))).alias("words"), F.sum("rows").alias("rows"))
    boxes = stored(boxes, "containers")
    low, high = boxes.agg(F.min("c"), F.max("c")).first() or (None, None)
    levels, span = [], (high or 0) - (low or 0) + 1
    at = boxes.select("g", "c", "rows")
    while True:  # one window per RUN neighbours, then the runs themselves
        before = Window.partitionBy("g", "up").orderBy("c").rowsBetween(Window.unboundedPreceding, -1)
        at = at.withColumn("up", F.floor((F.col("c") - F.lit(low or 0)) / RUN).cast("long"))
        levels.append(at.withColumn("base", F.coalesce(F.sum("rows").over(before), F.lit(0))))
        if span <= RUN:
            break
        span, low = -(-span // RUN), 0
        at = at.groupBy("g", F.col("up").alias("c")).agg(F.sum("rows").alias("rows"))
    totals = levels[-1].groupBy("g").agg(F.sum("rows").alias("n"))
    out = levels[-1].join(totals, "g").select("g", "c", "base", "n")
    for level in reversed(levels[:-1]):
        up = out.select("g", F.col("c").alias("up"), F.col("base").alias("more"), "n")
        out = level.join(up, ["g", "up"]).select("g", "c", (F.col("base") + F.col("more")).alias("base"), "n")
    return boxes.join(out, ["g", "c"]).select("g", "c", "base", "n", "words")


def in_order(df: DataFrame, by: list[str], place: str) -> DataFrame:
    """``place``: a row's number from 0 in its group ``by``, ascending by key,
    leaf and rid. Groups are cut into ranges of leaf digests and equal leaves
    into blocks of rids, about ``BLOCK`` rows each; a block is ranked alone and
    shifted by the rows of those before it."""
    n = F.count(F.lit(1))
    cut = df.join(df.groupBy(*by).agg(n.alias("_n")), by)
    wide, unit = F.col("_n") > BLOCK, F.conv(F.substring("leaf", 1, 8), 16, 10).cast("double") / float(1 << 32)
    block = {"_key": F.coalesce("key", F.lit(0)), "_cut": F.floor(unit * F.ceil(F.col("_n") / BLOCK)), "_leaf": F.when(wide, F.col("leaf")).otherwise(""),
             "_part": F.when(wide, F.shiftright("rid", 12)).otherwise(0)}
    cut = cut.withColumns(block)
    before = F.sum("_rows").over(Window.partitionBy(*by).orderBy(*block)) - F.col("_rows")
    sizes = cut.groupBy(*by, *block).agg(n.alias("_rows")).withColumn("_before", before).drop("_rows")
    own = F.row_number().over(Window.partitionBy(*by, *block).orderBy("leaf", "rid")) - 1
    return cut.join(sizes, [*by, *block]).withColumn(place, own + F.col("_before")).select(*df.columns, place)


def coordinates(leaves: DataFrame) -> DataFrame:
    """``leaves`` (g, key, leaf, rid and more) with n and at, the leaf's place
    in its group."""
    word = F.when(F.col("key").isNull(), F.lit(None)).otherwise(F.shiftright("key", 6))
    some = leaves.filter("key is not null")
    words = some.groupBy("g", word.alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(key & 63 as int)))").alias("bits"), F.count(F.lit(1)).alias("rows"))
    boxes = stored(directory(words), "directory")
    none = leaves.filter("key is null").groupBy("g").agg(F.count(F.lit(1)).alias("none"))
    joined = some.withColumn("w", word).withColumn("c", F.floor(F.col("w") / WORDS).cast("long")).join(boxes, ["g", "c"])
    joined = joined.withColumn("own", F.expr("filter(words, x -> x.w = w)[0]"))
    below = F.expr("bit_count(own.bits & ~shiftleft(-1L, cast(key & 63 as int)))")
    start = F.col("base") + F.expr("aggregate(filter(words, x -> x.w < w), 0L, (a, x) -> a + x.rows)")
    joined = joined.withColumn("start", start).withColumn("below", below).withColumn("clean", F.expr("bit_count(own.bits) = own.rows"))
    keep = [*leaves.columns, "n", "start", "below", "clean"]
    joined = joined.select(*keep, "w")
    clean = joined.filter("clean").withColumn("at", F.col("start") + F.col("below"))
    twice = in_order(joined.filter("not clean"), ["g", "w"], "own_place").withColumn("at", F.col("start") + F.col("own_place"))
    cols = [*leaves.columns, "n", "at"]
    keyed = clean.select(*cols).union(twice.select(*cols))
    first = in_order(leaves.filter("key is null"), ["g"], "at")
    # groups whose keys are all null have no container; null keys shift the others
    totals = boxes.groupBy("g").agg(F.max("n").alias("m")).join(none, "g", "full").select("g", (F.coalesce("m", F.lit(0)) + F.coalesce("none", F.lit(0))).alias("n"), F.coalesce("none", F.lit(0)).alias("none"))
    if none.isEmpty():
        return keyed.select(*leaves.columns, F.col("n").cast("long").alias("n"), F.col("at").cast("long").alias("at"))
    both = keyed.drop("n").withColumn("shift", F.lit(True)).union(first.select(*leaves.columns, "at").withColumn("shift", F.lit(False)))
    return both.join(totals, "g").select(*leaves.columns, F.col("n").cast("long").alias("n"), (F.col("at") + F.when(F.col("shift"), F.col("none")).otherwise(0)).cast("long").alias("at"))


def top_level(n: Column) -> Column:
    """Levels from a leaf to the one node left of ``n``."""
    out = F.lit(0)
    for k in range(15, 0, -1):
        out = F.when(n <= F.lit(FAN ** k), F.lit(k)).otherwise(out) if k < 15 else F.lit(15)
    return F.when(n <= 1, F.lit(0)).otherwise(out)


def reduced(nodes: DataFrame, name: str) -> DataFrame:
    """Runs of ``FAN`` nodes (g, at, n, slot struct ``s`` with ``digest``) as
    arrays in slot order, and the hash of each run."""
    runs = nodes.groupBy("g", F.floor(F.col("at") / FAN).cast("long").alias("run")).agg(F.first("n").alias("n"), F.array_sort(F.collect_list("s")).alias("slots"))
    node = F.when(F.col("n") > 1, digest(F.array_join(F.col("slots.digest"), ""))).otherwise(F.col("slots")[0]["digest"])
    return stored(runs.withColumn("node", node), name)


def tower(first: DataFrame, name: str) -> list[DataFrame]:
    """All levels over the runs ``first``, each a written table; a level holds
    the groups that had several nodes below it."""
    levels, n = [first], first.agg(F.max("n")).first()[0] or 0
    while n > FAN:
        n = -(-n // FAN)
        below = levels[-1].filter(F.col("n") > FAN).select("g", F.col("run").alias("at"), F.ceil(F.col("n") / FAN).cast("long").alias("n"),
                                                            F.struct(F.pmod("run", F.lit(FAN)).cast("int").alias("slot"), F.col("node").alias("digest")).alias("s"))
        levels.append(reduced(below, f"{name}-{len(levels)}"))
    return levels


def build(docs: DataFrame, key: str = "doc_id", group: str = "source", fields=FIELDS, extra: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``; ``extra`` columns stay with the leaves."""
    g = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    more = extra or {}
    leaves = docs.select(g.alias("g"), F.col(key).cast("long").alias("key"), leaf([F.col(c) for c in fields]).alias("leaf"), *[c.alias(k) for k, c in more.items()])
    leaves = stored(leaves.withColumn("rid", F.monotonically_increasing_id()), "leaves")
    placed = coordinates(leaves)
    slot = F.struct(F.pmod("at", F.lit(FAN)).cast("int").alias("slot"), F.col("leaf").alias("digest"), "key", *more)
    nodes = tower(reduced(placed.select("g", "at", "n", slot.alias("s")), "runs"), "level")
    tops = None
    for i, level in enumerate(nodes):
        one = level.filter(F.col("n") <= FAN).select("g", F.col("node").alias("subroot"), (F.lit(i) + F.when(F.col("n") > 1, 1).otherwise(0)).alias("top"))
        tops = one if tops is None else tops.union(one)
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(tops.repartitionByRange(parts, "g").withColumn("part", F.spark_partition_id()), "subroots")
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))  # at most one row per partition
    before = sizes.withColumn("before", F.sum("rows").over(Window.orderBy("part")) - F.col("rows"))
    n = ranged.count()
    groups = ranged.join(F.broadcast(before.select("part", "before")), "part").select(
        "g", "top", "subroot", (F.row_number().over(Window.partitionBy("part").orderBy("g")) - 1 + F.col("before")).cast("long").alias("place"))
    groups = stored(groups, "groups")
    base = groups.select(F.lit("").alias("g"), F.col("place").alias("at"), F.lit(n).cast("long").alias("n"), F.struct(F.pmod("place", F.lit(FAN)).cast("int").alias("slot"), F.col("subroot").alias("digest")).alias("s"))
    crown = tower(reduced(base, "crown"), "crown")
    last = crown[-1].select("node").first()
    return Manifest(nodes, groups, crown, last[0] if last else None)


def _siblings(slots: str = "slots") -> Column:
    """Per slot of a run the step of its path: digests left and right of it."""
    return F.expr(f"transform({slots}, (x, i) -> named_struct('slot', x.slot, 'left', array_join(slice({slots}.digest, 1, i), ''), 'right', array_join(slice({slots}.digest, i + 2, {FAN}), '')))")


def _paths(levels: list[DataFrame], above: DataFrame | None, lowest: int) -> DataFrame | None:
    """(g, at, path) of the nodes of level ``lowest``; ``above`` (g, level,
    path) gives the paths of the groups' last nodes."""
    down = None
    for i in range(len(levels) - 1, lowest - 1, -1):
        runs = levels[i].filter("n > 1")
        start = above.filter(F.col("level") == i + 1).select("g", F.lit(0).cast("long").alias("run"), "path")
        up = start if down is None else start.union(down.select("g", F.col("at").alias("run"), "path"))
        down = runs.join(up, ["g", "run"]).select("g", "run", "path", F.explode(_siblings()).alias("s"))
        down = down.select("g", (F.col("run") * FAN + F.col("s.slot")).alias("at"), F.concat(F.array(F.struct("s.left", "s.right")), F.col("path")).alias("path"))
    return down


def proofs(m: Manifest) -> DataFrame:
    """Per leaf its slot's columns (``s``), g, subroot and path: the digests
    left and right of it, level by level up to the root."""
    empty = F.array().cast("array<struct<left:string,right:string>>")
    apex = m.groups.sparkSession.range(1).select(F.lit("").alias("g"), F.lit(len(m.crown)).alias("level"), empty.alias("path"))
    crown = _paths(m.crown, apex, 0)  # a lone subroot has no run and no path
    tops = m.groups.withColumnRenamed("place", "at").join(crown.select("at", "path"), "at", "left").select("g", "top", "subroot", F.coalesce("path", empty).alias("path"))
    tops = stored(tops, "crown-paths")
    level_one = _paths(m.nodes, tops.select("g", F.col("top").alias("level"), "path"), 1)
    whole = tops.filter("top <= 1").select("g", F.lit(0).cast("long").alias("run"), "path")
    up = whole if level_one is None else whole.union(level_one.select("g", F.col("at").alias("run"), "path"))
    runs = m.nodes[0].join(up, ["g", "run"]).join(tops.select("g", "subroot"), "g")
    one = F.when(F.col("n") > 1, F.concat(F.array(F.struct("i.left", "i.right")), F.col("path"))).otherwise(F.col("path"))
    each = runs.select("g", "n", "subroot", "path", F.explode(F.arrays_zip("slots", _siblings().alias("i"))).alias("z"))
    return each.select("g", "n", "subroot", "path", F.col("z.slots").alias("s"), F.col("z.i").alias("i")).select("g", "subroot", "s", one.alias("path"))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda a, p: digest(p["left"], a, p["right"]))


def audit(docs: DataFrame, every: int = 5, fields=FIELDS) -> DataFrame:
    """A leaf, proof and folded root per row of ``docs``. Where ``every``
    divides the CRC-32 of the decimal doc_id, the fold starts from a copy of
    the row with a lower-cased text; ``verified`` tells whether it still gives
    the root."""
    touched = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(every)) == 0
    changed = leaf([ascii_lower(F.col(c)) if c == "text" else F.col(c) for c in fields])
    m = build(docs, fields=fields, extra={"changed": F.when(touched, changed)})
    out = proofs(m).select(
        F.col("s.key").alias("doc_id"), F.col("s.digest").alias("leaf"), "subroot", F.lit(m.root).alias("root"),
        F.sha2(F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), "").cast("binary"), 256).alias("proof_sha256"),
        fold(F.coalesce("s.changed", "s.digest"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def audit_sql(levels: int = 5) -> str:
    """DuckDB SQL of ``audit`` for groups of at most 16 ** levels rows, and
    ids that occur once."""
    f = lambda c: f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    low = "replace(text, 'A', 'a')"
    for c in "BCDEFGHIJKLMNOPQRSTUVWXYZ":
        low = f"replace({low}, '{c}', '{c.lower()}')"
    head = " || ".join(f(c) for c in ("doc_id", "source", "lang", "n_chars"))
    sql = [f"""WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))) AS t),
d AS (SELECT doc_id, coalesce('=' || source, '') AS g, sha256({head} || {f('text')}) AS leaf, sha256({head} || {f(low)}) AS low,
    xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS crc FROM documents, tab),
n0 AS (SELECT g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf AS h, count(*) OVER (PARTITION BY g) AS n, doc_id, leaf, CASE WHEN crc % 5 = 0 THEN low ELSE leaf END AS x FROM d)"""]

    def climb(node: str, steps: int, key: str) -> str:
        for k in range(steps):
            sql.append(f"{node}{k + 1} AS (SELECT {key}, i // 16 AS i, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h, (any_value(n) + 15) // 16 AS n FROM {node}{k} GROUP BY {key}, i // 16)")
        return f"{node}{steps}"

    top = climb("n", levels, "g")
    sql.append(f"s0 AS (SELECT 0 AS z, row_number() OVER (ORDER BY g) - 1 AS i, h, count(*) OVER () AS n, g, h AS subroot FROM {top})")
    peak = climb("s", levels, "z")
    steps, cols = [], []
    for node, key, n in (("n", "g", levels), ("s", "z", levels)):
        for k in range(n):
            sql.append(f"{node}b{k} AS (SELECT a.{key}, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r, any_value(a.n) AS n FROM {node}{k} a JOIN {node}{k} b ON a.{key} = b.{key} AND a.i // 16 = b.i // 16 GROUP BY a.{key}, a.i)")
            where = f"{node}b{k}.{key} = " + ("q.g" if node == "n" else "0") + f" AND {node}b{k}.i = " + (f"q.i // {16 ** k}" if node == "n" else f"q.si // {16 ** k}")
            steps.append(f"JOIN {node}b{k} ON {where}")
            cols.append(f"{node}b{k}")
    sql.append("q AS (SELECT n0.*, s0.i AS si, s0.subroot FROM n0 JOIN s0 ON n0.g = s0.g)")
    proof = " || ".join(f"{c}.l || {c}.r" for c in cols)
    sql.append(f"p AS (SELECT q.*, sha256({proof}) AS proof_sha256, [" + ", ".join(f"struct_pack(l := {c}.l, r := {c}.r, n := {c}.n)" for c in cols) + f"] AS path FROM q {' '.join(steps)})")
    for k in range(len(cols)):
        prev = "p" if k == 0 else f"f{k - 1}"
        x = "x" if k == 0 else "y"
        sql.append(f"f{k} AS (SELECT {prev}.* {'' if k == 0 else 'EXCLUDE (y)'}, CASE WHEN path[{k + 1}].n > 1 THEN sha256(path[{k + 1}].l || {x} || path[{k + 1}].r) ELSE {x} END AS y FROM {prev})")
    return ",\n".join(sql) + f"\nSELECT doc_id, leaf, subroot, (SELECT h FROM {peak}) AS root, proof_sha256, y AS folded_root, y = (SELECT h FROM {peak}) AS verified FROM f{len(cols) - 1}"
