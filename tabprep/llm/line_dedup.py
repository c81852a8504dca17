"""Line dedup by a segment-partition edit join (native).

A line of at least ``LEAST`` bytes goes if an equal line, or one within
``EDITS`` edits, starts earlier in the order of doc_id and line number; lines
are judged on the input, not on what is left. Edits are of UTF-8 bytes.

1. Lines are hashed; equal lines meet once and keep their first place.
2. A line is cut into EDITS + 1 even segments. Of two lines within EDITS
   edits one segment of the shorter occurs in the longer, at a place that the
   segment's number and the difference in length bound. The keys of the
   segments are the index; the keys of those substrings of a line, for each
   length it may meet, are the probes. Keys hold length and segment number.
   A line's own segments serve as its probes for equal lengths at their place.
3. Where keys meet, counts of a few bytes must agree to 2 * EDITS, inside the
   join, so segments that many lines share do not spread into pairs.
4. Pairs left fetch their texts and are verified by an edit distance in a
   band, bit-parallel: one integer holds a column's vertical differences in
   the band, and a step of a few operations goes to the next column.

Contracts: lines are what a newline splits; shorter lines always stay; a null
or empty text has one empty line and loses nothing; a null doc_id comes last;
repeated rows do not remove each other's line of the same number; an empty
table gives none; extra columns pass untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import apart, discard, stored

EDITS, LEAST = 2, 20
COUNTED = (" ", "e", "n", "t", "a", "i", "o", "r", "s", "h")
FIELD = 64  # counts are kept modulo this, six bits each
CELLS = 1 << 20


def segment(length: Column, i: int, parts: int) -> tuple[Column, Column]:
    """(start, size) of the i-th of ``parts`` even segments, 1-based; the
    last ``length % parts`` are one longer."""
    base, short = F.floor(length / parts), parts - length % parts
    start = 1 + (i - 1) * base + F.greatest(F.lit(0), (i - 1) - short)
    return start.cast("int"), (base + F.when(F.lit(i) > short, 1).otherwise(0)).cast("int")


def probe_places(edits: int) -> list[tuple[int, int, int]]:
    """(difference in length, segment, offset) of the substrings to probe."""
    out = []
    for diff in range(edits + 1):
        for i in range(1, edits + 2):
            left, right = i - 1, edits + 1 - i
            out += [(diff, i, off) for off in range(max(-left, diff - right), min(left, diff + right) + 1)]
    return out


def lines_of(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Lines long enough: doc, th (hash of the text), pos, line, place (doc
    and pos as one number), size (bytes), h1 and h2."""
    text = F.coalesce("text", F.lit(""))
    doc = F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1))
    out = docs.select(doc.alias("doc"), F.xxhash64(text).alias("th"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    out = out.withColumn("size", F.octet_length("line")).filter(F.col("size") >= least)
    return (out.withColumn("place", F.col("doc").cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(12,0)") + F.col("pos").cast("decimal(10,0)"))
            .withColumn("h1", F.xxhash64("line")).withColumn("h2", F.xxhash64(F.lit(1), F.col("line"))))


def byte_counts(line: Column) -> Column:
    """Counts of ``COUNTED`` modulo ``FIELD`` in one number (modulo keeps the
    filter lossless: it compares differences modulo as well)."""
    out = F.lit(0).cast("bigint")
    for c in COUNTED:
        n = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(c), F.lit("")))
        out = out * FIELD + F.pmod(n, F.lit(FIELD)).cast("bigint")
    return out


def counts_agree(a: Column, b: Column, edits: int) -> Column:
    total = F.lit(0)
    for k in range(len(COUNTED)):
        d = F.pmod(F.shiftright(a, 6 * k) - F.shiftright(b, 6 * k), F.lit(FIELD))
        total = total + F.least(d, FIELD - d)
    return total <= 2 * edits


def edit_distance(a: Column, b: Column, edits: int) -> Column:
    """Edit distance of two binary columns, ``size(a) >= size(b)``, right up to
    ``edits`` and larger than ``edits`` beyond it.

    Bits of the band of column j stand for rows j - edits .. j + edits. ``vp``
    and ``vn`` mark rows whose value is one more or one less than the row
    above. A step compares the column's byte with the band's rows, finds the
    cells that equal their upper-left neighbour (``d0``) by one addition, and
    moves the band down a row. The distance is followed along the diagonal
    that ends in the last cell. Equal ends are cut off first.
    """
    width = 2 * edits + 1
    full = (1 << width) - 1

    def shared(x: Column, y: Column, most: Column, at_end: bool) -> Column:
        def step(p: Column, k: Column) -> Column:
            n = p + k
            same = (F.right(x, n) == F.right(y, n)) if at_end else (F.left(x, n) == F.left(y, n))
            return F.when((n <= most) & same, n).otherwise(p)
        return F.aggregate(F.array(*[F.lit(1 << k) for k in range(30, -1, -1)]), F.lit(0), step)

    def of(s: Column) -> Column:
        m, n = F.length(s["a"]), F.length(s["b"])
        slope = m - n
        rows = lambda j: sum((F.when((j - edits + k >= 1) & (F.substring(s["a"], j - edits + k, F.lit(1)) == F.substring(s["b"], j, F.lit(1))), 1 << k).otherwise(0) for k in range(width)), F.lit(0))

        def step(acc: Column, j: Column) -> Column:
            def after(x: Column) -> Column:
                pm, vp, vn = x["pm"], acc["vp"], acc["vn"]
                d0 = ((pm.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(pm).bitwiseOR(vn).bitwiseAND(full)
                hp = vn.bitwiseOR(F.bitwise_not(d0.bitwiseOR(vp)).bitwiseAND(full))
                hn = d0.bitwiseAND(vp)
                down = F.shiftright(d0, 1)
                return F.struct(hn.bitwiseOR(F.bitwise_not(down.bitwiseOR(hp)).bitwiseAND(full)).alias("vp"), down.bitwiseAND(hp).alias("vn"),
                                (acc["d"] + F.when(F.get(F.array(*[d0.bitwiseAND(1 << (edits + k)) > 0 for k in range(edits + 1)]), slope), 0).otherwise(1)).alias("d"))
            moved = F.get(F.transform(F.array(F.struct(rows(j).alias("pm"))), after), 0)
            return F.when(acc["d"] > edits, acc).otherwise(moved)

        begin = F.struct(F.lit(full & ~((1 << edits) - 1)).alias("vp"), F.lit(0).alias("vn"), slope.alias("d"))
        walk = F.aggregate(F.sequence(F.lit(1), n), begin, step, lambda acc: acc["d"])
        return F.when(slope > edits, F.lit(edits + 1)).when(n == 0, slope).otherwise(walk)

    def cut(s: Column) -> Column:
        left = shared(s["a"], s["b"], F.length(s["b"]), False)
        x = F.struct(F.substring(s["a"], left + 1, F.length(s["a"])).alias("a"), F.substring(s["b"], left + 1, F.length(s["b"])).alias("b"))
        return x

    def cut_end(s: Column) -> Column:
        right = shared(s["a"], s["b"], F.length(s["b"]), True)
        return F.struct(F.left(s["a"], F.length(s["a"]) - right).alias("a"), F.left(s["b"], F.length(s["b"]) - right).alias("b"))

    one = F.array(F.struct(a.alias("a"), b.alias("b")))
    return F.get(F.transform(F.transform(F.transform(one, cut), cut_end), of), 0)


def different(lines: DataFrame) -> DataFrame:
    """One row per different line: h1, h2, line, first (its first place),
    times and sig (its byte counts)."""
    return lines.groupBy("h1", "h2", "line").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("times")).withColumn("sig", byte_counts(F.col("line")))


SAME = 1 << 62  # set in a probe's counts: the probe is for lines of its own length


def keys(each: DataFrame, edits: int = EDITS) -> tuple[DataFrame, DataFrame]:
    """(index, probes): rows of h1, counts and key. A line's own segments are
    in the index; they are also its probes for equal lengths at their own
    place, so the probes leave those out."""
    b, size, parts = F.col("line").cast("binary"), F.octet_length("line"), edits + 1

    def key(i: int, length: Column, off: int) -> Column:
        start, n = segment(length, i, parts)
        return F.xxhash64(F.lit(i), length, F.substring(b, start + off, n))

    n = int(each.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = each.select("h1", "sig", "line")
    # dealt by key once, for the two joins that read it three times
    index = rows.select("h1", "sig", F.explode(F.array(*[key(i, size, 0) for i in range(1, parts + 1)])).alias("key")).repartition(n, "key")
    places = [(diff, i, off) for diff, i, off in probe_places(edits) if diff or off]
    alike = F.array(*[key(i, size, off) for diff, i, off in places if not diff])
    longer = F.array(*[key(i, size - diff, off) for diff, i, off in places if diff])
    marked = lambda arr, same: F.transform(arr, lambda k: F.struct(k.alias("key"), (F.col("sig") + F.lit(SAME if same else 0)).alias("rsig")))
    probes = rows.select(F.col("h1").alias("r"), F.explode(F.concat(marked(alike, True), marked(longer, False))).alias("p")).select("r", "p.rsig", "p.key")
    return index, probes


def near_lines(docs: DataFrame, edits: int = EDITS, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lines, earliest): the lines, and for each different line that occurs
    twice or has a near one (h1, h2) the earliest place of those."""
    lines = lines_of(docs, least)
    each = stored(different(lines), "lines")
    index, probes = keys(each, edits)
    own = index.select(F.col("h1").alias("r"), F.col("sig").alias("rsig"), F.col("key").alias("rkey"))
    alike = index.join(own, (F.col("key") == F.col("rkey")) & (F.col("h1") < F.col("r")) & counts_agree(F.col("sig"), F.col("rsig"), edits))
    probes = probes.withColumnRenamed("key", "rkey")
    other = F.when(F.col("rsig") >= SAME, F.col("h1") < F.col("r")).otherwise(F.col("h1") != F.col("r"))
    apart = index.join(probes, (F.col("key") == F.col("rkey")) & other & counts_agree(F.col("sig"), F.col("rsig"), edits))
    pairs = stored(alike.select(F.col("h1").alias("s"), "r").union(apart.select(F.col("h1").alias("s"), "r")).distinct(), "line-pairs")
    ids = pairs.select(F.col("s").alias("h")).union(pairs.select("r")).distinct()
    # a table of at most CELLS hash cells spares most other lines the shuffle
    few = F.broadcast(ids.select(_cell(F.col("h")).alias("cell")).distinct())
    texts = each.withColumn("cell", _cell(F.col("h1"))).join(few, "cell", "left_semi").join(ids, F.col("h1") == F.col("h"), "left_semi")
    texts = stored(texts.select("h1", "h2", F.col("line").cast("binary").alias("line"), "first"), "line-texts")
    of = lambda p: texts.select(*[F.col(c).alias(f"{p}_{c}") for c in ("h1", "h2", "line", "first")])
    both = pairs.join(of("s"), F.col("s") == F.col("s_h1")).join(of("r"), F.col("r") == F.col("r_h1"))
    # a pair is found from the shorter line's segments: the longer comes first
    long = F.octet_length("r_line") >= F.octet_length("s_line")
    near = both.filter(edit_distance(F.when(long, F.col("r_line")).otherwise(F.col("s_line")), F.when(long, F.col("s_line")).otherwise(F.col("r_line")), edits) <= edits)
    swap = F.col("s_first") < F.col("r_first")
    late = near.select(F.when(swap, F.col("r_h1")).otherwise(F.col("s_h1")).alias("h1"), F.when(swap, F.col("r_h2")).otherwise(F.col("s_h2")).alias("h2"), F.least("s_first", "r_first").alias("earliest"))
    again = each.filter("times > 1").select("h1", "h2", F.col("first").alias("earliest"))
    earliest = stored(again.union(late).groupBy("h1", "h2").agg(F.min("earliest").alias("earliest")), "line-earliest")
    discard(each, pairs, texts)
    return lines, earliest


def _cell(c: Column) -> Column:
    return F.pmod(c, F.lit(CELLS))


def removed_lines(docs: DataFrame, edits: int = EDITS, least: int = LEAST) -> DataFrame:
    """(doc, th, gone): ascending line numbers that a document loses."""
    lines, earliest = near_lines(docs, edits, least)
    few = F.broadcast(earliest.select(_cell(F.col("h1")).alias("cell")).distinct())
    gone = lines.select("doc", "th", "pos", "place", "h1", "h2", _cell(F.col("h1")).alias("cell")).join(few, "cell", "left_semi").drop("cell").join(earliest, ["h1", "h2"]).filter("earliest < place")
    return gone.groupBy("doc", "th").agg(F.sort_array(F.collect_set("pos")).alias("gone"))


def _keys(docs: DataFrame) -> DataFrame:
    return (docs.withColumn("_doc", F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1)))
            .withColumn("_th", F.xxhash64(F.coalesce("text", F.lit("")))))


def report(docs: DataFrame, edits: int = EDITS, least: int = LEAST) -> DataFrame:
    """doc_id, n_lines, n_removed, removed (line numbers, comma-joined)."""
    gone = removed_lines(docs, edits, least).select(F.col("doc").alias("_doc"), F.col("th").alias("_th"), "gone")
    d = _keys(docs.select("doc_id", "text")).withColumn("n_lines", F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("bigint")).drop("text")
    return (d.join(gone, ["_doc", "_th"], "left")
            .select("doc_id", "n_lines", F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"),
                    F.coalesce(F.array_join(F.transform("gone", lambda p: p.cast("string")), ","), F.lit("")).alias("removed")))


def dedup(docs: DataFrame, edits: int = EDITS, least: int = LEAST) -> DataFrame:
    """``docs`` with the removed lines cut from ``text``; a document left
    without any non-empty line keeps an empty text. Documents without removed
    lines do not move: a bounded table of hash cells tells most of them."""
    return apart(docs, ("doc_id", "text"), lambda d: _dedup(d, edits, least))


def _dedup(docs: DataFrame, edits: int, least: int) -> DataFrame:
    gone = stored(removed_lines(docs, edits, least).select(F.col("doc").alias("_doc"), F.col("th").alias("_th"), F.col("gone").alias("_gone")), "gone-lines")
    d = _keys(docs).withColumn("_cell", F.pmod(F.xxhash64("_doc"), F.lit(CELLS)))
    few = F.broadcast(gone.select(F.pmod(F.xxhash64("_doc"), F.lit(CELLS)).alias("_cell")).distinct())
    held = d.join(few, "_cell", "left_anti").select(*docs.columns)
    parts = F.split(F.col("text"), "\n", -1)
    left = F.filter(F.transform(parts, lambda x, i: F.when(F.array_contains("_gone", i), None).otherwise(x)), lambda x: x.isNotNull())
    cut = (d.join(few, "_cell", "left_semi").join(gone, ["_doc", "_th"], "left")
           .withColumn("text", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))).select(*docs.columns))
    return held.union(cut)


REMOVED_SQL = r"""
WITH x AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
p AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM x),
o AS (SELECT *, strlen(line) AS n FROM p WHERE strlen(line) >= 20),
f AS (SELECT line, any_value(n) AS n, min(struct_pack(d := doc_id, p := pos)) AS first_, len(line) - len(replace(line, ' ', '')) AS c1,
    len(line) - len(replace(line, 'e', '')) AS c2, len(line) - len(replace(line, 'n', '')) AS c3, len(line) - len(replace(line, 't', '')) AS c4 FROM o GROUP BY line),
m AS (SELECT b.line, min(a.first_) AS first_ FROM f a JOIN f b ON a.n BETWEEN b.n - 2 AND b.n + 2
    AND abs(a.c1 - b.c1) + abs(a.c2 - b.c2) + abs(a.c3 - b.c3) + abs(a.c4 - b.c4) <= 4 AND (a.line = b.line OR levenshtein(a.line, b.line) <= 2) GROUP BY b.line),
g AS (SELECT o.doc_id, o.pos FROM o JOIN m ON m.line = o.line WHERE m.first_ < struct_pack(d := o.doc_id, p := o.pos)),
r AS (SELECT doc_id, count(*) AS n, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS removed FROM g GROUP BY doc_id)
SELECT x.doc_id, CAST(len(l) AS BIGINT) AS n_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_removed, coalesce(r.removed, '') AS removed FROM x LEFT JOIN r ON r.doc_id = x.doc_id"""
