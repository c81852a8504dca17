"""Mixing sources to target weights by a low-discrepancy schedule (native).

The mix is a sequence of slots. Slot ``j`` has the point ``frac(j * phi)`` of
the golden-ratio sequence; mapped through the cumulative target shares it
names a source, and its rank among that source's slots names the block of the
source it takes. A source's documents lie in a hash-shuffled order on a line
of words; its target words, cut in as many equal blocks as it has slots, run
along that line and, past the end, along it again.

Contracts: a null text has size 0; a null source is a source of its own, last
in order; repeated rows are separate documents; an empty table gives an empty
mix; extra columns are ignored. No window runs over a whole source: words are
summed in ``BUCKETS`` hash buckets per source first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.common import apart, n_words

#: Points of the schedule; blocks grow with the corpus, the schedule does not.
SLOTS = 1 << 16
GOLDEN = 2654435769  # 2**32 / golden ratio, odd
CELLS = 4096
WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words), bucket and h (the shuffled order)."""
    h = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), h.alias("h"),
                       F.substring(h, 1, 3).alias("bucket"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``sizes`` (source, source_size) -> also src (1..), weight, target, lo
    and hi (its interval of cumulative target shares).

    Targets share ``share`` times all words by weight; a target stops at
    ``cap`` times its source's words and the excess goes to the others by
    weight until none is above. That fixed point is a water level: with ratio
    = cap words / weight, the sources whose ratio lies under the level are
    full. One row per source, so the windows here hold a row per source.
    """
    by = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("src") - 1) % len(weights) + 1).cast("int"))
    ranked = (sizes.withColumn("src", F.row_number().over(by)).withColumn("weight", w)
              .withColumn("full", F.lit(float(cap)) * F.col("source_size")).withColumn("ratio", F.col("full") / F.col("weight")))
    all_rows = Window.partitionBy()
    upto = Window.orderBy("ratio", "src").rowsBetween(Window.unboundedPreceding, 0)
    level = (ranked.withColumn("words", F.lit(float(share)) * F.sum("source_size").over(all_rows))
             .withColumn("rest", F.sum("weight").over(all_rows) - F.sum("weight").over(upto))
             .withColumn("is_full", F.sum("full").over(upto) + F.col("ratio") * F.col("rest") <= F.col("words")))
    rate = ((F.col("words") - F.sum(F.when(F.col("is_full"), F.col("full")).otherwise(0.0)).over(all_rows))
            / F.sum(F.when(F.col("is_full"), 0.0).otherwise(F.col("weight"))).over(all_rows))
    target = F.when(F.col("is_full"), F.col("full")).otherwise(F.least("full", rate * F.col("weight")))
    total = F.sum("target").over(all_rows)
    line = Window.orderBy("src").rowsBetween(Window.unboundedPreceding, 0)
    return (level.withColumn("target", target)
            .withColumn("hi", F.when(total > 0, F.sum("target").over(line) / total).otherwise(0.0))
            .withColumn("lo", F.coalesce(F.lag("hi").over(Window.orderBy("src")), F.lit(0.0)))
            .select("source", "source_size", "src", "weight", "target", "lo", "hi"))


def schedule(targets: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Slots of the mix: slot, src, rank and, in words of the source's line,
    from and to. A source whose share holds no point gets one slot at the end.

    The points and the sources' intervals meet by an equi-join on cells of
    the unit interval, not by comparing every point with every source.
    """
    spark = targets.sparkSession
    t = targets.filter("target > 0").withColumn("goal", F.floor(F.col("target") + 0.5))
    cells = t.select("src", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") * CELLS), F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1)))).alias("cell"))
    points = (spark.range(slots).withColumnRenamed("id", "slot")
              .withColumn("u", (F.col("slot") * F.lit(GOLDEN)) % F.lit(1 << 32) / F.lit(float(1 << 32)))
              .withColumn("cell", F.floor(F.col("u") * CELLS)))
    named = points.join(cells, "cell").filter("u >= lo and u < hi").select("slot", "src")
    counted = named.withColumn("rank", F.row_number().over(Window.partitionBy("src").orderBy("slot")) - 1)
    missing = (t.join(named.select("src").distinct(), "src", "left_anti")
               .select((F.lit(slots) + F.col("src")).alias("slot"), "src", F.lit(0).alias("rank")))
    n = F.count(F.lit(1)).over(Window.partitionBy("src"))
    return (counted.union(missing).withColumn("n", n).join(t.select("src", "goal"), "src")
            .select("slot", "src", "rank", "n", "goal", F.expr("rank * goal div n").alias("from"), F.expr("(rank + 1) * goal div n").alias("to")))


def positions(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """Documents with their place on their source's line of words: at."""
    order = Window.partitionBy("src", "bucket").orderBy("h", F.col("doc_id"), "size")
    d = (docs.join(targets.select("source", "src"), docs["source"].eqNullSafe(targets["source"]))
         .select("doc_id", "src", "size", "h", "bucket"))
    totals = d.groupBy("src", "bucket").agg(F.sum("size").alias("words"))
    before = (totals.withColumn("before", F.sum("words").over(Window.partitionBy("src").orderBy("bucket")) - F.col("words"))
              .select("src", "bucket", "before"))
    return (d.withColumn("row", F.row_number().over(order))
            .withColumn("within", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
            .join(before, ["src", "bucket"])
            .select("doc_id", "src", "bucket", "row", "size", (F.col("before") + F.col("within")).alias("at")))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP, slots: int = SLOTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(targets, documents, takes): one row per source, per document, and per
    piece of a document that a slot takes (slot, pass, from and to in the
    document's words)."""
    d = sized(docs)
    targets = source_targets(d.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    placed = positions(d, targets)
    plan = schedule(targets, slots)
    line = plan.filter("rank = 0").select("src", "n", "goal").join(targets.select("src", "source_size"), "src")
    passes = (placed.filter("size > 0").join(line, "src")
              .withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(int(cap) - 1))))
              .withColumn("lo", F.col("at") + F.col("pass") * F.col("source_size"))
              .withColumn("hi", F.least(F.col("lo") + F.col("size"), F.col("goal"))).filter("lo < hi")
              .withColumn("rank", F.explode(F.sequence(F.expr("((lo + 1) * n - 1) div goal"), F.expr("(hi * n - 1) div goal")))))
    takes = (passes.join(plan.select("src", "rank", "slot", "from", "to"), ["src", "rank"])
             .select("slot", "src", "bucket", "row", "doc_id", "pass",
                     (F.greatest("lo", "from") - F.col("lo")).alias("from"), (F.least("hi", "to") - F.col("lo")).alias("to")))
    return targets, placed, takes


def taken(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: per document."""
    targets, placed, takes = mix(docs, **options)
    sums = takes.groupBy("src", "bucket", "row").agg(F.sum(F.col("to") - F.col("from")).alias("taken"))
    return (placed.join(sums, ["src", "bucket", "row"], "left").join(targets, "src")
            .select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix as whole documents: one is in the mix once for each of its
    pieces taken by a slot that begins with its first word, so at most ``cap``
    times. Documents without words are not in the mix; rows that share a
    doc_id share the larger number of copies."""
    return apart(docs, ("doc_id", "text", "source"), lambda d: _mixed(d, **options))


def _mixed(docs: DataFrame, **options) -> DataFrame:
    _, _, takes = mix(docs, **options)
    rows = takes.filter("from = 0").groupBy("src", "bucket", "row", "doc_id").agg(F.count(F.lit(1)).alias("copies"))
    copies = rows.groupBy("doc_id").agg(F.max("copies").cast("int").alias("_copies")).withColumnRenamed("doc_id", "_id")
    many = copies.filter("_copies > 0")
    return (docs.join(many, docs["doc_id"].eqNullSafe(many["_id"])).filter(n_words(F.col("text")) > 0)
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*docs.columns))


def taken_sql() -> str:
    """The same in SQL: a source's goal covers its line from the start, then
    from the start again, so a document's words taken are two overlaps."""
    return r"""
WITH d AS (SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source IS NULL, source) AS src FROM d GROUP BY source),
w AS (SELECT *, CASE (src - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight, 2.0::DOUBLE * source_size AS full_ FROM s),
l AS (SELECT *, full_ / weight AS ratio, 1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) AS words FROM w),
f AS (SELECT *, sum(full_) OVER o + ratio * (sum(weight) OVER () - sum(weight) OVER o) <= words AS is_full FROM l
    WINDOW o AS (ORDER BY ratio, src ROWS UNBOUNDED PRECEDING)),
t AS (SELECT source, source_size, src, CASE WHEN is_full THEN full_ ELSE least(full_,
    (words - sum(CASE WHEN is_full THEN full_ ELSE 0 END) OVER ()) / sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER () * weight) END AS target FROM f),
p AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS goal,
    CAST(sum(d.size) OVER (PARTITION BY t.src ORDER BY d.h, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS at_
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
    CAST(greatest(0, least(at_ + size, goal) - at_) + greatest(0, least(at_ + size + source_size, goal) - at_ - source_size) AS BIGINT) AS taken
FROM p"""
