"""Connected components of an edge table, by alternating star contractions.

Each round joins a node's neighbours with the smallest of them; edges never
multiply, and the number of rounds grows with the logarithm of the largest
component. Edges stay in Spark; only two checksum numbers reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import discard, stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    if large:
        s = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        s = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    m = s.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    j = s.join(m, "u")
    if large:
        out = j.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = j.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(m.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``edges`` (a, b) -> (node, component): component is the smallest node
    of the component. Nodes without an edge to another node are absent. Null
    ends and repeated edges are dropped."""
    e = stored(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u is not null and v is not null and u <> v").distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        last, e = e, stored(_star(_star(e, True), False), "edges")
        discard(last)
        r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h"), F.sum(F.col("u").cast("decimal(38,0)")).alias("s")).first()
        now = (r["n"], r["h"], r["s"])
        if now == before or not r["n"]:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
