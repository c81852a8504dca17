"""Document fingerprints: bottom-k sketches of shingle hashes (native).

A fingerprint holds the ``K`` smallest distinct 60-bit hashes of a text's
five-word shingles, as fixed-width hex, ascending and concatenated. Sketches
of parts merge into the sketch of the whole; two sketches estimate
resemblance and containment, one estimates the number of distinct shingles.

Contracts: a null text is empty; a text without words has the empty
fingerprint; one with fewer than five words is a single shingle of all its
words. Two empty fingerprints have likeness 1, an empty and another 0.
Repeated rows are fingerprinted each; extra columns pass untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.common import words

K, WIDTH = 128, 5
HEX = 15
TOP = 1 << 60


def sketch(text: Column, k: int = K, width: int = WIDTH) -> Column:
    """Ascending array of the ``k`` smallest distinct shingle hashes.

    Words are hashed once; a shingle's hash folds the hashes of its words, so
    no shingle text is built.
    """
    hashes = F.transform(words(text), lambda w: F.xxhash64(w))

    def of(ws: Column) -> Column:
        n = F.size(ws)
        shingles = F.transform(F.sequence(F.lit(0), n - width),
                               lambda i: F.xxhash64(*[F.get(ws, i + j) for j in range(width)]).bitwiseAND(TOP - 1))
        whole = F.array(F.xxhash64(n, ws).bitwiseAND(TOP - 1))
        return (F.when(n >= width, F.slice(F.sort_array(F.array_distinct(shingles)), 1, k))
                .when(n > 0, whole).otherwise(F.array().cast("array<bigint>")))

    # the one-element transform binds the hashes once; they are used several times
    return F.get(F.transform(F.array(hashes), of), 0)


def to_hex(sk: Column) -> Column:
    return F.array_join(F.transform(sk, lambda h: F.lpad(F.lower(F.hex(h)), HEX, "0")), "")


def from_hex(text: Column) -> Column:
    at = F.sequence(F.lit(0), (F.length(text) / HEX - 1).cast("int"))
    each = F.transform(at, lambda i: F.conv(F.substring(text, i * HEX + 1, F.lit(HEX)), 16, 10).cast("bigint"))
    return F.when(F.length(text) > 0, each).otherwise(F.array().cast("array<bigint>"))


def union_sketch(a: Column, b: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Share of the union's bottom k that both sketches hold; exact while the
    union has at most ``k`` shingles. The common elements of two bottom-k
    sketches that are under the union's k-th are those in the union's sketch.
    """
    u = union_sketch(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(a, b), u))
    return F.when(F.size(u) > 0, both / F.size(u)).otherwise(1.0).cast("double")


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact under ``k``."""
    n = F.size(a)
    return F.when(n < k, n.cast("double")).otherwise((k - 1) * F.lit(float(TOP)) / (F.get(a, F.lit(k - 1)) + 1))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has."""
    n_union = distinct_shingles(union_sketch(a, b, k), k)
    share = resemblance(a, b, k) * n_union / distinct_shingles(a, k)
    return F.when(F.size(a) > 0, F.least(share, F.lit(1.0))).otherwise(1.0)


def merge(df: DataFrame, keys: list[str], col: str = "sketch", k: int = K, fan_in: int = 64, most_parts: int = 1 << 24) -> DataFrame:
    """One sketch per key from the sketches of its parts, in levels of groups
    of about ``fan_in`` parts, so a key with a third of all rows never meets
    in one task. ``most_parts`` bounds only the number of levels planned; more
    parts make the groups of the first level larger, not the result wrong."""
    salts = 1
    while salts * fan_in < most_parts:
        salts *= fan_in
    out = df.select(*keys, col, F.xxhash64(col, F.monotonically_increasing_id()).alias("_salt"))
    while True:
        out = (out.withColumn("_salt", F.pmod("_salt", F.lit(salts))).groupBy(*keys, "_salt")
               .agg(F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list(col)))), 1, k).alias(col)))
        if salts == 1:
            return out.drop("_salt")
        salts //= fan_in


def next_document(docs: DataFrame, cols: list[str], derive=None) -> DataFrame:
    """``docs`` (doc_id and ``cols``) with ``next_<col>``: those of the next
    row in descending doc_id; after the last, of the first.

    Rows go to ranges of doc_id, sorted and led within each. The first row of
    every range is also dealt to the range before it (and the table's first to
    the last range), so no lead crosses a task. Range edges are existing
    doc_ids from a bounded quantile sketch; the driver sees only the edges.
    ``derive`` adds columns once a range has its rows.
    """
    spark = docs.sparkSession
    n = max(2, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    got = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10000).alias("q"), F.max("doc_id").alias("m")).first()
    edges = sorted({*(got["q"] or []), *([got["m"]] if got["m"] is not None else [])})  # each range's largest doc_id, ascending
    if not edges:
        edges = [0]
    # range r holds doc_id <= edges[r] (and > edges[r-1]); a null doc_id comes last, with the smallest
    first = F.array(*[F.lit(e).cast("bigint") for e in edges])
    r = F.coalesce(F.size(F.filter(first, lambda e: e < F.col("doc_id"))), F.lit(0))
    after = F.when(F.col("_r") < len(edges) - 1, F.col("_r") + 1).otherwise(F.lit(0))
    is_first = F.col("doc_id") == F.get(first, F.col("_r"))
    # the largest doc_id of range r stands right after the rows of range r + 1; that of the top range after range 0
    spread = F.when(is_first, F.array(F.struct(F.col("_r").alias("r"), F.lit(0).alias("tail")), F.struct(after.alias("r"), F.lit(1).alias("tail")))).otherwise(F.array(F.struct(F.col("_r").alias("r"), F.lit(0).alias("tail"))))
    rows = (docs.select("doc_id", *cols).withColumn("_r", r).withColumn("_at", F.explode(spread))
            .select("doc_id", *cols, F.col("_at.r").alias("_r"), F.col("_at.tail").alias("_tail"))
            .repartition(n, "_r"))
    rows = derive(rows) if derive else rows
    led = [c for c in rows.columns if c not in ("doc_id", "_r", "_tail")]
    order = Window.partitionBy("_r").orderBy("_tail", F.col("doc_id").desc_nulls_last(), *cols)
    return (rows.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in led])
            .filter("_tail = 0").drop("_r", "_tail"))


def edited_text(text: Column, following: Column) -> Column:
    """``text`` with its last floor(n/3) code points replaced by as many of
    the start of ``following`` (or all of it)."""
    n = F.length(text)
    cut = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - cut), F.substring(following, F.lit(1), cut))


def compare_with_next(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_chars, fingerprint, edited_sha256, edited_fingerprint,
    near_edited and near_next of each document, and the estimated number of
    distinct shingles."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    led = next_document(d, ["text"], derive=lambda rows: rows.withColumn("sk", sketch(F.col("text"), k)))
    out = (led.withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
           .select("doc_id", F.length("text").cast("long").alias("n_chars"), "sk", "next_sk",
                   F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), sketch(F.col("edited"), k).alias("esk")))
    return out.select("doc_id", "n_chars", "edited_sha256", to_hex(F.col("sk")).alias("fingerprint"), to_hex(F.col("esk")).alias("edited_fingerprint"),
                      resemblance(F.col("sk"), F.col("esk"), k).alias("near_edited"), resemblance(F.col("sk"), F.col("next_sk"), k).alias("near_next"),
                      distinct_shingles(F.col("sk"), k).alias("est_shingles"))
