"""File sources and sinks."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, schema: StructType | None = None, fmt: str | None = None) -> DataFrame:
    """CSV (header, declared schema) or Parquet by extension; a missing
    path raises a clear error instead of returning None."""
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    if fmt != "csv":
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    if schema is None:
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    # columns are matched by header name: Spark would apply a CSV schema by position
    raw = spark.read.option("header", True).csv(path)
    missing = [f.name for f in schema.fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path} lacks declared columns {missing}")
    return raw.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def load_sources(spark: SparkSession, primary: str, train: str, test: str, drop=(), schema=None) -> dict:
    """S3: {original, test, combined} with the combined set built by P1-P4.
    ``schema`` is one schema for all three files or a dict with a schema per
    file (keys primary, train, test); columns are found by name."""
    from tabprep.operators.project import union_sources
    of = schema if isinstance(schema, dict) else dict.fromkeys(("primary", "train", "test"), schema)
    original = read_table(spark, primary, of.get("primary"))
    comp_train = read_table(spark, train, of.get("train"))
    comp_test = read_table(spark, test, of.get("test"))
    return {"original": original, "test": comp_test, "combined": union_sources(original, comp_train, drop)}


def write_folds(df: DataFrame, path: str, fold_col: str = "fold") -> None:
    """One table partitioned by fold; overwrite removes stale folds."""
    df.write.mode("overwrite").partitionBy(fold_col).parquet(path)


def read_fold(spark: SparkSession, path: str, fold: int, fold_col: str = "fold"):
    """(train, val) of one fold; the filter prunes partitions."""
    t = spark.read.parquet(path)
    return t.where(F.col(fold_col) != fold), t.where(F.col(fold_col) == fold)


def write_metrics(df: DataFrame, path: str) -> None:
    """Small metric table as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_metric_runs(spark: SparkSession, root_glob: str) -> DataFrame:
    """All metric CSVs under ``<root>/<method>_saved_models/...``, tagged
    with method and kind from the file path."""
    df = spark.read.option("header", True).option("inferSchema", True).csv(root_glob)
    path = F.input_file_name()
    return (df.withColumn("method", F.regexp_extract(path, r"/([^/]+)_saved_models/", 1))
            .withColumn("kind", F.regexp_extract(path, r"metrics_([a-z]+)", 1)))


def write_table(df: DataFrame, path: str) -> None:
    """S7."""
    df.write.mode("overwrite").parquet(path)


def out_path(spark: SparkSession, *parts: str) -> str:
    """A path under the session's shared checkpoint folder (never machine-local
    on a cluster)."""
    from tabprep.session import checkpoint_dir
    base = checkpoint_dir(spark)
    base = base[len("file:"):] if base.startswith("file:") else base
    return os.path.join(base, "tabprep-out", *parts)
