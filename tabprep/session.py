"""Session construction and lineage cutting.

The library never creates a session on its own inside an operator; callers
pass one in. ``get_spark`` is a convenience for tests, bench and scripts.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "tabprep",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("TABPREP_DRIVER_MEM", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from ``spark.checkpoint.dir`` (or the context's directory). Only a
    local-mode session (tests, bench) without one gets a fresh scratch folder;
    on a cluster a missing setting is an error, never a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if sc.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="tabprep-ckpt-")
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir() or path
    raise RuntimeError("spark.checkpoint.dir is not set; the cluster must name a shared folder")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the shared checkpoint folder and
    read back: cuts lineage, survives lost executors and leaves no cached
    table behind."""
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def size_for_input(spark: SparkSession, input_bytes: int, target_partition_bytes: int = 256 << 20,
                   min_partitions: int = 200) -> int:
    """Size shuffles and scan splits for an input of ``input_bytes``: about
    one shuffle partition per ``target_partition_bytes`` so that each fits in
    executor memory (100 TB -> ~400k before AQE coalescing), scans split at
    the same size, AQE coalescing and skew splitting on. Returns the count."""
    n = max(min_partitions, -(-int(input_bytes) // target_partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(target_partition_bytes))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_partition_bytes // 2))
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return n
