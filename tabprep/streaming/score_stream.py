"""Scoring a stream (P18): the fitted pipeline is a stateless projection, so
it applies unchanged to a streaming DataFrame. Batches land in any sink;
``foreachBatch`` gives exactly-once writes to a table path."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tabprep.operators.fit import predict
from tabprep.operators.score import risk_tier


def stream_through(spark: SparkSession, apply, source_dir: str, schema: StructType, out_dir: str, checkpoint: str,
                   max_files_per_trigger: int | None = None) -> None:
    """Read parquet files as they arrive, ``apply`` a fitted transform (a
    ``PipelineModel.transform`` or any stateless function), write to
    ``out_dir``; runs until the currently available files are done
    (``availableNow``)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def sink(batch: DataFrame, epoch: int) -> None:
        # one directory per epoch, overwritten on replay: a retried batch
        # replaces its own output instead of appending a duplicate
        batch.write.mode("overwrite").parquet(f"{out_dir}/epoch={epoch}")

    q = (apply(reader.parquet(source_dir)).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def score_stream(spark: SparkSession, model: PipelineModel, source_dir: str, schema: StructType,
                 out_dir: str, checkpoint: str, max_files_per_trigger: int | None = None) -> None:
    """Score and tier with an assembler-and-learner pipeline."""
    stream_through(spark, lambda df: risk_tier(predict(model, df), "score", "prediction"), source_dir, schema, out_dir, checkpoint, max_files_per_trigger)
