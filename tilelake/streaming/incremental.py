"""Incremental runs: new slide files as a stream, a batch of files at a time, each batch through the same plan.

An extension of the restartable batch run: the checkpoint plays the part of the status folder, maxFilesPerTrigger the
part of the limit on slides in flight, and the status log still keeps a replayed batch from being done twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tilelake.functions import metadata
from tilelake.operators import sinks
from tilelake.plans import preprocess
from tilelake.plans.config import Config


def slide_stream(spark: SparkSession, folder: str, glob: str, per_batch: int) -> DataFrame:
    raw = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", glob).option("maxFilesPerTrigger", per_batch).load(folder)
    return raw.select("path", metadata.stem(F.col("path")).alias("stem"))


def run_incremental(spark: SparkSession, config: Config, checkpoint: str, per_batch: int = 8) -> StreamingQuery:
    """Processes what has arrived, then stops; call again for more."""
    model = preprocess.fit_reference(spark, config)

    def each(batch: DataFrame, _: int) -> None:
        own = batch.sparkSession
        todo = sinks.pending(batch, sinks.read_status(own, config.output.path), config.retry_failed)
        if not todo.isEmpty():
            preprocess.run_batch(own, todo, config, model)

    stream = slide_stream(spark, config.input.path, config.input.glob, per_batch)
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def status_counts(spark: SparkSession, path: str) -> DataFrame:
    """A running count of the status log by status, as a streaming table."""
    log = spark.readStream.schema(sinks.STATUS).parquet(f"{path}/status")
    return log.groupBy("status").agg(F.count("*").alias("n"))
