"""Incremental loading of the observation and forecast tables.

The reference loads its history tables in batches; the same conform rules
(A6, A7) are plain projections, so they run unchanged on a streaming
DataFrame.  Each micro-batch is split once into loadable and rejected rows
by ``foreachBatch`` and written to two Parquet sinks.

``foreachBatch`` alone is at-least-once: a batch that fails after part of its
write is replayed after a restart.  Each batch is therefore written into its
own ``load_batch=<id>`` partition with dynamic partition overwrite, so a
replay replaces that batch's files instead of appending them a second time.
Together with the source offsets in the checkpoint folder, every input file
lands exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources import tables


def read_stream(spark: SparkSession, source_dir: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source_dir)


BATCH_COLUMN = "load_batch"


def _write_batch(rows: DataFrame, path: str, batch_id: int, partition_by=()) -> None:
    """Idempotent write of one micro-batch: only its own partition(s) are replaced."""
    (rows.withColumn(BATCH_COLUMN, F.lit(int(batch_id)))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BATCH_COLUMN, *partition_by).parquet(path))


def write_split(batch: DataFrame, batch_id: int, valid_path: str, rejected_path: str, partition_by=()) -> None:
    """Loadable rows to ``valid_path``, rejected rows (with reason) to ``rejected_path``."""
    batch.persist()
    try:
        _write_batch(tables.loadable(batch), valid_path, batch_id, partition_by)
        _write_batch(tables.rejected(batch), rejected_path, batch_id)
    finally:
        batch.unpersist()


def start_load(conformed: DataFrame, valid_path: str, rejected_path: str, checkpoint: str,
               partition_by=(), available_now: bool = True, name: str | None = None) -> StreamingQuery:
    """Append a conformed stream: loadable rows to ``valid_path``, the rest
    (with their ``rejection`` reason) to ``rejected_path``."""
    writer = (conformed.writeStream
              .foreachBatch(lambda df, epoch: write_split(df, epoch, valid_path, rejected_path, partition_by))
              .option("checkpointLocation", checkpoint))
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def load_weather_history(spark: SparkSession, source_dir: str, schema: T.StructType, valid_path: str,
                         rejected_path: str, checkpoint: str, location: str = tables.DEFAULT_LOCATION,
                         available_now: bool = True) -> StreamingQuery:
    """A6 as a stream: new observation files -> typed, checked, appended."""
    stream = read_stream(spark, source_dir, schema)
    return start_load(tables.conform_weather_history(stream, location), valid_path, rejected_path, checkpoint,
                      available_now=available_now)


def load_forecasts(spark: SparkSession, source_dir: str, schema: T.StructType, valid_path: str,
                   rejected_path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """A7 as a stream: issued forecasts -> typed, horizon-checked, appended."""
    stream = read_stream(spark, source_dir, schema)
    return start_load(tables.conform_forecasts(stream), valid_path, rejected_path, checkpoint,
                      available_now=available_now)
