"""Incremental loading and scoring as Structured Streaming jobs.

All jobs use ``foreachBatch`` with an idempotent sink: every micro-batch
writes (overwrites) folders of its own batch id and reads the target as it was
before that batch, so a replayed batch after a failure produces exactly the same
rows. A target that has to be looked up lies in key buckets (``KeyedTable``): a
batch reads the buckets of its own keys, not the target. Progress and the file log
live in the checkpoint location (a shared folder), so a restarted query resumes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkmart.sources.keyed_table import KeyedTable


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    (df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def each_batch(spark: SparkSession, source: str, schema: StructType, checkpoint: str, run: Callable,
               max_files_per_trigger: int | None = None, transform: Callable | None = None):
    """Calls ``run(batch, batch_id)`` for the new files of ``source`` until all are processed."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source)
    if transform is not None:
        stream = transform(stream)
    q = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def incremental_load(spark: SparkSession, source: str, schema: StructType, target: KeyedTable, checkpoint: str,
                     order_by: Sequence[str] | None = None, max_files_per_trigger: int | None = None,
                     transform: Callable | None = None):
    """Stream new files of ``source`` into ``target`` with INSERT IGNORE on its
    key (existing rows win; first row per key in ``order_by`` wins inside
    a batch). Runs until the available files are processed."""
    def load(batch: DataFrame, batch_id: int) -> None:
        target.insert_ignore(batch, batch_id, order_by)

    return each_batch(spark, source, schema, checkpoint, load, max_files_per_trigger, transform)


def incremental_merge(spark: SparkSession, source: str, schema: StructType, state: KeyedTable, checkpoint: str,
                      fold: Callable[[DataFrame], DataFrame], max_files_per_trigger: int | None = None,
                      transform: Callable | None = None):
    """Stream new files of ``source``, reshaped by ``transform``, into a keyed
    state: per key of a batch the state becomes ``fold`` of the held and new rows."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        state.merge(batch, batch_id, fold)

    return each_batch(spark, source, schema, checkpoint, merge, max_files_per_trigger, transform)


def stream_score(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str,
                 score: Callable[[DataFrame], DataFrame], max_files_per_trigger: int | None = None,
                 label_col: str | None = None):
    """Score the new rows of ``source`` with ``score`` (a DataFrame ->
    DataFrame function) and append the result to ``target``; with
    ``label_col`` only rows whose label is still NULL."""
    def run(batch: DataFrame, batch_id: int) -> None:
        todo = batch if label_col is None else batch.where(F.col(label_col).isNull())
        _write_batch(score(todo), target, batch_id)

    return each_batch(spark, source, schema, checkpoint, run, max_files_per_trigger)


def _target(spark: SparkSession, path: str, schema: StructType, before_batch: int) -> DataFrame:
    """The target as it was before a batch; a target that is not there yet is empty."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):      # any other read error is raised
        return spark.createDataFrame([], schema)
    df = spark.read.schema(StructType(schema.fields[:]).add("batch_id", "long")).parquet(path)
    return df.filter(F.col("batch_id") < before_batch).drop("batch_id")


def read_target(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch_id")
