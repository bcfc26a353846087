"""Incremental loading as a Structured Streaming job.

New raw files landing in a folder are cleaned and loaded micro-batch by
micro-batch with ``foreachBatch``: every dimension takes only members with a
new natural key (keys continue after the largest existing one) and the fact
takes only events not loaded yet. Both are anti joins against what is already
published, so replaying a batch after a failure loads nothing twice, and the
stream's checkpoint (under ``spark.checkpoint.dir``) records which files were
processed.

Differences from a one-off run, by necessity:
* the sparse-column drop is skipped (a stream's schema is fixed up front);
* every dimension uses insert-new, including the ones a one-off run only fills
  when empty, otherwise members first seen in a later batch would never load;
* an event repeated across batches keeps the copy that arrived first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from dimloom.operators.clean import CleanConfig, clean
from dimloom.plans.warehouse import StepResult, Warehouse, load_date_dimension, load_dimension, load_fact_table
from dimloom.session import ensure_checkpoint_dir


def process_batch(wh: Warehouse, batch: DataFrame, specs, lookups, columns, order_by,
                  protect=()) -> list[StepResult]:
    """Load one micro-batch of raw rows into the warehouse (idempotent)."""
    staged = clean(batch, "rename", CleanConfig(protect=tuple(protect))).persist()
    try:
        results = [load_date_dimension(wh)]
        results += [load_dimension(wh, staged, spec, mode="insert_new") for spec in specs]
        results.append(load_fact_table(wh, staged, specs, lookups, columns, order_by))
        return results
    finally:
        staged.unpersist()


def start_incremental_load(spark: SparkSession, landing: str, schema: T.StructType, root: str,
                           specs, lookups, columns, order_by, protect=(), name: str = "incidents",
                           available_now: bool = True, max_files_per_batch: int | None = None) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what has landed and stops."""
    wh = Warehouse(spark, root)
    reader = spark.readStream.schema(schema)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    source = reader.parquet(landing)
    checkpoint = f"{ensure_checkpoint_dir(spark)}/dimloom-stream/{name}"

    def each(batch: DataFrame, epoch_id: int) -> None:
        process_batch(wh, batch, specs, lookups, columns, order_by, protect)

    writer = source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).queryName(name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
