"""Incremental file-arrival ingest with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def arriving_files(spark: SparkSession, folder: str, schema: StructType | str, fmt: str = "parquet",
                   glob: str | None = None, max_files: int | None = None) -> DataFrame:
    """Stream of the files in a folder, each read once."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def ingest_available(stream: DataFrame, target: str, checkpoint: str, batch_id: str | None = None,
                     partition_by=(), timeout: int | None = None) -> None:
    """Append everything that has arrived since the last run, then stop.

    The checkpoint remembers the files already taken, so a rerun adds nothing and
    a run that died midway resumes; the file sink commits each batch once.
    """
    if batch_id is not None:
        stream = stream.withColumns({"bronze_loaded_at": F.current_timestamp(), "bronze_batch_id": F.lit(batch_id)})
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.trigger(availableNow=True).start(target)
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"ingest into {target} did not finish")


def upsert_available(stream: DataFrame, checkpoint: str, apply_batch) -> None:
    """Hand every micro-batch to ``apply_batch(batch_df, batch_number)`` once, then stop."""
    query = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply_batch).trigger(availableNow=True).start()
    query.awaitTermination()
