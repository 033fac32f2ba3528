"""Append a file stream to a bronze table, with lineage columns and a landing log.

The stream stops at bronze: no windows, no state, no watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.sources.raw import stamp


def read_files(spark: SparkSession, folder: str, schema: StructType, fmt: str = "parquet",
               glob: str | None = None, max_files: int | None = None) -> DataFrame:
    """A stream of the files in a folder. `max_files` bounds a micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def stream_bronze(stream: DataFrame, batch_id: str, target: str, checkpoint: str) -> StreamingQuery:
    """Append everything available now and stop; a later call resumes at the checkpoint.

    The file sink's commit log makes the append exactly-once.
    """
    return (
        stamp(stream, batch_id).writeStream.format("parquet").outputMode("append")
        .option("path", target).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_row_audit(stream: DataFrame, target: str, audit: str, checkpoint: str, batch_id: str) -> StreamingQuery:
    """Land each micro-batch and log its row count, counted from what was landed.

    Both go to the folder of their micro-batch and overwrite it, so a batch
    replayed after a failure neither doubles rows nor log lines.
    """
    def land(batch: DataFrame, epoch: int) -> None:
        place = f"{target.rstrip('/')}/epoch={epoch}"
        batch.write.mode("overwrite").parquet(place)
        landed = batch.sparkSession.read.schema(batch.schema).parquet(place)
        (
            landed.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("batch_id", F.lit(epoch).cast("bigint"))
            .write.mode("overwrite").parquet(f"{audit.rstrip('/')}/epoch={epoch}")
        )

    return (
        stamp(stream, batch_id).writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
