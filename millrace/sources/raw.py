"""Raw files in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINEAGE = ("_ingested_at", "_source_file", "_ingest_batch")


def read_raw(spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Headered CSV with every column a string and nothing trimmed; empty cells are NULL.

    Given `columns` the schema is fixed and Spark opens no file to plan the
    read. Without them the header of one file supplies the names.
    """
    reader = spark.read.option("header", True).option("enforceSchema", columns is None)
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path)


def read_inferred(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Headered CSV with inferred types, for profiling only: it reads the files twice."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def export_csv(df: DataFrame, path: str) -> str:
    """Write headered CSV in parallel part files (an action). Returns the folder."""
    (
        df.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    return path


def stamp(df: DataFrame, batch_id: str, source: str | Column | None = None) -> DataFrame:
    """Add load time, source file and batch. Without `source`, the file each row came from."""
    if source is None:
        source = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    elif isinstance(source, str):
        source = F.lit(source)
    return df.withColumns(
        {"_ingested_at": F.current_timestamp(), "_source_file": source, "_ingest_batch": F.lit(batch_id)}
    )


def as_text(df: DataFrame) -> DataFrame:
    """Every column cast to string: the raw form of a typed table."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def business_columns(df: DataFrame) -> list[str]:
    """All columns but the lineage ones."""
    return [c for c in df.columns if c not in LINEAGE]
