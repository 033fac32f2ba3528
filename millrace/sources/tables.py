"""Named tables and views, and the registry through which models find them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from millrace.session import work_folder


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    path: str | None = None,
    merge_schema: bool = False,
    partition_by: tuple[str, ...] = (),
) -> DataFrame:
    """Publish `df` as a catalog table (an action) and return a scan of it.

    `merge_schema` matters to formats that keep a table schema across writes
    (Delta); a Parquet overwrite replaces the schema anyway.
    """
    writer = df.write.mode(mode).format(fmt)
    if merge_schema:
        writer = writer.option("mergeSchema", True)
    if path is not None:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return scan_table(df.sparkSession, name)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def staging_view(df: DataFrame, name: str) -> DataFrame:
    """Publish a model as a lazy view and return a scan of the view."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` below the shared work folder and read it back (an action).

    Used where a result feeds several later steps: the lineage ends here, a
    lost executor costs a re-read and no recomputation, and the files give
    Spark a true size, so it broadcasts the table only if it really is small.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Frames(Mapping):
    """Names to results that are built on first access, so a plan holds only what it uses."""

    def __init__(self, builders: Mapping[str, Callable]):
        self._builders, self._built = dict(builders), {}

    def __getitem__(self, name: str):
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


class SourceRegistry:
    """Upstream names to DataFrames, resolved when a model asks for them."""

    def __init__(self, spark: SparkSession, prefix: str = ""):
        self._spark, self._prefix = spark, prefix
        self._frames: dict[str, Callable[[], DataFrame]] = {}

    def add(self, name: str, frame: DataFrame | Callable[[], DataFrame]) -> "SourceRegistry":
        self._frames[name] = frame if callable(frame) else (lambda: frame)
        return self

    def ref(self, name: str) -> DataFrame:
        """A registered frame, else the catalog table `prefix + name`."""
        if name in self._frames:
            return self._frames[name]()
        return self._spark.table(self._prefix + name)

    def names(self) -> list[str]:
        return sorted(self._frames)
