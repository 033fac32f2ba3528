"""Texts through Python in Arrow batches, a bounded slice at a time."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from millrace.session import ship_package

SLICE_BYTES = 1 << 20  # of texts handled, and results held, at once; a longer text is a slice of its own


def give_back() -> None:
    """Return freed memory to the system at the end of a task: workers are reused for very different work."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # another C library than GNU's
        ctypes.CDLL(None).malloc_trim(0)


def slices(batch: pa.RecordBatch, texts: pa.Array, size: int) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Consecutive rows of a batch, with their texts, that add up to about `size` bytes."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(at, stop - at), texts.slice(at, stop - at)
        at = stop


Made = dict[str, tuple[pa.DataType, str]]
Start = Callable[[], Callable[[list[str]], list[list]]]


def _run(rows: DataFrame, kept: dict[str, int], texts_of: Callable[[pa.RecordBatch], pa.Array], made: Made, start: Start,
         slice_bytes: int) -> DataFrame:
    """`kept` names the columns that stay ({name: place}), `texts_of` finds the texts of a batch."""
    ship_package(rows.sparkSession)
    schema = StructType(
        [StructField(name, rows.schema[place].dataType) for name, place in kept.items()]
        + [StructField(name, DataType.fromDDL(kind)) for name, (_, kind) in made.items()])
    types, names, places = [t for t, _ in made.values()], schema.names, list(kept.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for part, texts in slices(batch, texts_of(batch), slice_bytes):
                out = work(texts.to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(k) for k in places], *[pa.array(v, t) for v, t in zip(out, types)]], names=names)
        give_back()

    return rows.mapInArrow(run, schema)


def map_texts(docs: DataFrame, text_col: str, keep: dict[str, str], made: Made, start: Start,
              slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The columns `keep` ({column: new name}) beside what Python makes of the texts (NULL counts as empty).

    `start` runs once per task and returns a function from texts to one list per
    column of `made` ({name: (Arrow type, Spark type)}).
    """
    rows = docs.select(*[F.col(c).alias(f"_k{n}") for n, c in enumerate(keep)],
                       F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    kept = {name: n for n, name in enumerate(keep.values())}
    return _run(rows, kept, lambda batch: batch.column(batch.num_columns - 1), made, start, slice_bytes)


def map_rows(docs: DataFrame, text_col: str, made: Made, start: Start) -> DataFrame:
    """Like `map_texts`, with the whole row as the struct `_doc`, whatever its columns are called."""
    place = docs.columns.index(text_col)
    packed = docs.select(F.struct("*").alias("_doc"))
    return _run(packed, {"_doc": 0}, lambda batch: batch.column(0).field(place).fill_null(""), made, start, SLICE_BYTES)
