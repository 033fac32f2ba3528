"""An equi join that survives a hot key on its left side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType, StringType

SENT_BYTES = 64 << 20  # of a measured list that may be sent to every task
ROW_BYTES = 100  # what a row takes there besides its texts


def sent_if_small(written: DataFrame) -> DataFrame:
    """A written list, to be broadcast if what it takes in a task, as measured, stays below a bound (runs a job).

    Spark judges a file by its size on disk and a low threshold, and moves all rows of the other side for lists
    that fit anywhere. A longer list, or one of arrays or structs, is returned as it is.
    """
    if not all(isinstance(f.dataType, AtomicType) for f in written.schema):
        return written
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in written.schema
             if isinstance(f.dataType, (StringType, BinaryType))]
    size = F.sum(reduce(add, texts, F.lit(ROW_BYTES)).cast("long"))
    return F.broadcast(written) if (written.agg(size).first()[0] or 0) <= SENT_BYTES else written


def skew_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], how: str) -> DataFrame:
    """Join on `left column = right column` for each pair; `right` is unique in its columns.

    For right sides that come out of an aggregate on the join key. Such a side
    is already partitioned by the key, Spark would join it in place, and
    adaptive execution splits a hot partition only between two fresh shuffles.
    The keys' hash as one more join column asks for that shuffle of the (narrow)
    right side. It follows from the keys, so it changes no result, and a right
    side small enough to broadcast still is.

    The comparison is null-safe, so Spark adds no NOT NULL filter to the right
    side, and where both sides derive from one shuffle they keep sharing it. A
    NULL key on the left matches only a NULL key on the right: leave those out.
    """
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in pairs]
    spread = F.xxhash64(*[a for a, _ in pairs]) == F.xxhash64(*[b for _, b in pairs])
    return left.join(right, reduce(and_, same) & spread, how)
