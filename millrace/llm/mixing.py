"""Mix sources to target weights along a curriculum.

Weights are dealt to the sources in code-point order (NULL last) and turned into
token targets that sum to all tokens; a target stops at `max_repeats` times its
source's size and the excess goes to the others by weight, until none is above.

Each source's weight moves over training time t in [0, 1] as
`1 + drift * (2 t - 1)`, drawn from `drifts` in turn. Its integral is the share of
the target that the source has delivered by t; inverting it gives every document,
from the tokens that its source delivers before it, a training position. Documents
are then sorted by ranges of that position.

Within a source, documents stand in the order of the MD5 of their id, pass after pass over the source. A copy
is taken if the tokens up to its middle are demanded by the end of the training: the share that inverts to its position
is 1 at most. Repeated ids order by size. A source of any share is
cut into key ranges of about `BUCKET_ROWS` documents, whose sums are chained over ranges of all such sums, so no
task holds a whole source or its buckets. A document without words takes part with size 0; an
empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.positions import number_rows, running_total
from millrace.sources.tables import settle

WEIGHTS = (1, 2, 3)
DRIFTS = (0.5, 0.0, -0.5)
MAX_REPEATS = 3
BUCKET_ROWS = 1000
WORD = r"[^\x20\x09-\x0D]+"


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, keep_rows: bool) -> DataFrame:
    size = F.size(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD), F.lit(0)))
    return docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), size.cast("long").alias("_size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("_key"),
        *([F.struct("*").alias("_doc")] if keep_rows else []))


def _pick(values: Sequence, position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(position - 1, F.lit(len(values))) + 1).cast("int"))


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, drifts: Sequence[float] = DRIFTS,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: _source, _total, _buckets, _target, _drift."""
    totals = sized.groupBy("_source").agg(F.sum("_size").alias("_total"), F.count(F.lit(1)).alias("_rows"))
    ranked = number_rows(totals.withColumn("_absent", F.col("_source").isNull()), "_absent", "_source", name="_at")
    sources = settle(ranked.select(
        "_source", "_total", F.ceil(F.col("_rows") / BUCKET_ROWS).cast("long").alias("_buckets"),
        _pick(weights, F.col("_at")).cast("long").alias("_weight"), _pick(drifts, F.col("_at")).alias("_drift"),
    ), "mix-sources")
    cap = F.col("_total") * max_repeats
    everything = sources.agg(F.coalesce(F.sum("_total"), F.lit(0))).first()[0]
    level = before = 0.0
    while True:  # each turn stops one more source at least, or ends
        above = F.col("_weight") * F.lit(level) > cap
        fixed, free = sources.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("_weight"))), F.lit(0)),
        ).first()
        if free == 0:
            break
        before, level = level, (everything - fixed) / free
        if level <= before:
            break
    target = F.least(cap.cast("double"), F.col("_weight") * F.lit(float(level)))
    return sources.select("_source", "_total", "_buckets", "_drift", target.alias("_target"))


def _planned(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows with the tokens of their source before them, `_before`, and their number of copies, `_copies`."""
    known = sized.join(F.broadcast(targets) if _small(targets) else targets,
                       sized["_source"].eqNullSafe(targets["_source"]), "left").drop(targets["_source"])
    lead = F.conv(F.left("_key", F.lit(8)), 16, 10).cast("long")
    bucketed = known.withColumn("_bucket", F.shiftright(lead * F.col("_buckets"), 32))
    sums = bucketed.groupBy("_source", "_bucket").agg(F.sum("_size").alias("_in_bucket"))
    chained = settle(running_total(sums.withColumn("_absent", F.col("_source").isNull()), "_in_bucket",
                                   "_absent", "_source", "_bucket"), "mix-chained")
    begun = chained.groupBy(F.col("_source").alias("_of")).agg(F.min(F.col("upto") - F.col("_in_bucket")).alias("_begin"))
    offsets = settle(chained.join(begun, F.col("_source").eqNullSafe(F.col("_of"))).select(
        F.col("_source").alias("_s"), F.col("_bucket").alias("_b"),
        (F.col("upto") - F.col("_in_bucket") - F.col("_begin")).alias("_offset")), "mix-offsets")
    joined = bucketed.join(offsets, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")), "left")
    inside = Window.partitionBy("_source", "_bucket").orderBy("_key", "_id", "_size").rowsBetween(
        Window.unboundedPreceding, -1)
    before = F.col("_offset") + F.coalesce(F.sum("_size").over(inside), F.lit(0))
    demanded = F.filter(F.array(*[F.lit(k).cast("long") for k in range(MAX_REPEATS)]), lambda copy: _share(copy) <= 1)
    copies = F.when(F.col("_target") > 0, F.size(demanded).cast("long")).otherwise(F.lit(1).cast("long"))
    return joined.withColumn("_before", before).withColumn("_copies", copies).drop("_s", "_b")


def _small(targets: DataFrame, rows: int = 10_000) -> bool:
    """A source table of a size that may be broadcast; a larger one is joined by shuffle, in splits."""
    return len(targets.select("_total").head(rows + 1)) <= rows


def _share(copy: Column) -> Column:
    """The part of its source's target that is delivered by the middle of a copy."""
    return (copy * F.col("_total") + F.col("_before") + F.col("_size") / 2) / F.col("_target")


def _position(copy: Column) -> Column:
    """Training time at which the middle of a copy is demanded: the integral of the weight, inverted."""
    share = _share(copy)
    start = 1 - F.col("_drift")
    root = F.sqrt(start * start + 4 * F.col("_drift") * share)
    return F.when(F.col("_target") > 0, F.least(F.lit(1.0), 2 * share / (start + root))).otherwise(F.lit(0.0))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: (id, size, source_size, target, taken, first_position), sorted by ranges of the position.

    `first_position` is NULL for a document that the mix does not take.
    """
    sized = settle(_sized(docs, id_col, text_col, source_col, False), "mix-sized")
    planned = _planned(sized, source_targets(sized))
    placed = planned.select(
        F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_total").alias("source_size"),
        F.col("_target").alias("target"), (F.col("_copies") * F.col("_size")).alias("taken"),
        F.when(F.col("_copies") > 0, _position(F.lit(0))).alias("first_position"))
    return placed.repartitionByRange("first_position", id_col).sortWithinPartitions("first_position", id_col)


def curriculum(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source") -> DataFrame:
    """The rows of `docs` as often as the mix takes them, sorted by training position."""
    targets = source_targets(settle(_sized(docs, id_col, text_col, source_col, False), "mix-sized"))
    planned = _planned(_sized(docs, id_col, text_col, source_col, True), targets)
    copies = planned.filter("_copies > 0").withColumn(
        "_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
    placed = copies.select(_position(F.col("_copy")).alias("_position"), "_id", "_copy", "_doc")
    order = ["_position", "_id", "_copy"]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).select("_doc.*")
