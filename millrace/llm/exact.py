"""Exact duplicates of texts by progressive refinement.

Length, then a hash of the first characters, then a hash of the whole text:
each level looks only at what the level before could not tell apart. A
(length, prefix) pair that occurs twice has a length that occurs twice, so the
first two levels are one grouping, combined before its shuffle; a group of any
size is one row from then on. The full content is hashed for the rows of
contested pairs only.

Two texts are equal when their SHA-256 digests are; NULL counts as empty. Of
equal texts the row with the largest id stays (a NULL id is below every id). Rows
that repeat an id and its text are told apart, and one of them stays. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.tables import settle

PREFIX_CHARS = 256


def _probes(text: Column) -> list[Column]:
    return [F.octet_length(text).alias("_len"), F.xxhash64(F.left(text, F.lit(PREFIX_CHARS))).alias("_prefix")]


def _contested(rows: DataFrame) -> DataFrame:
    """(length, prefix hash) pairs of more than one row, as a settled table of true size."""
    pairs = rows.groupBy(*_probes(F.col("_text"))).agg(F.count(F.lit(1)).alias("_n"))
    return settle(pairs.filter("_n > 1").select("_len", "_prefix", F.lit(True).alias("_open")), "exact-pairs")


def _groups(marked: DataFrame) -> DataFrame:
    """Per digest of contested rows: the id and the row that stay, and the group's size."""
    groups = marked.filter(F.col("_open") & F.col("_sha").isNotNull()).groupBy(F.col("_sha").alias("_digest")).agg(
        F.max("_id").alias("_keep_id"),
        F.coalesce(F.max_by("_row", "_id"), F.max("_row")).alias("_keep_row"),
        F.count(F.lit(1)).alias("_size"),
    )
    return settle(groups, "exact-groups")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digests: bool = False) -> DataFrame:
    """One row per row of `docs`: (id, keep_id, group_size, kept, text_sha256).

    `digests` fills text_sha256 for every row; else only contested rows have it.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"))
    pairs = _contested(rows)
    sha = F.sha2("_text", 256)
    probed = rows.select("_id", *_probes(F.col("_text")), sha.alias("_sha") if digests else F.col("_text"))
    found = probed.join(pairs, ["_len", "_prefix"], "left")
    digest = F.col("_sha") if digests else F.when(F.col("_open"), sha)
    marked = settle(found.select(
        F.monotonically_increasing_id().alias("_row"), "_id", digest.alias("_sha"),
        F.coalesce("_open", F.lit(False)).alias("_open"),
    ), "exact-rows")
    groups = _groups(marked)
    out = marked.join(groups, F.col("_sha") == F.col("_digest"), "left")
    alone = F.col("_keep_row").isNull()
    return out.select(
        F.col("_id").alias(id_col),
        F.when(alone, F.col("_id")).otherwise(F.col("_keep_id")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("_row") == F.col("_keep_row"))).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns.

    Only contested rows are written out and grouped; all others pass through.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    pairs = _contested(docs.select(text.alias("_text")))
    packed = docs.select(F.col(id_col).alias("_id"), F.struct("*").alias("_doc"), *_probes(text))
    content = F.coalesce(F.col("_doc").getField(text_col), F.lit(""))
    open_rows = settle(
        packed.join(pairs, ["_len", "_prefix"], "inner").select(
            F.monotonically_increasing_id().alias("_row"), "_id", "_doc", "_open", F.sha2(content, 256).alias("_sha")),
        "exact-open")
    keep = _groups(open_rows.select("_row", "_id", "_open", "_sha")).select(F.col("_keep_row").alias("_row"))
    stay = open_rows.join(keep, "_row", "left_semi").select("_doc.*")
    alone = packed.join(pairs, ["_len", "_prefix"], "left_anti").select("_doc.*")
    return alone.unionByName(stay)
