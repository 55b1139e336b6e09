"""One row per key, without ever gathering a hot key in one task.

`row_number() = 1` is planned by Spark as a per-task group limit before the shuffle, so each map
task sends at most one row per key however many copies it read."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COPY_SPREAD = 64
LINEAGE_ORDER = ("_ingested_at", "_source_file", "_row_position")


def first_per(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def content_hash(df: DataFrame) -> Column:
    """Last tie-break: rows that still tie are equal in every column."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def latest(df: DataFrame, key: str, order: list[Column] | None = None) -> DataFrame:
    """The most recently ingested version of each key, by time, file, and place in the file.

    Only those are compared, never the row's content, so the columns that nobody asks for are
    neither scanned nor shuffled. The place is stored at ingestion; a table without it has one
    row per key and file."""
    if order is None:
        order = [F.col(c).desc_nulls_last() for c in LINEAGE_ORDER if c in df.columns]
    return first_per(df, [key], order)


def mark_copies(df: DataFrame, key: str, row_id: str, newest_file_wins: bool,
                eligible: Column | None = None, spread: int = COPY_SPREAD) -> DataFrame:
    """Adds `_is_copy`: true on all eligible rows of a key but the winner.

    Every copy is needed (each one is rejected and logged), so there is no group limit to prune
    them. Ranking runs in two levels: first inside (key, slice), where the slice comes from
    `row_id`, so even a group of identical rows is spread over `spread` tasks; then among the
    slice winners, at most `spread` rows per key, while the losers stay in their slices. Rows that are
    not eligible form groups of one. It is one frame, so its input is planned once.
    `row_id` must be stable when a task is recomputed: numbered at the scan, or a message
    position."""
    by_file = F.col("_source_file").desc() if newest_file_wins else F.col("_source_file").asc()
    order = [by_file, F.col("_content")]
    group = F.col(key)
    if eligible is not None:
        alone = F.concat(F.lit("\u0000"), F.col(row_id).cast("string"))
        group = F.when(eligible, group).otherwise(alone)
    sliced = df.withColumns({"_content": content_hash(df), "_group": group,
                             "_slice": F.pmod(F.xxhash64(row_id), F.lit(spread))})
    local = sliced.withColumn(
        "_local", F.row_number().over(Window.partitionBy("_group", "_slice").orderBy(*order)))
    lane = F.when(F.col("_local") == 1, F.lit(-1)).otherwise(F.col("_slice"))
    final = F.row_number().over(Window.partitionBy("_group", "_lane").orderBy(*order, F.col("_slice")))
    ranked = local.withColumn("_lane", lane).withColumn("_final", final)
    return (ranked.withColumn("_is_copy", (F.col("_local") > 1) | (F.col("_final") > 1))
            .drop("_content", "_slice", "_local", "_group", "_lane", "_final"))
