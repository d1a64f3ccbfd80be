"""Positions and leaders within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage
from .dedup import keep_one

# monotonically_increasing_id(): partition number above, row number below.
_ROW_BITS = 33


def positions(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], name: str = "position"
) -> DataFrame:
    """Position 1..n of every row in its group, for a total ``order``.

    ``row_number()`` would sort a whole group in one task. Here the rows are
    range-partitioned by group and order, so a hot group spans many tasks;
    each row's slot in the sorted partitions is stored, and a position is the
    slot within the partition plus the group's row count in earlier ones. The
    per-partition counts are at most groups + partitions rows.
    """
    order = [F.asc(c) if isinstance(c, str) else c for c in order]
    groups = [F.asc(c) for c in group]
    slots = stage(
        df.repartitionByRange(*groups, *order)
        .sortWithinPartitions(*groups, *order)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "positions",
    ).df.withColumn("_part", F.shiftright("_slot", _ROW_BITS))

    spans = slots.groupBy(*group, "_part").agg(
        F.min("_slot").alias("_first"), F.count("*").alias("_rows")
    )
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = spans.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.col("_part").alias("_p"),
        "_first",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
    )
    same = slots._part == starts._p
    for i, g in enumerate(group):
        same = same & slots[g].eqNullSafe(starts[f"_g{i}"])
    place = (F.col("_slot") - F.col("_first") + F.col("_before") + 1).cast("bigint")
    return slots.join(starts, same).select(*[slots[c] for c in df.columns], place.alias(name))


def numbered(df: DataFrame, name: str = "place") -> DataFrame:
    """The rows of an ordered frame, numbered from 1 in the order it has.

    A sorted frame is sorted within and between its partitions: each row's slot is
    stored as written, and what lies before its partition is added.
    """
    slots = stage(df.withColumn("_slot", F.monotonically_increasing_id()), "numbered").df
    slots = slots.withColumn("_part", F.shiftright("_slot", _ROW_BITS))
    earlier = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    starts = (
        slots.groupBy(F.col("_part").alias("_p"))
        .agg(F.min("_slot").alias("_first"), F.count("*").alias("_rows"))
        .select("_p", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    place = (F.col("_slot") - F.col("_first") + F.col("_before") + 1).cast("bigint")
    return slots.join(starts, F.col("_part") == F.col("_p")).select(*df.columns, place.alias(name))


def top_of_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """The first row of each group; a group limit runs before the shuffle."""
    return keep_one(df, group, order)
