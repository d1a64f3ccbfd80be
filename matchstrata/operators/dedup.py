"""One row per key under an explicit order.

Every form is ``row_number() = 1``. Catalyst turns that into a group limit that
runs before the shuffle, so a key with a third of all rows sends one row per
map task, not its whole group, to one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the given order; NULL keys form one group."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def keep_first(df: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """The row that arrived first, by the columns that tell the arrival order."""
    return keep_one(df, keys, [F.asc(c) for c in arrival])


def keep_last(df: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """The row that arrived last."""
    return keep_one(df, keys, [F.desc(c) for c in arrival])


def keep_latest(
    df: DataFrame,
    keys: Sequence[str] = ("event_id",),
    version: str = "extract_date",
    tie_break: Sequence[Column | str] | None = None,
) -> DataFrame:
    """The row with the newest version of each key; a NULL version is oldest.

    Ties on the version are settled by ``tie_break`` or, without one, by all
    other columns in order, so that a rerun keeps the same row.
    """
    if tie_break is None:
        tie_break = [F.desc_nulls_last("extracted_at")] if "extracted_at" in df.columns else []
        tie_break += [c for c in df.columns if c not in {*keys, version, "extracted_at"}]
    return keep_one(df, keys, [F.desc_nulls_last(version), *tie_break])
