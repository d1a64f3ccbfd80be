"""Helpers shared by the training-data operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchstrata.session import stage

#: Rows up to which a table of a few fixed-width columns is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 500_000

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row of the partition below


def scan(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else unchanged.

    For stored frames of fixed-width columns only: their count is cheap, and it
    bounds their size. Beyond the bound the join shuffles, with AQE splitting
    skewed keys.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def text_bytes(column: Column | str) -> Column:
    """UTF-8 bytes of a text, none for null."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit("")).cast("binary")


def numbered(df: DataFrame, order: list[Column], out: str, label: str) -> DataFrame:
    """``df`` with ``out``, its row number from 0 in the order given.

    Rows are range-partitioned and sorted, and stored with their place inside
    their partition; the number is that place plus the rows of all partitions
    before, so no task sees more than one range.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__row", F.monotonically_increasing_id())
    )
    stored = stage(placed, label).df
    part = F.shiftright("__row", _ROW_BITS)
    before = (
        Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    )
    starts = (
        stored.groupBy(part.alias("__part"))
        .agg(F.count("*").alias("__n"))
        .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    )
    starts = stage(starts, f"{label}-starts").df  # stored, so that Catalyst knows its size
    return (
        stored.withColumn("__part", part)
        .join(starts, "__part")
        .withColumn(out, F.col("__start") + F.col("__row").bitwiseAND((1 << _ROW_BITS) - 1))
        .drop("__part", "__row", "__start")
    )


def components(edges: DataFrame, label: str = "links") -> DataFrame:
    """``node, component`` of every node of the undirected ``edges (a, b)``.

    The component is its smallest node. Large-star and small-star rounds: each
    step points the neighbours of a node at its smallest neighbour, until all
    point at their component's smallest. Each round is stored, so lineage stays
    short; the smallest neighbour is a pre-aggregated minimum joined back, never
    a collected list.
    """
    edges = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    current = stage(_downward(edges), f"{label}-0")
    state = _checksum(current.df)
    done = False
    step = 0
    while not done:
        step += 1
        grown = stage(_small_star(_large_star(current.df)), f"{label}-{step}")
        new_state = _checksum(grown.df)
        done = new_state == state
        state = new_state
        current.discard()
        current = grown
    stars = current.df
    roots = stars.select(F.col("b").alias("node")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _downward(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller end."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a").where("b > a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    pairs = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return pairs.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"),
    ).first()
    return row["n"], row["s"]


def either(conditions: list[Column]) -> Column:
    return reduce(lambda x, y: x | y, conditions, F.lit(False))
