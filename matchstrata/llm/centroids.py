"""Centroid clustering on integer vectors, each vector assigned by a tournament of bisectors.

For two centroids ``a`` and ``b`` the sign of an integer linear form tells which is
nearer: ``2 (b - a) . x`` against ``|b|^2 - |a|^2``, zero meaning that both are
equally far. Normals and thresholds of all pairs are made once a round. A vector
starts with centroid 0 as its winner; each further centroid is tried against the
winner by one sign test and takes over only if it is nearer, so ties stay with the
smaller number. After ``k - 1`` tests one is left, and only to this one the
distance is computed. Everything is exact.

Spark deals the vectors to tasks; a task hands on, for each centroid, how many
vectors it won and their sums. These are added up by Spark, and the driver gets
one row for each centroid: ``k`` times the dimension numbers, whatever the input.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchstrata.session import stage

CENTROIDS = 40
ROUNDS = 5
DIMENSION = 64
SCALE = 256
SEED = 2
#: Components beyond this (after scaling) could take a distance past 63 bits; their vectors are refused.
MOST = 1 << 27
_ROWS_AT_ONCE = 4_096


def quantized(vectors: DataFrame, dimension: int = DIMENSION, scale: int = SCALE) -> DataFrame:
    """``vec_id, vector``: components times ``scale``, rounded down.

    Vectors that are null, have another dimension, or hold a null or non-finite
    component are left out. A component whose scaled value lies beyond ``MOST``
    ends the query with that message, since distances would not fit.
    """
    x = F.col("embedding")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))

    def whole(c):
        value = F.floor(c.cast("double") * scale)
        too_far = F.raise_error(F.concat(F.lit("vector component out of range: "), c.cast("string"))).cast("long")
        return F.when(F.abs(c.cast("double") * scale) <= MOST, value.cast("long")).otherwise(too_far)

    kept = vectors.where(x.isNotNull() & (F.size(x) == dimension) & ~bad)
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, whole).alias("vector"))


def first_centroids(vectors: DataFrame, k: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The ``k`` vectors with the smallest digests of ``seed`` and id; fewer, if there are fewer.

    Vectors with one id come in the order of their components; a null id counts as an empty one.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = vectors.select("vector", digest.alias("digest")).orderBy("digest", "vector").limit(k).collect()
    return np.array([r["vector"] for r in chosen], np.int64)


class Bisectors:
    """Sign tests of all pairs of centroids."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        squares = (centroids * centroids).sum(axis=1)
        # [winner, challenger]: the challenger is nearer where the product with the normal exceeds the threshold.
        self.normals = 2 * (centroids[None, :, :] - centroids[:, None, :])
        self.thresholds = squares[None, :] - squares[:, None]

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """The winner of each row of ``x``; of equally near centroids the smaller number."""
        winner = np.zeros(len(x), np.int64)
        for challenger in range(1, len(self.centroids)):
            # Rows with one winner meet the same normal.
            order = np.argsort(winner, kind="stable")
            present, starts = np.unique(winner[order], return_index=True)
            for w, rows in zip(present.tolist(), np.split(order, starts[1:]), strict=True):
                side = x[rows] @ self.normals[w, challenger] > self.thresholds[w, challenger]
                winner[rows[side]] = challenger
        return winner

    def distances(self, x: np.ndarray, winner: np.ndarray) -> np.ndarray:
        apart = x - self.centroids[winner]
        return (apart * apart).sum(axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _won(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``cluster, n, sums``: per task and centroid, how many vectors it won and their sums."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)  # k times the dimension

    def run(batches):
        tests = Bisectors(shared.value)
        n = np.zeros(len(tests.centroids), np.int64)
        sums = np.zeros(tests.centroids.shape, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS_AT_ONCE):
                x = _matrix(batch.column(0).slice(start, _ROWS_AT_ONCE))
                winner = tests.nearest(x)
                n += np.bincount(winner, minlength=len(n))
                np.add.at(sums, winner, x)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(n[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"],
        )

    return vectors.select("vector").mapInArrow(run, "cluster int, n long, sums array<long>")


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after a round: the floor of the exact mean of what each won; empty ones stay."""
    parts = _won(vectors, centroids).select("cluster", "n", F.posexplode("sums").alias("at", "value"))
    exact = "decimal(38,0)"
    totals = parts.groupBy("cluster", "at").agg(F.sum(F.col("n").cast(exact)).alias("n"), F.sum(F.col("value").cast(exact)).alias("total"))
    out = centroids.copy()
    for r in totals.collect():  # k times the dimension rows
        out[r["cluster"], r["at"]] = int(r["total"]) // int(r["n"])
    return out


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)  # k times the dimension

    def run(batches):
        tests = Bisectors(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS_AT_ONCE):
                part = batch.slice(start, _ROWS_AT_ONCE)
                x = _matrix(part.column(1))
                winner = tests.nearest(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(winner, pa.int32()), pa.array(tests.distances(x, winner))],
                    names=["vec_id", "cluster", "distance"],
                )

    return vectors.select("vec_id", "vector").mapInArrow(run, "vec_id long, cluster int, distance long")


def clustered(
    embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimension: int = DIMENSION, seed: int = SEED
) -> DataFrame:
    """Per vector: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid, centroid_sha256``.

    ``distance`` is squared; the inertias are its sums over the cluster and over
    all vectors. The digest is that of the centroid's components joined by
    commas. Null, repeated ids and equal vectors are all kept; with fewer vectors
    than ``k`` each starts as a centroid; no vectors give no rows. Columns other
    than ``vec_id`` and ``embedding`` are not looked at.
    """
    spark = embeddings.sparkSession
    vectors = stage(quantized(embeddings, dimension), "cluster-vectors").df
    centroids = first_centroids(vectors, k, seed)
    if len(centroids):
        for _ in range(rounds):
            centroids = moved(vectors, centroids)
    else:
        centroids = np.zeros((1, dimension), np.int64)  # there is nothing to assign
    found = stage(assigned(vectors, centroids), "cluster-vectors-assigned").df
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = found.groupBy("cluster").agg(exact.alias("total")).collect()  # a row for each centroid
    whole = sum(int(r["total"]) for r in sums)
    rows = []
    for r in sums:
        centroid = centroids[r["cluster"]].tolist()
        digest = hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
        rows.append((r["cluster"], int(r["total"]), whole, centroid, digest))
    schema = "cluster int, cluster_inertia long, inertia long, centroid array<long>, centroid_sha256 string"
    return found.join(F.broadcast(spark.createDataFrame(rows, schema)), "cluster").select(  # at most k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid", "centroid_sha256"
    )
