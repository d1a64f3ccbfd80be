"""Exact top-k by inner product, with bounds from segment statistics, coarse to fine.

A vector is cut into equal segments, each told by its mean and the length of its
deviation from it. For two vectors, the segments' means give a part of the inner
product exactly, and the deviations bound the rest (Cauchy-Schwarz), so

    q . x  <=  sum over segments of  m * mean(q) * mean(x) + dev(q) * dev(x),

which is the lower bound on their distance that the statistics allow. Few wide
segments are tried first, then more narrow ones on what is left, and the exact
product is computed for the survivors alone.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchstrata.session import stage

SEGMENTS = (4, 8, 16)
ROWS_PER_BLOCK = 4_096
QUERIES_PER_BLOCK = 512
#: Bytes of query vectors that are broadcast at once, about; more queries take several passes over the vectors.
QUERY_BYTES = 1 << 25
#: Tasks that the blocks of vectors are dealt over at most.
TASKS = 4_096


def quantized(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256) -> DataFrame:
    """``row, vec_id, dim, vector``: components times ``scale``, rounded down to integers.

    Vectors that are null or empty, or hold a null or non-finite component, are
    left out. ``row`` tells rows with one id apart.
    """
    x = F.col(embedding)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (
        vectors.where(x.isNotNull() & (F.size(x) > 0) & ~bad)
        .select(
            F.col(vec_id).cast("long").alias("vec_id"),
            F.size(x).alias("dim"),
            F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("vector"),
        )
        .withColumn("row", F.monotonically_increasing_id())
    )


def _blocks(rows: DataFrame, size: int, side: str, tasks: int = 1) -> DataFrame:
    """Runs of at most ``size`` neighbouring rows as one row with their vectors, dealt over ``tasks`` partitions."""
    place = F.monotonically_increasing_id()
    return (
        rows.withColumn("__run", F.floor(place / size))
        .repartition(tasks, "dim", "__run")
        .groupBy("dim", "__run")
        .agg(
            F.collect_list(F.struct("row", "vec_id", "vector")).alias("rows"),
        )
        .select(
            "dim",
            F.col("__run").alias(f"{side}_run"),
            F.col("rows.row").alias(f"{side}_row"),
            F.col("rows.vec_id").alias(f"{side}_id"),
            F.flatten("rows.vector").alias(f"{side}_flat"),
        )
    )


def _statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Per vector: scaled means and deviation lengths of its segments (the last may be longer)."""
    cuts = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)
    sizes = np.diff(cuts)
    means = np.add.reduceat(x, cuts[:-1], axis=1) / sizes
    squares = np.add.reduceat(x * x, cuts[:-1], axis=1)
    deviations = np.sqrt(np.maximum(squares - sizes * means * means, 0))
    return np.hstack([means * np.sqrt(sizes), deviations])


def block_top_k(queries, query_rows, vectors, ids, rows, k: int, floor: np.ndarray | None = None):
    """For each query: positions and scores of its ``k`` best rows of the block, itself apart.

    Rows whose score is below the query's ``floor`` may be left out.
    """
    q, x = queries.astype(np.float64), vectors.astype(np.float64)
    levels = [(_statistics(q, s), _statistics(x, s)) for s in SEGMENTS]
    coarse = levels[0][0] @ levels[0][1].T
    # Products of floats may err by a few parts in 10^13; the bound is widened by far more.
    slack = 1e-9 * np.linalg.norm(q, axis=1) * max(np.linalg.norm(x, axis=1).max(initial=0.0), 1.0) + 1e-6
    # Sums of whole numbers below 2^53 are exact in floats too, and quicker.
    whole = q.shape[1] * np.abs(q).max(initial=0.0) * np.abs(x).max(initial=0.0) < 2**53

    def product(at: np.ndarray, n: int) -> np.ndarray:
        return (x[at] @ q[n]).astype(np.int64) if whole else vectors[at] @ queries[n]

    few, out = 4 * k, []
    for n in range(len(q)):
        bound = coarse[n].copy()
        bound[rows == query_rows[n]] = -np.inf
        least = -np.inf if floor is None else floor[n] - slack[n]
        left = np.flatnonzero((bound >= least) & (bound > -np.inf))
        if len(left) > few:
            likely = left[np.argpartition(-bound[left], few - 1)[:few]]
            least = max(least, np.partition(product(likely, n), -k)[-k] - slack[n])
            left = left[bound[left] >= least]
        for of_q, of_x in levels[1:]:
            if len(left) <= few:
                break
            left = left[of_x[left] @ of_q[n] >= least]
        exact = product(left, n)
        best = np.lexsort((ids[left], -exact))[:k]
        out.append((left[best], exact[best]))
    return out


def _best_of(one: list[np.ndarray], two: list[np.ndarray], queries: int, k: int) -> list[np.ndarray]:
    """The ``k`` best of each query in two lists of query, score, id and whether the id is null."""
    both = [np.concatenate(c) for c in zip(one, two, strict=True)]
    order = np.lexsort((both[2], -both[1], both[0]))
    query = both[0][order]
    starts = np.searchsorted(query, np.arange(queries))
    return [c[order[np.arange(len(order)) - starts[query] < k]] for c in both]


def _least_of(found: list[np.ndarray], queries: int, k: int) -> np.ndarray:
    """The score of each query's ``k``-th best in a list as from ``_best_of``; none counts as endlessly low."""
    floor = np.full(queries, -np.inf)
    full = np.flatnonzero(np.bincount(found[0], minlength=queries) == k)
    np.minimum.at(least := np.full(queries, np.inf), found[0], found[1].astype(np.float64))
    floor[full] = least[full]
    return floor


def top_k(vectors: DataFrame, is_query, k: int = 5) -> DataFrame:
    """``query_row, query_id, rank, vec_id, score`` of each query's ``k`` highest integer products.

    ``vectors`` as from ``quantized``; ``is_query`` is a condition on its columns.
    A query meets every row but itself, also other rows with its id; only vectors
    of its own dimension count. Ties go to the smaller id. Fewer rows than ``k``
    give fewer ranks; no rows give none. Scores are exact while they fit 63 bits.

    Queries and rows meet in blocks: the blocks of queries, of so many at a time as
    ``QUERY_BYTES`` allows, are broadcast to the blocks of rows, and a task hands on
    the ``k`` best rows of all its blocks for each query.
    """
    rows = stage(vectors, "vectors")
    n_blocks = max(1, -(-rows.df.count() // ROWS_PER_BLOCK))
    base = stage(_blocks(rows.df, ROWS_PER_BLOCK, "x", min(TASKS, n_blocks)), "blocks").df
    of_queries = rows.df.where(is_query)
    n_queries = -(-(of_queries.count()) // QUERIES_PER_BLOCK)
    asked = stage(_blocks(of_queries, QUERIES_PER_BLOCK, "q", max(1, min(TASKS, n_queries))), "queries").df
    rows.discard()
    # A task holds the queries of a pass and, of each, the best rows so far.
    held = F.size("q_flat").cast("long") * 8 + F.size("q_row").cast("long") * 64 * k
    passes = max(1, -(-(asked.agg(F.sum(held)).first()[0] or 0) // QUERY_BYTES))

    def run(batches):
        best = {}  # by run of queries: their rows and ids, and the best found so far
        for batch in batches:
            for one in range(batch.num_rows):
                dim, q_run, q_row, q_id, q, x_row, x_id, x = (c[one] for c in batch.columns)
                values = lambda s: s.values.to_numpy(zero_copy_only=False)
                dim, query_rows = dim.as_py(), values(q_row)
                ids = x_id.values.fill_null(np.iinfo(np.int64).min).to_numpy()  # a null id comes first
                queries, block = values(q).reshape(-1, dim), values(x).reshape(-1, dim)
                where = (dim, q_run.as_py())
                floor = _least_of(best[where][2], len(queries), k) if where in best else None
                found = block_top_k(queries, query_rows, block, ids, values(x_row), k, floor)
                counts = [len(p) for p, _ in found]
                at = np.concatenate([p for p, _ in found])
                null = x_id.values.is_null().to_numpy(zero_copy_only=False)
                new = [np.repeat(np.arange(len(found)), counts), np.concatenate([s for _, s in found]), ids[at], null[at]]
                if where in best:
                    best[where][2] = _best_of(best[where][2], new, len(found), k)
                else:
                    best[where] = [query_rows.copy(), q_id.values.to_pylist(), new]
        for query_rows, query_ids, (query, score, ids, null) in best.values():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(query_rows).take(pa.array(query)),
                    pa.array(query_ids, pa.int64()).take(pa.array(query)),
                    pa.array(ids, mask=null),
                    pa.array(score),
                ],
                names=["query_row", "query_id", "vec_id", "score"],
            )

    def met(some: DataFrame) -> DataFrame:
        pairs = base.join(F.broadcast(some), "dim")  # at most QUERY_BYTES, about
        return pairs.select("dim", "q_run", "q_row", "q_id", "q_flat", "x_row", "x_id", "x_flat").mapInArrow(
            run, "query_row long, query_id long, vec_id long, score long"
        )

    if passes == 1:
        found = met(asked)
    else:
        share = F.pmod(F.xxhash64("dim", "q_run"), F.lit(passes))
        parts = [stage(met(asked.where(share == p)), f"found-{p}").df for p in range(passes)]
        found = reduce(DataFrame.unionByName, parts)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc("vec_id"))
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_row", "query_id", "rank", "vec_id", "score")
    )
