"""Centroid clustering against plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest

from matchstrata.llm import centroids

ROWS = "vec_id long, embedding array<float>, label int, cluster int, distance long, vector string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, 2, 3, "x") for i, v in rows], ROWS).repartition(parts)


def plain(rows, k, rounds, dimension):
    """Every distance of every vector to every centroid, in whole numbers."""
    kept = []
    for i, v in rows:
        if v is None or len(v) != dimension or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    digest = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    cents = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]

    def assign():
        out = []
        for _, v in kept:
            far = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in cents]
            out.append((far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        won = assign()
        for c in range(len(cents)):
            mine = [v for (_, v), (w, _) in zip(kept, won, strict=True) if w == c]
            if mine:
                cents[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    won = assign()
    total = sum(d for _, d in won)
    out = []
    for (i, _), (c, d) in zip(kept, won, strict=True):
        inertia = sum(d2 for c2, d2 in won if c2 == c)
        out.append((i, c, d, inertia, total, cents[c], hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest()))
    return out


def vectors(rng, n, dimension):
    middles = [[rng.uniform(-2, 2) for _ in range(dimension)] for _ in range(5)]
    rows = []
    for i in range(n):
        m = rng.choice(middles)
        rows.append((i, [x + rng.gauss(0, 0.3) for x in m]))
    return rows


@pytest.mark.parametrize("k, rounds, dimension", [(7, 3, 8), (40, 5, 64), (3, 0, 4), (1, 2, 8)])
def test_clusters_are_those_of_brute_force(spark, k, rounds, dimension):
    rng = random.Random(k)
    rows = vectors(rng, 300, dimension)
    rows += [(1, rows[0][1]), (1, rows[0][1]), (2, rows[3][1]), (None, rows[5][1]), (None, [0.0] * dimension)]
    rows += [(900, None), (901, []), (902, [1.0]), (903, [float("nan")] * dimension), (904, [float("inf")] + [0.0] * (dimension - 1))]
    rows += [(905, [None] + [0.0] * (dimension - 1))]
    got = centroids.clustered(frame(spark, rows), k, rounds, dimension).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain(rows, k, rounds, dimension), key=repr)


def test_ties_go_to_the_smaller_number(spark):
    rows = [(i, [float(i % 3 - 1), 0.0]) for i in range(30)] + [(99, [0.5, 0.0]), (98, [-0.5, 0.0])]
    got = centroids.clustered(frame(spark, rows), 12, 4, 2).collect()  # several centroids are equal
    assert sorted(map(tuple, got), key=repr) == sorted(plain(rows, 12, 4, 2), key=repr)
    x = np.array([[0, 0], [5, 5], [1, 0]], np.int64)
    tests = centroids.Bisectors(np.array([[2, 0], [0, 0], [2, 0], [0, 0]], np.int64))
    assert tests.nearest(x).tolist() == [1, 0, 0]


def test_tournament_is_the_nearest_centroid():
    rng = np.random.default_rng(3)
    for _ in range(20):
        c = rng.integers(-4, 5, (int(rng.integers(1, 30)), 3))
        x = rng.integers(-5, 6, (200, 3))
        far = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        tests = centroids.Bisectors(c)
        winner = tests.nearest(x)
        assert (winner == far.argmin(axis=1)).all() and (tests.distances(x, winner) == far.min(axis=1)).all()


def test_few_or_no_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, [-0.001, 3.0])]
    assert sorted(map(tuple, centroids.clustered(frame(spark, rows), dimension=2).collect())) == sorted(plain(rows, 40, 5, 2))
    assert centroids.clustered(frame(spark, rows).limit(0), dimension=2).count() == 0
    assert centroids.clustered(frame(spark, [(1, None)]), dimension=2).count() == 0


def test_components_that_are_too_large_are_named(spark):
    big = frame(spark, [(1, [1.0, 2.0]), (2, [1e30, 3.0])])
    with pytest.raises(Exception, match="out of range"):
        centroids.clustered(big, dimension=2)
