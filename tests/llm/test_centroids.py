import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from borelog.llm.centroids import cluster, inverse, nearest, transform


def brute(rows, k=8, rounds=10, dims=64, scale=1024, seed="3"):
    kept = []
    for vec_id, vector in rows:
        if vector is not None and len(vector) == dims and all(x is not None and abs(x) < 1 << 14 for x in vector):
            kept.append((vec_id, np.array([int(np.floor(scale * float(x))) for x in vector], object)))
    name = lambda vec_id: hashlib.sha256(f"{seed}:{'' if vec_id is None else vec_id}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), transform(r[1][None])[0].tolist()))[:k]]
    place = lambda: [min((((v - c) ** 2).sum(), i) for i, c in enumerate(centroids)) for _, v in kept]
    for _ in range(rounds):
        best = [i for _, i in place()]
        for i in range(len(centroids)):
            members = [v for (_, v), b in zip(kept, best) if b == i]
            if members:
                centroids[i] = sum(members) // len(members)
    return sorted(((vec_id, i, int(d), [int(x) for x in centroids[i]]) for (vec_id, _), (d, i) in zip(kept, place())), key=repr)


def ours(spark, rows, **options):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for c in ("cluster", "distance", "centroid", "coefficients", "size", "at"):
        vectors = vectors.selectExpr("*", f"'clash' AS {c}")
    return sorted(map(tuple, cluster(vectors, **options).collect()), key=repr)


def test_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=64) + 3 * (i % 5)).tolist()) for i in range(150)]
    rows += [(7, rows[7][1]), (7, rows[9][1]), (None, rows[3][1]), (200, [16383.9] * 64), (201, [-16383.9] * 64)]
    assert ours(spark, rows) == brute(rows)


def test_rows_that_are_left_out(spark):
    whole = [0.5, -0.25] * 32
    bad = [None, [], whole[:63], [*whole, 1.0], [None, *whole[1:]], [float("nan"), *whole[1:]], [float("inf"), *whole[1:]], [-float("inf"), *whole[1:]], [1e300, *whole[1:]]]
    rows = [*enumerate(bad), (50, whole), (51, whole), (52, [-x for x in whole])]
    assert ours(spark, rows) == brute(rows) and len(ours(spark, rows)) == 3
    assert ours(spark, list(enumerate(bad))) == []
    assert ours(spark, []) == []


def test_copies_ties_and_options(spark):
    rows = [(i, [0.0] * 8) for i in range(30)] + [(i, [1.0] * 8) for i in range(30, 33)] + [(40, [0.5] * 8)]
    options = {"k": 5, "rounds": 3, "dims": 8, "scale": 2, "seed": "s"}
    assert ours(spark, rows, **options) == brute(rows, **options)
    with pytest.raises(ValueError):
        ours(spark, rows, dims=12)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 9), st.sampled_from([2, 16, 64]), st.sampled_from([2, 5, 1 << 24]))
def test_progressive_search(seed, k, dims, size):
    rng = np.random.default_rng(seed)
    rows, centroids = rng.integers(-size, size, (40, dims)), rng.integers(-size, size, (k, dims))
    assert (inverse(transform(rows)) == rows).all()
    best, distance = nearest(transform(rows), transform(centroids))
    apart = ((rows[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (best == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()
