"""Exact integer k-means, with nearest centroids found in the Walsh-Hadamard domain.

The transform keeps squared distances up to a fixed factor and gathers much of a smooth vector in its first coefficients.
Differences to the centroids are added up over coefficients from coarse to fine. Sums only grow: a centroid whose partial
sum is above another one's whole distance is out, and only those left go on to the last coefficient. All in integers.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from borelog.support import materialise

# Components below this in size, and scaled ones below LIMIT * scale, keep all sums of 64 coefficients within 64 bits.
LIMIT = 1 << 14
LEVELS = (4, 12, 28)


def sequency(dims: int) -> np.ndarray:
    """Order of the transform's rows by their changes of sign."""
    signs = np.ones((1, 1), np.int64)
    while len(signs) < dims:
        signs = np.block([[signs, signs], [signs, -signs]])
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1))


def transform(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of integer rows, coarse coefficients first; the length is a power of two."""
    n, dims = rows.shape
    half, x = 1, rows.astype(np.int64)
    while half < dims:
        pairs = x.reshape(n, dims // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, dims)
        half *= 2
    return x[:, sequency(dims)]


def inverse(coefficients: np.ndarray) -> np.ndarray:
    """Back from the coefficients; exact, also for sums of transforms of integer rows given as Python integers."""
    dims = coefficients.shape[1]
    x = np.empty_like(coefficients)
    x[:, sequency(dims)] = coefficients
    half = 1
    while half < dims:
        pairs = x.reshape(len(x), dims // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), dims)
        half *= 2
    return x // dims


def nearest(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid of each row, both given by coefficients; ties go to the smaller number."""
    n, dims = rows.shape
    total, alive = np.zeros((n, len(centroids)), np.int64), np.ones((n, len(centroids)), bool)
    every, low = np.arange(n), 0
    for high in [level for level in LEVELS if level < dims] + [dims]:
        at, which = np.nonzero(alive)
        apart = rows[at, low:high] - centroids[which, low:high]
        total[at, which] += np.einsum("ij,ij->i", apart, apart)
        low = high
        if high < dims:
            # The centroid in the lead is finished first; what is already farther than its whole distance is out.
            lead = np.where(alive, total, np.iinfo(np.int64).max).argmin(axis=1)
            rest = rows[:, high:] - centroids[lead, high:]
            alive &= total <= (total[every, lead] + np.einsum("ij,ij->i", rest, rest))[:, None]
    best = np.where(alive, total, np.iinfo(np.int64).max).argmin(axis=1)
    return best, total[every, best] // dims


def _integers(vector: str, dims: int, scale: int):
    def read(batches):
        for batch in batches:
            if len(batch):
                rows = np.stack(batch[vector].to_numpy()).astype(np.float64)
                coefficients = transform(np.floor(rows * scale).astype(np.int64)).astype(np.int32)
                yield pd.DataFrame({"vec_id": batch.vec_id.array, "coefficients": list(coefficients)})

    return read


def _matrix(batch) -> np.ndarray:
    return np.stack(batch["coefficients"].to_numpy()).astype(np.int64)


def _update(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: componentwise floor of the mean of each centroid's vectors; a centroid without vectors stays.

    Each task adds up its own vectors; k * dims sums in exact decimals reach the driver, whatever the size of the table.
    """
    k, dims = centroids.shape

    def add(batches):
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            if len(batch):
                rows = _matrix(batch)
                best, _ = nearest(rows, centroids)
                counts += np.bincount(best, minlength=k)
                np.add.at(sums, best, rows)
        used = np.flatnonzero(counts)
        if len(used):
            yield pd.DataFrame({"cluster": used, "size": counts[used], "sums": list(sums[used])})

    parts = kept.select("coefficients").mapInPandas(add, "cluster long, size long, sums array<long>")
    spread = parts.select("cluster", "size", F.posexplode("sums").alias("at", "part"))
    totals = spread.groupBy("cluster", "at").agg(
        F.sum(F.col("size").cast("decimal(38,0)")).alias("size"), F.sum(F.col("part").cast("decimal(38,0)")).alias("sum")
    )
    sizes, sums = [0] * k, np.zeros((k, dims), object)
    for row in totals.collect():
        sizes[row.cluster], sums[row.cluster, row["at"]] = int(row["size"]), int(row["sum"])
    moved = centroids.copy()
    for cluster, size in enumerate(sizes):
        if size:
            means = inverse(sums[cluster : cluster + 1]) // size
            moved[cluster] = transform(means.astype(np.int64))[0]
    return moved


def first_centroids(kept: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors whose ids hash lowest, as coefficients; equal ids go by their coefficients."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = kept.orderBy(digest, "coefficients").limit(k).select("coefficients").collect()
    return np.array([row.coefficients for row in rows], np.int64)


def cluster(
    vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: str = "3", vector: str = "embedding"
) -> DataFrame:
    """Cluster the whole vectors of ``vectors`` (vec_id, vector): a row per vector that is kept.

    Vectors with other than ``dims`` components (a power of two), with one that is NULL, NaN, infinite or of a size of
    16,384 or more, are left out; components become floor(scale * x). The first centroids are the vectors whose hashed
    ids come first, fewer if fewer vectors are kept. Returns vec_id, cluster, distance (squared, to its final centroid)
    and centroid (its components). Repeated rows count as often as they are given, a NULL vec_id hashes like an empty
    one, an empty table gives an empty result, other columns are ignored.

    The coefficients are written once; each round reads them without a shuffle of vectors and starts from k rows, so a
    lost executor costs its tasks of one round.
    """
    if dims < 2 or dims & (dims - 1) or dims * dims * (2 * LIMIT * scale) ** 2 >= 1 << 63:
        raise ValueError("dims must be a power of two, and dims * scale small enough for 64-bit sums")
    spark = vectors.sparkSession
    whole = F.coalesce(
        (F.size(vector) == dims)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LIMIT)), F.lit(False)
    )
    rows = vectors.where(whole).select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    kept = materialise(rows.mapInPandas(_integers("vector", dims, scale), "vec_id long, coefficients array<int>"))
    centroids = first_centroids(kept, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, centroid array<long>")
    for _ in range(rounds):
        centroids = _update(kept, centroids)
    final = [list(map(int, row)) for row in inverse(centroids)]

    def assign(batches):
        for batch in batches:
            if len(batch):
                best, distance = nearest(_matrix(batch), centroids)
                yield pd.DataFrame({"vec_id": batch.vec_id.array, "cluster": best.astype(np.int32), "distance": distance})

    assigned = kept.mapInPandas(assign, "vec_id long, cluster int, distance long")
    centres = spark.createDataFrame(list(enumerate(final)), "cluster int, centroid array<long>")
    return assigned.join(F.broadcast(centres), "cluster").select("vec_id", "cluster", "distance", "centroid")
