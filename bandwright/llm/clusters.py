"""Centroid clustering of vectors in whole numbers, each assignment by Orchard's search.

The centroids are few and known to every task; the vectors never move. To find the nearest centroid, the search walks
the list of the centroids nearest to the best one so far, jumps to the list of any closer one it finds, and stops at the
first that is farther from the best than twice the vector is: by the triangle inequality nothing beyond can be closer.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import arrow_function, package_on_workers, shielded, unshielded

SCALE = 256


@dataclass(frozen=True)
class Centroids:
    """Centroids (k, d), for each the others by distance, and those squared distances."""

    at: np.ndarray
    order: np.ndarray
    apart: np.ndarray

    @classmethod
    def of(cls, rows: list[list[int]]) -> Centroids:
        at = np.array(rows, np.int64)
        apart = ((at[:, None, :] - at[None, :, :]) ** 2).sum(axis=2)
        np.fill_diagonal(apart, -1)
        order = apart.argsort(axis=1, kind="stable")[:, 1:]
        return cls(at, order, np.take_along_axis(apart, order, axis=1))

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each vector (the smallest of several) and its squared distance."""
        n, k = len(vectors), len(self.at)
        best = np.zeros(n, np.int64)
        distance = ((vectors - self.at[0]) ** 2).sum(axis=1)
        visited = np.zeros((n, k), bool)
        visited[:, 0] = True
        step = np.zeros(n, np.int64)
        searching = np.arange(n) if k > 1 else np.zeros(0, np.int64)
        while len(searching):
            here = best[searching]
            # Strictly beyond twice the distance; at exactly twice, another may be as near and have a smaller number.
            searching = searching[self.apart[here, step[searching]] <= 4 * distance[searching]]
            other = self.order[best[searching], step[searching]]
            step[searching] += 1
            new = ~visited[searching, other]
            rows, other = searching[new], other[new]
            visited[rows, other] = True
            found = ((vectors[rows] - self.at[other]) ** 2).sum(axis=1)
            closer = (found < distance[rows]) | (found == distance[rows]) & (other < best[rows])
            rows, other = rows[closer], other[closer]
            best[rows], distance[rows], step[rows] = other, found[closer], 0
            searching = searching[step[searching] < k - 1]
        return best, distance


def largest_component(dims: int) -> int:
    """Below this, four times a squared distance fits a long."""
    return math.isqrt((1 << 63) // (16 * dims)) - 1


def whole_numbers(vector: Column, dims: int, scale: int) -> tuple[Column, Column]:
    """Whether a vector is kept, and floor(scale * x) of its components."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    limit = largest_component(dims)

    def whole(x: Column) -> Column:
        number = F.floor(x.cast("double") * scale)
        far = F.raise_error(F.lit(f"a component of {limit} / {scale} or more: squared distances would not fit a long"))
        return F.when(F.abs(x.cast("double") * scale) < limit, number).otherwise(far.cast("long"))

    return (F.size(vector) == dims) & finite, F.transform(vector, whole)


def _matrix(values: pa.ListArray, dims: int) -> np.ndarray:
    return values.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


_SUMS = "cluster int, n long, distance long, sums array<long>"


def _sums(centroids: Centroids, dims: int):
    """One row per task and centroid: how many vectors it won, their distances and their sums."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids.at)
        count, far, sums = np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            vectors = _matrix(batch.column(0), dims)
            best, distance = centroids.nearest(vectors)
            count += np.bincount(best, minlength=k)
            np.add.at(far, best, distance)
            np.add.at(sums, best, vectors)
        won = np.flatnonzero(count)
        columns = [pa.array(won.astype(np.int32)), pa.array(count[won]), pa.array(far[won]), pa.array(list(sums[won]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "distance", "sums"])

    return of


def _won(numbers: DataFrame, centroids: Centroids, dims: int) -> dict[int, tuple[int, int, list[int]]]:
    """Per centroid that won vectors: their number, their distances and their sums, exact."""
    parts = numbers.mapInArrow(_sums(centroids, dims), _SUMS)
    whole = "decimal(20,0)"
    totals = parts.groupBy("cluster").agg(
        F.sum(F.col("n").cast(whole)).alias("n"),
        F.sum(F.col("distance").cast(whole)).alias("distance"),
        F.array(*(F.sum(F.col("sums")[i].cast(whole)) for i in range(dims))).alias("sums"),
    )
    return {row.cluster: (int(row.n), int(row.distance), [int(x) for x in row.sums]) for row in totals.collect()}


def centroid_clusters(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = 40,
    rounds: int = 5,
    dims: int = 64,
    seed: int = 2,
    scale: int = SCALE,
) -> tuple[DataFrame, list[list[int]]]:
    """The kept rows with `cluster`, `distance` (squared), `cluster_inertia`, `inertia` and `centroid_sha256`, and the
    final centroids.

    * Kept are vectors of exactly `dims` components, none NULL, NaN or infinite; a component x counts as
      floor(`scale` * x). Other rows (NULL vectors too) are left out.
    * The first centroids are the `k` kept vectors with the smallest hexadecimal SHA-256 of `seed:id` (a NULL id reads
      "null"; rows of one id by their components); all of them if fewer are kept. Repeated rows count each, and may be
      several centroids at one place, of which the first wins all.
    * Each round gives every vector to its nearest centroid (the smaller number of several) and moves each centroid to
      the exact floor of its vectors' mean; one without vectors stays.
    * An input column named like an output gives way. No rows kept, no rows out. A component so large that squared
      distances do not fit a long (see `largest_component`) is an error.

    Each round scans the vectors where they lie; only k rows per task are shuffled, and k centroids reach the driver.
    """
    if k < 1 or rounds < 0 or dims < 1:
        raise ValueError(f"k and dims must be at least 1 and rounds 0, not {k}, {dims}, {rounds}")
    inner, names = shielded(vectors, vec_id, vector)
    kept, numbers = whole_numbers(F.col(names[vector]), dims, scale)
    rows = inner.where(kept).withColumn("numbers", numbers)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(names[vec_id]).cast("string"), F.lit("null")))
    order = F.sha2(name.cast("binary"), 256)
    first = rows.select(order.alias("order"), "numbers").orderBy("order", "numbers").limit(k).collect()
    kinds = {"cluster": "int", "distance": "long", "cluster_inertia": "long", "inertia": "long", "centroid_sha256": "string"}
    if not first:
        return unshielded(rows, vectors.columns, {n: F.lit(None).cast(kind) for n, kind in kinds.items()}), []
    package_on_workers(vectors.sparkSession)
    places = [list(row.numbers) for row in first]
    for _ in range(rounds):
        for number, (n, _, sums) in _won(rows.select("numbers"), Centroids.of(places), dims).items():
            places[number] = [total // n for total in sums]
    centroids = Centroids.of(places)
    won = _won(rows.select("numbers"), centroids, dims)

    def nearest(batch: pa.Array) -> pa.Array:
        best, distance = centroids.nearest(_matrix(batch, dims))
        return pa.StructArray.from_arrays([pa.array(best.astype(np.int32)), pa.array(distance)], ["cluster", "distance"])

    found = arrow_function(nearest, "struct<cluster: int, distance: long>")(F.col("numbers"))
    digests = [hashlib.sha256(",".join(map(str, place)).encode()).hexdigest() for place in places]
    facts = [(number, won[number][1], digests[number]) for number in sorted(won)]
    table = vectors.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, centroid_sha256 string")
    joined = rows.withColumn("found", found).withColumn("cluster", F.col("found.cluster")).join(F.broadcast(table), "cluster")
    outputs = {
        "cluster": F.col("cluster"),
        "distance": F.col("found.distance"),
        "cluster_inertia": F.col("cluster_inertia"),
        "inertia": F.lit(sum(distance for _, distance, _ in won.values())).cast("long"),
        "centroid_sha256": F.col("centroid_sha256"),
    }
    return unshielded(joined, vectors.columns, outputs), places
