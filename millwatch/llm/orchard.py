"""Clustering of vectors around centroids, in exact integers, with Orchard's search.

Every centroid keeps the others sorted by their distance from it. A vector walks along the list
of the centroid it is at; where it finds a closer one it goes on with that one's list, and it
stops once the list's distance is more than twice its own: by the triangle inequality nothing
beyond is as close. Vectors stay in their tasks; only sums per centroid are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm.common import written
from millwatch.llm.vectors import counted, flat_components

#: Largest integer component: squared distances of 64 of them fit 64 bits.
LARGEST = 1 << 27

#: Components of a kept vector, their scale, centroids, rounds and the salt of the first draw.
COMPONENTS, SCALE, CENTROIDS, ROUNDS, SALT = 64, 1024, 8, 10, "3:"


def neighbour_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per centroid the others, nearest first (ties by number), and their squared distances."""
    apart = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    order = np.array([[j for j in np.lexsort((np.arange(len(apart)), row)) if j != i] for i, row in enumerate(apart)])
    order = order.reshape(len(apart), -1).astype(np.int64)
    return order, np.take_along_axis(apart, order, axis=1)


def nearest(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of each point (ties: smaller number), its squared distance, and the
    number of distances that were computed. All points walk their lists side by side."""
    lists, apart = neighbour_lists(centroids)
    n, k = len(points), len(centroids)
    at = np.zeros(n, np.int64)
    best = ((points - centroids[0]) ** 2).sum(axis=1)
    visited = np.zeros((n, k), bool)
    visited[:, 0] = True
    place = np.zeros(n, np.int64)
    walking, computed = np.arange(n) if k > 1 else np.arange(0), n
    while len(walking):
        here, spot = at[walking], place[walking]
        going = spot < k - 1
        # squared: beyond twice the distance is beyond four times the square
        going[going] = apart[here[going], spot[going]] <= 4 * best[walking[going]]
        walking = walking[going]
        here, spot = at[walking], place[walking]
        to = lists[here, spot]
        place[walking] += 1
        new = ~visited[walking, to]
        rows, to = walking[new], to[new]
        visited[rows, to] = True
        computed += len(rows)
        far = ((points[rows] - centroids[to]) ** 2).sum(axis=1)
        closer = (far < best[rows]) | ((far == best[rows]) & (to < at[rows]))
        rows, to, far = rows[closer], to[closer], far[closer]
        at[rows], best[rows], place[rows] = to, far, 0
    return at, best, computed


def integers(column: pa.Array, size: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of the kept vectors and their components as integers."""
    flat, starts = flat_components(column)
    kept = np.flatnonzero((np.diff(starts) == size) & (counted(~np.isfinite(flat), starts) == 0))
    values = flat[starts[kept][:, None] + np.arange(size)].astype(np.float64)
    if len(kept) and np.abs(values).max() * scale > LARGEST:
        raise OverflowError(f"components times {scale} beyond {LARGEST}: their distances exceed 64 bits")
    return kept, np.floor(values * scale).astype(np.int64)


def points(vectors: DataFrame, size: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id and the integer components ``point`` of every kept vector."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, values = integers(batch.column("embedding"), size, scale)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(kept)), pa.array(list(values), pa.list_(pa.int32()))],
                ["vec_id", "point"],
            )

    source = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    return source.mapInArrow(work, "vec_id bigint, point array<int>")


def matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(len(column), -1)


def first_centroids(found: DataFrame, k: int = CENTROIDS, salt: str = SALT) -> np.ndarray:
    """The k points with the smallest hash of their id, in order of the hash. Points of one id
    are ordered by components; those without an id count as one with an empty number."""
    name = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = found.select(name.alias("name"), "point").orderBy("name", "point").limit(k).collect()
    return np.array([r["point"] for r in rows], np.int64)


def moved(found: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: the floor of the mean of each one's points."""
    size = centroids.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centroids), size), np.int64)
        members = np.zeros(len(centroids), np.int64)
        for batch in batches:
            if batch.num_rows:
                values = matrix(batch.column("point"))
                at, _, _ = nearest(values, centroids)
                np.add.at(total, at, values)
                members += np.bincount(at, minlength=len(centroids))
        used = np.flatnonzero(members)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(members[used]), pa.array(list(total[used]), pa.list_(pa.int64()))],
            ["cluster", "members", "total"],
        )

    sums = found.mapInArrow(work, "cluster int, members bigint, total array<bigint>")
    parts = [F.sum(F.col("total")[c]).alias(f"t{c}") for c in range(size)]
    after = centroids.copy()
    for row in sums.groupBy("cluster").agg(F.sum("members").alias("members"), *parts).collect():
        after[row["cluster"]] = [row[f"t{c}"] // row["members"] for c in range(size)]
    return after


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(
    vectors: DataFrame,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    size: int = COMPONENTS,
    scale: int = SCALE,
    salt: str = SALT,
) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia and
    centroid_sha256.

    Vectors of exactly ``size`` components, none NULL or non-finite, are kept; each component x
    becomes floor(scale * x). Each round assigns all to the nearest centroid (ties: the smaller
    number) and moves every centroid that has points to the floor of their mean; then all are
    assigned once more. Distances are squared.

    Fewer than ``k`` kept vectors give fewer centroids, an empty table an empty result. Rows that
    repeat, equal ids and rows without an id are points like any other. Other columns are not
    read. Components whose integers exceed 2^27 in size raise an OverflowError, as squared
    distances would not fit 64 bits.
    """
    found = written(points(vectors, size, scale), "cluster-points")
    centroids = first_centroids(found, k, salt)
    layout = "vec_id bigint, cluster int, distance bigint"
    if len(centroids):
        for _ in range(rounds):
            after = moved(found, centroids)
            if np.array_equal(after, centroids):
                break  # further rounds change nothing
            centroids = after

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at, far, _ = nearest(matrix(batch.column("point")), centroids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(at, pa.int32()), pa.array(far)], ["vec_id", "cluster", "distance"]
                )

    placed = written(found.mapInArrow(assign, layout), "cluster-rows")
    sums = placed.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()  # k rows at most
    each = {r["cluster"]: r["inertia"] for r in sums}

    def looked_up(values: dict, kind: str):
        pairs = [F.lit(v) for pair in sorted(values.items()) for v in pair]
        return F.create_map(*pairs)[F.col("cluster")].cast(kind) if pairs else F.lit(None).cast(kind)

    return placed.select(
        "vec_id",
        "cluster",
        "distance",
        looked_up(each, "bigint").alias("cluster_inertia"),
        F.lit(sum(each.values())).cast("bigint").alias("inertia"),
        looked_up({c: centroid_digest(centroids[c]) for c in each}, "string").alias("centroid_sha256"),
    )
