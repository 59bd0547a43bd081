"""Centroid clustering with whole-number vectors and the threshold algorithm.

A vector's nearest centroid is found as Fagin's threshold algorithm finds the
best object: each dimension has its list of centroids by value, walked outward
from the vector's own value, the nearer side first.  A centroid met for the
first time gets its exact distance.  No centroid that has not been met can be
nearer than the sum of the squared distances at the lists' frontiers, so the
walk stops as soon as that sum is strictly larger than the best exact distance
(strictly: a tie may still bring a smaller number).

Everything is exact: components are ``floor(scale * x)``, distances and sums are
whole numbers.  Vectors of moderate size use 64-bit arithmetic; where a squared
distance could leave 64 bits, the same walk runs on Python integers.

Scale: the whole-number vectors are written once; a round is one scan of them.
Tasks send a cluster's sums per dimension, Spark adds them up, and the driver
sees one number per cluster and dimension.  The centroids (clusters times
dimensions numbers) travel with the tasks.  A vector's length is fixed, so no
row is long; however many vectors share one cluster, or one id, they are spread
as the input is.

Defined results: a vector counts when it has exactly ``dims`` components, none
null, NaN or infinite; others are left out.  Repeated rows count each.  Seeds
are ordered by the hash of their id, then by their components (equal vectors
under one id make equal centroids, of which the higher-numbered stay empty); a
null id hashes as the empty text.  With fewer vectors than clusters each is a
centroid; an empty table gives no rows.  Components beyond 64 bits after scaling
are held at the largest; a distance or inertia beyond 64 bits is null.  Columns
other than the id and the vector, of whatever name, are not read.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

DIMS, CLUSTERS, ROUNDS, SCALE, SALT = 64, 8, 10, 1024, "3:"
#: Components up to this size have squared distances within 64 bits in up to ``1 << 6`` dimensions.
NARROW = 1 << 27
#: Vectors handled at once.
BATCH = 4096


def whole_vectors(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(vec_id, x) of the vectors that count among ``vectors(vec_id, embedding)``."""
    v = vectors.select("vec_id", F.transform("embedding", lambda e: e.cast("double")).alias("v"))
    fine = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return (v.where(F.size("v") == dims).where(F.coalesce(fine, F.lit(False)))
            .select("vec_id", F.transform("v", lambda e: F.floor(scale * e)).alias("x")))


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest row of ``c`` for each row of
    ``x``; whole numbers, ties to the smaller number."""
    n, dims = x.shape
    k = len(c)
    order = np.argsort(c, axis=0, kind="stable")
    lists = np.take_along_axis(c, order, axis=0)
    far = 1 << 80 if x.dtype == object else 1 << 29
    # entries of each list below the vector's value: the walk starts there, to both sides
    right = (lists[None, :, :] < x[:, None, :]).sum(axis=1).astype(np.int64)
    left = right - 1
    dim = np.arange(dims)
    seen = np.zeros((n, k), bool)
    best, number = np.zeros(n, x.dtype), np.full(n, -1)
    at = np.arange(n)

    def gaps(lo, hi, v):
        below = np.where(lo >= 0, v - lists[np.maximum(lo, 0), dim], far)
        above = np.where(hi < k, lists[np.minimum(hi, k - 1), dim] - v, far)
        return below, above

    while len(at):
        v, lo, hi = x[at], left[at], right[at]
        below, above = gaps(lo, hi, v)
        down = below <= above
        met = order[np.where(down, np.maximum(lo, 0), np.minimum(hi, k - 1)), dim]
        new = np.zeros((len(at), k), bool)
        new[np.arange(len(at))[:, None], met] = True
        new &= ~seen[at]
        for j in range(k):
            rows = np.flatnonzero(new[:, j])
            if len(rows):
                d = ((v[rows] - c[j]) ** 2).sum(axis=1)
                own = at[rows]
                nearer = (number[own] < 0) | (d < best[own]) | ((d == best[own]) & (j < number[own]))
                best[own[nearer]], number[own[nearer]] = d[nearer], j
        seen[at] |= new
        left[at], right[at] = lo - down, hi + ~down
        below, above = gaps(left[at], right[at], v)
        frontier = (np.minimum(below, above) ** 2).sum(axis=1)
        at = at[~seen[at].all(axis=1) & ~(frontier > best[at])]
    return number, best


def _vectors(batches, dims: int, centroids: list[list[int]]):
    """(batch, vectors, centroids) in pieces; Python integers where 64 bits may not do."""
    c = np.array(centroids, dtype=object)
    small = all(abs(v) < NARROW for row in centroids for v in row) and dims <= 64
    narrow = c.astype(np.int64) if small else None
    for whole in batches:
        for i in range(0, whole.num_rows, BATCH):
            b = whole.slice(i, BATCH)
            flat = b.column("x").flatten().to_numpy()
            x = flat.reshape(-1, dims)
            if small and (len(flat) == 0 or (flat.min() > -NARROW and flat.max() < NARROW)):
                yield b, x, narrow
            else:
                yield b, x.astype(object), c


def _sums(points: DataFrame, dims: int, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """Number of vectors and sums by dimension of every non-empty cluster."""
    k = len(centroids)

    def partial(batches):
        count, total = [0] * k, [[0] * dims for _ in range(k)]
        for _, x, c in _vectors(batches, dims, centroids):
            number, _ = nearest(x, c)
            for j in np.unique(number).tolist():
                own = x[number == j]
                count[j] += len(own)
                total[j] = [a + int(s) for a, s in zip(total[j], (own.sum(axis=0) if x.dtype == object or len(own) < 1 << 30 else own.astype(object).sum(axis=0)))]
        rows = [(j, i, count[j], Decimal(total[j][i])) for j in range(k) if count[j] for i in range(dims)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
             pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.decimal128(38, 0))], ["c", "i", "n", "s"])

    found = (points.select("x").mapInArrow(partial, "c int, i int, n long, s decimal(38,0)")
             .groupBy("c", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())  # clusters x dimensions rows
    out: dict[int, tuple[int, list[int]]] = {}
    for r in found:
        out.setdefault(r["c"], (r["n"], [0] * dims))[1][r["i"]] = int(r["s"])
    return out


def seeds(points: DataFrame, clusters: int = CLUSTERS, salt: str = SALT) -> list[list[int]]:
    """The first vectors by hash of their id."""
    key = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [list(r["x"]) for r in points.select("x", key.alias("h")).orderBy("h", "x").limit(clusters).collect()]


def fit(points: DataFrame, dims: int = DIMS, clusters: int = CLUSTERS, rounds: int = ROUNDS, salt: str = SALT) -> list[list[int]]:
    """Centroids after ``rounds`` rounds over written ``points(vec_id, x)``."""
    centroids = seeds(points, clusters, salt)
    for _ in range(rounds if centroids else 0):
        for j, (n, total) in _sums(points, dims, centroids).items():
            centroids[j] = [s // n for s in total]  # floor, also below zero
    return centroids


def assign(points: DataFrame, centroids: list[list[int]], dims: int = DIMS) -> DataFrame:
    """(vec_id, cluster, distance): the nearest centroid of every vector."""

    def rows(batches):
        for b, x, c in _vectors(batches, dims, centroids):
            number, distance = nearest(x, c)
            exact = pa.array(distance) if x.dtype != object else pa.array([d if d < 1 << 63 else None for d in distance.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(number.astype(np.int32)), exact], ["vec_id", "cluster", "distance"])

    return points.mapInArrow(rows, "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, dims: int = DIMS, clusters: int = CLUSTERS, rounds: int = ROUNDS,
            scale: int = SCALE, salt: str = SALT) -> DataFrame:
    """One row per vector that counts: its cluster, squared distance, the inertia
    of its cluster and of all, and the digest of its centroid."""
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    points = C.saved(whole_vectors(own, dims, scale), "centroid-points")
    centroids = fit(points, dims, clusters, rounds, salt)
    found = assign(points, centroids, dims)
    if not centroids:
        return found.select("*", *(F.lit(None).cast("long").alias(c) for c in ("cluster_inertia", "inertia")), F.lit(None).cast("string").alias("centroid_sha256"))
    found = C.saved(found, "centroid-rows")
    # a null distance (beyond 64 bits) makes its sums null
    sums = {r["cluster"]: None if r["lost"] else int(r["s"]) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"), F.count_if(F.col("distance").isNull()).alias("lost")).collect()}
    total = None if None in sums.values() else sum(sums.values())

    def fits(v):
        return v if v is not None and v < 1 << 63 else None

    def by_cluster(values, kind):
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1)

    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return found.select("vec_id", "cluster", "distance",
                        by_cluster([fits(sums.get(j, 0)) for j in range(len(centroids))], "long").alias("cluster_inertia"),
                        F.lit(fits(total)).cast("long").alias("inertia"), by_cluster(digest, "string").alias("centroid_sha256"))
