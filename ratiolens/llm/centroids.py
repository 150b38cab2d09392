"""Exact k-means of whole-number vectors by bounded search around centroids.

Every vector remembers its nearest and second-nearest centroid of the last search, an
upper bound to the first and a lower bound to all others. After centroids moved, most
vectors prove by these bounds (or half the way to the next centroid) that their
centroid stays the nearest. The others start from the closer of the two remembered
centroids and scan that one's neighbours in order of distance. A neighbour can only
matter within the distance to the start plus that to the second-nearest found so far, so
the ball shrinks as better ones are met, and the scan ends at the first neighbour
outside. Bounds are doubles with a margin; whoever survives is compared by squared
distances in whole numbers, ties by centroid number, so the result is that of comparing
all. Vectors are handled a batch at a time, one step of the scan for all that still scan.

Each round is one pass without shuffle over a table written in the shared folder. New
centroids come from sums kept up to date by the vectors that changed their cluster, one
row per task and cluster; the driver holds centroids and sums alone (clusters times
dimension whole numbers).

Defined results: vectors that are null, of another dimension, or hold a null or
non-finite component are left out; rows with one id, null included, are kept each and
counted each; equal hashes of ids are ordered by the packed components; fewer vectors than
clusters give that many clusters; an empty table gives an empty result. Components
outside of +-2**27 after scaling raise an error, since distances would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratiolens.llm.common import ship_package, stage

DIMENSION = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
SEED = "2:"
LARGEST = 1 << 27
#: Relative margin of the bounds, far above the rounding of doubles.
MARGIN = 1e-9


def _whole(dimension: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            fits = np.array(lists.value_lengths().fill_null(-1)) == dimension
            rows = np.flatnonzero(fits)
            lists = lists.take(pa.array(rows))
            values = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), dimension)
            whole = np.isfinite(values).all(axis=1)  # nulls arrive as NaN
            scaled = np.floor(values[whole].astype(np.float64) * scale)
            if len(scaled) and np.abs(scaled).max() > LARGEST:
                raise ValueError("a component is too large for whole-number distances")
            packed = scaled.astype("<i4")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(rows[whole])),
                    pa.array([x.tobytes() for x in packed], pa.binary()),
                ],
                names=["id", "vec"],
            )

    return run


def whole_vectors(
    vectors: DataFrame,
    id_col: str,
    vector_col: str,
    dimension: int = DIMENSION,
    scale: int = SCALE,
) -> DataFrame:
    """(id, vec): usable vectors as little-endian 32-bit whole numbers, floor(scale * x)."""
    source = vectors.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    )
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(_whole(dimension, scale), f"id {kind}, vec binary")


def first_centroids(vectors: DataFrame, clusters: int, seed: str) -> np.ndarray:
    """The vectors with the smallest hashes of their ids, in order of the hash."""
    key = F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = vectors.orderBy(F.sha2(key, 256), "vec").select("vec").limit(clusters).collect()
    return np.array([np.frombuffer(r.vec, "<i4") for r in rows], dtype=np.int64)


class Centroids:
    """Centroids with each one's neighbours in order of distance."""

    def __init__(self, places: np.ndarray):
        self.places = places
        k = len(places)
        gap = np.sqrt(((places[:, None, :] - places[None, :, :]) ** 2).sum(axis=2).astype(float))
        np.fill_diagonal(gap, -1.0)  # a centroid comes first in its own list
        self.order = np.argsort(gap, axis=1, kind="stable")[:, 1:]
        self.gaps = np.take_along_axis(gap, self.order, axis=1)
        self.half = self.gaps[:, 0] / 2 if k > 1 else np.full(k, np.inf)

    def squared(self, vectors: np.ndarray, which: np.ndarray) -> np.ndarray:
        apart = vectors - self.places[which]
        return np.einsum("ij,ij->i", apart, apart)

    def search(self, vectors: np.ndarray, near: np.ndarray, second: np.ndarray):
        """Nearest and second-nearest centroid with squared distances, ties by number.

        Starts from the closer one of the two given centroids.
        """
        d_near, d_second = self.squared(vectors, near), self.squared(vectors, second)
        swap = (d_second < d_near) | ((d_second == d_near) & (second < near))
        near, second = np.where(swap, second, near), np.where(swap, near, second)
        d_near, d_second = np.where(swap, d_second, d_near), np.where(swap, d_near, d_second)
        start, other, reach = near.copy(), second.copy(), np.sqrt(d_near.astype(float))
        open_ = np.arange(len(vectors))
        for step in range(self.order.shape[1]):
            ball = reach[open_] + np.sqrt(d_second[open_].astype(float))
            inside = self.gaps[start[open_], step] * (1 - MARGIN) <= ball * (1 + MARGIN)
            open_ = open_[inside]
            if not len(open_):
                break
            found = self.order[start[open_], step]
            new = found != other[open_]
            rows, found = open_[new], found[new]
            d = self.squared(vectors[rows], found)
            first = (d < d_near[rows]) | ((d == d_near[rows]) & (found < near[rows]))
            third = ~first & ((d < d_second[rows]) | ((d == d_second[rows]) & (found < second[rows])))
            at = rows[first]
            second[at], d_second[at] = near[at], d_near[at]
            near[at], d_near[at] = found[first], d[first]
            at = rows[third]
            second[at], d_second[at] = found[third], d[third]
        return near, second, d_near, d_second


def _assign(centroids: Centroids, drift: np.ndarray | None, last: bool):
    """One pass: assigns every vector; ``drift`` is how far each centroid moved since the last."""
    k = len(centroids.places)
    if drift is not None:
        most = np.argsort(-drift, kind="stable")
        others = np.full(k, drift[most[0]])  # farthest move among the other centroids
        others[most[0]] = drift[most[1]] if k > 1 else 0.0

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        size = batch.num_rows
        data = b"".join(batch.column("vec").to_pylist())
        vectors = np.frombuffer(data, "<i4").reshape(size, -1).astype(np.int64)
        if drift is None:
            near = np.zeros(size, dtype=np.int64)
            second = np.full(size, min(1, k - 1), dtype=np.int64)
            upper, lower = np.full(size, np.inf), np.zeros(size)
        else:
            near, second, upper, lower = (
                batch.column(n).to_numpy().copy() for n in ("cluster", "second", "upper", "lower")
            )
        was = near.copy() if drift is not None else np.full(size, -1, dtype=np.int64)
        if drift is not None:
            upper += drift[near]
            lower -= others[near]
        safe = np.maximum(lower, centroids.half[near]) * (1 - MARGIN)
        rows = np.flatnonzero(upper * (1 + MARGIN) >= safe)
        if drift is not None and len(rows):  # the true distance may settle it
            upper[rows] = np.sqrt(centroids.squared(vectors[rows], near[rows]).astype(float))
            rows = rows[upper[rows] * (1 + MARGIN) >= safe[rows]]
        if k > 1 and len(rows):
            a, b, d_a, d_b = centroids.search(vectors[rows], near[rows], second[rows])
            near[rows], second[rows] = a, b
            upper[rows], lower[rows] = np.sqrt(d_a.astype(float)), np.sqrt(d_b.astype(float))
        columns = [batch.column("id"), pa.array(near)]
        names = ["id", "cluster"]
        if last:
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(centroids.squared(vectors, near))], [*names, "distance"]
            )
        return pa.RecordBatch.from_arrays(
            [*columns, *map(pa.array, (second, upper, lower, was)), batch.column("vec")],
            [*names, "second", "upper", "lower", "was", "vec"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield one(batch)

    return run


def _moves(clusters: int):
    """Per task and cluster: how count and sums change by vectors that came or left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(clusters, dtype=np.int64)
        sums = None
        for batch in batches:
            if not batch.num_rows:
                continue
            data = b"".join(batch.column("vec").to_pylist())
            vectors = np.frombuffer(data, "<i4").reshape(batch.num_rows, -1).astype(np.int64)
            if sums is None:
                sums = np.zeros((clusters, vectors.shape[1]), dtype=np.int64)
            now, was = batch.column("cluster").to_numpy(), batch.column("was").to_numpy()
            np.add.at(sums, now, vectors)
            np.add.at(count, now, 1)
            left = was >= 0
            np.subtract.at(sums, was[left], vectors[left])
            np.subtract.at(count, was[left], 1)
        if sums is not None:
            some = np.flatnonzero((count != 0) | (sums != 0).any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array(count[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))],
                names=["cluster", "n", "sums"],
            )

    return run


def _moved_sums(state: DataFrame, clusters: int, dimension: int):
    """Changes of counts and sums over all tasks, as whole numbers."""
    changes = (
        state.where("cluster <> was")
        .select("cluster", "was", "vec")
        .mapInArrow(_moves(clusters), "cluster long, n long, sums array<long>")
        .groupBy("cluster")
        .agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(dimension)])
    )
    count, sums = np.zeros(clusters, dtype=np.int64), np.zeros((clusters, dimension), dtype=np.int64)
    for row in changes.collect():
        count[row.cluster] = row.n
        sums[row.cluster] = row[2:]
    return count, sums


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dimension: int = DIMENSION,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: str = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, squared distance) of every usable vector, and the final centroids."""
    ship_package(vectors.sparkSession)
    state = stage(whole_vectors(vectors, id_col, vector_col, dimension, scale), "vectors")
    kind = state.schema["id"].dataType.simpleString()
    places = first_centroids(state, clusters, seed)
    found = f"id {kind}, cluster long"
    if not len(places):
        none = state.select("id", F.lit(0).cast("long").alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return none.withColumnRenamed("id", id_col), places.reshape(0, dimension)
    k = len(places)
    count, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dimension), dtype=np.int64)
    drift = None
    kept = found + ", second long, upper double, lower double, was long, vec binary"
    for _ in range(rounds):
        state = stage(state.mapInArrow(_assign(Centroids(places), drift, False), kept), "assigned")
        more, moved = _moved_sums(state, k, dimension)
        count, sums = count + more, sums + moved
        full = count > 0
        after = places.copy()
        after[full] = sums[full] // count[full][:, None]
        drift = np.sqrt(((after - places) ** 2).sum(axis=1).astype(float)) * (1 + MARGIN)
        places = after
    ended = state.mapInArrow(
        _assign(Centroids(places), drift, True), f"{found}, distance long"
    )
    return stage(ended, "clusters").withColumnRenamed("id", id_col), places


def clusters_with_inertia(vectors: DataFrame, id_col: str = "vec_id", **how) -> DataFrame:
    """Every vector with its cluster, squared distance, sums of these and its centroid's digest."""
    found, places = cluster(vectors, id_col, **how)
    per = {
        r.cluster: r.inertia
        for r in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()
    }
    digests = [hashlib.sha256(",".join(map(str, p.tolist())).encode()).hexdigest() for p in places]
    listed = F.array(*[F.lit(per.get(c, 0)).cast("long") for c in range(len(places))] or [F.lit(0).cast("long")])
    hashes = F.array(*[F.lit(x) for x in digests] or [F.lit("")])
    at = F.col("cluster").cast("int")
    return found.select(
        id_col,
        at.alias("cluster"),
        "distance",
        F.get(listed, at).alias("cluster_inertia"),
        F.lit(sum(per.values())).cast("long").alias("inertia"),
        F.get(hashes, at).alias("centroid_sha256"),
    )
