"""Centroid clustering on integer vectors, with candidates pruned by Ptolemy's inequality.

For any four points of Euclidean space, d(x, c) * d(p, q) >= |d(x, p) * d(c, q) - d(x, q) * d(c, p)|.
A few fixed pairs of pivots p, q give every vector x lower bounds of its distance to each centroid c
from distances that are known: those of x to the pivots never change and are stored with the vector,
those of a centroid are computed once a round. Stored distances are rounded down and up to the
neighbouring 32-bit numbers, and the bound is taken of the worst case within them, a little lowered,
so rounding never prunes a centroid that could be nearest. A vector's distance to the centroid of its
least bound is computed exactly; every centroid whose bound doesn't exceed it survives, and all
survivors are compared exactly, in 64-bit integers. Results are those of a plain comparison.

A vector is kept if it has exactly `dims` components, none null or not finite. A component becomes
floor(SCALE * x). A component beyond LIMIT either way could give a squared distance that no long
holds; such vectors are left out like those that are not finite. Rounds: every vector goes to its
nearest centroid (of equal ones the smallest number), then each centroid that has vectors becomes
the floor of their mean; sums are added up in tasks and decimals, exactly, and a round sends only
`k` times `dims` of them to the driver.

The first centroids are the `k` kept vectors of the smallest SHA-256 of `seed`:vec_id; rows with the
same vec_id are taken in the order of their components, a null vec_id counts as empty text there.
With fewer vectors there are fewer centroids; an empty table gives no rows. Repeated rows are vectors
each; extra columns are ignored.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import settle

DIMS = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
SEED = "2"
PIVOT_PAIRS = 6
LIMIT = 1 << 26
#: Vectors that are compared at a time.
BLOCK = 4_096


def kept_vectors(embeddings: DataFrame, dims: int = DIMS) -> DataFrame:
    """vec_id and integer components of the vectors that can be clustered."""
    x = F.transform("embedding", lambda v: F.floor(v.cast("double") * SCALE))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double") * SCALE) <= LIMIT))
    fits = F.col("embedding").isNotNull() & (F.size("embedding") == dims)
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(fits).filter(finite).select("vec_id", x.alias("x"))


def first_centroids(vectors: DataFrame, k: int = CENTROIDS, seed: str = SEED) -> np.ndarray:
    """The k vectors that come first by the hash of their id."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return np.array([r.x for r in vectors.orderBy(order, "x").limit(k).select("x").collect()], np.int64)


def pivot_pairs(points: np.ndarray, n: int = PIVOT_PAIRS) -> np.ndarray:
    """Pairs of different points, far apart and each point in one pair only: shape (pairs, 2, dims)."""
    points = np.unique(points, axis=0)
    if len(points) < 2:
        return np.zeros((0, 2, points.shape[1] if points.ndim == 2 else 0), np.int64)
    apart = ((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2)
    pairs = []
    while len(pairs) < n and apart.max() > 0:
        i, j = np.unravel_index(apart.argmax(), apart.shape)
        pairs.append((points[i], points[j]))
        apart[[i, j], :] = apart[:, [i, j]] = 0
    return np.array(pairs)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x to each row of y."""
    return np.stack([((x - one) ** 2).sum(axis=1) for one in y], axis=1) if len(y) else np.zeros((len(x), 0), np.int64)


def interval(squared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """32-bit numbers at or below and at or above the root of exact squares."""
    root = np.sqrt(squared.astype(np.float64)).astype(np.float32)
    return np.maximum(np.nextafter(root, np.float32(-np.inf)), np.float32(0)), np.nextafter(root, np.float32(np.inf))


def lower_bounds(low: np.ndarray, high: np.ndarray, c_low: np.ndarray, c_high: np.ndarray, pair_high: np.ndarray) -> np.ndarray:
    """Squared distances of vectors to centroids, at least.

    low, high: distances of vectors to the pivots (vectors, pairs, 2); c_low, c_high of centroids;
    pair_high: of the two pivots of a pair.
    """
    low, high, c_low, c_high = (a.astype(np.float64) for a in (low, high, c_low, c_high))
    best = np.zeros((len(low), len(c_low)))
    for k in range(low.shape[1]):
        one = np.outer(low[:, k, 0], c_low[:, k, 1]) - np.outer(high[:, k, 1], c_high[:, k, 0])
        two = np.outer(low[:, k, 1], c_low[:, k, 0]) - np.outer(high[:, k, 0], c_high[:, k, 1])
        np.maximum(best, np.maximum(one, two) / float(pair_high[k]), out=best)
    return best * best * (1 - 1e-9)


class Index:
    """The pivots, and what is known of the centroids of one round."""

    def __init__(self, pairs: np.ndarray, centroids: np.ndarray):
        self.pairs, self.centroids = pairs, centroids
        self.c_low, self.c_high = self.known(centroids)
        self.pair_high = interval(((pairs[:, 0] - pairs[:, 1]) ** 2).sum(axis=1))[1]

    def known(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances to the pivots, rounded down and up."""
        squared = distances(x, self.pairs.reshape(-1, x.shape[1]))
        return interval(squared.reshape(len(x), len(self.pairs), 2))

    def nearest(self, x: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest centroid, its squared distance, and how many exact comparisons it took."""
        bounds = lower_bounds(low, high, self.c_low, self.c_high, self.pair_high)
        guess = bounds.argmin(axis=1)
        best = ((x - self.centroids[guess]) ** 2).sum(axis=1)
        row, c = np.nonzero(bounds <= best[:, None])
        exact = ((x[row] - self.centroids[c]) ** 2).sum(axis=1)
        # Of equal distances the smallest number: rows are in order, numbers too.
        order = np.lexsort((c, exact, row))
        first = order[np.flatnonzero(np.diff(row[order], prepend=-1))]
        return c[first], exact[first], len(row)


def _blocks(batches, dims: int, pairs: int):
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            rows = batch.slice(at, BLOCK)
            x = rows["x"].flatten().to_numpy().reshape(-1, dims).astype(np.int64)
            low, high = (rows[c].flatten().to_numpy().reshape(len(x), pairs, 2) for c in ("low", "high"))
            yield rows, x, low, high


def with_pivots(vectors: DataFrame, pairs: np.ndarray) -> DataFrame:
    """vec_id, x and the distances to all pivots, rounded down and up."""
    index = Index(pairs, np.zeros((0, pairs.shape[2]), np.int64))

    def run(batches):
        for batch in batches:
            x = batch["x"].flatten().to_numpy().reshape(-1, pairs.shape[2])
            size = 2 * len(pairs)
            known = [pa.FixedSizeListArray.from_arrays(pa.array(d.reshape(-1)), size) if size else pa.array([[]] * len(x), pa.list_(pa.float32())) for d in index.known(x)]
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["x"], *(k.cast(pa.list_(pa.float32())) for k in known)], ["vec_id", "x", "low", "high"])

    return vectors.mapInArrow(run, "vec_id long, x array<long>, low array<float>, high array<float>")


def _moved(vectors: DataFrame, index: Index) -> np.ndarray:
    """The centroids after one round."""
    k, dims = index.centroids.shape

    def add(batches):
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, x, low, high in _blocks(batches, dims, len(index.pairs)):
            which, _, _ = index.nearest(x, low, high)
            np.add.at(sums, which, x)
            counts += np.bincount(which, minlength=k)
        c = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(counts[c]), pa.array(sums[c].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    partial = vectors.mapInArrow(add, "cluster long, n long, sums array<long>")
    parts = partial.select("cluster", "n", F.posexplode("sums").alias("dim", "total"))
    total = F.sum(F.col("total").cast("decimal(38,0)"))
    centroids = index.centroids.copy()
    for r in parts.groupBy("cluster", "dim").agg(total.alias("total"), F.sum("n").alias("n")).collect():
        centroids[r.cluster, r.dim] = int(r.total) // r.n
    return centroids


def assign(vectors: DataFrame, index: Index) -> DataFrame:
    """vec_id, its cluster and its exact squared distance."""

    def run(batches):
        for rows, x, low, high in _blocks(batches, index.centroids.shape[1], len(index.pairs)):
            which, exact, _ = index.nearest(x, low, high)
            yield pa.RecordBatch.from_arrays([rows["vec_id"], pa.array(which.astype(np.int32)), pa.array(exact)], ["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS, seed: str = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every kept vector."""
    spark = embeddings.sparkSession
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    vectors = kept_vectors(embeddings, dims)
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], schema)
    pairs = pivot_pairs(centroids)
    vectors = settle(with_pivots(vectors, pairs))
    for _ in range(rounds):
        centroids = _moved(vectors, Index(pairs, centroids))
    found = settle(assign(vectors, Index(pairs, centroids)))
    inertia = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    of_cluster = [(c, s, sum(inertia.values()), digests[c]) for c, s in inertia.items()]
    known = spark.createDataFrame(of_cluster, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows
