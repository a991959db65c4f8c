"""Centroid clustering (Lloyd's rounds) on integer vectors: distances by matrix products, exact at any magnitude."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm import common
from skein.llm.vectors import EXACT, LONG, clipped, finite, floats, greatest, integers, rows_of, scaled

CLUSTERS, ROUNDS, WIDTH = 40, 5, 64
#: Vectors of one matrix product.
BLOCK = 2048


def kept(embeddings: DataFrame, vector: str, width: int) -> DataFrame:
    """vec_id and embedding of the rows that take part: exactly ``width`` components, none null or non-finite."""
    v = floats(embeddings, vector)
    df = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("embedding"))
    return df.where((F.size("embedding") == width) & finite(F.col("embedding")))


def starts(vectors: DataFrame, clusters: int, seed: int, width: int) -> np.ndarray:
    """The first centroids, by hash of the id: ``clusters`` rows at most come to the driver."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.orderBy(order.asc_nulls_last(), "embedding").limit(clusters).select("embedding").collect()
    return integers(scaled(np.array([r[0] for r in rows], np.float64).reshape(len(rows), width)))


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of rows to centroids, exactly.

    |x|^2 - 2 x.c + |c|^2 as a matrix product in double precision, whose every partial sum is an integer: exact while a bound on the
    magnitudes keeps it below 2 to the 53, whatever the order in which BLAS adds.  Beyond, the same in int64, and beyond
    that in Python's integers.
    """
    bound = x.shape[1] * (greatest(x) + greatest(c)) ** 2
    if bound < EXACT:
        a, b = x.astype(np.float64), c.astype(np.float64)
    elif bound <= LONG:
        a, b = x.astype(np.int64), c.astype(np.int64)
    else:
        a, b = integers(x).astype(object), c.astype(object)
    return (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]


def blocks(batch: pa.RecordBatch, width: int):
    """Integer matrices of a batch, ``BLOCK`` rows each, with the place of their first row."""
    flat, _ = rows_of(batch.column("embedding"))
    m = flat.reshape(-1, width)
    for i in range(0, len(m), BLOCK):
        yield i, scaled(m[i : i + BLOCK])


def sums(near: np.ndarray, values: np.ndarray, k: int) -> np.ndarray:
    """Componentwise sums of the rows of each cluster, exactly: in double precision, int64 or Python's integers, by a bound."""
    bound = greatest(values) * max(1, len(values))
    if bound < EXACT:
        return (near[None, :] == np.arange(k)[:, None]).astype(np.float64) @ values.astype(np.float64)
    out = np.zeros((k, values.shape[1]), object if bound > LONG else np.int64)
    np.add.at(out, near, integers(values) if bound <= LONG else integers(values).astype(object))
    return out


class Partial:
    """What some rows add to each cluster: (rows, sums), of any magnitude.  As a row of Spark's it is text, or packed int64."""

    @staticmethod
    def add(a: np.ndarray | None, b: np.ndarray | None) -> np.ndarray | None:
        if a is None or b is None:
            return b if a is None else a
        if a.dtype != object and b.dtype != object and greatest(a) + greatest(b) <= LONG:
            return a + b
        return a.astype(object) + b.astype(object)

    @staticmethod
    def pack(a: np.ndarray) -> tuple[bytes, bool]:
        if a.dtype == object and greatest(a) <= LONG:
            a = a.astype(np.int64)
        return (a.tobytes(), False) if a.dtype != object else (",".join(map(str, a.ravel().tolist())).encode(), True)

    @staticmethod
    def unpack(data: bytes, wide: bool, columns: int) -> np.ndarray:
        flat = np.array([int(v) for v in data.split(b",")], object) if wide else np.frombuffer(data, np.int64)
        return flat.reshape(-1, columns)


def gather(vectors: DataFrame, centroids: np.ndarray, measure, columns: int) -> np.ndarray:
    """Sums over all rows, by cluster, of what ``measure`` makes of a block: each task sums its own rows, a tree adds the tasks'."""

    def run(batches):
        total = None
        for b in batches:
            for _, x in blocks(b, centroids.shape[1]):
                total = Partial.add(total, integers(measure(x, distances(x, centroids))))
        if total is not None:
            data, wide = Partial.pack(total)
            yield pa.record_batch({"data": pa.array([data], pa.binary()), "wide": pa.array([wide])})

    rows = vectors.select("embedding").mapInArrow(run, "data binary, wide boolean").rdd
    found = rows.treeAggregate(None, lambda a, r: Partial.add(a, Partial.unpack(bytes(r[0]), r[1], columns)), Partial.add)
    return np.zeros((len(centroids), columns), np.int64) if found is None else found


def one_round(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: the floor of the mean of each cluster's vectors; an empty cluster's stays."""

    def measure(x, far):
        near = far.argmin(axis=1)
        return sums(near, np.hstack([np.ones((len(x), 1), x.dtype), x]), len(centroids))

    found = gather(vectors, centroids, measure, centroids.shape[1] + 1)
    out = [[v // row[0] for v in row[1:]] if row[0] else old for row, old in zip(found.astype(object).tolist(), centroids.tolist())]
    return integers(np.array(out, object) if greatest(np.array(out, object)) > LONG else np.array(out, np.int64))


def cluster(embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH, seed: int = 2, vector: str = "embedding") -> DataFrame:
    """Cluster vectors of ``width`` components, each floor(256 * component): vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    The first centroids are the vectors with the smallest sha256 of ``seed:vec_id``.  Each round gives every vector to the nearest
    centroid (ties: the smaller number) and moves each centroid to the floor of its vectors' mean; then vectors are given once more.
    Tasks hold ``clusters`` sums each, added by a tree, so what reaches the driver is bounded by ``clusters * width`` integers
    whatever the input; the source is read anew in each round, nothing is written, and a lost executor costs its tasks alone.

    Rows whose vector is null, of another width, or holds a null or non-finite component are left out.  Repeated rows count each, and
    equal vectors are never told apart.  A null vec_id stays null; it has no hash, so it is among the first centroids only where
    fewer than ``clusters`` rows have one; of rows of one vec_id the smaller vector comes first.  Fewer vectors than ``clusters`` give as
    many clusters.  Components of any finite magnitude are exact; a distance or inertia beyond a long becomes the
    greatest long.  Other columns, whatever their names, are not read.  An empty table gives an empty table.
    """
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    common.prepare(embeddings.sparkSession)
    vectors = kept(embeddings, vector, width)
    centroids = starts(vectors, clusters, seed, width)
    if not len(centroids):
        return embeddings.sparkSession.createDataFrame([], schema)
    for _ in range(rounds):
        centroids = one_round(vectors, centroids)

    def of_cluster(x, far):
        near = far.argmin(axis=1)
        return sums(near, integers(far[np.arange(len(x)), near])[:, None], len(centroids))

    each = gather(vectors, centroids, of_cluster, 1)[:, 0].astype(object)
    inertia, whole = clipped(each), int(clipped([each.sum()])[0])
    names = pa.array([hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in centroids.tolist()])

    def run(batches):
        for b in batches:
            for i, x in blocks(b, width):
                far = distances(x, centroids)
                near = far.argmin(axis=1)
                yield pa.record_batch({
                    "vec_id": b.column("vec_id").slice(i, len(x)),
                    "cluster": pa.array(near.astype(np.int32)),
                    "distance": pa.array(clipped(integers(far[np.arange(len(x)), near]))),
                    "cluster_inertia": pa.array(inertia[near]),
                    "inertia": pa.array(np.full(len(x), whole, np.int64)),
                    "centroid_sha256": names.take(pa.array(near)),
                })

    return vectors.mapInArrow(run, schema)
