"""Integer K-means with block-norm screening.

A vector becomes integers and is stored once beside its compressed form: the squared norm of each segment of its components.
By Cauchy and Schwarz the product of two segments is at most the product of their norms, so the segment norms of a vector and of a centroid
bound their distance from below:

    |x - c|^2  >=  |x|^2 + |c|^2 - 2 * sum over segments of |x_s| |c_s|

Bounds for all centroids cost a product of vectors of `segments` numbers. Centroids are visited by rising bound; one gets an exact distance, in integers, only while its bound
does not exceed the best distance so far. Equal bounds and distances are visited too, so ties go to the smaller number as if all had been compared.

Each round reads the stored vectors once. A task adds up its vectors by centroid, so that k rows of sums leave it;
the driver holds k centroids and nothing else.

Defined results: a vector that is null, has another number of components, or a component that is null, infinite or not a number is left out; a null id counts as the
empty text in its hash and is returned as null; equal hashes are ordered by components; repeated rows are vectors of their own; fewer vectors than k give as many centroids;
an empty table gives no rows. Other columns are ignored, whatever their names. A component of 2^27 or more, as an integer, is an error: distances would leave 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored

#: Components of integers below this keep every squared distance of 64 components within 64 bits.
LARGEST = 1 << 27


def quantised(vectors: DataFrame, dims: int = 64, scale: int = 64, segments: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x, norms): floor(scale * component) of the vectors that are whole, and the squared norm of each segment."""
    if dims % segments:
        raise ValueError("segments have equal lengths")
    width = dims // segments
    v = F.col(vector_col).cast("array<double>")
    # a null component makes the condition null, which fails too
    whole = (F.size(v) == dims) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    limit = F.lit(LARGEST / scale)
    ints = F.transform("v", lambda c: F.when(F.abs(c) < limit, F.floor(c * scale).cast("int")).otherwise(F.raise_error(F.lit("a component is too large for integer distances")).cast("int")))
    square = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, c: s + c.cast("long") * c.cast("long"))
    norms = F.transform(F.sequence(F.lit(1), F.lit(dims - width + 1), F.lit(width)), lambda at: square(F.slice("x", at, width)))
    kept = vectors.where(F.coalesce(whole, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    return kept.select("vec_id", ints.alias("x")).select("vec_id", "x", norms.alias("norms"))


def first_centroids(vectors: DataFrame, k: int, seed: int = 1) -> np.ndarray:
    """The k vectors of least hash of seed and id."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(hashed.alias("hash"), "x").orderBy("hash", "x").limit(k).collect()
    return np.array([r["x"] for r in rows], np.int64) if rows else np.zeros((0, 0), np.int64)


def segment_norms(x: np.ndarray, segments: int) -> np.ndarray:
    return (x.reshape(len(x), segments, -1) ** 2).sum(axis=2)


def nearest(x: np.ndarray, norms: np.ndarray, centers: np.ndarray, center_norms: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number, squared distance) of the nearest centroid of each row of x, the smaller number of equals, and how many exact distances were taken."""
    n, k = len(x), len(centers)
    roots, center_roots = np.sqrt(norms.astype(np.float64)), np.sqrt(center_norms.astype(np.float64))
    total = norms.sum(axis=1).astype(np.float64)[:, None] + center_norms.sum(axis=1).astype(np.float64)[None, :]
    bound = total - 2 * (roots @ center_roots.T)
    # rounding may raise a bound a little; distances are whole, so what this lowers it by costs next to nothing
    bound -= total * 1e-12 + 1e-6
    order = np.argsort(bound, axis=1, kind="stable")
    best, number, taken = np.full(n, np.iinfo(np.int64).max), np.full(n, k, np.int64), 0
    rows = np.arange(n)
    for r in range(k):
        c = order[rows, r]
        open_ = bound[rows, c] <= best[rows]
        rows, c = rows[open_], c[open_]
        if not len(rows):
            break
        gap = x[rows] - centers[c]
        d = np.einsum("ij,ij->i", gap, gap)
        taken += len(rows)
        better = (d < best[rows]) | ((d == best[rows]) & (c < number[rows]))
        best[rows[better]], number[rows[better]] = d[better], c[better]
    return number, best, taken


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    rows = lambda name, n: batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1)
    return rows("x", batch.num_rows), rows("norms", batch.num_rows)


def _sums(vectors: DataFrame, centers: np.ndarray, segments: int) -> dict[int, tuple[int, list[int]]]:
    """By centroid, the number of its vectors and their sum; each task sends a row for each of its centroids."""
    of_centers = segment_norms(centers, segments)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(len(centers), np.int64), np.zeros(centers.shape, np.int64)
        for batch in batches:
            if batch.num_rows:
                x, norms = _arrays(batch)
                number, _, _ = nearest(x, norms, centers, of_centers)
                n += np.bincount(number, minlength=len(centers))
                np.add.at(total, number, x)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some]), pa.array(total[some].tolist(), pa.list_(pa.int64()))], ["c", "n", "total"])

    parts = vectors.select("x", "norms").mapInArrow(add, "c int, n long, total array<long>")
    places = parts.select("c", "n", F.posexplode("total").alias("at", "s")).groupBy("c", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in places.orderBy("c", "at").collect():  # k rows of dims numbers
        out.setdefault(r["c"], (r["n"], []))[1].append(r["s"])
    return out


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, segments: int = 8, seed: int = 1) -> tuple[DataFrame, np.ndarray]:
    """The rows (vec_id, cluster, distance, exact) of the quantised vectors, which are stored, and the final centroids; exact is how many distances were taken of each batch, on its first row.

    The mean of a round is floor(sum / count) of each component; an empty centroid stays.
    """
    kept = stored(vectors, "vectors")
    centers = first_centroids(kept, k, seed)
    for _ in range(rounds if len(centers) else 0):
        for c, (n, total) in _sums(kept, centers, segments).items():
            centers[c] = [s // n for s in total]
    of_centers = segment_norms(centers, segments) if len(centers) else centers

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                number, d, taken = nearest(*_arrays(batch), centers, of_centers)
                exact = np.zeros(len(d), np.int64)
                exact[0] = taken
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(d), pa.array(exact)], ["vec_id", "cluster", "distance", "exact"])

    return kept.mapInArrow(assign, "vec_id long, cluster int, distance long, exact long"), centers


def judged(vectors: DataFrame, k: int = 16, rounds: int = 3, segments: int = 8, dims: int = 64, scale: int = 64, seed: int = 1, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every whole vector. Assignments are stored; the k rows of inertia go to every task."""
    rows, centers = cluster(quantised(vectors, dims, scale, segments, id_col, vector_col), k, rounds, segments, seed)
    found = stored(rows, "assigned")
    names = [(c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centers.tolist())]
    hashes = vectors.sparkSession.createDataFrame(names, "cluster int, centroid_sha256 string")
    own = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).join(F.broadcast(hashes), "cluster")
    facts = own.crossJoin(F.broadcast(own.agg(F.sum("cluster_inertia").alias("inertia"))))
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
