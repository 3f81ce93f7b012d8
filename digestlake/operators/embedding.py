"""Vectors of our own from the words of posts: term weights as sparse rows, their truncated decomposition, and the hybrid of dense and sparse.

The decomposition is that of the matrix with a row for each post and a column for each term, by subspace iteration: each pass multiplies all rows with the current basis, which
has a row for each of a bounded number of columns, and adds the products up by column. A task adds its rows up before it sends anything, so what is shuffled grows with tasks, columns and
dimensions, not with rows; the driver holds the basis alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from digestlake.functions import vectors as V
from digestlake.sources.tables import written

#: Tasks of a pass at most, each of which sends as many rows as there are columns.
TASKS = 512
#: Products of entries and dimensions that are held at once; a batch of long posts has very many more.
HELD = 1 << 22
SPARSE = "at array<int>, w array<double>"


def sparse(weights: DataFrame, doc: str = "id", first: int = 0) -> tuple[DataFrame, DataFrame]:
    """Rows (doc, at, w) of weights (doc, term, weight), and the numbers (term, at) of the terms in their order, from first. There are as many terms as features, which bound a row and the table."""
    terms = written(weights.select("term").distinct().withColumn("at", (F.row_number().over(Window.orderBy("term")) - 1 + first).cast("int")), "terms")
    listed = F.array_sort(F.collect_list(F.struct("at", "weight")))
    rows = weights.join(F.broadcast(terms), "term").groupBy(doc).agg(listed.alias("x"))
    return rows.select(doc, F.col("x.at").alias("at"), F.col("x.weight").alias("w")), terms


def _parts(rows: pd.DataFrame, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row after the last, sizes, columns, weights) of stretches of sparse rows whose products with width dimensions are few enough to be held; one longer row is a stretch of its own."""
    ends = np.concatenate([[0], np.cumsum([len(a) for a in rows["at"]], dtype=np.int64)])
    at, w, lo = rows["at"].to_numpy(), rows["w"].to_numpy(), 0
    while lo < len(rows):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + HELD // width, "right")) - 1)
        yield lo, hi, np.diff(ends[lo : hi + 1]), np.concatenate([np.asarray(a, np.int64) for a in at[lo:hi]]), np.concatenate([np.asarray(x, float) for x in w[lo:hi]])
        lo = hi


def _times(rows: pd.DataFrame, basis: np.ndarray) -> np.ndarray:
    """The products of sparse rows with the basis."""
    out = np.zeros((len(rows), basis.shape[1]))
    for lo, hi, sizes, at, w in _parts(rows, basis.shape[1]):
        if len(at):
            some = np.flatnonzero(sizes)
            out[lo + some] = np.add.reduceat(basis[at] * w[:, None], (np.cumsum(sizes) - sizes)[some])
    return out


def basis(rows: DataFrame, columns: int, dims: int, passes: int = 6, seed: int = 42, extra: int = 8) -> np.ndarray:
    """The first dims right singular vectors (columns x dims) of the matrix of sparse rows, the strongest first."""
    width = min(columns, dims + extra)
    now = np.linalg.qr(np.random.default_rng(seed).normal(size=(columns, width)))[0]
    few = rows.select("at", "w").coalesce(TASKS)
    for _ in range(passes):

        def add(frames, now=now):
            total = np.zeros((columns, width))
            for frame in frames:
                if len(frame):
                    y = _times(frame, now)
                    for a, w, row in zip(frame["at"], frame["w"], y):
                        total[a] += np.asarray(w)[:, None] * row
            used = np.flatnonzero(total.any(axis=1))
            yield pd.DataFrame({"at": used.astype(np.int32), "x": list(total[used])})

        parts = few.mapInPandas(add, "at int, x array<double>").select("at", F.posexplode("x").alias("place", "x"))
        sums = parts.groupBy("at", "place").agg(F.sum("x").alias("x")).groupBy("at").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "x"))), lambda s: s["x"]).alias("x"))
        z = np.zeros((columns, width))
        for r in sums.collect():  # a row for each column at most
            z[r["at"]] = r["x"]
        now, values, _ = np.linalg.svd(z, full_matrices=False)
        if not values.any():
            break
    # a vector's sign is free: its largest component is positive
    sign = np.sign(now[np.abs(now).argmax(axis=0), np.arange(now.shape[1])])
    return (now * np.where(sign == 0, 1, sign))[:, :dims]


def projected(rows: DataFrame, vectors: np.ndarray, name: str = "embedding") -> DataFrame:
    """rows with their products with the basis at length one; an empty row has zeros. The basis goes to every task."""
    shared = rows.sparkSession.sparkContext.broadcast(vectors)

    @F.pandas_udf("array<double>")
    def run(at: pd.Series, w: pd.Series) -> pd.Series:
        return pd.Series(list(_times(pd.DataFrame({"at": at, "w": w}), shared.value)))

    return rows.withColumn("_product", run("at", "w")).withColumn(name, V.unit(F.col("_product"))).drop("_product")


def embedded(weights: DataFrame, doc: str = "id", dims: int = 64, passes: int = 6, seed: int = 42) -> DataFrame:
    """(doc, embedding) from term weights (doc, term, weight)."""
    rows, terms = sparse(weights, doc)
    kept = written(rows, "sparse")
    return projected(kept, basis(kept, terms.count(), dims, passes, seed)).select(doc, "embedding")


def hybrid(dense: DataFrame, weights: DataFrame, dims: int, doc: str = "id", vector: str = "embedding", weight: float = 0.35) -> tuple[DataFrame, int]:
    """Sparse rows (doc, at, w) of length one, dense components first and then weighted terms, and their number of columns. A document without terms has its dense part alone, one without a dense vector its terms."""
    rows, terms = sparse(weights, doc, dims)
    none = lambda kind: F.expr(f"cast(array() as array<{kind}>)")
    place = F.transform(F.col(vector), lambda x, i: i)
    both = dense.select(doc, place.alias("d_at"), F.col(vector).cast("array<double>").alias("d")).join(rows, doc, "full")
    at = F.concat(F.coalesce("d_at", none("int")), F.coalesce("at", none("int")))
    w = F.concat(F.coalesce("d", none("double")), F.transform(F.coalesce("w", none("double")), lambda x: x * weight))
    return both.select(doc, at.alias("at"), V.unit(w).alias("w")), dims + terms.count()
