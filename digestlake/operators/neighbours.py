"""Nearest neighbours and spanning trees of many points, exact, in blocks of which only near ones meet.

A bounded sample of points serves as pivots. Each point belongs to the cell of its nearest pivot, and cells are cut into blocks. By the triangle
inequality the distances of two blocks' points to their pivots, and the pivots' own distance, bound every distance between the blocks from below.
A block meets another one only where that bound lies below what its points still look for: the distance to the k-th neighbour within their own block, or the
largest edge on a way that already connects the two blocks through their pivots. So what is left out cannot matter, and results are those of all pairs.

Two tables decide which pairs of points are looked at closely. Neighbours are found first, and the spanning tree of the edges to them, of those between a bounded sample and of those to the pivots bounds, for each two
points, the largest edge on a way that connects them; an edge that is no smaller is in no smallest tree. Products in single precision tell which pairs may count; distances are those of differences.

Blocks are dealt to a bounded number of groups. A group's task holds its own blocks and streams through the blocks that any of them meets, so a block moves once for each group
and traffic grows with the points, not with the pairs of blocks; what a task found for its points is whole when it ends. The work itself is quadratic where nothing can be left out.

Distances are rounded to nine digits, so that equal ones are equal wherever they are computed. Only pivots, a sample and a few numbers for each cell or two roots reach the driver: PIVOTS, SAMPLE and ROOTS at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestlake.sources.tables import written

PIVOTS = 512
#: What rounding may take from a bound.
SLACK = 1e-7
#: No point's number.
NOBODY = np.iinfo(np.int64).max
#: Groups and blocks at most, as long as blocks stay below so many points; and edges that a task holds before it drops those of no forest.
GROUPS, BLOCKS, BLOCK_POINTS, HELD_EDGES = 48, 256, 4096, 1 << 20
POINT = "i long, v array<double>, cell int, r double"
#: Neighbours whose edges make the first tree, points of the sample that connects them, roots that its bounds lead to, and rows of a strip of products.
NEAR, SAMPLE, ROOTS, STRIP = 16, 2048, 64, 256


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances to nine digits. Products lose digits where points are close, so those are computed from differences."""
    far = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :]
    square = np.maximum(far - 2 * (a @ b.T), 0)
    x, y = np.nonzero(square < 1e-3 * far)
    for lo in range(0, len(x), 1 << 16):
        p, q = x[lo : lo + (1 << 16)], y[lo : lo + (1 << 16)]
        square[p, q] = ((a[p] - b[q]) ** 2).sum(axis=1)
    return np.round(np.sqrt(square), 9)


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of the rows of a and b, one by one, to the last bit as SQL has them: components are added in their order, and halves of the ninth digit go up."""
    out = np.empty(len(a))
    for lo in range(0, len(a), 1 << 14):
        y = np.sqrt(np.cumsum((a[lo : lo + (1 << 14)] - b[lo : lo + (1 << 14)]) ** 2, axis=1)[:, -1]) * 1e9
        whole = np.floor(y)
        out[lo : lo + (1 << 14)] = (whole + (y - whole >= 0.5)) / 1e9
    return out


def shortest_forest(w: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Places of the edges of a minimum spanning forest, edges being ordered by (w, u, v) with u < v. Each tree takes its first edge to another one, until there is none (Boruvka)."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    order = np.lexsort((v, u, w))
    a, b = ends[: len(u)][order], ends[len(u) :][order]
    tree, left, kept = np.arange(len(nodes)), np.arange(len(order)), np.zeros(len(order), bool)
    while len(left):
        x, y = tree[a[left]], tree[b[left]]
        across = x != y
        left, x, y = left[across], x[across], y[across]
        # the last of equal places is kept, so the first edge
        first = np.full((2, len(nodes)), len(order))
        first[0, x[::-1]] = first[1, y[::-1]] = left[::-1]
        first = first.min(axis=0)
        some = np.flatnonzero(first < len(order))
        edge = first[some]
        kept[edge] = True
        up = np.arange(len(nodes))
        up[some] = tree[a[edge]] + tree[b[edge]] - some
        both = some[(up[up[some]] == some) & (some < up[some])]
        up[both] = both
        while (further := up[up]).tobytes() != up.tobytes():
            up = further
        tree = up[tree]
    return order[kept]


def dense_forest(d: np.ndarray, i: np.ndarray, j: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(w, u, v) of the minimum spanning tree over all edges d between points i and j, or among the points i if they are the same; grown a point at a time (Prim), edges being ordered by (w, u, v) with u < v."""
    n, to = len(d), (slice(0, len(d)) if same else slice(len(d), None))
    back = None if same else np.ascontiguousarray(d.T)
    names = i if same else np.concatenate([i, j])
    best, near, far, free = np.full(len(names), np.inf), np.full(len(names), NOBODY), np.full(len(names), NOBODY), np.ones(len(names), bool)
    now, out = 0, []
    for _ in range(len(names) - 1):
        free[now], best[now] = False, np.inf
        row, part = (d[now], to) if now < n else (back[now - n], slice(0, n))
        b, u, v, other = best[part], near[part], far[part], names[part]
        closer = (row <= b) & free[part]
        at = np.flatnonzero(closer)
        less, more = np.minimum(names[now], other[at]), np.maximum(names[now], other[at])
        win = (row[at] < b[at]) | (less < u[at]) | ((less == u[at]) & (more < v[at]))
        at, less, more = at[win], less[win], more[win]
        b[at], u[at], v[at] = row[at], less, more
        now = int(best.argmin())
        same_w = np.flatnonzero(best == best[now])
        if len(same_w) > 1:
            now = int(same_w[np.lexsort((far[same_w], near[same_w]))[0]])
        out.append((best[now], near[now], far[now]))
    w, u, v = zip(*out) if out else ((), (), ())
    return np.array(w, float), np.array(u, np.int64), np.array(v, np.int64)


@dataclass
class Grid:
    """Points (b, i, v, cell, r) in numbered blocks, and the pivots with their points' numbers and distances."""

    points: DataFrame
    pivots: np.ndarray
    numbers: list[int]
    gaps: np.ndarray
    n_blocks: int

    @property
    def spark(self) -> SparkSession:
        return self.points.sparkSession

    def blocks(self, points: DataFrame | None = None, *more: str) -> DataFrame:
        """A row for each block with its points' numbers, their components one after the other, and more columns as arrays."""
        some = self.points if points is None else points
        lists = [F.collect_list("i").alias("i"), F.flatten(F.collect_list("v")).alias("v"), *(F.collect_list(c).alias(c) for c in more)]
        return some.groupBy("b", "cell").agg(*lists, F.min("r").alias("lo"), F.max("r").alias("hi"))

    def together(self, blocks: DataFrame, met: DataFrame, work: Callable[[Iterator], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
        """work(rows of a group) -> frames, for each group: first its own blocks, whose asked is None, and then each block b2 that one of them meets, asked being the list of those."""
        each = -(-self.n_blocks // GROUPS)
        own = blocks.select(F.expr(f"cast(b div {each} as int)").alias("h"), F.lit(None).cast("array<long>").alias("asked"), *blocks.columns)
        # as many rows as blocks and groups
        asked = met.groupBy(F.expr(f"cast(b div {each} as int)").alias("h"), F.col("b2").alias("b")).agg(F.collect_list("b").alias("asked"))
        others = blocks.join(F.broadcast(asked), "b").select("h", "asked", *blocks.columns)
        groups = -(-self.n_blocks // each)

        def run(frames):
            def rows() -> Iterator:
                for frame in frames:
                    yield from frame.itertuples(index=False)

            now: list = [None]

            def of_group(first) -> Iterator:
                yield first
                for row in stream:
                    if row.h != first.h:
                        now[0] = row
                        return
                    yield row

            stream = rows()
            now[0] = next(stream, None)
            while now[0] is not None:
                first, now[0] = now[0], None
                yield from work(of_group(first))

        dealt = own.unionByName(others).repartitionById(max(1, groups), F.col("h")).sortWithinPartitions("h", F.col("asked").isNotNull(), "b")
        return dealt.mapInPandas(run, schema)

    def pairs(self, left: DataFrame, right: DataFrame, cells: np.ndarray, limit: np.ndarray | None) -> DataFrame:
        """(b, b2) of blocks (b, cell, lo, hi, most) and (b, cell, lo, hi) in cells that are near, whose points may be nearer than most, or than limit says for the two cells."""
        p, q = np.nonzero(cells)
        most = limit[p, q] if limit is not None else np.zeros(len(p))
        near = self.spark.createDataFrame(pd.DataFrame({"cell": p.astype(np.int32), "cell2": q.astype(np.int32), "gap": self.gaps[p, q], "limit": most}), "cell int, cell2 int, gap double, limit double")
        other = right.select(F.col("b").alias("b2"), F.col("cell").alias("cell2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
        bound = F.greatest(F.col("gap") - F.col("hi") - F.col("hi2"), F.col("lo2") - F.col("gap") - F.col("hi"), F.col("lo") - F.col("gap") - F.col("hi2"))
        met = left.join(F.broadcast(near), "cell").join(other, "cell2")
        return met.where(bound <= (F.col("limit") if limit is not None else F.col("most")) + SLACK).select("b", "b2")


def grid(rows: DataFrame, n: int, block: int, most_pivots: int = PIVOTS) -> Grid:
    """rows (i, v) in cells and blocks of about block points."""
    spark = rows.sparkSession
    block = max(block, min(BLOCK_POINTS, -(-n // BLOCKS)))
    count = max(1, min(most_pivots, -(-n // block)))
    chosen = rows.orderBy(F.xxhash64("i"), "i").limit(count).collect()
    pivots, numbers = np.array([r["v"] for r in chosen], float), [r["i"] for r in chosen]

    def place(frames):
        for frame in frames:
            if len(frame):
                d = distances(np.stack(frame["v"]), pivots)
                cell = d.argmin(axis=1)
                yield frame.assign(cell=cell.astype(np.int32), r=d[np.arange(len(d)), cell])

    placed = written(rows.select("i", "v").mapInPandas(place, POINT), "cells")
    sizes = {r["cell"]: r["n"] for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts, first, total = [], 0, 0
    for c in sorted(sizes):
        parts.append((c, first, -(-sizes[c] // block)))
        first += parts[-1][2]
    table = spark.createDataFrame(parts, "cell int, first long, parts long")
    points = placed.join(F.broadcast(table), "cell").select((F.col("first") + F.pmod(F.xxhash64("i"), F.col("parts"))).alias("b"), "i", "v", "cell", "r")
    return Grid(points, pivots, numbers, distances(pivots, pivots), first)


class _Nearest:
    """The k nearest points so far of each point of a block: distances d and numbers j, by distance and then number. Products tell which may count; distances are those of differences."""

    def __init__(self, row, k: int):
        self.i, self.k = np.asarray(row.i, np.int64), k
        self.v = np.asarray(row.v, float).reshape(len(self.i), -1)
        self.d, self.j = np.full((len(self.i), k), np.inf), np.full((len(self.i), k), NOBODY)
        self.close = _Close(self.v)
        self.add(self.i, self.v)

    def add(self, j: np.ndarray, v: np.ndarray) -> None:
        """Takes the points j at v into account."""
        other = self.close.other(v)
        for lo in range(0, len(self.i), STRIP):
            rows = slice(lo, lo + STRIP)
            most = self.d[rows, -1]
            if len(j) >= self.k and np.isinf(most).any():
                most = np.fmin(most, other.reach(rows, self.k))
            p, q = other.within(rows, most)
            for at in range(0, len(p), 1 << 16):
                self._take(p[at : at + (1 << 16)], q[at : at + (1 << 16)], j, v)

    def _take(self, p: np.ndarray, q: np.ndarray, j: np.ndarray, v: np.ndarray) -> None:
        d = apart(self.v[p], v[q])
        d[self.i[p] == j[q]] = -1.0  # itself before its copies
        near = d <= self.d[p, -1]
        p, q, d = p[near], q[near], d[near]
        some = np.unique(p)
        row, dist, number = np.concatenate([np.repeat(some, self.k), p]), np.concatenate([self.d[some].ravel(), d]), np.concatenate([self.j[some].ravel(), j[q]])
        by = np.lexsort((number, dist, row))
        row = row[by]
        head = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, int)
        first = by[head[:, None] + np.arange(self.k)]
        self.d[some], self.j[some] = dist[first], number[first]


class _Close:
    """Points in single precision around their middle."""

    def __init__(self, v: np.ndarray):
        self.middle = v.mean(axis=0)
        self.few = (v - self.middle).astype(np.float32)
        self.squares = (self.few * self.few).sum(axis=1)
        #: What products may lose, as a share of both squares.
        self.loss = 2e-5 * max(1, v.shape[1] / 64)

    def other(self, v: np.ndarray) -> _Others:
        return _Others(self, (v - self.middle).astype(np.float32))


class _Others:
    """Other points, as columns that a product turns into squared distances less the rows' own squares."""

    def __init__(self, close: _Close, few: np.ndarray):
        self.close, self.squares = close, (few * few).sum(axis=1)
        self.columns = np.ascontiguousarray(np.concatenate([-2 * few, self.squares[:, None]], axis=1).T)

    def _products(self, rows: slice) -> np.ndarray:
        few = self.close.few[rows]
        return np.concatenate([few, np.ones((len(few), 1), np.float32)], axis=1) @ self.columns

    def reach(self, rows: slice, k: int) -> np.ndarray:
        """For each of the rows a distance within which k columns are."""
        own = self.close.squares[rows].astype(float)
        with np.errstate(over="ignore", invalid="ignore"):
            return np.sqrt(np.maximum(np.partition(self._products(rows), k - 1, axis=1)[:, k - 1] + own, 0) + self.close.loss * (own + self.squares.max(initial=0)))

    def within(self, rows: slice, most: np.ndarray, more: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows, and of the columns, whose distance may be at most that of the row or, where given, of the column. What is no number may count."""
        own = self.close.squares[rows]
        with np.errstate(over="ignore", invalid="ignore"):
            d = self._products(rows)
            far = d > ((most + SLACK) ** 2 + self.close.loss * (own + self.squares.max(initial=0)) - own).astype(np.float32)[:, None]
            if more is not None:
                d += own[:, None]
                far &= d > ((more + SLACK) ** 2 + self.close.loss * (self.squares + own.max(initial=0))).astype(np.float32)[None, :]
        x, y = np.divmod(np.flatnonzero(~far), len(self.squares))
        return x + rows.start, y


def nearest(g: Grid, k: int) -> tuple[DataFrame, DataFrame]:
    """(i, near), the k nearest points as (distance, number), a point being its own first and the smaller number coming first of equals; and the pairs (b, b2) of blocks that met for it. Both are stored."""
    blocks = g.blocks()

    def inside(frames):
        for frame in frames:
            # the most that a point of the block still looks for; without k points in the block, anything
            yield pd.DataFrame([(row.b, row.cell, row.lo, row.hi, _Nearest(row, k).d[:, -1].max()) for row in frame.itertuples(index=False)], columns=["b", "cell", "lo", "hi", "most"])

    known = written(blocks.mapInPandas(inside, "b long, cell int, lo double, hi double, most double"), "blocks")
    radius, asked = np.zeros(len(g.pivots)), np.full(len(g.pivots), -np.inf)
    for r in known.groupBy("cell").agg(F.max("hi").alias("hi"), F.max("most").alias("most")).collect():
        radius[r["cell"]], asked[r["cell"]] = r["hi"], r["most"]
    some = asked > -np.inf
    cells = (g.gaps - radius[:, None] - radius[None, :] <= asked[:, None] + SLACK) & some[:, None] & some[None, :]
    met = written(g.pairs(known, known, cells, None).where("b <> b2"), "met")

    def search(rows):
        own: dict[int, _Nearest] = {}
        for row in rows:
            if row.asked is None:
                own[row.b] = _Nearest(row, k)
                continue
            j = np.asarray(row.i, np.int64)
            v = np.asarray(row.v, float).reshape(len(j), -1)
            for b in row.asked:
                own[b].add(j, v)
        for one in own.values():
            yield pd.DataFrame({"i": one.i, "d": list(np.maximum(one.d, 0)), "j": list(one.j)})

    found = g.together(blocks.select("b", "i", "v"), met, search, "i long, d array<double>, j array<long>")
    near = F.filter(F.zip_with("d", "j", lambda d, j: F.struct(d.alias("d"), j.alias("j"))), lambda s: s["j"] != F.lit(int(NOBODY)))
    return written(found.select("i", near.alias("near")), "near"), met


def core_distances(g: Grid, k: int) -> tuple[DataFrame, DataFrame]:
    """(i, core), the distance to the k-th nearest point, a point being its own first; and the pairs of blocks that met for it."""
    near, met = nearest(g, k)
    return near.select("i", F.element_at("near", -1)["d"].alias("core")), met


def _ways(w: np.ndarray) -> np.ndarray:
    """For each two nodes, the largest edge on the way between them in the minimum spanning tree of the weights w."""
    n = len(w)
    out, group = np.zeros((n, n)), [[x] for x in range(n)]
    u, v = np.triu_indices(n, 1)
    for e in shortest_forest(w[u, v], u, v) if n > 1 else []:
        a, b = group[u[e]], group[v[e]]
        out[np.ix_(a, b)] = out[np.ix_(b, a)] = w[u[e], v[e]]
        a += b
        for x in b:
            group[x] = a
    return out


def _bounds(w: np.ndarray, u: np.ndarray, v: np.ndarray, most: int = ROOTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(root, way, ways) from the n - 1 edges of a tree over points 0 .. n - 1, ordered by (w, u, v): for each point a root and the place of the largest edge on the way to it, and the same for each two roots; -1 is no edge.

    Roots are the first points of the trees that were largest when the edges, taken in order, tied them to larger ones. The largest edge between two points is at most the largest of the ways to their roots and between those.
    """
    n = len(w) + 1
    up, top, size, sides, first = list(range(n)), list(range(n)), [1] * n, [], list(range(n))
    lost = []
    for k, (a, b) in enumerate(zip(u.tolist(), v.tolist())):
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        while up[b] != b:
            up[b] = up[up[b]]
            b = up[b]
        if (size[a], -first[a]) < (size[b], -first[b]):
            a, b = b, a
        sides.append((top[a], top[b]))
        lost.append((size[b], first[b]))
        up[b], size[a], top[a] = a, size[a] + size[b], n + k
    largest = sorted(range(n - 1), key=lambda k: -lost[k][0])[: most - 1]
    roots = [first[a]] + [lost[k][1] for k in largest] if n > 1 else [0]
    number = {p: r for r, p in enumerate(roots)}
    ways = np.full((len(roots), len(roots)), -1)
    # the roots below each node, the main one first
    below: dict[int, list[int]] = {p: [r] for p, r in number.items()}
    given: list[tuple[int, int] | None] = [None] * (2 * n - 1)
    for k, (x, y) in enumerate(sides):
        a, b = below.pop(x, None), below.pop(y, None)
        if a and b:
            ways[np.ix_(a, b)] = ways[np.ix_(b, a)] = k
        elif a or b:
            given[y if a else x] = ((a or b)[0], k)
        if a or b:
            below[n + k] = (a or []) + (b or [])
    for k in range(n - 2, -1, -1):
        if (one := given[n + k]) is not None:
            for side in sides[k]:
                given[side] = one
    root, way = np.zeros(n, np.int64), np.full(n, -1)
    for i in range(n):
        if i in number:
            root[i] = number[i]
        else:
            root[i], way[i] = given[i]
    return root, way, ways


def _edges(e: np.ndarray, h: int) -> pd.DataFrame:
    return pd.DataFrame({"w": e[:, 0], "u": e[:, 1].astype(np.int64), "v": e[:, 2].astype(np.int64), "h": h})


def _forest(frame: pd.DataFrame) -> pd.DataFrame:
    return frame.iloc[shortest_forest(*(frame[c].to_numpy() for c in ("w", "u", "v")))]


def _merged(edges: DataFrame, groups: int) -> DataFrame:
    """The forest of edges (w, u, v, h) of so many groups h. Each round halves the groups, so no task reads more than two forests."""
    while groups > 1:
        groups = -(-groups // 2)
        edges = edges.withColumn("h", F.expr("cast(h div 2 as long)")).groupBy("h").applyInPandas(_forest, EDGE)
    return edges


EDGE = "w double, u long, v long, h long"


def _first_tree(g: Grid, points: DataFrame, near: DataFrame, n: int) -> DataFrame:
    """A tree (w, u, v) over all points that is close to the smallest: that of the edges to neighbours, of those to the pivots, and of the tree of a sample, to which the pivots belong."""
    numbers, spots, each = g.numbers, g.pivots, -(-g.n_blocks // GROUPS)
    few = points.select("i", "v", "core").orderBy(F.xxhash64("i"), "i").limit(max(SAMPLE, len(numbers))).collect()
    i, v, c = np.array([r["i"] for r in few]), np.array([r["v"] for r in few], float), np.array([r["core"] for r in few])
    at = np.argsort(i)
    i, v, c = i[at], v[at], c[at]
    d = np.empty((len(i), len(i)))
    for lo in range(0, len(i), STRIP):
        d[lo : lo + STRIP] = np.maximum(np.maximum(distances(v[lo : lo + STRIP], v), c[lo : lo + STRIP, None]), c[None, :])
    _, a, b = dense_forest(d, i, i, True)
    x, y = np.searchsorted(i, a), np.searchsorted(i, b)
    sample = pd.DataFrame({"w": np.maximum(np.maximum(apart(v[x], v[y]), c[x]), c[y]), "u": a, "v": b, "h": 0})
    core = dict(zip(i.tolist(), c.tolist()))
    pivots, own = np.array(numbers), np.array([core[k] for k in numbers])

    def stars(frames):
        for frame in frames:
            cell, j = frame["cell"].to_numpy(), frame["i"].to_numpy()
            some = pivots[cell] != j
            if some.any():
                cell, j, frame = cell[some], j[some], frame[some]
                w = np.maximum(np.maximum(apart(np.stack(frame["v"]), spots[cell]), frame["core"].to_numpy()), own[cell])
                yield pd.DataFrame({"w": w, "u": np.minimum(j, pivots[cell]), "v": np.maximum(j, pivots[cell]), "h": frame["b"].to_numpy() // each})

    tied = near.select("i", F.explode("near").alias("s")).select("i", F.col("s.j").alias("j"), F.col("s.d").alias("d")).where("i <> j")
    mine, other = points.select("i", "b", "core"), points.select(F.col("i").alias("j"), F.col("core").alias("core2"))
    tied = tied.join(mine, "i").join(other, "j").select(F.greatest("d", "core", "core2").alias("w"), F.least("i", "j").alias("u"), F.greatest("i", "j").alias("v"), F.expr(f"cast(b div {each} as long)").alias("h"))
    every = tied.unionByName(points.select("i", "v", "core", "cell", "b").mapInPandas(stars, EDGE)).unionByName(g.spark.createDataFrame(sample, EDGE))

    return written(_merged(every.groupBy("h").applyInPandas(_forest, EDGE), -(-g.n_blocks // each)).select("w", "u", "v"), "tree")


def spanning_edges(rows: DataFrame, n: int, least_samples: int, block: int) -> DataFrame:
    """Edges (w, u, v) of the minimum spanning tree of mutual reachability of rows (i, v), numbered 0 .. n - 1.

    A first tree says for each two points how long their edge may be, and each pair of near blocks gives the forest of the edges that are smaller. Forests are merged until one is left. Edges are ordered by (w, u, v);
    blocks are far if all their edges are longer than the longest one on a way between them through their pivots.
    """
    if n < 2:
        return rows.sparkSession.createDataFrame([], "w double, u long, v long")
    g = grid(rows, n, block)
    near, _ = nearest(g, min(max(least_samples, NEAR), n))
    cores = near.select("i", F.element_at("near", min(least_samples, n))["d"].alias("core"))
    points = written(g.points.join(cores, "i"), "reach")
    tree = _first_tree(g, points, near, n)

    def bound(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["w", "u", "v"])
        w, u, v = (frame[c].to_numpy() for c in ("w", "u", "v"))
        root, way, ways = _bounds(w, u, v)
        place = np.concatenate([way, ways.ravel()])
        # two roots have a number below 0
        i = np.concatenate([np.arange(n), -1 - (np.arange(len(ways))[:, None] * ROOTS + np.arange(len(ways))).ravel()])
        none = place < 0
        return pd.DataFrame({"i": i, "root": np.concatenate([root, np.zeros(ways.size, np.int64)]), "bw": np.where(none, -1.0, w[place]), "bk": np.where(none, -1, u[place] * n + v[place])})

    bounds = written(tree.withColumn("g", F.lit(0)).groupBy("g").applyInPandas(bound, "i long, root long, bw double, bk long"), "bounds")
    ways, keys = np.full((ROOTS, ROOTS), -1.0), np.full((ROOTS, ROOTS), -1)
    for r in bounds.where("i < 0").collect():  # as many rows as two roots
        ways[divmod(-1 - r["i"], ROOTS)], keys[divmod(-1 - r["i"], ROOTS)] = r["bw"], r["bk"]

    own = {r["i"]: r["core"] for r in points.where(F.col("i").isin(g.numbers)).select("i", "core").collect()}
    core = np.array([own[i] for i in g.numbers])
    radius, star, least, some = np.zeros(len(core)), np.zeros(len(core)), np.zeros(len(core)), np.zeros(len(core), bool)
    for r in points.groupBy("cell").agg(F.max("r").alias("r"), F.max(F.greatest("r", "core")).alias("star"), F.min("core").alias("least")).collect():
        c = r["cell"]
        radius[c], star[c], least[c], some[c] = r["r"], max(r["star"], core[c]), r["least"], True
    between = np.maximum(np.maximum(g.gaps, core[:, None]), core[None, :])
    limit = np.maximum(np.maximum(_ways(between), star[:, None]), star[None, :])
    shortest = np.maximum(np.maximum(g.gaps - radius[:, None] - radius[None, :], least[:, None]), least[None, :])
    cells = (shortest <= limit + SLACK) & some[:, None] & some[None, :]
    blocks = g.blocks(points.join(bounds.where("i >= 0"), "i"), "core", "root", "bw", "bk")
    sizes = written(g.blocks(points).select("b", "cell", "lo", "hi"), "blocks")
    met = written(g.pairs(sizes, sizes, cells, limit).where("b <= b2"), "met")

    def forests(rows):
        own, held, size, most = {}, [], 0, HELD_EDGES
        for row in rows:
            if row.asked is None:
                own[row.b] = _Bounded(row)
                continue
            other = _Bounded(row)
            for b in row.asked:
                for e in own[b].edges(other, b == row.b, n, ways, keys):
                    held.append(e)
                    size += len(e)
                    if size > most:
                        held, size = [forest(np.concatenate(held))], 0
                        most = max(HELD_EDGES, len(held[0]))
        if size or held:
            yield _edges(forest(np.concatenate(held)), row.h)

    def forest(e: np.ndarray) -> np.ndarray:
        return e[shortest_forest(e[:, 0], e[:, 1], e[:, 2])]

    groups = min(GROUPS, g.n_blocks)
    edges = g.together(blocks.select("b", "i", "v", "core", "root", "bw", "bk"), met, forests, EDGE).unionByName(tree.withColumn("h", F.lit(groups).cast("long")))
    return _merged(edges, groups + 1).select("w", "u", "v")


class _Bounded:
    """The points of a block by root, with the largest edges on the ways to their roots."""

    def __init__(self, row):
        by = np.argsort(np.asarray(row.root), kind="stable")
        self.i, self.core, self.root, self.bw, self.bk = (np.asarray(x, t)[by] for x, t in ((row.i, np.int64), (row.core, float), (row.root, np.int64), (row.bw, float), (row.bk, np.int64)))
        self.v = np.asarray(row.v, float).reshape(len(by), -1)[by]
        self.starts = np.flatnonzero(np.concatenate([[True], self.root[1:] != self.root[:-1]])).tolist() + [len(by)]
        self._close = None

    def edges(self, other: _Bounded, same: bool, n: int, ways: np.ndarray, keys: np.ndarray) -> Iterator[np.ndarray]:
        """Edges (w, u, v) to the other points that are smaller than the largest on the way that is known."""
        self._close = self._close or _Close(self.v)
        columns = self._close.other(other.v)
        for start, end in zip(self.starts, self.starts[1:]):
            r = self.root[start]
            more = np.maximum(other.bw, ways[r, other.root])
            for lo in range(start, end, STRIP):
                rows = slice(lo, min(lo + STRIP, end))
                x, y = columns.within(rows, np.maximum(self.bw[rows], 0), np.maximum(more, 0))
                for at in range(0, len(x), 1 << 16):
                    p, q = x[at : at + (1 << 16)], y[at : at + (1 << 16)]
                    if same:  # each pair once, and none with itself
                        once = self.i[p] < other.i[q]
                        p, q = p[once], q[once]
                    w = np.maximum(np.maximum(apart(self.v[p], other.v[q]), self.core[p]), other.core[q])
                    u, v = np.minimum(self.i[p], other.i[q]), np.maximum(self.i[p], other.i[q])
                    s = other.root[q]
                    three = np.stack([self.bw[p], other.bw[q], ways[r, s]])
                    most = three.max(axis=0)
                    key = np.where(three == most, np.stack([self.bk[p], other.bk[q], keys[r, s]]), -1).max(axis=0)
                    less = (w < most) | ((w == most) & (u * n + v < key))
                    if less.any():
                        yield np.stack([w[less], u[less], v[less]], axis=1)


def validity(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """(cluster, size, sparseness, separation, validity) of clusters of points (i, cluster), from the edges of their spanning tree; noise (-1) is no cluster.

    The sparseness of a cluster is its longest edge, its separation the shortest edge to another cluster, and its validity their difference over the larger of both: from -1
    to 1, and 0 where both are 0. A cluster with no edge to another has twice the longest edge of all as separation; the only cluster has twice the shortest edge to noise, if there is one.
    """
    of = lambda end, name: labels.select(F.col("i").alias(end), F.col("cluster").alias(name))
    e = edges.join(of("u", "a"), "u").join(of("v", "z"), "v").select("w", "a", "z")
    inner = e.where("a = z and a <> -1").groupBy(F.col("a").alias("cluster")).agg(F.max("w").alias("sparseness"))
    across = e.where("a <> z and a <> -1 and z <> -1").select("w", F.explode(F.array("a", "z")).alias("cluster")).groupBy("cluster").agg(F.min("w").alias("apart"))
    sizes = labels.where("cluster <> -1").groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    total = e.agg(F.coalesce(F.max("w"), F.lit(0.0)).alias("longest"), F.min(F.when((F.col("a") == -1) != (F.col("z") == -1), F.col("w"))).alias("outside"))
    clusters = sizes.agg(F.count(F.lit(1)).alias("clusters"))
    else_ = 2 * F.when(F.col("clusters") > 1, F.col("longest")).otherwise(F.coalesce("outside", "longest"))
    rows = sizes.join(inner, "cluster", "left").join(across, "cluster", "left").crossJoin(F.broadcast(total)).crossJoin(F.broadcast(clusters))
    rows = rows.select("cluster", "size", F.coalesce("sparseness", F.lit(0.0)).alias("sparseness"), F.coalesce("apart", else_).alias("separation"))
    larger = F.greatest("sparseness", "separation")
    return rows.withColumn("validity", F.when(larger > 0, (F.col("separation") - F.col("sparseness")) / larger).otherwise(0.0))


def relative_validity(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: the clusters' validities, weighted by their share of all points; null without a cluster."""
    n = labels.agg(F.count(F.lit(1)).alias("n"))
    return validity(edges, labels).crossJoin(F.broadcast(n)).agg(F.sum(F.col("size") / F.col("n") * F.col("validity")).alias("relative_validity"))
