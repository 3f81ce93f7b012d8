"""Neighbours, spanning trees and validity in blocks, against all pairs."""

import math
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from digestlake.operators import clustering, neighbours


def points(spark, x):
    return spark.createDataFrame([(i, [float(c) for c in p]) for i, p in enumerate(x)], "i long, v array<double>")


def blobs(seed=1, n=60, centers=12, spread=0.05, dims=3):
    rng = np.random.default_rng(seed)
    # a chain of clusters, so that far ones lie behind near ones
    middle = np.stack([np.arange(centers) * 2.0] + [np.zeros(centers)] * (dims - 1), axis=1)
    return np.concatenate([c + rng.normal(0, spread, (n, dims)) for c in middle])


def all_distances(x):
    return np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2)), 9)


def all_edges(x, k):
    d = all_distances(x)
    core = np.sort(d, axis=1)[:, k - 1]
    w = np.maximum(np.maximum(d, core[:, None]), core[None])
    u, v = np.triu_indices(len(x), 1)
    kept = neighbours.shortest_forest(w[u, v], u, v)
    return sorted(zip(w[u, v][kept].tolist(), u[kept].tolist(), v[kept].tolist())), core


def odd(seed):
    """Noise, copies and a dense spot that holds a third of the points."""
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.normal(0, 1, (150, 4)), np.zeros((60, 4)), rng.normal(5, 0.01, (90, 4)), rng.uniform(-20, 20, (20, 4))])


@pytest.mark.parametrize("block", [30, 1000])
def test_core_distances_of_all_pairs(spark, block):
    x = odd(2)
    cores, _ = neighbours.core_distances(neighbours.grid(points(spark, x), len(x), block), 5)
    got = dict(map(tuple, cores.select("i", "core").collect()))
    assert [got[i] for i in range(len(x))] == pytest.approx(all_edges(x, 5)[1].tolist(), abs=2e-9)


def test_far_blocks_do_not_meet(spark):
    x = blobs()
    g = neighbours.grid(points(spark, x), len(x), 30)
    cores, met = neighbours.core_distances(g, 5)
    got = dict(map(tuple, cores.select("i", "core").collect()))
    assert [got[i] for i in range(len(x))] == pytest.approx(all_edges(x, 5)[1].tolist(), abs=2e-9)
    blocks = g.points.select("b").distinct().count()
    assert blocks > 20 and met.count() < 0.5 * blocks * (blocks - 1)


def test_blocks_smaller_than_the_neighbourhood(spark):
    x = odd(3)[:40]
    cores, _ = neighbours.core_distances(neighbours.grid(points(spark, x), len(x), 3), 15)
    got = dict(map(tuple, cores.select("i", "core").collect()))
    assert [got[i] for i in range(len(x))] == pytest.approx(all_edges(x, 15)[1].tolist(), abs=2e-9)


@pytest.mark.parametrize("x, block", [(blobs(4, n=25), 20), (odd(5)[::2], 25), (odd(6)[::3], 500), (np.zeros((30, 2)), 7)])
def test_spanning_tree_of_all_pairs(spark, x, block):
    got = sorted(map(tuple, neighbours.spanning_edges(points(spark, x), len(x), 5, block).collect()))
    want, _ = all_edges(x, 5)
    assert [e[1:] for e in sorted(got, key=lambda e: e[1:])] == [e[1:] for e in sorted(want, key=lambda e: e[1:])]
    assert [e[0] for e in got] == pytest.approx([e[0] for e in want], abs=2e-9)


def test_no_edges(spark):
    assert neighbours.spanning_edges(points(spark, []), 0, 5, 100).count() == 0
    assert neighbours.spanning_edges(points(spark, [[1.0]]), 1, 5, 100).count() == 0


def brute_validity(edges, labels):
    names = sorted(set(labels) - {-1})
    out = {}
    for c in names:
        inner = max([w for w, u, v in edges if labels[u] == labels[v] == c], default=0)
        apart = min([w for w, u, v in edges if (labels[u] == c) != (labels[v] == c) and -1 not in (labels[u], labels[v])], default=None)
        if apart is None:
            outside = [w for w, u, v in edges if (labels[u] == -1) != (labels[v] == -1)]
            apart = 2 * (max(w for w, _, _ in edges) if len(names) > 1 or not outside else min(outside))
        out[c] = (apart - inner) / max(apart, inner) if max(apart, inner) else 0.0
    return sum(labels.count(c) / len(labels) * out[c] for c in names) if names else None


@pytest.mark.parametrize("kind", ["clusters", "noise", "one", "none", "mixed"])
def test_relative_validity(spark, kind):
    x = blobs(7, n=12, centers=5)
    rng = np.random.default_rng(1)
    own = [i // 12 for i in range(len(x))]
    labels = {"clusters": own, "noise": [-1 if i % 5 == 0 else c for i, c in enumerate(own)], "one": [0 if c < 3 else -1 for c in own], "none": [-1] * len(x), "mixed": rng.integers(-1, 4, len(x)).tolist()}[kind]
    rows = spark.createDataFrame([(i, [float(c) for c in p], labels[i]) for i, p in enumerate(x)], "vec_id long, embedding array<float>, cluster int")
    (got,) = clustering.relative_validity(rows, block=20).collect()
    x32 = x.astype(np.float32).astype(float)
    want = brute_validity(all_edges(x32, 5)[0], labels)
    assert got[0] is None if want is None else got[0] == pytest.approx(want, abs=1e-6)
    if kind == "clusters":
        assert got[0] > 0.5


@pytest.mark.parametrize("validity, silhouette, fine", [(0.1, 0.2, True), (-0.1, 0.2, False), (None, 0.2, True), (0.1, 0.01, False), (0.0, None, False), (None, None, True)])
def test_gate(spark, validity, silhouette, fine):
    rows = spark.createDataFrame([(i, i % 3) for i in range(9)], "vec_id long, cluster int")
    one = lambda name, value: spark.range(1).select(F.lit(value).cast("double").alias(name))
    (got,) = clustering.quality_gate(rows, one("silhouette", silhouette), one("relative_validity", validity)).collect()
    assert got["quality_pass"] is fine and got["relative_validity"] == validity


def test_a_block_moves_once_for_each_group(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "GROUPS", 2)
    rng = np.random.default_rng(8)
    g = neighbours.grid(points(spark, rng.normal(0, 1, (300, 3))), 300, 10)
    numbers = [r["b"] for r in g.points.select("b").distinct().collect()]
    met = spark.createDataFrame([(a, b) for a in numbers for b in numbers if a <= b], "b long, b2 long")

    def work(rows):
        import pandas as pd

        own, moved, pairs = set(), 0, 0
        for row in rows:
            if row.asked is None:
                own.add(row.b)
            else:
                assert set(row.asked) <= own
                moved, pairs = moved + 1, pairs + len(row.asked)
        yield pd.DataFrame({"moved": [moved], "pairs": [pairs]})

    got = g.together(g.blocks().select("b", "i", "v"), met, work, "moved long, pairs long").collect()
    assert sum(r["pairs"] for r in got) == met.count() > 10 * len(numbers)
    assert sum(r["moved"] for r in got) <= 2 * len(numbers)


@pytest.mark.parametrize("same", [True, False])
def test_dense_forest(same):
    rng = np.random.default_rng(9)
    # few different lengths, so that most edges are tied
    i = rng.permutation(40)[:25]
    j = i if same else np.setdiff1d(np.arange(40), i)
    d = rng.integers(1, 4, (len(i), len(j))).astype(float)
    d = np.maximum(d, d.T) if same else d
    x, y = np.nonzero(i[:, None] < j[None] if same else np.ones(d.shape, bool))
    w, u, v = d[x, y], np.minimum(i[x], j[y]), np.maximum(i[x], j[y])
    kept = neighbours.shortest_forest(w, u, v)
    assert sorted(zip(*neighbours.dense_forest(d, i, j, same))) == sorted(zip(w[kept], u[kept], v[kept]))


@pytest.mark.parametrize("block", [7, 2048])
def test_silhouette_of_all_pairs(spark, monkeypatch, block):
    """Against all pairs, with copies, a cluster of one, and noise; and no row for a pair of a point and a block."""
    monkeypatch.setattr(clustering, "SILHOUETTE_BLOCK", block)
    rng = np.random.default_rng(10)
    x = np.concatenate([rng.normal(0, 1, (60, 3)), np.ones((9, 3)), rng.normal(3, 1, (30, 3)), [[9.0, 9.0, 9.0]]])
    c = np.array([0] * 40 + [1] * 20 + [2] * 9 + [3] * 20 + [-1] * 10 + [4])
    rows = spark.createDataFrame([(i, [float(a) for a in p], int(k)) for i, (p, k) in enumerate(zip(x, c))], "vec_id long, embedding array<double>, cluster int")
    d, each = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2)), []
    for i in np.flatnonzero(c >= 0):
        outer = min(d[i, c == k].mean() for k in set(c.tolist()) - {-1, c[i]})
        inner = d[i, c == c[i]].sum() / max(1, (c == c[i]).sum() - 1)
        each.append((outer - inner) / max(outer, inner) if (c == c[i]).sum() > 1 else 0.0)
    out = clustering.silhouette(rows, block=5)
    assert out.first()[0] == pytest.approx(np.mean(each), abs=1e-9)
    assert clustering.silhouette(rows.where("cluster = 1"), block=5).first()[0] is None
    assert "other" not in out._jdf.queryExecution().optimizedPlan().toString()


def in_order(a, b):
    """The distance as SQL has it: squares added one by one, and halves of the ninth digit rounded up."""
    total = 0.0
    for x, y in zip(a, b):
        total += (x - y) ** 2
    scaled = math.sqrt(total) * 1e9
    return (math.floor(scaled) + (scaled - math.floor(scaled) >= 0.5)) / 1e9


def test_weights_to_the_last_digit(spark):
    # a pair whose distance by products is another one, in its ninth digit
    rng = np.random.default_rng(10)
    for _ in range(200_000):
        x = rng.normal(0, 1, 64)
        x *= 10 / np.linalg.norm(x)
        x = np.stack([x, x + rng.normal(0, 0.08, 64)])
        d, e = neighbours.distances(x, x.copy()), neighbours.distances(x[::-1].copy(), x[::-1].copy())
        if min(d[0, 1], d[1, 0], e[0, 1], e[1, 0]) > in_order(*x):
            break
    else:
        pytest.fail("no pair found")
    (got,) = neighbours.spanning_edges(points(spark, x), 2, 2, 100).collect()
    assert got["w"] == in_order(*x)


@pytest.mark.parametrize("most", [1, 3, 64])
def test_bounds_of_ways(most):
    rng = np.random.default_rng(11)
    n = 60
    x = np.concatenate([rng.normal(c, 0.3, (20, 3)) for c in range(3)])
    edges, _ = all_edges(x, 3)
    w, u, v = (np.array(e) for e in zip(*edges))
    root, way, ways = neighbours._bounds(w, u, v, most)
    largest = np.full((n, n), -1)
    group = [[i] for i in range(n)]
    for k, (a, b) in enumerate(zip(u, v)):
        a, b = group[a], group[b]
        largest[np.ix_(a, b)] = largest[np.ix_(b, a)] = k
        a += b
        for i in b:
            group[i] = a
    bound = np.maximum(np.maximum(way[:, None], way[None]), ways[root[:, None], root[None]])
    assert (bound >= largest).all() and len(ways) == most if most < n else True
    if most == 64:
        assert (bound == largest)[~np.eye(n, dtype=bool)].all()


def test_few_edges_are_looked_at():
    """With the edges to the nearest points known, blocks add few others and give the tree of all pairs."""
    rng = np.random.default_rng(12)
    x = rng.normal(0, 1, (600, 16))
    n, k = len(x), 12
    want, core = all_edges(x, 5)
    d = all_distances(x)
    w = np.maximum(np.maximum(d, core[:, None]), core[None])
    i, j = np.repeat(np.arange(n), k), np.argsort(d, axis=1)[:, 1 : k + 1].ravel()
    pairs = np.unique(np.concatenate([np.stack([np.minimum(i, j), np.maximum(i, j)], 1), [[0, a] for a in range(1, n)]]), axis=0)
    u, v = pairs.T
    kept = neighbours.shortest_forest(w[u, v], u, v)
    tree = np.stack([w[u, v][kept], u[kept], v[kept]], axis=1)
    root, way, ways = neighbours._bounds(*tree.T[:1], *tree.T[1:].astype(int))
    key = tree[:, 1].astype(int) * n + tree[:, 2].astype(int)
    at = lambda place, of: np.where(place < 0, -1, of[place])
    full = lambda m: np.pad(m, (0, neighbours.ROOTS - len(m)), constant_values=-1)
    row = lambda lo, hi: SimpleNamespace(i=np.arange(lo, hi), v=list(x[lo:hi].ravel()), core=core[lo:hi], root=root[lo:hi], bw=at(way, tree[:, 0])[lo:hi], bk=at(way, key)[lo:hi])
    blocks = [neighbours._Bounded(row(lo, lo + 200)) for lo in (0, 200, 400)]
    more = [e for a in range(3) for b in range(a, 3) for e in blocks[a].edges(blocks[b], a == b, n, full(at(ways, tree[:, 0])), full(at(ways, key)))]
    looked = sum(map(len, more))
    assert looked < 5 * n
    e = np.concatenate([tree, *more])
    got = e[neighbours.shortest_forest(*e.T)]
    assert [tuple(r) for r in got[:, 1:].astype(int)] == [r[1:] for r in want]
