"""Manifolds, embeddings of our own and the hybrid path, from posts to clusters."""

import random
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from digestlake.operators import clustering, embedding, manifold
from digestlake.plans import pipeline


def trust(x, y, k=10):
    """Trustworthiness (Venna and Kaski 2001): how near, in x, the nearest points in y are."""
    n = len(x)
    gap = lambda z: np.where(np.eye(n, dtype=bool), np.inf, np.sqrt(((z[:, None] - z[None]) ** 2).sum(axis=2)))
    rank = np.argsort(np.argsort(gap(x), axis=1), axis=1) + 1
    near = np.argsort(gap(y), axis=1)[:, :k]
    return 1 - 2 / (n * k * (2 * n - 3 * k - 1)) * np.maximum(np.take_along_axis(rank, near, axis=1) - k, 0).sum()


def sheet(n=400):
    """A rolled sheet, turned into 20 dimensions, at length one."""
    rng = np.random.default_rng(0)
    t = 1.5 * np.pi * (1 + 2 * rng.random(n))
    flat = np.stack([t * np.cos(t), 10 * rng.random(n), t * np.sin(t)], axis=1)
    x = np.concatenate([flat @ np.linalg.qr(rng.normal(size=(20, 3)))[0].T, np.full((n, 1), 20.0)], axis=1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def points(spark, x):
    return spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")


def places(df):
    rows = sorted(df.collect(), key=lambda r: r["vec_id"])
    return np.stack([r["reduced"] for r in rows])


def test_manifold_keeps_neighbours_better_than_components(spark):
    x = sheet()
    given = points(spark, x)
    laid = places(clustering.umap(given, dims=2, block=150, rounds=4))
    assert trust(x, laid) > trust(x, places(clustering.reduced(given, dims=2))) + 0.005
    assert (laid == places(clustering.umap(given, dims=2, block=150, rounds=4))).all()


def test_manifold_of_little(spark):
    x = sheet(5)
    assert places(clustering.umap(points(spark, x), dims=0)) == pytest.approx(x)
    assert places(clustering.umap(points(spark, x), dims=2, epochs=10, rounds=1)).shape == (5, 2)


def test_memberships_sum_to_a_logarithm():
    d = np.sort(np.random.default_rng(1).random((50, 14)), axis=1)
    w = manifold.memberships(d, 15)
    assert w[:, 0] == pytest.approx(1) and w.sum(axis=1) == pytest.approx(np.log2(15), abs=1e-6)
    assert manifold.memberships(np.zeros((1, 4)), 5) == pytest.approx(1)


def test_curve():
    assert manifold.curve(0.0) == pytest.approx((1.933, 0.790), abs=2e-3) and manifold.curve(0.1) == pytest.approx((1.577, 0.895), abs=2e-3)


def test_graph_joins_both_directions(spark):
    near = spark.createDataFrame([(0, [(0.0, 0), (0.5, 1)]), (1, [(0.0, 1), (0.2, 2), (0.5, 0)]), (2, [(0.0, 2), (0.2, 1)])], "i long, near array<struct<d double, j long>>")
    got = {(r["i"], r["j"]): r["w"] for r in manifold.graph(near, 3).collect()}
    p = {(0, 1): 1.0, (1, 2): 1.0, (2, 1): 1.0, (1, 0): manifold.memberships(np.array([[0.02, 0.125]]), 3)[0, 1]}
    assert got == pytest.approx({(i, j): p[i, j] + p[j, i] - p[i, j] * p[j, i] for i, j in p})


def sparse_rows(spark, a):
    rows = [(i, [int(c) for c in np.flatnonzero(r)], [float(x) for x in r[r != 0]]) for i, r in enumerate(a)]
    return spark.createDataFrame(rows, f"id long, {embedding.SPARSE}")


def test_basis_spans_what_the_decomposition_does(spark):
    rng = np.random.default_rng(3)
    a = (rng.normal(size=(120, 6)) * [9, 7, 5, 3, 2, 1.5]) @ rng.normal(size=(6, 40)) + 0.01 * rng.normal(size=(120, 40))
    a[rng.random(a.shape) < 0.3] = 0
    a[7] = 0
    ours = embedding.basis(sparse_rows(spark, a), 40, 4, passes=30)
    _, _, vt = np.linalg.svd(a, full_matrices=False)
    # cosines of the angles between the two subspaces
    assert np.linalg.svd(vt[:4] @ ours)[1] == pytest.approx(np.ones(4), abs=1e-4)
    got = np.stack([r["embedding"] for r in embedding.projected(sparse_rows(spark, a), ours).orderBy("id").collect()])
    want = a @ ours
    want[7] = 1
    assert got[np.arange(120) != 7] == pytest.approx((want / np.linalg.norm(want, axis=1, keepdims=True))[np.arange(120) != 7], abs=1e-9) and not got[7].any()


def test_hybrid_rows(spark):
    dense = spark.createDataFrame([("a", [0.6, 0.8]), ("b", [1.0, 0.0])], "id string, embedding array<double>")
    weights = spark.createDataFrame([("a", "x", 0.6), ("a", "y", 0.8), ("c", "y", 1.0)], "id string, term string, weight double")
    rows, columns = embedding.hybrid(dense, weights, 2, weight=0.5)
    got = {r["id"]: dict(zip(r["at"], r["w"])) for r in rows.collect()}
    n = (1 + 0.25) ** 0.5
    assert columns == 4
    assert got["a"] == pytest.approx({0: 0.6 / n, 1: 0.8 / n, 2: 0.3 / n, 3: 0.4 / n}) and got["b"] == pytest.approx({0: 1, 1: 0}) and got["c"] == pytest.approx({3: 1})


def test_from_posts_to_prompts(spark):
    rng = random.Random(4)
    words = {"sea": "harbour sailor anchor tide vessel captain sails cargo", "kitchen": "flour oven butter recipe dough bakery sugar yeast", "field": "harvest tractor barley meadow fence cattle plough grain"}
    rows = []
    for n, (topic, listed) in enumerate(words.items()):
        rows += [(str(100 * n + k), " ".join(rng.choices(listed.split(), k=14)) + f" {topic}", 10 * k + n) for k in range(40)]
    rows += [("900", "", 5), ("901", "entirely unrelated remark", 7)]
    posts = spark.createDataFrame([(i, t, "Mon Jan 01 00:00:00 +0000 2024", "someone", False, 10, likes, False, False, "q", int(i)) for i, t, likes in rows], "id string, text string, created_at string, screen_name string, verified boolean, followers long, likes long, is_retweet boolean, is_quote boolean, _query string, _ord long")
    grouped, vectors = pipeline.hybrid_clusters(posts.withColumn("unused", F.lit(1)), dims=5)
    got = {r["id"]: r["cluster"] for r in grouped.collect()}
    assert len(got) == len(rows) and got["900"] == -1
    for n in range(3):
        own = [got[str(100 * n + k)] for k in range(40)]
        assert max(own.count(c) for c in set(own) - {-1}) >= 30
    assert len({max(set(x) - {-1}, key=x.count) for x in ([got[str(100 * n + k)] for k in range(40)] for n in range(3))}) == 3
    s = pipeline.Settings(as_of=datetime(2024, 1, 2))
    told = pipeline.hybrid_digest(posts, s).collect()
    assert len(told) >= 3 and all(r["prompt"].startswith(f"# Cluster {r['cluster']}: {r['label']}\n# Tweet count: ") for r in told)
    assert any(set(r["label"].lower().replace("/", " ").split()) & set(words["sea"].split() + ["sea"]) for r in told)


def test_products_hold_a_bounded_number_of_terms():
    """A batch of long posts, some of them empty: memory does not grow with the terms of the batch."""
    import tracemalloc

    import pandas as pd

    rng = np.random.default_rng(3)
    sizes = [0, 4000, 0] + [400] * 2500 + [0]
    rows = pd.DataFrame({"at": [rng.integers(0, 900, n).astype(np.int32) for n in sizes], "w": [rng.random(n) for n in sizes]})
    basis = rng.random((900, 72))
    tracemalloc.start()
    got = embedding._times(rows, basis)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150 << 20
    assert got == pytest.approx(np.stack([w @ basis[a] if len(a) else np.zeros(72) for a, w in zip(rows["at"], rows["w"])]))


def test_soft_assign_of_all_centroids(spark):
    """Against all pairs, with ties, noise and missing values; centroids are multiplied in batches and joined to no row."""
    rng = np.random.default_rng(13)
    x, centers = rng.normal(0, 1, (90, 5)), rng.normal(0, 1, (12, 5))
    x, centers = x / np.linalg.norm(x, axis=1)[:, None], centers / np.linalg.norm(centers, axis=1)[:, None]
    centers[7] = centers[2]  # a tie goes to the smaller cluster
    c = [-1 if i % 9 == 0 else None if i % 10 == 1 else i % 14 for i in range(90)]  # 12 and 13 have no centroid
    rows = spark.createDataFrame([(i, None if i == 5 else [float(a) for a in p], c[i]) for i, p in enumerate(x)], "vec_id long, embedding array<double>, cluster int")
    listed = spark.createDataFrame([(i, [float(a) for a in p]) for i, p in enumerate(centers)], "cluster int, centroid array<double>")
    out = clustering.soft_assign(rows, listed, least=0.7, within=0.1)
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()
    for r in out.collect():
        i, own = r["vec_id"], r["cluster"]
        want = []
        if i != 5 and own not in (None, -1):
            sims = [sum(a * b for a, b in zip(x[i].tolist(), p)) for p in centers.tolist()]
            home = sims[own] if own < 12 else 0.0
            want = [k for _, k in sorted((-s, k) for k, s in enumerate(sims) if k != own and (s >= 0.7 or home - s <= 0.1))][:2]
        assert r["secondary"] == want
    none = clustering.soft_assign(rows, listed.limit(0)).collect()
    assert all(r["secondary"] == [] for r in none)
