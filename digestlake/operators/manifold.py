"""Manifold reduction: a fuzzy graph of nearest neighbours, laid out in few dimensions by sampled descent (McInnes, Healy and Melville 2018).

Neighbours are exact (neighbours.nearest), by cosine distance. Weights are found for each point by itself and joined over both directions. The layout starts from principal components and goes
on in rounds (one, where there is one block): in each, every block of points takes several epochs by itself, its neighbours in other blocks standing still, and repels its own points and a bounded sample of all. Then positions
are written and exchanged. A block holds its points' own neighbours and no other edges, so a point that is near to very many is no burden to its block. Random numbers come from the seed, the round and the block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestlake.functions import vectors as V
from digestlake.sources.tables import written

from . import neighbours

NEGATIVES, SAMPLE, CLIP, PARTS = 5, 1024, 4.0, 8


def curve(min_dist: float, spread: float = 1.0) -> tuple[float, float]:
    """(a, b) with 1 / (1 + a x^2b) nearest to 1 up to min_dist and exp(-(x - min_dist) / spread) from there, by Gauss and Newton."""
    x = np.linspace(0, 3 * spread, 301)[1:]
    y = np.where(x < min_dist, 1.0, np.exp(-(x - min_dist) / spread))
    p = np.array([0.0, 0.0])  # logarithms of a and b
    error = lambda p: 1 / (1 + np.exp(p[0]) * x ** (2 * np.exp(p[1]))) - y
    damp = 1e-3
    for _ in range(200):
        a, b = np.exp(p)
        f = 1 / (1 + a * x ** (2 * b))
        slope = np.stack([-f * f * a * x ** (2 * b), -f * f * a * x ** (2 * b) * 2 * b * np.log(x)], axis=1)
        step = np.linalg.solve(slope.T @ slope + damp * np.eye(2), -slope.T @ error(p))
        if (error(p + step) ** 2).sum() < (error(p) ** 2).sum():
            p, damp = p + step, damp / 3
        else:
            damp *= 4
        if np.abs(step).max() < 1e-10:
            break
    return float(np.exp(p[0])), float(np.exp(p[1]))


def memberships(d: np.ndarray, k: int) -> np.ndarray:
    """Weights of neighbours at distances d (a row for each point, rising): 1 for the nearest, with a sum of log2(k), by bisection of the scale."""
    nearest = np.where(d > 0, d, np.inf).min(axis=1)
    gap = np.maximum(d - np.where(np.isfinite(nearest), nearest, 0)[:, None], 0)
    low, high, scale = np.zeros(len(d)), np.full(len(d), np.inf), np.ones(len(d))
    for _ in range(64):
        much = np.exp(-gap / scale[:, None]).sum(axis=1) > np.log2(k)
        high, low = np.where(much, scale, high), np.where(much, low, scale)
        scale = np.where(np.isinf(high), scale * 2, (low + high) / 2)
    # no scale is much below the mean distance
    scale = np.maximum(scale, 1e-3 * np.maximum(d.mean(axis=1), 1e-12))
    return np.exp(-gap / scale[:, None])


def graph(near: DataFrame, k: int) -> DataFrame:
    """(i, j, w) over each point's own neighbours (i, near array<struct<d, j>>, the point itself among them): the fuzzy union of both directions, doubled where only one of the two lists the other."""

    def weigh(frames):
        for frame in frames:
            i, sizes = frame["i"].to_numpy(), frame["j"].map(len).to_numpy()
            for size in np.unique(sizes[sizes > 0]):
                rows = np.flatnonzero(sizes == size)
                d, j = np.stack(frame["d"].iloc[rows].to_numpy()), np.stack(frame["j"].iloc[rows].to_numpy())
                yield pd.DataFrame({"i": np.repeat(i[rows], size), "j": j.ravel(), "p": memberships(d * d / 2, k).ravel()})

    others = F.filter("near", lambda s: s["j"] != F.col("i"))
    near = near.select("i", others.alias("near")).select("i", F.col("near.d").alias("d"), F.col("near.j").alias("j"))
    one = written(near.mapInPandas(weigh, "i long, j long, p double"), "members")
    back = one.select(F.col("j").alias("i"), F.col("i").alias("j"), F.col("p").alias("q"))
    both = one.join(back, ["i", "j"], "left")
    w = F.when(F.col("q").isNull(), 2 * F.col("p")).otherwise(F.col("p") + F.col("q") - F.col("p") * F.col("q"))
    return both.select("i", "j", w.alias("w"))


def _descend(y: np.ndarray, head: np.ndarray, tail: np.ndarray, w: np.ndarray, n_own: int, far: np.ndarray, share: float, epochs: range, of: int, a: float, b: float, rng: np.random.Generator) -> np.ndarray:
    """Positions y after some epochs: the first n_own rows move, along sampled edges and away from sampled points, of which a share are far ones."""
    y = y.copy()
    share = share if len(far) else 0.0
    chance = np.minimum(w, 1.0)
    twice = np.maximum(w, 1.0)

    def move(at: np.ndarray, grad: np.ndarray, rate: float) -> None:
        own = at < n_own
        for c in range(y.shape[1]):
            y[:n_own, c] += rate * np.bincount(at[own], grad[own, c], n_own)

    for epoch in epochs:
        rate = 1.0 - epoch / of
        chosen = np.flatnonzero(rng.random(len(w)) < chance)
        rng.shuffle(chosen)
        for part in np.array_split(chosen, PARTS):
            if not len(part):
                continue
            h, t = head[part], tail[part]
            gap = y[h] - y[t]
            square = (gap * gap).sum(axis=1)
            with np.errstate(divide="ignore", invalid="ignore"):
                pull = np.where(square > 0, -2 * a * b * square ** (b - 1) / (1 + a * square**b), 0)
            grad = np.clip((pull * twice[part])[:, None] * gap, -CLIP, CLIP)
            move(h, grad, rate)
            move(t, -grad, rate)
            h = np.repeat(h, NEGATIVES)
            pool = rng.integers(0, n_own, len(h))
            other = y[pool]
            away = rng.random(len(h)) < share
            if away.any():
                other[away] = far[rng.integers(0, len(far), int(away.sum()))]
            pool[away] = -1
            gap = y[h] - other
            square = (gap * gap).sum(axis=1)
            push = 2 * b / ((0.001 + square) * (1 + a * square**b))
            push[pool == h] = 0
            move(h, np.clip(push[:, None] * gap, -CLIP, CLIP), rate)
    return y[:n_own]


def layout(edges: DataFrame, start: DataFrame, blocks: DataFrame, n: int, dims: int, min_dist: float, epochs: int, rounds: int, seed: int) -> DataFrame:
    """(i, y) of points (i, y) moved along edges (i, j, w), in the blocks (i, b). Positions are written after each round."""
    a, b = curve(min_dist)

    def round_of(r: int, part: range, far: np.ndarray, far_b: np.ndarray):
        def run(frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values(["i", "j"], ignore_index=True)
            own = frame.drop_duplicates("i")
            i = own["i"].to_numpy()
            other = frame.loc[~frame["j"].isin(i)].drop_duplicates("j")
            names = np.concatenate([i, other["j"].to_numpy()])
            y = np.concatenate([np.stack(own["y"])] + ([np.stack(other["z"])] if len(other) else []))
            place = pd.Series(np.arange(len(names)), names)
            block = int(frame["b"].iloc[0])
            rng = np.random.default_rng([seed, r, block])
            moved = _descend(y, place[frame["i"]].to_numpy(), place[frame["j"]].to_numpy(), frame["w"].to_numpy(), len(i), far[far_b != block], 1 - len(i) / n, part, epochs, a, b, rng)
            return pd.DataFrame({"i": i, "y": list(moved)})

        return run

    joined = written(edges.join(blocks, "i"), "layout-edges")
    ends = [epochs * r // rounds for r in range(rounds + 1)]
    now = written(start, "positions")
    for r in range(rounds):
        # a bounded sample of all positions, another one in each round
        some = now.join(blocks, "i").orderBy(F.xxhash64("i", F.lit(seed + r)), "i").limit(SAMPLE).collect()
        far, far_b = np.array([x["y"] for x in some], float).reshape(-1, dims), np.array([x["b"] for x in some])
        placed = joined.join(now, "i").join(now.select(F.col("i").alias("j"), F.col("y").alias("z")), "j")
        moved = placed.groupBy("b").applyInPandas(round_of(r, range(ends[r], ends[r + 1]), far, far_b), "i long, y array<double>")
        # points without neighbours stay where they are
        now = written(now.withColumnRenamed("y", "was").join(moved, "i", "left").select("i", F.coalesce("y", "was").alias("y")), "positions")
    return now


def reduced(rows: DataFrame, start: DataFrame, n: int, dims: int = 10, k: int = 15, min_dist: float = 0.0, seed: int = 42, epochs: int = 200, rounds: int = 8, block: int = 2000) -> DataFrame:
    """(i, y) of rows (i, v), numbered 0 .. n - 1: their manifold in dims dimensions, laid out from the positions start (i, y)."""
    if n < 2:
        return start
    g = neighbours.grid(rows.select("i", V.unit(F.col("v")).alias("v")), n, block)
    near, _ = neighbours.nearest(g, min(k, n))
    edges = graph(near, min(k, n))
    width = start.agg(F.max(F.array_max(F.transform("y", lambda c: F.abs(c))))).first()[0] or 1.0
    return layout(edges, start.select("i", F.transform("y", lambda c: c * (10.0 / width)).alias("y")), g.points.select("i", "b"), n, dims, min_dist, epochs, rounds if g.n_blocks > 1 else 1, seed)
