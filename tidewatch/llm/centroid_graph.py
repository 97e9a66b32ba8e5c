"""Balanced centroids and an in-memory graph that searches them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def balanced_centroids(sample: np.ndarray, lists: int, rounds: int = 12, seed: int = 1) -> np.ndarray:
    """k-means in which a cluster's distance grows with its size, so sizes come near each other."""
    rng = np.random.default_rng(seed)
    lists = min(lists, len(sample))
    centroids = sample[rng.choice(len(sample), lists, replace=False)].copy()
    norms = (sample**2).sum(axis=1)
    even = len(sample) / lists
    size = np.full(lists, even)
    for step in range(rounds):
        near = np.empty(len(sample), np.int64)
        weight = 0.0
        for a in range(0, len(sample), 4096):
            part = sample[a : a + 4096]
            d = norms[a : a + 4096, None] - 2 * part @ centroids.T + (centroids**2).sum(axis=1)
            if not weight:
                weight = float(np.median(d.min(axis=1))) * 0.2
            near[a : a + 4096] = (d + weight * (size / even - 1)).argmin(axis=1)
        count = np.bincount(near, minlength=lists)
        order = np.argsort(near, kind="stable")
        used = np.flatnonzero(count)
        begin = (np.cumsum(count) - count)[used]
        centroids[used] = np.add.reduceat(sample[order], begin) / count[used, None]
        empty = np.flatnonzero(count == 0)
        if len(empty) and step < rounds - 1:
            centroids[empty] = sample[rng.choice(len(sample), len(empty), replace=False)]
        size = 0.5 * size + 0.5 * count
    # A cluster of a few points stands for nothing; its points go to its neighbours.
    kept = centroids[count >= 0.25 * even] if (count >= 0.25 * even).any() else centroids
    return kept.astype(np.float32)


@dataclass
class CentroidGraph:
    """Each centroid's nearest ones and a few at random; searched best first."""

    centroids: np.ndarray
    neighbours: np.ndarray
    entries: np.ndarray

    @classmethod
    def build(cls, centroids: np.ndarray, near: int = 24, far: int = 8, seed: int = 2):
        n = len(centroids)
        rng = np.random.default_rng(seed)
        near = min(near, n - 1) if n > 1 else 0
        square = (centroids**2).sum(axis=1)
        nearest = np.empty((n, near), np.int64)
        for a in range(0, n, 1024):
            d = square - 2 * centroids[a : a + 1024] @ centroids.T
            d[np.arange(len(d)), a + np.arange(len(d))] = np.inf
            nearest[a : a + 1024] = np.argpartition(d, near - 1, axis=1)[:, :near] if near else 0
        links = np.concatenate([nearest, rng.integers(0, n, (n, far))], axis=1)
        entries = rng.choice(n, min(n, 16), replace=False)
        return cls(centroids, links, entries)

    def search(self, points: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest centroids found and their squared distances, in order.

        All points walk the graph together; each expands its best open node until its
        best ``width`` nodes are all expanded.
        """
        n, width = len(self.centroids), min(width, len(self.centroids))
        out_ids = np.empty((len(points), width), np.int64)
        out_d = np.empty((len(points), width), np.float32)
        for a in range(0, len(points), 1024):
            ids, d = self._walk(points[a : a + 1024], n, width)
            out_ids[a : a + 1024], out_d[a : a + 1024] = ids, d
        return out_ids, out_d

    def _walk(self, points: np.ndarray, n: int, width: int):
        rows = np.arange(len(points))
        square = (points**2).sum(axis=1)
        own = (self.centroids**2).sum(axis=1)
        distance = np.full((len(points), n), np.inf, np.float32)
        closed = np.zeros((len(points), n), bool)
        best = np.full((len(points), width), -1, np.int64)

        def visit(who: np.ndarray, nodes: np.ndarray) -> None:
            dots = np.einsum("ij,ikj->ik", points[who], self.centroids[nodes])
            distance[who[:, None], nodes] = square[who, None] + own[nodes] - 2 * dots

        visit(rows, np.tile(self.entries, (len(points), 1)))
        open_rows = rows
        while len(open_rows):
            part = distance[open_rows]
            top = np.argpartition(part, width - 1, axis=1)[:, :width] if width < n else np.tile(
                np.arange(n), (len(open_rows), 1)
            )
            best[open_rows] = top
            value = np.where(
                closed[open_rows[:, None], top], np.inf, np.take_along_axis(part, top, axis=1)
            )
            expand = np.argsort(value, axis=1)[:, :4]
            alive = np.isfinite(np.take_along_axis(value, expand, axis=1))
            going = alive.any(axis=1)
            open_rows, top, expand, alive = open_rows[going], top[going], expand[going], alive[going]
            if not len(open_rows):
                break
            nodes = np.take_along_axis(top, expand, axis=1)
            nodes = np.where(alive, nodes, nodes[:, :1])
            closed[open_rows[:, None], nodes] = True
            visit(open_rows, self.neighbours[nodes].reshape(len(open_rows), -1))
        value = np.take_along_axis(distance, best, axis=1)
        order = np.argsort(value, axis=1, kind="stable")
        return np.take_along_axis(best, order, axis=1), np.take_along_axis(value, order, axis=1)
