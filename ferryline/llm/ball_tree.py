"""A ball tree over integer vectors, searched for the largest inner products.

Every node covers its vectors by a ball; ``q . center + |q| * radius`` bounds the inner products
in it from above. Scores are integers: the bound is rounded down after a margin for the
errors of floating point, and a node that can only tie is passed over when all its ids are larger.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEAF = 64
#: Inner products below this are exact in floating point.
EXACT = 2.0**52


@dataclass
class Balls:
    """Balls of one kind each: centers, radii and the least id in each of them."""

    center: np.ndarray
    radius: np.ndarray
    least_id: np.ndarray

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Integers no inner product in the ball exceeds, one row for each query."""
        length = np.sqrt((queries * queries).sum(axis=1))[:, None]
        reach = np.sqrt((self.center * self.center).sum(axis=1)) + self.radius
        rough = queries @ self.center.T + length * self.radius
        return np.floor(rough + 1e-9 * length * reach + 1e-6)

    def open(self, bounds: np.ndarray, kth: np.ndarray, kth_id: np.ndarray) -> np.ndarray:
        """Which balls may hold a vector that comes before the ``kth`` one of each query."""
        tie = (bounds == kth[:, None]) & (self.least_id < kth_id[:, None])
        return (bounds > kth[:, None]) | tie


def ball(vectors: np.ndarray) -> tuple[np.ndarray, float]:
    center = vectors.mean(axis=0)
    far = ((vectors - center) ** 2).sum(axis=1).max() if len(vectors) else 0.0
    return center, float(np.sqrt(far) * (1 + 1e-12))


def halves(vectors: np.ndarray, center: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A direction through two far vectors, and each vector's place along it."""
    one = vectors[((vectors - center) ** 2).sum(axis=1).argmax()]
    two = vectors[((vectors - one) ** 2).sum(axis=1).argmax()]
    return two - one, vectors @ (two - one)


class BallTree:
    """Nodes in level order; leaves are ranges of the reordered vectors."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(vectors))
        as_float = vectors.astype(np.float64)
        spans, parent, inner, centers, radii = [(0, len(order))], [-1], [], [], []
        at = 0
        while at < len(spans):
            low, high = spans[at]
            part = order[low:high]
            center, radius = ball(as_float[part])
            centers.append(center)
            radii.append(radius)
            inner.append(high - low > leaf and radius > 0)
            if inner[-1]:
                _, along = halves(as_float[part], center)
                order[low:high] = part[np.argsort(along, kind="stable")]
                middle = (low + high) // 2
                spans += [(low, middle), (middle, high)]
                parent += [at, at]
            at += 1
        self.spans, self.parent, self.inner = np.array(spans), np.array(parent), np.array(inner)
        self.vectors, self.ids, self.rows = vectors[order], ids[order], rows[order]
        self.balls = Balls(np.array(centers), np.array(radii),
                           np.array([self.ids[low:high].min() for low, high in spans]))
        self.norm = float(np.sqrt((as_float**2).sum(axis=1).max()))

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, kth: np.ndarray,
               kth_id: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(query, score, id)`` of up to ``k`` vectors each that come before the given ``kth`` ones.

        ``own`` is the row that a query must not find. Leaves are scanned from the greatest bound
        on, one for each query, then twice as many, and so on; the rest is judged again after each turn.
        """
        as_float = queries.astype(np.float64)
        bounds = self.balls.bounds(as_float)
        longest = np.sqrt((as_float**2).sum(axis=1).max()) * self.norm
        exact = longest < EXACT
        ours = as_float if exact else queries
        theirs = self.vectors.astype(np.float64) if exact else self.vectors
        kth, kth_id = kth.astype(np.float64 if exact else np.int64).copy(), kth_id.copy()
        open_ = self.balls.open(bounds, kth, kth_id)
        for node in range(1, len(self.parent)):  # a node is open only below open nodes
            open_[:, node] &= open_[:, self.parent[node]]
        leaves = np.flatnonzero(~self.inner)
        waiting = np.where(open_[:, leaves], bounds[:, leaves], -np.inf)
        ranked = np.argsort(-waiting, axis=1, kind="stable")
        best = (np.zeros(0, np.int64), np.zeros(0, kth.dtype), np.zeros(0, np.int64))
        done, width = 0, 1
        while done < len(leaves):
            turn = ranked[:, done:done + width]
            query = np.repeat(np.arange(len(queries)), turn.shape[1])
            pick = turn.ravel()
            alive = (waiting[query, pick] > -np.inf) & self._open(bounds, kth, kth_id, query, leaves[pick])
            query, pick = query[alive], pick[alive]
            if not len(query):
                break  # bounds only get smaller from here
            best = self._scanned(query, leaves[pick], ours, theirs, own, kth, kth_id, best, k)
            done, width = done + width, 2 * width
        return best

    def _open(self, bounds, kth, kth_id, query, node):
        value = bounds[query, node]
        return (value > kth[query]) | (
            (value == kth[query]) & (self.balls.least_id[node] < kth_id[query]))

    def _scanned(self, query, leaf, ours, theirs, own, kth, kth_id, best, k):
        """The best of each query so far and in the given leaves; lowers ``kth`` in place."""
        found = [best]
        by_leaf = np.argsort(leaf, kind="stable")
        query, leaf = query[by_leaf], leaf[by_leaf]
        edges = np.flatnonzero(np.diff(leaf, prepend=-1, append=-1))
        for begin, end in zip(edges[:-1], edges[1:]):
            low, high = self.spans[leaf[begin]]
            who = query[begin:end]
            scores = ours[who] @ theirs[low:high].T
            ids = self.ids[low:high]
            hit = (scores > kth[who][:, None]) | (
                (scores == kth[who][:, None]) & (ids < kth_id[who][:, None]))
            hit &= self.rows[low:high] != own[who][:, None]
            a, b = np.nonzero(hit)
            found.append((who[a], scores[a, b], ids[b]))
        asked, score, ids = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((ids, -score, asked))
        asked, score, ids = asked[order], score[order], ids[order]
        first = np.searchsorted(asked, asked, side="left")
        place = np.arange(len(asked)) - first
        full = place == k - 1
        kth[asked[full]], kth_id[asked[full]] = score[full], ids[full]
        keep = place < k
        return asked[keep], score[keep], ids[keep]
