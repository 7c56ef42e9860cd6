"""Near points in memory: equal leaves of a k-d tree, of which those near each other are compared in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Distances compared at once.
BLOCK = 1_000_000


class Leaves:
    """Points in leaves of about ``size``, half of it at least; boxes by level, from all points down to the leaves."""

    def __init__(self, x: np.ndarray, y: np.ndarray, size: int):
        n = len(x)
        depth = max(0, int(np.ceil(np.log2(max(n, 1) / size))))
        ends = np.arange(2**depth + 1) * n // 2**depth
        order = np.arange(n)
        for level in range(depth):
            step = 2 ** (depth - level)
            for j in range(0, 2**depth, step):
                a, m, b = ends[j], ends[j + step // 2], ends[j + step]
                part = order[a:b]
                px, py = x[part], y[part]
                v = px if np.ptp(px) >= np.ptp(py) else py
                order[a:b] = part[np.argpartition(v, m - a)]
        sizes = np.diff(ends)
        self.n, self.depth, self.width = n, depth, int(sizes.max())
        # a row of members a leaf and an empty row; n stands for none, and lies at infinity
        self.members = np.full((2**depth + 1, self.width), n)
        self.members[:-1][np.arange(self.width) < sizes[:, None]] = order
        self.x, self.y = np.append(x, np.inf), np.append(y, np.inf)
        box = [f.reduceat(v[order], ends[:-1]) for v in (x, y) for f in (np.minimum, np.maximum)]
        self.boxes = [box]
        for _ in range(depth):
            box = [f(v[::2], v[1::2]) for v, f in zip(box, (np.minimum, np.maximum) * 2)]
            self.boxes.insert(0, box)

    def near(self, radius: np.ndarray, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(leaf, other) with boxes at most the leaf's radius apart, itself among them; in the order of leaf. Two leaves wholly of one group are left out."""
        own = self.boxes[-1]
        q = np.arange(len(own[0]))
        node = np.zeros(len(q), np.int64)
        for level in range(self.depth + 1):
            if level:
                q, node = np.repeat(q, 2), (2 * node[:, None] + (0, 1)).ravel()
            b = self.boxes[level]
            gap = [np.maximum(0, np.maximum(b[i][node] - own[i + 1][q], own[i][q] - b[i + 1][node])) for i in (0, 2)]
            keep = gap[0] ** 2 + gap[1] ** 2 <= (radius[q] * (1 + 1e-9)) ** 2
            q, node = q[keep], node[keep]
        if group is not None:
            inside = self.members[:-1]
            g = group[np.where(inside < self.n, inside, inside[:, :1])]
            one = np.where((g == g[:, :1]).all(1), g[:, 0], -1)
            keep = (one[q] != one[node]) | (one[q] < 0)
            q, node = q[keep], node[keep]
        return q, node

    def blocks(self, radius: np.ndarray, group: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(points, candidates, dx, dy): every point that has candidates once, a leaf a row; ``n`` fills up either, and is never near."""
        q, other = self.near(radius, group)
        counts = np.bincount(q, minlength=len(radius))
        first = np.cumsum(counts) - counts
        by = np.argsort(counts, kind="stable")
        at = int((counts == 0).sum())
        while at < len(by):
            most = max(1, BLOCK // (self.width**2 * int(counts[by[at]])))
            leaf = by[at : at + most]
            while len(leaf) > 1 and len(leaf) * int(counts[leaf[-1]]) * self.width**2 > 2 * BLOCK:
                leaf = leaf[: len(leaf) // 2]
            at += len(leaf)
            m = int(counts[leaf[-1]])
            slot = np.arange(m)
            there = slot < counts[leaf][:, None]
            found = np.where(there, other[np.minimum(first[leaf][:, None] + slot, len(other) - 1)], len(radius))
            p, c = self.members[leaf], self.members[found].reshape(len(leaf), -1)
            px, py = (np.where(p < self.n, v[p], 0.0)[:, :, None] for v in (self.x, self.y))
            yield p, c, self.x[c][:, None, :] - px, self.y[c][:, None, :] - py


def kth_bounds(leaves: Leaves, k: int) -> np.ndarray:
    """For each leaf, a radius within which each of its points has k others: taken from the leaf itself."""
    out = np.zeros(len(leaves.members) - 1)
    step = max(1, BLOCK // leaves.width**2)
    for a in range(0, len(out), step):
        p = leaves.members[a : a + step][:-1] if a + step > len(out) else leaves.members[a : a + step]
        px, py = (np.where(p < leaves.n, v[p], np.nan) for v in (leaves.x, leaves.y))
        d = (px[:, :, None] - px[:, None, :]) ** 2 + (py[:, :, None] - py[:, None, :]) ** 2
        out[a : a + len(p)] = np.sqrt(np.nanmax(np.partition(d, k, 2)[:, :, k], 1))
    return out


def kth_distance(x: np.ndarray, y: np.ndarray, k: int) -> np.ndarray:
    """The distance of each point to its k-th nearest other; k is below the number of points."""
    out = np.empty(len(x) + 1)
    leaves = Leaves(x, y, max(32, 2 * (k + 1)))
    for p, _, dx, dy in leaves.blocks(kth_bounds(leaves, k)):
        d = dx * dx + dy * dy
        out[p] = np.sqrt(np.partition(d, k, 2)[:, :, k])
    return out[:-1]


def lightest_forest(n: int, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the edges of a minimum spanning forest, in the order of their weight (Boruvka's rounds; of equals the earlier), and each point's tree."""
    order = np.argsort(w, kind="stable")
    order = order[a[order] != b[order]]
    a, b, at, took, label = a[order], b[order], np.arange(len(order)), [], np.arange(n)
    while len(a):
        best = np.full(n, len(a))
        ids = np.arange(len(a))[::-1]
        best[a[::-1]] = ids  # the last, that is the lightest, stays
        other = np.full(n, len(a))
        other[b[::-1]] = ids
        best = np.minimum(best, other)
        has = np.flatnonzero(best < len(a))
        e = best[has]
        took.append(at[np.unique(e)])
        parent = np.arange(n)
        parent[has] = np.where(a[e] == has, b[e], a[e])
        pair = (parent[parent] == np.arange(n)) & (np.arange(n) < parent)
        parent[pair] = np.flatnonzero(pair)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
        a, b, label = parent[a], parent[b], parent[label]
        keep = a != b
        a, b, at = a[keep], b[keep], at[keep]
    return order[np.sort(np.concatenate(took))] if took else order[:0], label


def reach_tree(x: np.ndarray, y: np.ndarray, core: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, w) by rising w: a minimum spanning tree of all pairs, w the largest of their distance and both cores.

    Exact without looking at all pairs. Order the points by core. Of the points before a in one of its eight octants only the
    nearest, c, needs an edge: for any other, b, the pairs (a, c) and (c, b) weigh no more and c, b are nearer than a, b. Points at one place
    are linked in a chain, and its first stands for them. The search radius is doubled from that of the densest places. A
    point's octant is closed once such a c, or any c that with its core lies within the radius, is found there:
    longer pairs go by way of c then, so only points with an open octant go on. Edges up to the radius are final, and what they
    join is one group, whose points need no further edges between them. It ends with one group.
    """
    n = len(x)
    rank = np.empty(n, np.int64)
    rank[np.lexsort((np.arange(n), core))] = np.arange(n)
    o = np.lexsort((rank, y, x))
    same = np.r_[False, (x[o][1:] == x[o][:-1]) & (y[o][1:] == y[o][:-1])]
    chain = np.flatnonzero(same)
    a, b, w = o[chain], o[chain - 1], core[o[chain]]
    made: list = []
    left = np.sort(o[~same])
    positive = core[left][core[left] > 0]
    radius = float(np.quantile(positive, 0.01)) if len(positive) else 1.0
    closed, group = np.zeros((n, 8), bool), np.arange(n)
    ranks, cores = np.append(rank, n), np.append(core, np.inf)
    while len(left) > 1 and (group != group[0]).any():
        leaves = Leaves(x[left], y[left], 32)
        ids, best, to, groups = np.append(left, n), np.full(n * 8, np.inf), np.full(n * 8, -1), np.append(group, -1)
        for p, c, dx, dy in leaves.blocks(np.full(len(leaves.members) - 1, radius), group[left]):
            d = dx * dx + dy * dy
            p, c = ids[p], ids[c]
            i, j, k = np.nonzero((d <= radius * radius) & (groups[p][:, :, None] != groups[c][:, None, :]) & (d > 0) & (p < n)[:, :, None])
            ux, uy, d = dx[i, j, k], dy[i, j, k], d[i, j, k]
            p, c = p[i, j], c[i, k]
            key = p * 8 + (ux >= 0) * 4 + (uy >= 0) * 2 + (np.abs(ux) >= np.abs(uy))
            before = ranks[c] < ranks[p]
            closed.ravel()[key[before | (cores[c] <= radius)]] = True
            key, c, d = key[before], c[before], d[before]
            np.minimum.at(best, key, d)
            hit = d == best[key]
            to[key[hit]] = c[hit]
        key = np.flatnonzero(to >= 0)
        p, c = key // 8, to[key]
        a, b, w = np.r_[a, p], np.r_[b, c], np.r_[w, np.maximum(np.sqrt(best[key]), np.maximum(core[p], core[c]))]
        e, _ = lightest_forest(n, group[a], group[b], w)
        a, b, w = a[e], b[e], w[e]
        final = w <= radius
        if final.any():
            made.append((a[final], b[final], w[final]))
            _, label = lightest_forest(n, group[a[final]], group[b[final]], w[final])
            group = label[group]
        a, b, w = a[~final], b[~final], w[~final]
        left = left[~closed[left].all(1)]
        radius *= 1.5
    e, _ = lightest_forest(n, group[a], group[b], w)
    made.append((a[e], b[e], w[e]))
    a, b, w = (np.concatenate(v) for v in zip(*made))
    e = np.argsort(w, kind="stable")
    return a[e], b[e], w[e]
