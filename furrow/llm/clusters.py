"""Similarity clusters: hashed weighted features, a tree of distributed k-means, exact links inside and across cells."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.operators.graph import components, contract
from furrow.session import drop_staged, stage

#: Entries of a block of the distance matrix, which bounds a worker's memory.
BLOCK = 1_000_000


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit integer hash (the finaliser of SplitMix64)."""
    z = np.asarray(x).astype(np.uint64)
    with np.errstate(over="ignore"):
        z = z + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


@dataclass(frozen=True)
class Features:
    """What a record's vector is made of.

    numeric: column -> weight; each has a dimension of its own, centred on ``centre``.
    category: column (integers) -> weight; a value is hashed to one of ``buckets`` dimensions with
    a hashed sign. Two records with equal categories differ only in the numeric dimensions, so
    their distance there is the weighted Euclidean distance, whatever collides.
    A null, NaN or infinite number adds nothing; a null category is a category of its own.
    """

    numeric: dict[str, float]
    category: dict[str, float] = field(default_factory=dict)
    buckets: int = 8
    centre: dict[str, float] = field(default_factory=dict)

    @property
    def dims(self) -> int:
        return len(self.numeric) + self.buckets * bool(self.category)

    def vectors(self, pdf: pd.DataFrame) -> np.ndarray:
        out = np.zeros((len(pdf), self.dims))
        for j, (c, w) in enumerate(self.numeric.items()):
            x = pdf[c].to_numpy(dtype=float, na_value=np.nan) - self.centre.get(c, 0.0)
            out[:, j] = np.where(np.isfinite(x), x * w, 0.0)
        rows = np.arange(len(pdf))
        for n, (c, w) in enumerate(self.category.items()):
            v = pdf[c].to_numpy(dtype=float, na_value=np.nan)
            code = np.where(np.isfinite(v), v, -(2.0**53)).astype(np.int64).astype(np.uint64)
            h = mix64(mix64(code) + np.uint64(n))
            sign = np.where((h >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)
            out[rows, len(self.numeric) + (h % np.uint64(self.buckets)).astype(int)] += w * sign
        return out


def squared_distances(x: np.ndarray, c: np.ndarray):
    """Blocks (from, to, squared distances of x[from:to] to every row of c)."""
    cc = (c * c).sum(1)
    step = max(1, BLOCK // max(1, len(c)))
    for a in range(0, len(x), step):
        b = x[a : a + step]
        yield a, a + len(b), np.maximum((b * b).sum(1)[:, None] - 2 * (b @ c.T) + cc, 0)


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest row of c; ties go to the lower index."""
    idx, d2 = np.zeros(len(x), dtype=np.int64), np.zeros(len(x))
    for a, b, d in squared_distances(x, c):
        idx[a:b] = d.argmin(1)
        d2[a:b] = d[np.arange(b - a), idx[a:b]]
    return idx, d2


def weighted_seeding(x: np.ndarray, w: np.ndarray, k: int, seed: int, steps: int = 5) -> np.ndarray:
    """k-means++ over weighted points, then weighted Lloyd steps, in memory; at most k centroids."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.choice(len(x), p=w / w.sum()))]
    d2 = ((x - x[chosen[0]]) ** 2).sum(1)
    while len(chosen) < k and (p := w * d2).sum() > 0:
        chosen.append(int(rng.choice(len(x), p=p / p.sum())))
        d2 = np.minimum(d2, ((x - x[chosen[-1]]) ** 2).sum(1))
    c = x[chosen]
    for _ in range(steps):
        idx, _ = nearest(x, c)
        m = np.bincount(idx, weights=w, minlength=len(c))
        c = np.stack([np.bincount(idx, weights=w * x[:, j], minlength=len(c)) for j in range(x.shape[1])], 1)[m > 0] / m[m > 0, None]
    return c


class Tree:
    """Centroids in levels: a node has at most ``branch`` children, so a row is compared with branch * depth of them.

    A leaf is a cell; ``rows`` counts what each cell holds. The tree has about 2 * rows / leaf_rows centroids, which
    is what every task gets: ``size`` numbers, and fit_tree refuses to grow it beyond ``most_numbers``.
    """

    def __init__(self, features: Features, rows: int):
        self.features, self.centroids, self.first = features, [], []  # by inner node: centroids, and the cell of the first child
        self.inner, self.rows, self.centre = [-1], np.array([rows], dtype=np.int64), [np.zeros(features.dims)]  # by cell

    @property
    def size(self) -> int:
        return sum(c.size for c in self.centroids)

    def leaves(self) -> np.ndarray:
        return np.flatnonzero(np.array(self.inner) < 0)

    def split(self, cell: int, centroids: np.ndarray, rows: np.ndarray) -> None:
        self.inner[cell] = len(self.centroids)
        self.centroids.append(centroids)
        self.first.append(len(self.inner))
        self.inner += [-1] * len(centroids)
        self.centre += list(centroids)
        self.rows = np.r_[self.rows, rows.astype(np.int64)]

    def locate(self, x: np.ndarray, margin: float | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, cell, home): the leaf of each row, by the nearest child at each level.

        With a margin every child that is at most ``margin`` farther than the nearest is followed too; home marks the row's own leaf.
        """
        row, cell, home = np.arange(len(x)), np.zeros(len(x), np.int64), np.ones(len(x), bool)
        inner, done = np.array(self.inner), []
        while len(row):
            leaf = inner[cell] < 0
            done.append((row[leaf], cell[leaf], home[leaf]))
            row, cell, home = row[~leaf], cell[~leaf], home[~leaf]
            order = np.argsort(cell, kind="stable")
            row, cell, home = row[order], cell[order], home[order]
            cut = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.empty(0, np.int64)
            nxt = []
            for a, b in zip(cut, np.r_[cut[1:], len(cell)]):
                node = inner[cell[a]]
                c, start = self.centroids[node], self.first[node]
                for lo, hi, d2 in squared_distances(x[row[a:b]], c):
                    r, h, own = row[a + lo : a + hi], home[a + lo : a + hi], d2.argmin(1)
                    if margin is None:
                        nxt.append((r, start + own, h))
                    else:
                        d = np.sqrt(d2)
                        i, j = np.nonzero(d <= d[np.arange(len(d)), own][:, None] + margin)
                        nxt.append((r[i], start + j, h[i] & (j == own[i])))
            row, cell, home = (np.concatenate(z) for z in zip(*nxt)) if nxt else (row, cell, home)
        return tuple(np.concatenate(z) for z in zip(*done)) if done else (row, cell, home)

    def cells(self, x: np.ndarray) -> np.ndarray:
        row, cell, _ = self.locate(x)
        out = np.empty(len(x), np.int64)
        out[row] = cell
        return out


def weighted_points(df: DataFrame, features: Features, resolution: dict[str, float]) -> DataFrame:
    """The rows pre-aggregated before any pass of k-means: one point, their mean, and its weight ``_w``, for all rows
    of equal categories and equal squares of the resolution. All rows count; a spot with a third of them is one point."""
    safe = {c: F.when(F.abs(F.col(c).cast("double")) < float("inf"), F.col(c).cast("double")) for c in features.numeric}
    keys = [F.floor(x / F.lit(resolution[c])).alias(f"_b{i}") for i, (c, x) in enumerate(safe.items())]
    return df.groupBy(*features.category, *keys).agg(F.count(F.lit(1)).alias("_w"), *[F.avg(x).alias(c) for c, x in safe.items()]).drop(*[f"_b{i}" for i in range(len(keys))])


def fit_tree(df: DataFrame, features: Features, resolution: dict[str, float], leaf_rows: int = 100_000, branch: int = 32, rounds: int = 2, iterations: int = 3, seed: int = 7, most_numbers: int = 50_000_000) -> Tree:
    """Distributed k-means in levels over all rows of ``df``, each level seeded in parallel by oversampling (k-means||).

    Every cell of more than ``leaf_rows`` rows is split into k = min(branch, 2 * rows / leaf_rows) cells, all cells of
    a level at once: ``rounds`` draws take each point with probability k * w * d^2 / (the cell's sum of w * d^2), the
    drawn points are weighted by the rows nearest to them and reduced to k by weighted k-means++ on the driver, and
    ``iterations`` Lloyd steps follow. So the cost a row is that of branch * depth distances, at any size.
    The passes read weighted_points, in which all rows count. A draw is a hash of the point, so a rerun of
    a task takes the same. Cells whose points are all at one place stay whole. No rows: one empty cell.
    """
    columns = [*features.numeric, *features.category]
    points = stage(weighted_points(df.select(*columns), features, resolution), "points")
    first = points.agg(F.sum("_w").alias("n"), *[((F.min(c) + F.max(c)) / 2).alias(c) for c in features.numeric]).first()
    features = Features(features.numeric, features.category, features.buckets, {c: first[c] or 0.0 for c in features.numeric})
    tree = Tree(features, first["n"] or 0)
    d = features.dims
    names = [f"v{j}" for j in range(d)]
    schema = ", ".join(f"{x} double" for x in names)

    def by_cell(it, open_: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for pdf in it:
            x = features.vectors(pdf)
            cell, w = tree.cells(x), pdf["_w"].to_numpy(dtype=float)
            for c in np.intersect1d(cell, open_):
                at = cell == c
                yield int(c), x[at], w[at]

    def cost(candidates: dict[int, np.ndarray]) -> dict[int, float]:
        open_ = np.array(list(candidates))

        def f(it):
            total: dict[int, float] = {}
            for c, x, w in by_cell(it, open_):
                total[c] = total.get(c, 0.0) + float((w * nearest(x, candidates[c])[1]).sum())
            yield pd.DataFrame({"cell": list(total), "d2": list(total.values())}).astype({"cell": "int64", "d2": "float64"})

        return {r["cell"]: r["d2"] for r in points.mapInPandas(f, "cell long, d2 double").groupBy("cell").agg(F.sum("d2").alias("d2")).collect()}

    def draw(candidates: dict[int, np.ndarray], phi: dict[int, float], k: dict[int, int], no: int) -> dict[int, np.ndarray]:
        open_ = np.array(list(candidates))

        def f(it):
            for c, x, w in by_cell(it, open_):
                h = np.full(len(x), seed * 1000 + no, dtype=np.uint64)
                for col in np.ascontiguousarray(x).view(np.uint64).T:
                    h = mix64(h ^ col)
                u = (h >> np.uint64(11)).astype(float) / 2.0**53
                took = x[u * phi[c] < k[c] * w * nearest(x, candidates[c])[1]]
                yield pd.DataFrame(took, columns=names).assign(cell=c)[["cell", *names]]

        got = points.mapInPandas(f, f"cell long, {schema}").distinct().toPandas().sort_values(["cell", *names])
        return {int(c): np.concatenate([candidates[int(c)], g[names].to_numpy()]) for c, g in got.groupby("cell")} if len(got) else {}

    def sums(centres: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        open_ = np.array(list(centres))

        def f(it):
            s, w_ = {c: np.zeros(m.shape) for c, m in centres.items()}, {c: np.zeros(len(m)) for c, m in centres.items()}
            for c, x, w in by_cell(it, open_):
                idx, _ = nearest(x, centres[c])
                w_[c] += np.bincount(idx, weights=w, minlength=len(w_[c]))
                for j in range(d):
                    s[c][:, j] += np.bincount(idx, weights=w * x[:, j], minlength=len(w_[c]))
            for c in centres:
                keep = np.flatnonzero(w_[c])
                yield pd.DataFrame({"cell": c, "i": keep, "w": w_[c][keep], **{names[j]: s[c][keep, j] for j in range(d)}})

        got = points.mapInPandas(f, f"cell long, i long, w double, {schema}").groupBy("cell", "i").agg(F.sum("w").alias("w"), *[F.sum(x).alias(x) for x in names])
        out = {}
        for c, g in got.toPandas().sort_values(["cell", "i"]).groupby("cell"):
            w = g["w"].to_numpy()
            out[int(c)] = g[names].to_numpy() / w[:, None], w, g["i"].to_numpy()
        return out

    whole: set[int] = set()
    while todo := [int(c) for c in tree.leaves() if tree.rows[c] > leaf_rows and c not in whole]:
        k = {c: int(min(branch, -(-2 * tree.rows[c] // leaf_rows))) for c in todo}
        if tree.size + sum(k.values()) * d > most_numbers:
            raise ValueError("the tree of centroids would outgrow what can be sent to every task: raise leaf_rows")
        candidates = {c: tree.centre[c][None, :] for c in todo}
        for no in range(rounds):
            phi = cost(candidates)
            candidates |= draw({c: candidates[c] for c in todo if phi.get(c, 0.0) > 0}, phi, k, no) if any(v > 0 for v in phi.values()) else {}
        weights = sums(candidates)
        centres = {c: weighted_seeding(m, w, k[c], seed) for c, (m, w, _) in weights.items() if len(m) > 1}
        for _ in range(iterations - 1):
            centres = {c: m for c, (m, _, _) in sums(centres).items()} if centres else {}
        last = sums(centres) if centres else {}  # only counts what the final centroids hold
        for c in todo:
            if c in last and len(last[c][1]) > 1:
                tree.split(c, centres[c][last[c][2]], last[c][1])
            else:
                whole.add(c)
    drop_staged(points)
    return tree


def _local_clusters(x: np.ndarray, target: int, branch: int, seed: int) -> np.ndarray:
    """A cluster number for each row: k-means splits of at most ``branch`` parts until a part has at most ``target`` rows or one place."""
    label, todo, made = np.zeros(len(x), np.int64), [np.arange(len(x))], 0
    while todo:
        at = todo.pop()
        k = int(min(branch, -(-len(at) // target)))
        idx = np.zeros(len(at), np.int64)
        if k > 1:
            sample = at if len(at) <= 64 * k else at[np.argsort(mix64(at.astype(np.uint64)), kind="stable")[: 64 * k]]  # seeds; every row is then assigned
            c = weighted_seeding(x[sample], np.ones(len(sample)), k, seed, 2)
            idx, _ = nearest(x[at], c)
        parts = [at[idx == i] for i in np.unique(idx)]
        if len(parts) == 1:
            label[at] = made
            made += 1
        else:
            todo += parts
    return label


def similarity_clusters(df: DataFrame, id_col: str, tree: Tree, target: int = 50, members: int = 3, branch: int = 16, leaf_rows: int = 100_000) -> DataFrame:
    """(cluster, size, members, spread): clusters of about ``target`` mutually similar rows, with the ids nearest to each centroid.

    Rows meet by the tree's cell and are clustered inside it; a cell that holds more than ``leaf_rows`` (many rows at one place) is
    dealt by a hash of the id to as many tasks as it needs, whose clusters stand side by side. Ties in distance go to the
    smaller id, which compares as text. spread is the root mean square distance to the centroid. Rows with a null id
    count in the size and are never named; missing numbers and categories count as Features says.
    """
    f = tree.features
    columns = list(dict.fromkeys([*f.numeric, *f.category]))
    parts = np.maximum(1, -(-tree.rows // leaf_rows))

    def place(it):
        for pdf in it:
            cell = tree.cells(f.vectors(pdf))
            yield pdf.assign(_cell=cell, _part=pdf["_h"].to_numpy() % parts[cell]).drop(columns="_h")

    def cluster(key, pdf):
        pdf = pdf.sort_values([*columns, "_id"], kind="stable", na_position="last").reset_index(drop=True)
        x = f.vectors(pdf)
        lab = _local_clusters(x, target, branch, 7)
        n = np.bincount(lab)
        c = np.stack([np.bincount(lab, weights=x[:, j]) for j in range(x.shape[1])], 1) / n[:, None]
        d2 = ((x - c[lab]) ** 2).sum(1)
        near = pd.DataFrame({"lab": lab, "d2": np.round(d2, 6), "id": pdf["_id"]}).dropna(subset=["id"]).sort_values(["lab", "d2", "id"], kind="stable").groupby("lab")["id"].apply(lambda g: list(g.head(members)))
        names = [near.get(i, []) for i in range(len(n))]
        return pd.DataFrame({"cluster": [f"{key[0]}-{key[1]}-{i}" for i in range(len(n))], "size": n, "members": names, "spread": np.sqrt(np.bincount(lab, weights=d2) / n)})

    rows = df.select(F.col(id_col).cast("string").alias("_id"), *columns)
    rows = rows.withColumn("_h", F.pmod(F.xxhash64("_id"), F.lit(1 << 40)))
    kinds = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in rows.drop("_h").schema.fields)
    return rows.mapInPandas(place, f"{kinds}, _cell long, _part long").groupBy("_cell", "_part").applyInPandas(cluster, "cluster string, size long, members array<string>, spread double")


def typical_members(df: DataFrame, cluster: str, id_col: str, x_col: str, y_col: str, keep: list[str], members: int = 3) -> DataFrame:
    """(cluster, keep..., size, cx, cy, typical_1, ...): each cluster's size, centroid and the ids of its rows nearest to the centroid.

    Sizes and means combine before the shuffle; each task then keeps the nearest few rows a cluster, streaming, so a cluster of any
    size sends a few rows a task. Ties in distance (rounded to micrometres) go to the smaller id. ``keep`` columns
    must be equal within a cluster; missing members are null.
    """
    rows = df.select(F.col(cluster).alias("cluster"), F.col(id_col).alias("id"), F.col(x_col).alias("x"), F.col(y_col).alias("y"), *keep)
    centre = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.avg("x").alias("cx"), F.avg("y").alias("cy"), *[F.min(c).alias(c) for c in keep])
    centre = stage(centre, "centres")
    dx, dy = F.col("x") - F.col("cx"), F.col("y") - F.col("cy")
    far = rows.select("cluster", "id", "x", "y").join(centre.select("cluster", "cx", "cy"), "cluster").select("cluster", F.round(F.sqrt(dx * dx + dy * dy), 6).alias("d"), "id")

    def nearest_rows(it):
        held = None
        for pdf in it:
            both = pdf if held is None else pd.concat([held, pdf])
            held = both.sort_values(["cluster", "d", "id"], kind="stable").groupby("cluster", sort=False).head(members)
            if len(held) > 500_000:  # many small clusters: pass them on, the aggregate meets them again
                yield held
                held = None
        if held is not None:
            yield held

    few = far.mapInPandas(nearest_rows, far.schema)
    best = F.slice(F.array_sort(F.collect_list(F.struct("d", "id"))), 1, members)  # at most ``members`` rows a cluster and flush
    named = few.groupBy("cluster").agg(best.getField("id").alias("m"))
    return centre.join(named, "cluster").select("cluster", *keep, "size", "cx", "cy", *[F.get("m", F.lit(i)).alias(f"typical_{i + 1}") for i in range(members)])


def close_pairs(code: np.ndarray, x: np.ndarray, y: np.ndarray, radius: float):
    """Blocks of index pairs (i, j) with equal code at most ``radius`` apart, each pair once.

    Points are sorted by squares of side ``radius``; a square meets itself and four of its
    neighbours, found by binary search.
    """
    if not len(x):
        return
    side = radius * (1 + 1e-6)
    ix, iy = np.floor((x - x.min()) / side).astype(np.int64), np.floor((y - y.min()) / side).astype(np.int64) + 1
    ny = iy.max() + 2
    nx = ix.max() + 2
    key = (code.astype(np.int64) * nx + ix) * ny + iy
    order = np.argsort(key, kind="stable")
    key = key[order]
    x, y = x[order], y[order]
    here = np.arange(len(x))
    for step in (0, 1, ny - 1, ny, ny + 1):
        lo = here + 1 if step == 0 else np.searchsorted(key, key + step, "left")
        hi = np.searchsorted(key, key + step, "right")
        count = np.maximum(hi - lo, 0)
        edges = np.concatenate([[0], np.cumsum(count)])
        a = 0
        while a < len(x):
            b = max(a + 1, int(np.searchsorted(edges, edges[a] + BLOCK, "right")) - 1)
            c = count[a:b]
            i = np.repeat(here[a:b], c)
            j = np.arange(len(i)) - np.repeat(edges[a:b] - edges[a], c) + np.repeat(lo[a:b], c)
            near = np.sqrt((x[i] - x[j]) ** 2 + (y[i] - y[j]) ** 2) <= radius
            yield order[i[near]], order[j[near]]
            a = b


def link_rows(pdf: pd.DataFrame, radius: float) -> pd.DataFrame:
    """Label each row of a cell by the smallest id of its component. Columns: id, code, x, y, home, shared."""
    pdf = pdf.sort_values(["id", "home"], ascending=[True, False], kind="stable").drop_duplicates("id")
    code = pd.factorize(pdf["code"])[0]
    spot, spot_of = np.unique(np.stack([code.astype(float), pdf["x"].to_numpy(), pdf["y"].to_numpy()], 1), axis=0, return_inverse=True)
    spot_of = spot_of.ravel()
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i, j in close_pairs(spot[:, 0], spot[:, 1], spot[:, 2], radius):
        a.append(i)
        b.append(j)
    comp = components(np.concatenate(a), np.concatenate(b), len(spot))[spot_of]
    first = np.full(len(spot), len(pdf))
    np.minimum.at(first, comp, np.arange(len(pdf)))
    ids = pdf["id"].to_numpy()
    return pd.DataFrame({"id": ids, "home": pdf["home"].to_numpy(), "shared": pdf["shared"].to_numpy(), "label": ids[first[comp]]})


def _squares(x: np.ndarray, y: np.ndarray, side: float, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, sx, sy, home) for each square of the grid that the radius around a point meets."""
    own = np.floor(x / side).astype(np.int64), np.floor(y / side).astype(np.int64)
    out = [(np.arange(len(x)), own[0], own[1], np.ones(len(x), bool))]
    for i in (-1, 0, 1):
        for j in (-1, 0, 1):
            if i or j:
                sx, sy = np.floor((x + i * radius) / side).astype(np.int64), np.floor((y + j * radius) / side).astype(np.int64)
                at = np.flatnonzero(((sx != own[0]) == bool(i)) & ((sy != own[1]) == bool(j)))
                out.append((at, sx[at], sy[at], np.zeros(len(at), bool)))
    return tuple(np.concatenate(z) for z in zip(*out))


def linked_patches(df: DataFrame, id_col: str, x_col: str, y_col: str, group_col: str, radius: float, least: int, tree: Tree, max_cell_rows: int = 200_000) -> DataFrame:
    """(patch, id): every member of each patch of at least ``least`` records, named by its smallest id.

    Two records link if their group is equal and they are at most ``radius`` apart; a patch is
    what is linked directly or through others. The k-means cells of ``tree`` (whose features must be these x, y with
    weight 1 and the group) are the candidate clusters: a record goes to its own cell and to each that it would reach by children at
    most 2 * radius farther than the nearest. By the triangle inequality both ends of a link then
    meet in a cell, so no link is lost. Cells link locally; labels that share a record are joined by star contraction.

    A cell of more than ``max_cell_rows`` rows, by its own count, is cut into squares along x and y that overlap by the radius, and
    records at one place in it become one before they are shuffled. A square that still has too many places is dealt to
    parts that meet in pairs. So no task sees more than about 2 * max_cell_rows records, and no link is lost.

    Rows with the same id are repeats of one row and count once. Rows with a null id, a null or non-finite x or y or a null group belong to no patch.
    """
    f = tree.features
    base = df.select(F.col(id_col).cast("string").alias("id"), F.col(x_col).cast("double").alias(x_col), F.col(y_col).cast("double").alias(y_col), group_col)
    base = base.where(F.col("id").isNotNull() & (F.abs(x_col) < float("inf")) & (F.abs(y_col) < float("inf")) & F.col(group_col).isNotNull())
    hot = np.array([c for c in tree.leaves() if tree.rows[c] > max_cell_rows], dtype=np.int64)
    side = 4 * radius

    def assign(it):
        for pdf in it:
            r, c, h = tree.locate(f.vectors(pdf), 2 * radius + 1e-6)
            x, y = pdf[x_col].to_numpy(), pdf[y_col].to_numpy()
            sx, sy = np.zeros(len(r), np.int64), np.zeros(len(r), np.int64)
            if len(hot) and (at := np.isin(c, hot)).any():
                i, qx, qy, own = _squares(x[r[at]], y[r[at]], side, radius + 1e-6)
                cold = ~at
                r, c, h, sx, sy = (np.concatenate(z) for z in ((r[cold], r[at][i]), (c[cold], c[at][i]), (h[cold], h[at][i] & own), (sx[cold], qx), (sy[cold], qy)))
            shared = np.bincount(r, minlength=len(pdf))[r] > 1
            yield pd.DataFrame({"id": pdf["id"].to_numpy()[r], "code": pdf[group_col].to_numpy()[r], "x": x[r], "y": y[r], "cell": c, "sx": sx, "sy": sy, "home": h, "shared": shared})

    kind = df.schema[group_col].dataType.simpleString()
    cells = base.mapInPandas(assign, f"id string, code {kind}, x double, y double, cell long, sx long, sy long, home boolean, shared boolean")
    linked_schema = "id string, home boolean, shared boolean, label string"
    link = lambda pdf: link_rows(pdf, radius)
    copies = None
    if not len(hot):
        linked = stage(cells.groupBy("cell").applyInPandas(link, linked_schema), "linked")
    else:
        cells = stage(cells, "cells")
        is_hot = F.col("cell").isin(*hot.tolist())
        where = ["cell", "sx", "sy"]
        spots = stage(cells.where(is_hot).groupBy("code", "x", "y", *where).agg(F.min("id").alias("id"), F.max("home").alias("home"), F.max("shared").alias("shared")), "spots")
        crowd = spots.groupBy(*where).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_cell_rows).withColumn("parts", F.ceil(F.col("n") / max_cell_rows)).drop("n")
        dealt = spots.join(crowd, where, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        dealt = dealt.withColumn("_p", F.pmod(F.xxhash64("id"), "parts")).withColumn("_q", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
        dealt = dealt.withColumns({"lo": F.least("_p", "_q"), "hi": F.greatest("_p", "_q"), "home": F.col("home") & (F.col("_p") == F.col("_q")), "shared": F.col("shared") | (F.col("parts") > 1)})
        many = dealt.groupBy(*where, "lo", "hi").applyInPandas(link, linked_schema)
        linked = stage(cells.where(~is_hot).groupBy("cell").applyInPandas(link, linked_schema).unionByName(many), "linked")
        # the other records of a place follow the one that stood for them
        stood = spots.where("home").select("code", "x", "y", F.col("id").alias("rep"))
        copies = cells.where(is_hot & F.col("home")).join(stood, ["code", "x", "y"]).where("id <> rep").select("id", "rep").distinct()
        copies = stage(copies.join(linked.where("home").select(F.col("id").alias("rep"), "label"), "rep").select("id", "label"), "copies")
    # a record in several cells ties their labels together: edges from the smallest to the others
    ties = linked.where("shared").groupBy("id").agg(F.collect_set("label").alias("labels")).where(F.size("labels") > 1)
    roots = contract(ties.select(F.array_min("labels").alias("v"), F.explode("labels").alias("u")).where("u != v").distinct())
    members = linked.where("home").select("id", "label")
    members = members if copies is None else members.unionByName(copies)
    labels = members.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    labels = labels.join(roots, labels.label == roots.node, "left").select("label", "n", F.coalesce("root", "label").alias("root"))
    large = labels.groupBy("root").agg(F.sum("n").alias("size")).where(F.col("size") >= least).select(F.col("root").alias("patch"))
    named = labels.join(large, labels.root == large.patch).select("label", "patch")
    return members.join(named, "label").select("patch", "id")
