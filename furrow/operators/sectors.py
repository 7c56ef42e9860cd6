"""Sectors of plants: density clustering, rescue of noise, renumbering, rows, columns, hulls."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furrow.functions.rounding import half_away
from furrow.operators.joins import knn_join
from furrow.operators.near import kth_distance, reach_tree
from furrow.session import running_total, stage


def spacing(points: DataFrame, id_col: str, x: str, y: str, k: int, cell: float) -> DataFrame:
    """One row: the median distance to the nearest other point, and the 0.9 quantile of the distance to the k-th point, itself included.

    Both are exact over distances rounded to micrometres.
    """
    n = knn_join(points, points, max(1, k - 1), cell, id_col, x, y)
    h = n.groupBy("rank", half_away("d", 6).alias("d")).agg(F.count(F.lit(1)).alias("c"))
    nearest = F.when(F.col("rank") == 1, F.col("c")).otherwise(0)
    far = F.when(F.col("rank") == max(1, k - 1), F.col("c")).otherwise(0)
    return h.agg(F.percentile("d", 0.5, nearest).alias("nearest"), F.percentile("d", 0.9, far).alias("kth"))


def relabelled(points: DataFrame, sector: str, x: str, y: str) -> DataFrame:
    """(old, sector): sectors numbered from 0 by falling mean y, then rising mean x, then the old id; noise stays -1."""
    m = points.where(F.col(sector) >= 0).groupBy(F.col(sector).alias("old")).agg(half_away(F.avg(y), 6).alias("_y"), half_away(F.avg(x), 6).alias("_x"))
    order = Window.partitionBy(F.lit(1)).orderBy(F.desc("_y"), "_x", "old")  # one row a sector
    return m.select("old", (F.row_number().over(order) - 1).alias("sector"))


def axis_tolerance(points: DataFrame, keys: list[str], minor: str, factor: float = 1.5, least: float = 1e-9, digits: int = 3) -> DataFrame:
    """(keys, tolerance): factor times the median of each value's nearest non-zero gap, over values rounded to ``digits``."""
    h = points.groupBy(*keys, half_away(minor, digits).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(*keys).orderBy("v")
    gap = F.least(F.col("v") - F.lag("v").over(w), F.lead("v").over(w) - F.col("v"))
    h = h.withColumn("gap", gap).where("gap IS NOT NULL")
    return h.groupBy(*keys).agg(F.greatest(F.percentile("gap", 0.5, F.col("c")) * factor, F.lit(least)).alias("tolerance"))


def row_column_numbers(points: DataFrame, id_col: str, sector: str, minor: str, major: str, tolerance: str) -> DataFrame:
    """(id, sector, row_index, col_index), both from 1: rows by falling minor with anchored tolerance, columns by major in a row.

    A sector's rows are folded one after the other, but wherever a stretch of the minor axis as long as the
    tolerance is empty a new row must begin. So the occupied stretches are counted first, islands of them
    are folded independently, streaming in order, and their row counts are added up: a large sector is many tasks.
    Rows with a null sector or a negative one (noise), minor, major or tolerance get no numbers; equal positions go by id.
    """
    p = points.select(F.col(id_col).alias("id"), F.col(sector).alias("sector"), F.col(minor).cast("double").alias("minor"), F.col(major).cast("double").alias("major"), F.col(tolerance).cast("double").alias("tol"))
    p = p.where((F.col("sector") >= 0) & F.col("id").isNotNull() & (F.abs("minor") < float("inf")) & (F.abs("major") < float("inf")) & (F.col("tol") > 0))
    p = p.withColumn("_b", F.floor(F.col("minor") / (F.col("tol") * (1 + 1e-9))))
    b = p.select("sector", "_b").distinct()
    w = Window.partitionBy("sector").orderBy(F.desc("_b"))
    b = b.withColumn("_new", F.coalesce((F.lag("_b").over(w) - F.col("_b") > 1).cast("int"), F.lit(1)))
    b = b.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")

    def fold(it):
        key, row, anchor = None, 0, 0.0
        for pdf in it:
            out = []
            for s, i, v, tol in zip(pdf["sector"].tolist(), pdf["_island"].tolist(), pdf["minor"].tolist(), pdf["tol"].tolist()):
                if (s, i) != key:
                    key, row, anchor = (s, i), 1, v
                elif abs(anchor - v) > tol:
                    row, anchor = row + 1, v
                out.append(row)
            yield pdf[["id", "sector", "_island", "major"]].assign(row=out)

    kinds = {f.name: f.dataType.simpleString() for f in p.schema.fields}
    whole = p.join(b, ["sector", "_b"]).drop("_b").repartition("sector", "_island").sortWithinPartitions("sector", "_island", F.desc("minor"), "major", "id")
    parts = whole.select("id", "sector", "_island", "minor", "major", "tol").mapInPandas(fold, f"id {kinds['id']}, sector {kinds['sector']}, _island long, major double, row long")
    parts = parts.withColumn("col_index", F.row_number().over(Window.partitionBy("sector", "_island", "row").orderBy("major", "id")))
    parts = stage(parts.drop("major"), "rows")
    n = parts.groupBy("sector", "_island").agg(F.max("row").alias("_n"))
    before = n.select("sector", "_island", F.coalesce(F.sum("_n").over(Window.partitionBy("sector").orderBy("_island").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"))
    return parts.join(before, ["sector", "_island"]).select("id", "sector", (F.col("row") + F.col("_o")).cast("int").alias("row_index"), F.col("col_index").cast("int").alias("col_index"))


def rescued_noise(noise: DataFrame, frames: DataFrame, id_col: str, x: str, y: str, across: float, along: float) -> DataFrame:
    """(id, sector): the best sector of each noise point whose gaps to the sector's frame are within both limits.

    The score is the sum of the squared shares of the limits; equal scores go to the lower sector. Frames are
    laid on squares as wide as their reach, so a point meets the frames near it by an equi-join.
    """
    side = 64 * max(across, along)
    f = frames.withColumn("_reach", F.greatest(F.abs("major_min"), F.abs("major_max"), F.abs("minor_q05"), F.abs("minor_q95")) * 1.5 + (across + along) * 1.5)
    span = lambda c: F.explode(F.sequence(F.floor((F.col(c) - F.col("_reach")) / side), F.floor((F.col(c) + F.col("_reach")) / side)))
    f = f.withColumn("_gx", span("cx")).withColumn("_gy", span("cy"))
    n = noise.select(F.col(id_col).alias("id"), F.col(x).alias("_x"), F.col(y).alias("_y")).where((F.abs("_x") < float("inf")) & (F.abs("_y") < float("inf")))
    n = n.withColumns({"_gx": F.floor(F.col("_x") / side), "_gy": F.floor(F.col("_y") / side)})
    m = n.join(f, ["_gx", "_gy"])
    dx, dy = F.col("_x") - F.col("cx"), F.col("_y") - F.col("cy")
    gap = lambda v, lo, hi: F.greatest(F.col(lo) - v, v - F.col(hi), F.lit(0.0))
    gm = gap(dx * F.col("ax") + dy * F.col("ay"), "major_min", "major_max")
    gn = gap(dy * F.col("ax") - dx * F.col("ay"), "minor_q05", "minor_q95")
    m = m.select("id", F.col("sector"), gm.alias("gm"), gn.alias("gn")).where((F.col("gm") <= along) & (F.col("gn") <= across))
    score = F.pow(F.col("gn") / across, 2) + F.pow(F.col("gm") / along, 2)
    return m.groupBy("id").agg(F.min(F.struct(score.alias("s"), "sector")).alias("m")).select("id", F.col("m.sector").alias("sector"))


def convex_hull(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Corners in counter-clockwise order (monotone chain); fewer than three distinct points come back as they are."""
    p = np.unique(np.stack([x, y], 1), axis=0)
    if len(p) < 3:
        return p

    def half(points):
        out: list = []
        for q in points:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(q)
        return out[:-1]

    p = [tuple(q) for q in p]
    return np.array(half(p) + half(p[::-1]))


def sector_hulls(points: DataFrame, sector: str, x: str, y: str, buffer: float = 0.5) -> DataFrame:
    """(sector, n, hull): the convex hull of each sector of at least three points.

    Each task reduces its points to the hull's corners first, so a sector of any size sends few. Points on a line, or all at one
    place, give a square or strip of the buffer's width around them.
    """
    rows = points.where((F.col(sector) >= 0) & (F.abs(x) < float("inf")) & (F.abs(y) < float("inf"))).select(F.col(sector).alias("sector"), F.col(x).alias("x"), F.col(y).alias("y"))

    def part(it):
        for pdf in it:
            for s, g in pdf.groupby("sector"):
                h = convex_hull(g["x"].to_numpy(), g["y"].to_numpy())
                yield pd.DataFrame({"sector": s, "x": h[:, 0], "y": h[:, 1], "n": [len(g)] + [0] * (len(h) - 1)})

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["n"].sum())
        if n < 3:
            return pd.DataFrame({"sector": [], "n": [], "hull": []})
        h = convex_hull(pdf["x"].to_numpy(), pdf["y"].to_numpy())
        if len(h) < 3:
            (x0, y0), (x1, y1) = h.min(0) - buffer, h.max(0) + buffer
            h = np.array([(x0, y0), (x1, y0), (x1, y1), (x0, y1)])
        return pd.DataFrame({"sector": [pdf["sector"].iloc[0]], "n": [n], "hull": [[list(map(float, q)) for q in h]]})

    kind = rows.schema["sector"].dataType.simpleString()
    small = rows.mapInPandas(part, f"sector {kind}, x double, y double, n long")
    return small.groupBy("sector").applyInPandas(whole, f"sector {kind}, n long, hull array<array<double>>")


def simplified_ring(ring: list, eps: float = 2.0) -> list:
    """Douglas-Peucker with a closed ring out; rings of fewer than four points come back closed as they are."""
    pts = [tuple(map(float, p)) for p in ring if p is not None and len(p) >= 2]
    if len(pts) > 3:
        keep, todo = {0, len(pts) - 1}, [(0, len(pts) - 1)]
        while todo:
            a, b = todo.pop()
            if b - a < 2:
                continue
            (x1, y1), (x2, y2) = pts[a], pts[b]
            size = np.hypot(x2 - x1, y2 - y1)
            q = np.array(pts[a + 1 : b])
            far = np.abs((x2 - x1) * (y1 - q[:, 1]) - (x1 - q[:, 0]) * (y2 - y1)) / size if size else np.hypot(q[:, 0] - x1, q[:, 1] - y1)
            i = int(far.argmax())
            if far[i] > eps:
                keep.add(a + 1 + i)
                todo += [(a, a + 1 + i), (a + 1 + i, b)]
        pts = [pts[i] for i in sorted(keep)]
    if pts and pts[0] != pts[-1]:
        pts.append(pts[0])
    return [list(p) for p in pts]


def hdbscan(x: np.ndarray, y: np.ndarray, min_cluster: int, min_samples: int | None = None) -> np.ndarray:
    """Labels from 0, noise -1: mutual-reachability spanning tree, condensed by cluster size, chosen by excess of mass.

    Exact, in memory, for one scene; near points only are compared, so it takes about n log n. The number of samples defaults to min_cluster.
    """
    n = len(x)
    if n < min_cluster or n < 2:
        return np.full(n, -1)
    k = min(n - 1, (min_samples or min_cluster) - 1)
    a, b, h = reach_tree(x, y, kth_distance(x, y, k))
    # single linkage: node n + i joins left[i] and right[i]
    up, left, right = list(range(2 * n - 1)), [], []
    for i, (u, v) in enumerate(zip(a.tolist(), b.tolist()), n):
        while up[u] != u:
            up[u] = u = up[up[u]]
        while up[v] != v:
            up[v] = v = up[up[v]]
        left.append(u)
        right.append(v)
        up[u] = up[v] = i
    size = [1] * n
    for u, v in zip(left, right):
        size.append(size[u] + size[v])
    left, right, size = np.array(left), np.array(right), np.array(size)
    parent = np.arange(2 * n - 1)
    parent[left] = parent[right] = np.arange(n, 2 * n - 1)
    # condensed tree: a split counts where both sides are large enough, and starts two clusters
    big = size >= min_cluster
    split = big[left] & big[right]
    start = np.zeros(2 * n - 1, bool)
    start[left[split]] = start[right[split]] = start[-1] = True
    top = np.where(start, np.arange(2 * n - 1), parent)
    while not start[top].all():
        top = top[top]
    starts = np.flatnonzero(start)[::-1]  # a cluster's number is above that of the one around it
    number = np.full(2 * n - 1, -1)
    number[starts] = np.arange(len(starts))
    cluster = number[top]
    lam = np.where(h > 0, 1 / np.where(h > 0, h, 1.0), 1e12)
    around = cluster[parent[starts]]
    birth = np.r_[0.0, lam[parent[starts[1:]] - n]]
    inner = cluster[n:]
    gone = size[left] * (split | ~big[left]) + size[right] * (split | ~big[right])
    stability = np.bincount(inner, np.where(big[n:], (lam - birth[inner]) * gone, 0.0), len(starts)).tolist()
    below, chosen, inside = [0.0] * len(starts), [False] * len(starts), [False] * len(starts)
    around = around.tolist()
    for c in range(len(starts) - 1, 0, -1):
        chosen[c] = not inside[c] or stability[c] >= below[c]
        below[around[c]] += stability[c] if chosen[c] else below[c]
        inside[around[c]] = True
    labels, found = [-1] * len(starts), 0
    for c in range(1, len(starts)):
        labels[c] = labels[around[c]]
        if labels[c] < 0 and chosen[c]:
            labels[c], found = found, found + 1
    return np.array(labels)[cluster[:n]]


def density_sectors(points: DataFrame, id_col: str, x: str, y: str, scene: str, min_cluster: int = 10) -> DataFrame:
    """(scene, id, sector, nearest): HDBSCAN inside each scene, noise -1, and the distance to the nearest other point. A scene is one survey's points and must fit a task."""
    p = points.select(F.col(id_col).alias("id"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), F.col(scene).alias("scene"))
    p = p.where((F.abs("x") < float("inf")) & (F.abs("y") < float("inf")) & F.col("scene").isNotNull())

    def f(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        x, y = pdf["x"].to_numpy(), pdf["y"].to_numpy()
        return pdf[["scene", "id"]].assign(sector=hdbscan(x, y, min_cluster), nearest=kth_distance(x, y, 1) if len(x) > 1 else None)

    kinds = {s.name: s.dataType.simpleString() for s in p.schema.fields}
    return p.groupBy("scene").applyInPandas(f, f"scene {kinds['scene']}, id {kinds['id']}, sector int, nearest double")


def subsampled(pixels: DataFrame, keys: list[str], order: str, most: int = 200) -> DataFrame:
    """At most ``most`` rows of each key, evenly spaced in order: positions floor of linspace(0, n - 1, most)."""
    spread = 16
    n = pixels.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    r = running_total(pixels, keys, order, F.lit(1), "_i", spread).join(n, keys)
    step = (F.col("_n") - 1) / F.lit(most - 1)
    slot = F.ceil(F.col("_i") / step - 1e-9)
    return r.where((F.col("_n") <= most) | ((slot < most) & (F.floor(slot * step + 1e-9) == F.col("_i")))).drop("_i", "_n")
