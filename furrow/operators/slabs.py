"""Points near points or in regions: ordered slabs, and binary search among the edges of a slab."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Candidate pairs looked at together, which bounds a worker's memory.
BLOCK = 1_000_000


def slab_pairs(x: np.ndarray, y: np.ndarray, radius: float):
    """Blocks of index pairs (i, j) at most ``radius`` apart, each unordered pair once.

    Each point owns a square region of half-width ``radius``. The plane is cut into slabs of that
    width along x; inside a slab the points are ordered by y, so the squares that hold a point are
    between two binary searches, for y - radius and y + radius, in its own slab and the next one.
    """
    if not len(x):
        return
    slab = np.floor((x - x.min()) / (radius * (1 + 1e-6))).astype(np.int64)
    order = np.lexsort((y, slab))
    x, y, slab = x[order], y[order], slab[order]
    here = np.arange(len(x))
    first = np.flatnonzero(np.r_[True, slab[1:] != slab[:-1]])
    rank = np.searchsorted(slab[first], slab)
    span = y.max() - y.min() + 4 * radius
    code = rank * span + (y - y.min())  # slabs one after the other, each ordered by y
    slack = 1e-9 * (1 + span * len(first))
    nxt = np.flatnonzero(np.r_[slab[first][1:] == slab[first][:-1] + 1, False])
    follows = np.isin(rank, nxt)
    for own in (True, False):
        lo = here + 1 if own else np.searchsorted(code, code + span - radius - slack, "left")
        hi = np.searchsorted(code, code + (0 if own else span) + radius + slack, "right")
        count = np.maximum(hi - lo, 0) if own else np.where(follows, np.maximum(hi - lo, 0), 0)
        edges = np.r_[0, np.cumsum(count)]
        a = 0
        while a < len(x):
            b = max(a + 1, int(np.searchsorted(edges, edges[a] + BLOCK, "right")) - 1)
            c = count[a:b]
            i = np.repeat(here[a:b], c)
            j = np.arange(len(i)) - np.repeat(edges[a:b] - edges[a], c) + np.repeat(lo[a:b], c)
            dx, dy = x[i] - x[j], y[i] - y[j]
            near = (np.sqrt(dx * dx + dy * dy) <= radius) & (slab[j] - slab[i] == (0 if own else 1))
            yield order[i[near]], order[j[near]]
            a = b


@dataclass(frozen=True)
class Slabs:
    """Slabs along x between ``breaks``, each cut along y at ``cuts[slab]`` where it holds too many rows.

    ``parts``: into how many parts a block's rows are dealt that no cut can make smaller, such as many at one place.
    """

    breaks: np.ndarray
    cuts: dict[int, np.ndarray]
    parts: dict[tuple[int, int], int]

    def tiles(self, x: np.ndarray, y: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, slab, block, home) for each slab and block that the square around a point meets."""
        row, slab = _ranges(np.searchsorted(self.breaks, x - radius, "right"), np.searchsorted(self.breaks, x + radius, "right"))
        home = slab == np.searchsorted(self.breaks, x, "right")[row]
        block = np.zeros(len(row), np.int64)
        parts = []
        for s in np.unique(slab):
            at, cuts = np.flatnonzero(slab == s), self.cuts.get(int(s), ())
            if len(cuts):
                z = y[row[at]]
                again, b = _ranges(np.searchsorted(cuts, z - radius, "right"), np.searchsorted(cuts, z + radius, "right"))
                parts.append((row[at][again], slab[at][again], b, home[at][again] & (b == np.searchsorted(cuts, z, "right")[again])))
            else:
                parts.append((row[at], slab[at], block[at], home[at]))
        return tuple(np.concatenate(p) for p in zip(*parts)) if parts else (row, slab, block, home)

    def deal(self, slab: np.ndarray, block: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, part, low, high): each row once, or, in a block of several parts, for every part that its own meets, itself included."""
        many = np.ones(len(slab), np.int64)
        for (s, b), n in self.parts.items():
            many[(slab == s) & (block == b)] = n
        row, other = _ranges(np.zeros(len(slab), np.int64), many - 1)
        part = (salt % many)[row]
        return row, part, np.minimum(part, other), np.maximum(part, other)


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every value of each range lo..hi, with the index of the range."""
    n = hi - lo + 1
    row = np.repeat(np.arange(len(lo)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)


def plan_slabs(df: DataFrame, x: str, y: str, rows_per_slab: int = 20_000, most: int = 4096) -> Slabs:
    """Balanced slabs from mergeable quantile sketches over all rows: at most ``most``, cut along y into blocks of about ``rows_per_slab`` rows.

    Slabs of more than three times as many rows, by their own count, are cut at as many quantiles of y as that takes. A block that stays
    large all the same, as its rows lie at one y, is given parts instead. What reaches the driver is a number for each block.
    """
    n = df.count()
    want = int(min(most, max(1, n // rows_per_slab)))
    if want == 1 and n <= 3 * rows_per_slab:
        return Slabs(np.empty(0), {}, {})
    breaks = np.unique(df.agg(F.percentile_approx(x, [i / want for i in range(1, want)], 20 * want).alias("b")).first()["b"]) if want > 1 else np.empty(0)

    def count(it):
        total = np.zeros(len(breaks) + 1, np.int64)
        for pdf in it:
            total += np.bincount(np.searchsorted(breaks, pdf["x"].to_numpy(), "right"), minlength=len(total))
        at = np.flatnonzero(total)
        yield pd.DataFrame({"s": at, "n": total[at]})

    sizes = {r["s"]: r["n"] for r in df.select(F.col(x).alias("x")).mapInPandas(count, "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).collect()}
    large = np.array(sorted(s for s, m in sizes.items() if m > 3 * rows_per_slab), dtype=np.int64)
    if not len(large):
        return Slabs(breaks, {}, {})
    steps = int(max(-(-sizes[s] // rows_per_slab) for s in large))

    def place(it):
        for pdf in it:
            slab = np.searchsorted(breaks, pdf["x"].to_numpy(), "right")
            keep = np.isin(slab, large)
            yield pd.DataFrame({"s": slab[keep], "y": pdf["y"].to_numpy()[keep]})

    ys = df.select(F.col(x).alias("x"), F.col(y).alias("y")).mapInPandas(place, "s long, y double")
    found = ys.groupBy("s").agg(F.percentile_approx("y", [i / steps for i in range(1, steps)], max(1000, 20 * steps)).alias("q"))
    cuts, parts = {}, {}
    for r in found.collect():
        blocks = -(-sizes[r["s"]] // rows_per_slab)
        at = np.array([r["q"][max(0, round(i * steps / blocks) - 1)] for i in range(1, blocks)])
        cuts[r["s"]], again = np.unique(at, return_counts=True)
        # a cut that comes up several times has as many blocks' rows at its own y, which lie above it
        for b, c in enumerate(again, 1):
            if c > 3:
                parts[r["s"], b] = int(-(-c // 3))
    return Slabs(breaks, cuts, parts)


def _in_slabs(df: DataFrame, breaks: np.ndarray, **out: str) -> DataFrame:
    """Columns with the number of breaks at most another column's value (null and NaN as 0.0), found by binary search a batch at a time."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def f(it):
        for pdf in it:
            yield pdf.assign(**{k: np.searchsorted(breaks, np.nan_to_num(pdf[c].to_numpy(dtype=float, na_value=0.0), nan=0.0), "right") for k, c in out.items()})

    return df.mapInPandas(f, kinds + "".join(f", `{k}` long" for k in out))


def near_pairs(df: DataFrame, id_col: str, x: str, y: str, radius: float, value: str | None = None, differ: float = 0.0, rows_per_slab: int = 20_000) -> DataFrame:
    """(a, b, distance): pairs of different points at most ``radius`` apart, smaller id first; with value_a and value_b and
    only pairs whose ``value`` differs by more than ``differ``, if a value column is named.

    Points are distributed by slab and block; a point goes to every block that its square meets and is
    located in its own, so each pair is found once. Blocks that cannot be cut small enough, as at one place, are dealt to parts that
    meet in pairs. Ids compare as text.

    Rows with a null id, or a null, NaN or infinite coordinate (or value, if one is named), have no partners.
    Points at one place pair like others; rows of equal id never pair.
    """
    v = F.col(value).cast("double") if value else F.lit(0.0)
    rows = df.select(F.col(id_col).cast("string").alias("id"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), v.alias("v"))
    rows = rows.where(F.col("id").isNotNull() & (F.abs("x") < float("inf")) & (F.abs("y") < float("inf")) & (F.abs("v") < float("inf")))
    slabs = plan_slabs(rows, "x", "y", rows_per_slab)

    def assign(it):
        for pdf in it:
            row, slab, block, home = slabs.tiles(pdf["x"].to_numpy(), pdf["y"].to_numpy(), radius + 1e-6)
            again, part, low, high = slabs.deal(slab, block, pdf["salt"].to_numpy()[row])
            yield pdf.iloc[row[again]].drop(columns="salt").assign(slab=slab[again], block=block[again], home=home[again], part=part, low=low, high=high)

    def locate(pdf: pd.DataFrame) -> pd.DataFrame:
        px, py, pv, home, ids, part = (pdf[c].to_numpy() for c in ("x", "y", "v", "home", "id", "part"))
        apart = pdf["low"].iloc[0] != pdf["high"].iloc[0]  # two parts: pairs inside one are found where it is alone
        out = [pd.DataFrame({"a": [], "b": [], "distance": [], "value_a": [], "value_b": []}).astype({"a": str, "b": str})]
        for i, j in slab_pairs(px, py, radius):
            if apart:
                cross = part[i] != part[j]
                i, j = i[cross], j[cross]
            if value:
                keep = np.abs(pv[i] - pv[j]) > differ
                i, j = i[keep], j[keep]
            swap = ids[i] > ids[j]
            a, b = np.where(swap, j, i), np.where(swap, i, j)
            keep = home[b] & (ids[a] != ids[b])  # b is located here; a's square may come from next door
            a, b = a[keep], b[keep]
            out.append(pd.DataFrame({"a": ids[a], "b": ids[b], "distance": np.sqrt((px[a] - px[b]) ** 2 + (py[a] - py[b]) ** 2), "value_a": pv[a], "value_b": pv[b]}))
        return pd.concat(out, ignore_index=True)

    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(1 << 40)) if slabs.parts else F.lit(0).cast("long"))
    tiles = salted.mapInPandas(assign, "id string, x double, y double, v double, slab long, block long, home boolean, part long, low long, high long")
    found = tiles.groupBy("slab", "block", "low", "high").applyInPandas(locate, "a string, b string, distance double, value_a double, value_b double")
    return found if value else found.drop("value_a", "value_b")


class RegionSlabs:
    """A trapezoidal decomposition: edges (zone, x1, y1, x2, y2) in slabs between their x and the x of their crossings, ordered by y inside a slab."""

    def __init__(self, edges: np.ndarray):
        e = edges[edges[:, 1] != edges[:, 3]] if len(edges) else np.empty((0, 5))
        swap = e[:, 1] > e[:, 3]
        e[swap] = e[swap][:, [0, 3, 4, 1, 2]]
        self.breaks = np.unique(e[:, [1, 3]])
        while True:
            slab = self._ordered(e)
            if not len(more := np.setdiff1d(self._crossings(slab), self.breaks)):
                break
            self.breaks = np.union1d(self.breaks, more)
        count = np.bincount(slab, minlength=max(0, len(self.breaks) - 1)) if len(slab) else np.zeros(0, np.int64)
        self.start = np.r_[0, np.cumsum(count)]
        self.zone = np.full(len(self.edge), np.nan)  # of the trapezoid above each edge
        for s in range(len(count)):
            inside: set[float] = set()
            for k in range(self.start[s], self.start[s + 1]):
                inside ^= {self.edge[k, 0]}
                self.zone[k] = min(inside) if inside else np.nan

    def _ordered(self, e: np.ndarray) -> np.ndarray:
        """Sets ``edge``, by slab and by y at its middle; returns the slabs."""
        lo, hi = np.searchsorted(self.breaks, e[:, 1]), np.searchsorted(self.breaks, e[:, 3])
        row, slab = _ranges(lo, hi - 1)
        mid = (self.breaks[slab] + self.breaks[slab + 1]) / 2 if len(slab) else np.empty(0)
        at = e[row]
        ymid = at[:, 2] + (at[:, 4] - at[:, 2]) * (mid - at[:, 1]) / np.where(len(at), at[:, 3] - at[:, 1], 1)
        order = np.lexsort((ymid, slab))
        self.edge = at[order]
        return slab[order]

    def _crossings(self, slab: np.ndarray) -> np.ndarray:
        """The x where neighbours of a slab cross inside it. While any edges of a slab cross, some neighbours do."""
        k = np.flatnonzero(slab[1:] == slab[:-1])
        if not len(k):
            return np.empty(0)
        a, b, left, right = self.edge[k], self.edge[k + 1], self.breaks[slab[k]], self.breaks[slab[k] + 1]
        up = lambda x: (b[:, 2] - a[:, 2]) + (b[:, 4] - b[:, 2]) * (x - b[:, 1]) / (b[:, 3] - b[:, 1]) - (a[:, 4] - a[:, 2]) * (x - a[:, 1]) / (a[:, 3] - a[:, 1])
        dl, dr = up(left), up(right)
        slack = 1e-9 * (1 + np.abs(a[:, [2, 4]]).max(1) / 1e3)  # edges that meet at a break differ there by rounding
        cross = (np.minimum(dl, dr) < -slack) & (np.maximum(dl, dr) > slack)
        x = left[cross] + (right - left)[cross] * (dl / np.where(cross, dl - dr, 1))[cross]
        return x[(x > left[cross]) & (x < right[cross])]

    def locate(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The smallest zone that holds each point, or NaN. A point on an edge belongs to what lies above it, at a break to the right."""
        out = np.full(len(x), np.nan)
        if len(self.breaks) < 2:
            return out
        slab = np.searchsorted(self.breaks, x, "right") - 1
        ok = (slab >= 0) & (slab < len(self.breaks) - 1) & np.isfinite(y)
        lo, hi = self.start[np.where(ok, slab, 0)], self.start[np.where(ok, slab, 0) + 1]
        base = lo.copy()
        while (todo := ok & (lo < hi)).any():
            mid = (lo + hi) // 2
            e = self.edge[np.where(todo, mid, 0)]
            above = y >= e[:, 2] + (e[:, 4] - e[:, 2]) * (x - e[:, 1]) / (e[:, 3] - e[:, 1])
            lo, hi = np.where(todo & above, mid + 1, lo), np.where(todo & ~above, mid, hi)
        hit = ok & (lo > base)
        out[hit] = self.zone[lo[hit] - 1]
        return out


def region_edges(regions: DataFrame, zone_col: str, ring_col: str) -> DataFrame:
    """(zone, x1, y1, x2, y2): the edges of each ring; an open ring is closed; null rings and points have none."""
    pts = F.filter(F.col(ring_col), lambda p: p.isNotNull() & (F.size(p) >= 2) & p[0].isNotNull() & p[1].isNotNull())
    nxt = F.concat(F.slice("r", 2, F.greatest(F.size("r"), F.lit(1))), F.slice("r", 1, 1))
    e = regions.select(F.col(zone_col).cast("double").alias("zone"), pts.alias("r")).where((F.size("r") > 2) & F.col("zone").isNotNull())
    e = e.select("zone", F.explode(F.arrays_zip(F.col("r").alias("p"), nxt.alias("q"))).alias("e"))
    return e.select("zone", *[F.element_at(f"e.{p}", i).cast("double").alias(f"{'xy'[i - 1]}{n}") for n, p in ((1, "p"), (2, "q")) for i in (1, 2)])


def containing_region(points: DataFrame, x: str, y: str, regions: DataFrame, zone_col: str, ring_col: str, keep: Sequence[str], most_edges: int = 100_000, spread: int = 8) -> DataFrame:
    """(keep..., zone): for each point the smallest-numbered region that holds it, or null.

    With at most ``most_edges`` edges (counted first) the decomposition goes to every task. Beyond
    that, points and edges meet by slab: slabs are balanced over the points, an edge goes to every slab it
    spans, and a slab's points are spread over ``spread`` tasks, so no task sees an unbounded share.

    Points without usable coordinates lie in no region; regions with a null ring or zone hold nothing.
    """
    edges = region_edges(regions, zone_col, ring_col)
    px, py = F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")
    rows = points.select(*keep, px, py)
    fields = ", ".join(f"`{c}` {points.schema[c].dataType.simpleString()}" for c in keep)
    kind = regions.schema[zone_col].dataType.simpleString()

    def answer(pdf: pd.DataFrame, made: RegionSlabs) -> pd.DataFrame:
        zone = made.locate(pdf["_x"].to_numpy(dtype=float, na_value=np.nan), pdf["_y"].to_numpy(dtype=float, na_value=np.nan))
        return pdf[list(keep)].assign(zone=pd.array(np.where(np.isnan(zone), 0, zone).astype("int64"), dtype="Int64")).assign(zone=lambda d: d["zone"].mask(np.isnan(zone)))

    found = edges.limit(most_edges + 1).toPandas()
    if len(found) <= most_edges:
        made = RegionSlabs(found.to_numpy(dtype=float))
        return rows.mapInPandas(lambda it: (answer(p, made) for p in it), f"{fields}, zone {kind}")
    slabs = plan_slabs(rows.where((F.abs("_x") < float("inf")) & (F.abs("_y") < float("inf"))), "_x", "_y")
    place = _in_slabs(rows, slabs.breaks, _s="_x").withColumn("_t", F.pmod(F.xxhash64(*rows.columns), F.lit(spread)).cast("int"))
    wide = _in_slabs(edges, slabs.breaks, _lo="x1", _hi="x2").withColumn("_s", F.explode(F.sequence(F.least("_lo", "_hi"), F.greatest("_lo", "_hi")))).withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))).drop("_lo", "_hi")
    both = place.groupBy("_s", "_t").cogroup(wide.groupBy("_s", "_t"))
    return both.applyInPandas(lambda p, e: answer(p, RegionSlabs(e[["zone", "x1", "y1", "x2", "y2"]].to_numpy(dtype=float))), f"{fields}, zone {kind}")
