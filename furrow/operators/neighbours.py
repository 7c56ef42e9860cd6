"""Means over the nearest neighbours: blocks of about equal size are searched in memory, what they leave open is settled by a join."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furrow.operators.joins import knn_join
from furrow.operators.near import Leaves, kth_bounds
from furrow.operators.slabs import Slabs, plan_slabs
from furrow.session import stage

#: Open rows up to which they go to every task.
FEW = 100_000


def k_nearest(x: np.ndarray, y: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(distance, position) of the k nearest others of each point, nearest first, ties by position; inf and -1 where there are fewer.

    Of the points at one place only the first k + 1 can be among the nearest of any point, so the others are left out of the search.
    """
    n = len(x)
    far, at = np.full((n + 1, k), np.inf), np.full((n + 1, k), -1)
    if n <= max(256, 2 * (k + 1)):
        d = np.sqrt((x[:, None] - x) ** 2 + (y[:, None] - y) ** 2)
        np.fill_diagonal(d, np.inf)
        o = np.argsort(d, axis=1, kind="stable")[:, :k]
        m = min(k, n - 1)
        if m > 0:
            far[:n, :m], at[:n, :m] = np.take_along_axis(d, o, 1)[:, :m], o[:, :m]
        return far[:n], at[:n]
    o = np.lexsort((np.arange(n), y, x))
    first = np.r_[True, (x[o][1:] != x[o][:-1]) | (y[o][1:] != y[o][:-1])]
    begin = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    more = np.flatnonzero(np.arange(n) - begin > k)
    if len(more):
        keep = np.ones(n, bool)
        keep[o[more]] = False
        keep = np.flatnonzero(keep)
        d, j = k_nearest(x[keep], y[keep], k)
        far[keep], at[keep] = d, np.where(j >= 0, keep[j], -1)
        far[o[more]], at[o[more]] = 0.0, o[begin[more][:, None] + np.arange(k)]
        return far[:n], at[:n]
    leaves = Leaves(x, y, max(32, 2 * (k + 1)))
    for p, c, dx, dy in leaves.blocks(kth_bounds(leaves, k)):
        d = dx * dx + dy * dy
        d[p[:, :, None] == c[:, None, :]] = np.inf
        most = np.partition(d, k - 1, 2)[:, :, k - 1 : k] * (1 + 1e-15)  # squares that differ may have one root
        i, r, s = np.nonzero((d <= most) & (p < n)[:, :, None])
        key, d, c = p[i, r], np.sqrt(d[i, r, s]), c[i, s]
        o = np.lexsort((c, d, key))
        key, d, c = key[o], d[o], c[o]
        head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        place = np.arange(len(key)) - np.repeat(head, np.diff(np.r_[head, len(key)]))
        keep = place < k
        far[key[keep], place[keep]], at[key[keep], place[keep]] = d[keep], c[keep]
    return far[:n], at[:n]


def _mean(v: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The mean of the found, summed from the nearest on; NaN where none is."""
    total, n = np.zeros(len(at)), (at >= 0).sum(1)
    for j in range(at.shape[1]):
        total += np.where(at[:, j] >= 0, v[at[:, j]], 0.0)
    return np.divide(total, n, out=np.full(len(at), np.nan), where=n > 0)


def _numbers(table: pa.Table, c: str) -> np.ndarray:
    return table[c].cast(pa.float64()).to_numpy()


def _edge(plan: Slabs, slab: int, block: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Each point's distance to the edge of its block."""
    cuts = plan.cuts.get(slab, ())
    out = np.full(len(x), np.inf)
    for v, at, i in ((x, plan.breaks, slab), (y, cuts, block)):
        if i > 0:
            out = np.minimum(out, v - at[i - 1])
        if i < len(at):
            out = np.minimum(out, at[i] - v)
    return out


def near_means(df: DataFrame, id_col: str, x: str, y: str, values: Sequence[str], k: int, cell: float, rows_per_block: int = 20_000) -> DataFrame:
    """``df`` with ``<value>_near``: the mean of the value over the k nearest other rows that have it, ties by id; exactly.

    Only rows that have the value get a mean, and those without id or finite coordinates get none. ``df`` is read several times, so stage
    it. Values and coordinates must be doubles, without NaN.

    Rows go to blocks of about ``rows_per_block``, and with a margin of a few spacings to those beside. A row is settled there if its
    k-th neighbour is nearer than the edge of what the block holds. The others, which are few, know within which distance their neighbours lie
    and meet the rows of that square. Where many rows share a place or a line, so that blocks can't be cut, ``knn_join`` is used for all.
    """
    some = F.coalesce(*[F.col(v) for v in values]).isNotNull()
    takes = F.coalesce((F.abs(x) < float("inf")) & (F.abs(y) < float("inf")) & F.col(id_col).isNotNull() & some, F.lit(False))
    part = df.where(takes)
    ends = part.agg(F.count(F.lit(1)), *[F.percentile_approx(c, [0.25, 0.75], 1000) for c in (x, y)]).first()
    plan = plan_slabs(part.select(x, y), x, y, rows_per_block, max(1, math.isqrt(ends[0] // rows_per_block)))
    if plan.parts:
        for v in values:
            has = part.where(F.col(v).isNotNull())
            n = knn_join(has, has, k, cell, id_col, x, y, v).groupBy("id").agg(F.avg("v").alias(f"{v}_near"))
            df = df.join(n.withColumnRenamed("id", id_col), id_col, "left")
        return df
    # half of the rows lie between the quartiles of x, and about half of these between those of y
    margin = 3 * math.sqrt(max(0.0, (ends[1][1] - ends[1][0]) * (ends[2][1] - ends[2][0])) / max(1, ends[0] / 4)) or cell if ends[0] else cell

    def send(it):
        for b in it:
            row, slab, block, home = plan.tiles(b[x].to_numpy(), b[y].to_numpy(), margin)
            out = b.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(slab, pa.int32()), pa.array(block, pa.int32()), pa.array(home)], [*b.schema.names, "_slab", "_block", "_home"])

    def search(key, table):
        table = table.take(pc.sort_indices(table, sort_keys=[(id_col, "ascending")]))  # ties go by position
        px, py, home = _numbers(table, x), _numbers(table, y), table["_home"].to_numpy()
        edge = _edge(plan, key[0].as_py(), key[1].as_py(), px, py) + margin - 1e-12 * (np.abs(px) + np.abs(py))
        out = table.drop_columns(["_slab", "_block", "_home"])
        for v in values:
            mean, open_ = np.full(len(px), np.nan), np.full(len(px), np.nan)
            value = _numbers(table, v)
            has = np.flatnonzero(~np.isnan(value))
            if len(has):
                d, at = k_nearest(px[has], py[has], k)
                settled = (d[:, -1] <= edge[has]) | np.isinf(edge[has])
                mean[has] = np.where(settled, _mean(value[has], at), np.nan)
                open_[has] = np.where(settled, np.nan, d[:, -1])
            out = out.append_column(f"{v}_near", pa.array(mean, mask=np.isnan(mean))).append_column(f"_{v}_open", pa.array(open_, mask=np.isnan(open_)))
        return out.filter(pa.array(home))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    sent = part.mapInArrow(send, f"{fields}, _slab int, _block int, _home boolean")
    found = sent.groupBy("_slab", "_block").applyInArrow(search, fields + "".join(f", `{v}_near` double, `_{v}_open` double" for v in values))
    made = stage(found, "neighbours")
    counts = made.agg(*[e for v in values for e in (F.count_if(F.col(f"_{v}_open") < float("inf")), F.count_if(F.col(f"_{v}_open") == float("inf")))]).first()
    for i, v in enumerate(values):
        if not counts[2 * i] + counts[2 * i + 1]:
            continue
        late, rest = _within_reach(made, id_col, x, y, v, k, counts[2 * i] <= FEW), counts[2 * i + 1]
        if rest:  # blocks with fewer than k other rows
            lost = knn_join(made.where(F.col(f"_{v}_open") == float("inf")), made.where(F.col(v).isNotNull()), k, cell, id_col, x, y, v)
            late = late.unionByName(lost.groupBy("id").agg(F.avg("v").alias("_late")).withColumnRenamed("id", "_id"))
        late = stage(late, "late")
        late = F.broadcast(late) if counts[2 * i] + rest <= FEW else late
        made = made.join(late, F.col(id_col) == F.col("_id"), "left").withColumn(f"{v}_near", F.coalesce(f"{v}_near", "_late")).drop("_id", "_late")
    made = made.select(*df.columns, *[f"{v}_near" for v in values])
    return made.unionByName(df.where(~takes).select(*df.columns, *[F.lit(None).cast("double").alias(f"{v}_near") for v in values]))


def _within_reach(made: DataFrame, id_col: str, x: str, y: str, value: str, k: int, few: bool) -> DataFrame:
    """(_id, _late): the means of open rows, whose k nearest lie within a known distance.

    Each has squares of at least twice that distance for a side, at a level of its own, of which it meets four at most.
    """
    reach = F.col(f"_{value}_open")
    q = made.where(reach < float("inf")).select(F.col(id_col).alias("_id"), F.col(x).alias("_x"), F.col(y).alias("_y"), reach.alias("_r"))
    pad = F.col("_r") * (1 + 1e-9) + 1e-12 * (F.abs("_x") + F.abs("_y"))
    q = q.withColumn("_pad", F.greatest(pad, F.lit(1e-12))).withColumn("_level", F.ceil(F.log2(2 * F.col("_pad"))).cast("int"))
    levels = sorted(r[0] for r in q.select("_level").distinct().collect())  # a number for each power of two
    if not levels:
        return made.limit(0).select(F.col(id_col).alias("_id"), F.lit(0.0).alias("_late"))
    side = F.pow(F.lit(2.0), F.col("_level"))
    meets = lambda c: F.explode(F.sequence(F.floor((F.col(c) - F.col("_pad")) / side), F.floor((F.col(c) + F.col("_pad")) / side)))
    q = q.withColumn("_cx", meets("_x")).withColumn("_cy", meets("_y"))
    b = made.where(F.col(value).isNotNull()).select(F.col(id_col).alias("_other"), F.col(x).alias("_bx"), F.col(y).alias("_by"), F.col(value).alias("_v"), F.explode(F.array(*map(F.lit, levels))).alias("_level"))
    b = b.withColumns({"_cx": F.floor(F.col("_bx") / side), "_cy": F.floor(F.col("_by") / side)})
    dx, dy = F.col("_x") - F.col("_bx"), F.col("_y") - F.col("_by")
    met = b.join(F.broadcast(q) if few else q, ["_level", "_cx", "_cy"]).where("_id <> _other").withColumn("_d", F.sqrt(dx * dx + dy * dy)).where("_d <= _r")
    top = met.withColumn("_rank", F.row_number().over(Window.partitionBy("_id").orderBy("_d", "_other"))).where(F.col("_rank") <= k)
    listed = F.array_sort(F.collect_list(F.struct("_rank", "_v")))
    return top.groupBy("_id").agg(listed.alias("l")).select("_id", (F.aggregate("l", F.lit(0.0), lambda a, e: a + e["_v"]) / F.size("l")).alias("_late"))
