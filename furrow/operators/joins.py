"""Spatial and bookkeeping joins: nearest neighbours, radius, raster lookup, polygons, tiles, stems."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furrow.functions.geo import Affine, pixel_of
from furrow.functions.rounding import half_even
from furrow.session import stage


def _points(df: DataFrame, id_col: str, x: str, y: str, value: str | None) -> DataFrame:
    v = [F.col(value).cast("double").alias("v")] if value else []
    rows = df.select(F.col(id_col).alias("id"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), *v)
    return rows.where((F.abs("x") < float("inf")) & (F.abs("y") < float("inf")) & F.col("id").isNotNull())


def knn_join(left: DataFrame, right: DataFrame, k: int, cell: float, id_col: str = "id", x: str = "x", y: str = "y", value: str | None = None, exclude_self: bool = True, most_rounds: int = 40) -> DataFrame:
    """(id, rank, other, d, v): the k nearest rows of ``right`` for each row of ``left``, exactly; ties by id.

    Squares of side ``cell`` meet their 3 x 3 surroundings by an equi-join. A row is done when its k-th distance is at
    most the distance to the edge of what was searched; the others go on with squares of at least twice the
    side, which a few lonely rows do. Where many rows of ``right`` share a place only the k + 1 smallest
    ids can be among the nearest, so the others are left out first. ``cell`` should be near the usual spacing.
    A row itself (equal id) is excluded or kept; rows without coordinates take no part.
    """
    a = _points(left, id_col, x, y, None)
    b = _points(right, id_col, x, y, value)
    here = Window.partitionBy("x", "y").orderBy("id")
    b = b.withColumn("_n", F.row_number().over(here)).where(F.col("_n") <= k + 1).drop("_n")
    b = stage(b.select(F.col("id").alias("other"), F.col("x").alias("bx"), F.col("y").alias("by"), *(["v"] if value else [])), "knn-right")
    ends = b.agg(F.min("bx"), F.max("bx"), F.min("by"), F.max("by"), F.count(F.lit(1))).first()
    extra = ["v"] if value else []
    if not ends[4]:
        return a.select("id", F.lit(1).alias("rank"), F.lit(None).cast(b.schema["other"].dataType).alias("other"), F.lit(0.0).alias("d"), *[F.lit(0.0).alias(c) for c in extra]).limit(0)
    cell *= 2 ** _first_level(b, cell, k, ends[4])
    todo, done, side = a, [], cell
    for no in range(most_rounds):
        far = ends[1] - ends[0] <= side and ends[3] - ends[2] <= side
        ca, cb = (F.floor(F.col(c) / side).alias(n) for c, n in (("bx", "cx"), ("by", "cy")))
        shift = F.explode(F.sequence(F.lit(-1), F.lit(1)))
        wide = todo.select("*", F.floor(F.col("x") / side).alias("_ox"), F.floor(F.col("y") / side).alias("_oy"))
        wide = wide.withColumn("_i", shift).withColumn("_j", shift).withColumns({"cx": F.col("_ox") + F.col("_i"), "cy": F.col("_oy") + F.col("_j")})
        met = wide.join(b.select("*", ca, cb), ["cx", "cy"])
        if exclude_self:
            met = met.where("id <> other")
        dx, dy = F.col("x") - F.col("bx"), F.col("y") - F.col("by")
        met = met.withColumn("d", F.sqrt(dx * dx + dy * dy))
        near = Window.partitionBy("id").orderBy("d", "other")
        top = met.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k)
        # the distance to the edge of the searched block
        fx, fy = F.col("x") - F.col("_ox") * side, F.col("y") - F.col("_oy") * side
        edge = F.lit(side) + F.least(fx, fy, F.lit(side) - fx, F.lit(side) - fy)
        top = stage(top.select("id", "rank", "other", "d", *extra, edge.alias("_edge")), "knn")
        full = top.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("far"), F.first("_edge").alias("edge")).where((F.col("n") >= k) & (F.col("far") <= F.col("edge")))
        outside = todo.select(F.max(F.greatest(F.abs("x"), F.abs("y")))).first()[0] if far else None
        if far and (outside is None or outside <= side):
            done.append(top)
            break
        done.append(top.join(full.select("id"), "id", "left_semi"))
        todo = stage(todo.join(full.select("id"), "id", "left_anti"), "knn-left")
        left_over = todo.count()
        if not left_over:
            break
        # the fewer go on, the larger their squares may become at no more pairs than at first
        side *= 2.0 ** max(1, min(6, int(math.log2(max(1.0, ends[4] / left_over)) / 2)))
    else:
        raise RuntimeError(f"neighbours were not settled within {most_rounds} rounds")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("id", F.col("rank").cast("int").alias("rank"), "other", "d", *extra)


def _first_level(b: DataFrame, cell: float, k: int, n: int, levels: int = 8) -> int:
    """How often to double the square's side at first: until an occupied square holds a third of k rows on average."""
    sides = [cell * 2**i for i in range(levels)]
    got = b.agg(*[F.approx_count_distinct(F.struct(F.floor(F.col("bx") / s), F.floor(F.col("by") / s))).alias(f"n{i}") for i, s in enumerate(sides)]).first()
    return next((i for i in range(levels) if n / max(1, got[i]) >= k / 3), levels - 1)


def smooth_by_neighbours(df: DataFrame, id_col: str, x: str, y: str, value: str, k: int, cell: float, include_self: bool = False, own: float = 0.7, digits: int | None = None) -> DataFrame:
    """(id, value, smoothed): own * value + (1 - own) * mean of the k nearest.

    Without self, candidates are the rows that have a value. With self, the k + 1 nearest of all rows are
    taken first, nulls dropped after, and the mean includes the row; with fewer than two values left
    the value stays as it is.
    """
    if include_self:
        n = knn_join(df.where(F.col(value).isNotNull()), df, k + 1, cell, id_col, x, y, value, exclude_self=False)
    else:
        valued = df.where(F.col(value).isNotNull())
        n = knn_join(valued, valued, k, cell, id_col, x, y, value)
    mean = n.groupBy("id").agg(F.avg("v").alias("_m"), F.count("v").alias("_n"))
    rows = df.select(F.col(id_col).alias("id"), F.col(value).cast("double").alias("value")).where("value IS NOT NULL")
    out = rows.join(mean, "id", "left")
    enough = F.col("_n") > (1 if include_self else 0)
    s = F.when(enough, own * F.col("value") + (1 - own) * F.col("_m")).otherwise(F.col("value"))
    return out.select("id", "value", (half_even(s, digits) if digits else s).alias("smoothed"))


def neighbour_context(targets: DataFrame, measured: DataFrame, value: str, k: int, cell: float, id_col: str = "id", x: str = "x", y: str = "y") -> DataFrame:
    """(id, mean, distance): mean value of and mean distance to the k nearest measured rows other than itself."""
    n = knn_join(targets, measured.where(F.col(value).isNotNull()), k, cell, id_col, x, y, value)
    return n.groupBy("id").agg(F.avg("v").alias("mean"), F.avg("d").alias("distance"))


def neighbour_means(targets: DataFrame, measured: DataFrame, values: Sequence[str], k: int, cell: float, id_col: str = "id", x: str = "x", y: str = "y") -> DataFrame:
    """(id, near_<value>..., near_distance): as neighbour_context, for several values by one search; ``measured`` must have them all."""
    n = knn_join(targets, measured, k, cell, id_col, x, y)
    named = measured.select(F.col(id_col).alias("other"), *[F.col(v).cast("double").alias(f"near_{v}") for v in values])
    return n.join(named, "other").groupBy("id").agg(*[F.avg(f"near_{v}").alias(f"near_{v}") for v in values], F.avg("d").alias("near_distance"))


def nearest_within(left: DataFrame, right: DataFrame, radius: float, id_col: str = "id", x: str = "x", y: str = "y", exclude_self: bool = False) -> DataFrame:
    """(id, other, d): the nearest row of ``right`` at most ``radius`` away, ties by id; rows without one are left out.

    With ``exclude_self`` a row of equal id is not a neighbour.

    With squares of side radius the 3 x 3 surroundings always suffice; the minimum is an aggregate, so matches
    combine before the shuffle.
    """
    a, b = _points(left, id_col, x, y, None), _points(right, id_col, x, y, None)
    shift = F.explode(F.sequence(F.lit(-1), F.lit(1)))
    side = radius * (1 + 1e-9)
    wide = b.select(F.col("id").alias("other"), F.col("x").alias("bx"), F.col("y").alias("by"), F.floor(F.col("x") / side).alias("_ox"), F.floor(F.col("y") / side).alias("_oy"))
    wide = wide.withColumn("_i", shift).withColumn("_j", shift).withColumns({"cx": F.col("_ox") + F.col("_i"), "cy": F.col("_oy") + F.col("_j")}).drop("_ox", "_oy", "_i", "_j")
    met = a.withColumns({"cx": F.floor(F.col("x") / side), "cy": F.floor(F.col("y") / side)}).join(wide, ["cx", "cy"])
    if exclude_self:
        met = met.where("id <> other")
    dx, dy = F.col("x") - F.col("bx"), F.col("y") - F.col("by")
    met = met.withColumn("d", F.sqrt(dx * dx + dy * dy)).where(F.col("d") <= radius)
    return met.groupBy("id").agg(F.min(F.struct("d", "other")).alias("m")).select("id", "m.other", "m.d")


def raster_lookup(points: DataFrame, raster: DataFrame, to_geo: Affine, width: int, height: int, x: str, y: str, how: str = "floor") -> DataFrame:
    """Points with the raster's bands at their pixel and ``inside``: a computed (row, col) key and a left join.

    ``raster`` has row, col and bands. A point outside the raster is kept with null bands.
    """
    col, row = pixel_of(to_geo, x, y, how)
    keyed = points.withColumns({"col": col, "row": row})
    keyed = keyed.withColumn("inside", F.coalesce((F.col("col") >= 0) & (F.col("col") < width) & (F.col("row") >= 0) & (F.col("row") < height), F.lit(False)))
    return keyed.join(raster, ["row", "col"], "left")


def ring_sides(ring: Column) -> Column:
    """The sides of a ring (array of points) as an array of (x1, y1, x2, y2); an open ring is closed."""
    nxt = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    at = lambda e, n, i: F.element_at(e[n], i).alias(f"{'xy'[i - 1]}{1 + (n == 'q')}")
    return F.transform(F.arrays_zip(ring.alias("p"), nxt.alias("q")), lambda e: F.struct(*[at(e, n, i) for n in "pq" for i in (1, 2)]))


def in_sides(x: str, y: str, sides: Column, touch: bool = True) -> Column:
    """Crossing number of the sides of a ring; on its edge counts as inside if ``touch``."""
    px, py = F.col(x), F.col(y)

    def crosses(e):
        # try_divide: a level edge is never crossed, and the sides of AND may be evaluated in any order
        return ((e["y1"] > py) != (e["y2"] > py)) & (px < e["x1"] + F.try_divide((e["x2"] - e["x1"]) * (py - e["y1"]), e["y2"] - e["y1"]))

    def on(e):
        level = (e["x2"] - e["x1"]) * (py - e["y1"]) - (e["y2"] - e["y1"]) * (px - e["x1"])
        return (level == 0) & px.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & py.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))

    inside = F.size(F.filter(sides, crosses)) % 2 == 1
    return inside | F.exists(sides, on) if touch else inside


def in_polygon(x: str, y: str, ring: Column, touch: bool = True) -> Column:
    """Crossing number of a ring (array of points); on its edge counts as inside if ``touch``."""
    return in_sides(x, y, ring_sides(ring), touch)


def in_polygons(points: DataFrame, x: str, y: str, polygons: DataFrame, ring: str, touch: bool = True) -> DataFrame:
    """Each point with each polygon that holds it, the columns of both; a point in none is left out.

    The polygons, a short table of named areas, go to every task with their sides made once; a ring's box is looked
    at before its sides.
    """
    side = lambda i: F.transform(ring, lambda p: F.element_at(p, i))
    boxes = {"_west": F.array_min(side(1)), "_east": F.array_max(side(1)), "_south": F.array_min(side(2)), "_north": F.array_max(side(2))}
    near = F.col(x).between(F.col("_west"), F.col("_east")) & F.col(y).between(F.col("_south"), F.col("_north"))
    made = {**boxes, "_sides": ring_sides(F.col(ring))}
    return points.join(F.broadcast(polygons.withColumns(made)), near & in_sides(x, y, F.col("_sides"), touch)).drop(*made)


def in_extent(x: str, y: str, west: float, south: float, east: float, north: float) -> Column:
    """Inside a box, all four sides included; false for nulls."""
    return F.coalesce(F.col(x).between(west, east) & F.col(y).between(south, north), F.lit(False))


def without_excluded(points: DataFrame, excluded: DataFrame, to_geo: Affine, width: int, height: int, x: str, y: str) -> DataFrame:
    """Points inside the raster whose pixel is not among ``excluded`` (row, col); pixel_x and pixel_y are set to the pixel."""
    col, row = pixel_of(to_geo, x, y)
    keyed = points.withColumns({"pixel_x": col, "pixel_y": row})
    keyed = keyed.where(F.col("pixel_x").between(0, width - 1) & F.col("pixel_y").between(0, height - 1))
    out = excluded.select(F.col("col").alias("pixel_x"), F.col("row").alias("pixel_y")).distinct()
    return keyed.join(out, ["pixel_x", "pixel_y"], "left_anti")


def stem(c: str, suffixes: Sequence[str] = ()) -> Column:
    """The file name without folder, extension and the first matching suffix."""
    name = F.regexp_replace(F.regexp_extract(F.col(c), r"([^/\\]*)$", 1), r"\.[^.]*$", "")
    return F.regexp_replace(name, "(" + "|".join(suffixes) + ")$", "") if suffixes else name


def match_by_stem(left: DataFrame, left_path: str, right: DataFrame, right_path: str, suffixes: Sequence[str] = ()) -> DataFrame:
    """(stem, left_path, right_path): pairs of files of one stem; a stem without a partner is left out."""
    a = left.select(stem(left_path).alias("stem"), F.col(left_path).alias("left_path"))
    b = right.select(stem(right_path, suffixes).alias("stem"), F.col(right_path).alias("right_path"))
    return a.join(b, "stem")


def zip_shortest(*arrays: str) -> Column:
    """Arrays by position as far as the shortest reaches."""
    n = F.least(*[F.size(a) for a in arrays]) if len(arrays) > 1 else F.size(arrays[0])
    return F.arrays_zip(*[F.slice(F.col(a), F.lit(1), n).alias(a) for a in arrays])


def keep_visible(dimension: DataFrame, facts: DataFrame, key: str, condition: Column) -> DataFrame:
    """Rows of a dimension that still have a fact after a filter."""
    return dimension.join(facts.where(condition).select(key).where(F.col(key).isNotNull()), key, "left_semi")
