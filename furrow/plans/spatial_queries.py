"""Queries of spatial joins, sectors, rasters, tiles and masks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.functions.geo import pixel_of
from furrow.functions.rounding import half_away
from furrow.functions.text import plain_numbers
from furrow.operators import aggregates, joins, raster, sectors, tiles
from furrow.operators.sectors import simplified_ring
from furrow.plans.base import PIXELS, PLANTS, POSITIONS, SAMPLES, SCENE, Registry, pixels, plants, positions, samples
from furrow.plans.crops import table

R = Registry()
_ROUND = lambda c, n=6: half_away(c, n)
#: Usual spacing of plants and of samples in metres, the first square side of the neighbour search.
PLANT_CELL, SAMPLE_CELL = 2.0, 8.0


def _near(a: str, b: str, k: int, value: str, exclude: bool = True) -> str:
    """Nearest rows by brute force in SQL: id, n = list of (d, other, v), in order."""
    cond = "WHERE a.id <> b.id" if exclude else ""
    return f"SELECT a.id, min({{'d': sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 'other': b.id, 'v': b.{value}}}, {k}) AS n FROM {a} a, {b} b {cond} GROUP BY a.id"


@R.add(f"""WITH s AS {SAMPLES}, n AS ({_near('s', 's', 8, 'ndvi')}) SELECT s.id, round(0.7 * ndvi + 0.3 * list_avg(list_transform(n, lambda e: e.v)), 9) AS smoothed FROM s JOIN n USING (id)""")
def knn_smooth_excl(spark: SparkSession, d: str) -> DataFrame:
    """Smoothing over the 8 nearest others that have a value."""
    return joins.smooth_by_neighbours(samples(spark, d), "id", "x", "y", "ndvi", 8, SAMPLE_CELL).select("id", _ROUND("smoothed", 9).alias("smoothed"))


@R.add(f"""WITH s AS {SAMPLES}, n AS ({_near('s', 's', 9, 'stress_idx', False)}), m AS (SELECT id, list_avg(list_transform(n, lambda e: e.v)) AS m, len(list_filter(n, lambda e: e.v IS NOT NULL)) AS c FROM n)
  SELECT s.id, round(CASE WHEN c > 1 THEN 0.7 * stress_idx + 0.3 * m ELSE stress_idx END, 9) AS smoothed FROM s JOIN m USING (id) WHERE stress_idx IS NOT NULL""")
def knn_smooth_incl(spark: SparkSession, d: str) -> DataFrame:
    """Smoothing over the 9 nearest rows, itself among them, nulls dropped afterwards."""
    return joins.smooth_by_neighbours(samples(spark, d), "id", "x", "y", "stress_idx", 8, SAMPLE_CELL, include_self=True).select("id", _ROUND("smoothed", 9).alias("smoothed"))


@R.add(f"""WITH s AS {SAMPLES}, p AS (SELECT plant_id AS id, x, y FROM {POSITIONS} WHERE ndvi IS NULL), n AS ({_near('p', 's', 8, 'ndvi')})
  SELECT id, round(list_avg(list_transform(n, lambda e: e.v)), 9) AS mean, round(list_avg(list_transform(n, lambda e: e.d)), 4) AS distance FROM n""")
def knn_context(spark: SparkSession, d: str) -> DataFrame:
    """Mean value and distance of the 8 nearest measured samples for each plant without ndvi."""
    gaps = positions(spark, d).where("ndvi IS NULL").select(F.col("plant_id").alias("id"), "x", "y")
    return joins.neighbour_context(gaps, samples(spark, d), "ndvi", 8, SAMPLE_CELL).select("id", _ROUND("mean", 9).alias("mean"), half_away("distance", 4).alias("distance"))


@R.add(f"""WITH s AS {SAMPLES}, p AS (SELECT plant_id AS id, x, y, floor(x / 0.5::DOUBLE) AS cx, floor(y / 0.5::DOUBLE) AS cy FROM {POSITIONS}), b AS (SELECT s.*, floor(x / 0.5::DOUBLE) + i AS cx, floor(y / 0.5::DOUBLE) + j AS cy FROM s, (VALUES (-1), (0), (1)) u(i), (VALUES (-1), (0), (1)) v(j)),
  m AS (SELECT p.id, b.id AS other, sqrt((p.x - b.x) * (p.x - b.x) + (p.y - b.y) * (p.y - b.y)) AS d FROM p JOIN b USING (cx, cy))
  SELECT id, arg_min(other, (d, other)) AS other, round(min(d), 4) AS d FROM m WHERE d <= 0.5 GROUP BY id""")
def nearest_within_radius(spark: SparkSession, d: str) -> DataFrame:
    """The nearest index sample at most half a metre from each plant."""
    left = positions(spark, d).select(F.col("plant_id").alias("id"), "x", "y")
    return joins.nearest_within(left, samples(spark, d), 0.5).select("id", "other", half_away("d", 4).alias("d"))


_DETECTED = "(SELECT DISTINCT plant_id AS id, geo_x AS x, geo_y AS y FROM plants_with_ids WHERE geo_x BETWEEN 200000 AND 800000 AND geo_y BETWEEN 1000000 AND 1600000)"


@R.add(f"""WITH p AS (SELECT plant_id AS id, x, y, floor(x / 0.5::DOUBLE) AS cx, floor(y / 0.5::DOUBLE) AS cy FROM {POSITIONS}), b AS (SELECT s.*, floor(x / 0.5::DOUBLE) + i AS cx, floor(y / 0.5::DOUBLE) + j AS cy FROM {_DETECTED} s, (VALUES (-1), (0), (1)) u(i), (VALUES (-1), (0), (1)) v(j)),
  m AS (SELECT p.id, b.id AS other, sqrt((p.x - b.x) * (p.x - b.x) + (p.y - b.y) * (p.y - b.y)) AS d FROM p JOIN b USING (cx, cy) WHERE p.id <> b.id)
  SELECT id, arg_min(other, (d, other)) AS other, round(min(d), 4) AS d FROM m WHERE d <= 0.5 GROUP BY id""")
def nearest_detection(spark: SparkSession, d: str) -> DataFrame:
    """The nearest other detected plant at most half a metre from each plant."""
    left = positions(spark, d).select(F.col("plant_id").alias("id"), "x", "y")
    found = table(spark, d, "plants_with_ids").where("geo_x BETWEEN 200000 AND 800000 AND geo_y BETWEEN 1000000 AND 1600000")
    right = found.select(F.col("plant_id").alias("id"), F.col("geo_x").alias("x"), F.col("geo_y").alias("y")).distinct()
    return joins.nearest_within(left, right, 0.5, exclude_self=True).select("id", "other", half_away("d", 4).alias("d"))


@R.add(f"""WITH s AS {SAMPLES}, n AS ({_near('s', 's', 7, 'ndvi')}) SELECT median(round(n[1].d, 6)) AS nearest, quantile_cont(round(n[7].d, 6), 0.9) AS kth FROM n""")
def spacing_estimate(spark: SparkSession, d: str) -> DataFrame:
    """Median nearest distance and the 0.9 quantile of the 8th column's, itself in the first."""
    return sectors.spacing(samples(spark, d), "id", "x", "y", 8, SAMPLE_CELL)


_RASTER = f"(SELECT floor((1104000.0 - y) / 2.0::DOUBLE)::INT AS row, floor((x - 400000.0) / 2.0::DOUBLE)::INT AS col, round(avg(ndvi), 9) AS band FROM {SAMPLES} GROUP BY ALL)"
_GRID = (2.0, 0.0, 400000.0, 0.0, -2.0, 1104000.0)


def _raster(spark: SparkSession, d: str) -> DataFrame:
    col, row = pixel_of(_GRID, "x", "y")
    return samples(spark, d).withColumns({"row": row, "col": col}).groupBy("row", "col").agg(half_away(F.avg("ndvi"), 9).alias("band"))


@R.add(f"""SELECT p.plant_id, r.band, p.row >= 0 AND p.row < 3000 AND p.col >= 0 AND p.col < 3400 AS inside FROM (SELECT plant_id, floor((1104000.0 - y) / 2.0::DOUBLE)::INT AS row, floor((x - 400000.0) / 2.0::DOUBLE)::INT AS col FROM {POSITIONS}) p LEFT JOIN {_RASTER} r ON r.row = p.row AND r.col = p.col""")
def raster_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The raster's value at each plant's pixel; points outside are kept."""
    rows = joins.raster_lookup(positions(spark, d).select("plant_id", "x", "y"), _raster(spark, d), _GRID, 3400, 3000, "x", "y")
    return rows.select("plant_id", "band", "inside")


def _canopy(spark: SparkSession, d: str, grid: tuple = _GRID) -> DataFrame:
    """Every pixel of each plant's box, as spans that lie in one pixel of the raster: x, y of the first, and their number n."""
    w = table(spark, d, "plants_with_ids").where("sector_label <> 'NOISE' OR sector_label IS NULL").where("mask_file IS NOT NULL")
    w = w.select("plant_id", "bbox_x", "bbox_y", "bbox_width", "bbox_height").distinct()
    ground = {"x": lambda p: F.lit(SCENE[0]) * p + F.lit(SCENE[2]), "y": lambda p: F.lit(SCENE[4]) * p + F.lit(SCENE[5])}
    cell = {"x": lambda p: pixel_of(grid, ground["x"](p), F.lit(0.0))[0], "y": lambda p: pixel_of(grid, F.lit(0.0), ground["y"](p))[1]}

    def spans(c: str, length: str) -> Column:
        at = F.sequence(F.col(f"bbox_{c}"), F.col(f"bbox_{c}") + F.greatest(F.col(length), F.lit(1)) - 1)
        cells = F.transform(at, cell[c])
        return F.explode(F.transform(F.array_distinct(cells), lambda k: F.struct((F.col(f"bbox_{c}") + F.array_position(cells, k) - 1).alias("at"), F.size(F.filter(cells, lambda v: v == k)).alias("n"))))

    px = w.withColumn("h", spans("x", "bbox_width")).withColumn("v", spans("y", "bbox_height"))
    return px.select("plant_id", ground["x"](F.col("h.at")).alias("x"), ground["y"](F.col("v.at")).alias("y"), (F.col("h.n").cast("long") * F.col("v.n")).alias("n"))


_CANOPY = f"""(SELECT plant_id, {SCENE[0]!r}::DOUBLE * px + {SCENE[2]!r}::DOUBLE AS x, {SCENE[4]!r}::DOUBLE * py + {SCENE[5]!r}::DOUBLE AS y FROM (SELECT plant_id, px, unnest(range(bbox_y, bbox_y + greatest(bbox_height, 1))) AS py
    FROM (SELECT plant_id, bbox_y, bbox_height, unnest(range(bbox_x, bbox_x + greatest(bbox_width, 1))) AS px FROM (SELECT DISTINCT plant_id, bbox_x, bbox_y, bbox_width, bbox_height FROM plants_with_ids WHERE sector_label IS DISTINCT FROM 'NOISE' AND mask_file IS NOT NULL))))"""


@R.add(f"""WITH c AS (SELECT plant_id, floor(({_GRID[5]!r}::DOUBLE - y) / 2.0::DOUBLE)::INT AS row, floor((x - 400000.0) / 2.0::DOUBLE)::INT AS col FROM {_CANOPY}), j AS (SELECT c.plant_id, band, band IS NULL OR band >= 0.2 AS keep, band IS NOT NULL AS inside FROM c LEFT JOIN {_RASTER} r ON r.row = c.row AND r.col = c.col)
  SELECT plant_id, round(avg(CASE WHEN keep AND inside THEN band END), 3) AS value, round(1 - avg(keep::INT), 3) AS soil_fraction, count(*) FILTER (keep AND inside) AS canopy_px FROM j GROUP BY plant_id""")
def canopy_pixel_aggregate(spark: SparkSession, d: str) -> DataFrame:
    """Canopy pixels looked up in the raster, gated by soil, averaged by plant."""
    j = joins.raster_lookup(_canopy(spark, d), _raster(spark, d), _GRID, 3400, 3000, "x", "y")
    keep = F.col("band").isNull() | (F.col("band") >= 0.2)
    return aggregates.canopy_aggregate(j.withColumn("dist", F.lit(0.0)), "plant_id", "band", "dist", keep, F.col("band").isNotNull(), F.col("n")).select("plant_id", "value", "soil_fraction", "canopy_px")


_FINE = (0.5, 0.0, 400000.0, 0.0, -0.5, 1104000.0)


@R.add(f"""WITH b AS (SELECT floor((1104000.0 - y) / 0.5::DOUBLE)::INT AS row, floor((x - 400000.0) / 0.5::DOUBLE)::INT AS col, round(avg(osavi), 9) AS band FROM {POSITIONS} WHERE osavi IS NOT NULL GROUP BY ALL),
  c AS (SELECT plant_id, floor((1104000.0 - y) / 0.5::DOUBLE)::INT AS row, floor((x - 400000.0) / 0.5::DOUBLE)::INT AS col FROM {_CANOPY}),
  j AS (SELECT c.plant_id, band, band IS NULL OR band >= 0.2 AS keep, band IS NOT NULL AS inside FROM c LEFT JOIN b ON b.row = c.row AND b.col = c.col)
  SELECT plant_id, round(avg(CASE WHEN keep AND inside THEN band END), 9) AS value, format('{{:.3f}}', 1 - avg(keep::INT))::DOUBLE AS soil_fraction, count(*) FILTER (keep AND inside) AS canopy_px FROM j GROUP BY plant_id""")
def canopy_osavi_aggregate(spark: SparkSession, d: str) -> DataFrame:
    """As canopy_pixel_aggregate, over half-metre means of the plants' own osavi, which the boxes meet at every size."""
    col, row = pixel_of(_FINE, "x", "y")
    grid = positions(spark, d).where("osavi IS NOT NULL").withColumns({"row": row, "col": col}).groupBy("row", "col").agg(half_away(F.avg("osavi"), 9).alias("band"))
    j = joins.raster_lookup(_canopy(spark, d, _FINE), grid, _FINE, 13600, 12000, "x", "y")
    keep = F.col("band").isNull() | (F.col("band") >= 0.2)
    return aggregates.canopy_aggregate(j.withColumn("dist", F.lit(0.0)), "plant_id", "band", "dist", keep, F.col("band").isNotNull(), F.col("n")).select("plant_id", half_away("raw_value", 9).alias("value"), "soil_fraction", "canopy_px")


@R.add(f"""WITH n AS (SELECT *, row_number() OVER (PARTITION BY sector_id ORDER BY plant_id) - 1 AS i, count(*) OVER (PARTITION BY sector_id) AS n FROM {PLANTS} WHERE sector_id >= 0)
  SELECT sector_id, count(*) AS kept FROM n WHERE n <= 200 OR (ceil(i / ((n - 1) / 199.0::DOUBLE) - 1e-9) < 200 AND floor(ceil(i / ((n - 1) / 199.0::DOUBLE) - 1e-9) * ((n - 1) / 199.0::DOUBLE) + 1e-9) = i) GROUP BY sector_id""")
def systematic_subsample(spark: SparkSession, d: str) -> DataFrame:
    """At most 200 evenly spaced rows of each group."""
    rows = plants(spark, d).where("sector_id >= 0").select("sector_id", "plant_id")
    return sectors.subsampled(rows, ["sector_id"], "plant_id", 200).groupBy("sector_id").agg(F.count(F.lit(1)).alias("kept"))


_EDGES = "(SELECT zone_id, ring[i][1] AS x1, ring[i][2] AS y1, ring[i % len(ring) + 1][1] AS x2, ring[i % len(ring) + 1][2] AS y2 FROM (SELECT zone_id, ring, unnest(range(1, len(ring) + 1)) AS i FROM boundary_zones))"


@R.add(f"""WITH h AS (SELECT plant_id, zone_id FROM {POSITIONS} p JOIN {_EDGES} e ON (y1 > y) <> (y2 > y) AND x < x1 + (x2 - x1) * (y - y1) / (y2 - y1) GROUP BY plant_id, zone_id HAVING count(*) % 2 = 1) SELECT plant_id, zone_id FROM h""")
def point_in_polygon(spark: SparkSession, d: str) -> DataFrame:
    """Plants within each zone of boundary_zones, by crossing number (J7, R5); a plant in several zones has a row for each."""
    zones = table(spark, d, "boundary_zones").select("zone_id", "ring")
    return joins.in_polygons(positions(spark, d).select("plant_id", "x", "y"), "x", "y", zones, "ring").select("plant_id", "zone_id")


@R.add(f"SELECT plant_id, coalesce(x BETWEEN 401000 AND 405000 AND y BETWEEN 1100000 AND 1100300, false) AS in_orthomosaic FROM {PLANTS}")
def extent_flag(spark: SparkSession, d: str) -> DataFrame:
    """Inside the scene's box, sides included."""
    return plants(spark, d).select("plant_id", joins.in_extent("x", "y", 401000, 1100000, 405000, 1100300).alias("in_orthomosaic"))


@R.add(f"""WITH k AS (SELECT plant_id, floor((x - 400000.0) / 2.0::DOUBLE)::INT AS pixel_x, floor((1104000.0 - y) / 2.0::DOUBLE)::INT AS pixel_y FROM {POSITIONS})
  SELECT k.* FROM k WHERE pixel_x BETWEEN 0 AND 3399 AND pixel_y BETWEEN 0 AND 2999 AND NOT EXISTS (SELECT 1 FROM {_RASTER} r WHERE r.row = k.pixel_y AND r.col = k.pixel_x AND r.band < 0.5)""")
def exclusion_antijoin(spark: SparkSession, d: str) -> DataFrame:
    """Plants whose pixel isn't excluded."""
    return joins.without_excluded(positions(spark, d).select("plant_id", "x", "y"), _raster(spark, d).where("band < 0.5"), _GRID, 3400, 3000, "x", "y").select("plant_id", "pixel_x", "pixel_y")


@R.add(f"""WITH m AS (SELECT sector_id AS old, round(avg(y), 6) AS my, round(avg(x), 6) AS mx FROM {POSITIONS} WHERE sector_id >= 0 GROUP BY sector_id) SELECT old, row_number() OVER (ORDER BY my DESC, mx, old) - 1 AS sector FROM m""")
def sector_relabel(spark: SparkSession, d: str) -> DataFrame:
    """Sectors renumbered by position."""
    return sectors.relabelled(positions(spark, d), "sector_id", "x", "y").select("old", F.col("sector").cast("long").alias("sector"))


_TOL = f"""WITH h AS (SELECT sector_id, round(y, 3) AS v, count(*) AS c FROM {POSITIONS} WHERE sector_id >= 0 GROUP BY ALL), g AS (SELECT *, least(v - lag(v) OVER w, lead(v) OVER w - v) AS gap FROM h WINDOW w AS (PARTITION BY sector_id ORDER BY v))"""


@R.add(f"{_TOL} SELECT g.sector_id, round(median(gap) * 1.5, 6) AS tolerance FROM g, range(c) WHERE gap IS NOT NULL GROUP BY g.sector_id")
def axis_tolerance(spark: SparkSession, d: str) -> DataFrame:
    """1.5 times the median nearest gap, each row counted."""
    rows = positions(spark, d).where("sector_id >= 0").withColumn("y", half_away("y", 3))
    return sectors.axis_tolerance(rows, ["sector_id"], "y").select("sector_id", _ROUND("tolerance").alias("tolerance"))


_FOLD = f"""WITH RECURSIVE p AS (SELECT plant_id AS id, sector_id, round(y, 3) AS minor, round(x, 3) AS major FROM {POSITIONS} WHERE sector_id >= 0), o AS (SELECT *, row_number() OVER (PARTITION BY sector_id ORDER BY minor DESC, major, id) AS n FROM p),
  f AS (SELECT id, sector_id, n, major, minor AS anchor, 1 AS r FROM o WHERE n = 1 UNION ALL SELECT o.id, o.sector_id, o.n, o.major, CASE WHEN abs(f.anchor - o.minor) > 0.2::DOUBLE THEN o.minor ELSE f.anchor END, f.r + (abs(f.anchor - o.minor) > 0.2::DOUBLE)::INT FROM f JOIN o ON o.sector_id = f.sector_id AND o.n = f.n + 1)"""


@R.add(f"{_FOLD} SELECT id, sector_id AS sector, r AS row_index, (row_number() OVER (PARTITION BY sector_id, r ORDER BY major, id))::INT AS col_index FROM f")
def row_column_assignment(spark: SparkSession, d: str) -> DataFrame:
    """Rows by an anchored fold, columns inside a row."""
    p = positions(spark, d).where("sector_id >= 0").select("plant_id", "sector_id", half_away("y", 3).alias("minor"), half_away("x", 3).alias("major"), F.lit(0.2).alias("tol"))
    return sectors.row_column_numbers(p, "plant_id", "sector_id", "minor", "major", "tol")


_FRAME = f"""WITH p AS (SELECT plant_id, sector_id, x, y FROM {POSITIONS} WHERE sector_id >= 0), m AS (SELECT sector_id, count(*) AS n, avg(x) AS cx, avg(y) AS cy, covar_pop(x, x) AS sxx, covar_pop(x, y) AS sxy, covar_pop(y, y) AS syy FROM p GROUP BY sector_id HAVING count(*) >= 3),
  h AS (SELECT *, (sxx - syy) / 2 AS half, sqrt(((sxx - syy) / 2) ** 2 + sxy ** 2) AS root FROM m), v AS (SELECT *, CASE WHEN half >= 0 THEN half + root ELSE sxy END AS vx, CASE WHEN half >= 0 THEN sxy ELSE root - half END AS vy FROM h),
  u AS (SELECT *, vx / sqrt(vx ** 2 + vy ** 2) AS ux, vy / sqrt(vx ** 2 + vy ** 2) AS uy FROM v), f AS (SELECT sector_id, n, cx, cy, ux * s AS ax, uy * s AS ay FROM (SELECT *, CASE WHEN CASE WHEN abs(ux) >= abs(uy) THEN ux ELSE uy END < 0 THEN -1 ELSE 1 END AS s FROM u))"""


@R.add(f"{_FRAME} SELECT sector_id, n, round(cx, 4) AS cx, round(cy, 4) AS cy, round(max((x - cx) * ax + (y - cy) * ay) - min((x - cx) * ax + (y - cy) * ay), 3) AS extent FROM f JOIN p USING (sector_id) GROUP BY ALL")
def pca_sector_frame(spark: SparkSession, d: str) -> DataFrame:
    """Centre and principal axes in closed form, extent along the axis."""
    f = aggregates.sector_frames(positions(spark, d), "sector_id", "x", "y")
    return f.select("sector_id", "n", half_away("cx", 4).alias("cx"), half_away("cy", 4).alias("cy"), half_away(F.col("major_max") - F.col("major_min"), 3).alias("extent"))


@R.add(f"""{_FRAME}, e AS (SELECT sector_id, any_value(cx) AS cx, any_value(cy) AS cy, any_value(ax) AS ax, any_value(ay) AS ay, min((x - cx) * ax + (y - cy) * ay) AS lo, max((x - cx) * ax + (y - cy) * ay) AS hi, quantile_cont(round((y - cy) * ax - (x - cx) * ay, 3), 0.05) AS q5, quantile_cont(round((y - cy) * ax - (x - cx) * ay, 3), 0.95) AS q95 FROM f JOIN p USING (sector_id) GROUP BY sector_id),
  g AS (SELECT n.plant_id, e.sector_id, greatest(lo - ((n.x - cx) * ax + (n.y - cy) * ay), (n.x - cx) * ax + (n.y - cy) * ay - hi, 0) AS gm, greatest(q5 - ((n.y - cy) * ax - (n.x - cx) * ay), (n.y - cy) * ax - (n.x - cx) * ay - q95, 0) AS gn FROM {POSITIONS} n, e WHERE n.sector_id = -1)
  SELECT plant_id AS id, arg_min(sector_id, ((gn / 3.0) ** 2 + (gm / 6.0) ** 2, sector_id)) AS sector FROM g WHERE gm <= 6 AND gn <= 3 GROUP BY plant_id""")
def noise_rescue(spark: SparkSession, d: str) -> DataFrame:
    """The best sector for each noise plant within both gap limits."""
    p = positions(spark, d)
    frames = aggregates.sector_frames(p, "sector_id", "x", "y").withColumnRenamed("sector_id", "sector")
    return sectors.rescued_noise(p.where("sector_id = -1"), frames, "plant_id", "x", "y", 3.0, 6.0)


@R.add(f"""WITH RECURSIVE q AS (SELECT sector_id, x, y, count(*) OVER (PARTITION BY sector_id) AS n FROM {POSITIONS} WHERE sector_id >= 0), p AS (SELECT DISTINCT * FROM q WHERE n >= 3),
  o AS (SELECT sector_id, side, x, y, row_number() OVER (PARTITION BY sector_id, side ORDER BY x * side, y * side) AS i FROM p, (VALUES (1), (-1)) s(side)),
  c AS (SELECT DISTINCT sector_id, side, 1::BIGINT AS i, []::STRUCT(x DOUBLE, y DOUBLE)[] AS st FROM o
    UNION ALL SELECT sector_id, side, CASE WHEN pop THEN i ELSE i + 1 END, CASE WHEN pop THEN st[1:len(st) - 1] ELSE list_append(st, {{'x': x, 'y': y}}) END
      FROM (SELECT c.*, o.x, o.y, len(st) > 1 AND (st[-1].x - st[-2].x) * (o.y - st[-2].y) - (st[-1].y - st[-2].y) * (o.x - st[-2].x) <= 0 AS pop FROM c JOIN o USING (sector_id, side, i))),
  e AS (SELECT sector_id, side, arg_max(st, i) AS st, max(i) AS i FROM (SELECT sector_id, side, i, arg_min(st, len(st)) AS st FROM c GROUP BY ALL) GROUP BY ALL),
  h AS (SELECT sector_id, list_concat(any_value(st[1:len(st) - 1]) FILTER (side = 1), any_value(st[1:len(st) - 1]) FILTER (side = -1)) AS h FROM e GROUP BY sector_id),
  w AS (SELECT sector_id, min(n) AS n, min(x) - 0.5::DOUBLE AS x0, max(x) + 0.5::DOUBLE AS x1, min(y) - 0.5::DOUBLE AS y0, max(y) + 0.5::DOUBLE AS y1 FROM p GROUP BY sector_id),
  r AS (SELECT sector_id AS sector, n, CASE WHEN len(h) >= 3 THEN h ELSE [{{'x': x0, 'y': y0}}, {{'x': x1, 'y': y0}}, {{'x': x1, 'y': y1}}, {{'x': x0, 'y': y1}}] END AS h FROM h JOIN w USING (sector_id))
  SELECT sector, n, i::INT AS corner, h[i + 1].x AS x, h[i + 1].y AS y FROM (SELECT *, unnest(range(len(h))) AS i FROM r)""")
def convex_hull(spark: SparkSession, d: str) -> DataFrame:
    """Corners of the convex hull of each sector, counter-clockwise."""
    h = sectors.sector_hulls(positions(spark, d), "sector_id", "x", "y").select("sector", "n", F.posexplode("hull").alias("corner", "q"))
    return h.select("sector", "n", "corner", F.col("q")[0].alias("x"), F.col("q")[1].alias("y"))


# -- tiles and masks --------------------------------------------------------------------------------
_STARTS = lambda n: f"(SELECT p, least(p + 640, {n}) AS stop, lead(p, 1, {n}) OVER (ORDER BY p) AS own, row_number() OVER (ORDER BY p) - 1 AS i FROM (SELECT unnest(range(0, {n} - 640 + 1, 576)) AS p UNION SELECT {n} - 640))"


@R.add(f"""WITH xs AS {_STARTS(14929)}, ys AS {_STARTS(22012)} SELECT (ys.i * (SELECT count(*) FROM xs) + xs.i)::INT AS tile_id, xs.p::INT AS x0, ys.p::INT AS y0, xs.stop::INT AS x1, ys.stop::INT AS y1, xs.p::INT AS own_x0, xs.own::INT AS own_x1, ys.p::INT AS own_y0, ys.own::INT AS own_y1 FROM xs, ys""")
def tile_grid(spark: SparkSession, d: str) -> DataFrame:
    """The tile plan of a scene with ownership bounds: 1,014 tiles."""
    return tiles.tile_grid(spark, 14929, 22012, 640, 0.10)


TILE = 640
_SCENE = "SELECT max(regexp_extract(image, '_(\\d+)\\.png', 1)::INT) + 640 AS w, max(regexp_extract(image, 'tile_(\\d+)_', 1)::INT) + 640 AS h FROM detections WHERE regexp_matches(image, 'tile_\\d+_\\d+\\.png')"
_SIDES = "WITH " + ", ".join(f"{n} AS {_STARTS(f'(SELECT {c} FROM ({_SCENE}))')}" for n, c in (("xs", "w"), ("ys", "h")))
_CENTRES = """(SELECT image, (d.d).detection_id, (d.d).confidence, len((d.d).polygon) AS corners, regexp_extract(image, '_(\\d+)\\.png', 1)::INT + ((d.d).bbox_xyxy[1] + (d.d).bbox_xyxy[3]) / 2 AS x, regexp_extract(image, 'tile_(\\d+)_', 1)::INT + ((d.d).bbox_xyxy[2] + (d.d).bbox_xyxy[4]) / 2 AS y
    FROM (SELECT DISTINCT image, unnest(detections) AS d FROM detections) d)""".replace("(d.d).", "d.d.")


def _centres(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "detections").select("image", F.explode("detections").alias("d")).distinct()
    mid = lambda i: (F.col("d.bbox_xyxy")[i] + F.col("d.bbox_xyxy")[i + 2]) / 2
    return x.select("image", "d.detection_id", "d.confidence", F.size("d.polygon").alias("corners"), (F.regexp_extract("image", r"_(\d+)\.png", 1).cast("int") + mid(0)).alias("x"), (F.regexp_extract("image", r"tile_(\d+)_", 1).cast("int") + mid(1)).alias("y"))


def _scene(spark: SparkSession, d: str) -> tuple[int, int]:
    """Width and height of the scene: as far as the images' tiles reach; one tile without any."""
    far = lambda pattern: F.max(F.regexp_extract("image", pattern, 1).try_cast("int")) + TILE
    w, h = table(spark, d, "detections").where(F.col("image").rlike(r"tile_\d+_\d+\.png")).agg(far(r"_(\d+)\.png"), far(r"tile_(\d+)_")).first()
    return w or TILE, h or TILE


@R.add(f"""{_SIDES} SELECT image, detection_id, (ys.i * (SELECT count(*) FROM xs) + xs.i)::INT AS tile_id FROM {_CENTRES} c JOIN xs ON c.x >= xs.p AND c.x < xs.own JOIN ys ON c.y >= ys.p AND c.y < ys.own""")
def tile_ownership(spark: SparkSession, d: str) -> DataFrame:
    """The tile that owns each detection's centre, by arithmetic in place of a range join."""
    return tiles.owned_detections(_centres(spark, d), *_scene(spark, d), TILE, 0.10, "x", "y").select("image", "detection_id", "tile_id")


@R.add(f"""{_SIDES}, g AS (SELECT (ys.i * (SELECT count(*) FROM xs) + xs.i)::INT AS tile_id, xs.p AS x0, ys.p AS y0, xs.own AS ox, ys.own AS oy FROM xs, ys),
  n AS (SELECT tile_id, count(*) AS detections, count(*) FILTER (corners >= 3) AS masks FROM g JOIN {_CENTRES} c ON c.x >= x0 AND c.x < ox AND c.y >= y0 AND c.y < oy WHERE confidence >= 0.25 GROUP BY tile_id)
  SELECT tile_id, x0::INT AS x0, y0::INT AS y0, coalesce(detections, 0) AS detections, coalesce(masks, 0) AS masks FROM g LEFT JOIN n USING (tile_id)""")
def tile_summary(spark: SparkSession, d: str) -> DataFrame:
    """Detections and masks of every tile, empty ones too."""
    w, h = _scene(spark, d)
    owned = tiles.owned_detections(_centres(spark, d), w, h, TILE, 0.10, "x", "y")
    return tiles.tile_summary(tiles.tile_grid(spark, w, h, TILE, 0.10), owned, F.col("confidence") >= 0.25, F.col("corners") >= 3)


def _simple_rings(rings: pd.Series) -> pd.Series:
    return rings.map(lambda r: None if r is None else simplified_ring(list(r), 2.0))


_RUNS = f"(SELECT row, min(col) AS first, max(col) AS last FROM (SELECT row, col, col - row_number() OVER (PARTITION BY row ORDER BY col) AS g FROM (SELECT DISTINCT row, col FROM {PIXELS})) GROUP BY row, g)"


@R.add(f"SELECT row, first, last FROM {_RUNS}")
def mask_rle(spark: SparkSession, d: str) -> DataFrame:
    """Runs of set pixels."""
    return tiles.run_lengths(pixels(spark, d), ["row"], "col")


@R.add(f"SELECT row, n, min(col) AS first, max(col) AS last FROM (SELECT row, col, n, col - row_number() OVER (PARTITION BY row, n ORDER BY col) AS g FROM (SELECT row, col, count(*) AS n FROM {PIXELS} GROUP BY ALL)) GROUP BY row, n, g")
def mask_rle_counts(spark: SparkSession, d: str) -> DataFrame:
    """Runs of equal values."""
    counted = pixels(spark, d).groupBy("row", "col").agg(F.count(F.lit(1)).alias("n"))
    return tiles.run_lengths(counted, ["row"], "col", "n").select("row", "n", "first", "last")


@R.add(f"SELECT row, col, max(area_px) AS largest, sum(area_px)::BIGINT AS total, count(*) AS masks FROM {PIXELS} GROUP BY ALL")
def mask_stitch(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping masks merged: maximum, sum, number."""
    return tiles.stitch(pixels(spark, d), "area_px")


def _components(reach: str) -> str:
    return f"""WITH RECURSIVE p AS (SELECT DISTINCT row, col FROM {PIXELS}), e AS (SELECT a.row AS r1, a.col AS c1, b.row AS r2, b.col AS c2 FROM p a JOIN (SELECT row + i AS nr, col + j AS nc, row, col FROM p, (VALUES (-1), (0), (1)) s(i), (VALUES (-1), (0), (1)) t(j) WHERE {reach}) b ON a.row = b.nr AND a.col = b.nc),
  t AS (SELECT row AS r0, col AS c0, row, col FROM p UNION SELECT t.r0, t.c0, e.r2, e.c2 FROM t JOIN e ON e.r1 = t.row AND e.c1 = t.col), l AS (SELECT r0 AS row, c0 AS col, min((row, col)) AS label FROM t GROUP BY r0, c0),
  s AS (SELECT label, count(*) AS area_px, min(col) AS bbox_x, min(row) AS bbox_y, max(col) - min(col) + 1 AS bbox_width, max(row) - min(row) + 1 AS bbox_height, round(sum(col) / count(*)::DOUBLE, 6) AS centroid_x, round(sum(row) / count(*)::DOUBLE, 6) AS centroid_y FROM l GROUP BY label)"""


_STATS = ("area_px", "bbox_x", "bbox_y", "bbox_width", "bbox_height")


@R.add(f"{_components('true')} SELECT row_number() OVER (ORDER BY label) AS instance_id, area_px, bbox_x, bbox_y, bbox_width, bbox_height, centroid_x, centroid_y FROM s WHERE area_px >= 3")
def connected_components(spark: SparkSession, d: str) -> DataFrame:
    """Instances of at least three pixels joined by sides or corners, renumbered."""
    c = raster.renumbered(raster.component_stats(raster.labelled_runs(pixels(spark, d), 8), 3))
    return c.select("instance_id", *_STATS, _ROUND("centroid_x").alias("centroid_x"), _ROUND("centroid_y").alias("centroid_y"))


@R.add(f"{_components('i = 0 OR j = 0')} SELECT area_px, bbox_x, bbox_y, round(area_px * 0.25::DOUBLE, 4) AS ground_area, centroid_x, centroid_y FROM s")
def connected_regions(spark: SparkSession, d: str) -> DataFrame:
    """Regions joined by sides, with area in ground units and centroid (R2)."""
    c = raster.component_stats(raster.labelled_runs(pixels(spark, d), 4))
    return c.select("area_px", "bbox_x", "bbox_y", half_away(F.col("area_px") * 0.25, 4).alias("ground_area"), _ROUND("centroid_x").alias("centroid_x"), _ROUND("centroid_y").alias("centroid_y"))


@R.add(f"{_components('true')} SELECT area_px, bbox_x, bbox_y, bbox_width, bbox_height FROM s ORDER BY area_px DESC, label LIMIT 1")
def largest_region(spark: SparkSession, d: str) -> DataFrame:
    """The region of the greatest area, the first of equals."""
    return raster.largest(raster.component_stats(raster.labelled_runs(pixels(spark, d), 8))).select(*_STATS)


_N5 = "(VALUES (0, 0), (1, 0), (-1, 0), (0, 1), (0, -1)) s(i, j)"


@R.add(f"""WITH p AS (SELECT DISTINCT row, col FROM {PIXELS}), d1 AS (SELECT DISTINCT row + i AS row, col + j AS col FROM p, {_N5}), d2 AS (SELECT DISTINCT row + i AS row, col + j AS col FROM d1, {_N5}),
  e1 AS (SELECT row + i AS row, col + j AS col FROM d2, {_N5} GROUP BY ALL HAVING count(*) = 5) SELECT row + i AS row, col + j AS col FROM e1, {_N5} GROUP BY ALL HAVING count(*) = 5""")
def binary_closing(spark: SparkSession, d: str) -> DataFrame:
    """Two dilations, then two erosions."""
    return raster.closed(pixels(spark, d), 2).select("row", "col")


@R.add(f"""WITH RECURSIVE p AS (SELECT DISTINCT row, col FROM {PIXELS}), b AS (SELECT row, min(col) AS lo, max(col) AS hi FROM p GROUP BY row), g AS (SELECT row, unnest(range(lo + 1, hi)) AS col FROM b EXCEPT SELECT row, col FROM p),
  o AS (SELECT g.row, g.col FROM g LEFT JOIN b u ON u.row = g.row - 1 LEFT JOIN b l ON l.row = g.row + 1 WHERE u.row IS NULL OR l.row IS NULL OR g.col < u.lo OR g.col > u.hi OR g.col < l.lo OR g.col > l.hi
    UNION SELECT g.row, g.col FROM o JOIN (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) s(i, j) ON true JOIN g ON g.row = o.row + i AND g.col = o.col + j)
  SELECT row::INT AS row, col::INT AS col FROM (SELECT * FROM g EXCEPT SELECT * FROM o)""")
def filled_holes(spark: SparkSession, d: str) -> DataFrame:
    """Pixels enclosed by set ones."""
    return tiles.pixels_of_runs(raster.filled_holes(pixels(spark, d)), ["row"], "col").select(F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"))


@R.add(f"SELECT floor(row / 4)::INT AS row, floor(col / 4)::INT AS col, round(avg(osavi), 9) AS osavi FROM {PIXELS} GROUP BY ALL")
def decimated_read(spark: SparkSession, d: str) -> DataFrame:
    """Means of 4 x 4 pixels."""
    return raster.decimated(pixels(spark, d), ["osavi"], 4).withColumn("osavi", _ROUND("osavi", 9))


@R.add(f"SELECT plant_id, count(*) AS seen, max(n) AS most FROM (SELECT plant_id, unnest(range(row - 1, row + 2)) AS row, cols FROM (SELECT plant_id, row, range(col - 1, col + 2) AS cols FROM {PIXELS})) a, unnest(cols) u(col) JOIN (SELECT row, col, count(*) AS n FROM {PIXELS} GROUP BY ALL) b ON b.row = a.row AND b.col = u.col GROUP BY plant_id")
def window_neighbourhood(spark: SparkSession, d: str) -> DataFrame:
    """The window of each plant's pixel joined to the raster (G4), which is as large as the plants reach."""
    p = pixels(spark, d)
    n = p.groupBy("row", "col").agg(F.count(F.lit(1)).alias("n"))
    # windows are symmetric: each set pixel tells its surroundings, so that pixels are spread and not plants
    w = raster.neighbourhood(n, 1).groupBy("row", "col").agg(F.count(F.lit(1)).alias("seen"), F.max("n").alias("most"))
    return p.select("plant_id", "row", "col").join(w, ["row", "col"]).select("plant_id", "seen", "most")


@R.add(f"SELECT plant_id, CASE WHEN osavi >= 0.5 THEN floor(area_px % 256 * (1 - 0.55::DOUBLE) + 0) ELSE area_px % 256 END::INT AS r, CASE WHEN osavi >= 0.5 THEN floor(area_px % 256 * (1 - 0.55::DOUBLE) + 255 * 0.55::DOUBLE) ELSE area_px % 256 END::INT AS g, CASE WHEN osavi >= 0.5 THEN floor(area_px % 256 * (1 - 0.55::DOUBLE) + 0) ELSE area_px % 256 END::INT AS b FROM {PIXELS}")
def alpha_overlay(spark: SparkSession, d: str) -> DataFrame:
    """A tint mixed in where the mask is set."""
    p = pixels(spark, d).select("plant_id", *[(F.col("area_px") % 256).alias(c) for c in "rgb"], "osavi")
    return p.select("plant_id", *raster.overlay("r", "g", "b", F.col("osavi") >= 0.5, 0.55))


@R.add(f"WITH p AS (SELECT DISTINCT row, col FROM {PIXELS}), t AS (SELECT unnest(range((min(row) // 4 - 2)::BIGINT, (max(row) // 4 + 2)::BIGINT)) AS r FROM p), u AS (SELECT unnest(range((min(col) // 4 - 2)::BIGINT, (max(col) // 4 + 2)::BIGINT)) AS c FROM p) SELECT t.r::INT AS row, u.c::INT AS col FROM p JOIN t ON p.row = floor(t.r * 4000 / 1000::DOUBLE) JOIN u ON p.col = floor(u.c * 14000 / 3500::DOUBLE)")
def mask_resize(spark: SparkSession, d: str) -> DataFrame:
    """Nearest-neighbour resize of a mask to a quarter (R10), as far as the plants reach; rows north of the origin are negative."""
    p = pixels(spark, d).select("row", "col").distinct()
    return raster.resized_nearest(p, (4000, 14000), (1000, 3500))


@R.add("""WITH RECURSIVE g AS (SELECT row_number() OVER () AS rid, image, d.detection_id, d.polygon AS ring FROM (SELECT image, unnest(detections) AS d FROM detections) d WHERE len(d.polygon) >= 3),
  p AS (SELECT rid, unnest(range(len(ring))) AS i, unnest(ring)[1] AS x, unnest(ring)[2] AS y, len(ring) AS n FROM g),
  s AS (SELECT DISTINCT rid, 0::BIGINT AS a, n - 1 AS b FROM p WHERE n > 3
    UNION ALL SELECT rid, unnest([a, m]), unnest([m, b]) FROM (SELECT rid, a, b, arg_max(i, (far, -i)) AS m, max(far) AS far
      FROM (SELECT s.rid, s.a, s.b, q.i, CASE WHEN u.x = v.x AND u.y = v.y THEN sqrt((q.x - u.x) ** 2 + (q.y - u.y) ** 2) ELSE abs((v.x - u.x) * (u.y - q.y) - (u.x - q.x) * (v.y - u.y)) / sqrt((v.x - u.x) ** 2 + (v.y - u.y) ** 2) END AS far
        FROM s JOIN p q ON q.rid = s.rid AND q.i > s.a AND q.i < s.b JOIN p u ON u.rid = s.rid AND u.i = s.a JOIN p v ON v.rid = s.rid AND v.i = s.b) GROUP BY ALL) WHERE far > 2),
  k AS (SELECT rid, a AS i FROM s UNION SELECT rid, b FROM s UNION SELECT rid, i FROM p WHERE n <= 3),
  r AS (SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY i) - 1 AS corner, x, y FROM k JOIN p USING (rid, i)),
  z AS (SELECT * FROM r UNION ALL SELECT e.rid, e.corner + 1, f.x, f.y FROM (SELECT * FROM r QUALIFY corner = max(corner) OVER (PARTITION BY rid)) e JOIN r f ON f.rid = e.rid AND f.corner = 0 WHERE e.x <> f.x OR e.y <> f.y)
  SELECT image, detection_id, corner::INT AS corner, x, y FROM z JOIN g USING (rid)""")
def polygon_simplify(spark: SparkSession, d: str) -> DataFrame:
    """Corners of rings simplified and closed."""
    simple = F.pandas_udf(_simple_rings, T.ArrayType(T.ArrayType(T.DoubleType())))
    rows = table(spark, d, "detections").select("image", F.explode("detections").alias("d")).where(F.size("d.polygon") >= 3)
    ring = rows.select("image", "d.detection_id", F.posexplode(simple("d.polygon")).alias("corner", "q"))
    return ring.select("image", "detection_id", "corner", F.col("q")[0].alias("x"), F.col("q")[1].alias("y"))


_TEXT = "regexp_replace(format('{{:.6f}}', {0}), '(\\.\\d+?)0+$', '\\1')"


@R.add(f"""SELECT plant_id, '{{"type":"Feature","properties":{{"plant_id":"' || plant_id || '","area_px":' || area_px || '}},"geometry":{{"type":"Point","coordinates":[' || {_TEXT.format('x')} || ',' || {_TEXT.format('y')} || ']}}}}' AS json, round(x, 6) AS lon_x, round(y, 6) AS lat_y FROM {POSITIONS}""")
def geojson_features(spark: SparkSession, d: str) -> DataFrame:
    """A GeoJSON feature a plant, and its coordinates read back from the text."""
    from furrow.sources.writers import point_features

    f = positions(spark, d).select("plant_id", "x", "y", F.struct("plant_id", "area_px").alias("p"))
    made = point_features(f.select("plant_id", F.col("p.area_px").alias("area_px"), "x", "y"), "x", "y", ["plant_id", "area_px"])
    back = F.from_json("json", "properties struct<plant_id:string>, geometry struct<coordinates:array<double>>")
    at = F.col("f.geometry.coordinates")
    return made.select("json", back.alias("f")).select(F.col("f.properties.plant_id").alias("plant_id"), plain_numbers(F.col("json")).alias("json"), at[0].alias("lon_x"), at[1].alias("lat_y"))


@R.add(f"SELECT count(*) AS total_plants, count(*) FILTER (sector_label IS NULL OR sector_label = 'NOISE') AS noise_plants, count(DISTINCT sector_label) FILTER (sector_label <> 'NOISE') AS sectors FROM {PLANTS}")
def id_summary(spark: SparkSession, d: str) -> DataFrame:
    """The JSON summary of a run, read back (K3)."""
    from furrow.sources.writers import id_summary as summary

    doc = F.from_json("json", "total_plants long, plants_by_sector map<string,long>, noise_plants long")
    return summary(plants(spark, d)).select(doc.alias("s")).select("s.total_plants", "s.noise_plants", F.size("s.plants_by_sector").cast("long").alias("sectors"))


QUERIES, SQL = R.queries, R.sql
