"""Queries of the general problems over the crop table (3 and 5) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.functions.rounding import half_away
from furrow.operators.imputation import Level, fill_values
from furrow.operators.slabs import containing_region, near_pairs
from furrow.plans.crops import COUNTING_SQL, POSITION_SQL, counting_rows, label_key, stage_name, table, usable, usable_position
from furrow.session import stage

# Fixed values of the problems' statements.
NEAR_METRES = 0.12
DISAGREE = 0.10

#: Decimals that readings are rounded to for the medians; osavi has 4, health_score 1.
DIGITS = 4
READING_LEVELS = (Level("sector and stage", ("field", "sector", "stage"), 5), Level("sector and flight", ("field", "sector", "day"), 5), Level("sector", ("field", "sector")))
SECTOR_LEVELS = (Level("label and flight", ("label", "day"), 3), Level("label", ("label",)))


def _cells(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Counting rows, and the filled cells: plant_id, field_name, value, level, support."""
    rows = counting_rows(table(spark, d, "pineapple_crops"), "sector_id", "sector_label", "predicted_growth_stage", "flight_date", "osavi", "health_score")
    rows = stage(rows.withColumns({"sector": F.when(usable("sector_id"), F.col("sector_id")), "stage": stage_name(), "day": F.to_date("flight_date"), "label": label_key()}), "cells")
    fields = ("osavi", "health_score")  # a number in the shuffles, the name in the result
    cell = F.explode(F.array(*[F.struct(F.lit(i).cast("byte").alias("field"), F.when(usable(f), half_away(f, DIGITS)).alias("value")) for i, f in enumerate(fields)])).alias("c")
    cells = rows.where("sector IS NOT NULL").select("plant_id", "sector", "stage", "day", cell).select("plant_id", "sector", "stage", "day", "c.*")
    read = fill_values(cells.where("value IS NULL").drop("value"), cells, "value", READING_LEVELS).withColumn("field_name", F.when(F.col("field") == 0, fields[0]).otherwise(fields[1]))
    lost = rows.where(F.col("label").isNotNull() & (F.col("sector_id").isNull() | (F.col("sector_id") < -1))).select("plant_id", F.lit("sector_id").alias("field_name"), "label", "day")
    placed = fill_values(lost, rows.where("sector IS NOT NULL").select("label", "day", "sector"), "sector", SECTOR_LEVELS, "mode")
    columns = ("plant_id", "field_name", F.col("value").cast("double").alias("value"), "level", "support")
    return rows, read.where("level IS NOT NULL").select(*columns).unionByName(placed.where("level IS NOT NULL").select(*columns))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _cells(spark, d)[1].select("plant_id", "field_name")


def p3_filled(spark: SparkSession, d: str) -> DataFrame:
    return _cells(spark, d)[1].withColumn("value", half_away("value", 6))


def p3_table(spark: SparkSession, d: str) -> DataFrame:
    """Every counting row with its filled values and a flag for each field; an unusable cell that can't be filled is null."""
    rows, cells = _cells(spark, d)
    pick = lambda f: F.max(F.when(F.col("field_name") == f, F.col("value"))).alias(f"_{f}")
    fills = cells.groupBy("plant_id").agg(*[pick(f) for f in ("osavi", "health_score", "sector_id")])
    out = rows.join(fills, "plant_id", "left")
    kept = {"osavi": F.when(usable("osavi"), F.col("osavi")), "health_score": F.when(usable("health_score"), F.col("health_score")), "sector_id": F.when(F.col("sector_id") >= -1, F.col("sector_id"))}
    whole = {f: F.coalesce(c, F.col(f"_{f}").cast("int" if f == "sector_id" else "double")) for f, c in kept.items()}
    return out.select("plant_id", *[(c if f == "sector_id" else half_away(c, 6)).alias(f) for f, c in whole.items()], *[F.col(f"_{f}").isNotNull().alias(f"{f}_filled") for f in kept])


_P3_ROWS = f"""r AS (SELECT plant_id, sector_id, CASE WHEN sector_id >= 0 THEN sector_id END AS sector, upper(trim(sector_label)) AS label, CAST(flight_date AS DATE) AS day,
    lower(trim(predicted_growth_stage)) AS stage, CASE WHEN osavi BETWEEN -1 AND 1 THEN round(osavi, 4) END AS osavi, CASE WHEN health_score BETWEEN 0 AND 100 THEN round(health_score, 4) END AS health_score FROM ({COUNTING_SQL})),
  c AS (SELECT plant_id, sector, stage, day, 'osavi' AS field_name, osavi AS value FROM r WHERE sector IS NOT NULL UNION ALL SELECT plant_id, sector, stage, day, 'health_score', health_score FROM r WHERE sector IS NOT NULL),
  l1 AS (SELECT field_name, sector, stage, median(value) AS value, count(*) AS support FROM c WHERE value IS NOT NULL AND stage IS NOT NULL GROUP BY ALL HAVING count(*) >= 5),
  l2 AS (SELECT field_name, sector, day, median(value) AS value, count(*) AS support FROM c WHERE value IS NOT NULL AND day IS NOT NULL GROUP BY ALL HAVING count(*) >= 5),
  l3 AS (SELECT field_name, sector, median(value) AS value, count(*) AS support FROM c WHERE value IS NOT NULL GROUP BY ALL),
  m1 AS (SELECT label, day, sector AS value, count(*) AS c FROM r WHERE sector IS NOT NULL AND label IS NOT NULL AND day IS NOT NULL GROUP BY ALL),
  s1 AS (SELECT label, day, arg_min(value, (-c, value)) AS value, sum(c)::BIGINT AS support FROM m1 GROUP BY ALL HAVING sum(c) >= 3),
  m2 AS (SELECT label, sector AS value, count(*) AS c FROM r WHERE sector IS NOT NULL AND label IS NOT NULL GROUP BY ALL),
  s2 AS (SELECT label, arg_min(value, (-c, value)) AS value, sum(c)::BIGINT AS support FROM m2 GROUP BY ALL)"""
P3_FILLED_SQL = f"""WITH {_P3_ROWS}
SELECT plant_id, field_name, round(coalesce(l1.value, l2.value, l3.value), 6) AS value, CASE WHEN l1.support > 0 THEN 'sector and stage' WHEN l2.support > 0 THEN 'sector and flight' ELSE 'sector' END AS level,
    coalesce(l1.support, l2.support, l3.support) AS support
  FROM c LEFT JOIN l1 USING (field_name, sector, stage) LEFT JOIN l2 USING (field_name, sector, day) LEFT JOIN l3 USING (field_name, sector) WHERE c.value IS NULL AND l3.support > 0
UNION ALL SELECT plant_id, 'sector_id', coalesce(s1.value, s2.value)::DOUBLE, CASE WHEN s1.support > 0 THEN 'label and flight' ELSE 'label' END, coalesce(s1.support, s2.support)
  FROM r LEFT JOIN s1 USING (label, day) LEFT JOIN s2 USING (label) WHERE label IS NOT NULL AND (sector_id IS NULL OR sector_id < -1) AND s2.support > 0"""


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    rows = counting_rows(table(spark, d, "pineapple_crops"), "geo_x", "geo_y", "osavi").where(usable_position() & usable("osavi"))
    pairs = near_pairs(stage(rows, "points"), "plant_id", "geo_x", "geo_y", NEAR_METRES, "osavi", DISAGREE)
    return pairs.select(F.col("a").alias("plant_id_a"), F.col("b").alias("plant_id_b"))


def p5_zones(spark: SparkSession, d: str) -> DataFrame:
    """The zone that holds each plant with a usable position, and its osavi."""
    rows = counting_rows(table(spark, d, "pineapple_crops"), "geo_x", "geo_y", "osavi").where(usable_position())
    found = containing_region(rows, "geo_x", "geo_y", table(spark, d, "boundary_zones"), "zone_id", "ring", ["plant_id", "osavi"])
    return found.select("plant_id", F.col("zone").alias("zone_id"), F.nanvl("osavi", F.lit(None).cast("double")).alias("osavi"))


P5_FOUND_SQL = f"""WITH p AS (SELECT plant_id, geo_x AS x, geo_y AS y, osavi, floor(geo_x / 0.13) AS cx, floor(geo_y / 0.13) AS cy FROM ({COUNTING_SQL}) WHERE {POSITION_SQL} AND osavi BETWEEN -1 AND 1)
SELECT a.plant_id AS plant_id_a, b.plant_id AS plant_id_b FROM (SELECT p.*, cx + i AS nx, cy + j AS ny FROM p, (VALUES (-1), (0), (1)) s(i), (VALUES (-1), (0), (1)) t(j)) a
  JOIN p b ON a.nx = b.cx AND a.ny = b.cy AND a.plant_id < b.plant_id WHERE sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 0.12 AND abs(a.osavi - b.osavi) > 0.10"""
P5_ZONES_SQL = f"""WITH p AS (SELECT plant_id, geo_x AS x, geo_y AS y, CASE WHEN NOT isnan(osavi) THEN osavi END AS osavi FROM ({COUNTING_SQL}) WHERE {POSITION_SQL}),
  e AS (SELECT zone_id, ring[i][1] AS x1, ring[i][2] AS y1, ring[i % len(ring) + 1][1] AS x2, ring[i % len(ring) + 1][2] AS y2 FROM (SELECT zone_id, ring, unnest(range(1, len(ring) + 1)) AS i FROM boundary_zones)),
  h AS (SELECT plant_id, zone_id FROM p JOIN e ON (x1 <= x) <> (x2 <= x) AND y >= y1 + (y2 - y1) * (x - x1) / (x2 - x1) GROUP BY plant_id, zone_id HAVING count(*) % 2 = 1)
SELECT p.plant_id, (SELECT min(zone_id) FROM h WHERE h.plant_id = p.plant_id) AS zone_id, osavi FROM p"""

P3_TABLE_SQL = f"""WITH f AS (SELECT plant_id, max(value) FILTER (field_name = 'osavi') AS o, max(value) FILTER (field_name = 'health_score') AS h, max(value) FILTER (field_name = 'sector_id') AS s FROM ({P3_FILLED_SQL}) GROUP BY plant_id)
  SELECT c.plant_id, round(coalesce(CASE WHEN osavi BETWEEN -1 AND 1 THEN osavi END, o), 6) AS osavi, round(coalesce(CASE WHEN health_score BETWEEN 0 AND 100 THEN health_score END, h), 6) AS health_score,
    coalesce(CASE WHEN sector_id >= -1 THEN sector_id END, s::INT) AS sector_id, o IS NOT NULL AS osavi_filled, h IS NOT NULL AS health_score_filled, s IS NOT NULL AS sector_id_filled FROM ({COUNTING_SQL}) c LEFT JOIN f USING (plant_id)"""

QUERIES = {f.__name__: f for f in (p3_found, p3_filled, p3_table, p5_found, p5_zones)}
SQL = {"p3_found": f"SELECT plant_id, field_name FROM ({P3_FILLED_SQL})", "p3_filled": P3_FILLED_SQL, "p3_table": P3_TABLE_SQL, "p5_found": P5_FOUND_SQL, "p5_zones": P5_ZONES_SQL}
