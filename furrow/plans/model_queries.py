"""Queries of the health pipelines, the learned operators and the plant-id pipeline.

Trees, forests and mixtures are not equal bit by bit from one engine to another. So each plan is registered whole, and
beside it what must hold of its rows, which SQL can say: exact counts, ranges and orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from furrow.functions.ladders import floors, growth_stage
from furrow.functions.rounding import half_away
from furrow.operators.aggregates import sector_frames
from furrow.operators.models import counted_split, impute_by_boosting, predict_stage, train_stage_forest
from furrow.operators.sectors import density_sectors, rescued_noise
from furrow.plans.base import PLANTS, POSITIONS, Registry, plants, positions
from furrow.plans.crops import table
from furrow.plans.health import cohort_health, plant_ids, rank_health
from furrow.session import stage

R = Registry()


def _nearest_mean(value: str) -> str:
    """0.7 * value + 0.3 * mean of the 8 nearest others that have one, by brute force in SQL."""
    return f"""(SELECT a.plant_id, round(0.7 * any_value(a.{value}) + 0.3 * list_avg(list_transform(min({{'d': sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 'other': b.plant_id, 'v': b.{value}}}, 8), lambda e: e.v)), 9) AS s
    FROM p a, p b WHERE a.{value} IS NOT NULL AND b.{value} IS NOT NULL AND a.plant_id <> b.plant_id GROUP BY a.plant_id)"""


#: What the rank-based plan reads beside id and position.
_HEALTH = ("sector_label", "ndvi", "ndre")
_SCORE = "(rank() OVER (ORDER BY {0}) + (count(*) OVER (PARTITION BY {0}) - 1) / 2.0::DOUBLE) / count(*) OVER () * 100"
_TIER = "CASE WHEN label = 'NOISE' THEN 'NOISE' WHEN score IS NULL THEN 'Out of Boundary' WHEN score >= 70 THEN 'Healthy' WHEN score >= 40 THEN 'Moderate' WHEN score >= 15 THEN 'Stressed' ELSE 'Critical' END"


@R.add(f"""WITH p AS MATERIALIZED (SELECT plant_id, sector_label, x, y, ndvi, ndre FROM {POSITIONS}), v AS {_nearest_mean('ndvi')}, e AS {_nearest_mean('ndre')},
  s AS (SELECT plant_id, {_SCORE.format('v.s')} AS b, {_SCORE.format('e.s')} AS n FROM v JOIN e USING (plant_id)),
  f AS (SELECT p.plant_id, sector_label AS label, b, n, 0.55::DOUBLE * b + 0.45::DOUBLE * n AS score FROM p LEFT JOIN s USING (plant_id))
  SELECT plant_id, {_TIER} AS health_status, CASE WHEN label IS DISTINCT FROM 'NOISE' THEN round(b, 6) END AS b, CASE WHEN label IS DISTINCT FROM 'NOISE' THEN round(n, 6) END AS n,
    CASE WHEN label IS NOT DISTINCT FROM 'NOISE' OR b IS NULL THEN NULL WHEN b >= 66 AND n >= 66 THEN 'Healthy & vigorous' WHEN b < 33 AND n < 33 THEN 'Critical (low biomass & N)' WHEN n < 33 THEN 'Nitrogen deficient' WHEN b < 33 THEN 'Sparse canopy / early growth' ELSE 'Moderate' END AS diagnosis,
    CASE WHEN label IS NOT DISTINCT FROM 'NOISE' OR b IS NULL THEN NULL WHEN n < b - 12 THEN 'Nitrogen' WHEN b < n - 12 THEN 'Biomass' ELSE 'Balanced' END AS limiting_factor FROM f""")
def rank_health_scores(spark: SparkSession, d: str) -> DataFrame:
    """The rank-based health plan without its models: smoothing, ranks, status, diagnosis, limiting factor."""
    h = rank_health(positions(spark, d, *_HEALTH), with_models=False, digits=6)
    return h.select("plant_id", "health_status", F.col("biomass_score").alias("b"), F.col("nitrogen_score").alias("n"), "diagnosis", "limiting_factor")


@R.add()
def rank_health_plants(spark: SparkSession, d: str) -> DataFrame:
    """The whole rank-based plan: with archetypes of a mixture and the cap for outliers."""
    return rank_health(positions(spark, d, *_HEALTH))


@R.add(f"""SELECT count(*) AS plants, count(*) FILTER (ndvi IS NOT NULL AND ndre IS NOT NULL) AS valid, count(*) FILTER (sector_label = 'NOISE') AS noise, 0 AS out_of_range, true AS outliers_within_share, 4 AS archetypes, true AS archetypes_in_order, 0 AS wrong_caps FROM {POSITIONS}""")
def rank_health_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of rank_health_plants: a score for every valid plant within 0..100, a tenth of outliers, four archetypes in the
    order of their vigour, and every outlier that is low in both at most 12 (M5, M6, W5, P12)."""
    h = rank_health(positions(spark, d, *_HEALTH))
    valid, plain = F.col("ndvi").isNotNull() & F.col("ndre").isNotNull(), ~F.col("sector_label").eqNullSafe(F.lit("NOISE"))
    scored = F.col("health_score").between(0, 100) == (valid & plain)
    low = (F.col("biomass_score") < 33) & (F.col("nitrogen_score") < 33) & F.col("is_anomaly")
    level = F.when(valid & plain, F.col("ndvi_smooth") + F.col("ndre_smooth"))
    # one pass by archetype, then a few rows
    g = h.groupBy("archetype").agg(
        F.count(F.lit(1)).alias("plants"), F.count_if(valid).alias("valid"), F.count_if(~plain).alias("noise"), F.count_if("is_anomaly").alias("outliers"),
        F.count_if(~F.coalesce(scored, ~(valid & plain))).alias("out_of_range"), F.count_if(low & (F.col("health_score") > 12)).alias("wrong_caps"), F.avg(level).alias("m"), F.count_if(valid & plain).alias("members"),
    )
    order = F.array_sort(F.collect_list(F.when(F.col("members") > 0, F.struct("archetype", "m"))))
    rising = F.forall(F.sequence(F.lit(1), F.size("o") - 1), lambda i: F.col("o")[i]["m"] >= F.col("o")[i - 1]["m"])
    one = g.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("plants", "valid", "noise", "outliers", "out_of_range", "wrong_caps")], order.alias("o"))
    return one.select(
        "plants", "valid", "noise", F.col("out_of_range").cast("int").alias("out_of_range"), (F.col("outliers") / F.col("valid")).between(0.08, 0.12).alias("outliers_within_share"),
        F.size("o").alias("archetypes"), rising.alias("archetypes_in_order"), F.col("wrong_caps").cast("int").alias("wrong_caps"),
    )


@R.add()
def cohort_health_plants(spark: SparkSession, d: str) -> DataFrame:
    """The plan by growth-stage cohorts, an isolation forest to each."""
    return cohort_health(positions(spark, d))


@R.add(f"""SELECT stage, count(*) AS plants, count(*) FILTER (osavi IS NULL) AS without_index, count(*) FILTER (osavi < CASE WHEN stage = 'Seedling' THEN 0.20 ELSE 0.25 END) AS below_floor, 0 AS above_cap, 0 AS out_of_range, 0 AS wrong_status FROM {POSITIONS} WHERE stage IS NOT NULL GROUP BY stage""")
def cohort_health_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of cohort_health_plants: plants below the floor score at most 14, scores lie within 0..100 and exist with the index, and the status fits the score."""
    h = cohort_health(positions(spark, d)).where("stage IS NOT NULL")
    _, fu = floors("stage")
    s = F.col("health_score")
    tier = F.when(s.isNull(), "Out of Boundary").when(s >= 70.05, "Healthy").when(s.between(40.05, 69.95), "Moderate").when(s.between(15.05, 39.95), "Stressed").when(s <= 14.95, "Critical")
    return h.groupBy("stage").agg(
        F.count(F.lit(1)).alias("plants"), F.count_if(F.col("osavi").isNull()).alias("without_index"), F.count_if(F.col("osavi") < fu).alias("below_floor"),
        F.count_if((F.col("osavi") < fu) & (s > 14)).cast("int").alias("above_cap"), F.count_if(F.coalesce(~s.between(0, 100), F.lit(False)) | (s.isNull() != F.col("osavi").isNull())).cast("int").alias("out_of_range"),
        F.count_if(tier.isNotNull() & (tier != F.col("health_status"))).cast("int").alias("wrong_status"),
    )


def _imputed(spark: SparkSession, d: str) -> tuple[DataFrame, dict[str, float]]:
    found = table(spark, d, "plants_with_ids").groupBy("plant_id").agg(*[F.max(c).alias(c) for c in ("mask_file", "bbox_width", "bbox_height")])
    rows = positions(spark, d).join(found, "plant_id", "left")
    return impute_by_boosting(rows, "plant_id", "x", "y", ["ndvi", "ndre"], ["x", "y", "area_px", "canopy_area", "bbox_width", "bbox_height", "sector_id"], 2.0, "sector_label", "mask_file")


@R.add()
def gap_imputation(spark: SparkSession, d: str) -> DataFrame:
    """Both indices of every gap predicted by boosted trees from position, size and neighbours."""
    return _imputed(spark, d)[0]


@R.add(f"""SELECT CASE WHEN sector_label IS NOT DISTINCT FROM 'NOISE' THEN 'none' WHEN ndvi IS NOT NULL AND ndre IS NOT NULL THEN 'measured' WHEN ndvi IS NULL AND m.mask_file IS NOT NULL THEN 'predicted' ELSE 'none' END AS source, count(*) AS plants, true AS plausible, true AS fits
    FROM {POSITIONS} p LEFT JOIN (SELECT plant_id, max(mask_file) AS mask_file FROM plants_with_ids GROUP BY plant_id) m ON p.plant_id = m.plant_id GROUP BY 1""")
def gap_imputation_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of gap_imputation: which plants are measured, predicted or neither, predictions within the indices' range, and
    a hold-out error no larger than that of the mean (M4, A19)."""
    made, r2 = _imputed(spark, d)
    ok = F.when(F.col("source") == "predicted", F.col("ndvi").between(-1, 1) & F.col("ndre").between(-1, 1)).otherwise(True)
    return made.groupBy(F.coalesce("source", F.lit("none")).alias("source")).agg(F.count(F.lit(1)).alias("plants"), F.min(F.coalesce(ok, F.lit(False))).alias("plausible")).withColumn("fits", F.lit(all(v > -0.05 for v in r2.values())))


_AREA = "canopy_area >= 0.1811 THEN 'Mature' WHEN canopy_area >= 0.1449 THEN 'Fruiting' WHEN canopy_area >= 0.1177 THEN 'Flowering' WHEN canopy_area >= 0.0815 THEN 'Vegetative' ELSE 'Seedling'"


@R.add(f"""WITH n AS (SELECT plant_id, CASE WHEN {_AREA} END AS stage, md5('42|' || plant_id) AS h, count(*) OVER () AS n, row_number() OVER (ORDER BY md5('42|' || plant_id), plant_id) AS i FROM {PLANTS} WHERE canopy_area IS NOT NULL)
  SELECT stage, count(*) FILTER (i <= floor(n * 0.8::DOUBLE)) AS train, count(*) FILTER (i > floor(n * 0.8::DOUBLE)) AS test, true AS learned FROM n GROUP BY stage""")
def stage_forest_checks(spark: SparkSession, d: str) -> DataFrame:
    """A forest of 50 trees learns the stage rule: rows for training and testing, and whether nine tenths of all test rows are right."""
    rows = plants(spark, d).where("canopy_area IS NOT NULL").select("plant_id", "canopy_area", "area_px", "osavi", "ndvi", growth_stage("canopy_area").alias("label"))
    rows = stage(counted_split(rows, "plant_id", 42), "stages")
    features = ["canopy_area", "area_px", "osavi", "ndvi"]
    model = train_stage_forest(rows.where("split = 'train'"), features, "label")
    made = stage(predict_stage(model, rows.where("split <> 'train'"), features), "predicted")
    right = made.agg((F.avg((F.col("predicted_stage") == F.col("label")).cast("int")) >= 0.9).alias("learned"))
    n = rows.groupBy(F.col("label").alias("stage")).agg(F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") != "train").alias("test"))
    return n.crossJoin(F.broadcast(right))  # one row


#: Least members of a sector that density finds, and the spacings a noise point may lie off it: across and along.
LEAST_SECTOR, ACROSS, ALONG = 25, 3.0, 3.25


def _identified(spark: SparkSession, d: str) -> DataFrame:
    """Density sectors, noise rescued into near sectors, sectors renumbered, rows and columns, ids."""
    p = stage(positions(spark, d).select(F.col("plant_id").alias("id"), "x", "y", F.lit("scene").alias("scene")), "positions")
    found = stage(p.join(density_sectors(p, "id", "x", "y", "scene", LEAST_SECTOR).select("id", "sector", "nearest"), "id"), "sectors")
    near = found.agg(F.percentile(half_away("nearest", 6), 0.5)).first()[0] or 1.0  # as spacing has it
    saved = rescued_noise(found.where("sector = -1"), sector_frames(found, "sector", "x", "y"), "id", "x", "y", ACROSS * near, ALONG * near)
    whole = found.join(saved.withColumnRenamed("sector", "_saved"), "id", "left").select("id", "x", "y", F.coalesce("_saved", "sector").alias("sector"))
    return plant_ids(stage(whole, "whole"))


@R.add()
def plant_id_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """From positions to plant ids."""
    return _identified(spark, d)


@R.add(f"SELECT count(*) AS plants, true AS several_sectors, 0 AS small_sectors, 0 AS unnumbered, 0 AS numbered_noise, 0 AS repeated_places, true AS sectors_from_north FROM {POSITIONS}")
def plant_id_checks(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of plant_id_pipeline: every plant once, sectors of at least the least size and numbered from north to south, row and column for
    each of their plants and for no other, and no two plants of a sector in one place."""
    made = _identified(spark, d)
    at = stage(made.join(positions(spark, d).select(F.col("plant_id").alias("id"), "y"), "id"), "identified")
    member = F.col("sector") >= 0
    one = at.agg(
        F.count(F.lit(1)).alias("plants"), F.count_if(member & (F.col("row_index").isNull() | F.col("col_index").isNull() | (F.col("row_index") < 1) | (F.col("col_index") < 1))).cast("int").alias("unnumbered"),
        F.count_if(~member & F.col("row_index").isNotNull()).cast("int").alias("numbered_noise"),
    )
    s = at.where(member).groupBy("sector").agg(F.count(F.lit(1)).alias("n"), half_away(F.avg("y"), 6).alias("y"))
    north = F.lag("y").over(Window.partitionBy(F.lit(1)).orderBy("sector"))  # a row a sector
    sizes = s.withColumn("_d", north - F.col("y")).agg((F.count(F.lit(1)) > 1).alias("several_sectors"), F.count_if(F.col("n") < LEAST_SECTOR).cast("int").alias("small_sectors"), (F.coalesce(F.min("_d"), F.lit(0.0)) >= 0).alias("sectors_from_north"))
    twice = at.where(member).groupBy("sector", "row_index", "col_index").agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).cast("int").alias("repeated_places"))
    return one.crossJoin(F.broadcast(sizes)).crossJoin(F.broadcast(twice)).select("plants", "several_sectors", "small_sectors", "unnumbered", "numbered_noise", "repeated_places", "sectors_from_north")  # one row each


QUERIES, SQL = R.queries, R.sql
