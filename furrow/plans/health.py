"""The two health pipelines and the id pipeline as plans over DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions import ladders
from furrow.functions.geo import geo_hash, plant_id, sector_label
from furrow.functions.indices import average_rank_score, blend, rescale
from furrow.functions.nulls import finite
from furrow.functions.rounding import half_even
from furrow.operators.aggregates import project, sector_frames
from furrow.operators.joins import smooth_by_neighbours
from furrow.operators.models import isolation_scores, with_archetypes
from furrow.operators.neighbours import near_means
from furrow.operators.sectors import axis_tolerance, relabelled, row_column_numbers
from furrow.session import stage


@dataclass(frozen=True)
class RankParams:
    """Parameters of the rank-based health model."""

    neighbours: int = 8
    own: float = 0.7
    cell: float = 2.0
    biomass_weight: float = 0.55
    contamination: float = 0.10
    least_outliers: int = 30


def rank_health(plants: DataFrame, p: RankParams = RankParams(), with_models: bool = True, digits: int = 1) -> DataFrame:
    """Rank-based health of plants (plant_id, sector_label, x, y, ndvi, ndre), one row a plant.

    Each index is smoothed over the neighbours that have it. Plants with both indices are valid: they are ranked, blended,
    diagnosed and capped; the others have null scores and are Out of Boundary. Rows labelled NOISE come last: their scores are
    null and their status is NOISE. Scores have ``digits`` decimals.
    """
    rows = plants.select("plant_id", "sector_label", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), finite("ndvi").alias("ndvi"), finite("ndre").alias("ndre"))
    both = F.col("ndvi").isNotNull() & F.col("ndre").isNotNull()
    rows = near_means(stage(rows, "plants"), "plant_id", "x", "y", ["ndvi", "ndre"], p.neighbours, p.cell)
    smooth = {v: half_even(F.coalesce(p.own * F.col(v) + (1 - p.own) * F.col(f"{v}_near"), F.col(v)), 9) for v in ("ndvi", "ndre")}
    rows = rows.select("plant_id", "sector_label", "ndvi", "ndre", *[c.alias(f"{v}_smooth") for v, c in smooth.items()])
    rows = stage(rows.withColumns({"_v": F.when(both, F.col("ndvi_smooth")), "_e": F.when(both, F.col("ndre_smooth"))}), "smoothed")
    anomaly, cluster, confidence = F.lit(False), F.lit(-1), F.lit(None).cast("double")
    named = with_archetypes(rows, "plant_id", ["_v", "_e"], p.contamination, p.least_outliers) if with_models else None
    rows = average_rank_score(rows, "_v", "biomass")
    rows = average_rank_score(rows, "_e", "nitrogen")
    if named:
        rows = named(rows)
        anomaly, cluster, confidence = F.col("outlier"), F.col("archetype"), F.col("confidence")
    b, n = F.col("biomass"), F.col("nitrogen")
    noise = F.col("sector_label").eqNullSafe(F.lit("NOISE"))
    score = ladders.capped_both_low(p.biomass_weight * b + (1 - p.biomass_weight) * n, b, n, anomaly)
    tier = ladders.health_tier(score, "sector_label")
    hide = lambda c: F.when(~noise, c)
    return rows.select(
        "plant_id", "sector_label", "ndvi", "ndre",
        *[half_even(c, 3).alias(c) for c in ("ndvi_smooth", "ndre_smooth")],
        hide(half_even(b, digits)).alias("biomass_score"), hide(half_even(n, digits)).alias("nitrogen_score"), hide(half_even(score, digits)).alias("health_score"),
        tier.alias("health_status"), ladders.tier_colour(tier).alias("health_color"),
        hide(ladders.diagnosis(b, n)).alias("diagnosis"), hide(ladders.limiting_factor(b, n)).alias("limiting_factor"),
        anomaly.alias("is_anomaly"), F.when(noise, -1).otherwise(cluster).alias("archetype"), hide(confidence).alias("archetype_confidence"),
    )


def cohort_health(plants: DataFrame, cell: float = 2.0, contamination: float = 0.12, least: int = 15) -> DataFrame:
    """Health by growth-stage cohorts of plants (plant_id, stage, x, y, osavi, ndvi, ndre), one row a plant.

    osavi is smoothed over the nine nearest plants, itself among them; each stage has an isolation forest whose score is
    set against the stage's median and deviation; vigour and score blend, then the directional caps apply.
    A stage of fewer than ``least`` plants is scored by osavi alone. Null osavi: Out of Boundary, no score.
    """
    rows = plants.select("plant_id", "stage", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), *[finite(c).alias(c) for c in ("osavi", "ndvi", "ndre")])
    s = smooth_by_neighbours(rows, "plant_id", "x", "y", "osavi", 8, cell, include_self=True)
    rows = rows.join(s.select(F.col("id").alias("plant_id"), half_even("smoothed", 9).alias("osavi_smooth")), "plant_id", "left")
    iso = isolation_scores(rows, "plant_id", ["osavi_smooth", "ndvi", "ndre"], "stage", least=least)
    rows = rows.join(iso.select(F.col("id").alias("plant_id"), "score"), "plant_id", "left")
    stats = rows.groupBy("stage").agg(F.percentile_approx("score", 0.5, 10_000).alias("_med"), F.stddev_pop("score").alias("_sd"), F.avg("osavi_smooth").alias("_mean"))
    stats = stats.withColumn("_sd", F.when(F.col("_sd") > 0.01, F.col("_sd")).otherwise(0.05))
    rows = stage(rows.join(stats, "stage", "left"), "cohorts")
    med, sd = F.col("_med"), F.col("_sd")
    norm = rescale("score", med - 2 * sd, med + sd)
    v = ladders.vigour(F.col("osavi"), F.col("ndvi"), F.col("ndre"), F.col("stage"))
    capped = ladders.directional_caps(blend((0.7, v), (0.3, norm)), F.col("osavi"), F.col("stage"), F.col("score") < med - 1.5 * sd, F.col("_mean"))
    final = F.when(F.col("score").isNull(), rescale("osavi", 0.2, 0.5)).otherwise(capped)
    tier = ladders.health_tier(final)
    return rows.select("plant_id", "stage", "osavi", half_even("osavi_smooth", 3).alias("osavi_smooth"), half_even(final, 1).alias("health_score"), tier.alias("health_status"), ladders.tier_code(tier).alias("health_status_code"), ladders.tier_colour(tier).alias("health_color"))


def plant_ids(points: DataFrame, id_col: str = "id", sector: str = "sector", x: str = "x", y: str = "y") -> DataFrame:
    """(id, sector, sector_label, row_index, col_index, plant_id): sectors renumbered, rows and columns in the sector's frame.

    Sectors below three members use the x and y axes. Noise keeps -1 and has no row or column.
    """
    rows = points.select(F.col(id_col).alias("id"), F.col(sector).alias("old"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    rows = rows.join(relabelled(rows, "old", "x", "y"), "old", "left").withColumn("sector", F.coalesce("sector", F.lit(-1)))
    framed = rows.join(sector_frames(rows, "sector", "x", "y").select("sector", "cx", "cy", "ax", "ay"), "sector", "left")
    framed = framed.withColumns({"cx": F.coalesce("cx", F.lit(0.0)), "cy": F.coalesce("cy", F.lit(0.0)), "ax": F.coalesce("ax", F.lit(1.0)), "ay": F.coalesce("ay", F.lit(0.0))})
    p = project(framed, "x", "y").where("sector >= 0")
    tol = axis_tolerance(p, ["sector"], "minor")
    numbers = row_column_numbers(p.join(tol, "sector", "left").withColumn("tolerance", F.coalesce("tolerance", F.lit(1e-9))), "id", "sector", "minor", "major", "tolerance")
    out = rows.join(numbers.select("id", "row_index", "col_index"), "id", "left").withColumn("sector_label", sector_label("sector"))
    return out.select("id", "sector", "sector_label", "row_index", "col_index", plant_id("sector_label", "row_index", "col_index", geo_hash("x", "y")).alias("plant_id"))
