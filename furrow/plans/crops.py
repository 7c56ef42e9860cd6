"""Cleaning rules of the plant-health table: one counting row a plant, usable values only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Ranges of usable positions.
GEO_X = (200000.0, 800000.0)
GEO_Y = (1000000.0, 1600000.0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def counting_rows(crops: DataFrame, *columns: str) -> DataFrame:
    """For each plant the row with the latest created_at, with the named columns.

    Rows without a plant_id are left out; a null created_at is older than any other; rows equal in
    both are identical, so whichever is kept gives the same values. The maximum is taken as an
    aggregate, so repeated deliveries combine before the shuffle, however many a plant has.
    """
    packed = F.max(F.struct("created_at", *columns)).alias("r")
    return crops.where(F.col("plant_id").isNotNull()).groupBy("plant_id").agg(packed).select("plant_id", *[F.col(f"r.{c}").alias(c) for c in columns])


def usable(field: str) -> Column:
    """Whether the field holds a usable value: never null; NaN is greater than any bound in Spark, so it fails."""
    c = F.col(field)
    ranges = {"osavi": (-1.0, 1.0), "health_score": (0.0, 100.0), "geo_x": GEO_X, "geo_y": GEO_Y}
    return F.coalesce(c >= 0 if field == "sector_id" else c.between(*ranges[field]), F.lit(False))


def usable_position() -> Column:
    return usable("geo_x") & usable("geo_y")


def stage_name(c: str = "predicted_growth_stage") -> Column:
    return F.initcap(F.lower(F.trim(c)))


def label_key(c: str = "sector_label") -> Column:
    return F.upper(F.trim(c))


#: The counting rows in DuckDB's SQL, for the oracle queries.
COUNTING_SQL = """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY plant_id ORDER BY created_at DESC NULLS LAST) AS rn
    FROM pineapple_crops WHERE plant_id IS NOT NULL) WHERE rn = 1"""
POSITION_SQL = "geo_x BETWEEN 200000 AND 800000 AND geo_y BETWEEN 1000000 AND 1600000"
