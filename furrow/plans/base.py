"""The cleaned tables that the queries of the operators start from, in Spark and in SQL, and how a query is registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.functions.geo import FALSE_EAST, K0, _ALPHA, _E2, _RECT, Affine, _meridian
from furrow.plans.crops import COUNTING_SQL, POSITION_SQL, counting_rows, label_key, stage_name, table, usable, usable_position
from furrow.sources.readers import index_grid

# Fixed values of the survey's scene: pixel corner to ground, UTM zone, side of the working raster in metres.
SCENE: Affine = (0.0137, 0.0, 400000.0, 0.0, -0.0137, 1104000.0)
ZONE = 51
CELL = 0.5


class Registry:
    """Queries by name, with their SQL where SQL can say the same."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None):
        def register(f):
            self.queries[f.__name__] = f
            if sql:
                self.sql[f.__name__] = sql
            return f

        return register


def _within(c: str, low: float = -1.0, high: float = 1.0):
    return F.when(F.col(c).between(low, high), F.col(c)).alias(c)


def plants(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Counting rows with unusable values as null; all columns, or plant_id, x, y and those named, as only these travel."""
    at = usable_position()
    made = {
        "sector_id": (F.when(usable("sector_id") | (F.col("sector_id") == -1), F.col("sector_id")).alias("sector_id"), "sector_id"), "sector_label": (label_key().alias("sector_label"), "sector_label"), "stage": (stage_name().alias("stage"), "predicted_growth_stage"),
        "x": (F.when(at, F.col("geo_x")).alias("x"), "geo_x"), "y": (F.when(at, F.col("geo_y")).alias("y"), "geo_y"), **{c: (_within(c), c) for c in ("osavi", "ndvi", "ndre")}, "health_score": (_within("health_score", 0.0, 100.0), "health_score"),
        "health_color": ("health_color", "health_color"), "canopy_area": (_within("canopy_area", 0.0, 1000.0), "canopy_area"), **{c: (c, c) for c in ("area_px", "pixel_x", "pixel_y", "flight_date")},
    }
    wanted = [m for c, m in made.items() if not columns or c in ("x", "y", *columns)]
    rows = counting_rows(table(spark, d, "pineapple_crops"), *[source for _, source in wanted])
    return rows.select("plant_id", *[c for c, _ in wanted])


PLANTS = f"""(SELECT plant_id, CASE WHEN sector_id >= -1 THEN sector_id END AS sector_id, upper(trim(sector_label)) AS sector_label,
    upper(trim(predicted_growth_stage))[1:1] || lower(trim(predicted_growth_stage))[2:] AS stage, CASE WHEN {POSITION_SQL} THEN geo_x END AS x, CASE WHEN {POSITION_SQL} THEN geo_y END AS y,
    CASE WHEN osavi BETWEEN -1 AND 1 THEN osavi END AS osavi, CASE WHEN ndvi BETWEEN -1 AND 1 THEN ndvi END AS ndvi, CASE WHEN ndre BETWEEN -1 AND 1 THEN ndre END AS ndre,
    CASE WHEN health_score BETWEEN 0 AND 100 THEN health_score END AS health_score, health_color, CASE WHEN canopy_area BETWEEN 0 AND 1000 THEN canopy_area END AS canopy_area, area_px, pixel_x, pixel_y, flight_date
  FROM ({COUNTING_SQL}))"""


def positions(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Plants with a usable position."""
    return plants(spark, d, *columns).where("x IS NOT NULL")


POSITIONS = f"(SELECT * FROM {PLANTS} WHERE x IS NOT NULL)"


def pixels(spark: SparkSession, d: str) -> DataFrame:
    """Plants on a raster of half-metre cells: plant_id, row, col, area_px."""
    return positions(spark, d).select("plant_id", F.floor((1100500.0 - F.col("y")) / CELL).cast("int").alias("row"), F.floor((F.col("x") - 400000.0) / CELL).cast("int").alias("col"), "area_px", "osavi")


PIXELS = f"(SELECT plant_id, floor((1100500.0 - y) / 0.5::DOUBLE)::INT AS row, floor((x - 400000.0) / 0.5::DOUBLE)::INT AS col, area_px, osavi FROM {POSITIONS})"


def samples(spark: SparkSession, d: str) -> DataFrame:
    """Index samples with usable values and their UTM position, and an id made of both."""
    g = index_grid(table(spark, d, "raw_index_grid"), ZONE).where("ndvi BETWEEN -1 AND 1 AND ndre BETWEEN -1 AND 1").distinct()
    return g.select(F.concat_ws("/", F.format_string("%.8f", "lat"), F.format_string("%.8f", "lon")).alias("id"), "lat", "lon", "x", "y", "ndvi", "ndre", "stress_idx")


_T = f"sinh(atanh(sin(radians(lat))) - {_E2**0.5!r} * atanh({_E2**0.5!r} * sin(radians(lat))))"
_L = f"(radians(lon) - {_meridian(ZONE)!r})"
_ETA = f"asinh(sin({_L}) / sqrt(({_T}) * ({_T}) + cos({_L}) * cos({_L})))"
_XI = f"atan2({_T}, cos({_L}))"
UTM_X = f"{FALSE_EAST!r}::DOUBLE + {K0 * _RECT!r}::DOUBLE * (eta + " + " + ".join(f"{a!r}::DOUBLE * cos({2 * (j + 1)} * xi) * sinh({2 * (j + 1)} * eta)" for j, a in enumerate(_ALPHA)) + ")"
UTM_Y = f"{K0 * _RECT!r}::DOUBLE * (xi + " + " + ".join(f"{a!r}::DOUBLE * sin({2 * (j + 1)} * xi) * cosh({2 * (j + 1)} * eta)" for j, a in enumerate(_ALPHA)) + ")"
SAMPLES = f"""(SELECT format('{{:.8f}}/{{:.8f}}', lat, lon) AS id, lat, lon, {UTM_X} AS x, {UTM_Y} AS y, ndvi, ndre, stress_idx FROM (SELECT DISTINCT *, {_ETA} AS eta, {_XI} AS xi
    FROM (SELECT lat, lon, ndvi, ndre, CASE WHEN NOT isnan(nsi) THEN nsi END AS nsi, CASE WHEN NOT isnan(chlorophyll_idx) THEN chlorophyll_idx END AS chlorophyll_idx, CASE WHEN NOT isnan(stress_idx) THEN stress_idx END AS stress_idx
      FROM raw_index_grid WHERE lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon) AND ndvi BETWEEN -1 AND 1 AND ndre BETWEEN -1 AND 1)))"""
