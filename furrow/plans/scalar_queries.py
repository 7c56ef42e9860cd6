"""Queries of column expressions, filters, aggregates and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.functions import colours, indices, ladders, nulls, text
from furrow.functions.geo import apply_affine, geo_hash, inverse, pixel_of, plant_id, sector_label, to_latlon, to_utm
from furrow.functions.rounding import half_away
from furrow.operators import aggregates
from furrow.operators.models import counted_split
from furrow.plans.base import PLANTS, POSITIONS, SAMPLES, SCENE, ZONE, Registry, plants, positions, samples
from furrow.plans.crops import table

R = Registry()
_ROUND = lambda c, n=6: half_away(c, n)


@R.add(f"""SELECT sector_id, sector_label, count(*) AS total_active_plants, round(sum(kg)::DECIMAL(20,3) * 0.001::DECIMAL(4,3), 3)::DOUBLE AS predicted_biomass_tonnes
    FROM (SELECT sector_id, sector_label, round(34 * pow(canopy_area, 1.2) * (coalesce(ndvi, 0.3) + 0.1), 3)::DECIMAL(18,3) AS kg FROM {PLANTS}
      WHERE sector_label IS DISTINCT FROM 'NOISE' AND sector_id IS NOT NULL AND sector_label IS NOT NULL) GROUP BY sector_id, sector_label ORDER BY sector_id, sector_label""")
def sector_biomass_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Plants and biomass of each sector."""
    return aggregates.biomass_rollup(plants(spark, d), "canopy_area", "ndvi").orderBy("sector_id", "sector_label")


_F = {"r": "l_discount::FLOAT::DOUBLE", "g": "l_tax::FLOAT::DOUBLE", "n": "l_quantity::FLOAT::DOUBLE", "e": "l_extendedprice::FLOAT::DOUBLE"}


@R.add(f"""SELECT l_orderkey, l_linenumber, round(({_F['n']} - {_F['r']}) / ({_F['n']} + {_F['r']} + 1e-10), 6) AS ndvi, round(({_F['n']} - {_F['e']}) / ({_F['n']} + {_F['e']} + 1e-10), 6) AS ndre,
    round(({_F['n']} - {_F['r']}) / ({_F['n']} + {_F['r']} + 0.16 + 1e-10), 6) AS osavi, round(({_F['n']} - {_F['g']}) / ({_F['n']} + {_F['g']} + 1e-10), 6) AS gdvi FROM lineitem""")
def vegetation_indices(spark: SparkSession, d: str) -> DataFrame:
    """Indices of four bands in single precision (P1); the bands are four numeric columns."""
    cols = indices.band_indices("l_discount", "l_tax", "l_quantity", "l_extendedprice")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *[_ROUND(c).alias(k) for k, c in cols.items()])


@R.add("""SELECT l_orderkey, l_linenumber, round((l_quantity - l_tax) / (l_quantity + l_tax + 1e-6), 6) AS ndvi, round(0.299 * l_quantity + 0.587 * l_discount + 0.114 * l_tax, 6) AS luma,
    round((l_quantity + l_discount + l_tax) / 3.0, 6) AS brightness, (l_quantity + l_discount + l_tax) / 3.0 > 8 OR (l_extendedprice - l_quantity) / (l_extendedprice + l_quantity + 1e-6) <= 0.10 AS excluded FROM lineitem""")
def brightness_and_exclusion(spark: SparkSession, d: str) -> DataFrame:
    """Two-band NDVI, luma, brightness and the exclusion mask."""
    from furrow.operators.raster import exclusion

    rows = table(spark, d, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", _ROUND(indices.normalised_difference("l_quantity", "l_tax", eps=indices.EPS_RGB)).alias("ndvi"), _ROUND(indices.luma("l_quantity", "l_discount", "l_tax")).alias("luma"), _ROUND(indices.brightness("l_quantity", "l_discount", "l_tax")).alias("brightness"), exclusion("l_quantity", "l_discount", "l_tax", "l_extendedprice", 0.10, 8.0).alias("excluded"))


_TIER = "CASE WHEN health_score IS NULL THEN 'Out of Boundary' WHEN health_score >= 70 THEN 'Healthy' WHEN health_score >= 40 THEN 'Moderate' WHEN health_score >= 15 THEN 'Stressed' ELSE 'Critical' END"


@R.add(f"""SELECT plant_id, tier, CASE tier WHEN 'Healthy' THEN '#2E7D32' WHEN 'Moderate' THEN '#FBC02D' WHEN 'Stressed' THEN '#FF5722' WHEN 'Critical' THEN '#D32F2F' WHEN 'NOISE' THEN '#757575' ELSE '#1976D2' END AS colour,
    CASE tier WHEN 'Healthy' THEN 0 WHEN 'Moderate' THEN 1 WHEN 'Stressed' THEN 2 WHEN 'Critical' THEN 3 ELSE 4 END AS code,
    CASE WHEN sector_id < 0 THEN '#888' ELSE ['#e41a1c', '#377eb8', '#4daf4a', '#984ea3', '#ff7f00', '#ffff33', '#a65628', '#f781bf'][sector_id % 8 + 1] END AS sector_colour
    FROM (SELECT plant_id, sector_id, CASE WHEN sector_label = 'NOISE' THEN 'NOISE' ELSE {_TIER} END AS tier FROM {PLANTS})""")
def health_tier_ladder(spark: SparkSession, d: str) -> DataFrame:
    """Tier, colour and code of each plant, and its sector's colour."""
    tier = ladders.health_tier("health_score", "sector_label")
    return plants(spark, d).select("plant_id", tier.alias("tier"), ladders.tier_colour(tier).alias("colour"), ladders.tier_code(tier).alias("code"), ladders.sector_colour("sector_id").alias("sector_colour"))


@R.add(f"SELECT plant_id, round(area_px * 0.013458::DOUBLE * 0.013458::DOUBLE, 9) AS area, CASE WHEN canopy_area >= 0.1811 THEN 'Mature' WHEN canopy_area >= 0.1449 THEN 'Fruiting' WHEN canopy_area >= 0.1177 THEN 'Flowering' WHEN canopy_area >= 0.0815 THEN 'Vegetative' WHEN canopy_area IS NOT NULL THEN 'Seedling' END AS rule_stage FROM {PLANTS}")
def growth_stage_ladder(spark: SparkSession, d: str) -> DataFrame:
    """Ground area and stage by rule."""
    return plants(spark, d).select("plant_id", half_away(indices.ground_area("area_px"), 9).alias("area"), ladders.growth_stage("canopy_area").alias("rule_stage"))


_RANK = "(rank() OVER (ORDER BY {0}) + (count(*) OVER (PARTITION BY {0}) - 1) / 2.0::DOUBLE) / count(*) OVER () * 100"


@R.add(f"SELECT plant_id, ndvi, round({_RANK.format('ndvi')}, 6) AS biomass_score FROM {PLANTS} WHERE ndvi IS NOT NULL")
def rank_percentile_score(spark: SparkSession, d: str) -> DataFrame:
    """Percentile rank with ties averaged."""
    rows = plants(spark, d).where("ndvi IS NOT NULL").select("plant_id", "ndvi")
    return indices.average_rank_score(rows, "ndvi", "biomass_score").withColumn("biomass_score", _ROUND("biomass_score"))


@R.add(f"""WITH v AS (SELECT plant_id, osavi, {_RANK.format('ndvi')} AS b, {_RANK.format('ndre')} AS n FROM {PLANTS} WHERE ndvi IS NOT NULL AND ndre IS NOT NULL)
  SELECT plant_id, round(b, 6) AS b, round(n, 6) AS n, CASE WHEN b >= 66 AND n >= 66 THEN 'Healthy & vigorous' WHEN b < 33 AND n < 33 THEN 'Critical (low biomass & N)' WHEN n < 33 THEN 'Nitrogen deficient' WHEN b < 33 THEN 'Sparse canopy / early growth' ELSE 'Moderate' END AS diagnosis,
    CASE WHEN n < b - 12 THEN 'Nitrogen' WHEN b < n - 12 THEN 'Biomass' ELSE 'Balanced' END AS factor, round(CASE WHEN b < 33 AND n < 33 AND coalesce(osavi < 0.2, false) THEN least(0.55 * b + 0.45 * n, 12) ELSE 0.55 * b + 0.45 * n END, 6) AS score FROM v""")
def agronomic_diagnosis(spark: SparkSession, d: str) -> DataFrame:
    """Diagnosis, limiting factor and the cap for rows low in both; low osavi stands for the anomaly."""
    rows = plants(spark, d).where("ndvi IS NOT NULL AND ndre IS NOT NULL").select("plant_id", "osavi", "ndvi", "ndre")
    rows = indices.average_rank_score(indices.average_rank_score(rows, "ndvi", "b"), "ndre", "n")
    b, n = F.col("b"), F.col("n")
    score = ladders.capped_both_low(indices.blend((0.55, b), (0.45, n)), b, n, F.col("osavi") < 0.2)
    return rows.select("plant_id", _ROUND("b").alias("b"), _ROUND("n").alias("n"), ladders.diagnosis("b", "n").alias("diagnosis"), ladders.limiting_factor("b", "n").alias("factor"), _ROUND(score).alias("score"))


@R.add(f"""WITH v AS (SELECT *, CASE WHEN stage = 'Seedling' THEN 0.40 ELSE 0.50 END::DOUBLE AS fh, CASE WHEN stage = 'Seedling' THEN 0.20 ELSE 0.25 END::DOUBLE AS fu, avg(osavi) OVER (PARTITION BY stage) AS m FROM {PLANTS}),
  g AS (SELECT *, 0.6 * greatest(0, least(1, (osavi - fu) / (fh - fu))) * 100 + 0.2 * coalesce(greatest(0, least(1, (ndvi - 0.15) / 0.45)) * 100 + 0 * ndvi, 50) + 0.2 * coalesce(greatest(0, least(1, (ndre - 0.10) / 0.30)) * 100 + 0 * ndre, 50) AS vigour, coalesce(ndvi < 0.2, false) AS o FROM v)
  SELECT plant_id, round(CASE WHEN osavi IS NOT NULL THEN vigour END, 6) AS vigour, round(CASE WHEN osavi IS NULL THEN NULL WHEN osavi < fu THEN least(vigour, 14) WHEN o AND osavi < m AND osavi < fu + 0.05 THEN least(vigour, 14) WHEN o AND osavi < m THEN greatest(15, least(39, vigour)) WHEN o THEN greatest(vigour, 70) ELSE vigour END, 6) AS capped FROM g""")
def vigor_blend_caps(spark: SparkSession, d: str) -> DataFrame:
    """Rescaled, blended and capped vigour; low ndvi stands for the outlier."""
    rows = plants(spark, d)
    mean = rows.groupBy(F.col("stage").alias("_s")).agg(F.avg("osavi").alias("_m"))
    rows = rows.join(mean, F.col("stage").eqNullSafe(F.col("_s")), "left")
    v = ladders.vigour(F.col("osavi"), F.col("ndvi"), F.col("ndre"), F.col("stage"))
    return rows.select("plant_id", _ROUND(v).alias("vigour"), _ROUND(ladders.directional_caps(v, F.col("osavi"), F.col("stage"), F.col("ndvi") < 0.2, F.col("_m"))).alias("capped"))


@R.add(f"SELECT plant_id, sector_label, ndvi FROM {PLANTS} WHERE sector_label IS DISTINCT FROM 'NOISE' AND ndvi IS NOT NULL AND osavi IS NOT NULL")
def noise_nullsafe_filter(spark: SparkSession, d: str) -> DataFrame:
    """Rows not labelled NOISE, a missing label included, with both values (F1, F2)."""
    return plants(spark, d).where(nulls.is_not("sector_label", "NOISE")).na.drop(subset=["ndvi", "osavi"]).select("plant_id", "sector_label", "ndvi")


@R.add(f"""SELECT p.plant_id, CASE WHEN ndvi IS NOT NULL AND ndre IS NOT NULL THEN 'measured' WHEN ndvi IS NULL AND sector_label IS DISTINCT FROM 'NOISE' AND m.mask_file IS NOT NULL THEN 'target' ELSE 'none' END AS role, coalesce(osavi >= 0.2, false) AS above_soil
    FROM {PLANTS} p LEFT JOIN (SELECT plant_id, max(mask_file) AS mask_file FROM plants_with_ids GROUP BY plant_id) m ON p.plant_id = m.plant_id""")
def measured_or_gap_source(spark: SparkSession, d: str) -> DataFrame:
    """Which plants are measured, which are gaps to impute, and which pass the soil gate."""
    mask = table(spark, d, "plants_with_ids").groupBy("plant_id").agg(F.max("mask_file").alias("mask_file"))
    rows = plants(spark, d).join(mask, "plant_id", "left")
    gap = F.col("ndvi").isNull() & nulls.is_not("sector_label", "NOISE") & F.col("mask_file").isNotNull()
    return rows.select("plant_id", F.when(F.col("ndvi").isNotNull() & F.col("ndre").isNotNull(), "measured").when(gap, "target").otherwise("none").alias("role"), nulls.holds(F.col("osavi") >= 0.2).alias("above_soil"))


_HEX = "('0x' || substr(health_color, {0}, 2))::INT"
#: The palette once more as plain values, so that the SQL shares nothing with the library.
_PAL = """(0, 165, 0, 38, -0.1::DOUBLE, 'Bare soil (-0.2-0.0)'), (1, 215, 48, 39, 0.05::DOUBLE, 'Very sparse (0.0-0.1)'), (2, 244, 109, 67, 0.15::DOUBLE, 'Sparse (0.1-0.2)'), (3, 253, 174, 97, 0.25::DOUBLE, 'Low (0.2-0.3)'),
  (4, 254, 224, 139, 0.35::DOUBLE, 'Low-moderate (0.3-0.4)'), (5, 255, 255, 191, 0.45::DOUBLE, 'Moderate (0.4-0.5)'), (6, 217, 239, 139, 0.55::DOUBLE, 'Moderate-good (0.5-0.6)'), (7, 166, 217, 106, 0.65::DOUBLE, 'Good (0.6-0.7)'),
  (8, 102, 189, 99, 0.75::DOUBLE, 'Healthy (0.7-0.8)'), (9, 26, 152, 80, 0.85::DOUBLE, 'Very healthy (0.8-0.9)'), (10, 0, 104, 55, 0.95::DOUBLE, 'Dense vegetation (0.9-1.0)')"""


@R.add(f"""WITH p(i, r, g, b, mid, name) AS (VALUES {_PAL}), c AS (SELECT DISTINCT health_color, {_HEX.format(2)} AS cr, {_HEX.format(4)} AS cg, {_HEX.format(6)} AS cb FROM {PLANTS} WHERE health_color IS NOT NULL),
  m AS (SELECT health_color, min({{'d': sqrt((cr - r) ** 2 + (cg - g) ** 2 + (cb - b) ** 2), 'i': i, 'mid': mid, 'name': name}}) AS m FROM c, p GROUP BY health_color)
  SELECT plant_id, x.health_color, m.mid AS value, m.name AS label, round(m.d, 6) AS distance FROM {PLANTS} x LEFT JOIN m ON m.health_color = x.health_color""")
def colormap_reverse_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Index value of a colour: the nearest palette colour, ties to the lower bin."""
    rows = plants(spark, d).select("plant_id", "health_color", *[colours.hex_channel("health_color", i).alias(k) for i, k in enumerate("rgb")])
    return rows.withColumn("n", colours.NDVI.nearest("r", "g", "b")).select("plant_id", "health_color", F.col("n.mid").alias("value"), F.col("n.name").alias("label"), _ROUND("n.d").alias("distance"))


@R.add(f"""WITH p(i, r, g, b, mid, name) AS (VALUES {_PAL}), v AS (SELECT DISTINCT osavi AS value FROM {PLANTS} WHERE osavi IS NOT NULL), m AS (SELECT value, min({{'d': abs(mid - value), 'i': i, 'name': name}}) AS m FROM v, p GROUP BY value)
  SELECT plant_id, osavi, m.name AS label FROM {PLANTS} x LEFT JOIN m ON m.value = x.osavi""")
def midpoint_label(spark: SparkSession, d: str) -> DataFrame:
    """Name of the bin with the nearest midpoint."""
    return plants(spark, d).select("plant_id", "osavi", colours.OSAVI.label("osavi").alias("label"))


_STOPS = [(0.0, (211, 47, 47)), (50.0, (251, 192, 45)), (100.0, (46, 125, 50))]


@R.add("SELECT plant_id, health_score, " + ", ".join(f"CASE WHEN health_score IS NULL THEN NULL WHEN health_score <= 0 THEN {a} WHEN health_score <= 50 THEN floor({a} + health_score / 50 * ({b} - {a}))::INT WHEN health_score <= 100 THEN floor({b} + (health_score - 50) / 50 * ({c} - {b}))::INT ELSE {c} END AS {k}" for k, a, b, c in zip("rgb", *[s[1] for s in _STOPS])) + f" FROM {PLANTS}")
def colour_ramp(spark: SparkSession, d: str) -> DataFrame:
    """Three-stop colour ramp with truncated channels."""
    return plants(spark, d).select("plant_id", "health_score", colours.ramp("health_score", _STOPS).alias("c")).select("plant_id", "health_score", "c.*")


@R.add(f"""WITH z AS (SELECT plant_id, coalesce(ndre, 0.0::DOUBLE) AS z FROM {PLANTS}), q AS (SELECT quantile_cont(round(z, 6), 0.02) AS lo, quantile_cont(round(z, 6), 0.98) AS hi FROM z)
  SELECT plant_id, round(greatest(0, least(1, (z - lo) / (hi - lo))), 6) AS stretched FROM z, q""")
def percentile_stretch(spark: SparkSession, d: str) -> DataFrame:
    """Stretch between the 2nd and 98th percentile, nulls as 0."""
    return colours.percentile_stretch(plants(spark, d).select("plant_id", "ndre"), "ndre", "stretched").select("plant_id", _ROUND("stretched").alias("stretched"))


@R.add(f"SELECT plant_id, sector_id, CASE WHEN max(area_px) OVER w > 0 THEN floor(area_px / (max(area_px) OVER w)::DOUBLE * 255) END::INT AS grey FROM {PLANTS} WHERE sector_id >= 0 WINDOW w AS (PARTITION BY sector_id)")
def dtype_stretch(spark: SparkSession, d: str) -> DataFrame:
    """Integers to 0..255 by each tile's maximum; a sector is the tile (P20)."""
    return colours.to_byte(plants(spark, d).where("sector_id >= 0").select("plant_id", "sector_id", "area_px"), "area_px", "grey", ["sector_id"], True).select("plant_id", "sector_id", "grey")


@R.add(f"SELECT id, round(x, 4) AS x, round(y, 4) AS y, round(lat, 8) AS lat, round(lon, 8) AS lon FROM {SAMPLES}")
def reprojection(spark: SparkSession, d: str) -> DataFrame:
    """Geographic to UTM and back again; the way back must give what went in."""
    rows = samples(spark, d)
    lat, lon = to_latlon("x", "y", ZONE)
    x, y = to_utm("lat", "lon", ZONE)
    return rows.select("id", half_away(x, 4).alias("x"), half_away(y, 4).alias("y"), half_away(lat, 8).alias("lat"), half_away(lon, 8).alias("lon"))


_INV = inverse(SCENE)


@R.add(f"""SELECT plant_id, round({SCENE[0]!r}::DOUBLE * (pixel_x + 0.5::DOUBLE) + {SCENE[2]!r}::DOUBLE, 6) AS centre_x, round({SCENE[4]!r}::DOUBLE * (pixel_y + 0.5::DOUBLE) + {SCENE[5]!r}::DOUBLE, 6) AS centre_y,
    floor({_INV[0]!r}::DOUBLE * x + {_INV[1]!r}::DOUBLE * y + {_INV[2]!r}::DOUBLE)::INT AS col, round(pixel_x * (1024 / 480000.0::DOUBLE), 2) AS shown_x FROM {POSITIONS}""")
def affine_pixels(spark: SparkSession, d: str) -> DataFrame:
    """Pixel centres to ground, ground to pixel, preview scale."""
    cx, cy = apply_affine(SCENE, "pixel_x", "pixel_y", 0.5)
    col, _ = pixel_of(SCENE, "x", "y")
    return positions(spark, d).select("plant_id", _ROUND(cx).alias("centre_x"), _ROUND(cy).alias("centre_y"), col.alias("col"), half_away(F.col("pixel_x") * F.lit(1024 / 480000.0), 2).alias("shown_x"))


#: fmt rounds the exact binary value, as Python's round does; a rounded product does not.
_STRIP = "regexp_replace(format('{{:.4f}}', {0}), '(\\.\\d+?)0+$', '\\1')"


@R.add(f"""SELECT w.plant_id, sector_label, format('PLT-{{}}-R{{:03d}}-C{{:03d}}-{{}}', CASE WHEN sector_id >= 0 THEN format('S{{:02d}}', sector_id) ELSE 'NOISE' END, coalesce(row_index, 0), coalesce(col_index, 0),
    upper(substr(md5({_STRIP.format('geo_x')} || ',' || {_STRIP.format('geo_y')}), 1, 6))) AS made_id FROM plants_with_ids w WHERE geo_x BETWEEN 200000 AND 800000 AND geo_y BETWEEN 1000000 AND 1600000""")
def geo_hash_id(spark: SparkSession, d: str) -> DataFrame:
    """Hashes of positions and the ids made of them."""
    rows = table(spark, d, "plants_with_ids").where("geo_x BETWEEN 200000 AND 800000 AND geo_y BETWEEN 1000000 AND 1600000")
    return rows.select("plant_id", "sector_label", plant_id(sector_label("sector_id"), "row_index", "col_index", geo_hash("geo_x", "geo_y")).alias("made_id"))


@R.add(f"""SELECT plant_id, CASE WHEN area_px IS NULL THEN 'n/a' ELSE format('{{:02d}}:{{:02d}}:{{:02d}}', area_px // 3600, area_px % 3600 // 60, area_px % 60) END AS hms, CASE WHEN osavi IS NULL THEN 'n/a' ELSE format('{{:.3f}}', round(osavi, 3)) END AS shown,
    CASE WHEN osavi IS NULL OR osavi = 0 THEN 0.5 ELSE osavi END::DOUBLE AS or_default, coalesce(try_cast(coalesce(sector_label, stage) AS DOUBLE), -1) AS first_number FROM {PLANTS}""")
def report_formats(spark: SparkSession, d: str) -> DataFrame:
    """Durations, fixed decimals, zero as missing, first number of several columns."""
    rows = plants(spark, d)
    return rows.select("plant_id", text.duration("area_px").alias("hms"), text.decimals("osavi", 3, "half_away").alias("shown"), nulls.or_default("osavi", 0.5).alias("or_default"), F.coalesce(nulls.first_number("sector_label", "stage"), F.lit(-1.0)).alias("first_number"))


@R.add(f"""SELECT plant_id, lower(concat_ws(' ', plant_id, sector_label, 'R' || lpad(row_index::VARCHAR, 3, '0'), 'C' || lpad(col_index::VARCHAR, 3, '0'))) AS search_key FROM plants_with_ids
    WHERE contains(lower(concat_ws(' ', plant_id, sector_label, 'R' || lpad(row_index::VARCHAR, 3, '0'), 'C' || lpad(col_index::VARCHAR, 3, '0'))), 'r007')""")
def viewer_search(spark: SparkSession, d: str) -> DataFrame:
    """Search of plants by a lower-case key."""
    r, c = text.row_col_code("row_index", "col_index")
    return table(spark, d, "plants_with_ids").withColumn("search_key", text.search_key("plant_id", "sector_label", r, c)).where(F.col("search_key").contains("r007")).select("plant_id", "search_key")


@R.add(f"""WITH s AS (SELECT stage, sector_label, health_score FROM {PLANTS} WHERE health_score >= 40 AND stage IS NOT NULL), c AS (SELECT sector_label, count(*) AS shown, round(avg(health_score), 9) AS mean_score FROM s GROUP BY sector_label)
  SELECT sector_label, shown, mean_score, round(shown / max(shown) OVER ()::DOUBLE, 9) AS bar FROM c""")
def viewer_stats(spark: SparkSession, d: str) -> DataFrame:
    """Filtered counts and means by sector, with bars relative to the longest."""
    c = plants(spark, d).where("health_score >= 40 AND stage IS NOT NULL").groupBy("sector_label").agg(F.count(F.lit(1)).alias("shown"), half_away(F.avg("health_score"), 9).alias("mean_score"))
    top = c.agg(F.max("shown").alias("_top"))
    return c.crossJoin(F.broadcast(top)).select("sector_label", "shown", "mean_score", half_away(F.col("shown") / F.col("_top"), 9).alias("bar"))  # one row


@R.add(f"SELECT DISTINCT sector_id FROM {PLANTS} p WHERE sector_id >= 0 AND EXISTS (SELECT 1 FROM {PLANTS} q WHERE q.sector_id = p.sector_id AND q.health_score < 10)")
def visible_sectors(spark: SparkSession, d: str) -> DataFrame:
    """Sectors that still have a plant after the filter (J15, DISTINCT)."""
    from furrow.operators.joins import keep_visible

    rows = plants(spark, d)
    return keep_visible(rows.where("sector_id >= 0").select("sector_id").distinct(), rows, "sector_id", F.col("health_score") < 10)


@R.add(f"SELECT sector_label AS label, count(*) AS n FROM {PLANTS} WHERE sector_label IS NOT NULL GROUP BY 1 ORDER BY n DESC, label")
def label_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts by label, most frequent first (A2)."""
    return aggregates.label_counts(plants(spark, d), "sector_label").orderBy(F.desc("n"), "label")


@R.add(f"SELECT count(*) AS n, count(*) FILTER (ndvi IS NOT NULL) AS measured, count(*) FILTER (sector_label = 'NOISE') AS noise, count(*) FILTER (health_score < 15) AS critical FROM {PLANTS}")
def conditional_counts(spark: SparkSession, d: str) -> DataFrame:
    """Several conditional counts in one pass (A3)."""
    return aggregates.conditional_counts(plants(spark, d), measured=F.col("ndvi").isNotNull(), noise=F.col("sector_label") == "NOISE", critical=F.col("health_score") < 15)


@R.add(f"SELECT sector_id, round(avg(ndvi), 9) AS ndvi, round(avg(ndre), 9) AS ndre, round(avg(osavi), 9) AS osavi, count(ndvi) AS n FROM {PLANTS} WHERE sector_id >= 0 GROUP BY sector_id")
def null_skipping_means(spark: SparkSession, d: str) -> DataFrame:
    """Means of several columns without nulls and NaN; none gives null."""
    return plants(spark, d).where("sector_id >= 0").groupBy("sector_id").agg(*[half_away(F.avg(c), 9).alias(c) for c in ("ndvi", "ndre", "osavi")], F.count("ndvi").alias("n"))


@R.add(f"SELECT stage, median(round(osavi, 6)) AS med, quantile_cont(round(osavi, 6), 0.9) AS q90, round(CASE WHEN stddev_pop(osavi) > 0.01 THEN stddev_pop(osavi) ELSE 0.05 END, 6) AS sd FROM {PLANTS} WHERE stage IS NOT NULL AND osavi IS NOT NULL GROUP BY stage")
def cohort_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Exact median and quantile over a histogram, deviation with a floor."""
    rows = plants(spark, d).where("stage IS NOT NULL AND osavi IS NOT NULL")
    h = rows.groupBy("stage", half_away("osavi", 6).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    q = h.groupBy("stage").agg(F.percentile("v", [0.5, 0.9], F.col("c")).alias("q"))
    sd = rows.groupBy("stage").agg(F.stddev_pop("osavi").alias("s"))
    return q.join(sd, "stage").select("stage", F.col("q")[0].alias("med"), F.col("q")[1].alias("q90"), _ROUND(F.when(F.col("s") > 0.01, F.col("s")).otherwise(0.05)).alias("sd"))


@R.add(f"SELECT round(corr(ndvi, ndre), 6) AS ndvi_ndre, round(corr(ndvi, osavi), 6) AS ndvi_osavi FROM {PLANTS}")
def index_correlation(spark: SparkSession, d: str) -> DataFrame:
    """Correlations over the rows where both exist."""
    return aggregates.correlations(plants(spark, d), {"ndvi_ndre": ("ndvi", "ndre"), "ndvi_osavi": ("ndvi", "osavi")})


@R.add(f"SELECT sector_id, arg_max(plant_id, (health_score, -area_px)) AS plant_id, max(health_score) AS health_score FROM (SELECT sector_id, min(plant_id) AS plant_id, health_score, area_px FROM {PLANTS} WHERE sector_id >= 0 AND health_score IS NOT NULL AND area_px IS NOT NULL GROUP BY sector_id, health_score, area_px) GROUP BY sector_id")
def best_row(spark: SparkSession, d: str) -> DataFrame:
    """The best row of each group, the first in sequence among equals (A10)."""
    rows = plants(spark, d).where("sector_id >= 0 AND health_score IS NOT NULL AND area_px IS NOT NULL").groupBy("sector_id", "health_score", "area_px").agg(F.min("plant_id").alias("plant_id"))
    return aggregates.best_row(rows, F.col("health_score"), F.col("area_px"), ["sector_id"]).select("sector_id", "plant_id", "health_score")


@R.add("SELECT plant_id, arg_max(health_score, created_at) AS last_score, max(created_at) AS last_at, count(*) AS deliveries FROM (SELECT DISTINCT plant_id, created_at, CASE WHEN health_score BETWEEN 0 AND 100 THEN health_score END AS health_score FROM pineapple_crops) WHERE health_score IS NOT NULL GROUP BY plant_id")
def final_row(spark: SparkSession, d: str) -> DataFrame:
    """The last value of an ordered log."""
    rows = table(spark, d, "pineapple_crops").select("plant_id", "created_at", F.when(F.col("health_score").between(0, 100), F.col("health_score")).alias("health_score")).distinct().where("health_score IS NOT NULL")
    return rows.groupBy("plant_id").agg(F.max_by("health_score", "created_at").alias("last_score"), F.max("created_at").alias("last_at"), F.count(F.lit(1)).alias("deliveries"))


@R.add(f"SELECT round(1 - sum((ndvi - p) ** 2) / (var_pop(ndvi) * count(*)), 6) AS r2, count(*) AS n FROM (SELECT ndvi, 0.1 + 0.8 * osavi AS p FROM {PLANTS} WHERE ndvi IS NOT NULL AND osavi IS NOT NULL)")
def holdout_r2(spark: SparkSession, d: str) -> DataFrame:
    """R squared of a prediction."""
    rows = plants(spark, d).where("ndvi IS NOT NULL AND osavi IS NOT NULL").select("ndvi", (0.1 + 0.8 * F.col("osavi")).alias("p"))
    return aggregates.ground_truth_fit(rows, "ndvi", "p").select(_ROUND("r2").alias("r2"), "n")


_OTSU = f"""WITH h AS (SELECT stage, floor(health_score)::INT AS bin, count(*)::DOUBLE AS n FROM {PLANTS} WHERE health_score IS NOT NULL AND stage IS NOT NULL GROUP BY ALL),
  e AS (SELECT stage, bin, bin + 0.5::DOUBLE AS c, coalesce(n, 0) AS n FROM (SELECT DISTINCT stage, unnest(range(0, 256))::INT AS bin FROM h) LEFT JOIN h USING (stage, bin)),
  s AS (SELECT stage, bin, c, sum(n) OVER u AS w1, sum(n * c) OVER u AS s1, sum(n) OVER d AS w2, sum(n * c) OVER d AS s2 FROM e WINDOW u AS (PARTITION BY stage ORDER BY bin ROWS UNBOUNDED PRECEDING), d AS (PARTITION BY stage ORDER BY bin ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
  z AS (SELECT *, CASE WHEN w1 = 0 THEN 1e-5 ELSE w1 END AS v1, CASE WHEN w2 = 0 THEN 1e-5 ELSE w2 END AS v2 FROM s WHERE bin < 255)
  SELECT stage, arg_max(c, (round(v1 * v2 * (s1 / v1 - s2 / v2) ** 2, 3), -bin)) AS threshold FROM z GROUP BY stage"""


@R.add(_OTSU)
def otsu_threshold(spark: SparkSession, d: str) -> DataFrame:
    """Threshold of the greatest variance between classes from cumulative sums both ways."""
    return aggregates.otsu_threshold(plants(spark, d).where("stage IS NOT NULL"), "health_score", ["stage"])


@R.add(f"WITH t AS ({_OTSU}) SELECT plant_id, coalesce(health_score > greatest(threshold, 50), false) AS sunlit FROM {PLANTS} p LEFT JOIN t ON t.stage = p.stage")
def sunlit_mask(spark: SparkSession, d: str) -> DataFrame:
    """Brighter than the threshold and than its floor."""
    rows = plants(spark, d)
    t = aggregates.otsu_threshold(rows.where("stage IS NOT NULL"), "health_score", ["stage"])
    return rows.join(t, "stage", "left").select("plant_id", nulls.holds(aggregates.sunlit(F.col("health_score"), F.col("threshold"))).alias("sunlit"))


@R.add(f"""SELECT plant_id, sector_label, round(osavi, 3) AS osavi, NULL::DOUBLE AS estimated_height, osavi IS NOT NULL AS has_index, sector_id FROM {PLANTS} ORDER BY has_index DESC, sector_label ASC NULLS LAST, plant_id""")
def ordered_output(spark: SparkSession, d: str) -> DataFrame:
    """Preferred columns first, missing columns as nulls, rounded, sorted with nulls last (P26, P27, P28, sort)."""
    rows = plants(spark, d).withColumn("has_index", F.col("osavi").isNotNull()).select("sector_id", "plant_id", "sector_label", "osavi", "has_index")
    rows = text.round_floats(rows, 3, "half_away")
    rows = text.with_null_columns(rows, {"estimated_height": "double"})
    return text.ordered_columns(rows, ["plant_id", "sector_label", "osavi", "estimated_height"]).orderBy(F.desc("has_index"), F.asc_nulls_last("sector_label"), "plant_id")


@R.add(f"""WITH n AS (SELECT plant_id, md5('42|' || plant_id) AS h, count(*) OVER () AS n, row_number() OVER (ORDER BY md5('42|' || plant_id), plant_id) AS i FROM {PLANTS})
  SELECT plant_id, CASE WHEN i <= floor(n * 0.8::DOUBLE) THEN 'train' WHEN i <= floor(n * 0.8::DOUBLE) + floor(n * 0.1::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM n""")
def seeded_split(spark: SparkSession, d: str) -> DataFrame:
    """Seeded split with exact counts, the rest to the last part."""
    return counted_split(plants(spark, d).select("plant_id"), "plant_id", 42).select("plant_id", "split")


@R.add("""WITH d AS (SELECT image, image_size.width AS width, unnest(detections) AS d FROM detections)
  SELECT image, width, d.detection_id, d.class_name, d.confidence, d.bbox_xyxy[3] - d.bbox_xyxy[1] AS box_width, len(d.polygon) AS corners FROM d WHERE d.confidence >= 0.25""")
def nested_detections(spark: SparkSession, d: str) -> DataFrame:
    """Exploded detections of at least the confidence limit."""
    from furrow.sources.readers import exploded_detections

    rows = exploded_detections(table(spark, d, "detections")).where("confidence >= 0.25")
    return rows.select("image", "width", "detection_id", "class_name", "confidence", (F.col("bbox_xyxy")[2] - F.col("bbox_xyxy")[0]).alias("box_width"), F.size("polygon").cast("long").alias("corners"))


@R.add("""SELECT image, unnest(list_zip(boxes[1:m], scores[1:m])).* FROM (SELECT *, least(len(boxes), len(scores)) AS m FROM (SELECT DISTINCT image, list_transform(detections, lambda x: x.bbox_xyxy[1]) AS boxes, list_transform(list_filter(detections, lambda x: x.confidence >= 0.5), lambda x: x.confidence) AS scores FROM detections))""".replace("unnest(list_zip(boxes[1:m], scores[1:m])).*", "unnest(boxes[1:m]) AS box, unnest(scores[1:m]) AS score"))
def zipped_results(spark: SparkSession, d: str) -> DataFrame:
    """Parallel lists by position, the shortest decides."""
    from furrow.operators.joins import zip_shortest

    rows = table(spark, d, "detections").select("image", F.transform("detections", lambda x: x["bbox_xyxy"][0]).alias("boxes"), F.transform(F.filter("detections", lambda x: x["confidence"] >= 0.5), lambda x: x["confidence"]).alias("scores")).distinct()
    return rows.select("image", F.explode(zip_shortest("boxes", "scores")).alias("z")).select("image", F.col("z.boxes").alias("box"), F.col("z.scores").alias("score"))


@R.add("""SELECT DISTINCT c.plant_id AS stem, c.plant_id || '.csv' AS left_path, p.mask_file AS right_path FROM pineapple_crops c JOIN plants_with_ids p ON regexp_replace(regexp_replace(p.mask_file, '\\.[^.]*$', ''), '_mask$', '') = c.plant_id""")
def label_pair_match(spark: SparkSession, d: str) -> DataFrame:
    """Files of one stem, a suffix taken off."""
    from furrow.operators.joins import match_by_stem

    left = table(spark, d, "pineapple_crops").select(F.concat("plant_id", F.lit(".csv")).alias("f")).distinct()
    return match_by_stem(left, "f", table(spark, d, "plants_with_ids").select("mask_file").distinct(), "mask_file", ["_mask"])


@R.add(f"SELECT plant_id, 'crops' AS origin FROM {PLANTS} UNION ALL SELECT DISTINCT plant_id, 'ids' FROM plants_with_ids")
def concatenated(spark: SparkSession, d: str) -> DataFrame:
    """Lists put behind each other (union)."""
    return plants(spark, d).select("plant_id", F.lit("crops").alias("origin")).unionByName(table(spark, d, "plants_with_ids").select("plant_id").distinct().withColumn("origin", F.lit("ids")))


QUERIES, SQL = R.queries, R.sql
