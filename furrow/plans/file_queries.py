"""Queries that write files and read them again, and those of file formats' own rules: what comes back must be what went in."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.functions.geo import compose, inverse, pixel_of
from furrow.functions.rounding import half_away
from furrow.operators import raster, tiles
from furrow.operators.aggregates import otsu_threshold
from furrow.plans.base import PIXELS, PLANTS, POSITIONS, SCENE, ZONE, Registry, pixels, plants, positions
from furrow.plans.crops import table
from furrow.session import scratch, stage
from furrow.sources import readers, tiff, writers

R = Registry()
_IDS = "plant_id, instance_id, sector_id, sector_label, row_index, col_index, pixel_x, pixel_y, geo_x, geo_y, area_px, mask_file"


@R.add(f"SELECT {_IDS.replace('geo_x', 'CASE WHEN abs(geo_x) < 1e300 THEN geo_x END AS geo_x').replace('geo_y', 'CASE WHEN abs(geo_y) < 1e300 THEN geo_y END AS geo_y').replace('sector_label', 'nullif(sector_label, $$$$) AS sector_label')} FROM plants_with_ids")
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The plant table written as CSV and read by its schema."""
    path = scratch(spark, "csv")
    writers.write_csv(table(spark, d, "plants_with_ids"), path)
    return readers.read_plants_csv(spark, path).select(*_IDS.split(", "))


@R.add("SELECT lat, lon, ndvi, ndre FROM raw_index_grid WHERE ndvi IS NOT NULL AND NOT isnan(ndvi) AND ndre IS NOT NULL AND NOT isnan(ndre) AND lat IS NOT NULL AND NOT isnan(lat) AND lon IS NOT NULL AND NOT isnan(lon)")
def grid_csv(spark: SparkSession, d: str) -> DataFrame:
    """Index samples from CSV; rows without position or either index are left out."""
    path = scratch(spark, "grid")
    writers.write_csv(table(spark, d, "raw_index_grid"), path)
    return readers.read_index_grid(spark, path, ZONE).select("lat", "lon", "ndvi", "ndre")


@R.add(f"SELECT plant_id, area_px, round(x, 6) AS x, round(y, 6) AS y, 'EPSG:32651' AS crs FROM {POSITIONS}")
def geojson_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """One FeatureCollection a part of the table, read again as points."""
    f = writers.point_features(positions(spark, d).select("plant_id", "area_px", "x", "y"), "x", "y", ["plant_id", "area_px"])
    part = f.withColumn("_p", F.spark_partition_id()).withColumn("_q", F.floor(F.row_number().over(_in_part()) / 1000))  # a document holds a thousand
    doc = part.groupBy("_p", "_q").agg(F.concat(F.lit('{"type":"FeatureCollection","crs":{"type":"name","properties":{"name":"EPSG:32651"}},"features":['), F.array_join(F.collect_list("json"), ","), F.lit("]}")).alias("value"))
    path = scratch(spark, "geojson")
    doc.select(F.regexp_replace("value", r"[\r\n]", " ").alias("value")).write.text(path)
    rows = readers.read_points_geojson(spark, path, "plant_id:string,area_px:int", lines=True)
    return rows.select("plant_id", "area_px", "x", "y", "crs")


def _in_part():
    from pyspark.sql import Window

    return Window.partitionBy("_p").orderBy("json")


@R.add("SELECT zone_id - 1 AS feature, i::INT AS corner, ring[i + 1][1] AS x, ring[i + 1][2] AS y, round(area, 3) AS area FROM (SELECT zone_id, ring, unnest(range(len(ring))) AS i, abs(list_sum(list_transform(range(1, len(ring) + 1), lambda k: ring[k][1] * ring[k % len(ring) + 1][2] - ring[k % len(ring) + 1][1] * ring[k][2]))) / 2 AS area FROM boundary_zones)")
def boundary_geojson(spark: SparkSession, d: str) -> DataFrame:
    """Zones as one boundary document, read again as rings with their area."""
    zones = table(spark, d, "boundary_zones").orderBy("zone_id")
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array("ring").alias("coordinates"))
    f = zones.select("zone_id", F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"))).alias("json"))
    one = f.agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("zone_id", "json"))), lambda z: z["json"]), ","), F.lit("]}")).alias("value"))  # twelve zones
    path = scratch(spark, "zones")
    one.coalesce(1).write.text(path)
    rings = readers.read_rings_geojson(spark, path)
    return rings.select("feature", half_away("area", 3).alias("area"), F.posexplode("ring").alias("corner", "p")).select("feature", "corner", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"), "area")


@R.add(f"SELECT row, first, last FROM (SELECT row, min(col) AS first, max(col) AS last FROM (SELECT row, col, col - row_number() OVER (PARTITION BY row ORDER BY col) AS g FROM (SELECT DISTINCT row, col FROM {PIXELS})) GROUP BY row, g)")
def run_length_json(spark: SparkSession, d: str) -> DataFrame:
    """A mask as run-length documents of a few rows each, read again and run together."""
    runs = tiles.run_lengths(pixels(spark, d), ["row"], "col").withColumn("image", F.floor(F.col("row") / 64))
    docs = tiles.runs_json(runs, ["image"], "row", F.lit(14000), F.lit(64))
    path = scratch(spark, "runs")
    docs.select("json").write.text(path)
    back = readers.mask_pixels_of_runs(spark.read.text(path).select(F.lit("scene").alias("image"), F.col("value").alias("json")))
    return tiles.run_lengths(back, ["row"], "col")


@R.add(f"SELECT row, n, min(col) AS first, max(col) AS last FROM (SELECT row, col, n, col - row_number() OVER (PARTITION BY row, n ORDER BY col) AS g FROM (SELECT row, col, count(*) AS n FROM {PIXELS} GROUP BY ALL)) GROUP BY row, n, g")
def run_length_counts_json(spark: SparkSession, d: str) -> DataFrame:
    """The counts form of the run-length document (K4)."""
    counted = pixels(spark, d).groupBy("row", "col").agg(F.count(F.lit(1)).alias("n"))
    runs = tiles.run_lengths(counted, ["row"], "col", "n").withColumn("image", F.floor(F.col("row") / 64))
    docs = tiles.runs_json(runs, ["image"], "row", F.lit(14000), F.lit(64), "n")
    doc = F.from_json("json", "format string, rows array<struct<y:int,x_runs:array<array<int>>>>")
    r = docs.select(doc.alias("m")).where("m.format = 'row_runs_counts_v1'").select(F.explode("m.rows").alias("r")).select(F.col("r.y").alias("row"), F.explode("r.x_runs").alias("x"))
    return r.select("row", F.col("x")[2].cast("long").alias("n"), F.col("x")[0].alias("first"), F.col("x")[1].alias("last"))


@R.add(f"SELECT row // 32 AS block, count(*) AS px, sum(row % 32)::BIGINT AS rows, sum(col)::BIGINT AS cols FROM (SELECT DISTINCT row, col FROM {PIXELS}) GROUP BY 1")
def mask_png_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Blocks of a mask as PNG files with their boxes, decoded again."""
    p = pixels(spark, d).select(F.floor(F.col("row") / 32).cast("int").alias("block"), (F.col("row") % 32).alias("row"), "col", F.floor(F.col("col") / 1024).alias("c")).distinct()
    p = p.select(F.concat_ws("_", F.col("block"), F.col("c")).alias("id"), "row", "col")
    images = stage(writers.mask_images(p, "id"), "images")
    path = scratch(spark, "png").removeprefix("file://").removeprefix("file:")
    writers.write_mask_files(images, path)
    box = images.select(F.col("mask_file").alias("file"), F.col("bbox.x").alias("x0"), F.col("bbox.y").alias("y0"), "id")
    set_ = readers.read_mask_pixels(spark, path).join(box, "file")
    return set_.groupBy(F.split("id", "_")[0].cast("int").alias("block")).agg(F.count(F.lit(1)).alias("px"), F.sum(F.col("row") + F.col("y0")).alias("rows"), F.sum(F.col("col") + F.col("x0")).alias("cols"))


_MEANS = f"(SELECT floor(row / 8)::INT AS row, floor(col / 8)::INT AS col, round(avg(osavi), 9) AS v FROM {PIXELS} WHERE osavi IS NOT NULL GROUP BY ALL)"


@R.add(f"SELECT row, col, v FROM {_MEANS} WHERE v <> 0 AND row >= 0 AND col >= 0")
def geotiff_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """A raster of means as GeoTIFF tiles with their own positions, read again through the format's source and put back by position."""
    means = raster.decimated(pixels(spark, d).where("osavi IS NOT NULL"), ["osavi"], 8).select("row", "col", half_away("osavi", 9).alias("v")).where("row >= 0 AND col >= 0")
    folder = scratch(spark, "tif").removeprefix("file://").removeprefix("file:")
    grid = (4.0, 0.0, 400000.0, 0.0, -4.0, 1100500.0)

    def save(rows):
        os.makedirs(folder, exist_ok=True)
        for r in rows:
            with open(os.path.join(folder, r["name"]), "wb") as out:
                out.write(r["tif"])

    tiff.tile_files(means, "v", grid, 32651, 256, "float64").select("name", "tif").foreachPartition(save)
    spark.dataSource.register(tiff.GeoTiffSource)
    at = spark.read.format("geotiff").option("mode", "info").load(folder).select("path", F.col("affine")[2].alias("x0"), F.col("affine")[5].alias("y0"))
    px = spark.read.format("geotiff").load(folder).where(F.col("bands")[0] != 0).join(at, "path")
    col, row = pixel_of(grid, F.col("x0") + 4.0 * (F.col("col") + 0.5), F.col("y0") - 4.0 * (F.col("row") + 0.5))
    return px.select(row.alias("row"), col.alias("col"), F.col("bands")[0].alias("v"))


@R.add(f"SELECT count(DISTINCT (row // 256, col // 256)) AS files, 256 AS width, 32651 AS epsg, true AS inside FROM {_MEANS} WHERE row >= 0 AND col >= 0")
def tiff_metadata(spark: SparkSession, d: str) -> DataFrame:
    """The metadata documents of GeoTIFF files: size, code, and that their longitude and latitude lie about the field."""
    import json

    means = raster.decimated(pixels(spark, d).where("osavi IS NOT NULL"), ["osavi"], 8).where("row >= 0 AND col >= 0")
    made = tiff.tile_files(means, "osavi", (4.0, 0.0, 400000.0, 0.0, -4.0, 1100500.0), 32651, 256)

    def f(it):
        for pdf in it:
            yield pdf.assign(json=[json.dumps(tiff.metadata(tiff.read_header(n, t))) for n, t in zip(pdf["name"], pdf["tif"])])[["json"]]

    m = made.select("name", "tif").mapInPandas(f, "json string")
    doc = m.select(F.from_json("json", "width int, crs_epsg int, gsd_cm double, bounds_lonlat struct<west:double,south:double,east:double,north:double>").alias("m"))
    b = F.col("m.bounds_lonlat")
    inside = (b["west"] >= 122.0) & (b["east"] <= 122.3) & (b["south"] >= 9.9) & (b["north"] <= 10.0) & (b["west"] < b["east"]) & (F.col("m.gsd_cm") == 400.0)
    return doc.agg(F.count(F.lit(1)).alias("files"), F.max("m.width").alias("width"), F.max("m.crs_epsg").alias("epsg"), F.min(inside).alias("inside"))


@R.add("SELECT DISTINCT image AS file, 0 AS class_id, round(((b[1] + b[3]) / 2) / 640, 6) AS cx, round(((b[2] + b[4]) / 2) / 640, 6) AS cy FROM (SELECT image, unnest(detections).bbox_xyxy AS b FROM detections)")
def yolo_labels(spark: SparkSession, d: str) -> DataFrame:
    """Boxes as label files, one an image, read again."""
    b = table(spark, d, "detections").select("image", F.explode("detections").alias("d")).select("image", F.col("d.bbox_xyxy").alias("b")).distinct()
    v = [(F.col("b")[0] + F.col("b")[2]) / 2 / 640, (F.col("b")[1] + F.col("b")[3]) / 2 / 640, (F.col("b")[2] - F.col("b")[0]) / 640, (F.col("b")[3] - F.col("b")[1]) / 640]
    lines = b.select("image", F.concat_ws(" ", F.lit("0"), *[F.format_string("%.9f", half_away(x, 6)) for x in v]).alias("line"))
    folder = scratch(spark, "labels").removeprefix("file://").removeprefix("file:")
    docs = lines.groupBy("image").agg(F.array_join(F.collect_list("line"), "\n").alias("text"))  # an image's boxes

    def save(rows):
        os.makedirs(folder, exist_ok=True)
        for r in rows:
            with open(os.path.join(folder, r["image"].replace("/", "%") + ".txt"), "w") as out:
                out.write(r["text"] + "\n")

    docs.foreachPartition(save)
    names = readers.list_files(spark, folder, "*.txt").select(F.col("name").alias("file"))
    got = readers.read_yolo_labels(spark, folder).join(names, "file", "left_semi")
    return got.select(F.regexp_replace(F.replace("file", F.lit("%"), F.lit("/")), r"\.txt$", "").alias("file"), "class_id", "cx", "cy").distinct()


@R.add("SELECT source AS key, target_share AS value FROM mix_targets")
def key_value_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines "key: value" with comments and blank lines between, read again."""
    t = table(spark, d, "mix_targets").select(F.concat(F.lit("# share\n\n  "), "source", F.lit(" : "), F.col("target_share").cast("string")).alias("value"))
    path = scratch(spark, "values")
    t.write.text(path)
    return readers.read_key_values(spark, path).select("key", F.col("value").cast("double").alias("value"))


@R.add(f"SELECT plant_id, floor((row_number() OVER (ORDER BY plant_id) - 1) / ceil(count(*) OVER () / 8.0::DOUBLE))::INT AS chunk FROM {PLANTS}")
def chunks(spark: SparkSession, d: str) -> DataFrame:
    """Eight runs of plants of equal length, in order."""
    return tiles.chunked(plants(spark, d).select("plant_id"), "plant_id", 8).select("plant_id", "chunk")


@R.add("SELECT DISTINCT image, regexp_extract(image, 'tile_(\\d+)_', 1)::INT AS y, regexp_extract(image, '_(\\d+)\\.png', 1)::INT AS x FROM detections WHERE regexp_matches(image, 'tile_\\d+_\\d+\\.png') ORDER BY y, x, image LIMIT 25")
def first_tiles(spark: SparkSession, d: str) -> DataFrame:
    """The first 25 tiles in the order of the scene, as for a trial run."""
    t = table(spark, d, "detections").select("image").distinct().where(F.col("image").rlike(r"tile_\d+_\d+\.png"))
    t = t.select("image", F.regexp_extract("image", r"tile_(\d+)_", 1).cast("int").alias("y"), F.regexp_extract("image", r"_(\d+)\.png", 1).cast("int").alias("x"))
    return tiles.first_rows(t, ["y", "x", "image"], 25)


@R.add(f"SELECT row, col, (r = 255 AND g = 255 AND b = 255) AS background, r = 0 AS dark FROM (SELECT row, col, CASE WHEN max(area_px) % 3 = 0 THEN 255 ELSE max(area_px) % 256 END AS r, 255 AS g, 255 AS b FROM {PIXELS} WHERE area_px IS NOT NULL GROUP BY ALL)")
def background_colour(spark: SparkSession, d: str) -> DataFrame:
    """Pixels of the background's colour."""
    p = pixels(spark, d).where("area_px IS NOT NULL").groupBy("row", "col").agg(F.max("area_px").alias("a"))
    p = p.select("row", "col", F.when(F.col("a") % 3 == 0, 255).otherwise(F.col("a") % 256).alias("r"), F.lit(255).alias("g"), F.lit(255).alias("b"))
    return p.select("row", "col", raster.background("r", "g", "b").alias("background"), (F.col("r") == 0).alias("dark"))


_OTSU = """e AS (SELECT row, col, bin, bin + 0.5::DOUBLE AS c, coalesce(n, 0) AS n FROM (SELECT DISTINCT row, col, unnest(range(0, 256))::INT AS bin FROM h) LEFT JOIN h USING (row, col, bin)),
  s AS (SELECT row, col, bin, c, sum(n) OVER u AS w1, sum(n * c) OVER u AS s1, sum(n) OVER d AS w2, sum(n * c) OVER d AS s2 FROM e WINDOW u AS (PARTITION BY row, col ORDER BY bin ROWS UNBOUNDED PRECEDING), d AS (PARTITION BY row, col ORDER BY bin ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
  z AS (SELECT *, CASE WHEN w1 = 0 THEN 1e-5 ELSE w1 END AS v1, CASE WHEN w2 = 0 THEN 1e-5 ELSE w2 END AS v2 FROM s WHERE bin < 255),
  t AS (SELECT row, col, arg_max(c, (round(v1 * v2 * (s1 / v1 - s2 / v2) ** 2, 3), -bin)) AS threshold FROM z GROUP BY row, col)"""


@R.add(f"""WITH p AS MATERIALIZED (SELECT row, col, (max(area_px) % 120)::INT AS bright FROM {PIXELS} WHERE area_px IS NOT NULL GROUP BY ALL), w AS MATERIALIZED (SELECT c.row, c.col, q.row AS r, q.col AS k, q.bright FROM p c JOIN (SELECT row + i AS cr, col + j AS cc, row, col, bright FROM p, (VALUES (-1), (0), (1)) s(i), (VALUES (-1), (0), (1)) t(j)) q ON q.cr = c.row AND q.cc = c.col),
  h AS (SELECT row, col, bright AS bin, count(*)::DOUBLE AS n FROM w GROUP BY ALL), {_OTSU}, l AS (SELECT w.*, bright > greatest(threshold, 50) AS lit FROM w JOIN t USING (row, col)), a AS (SELECT *, bool_or(lit) OVER (PARTITION BY row, col) AS any_lit FROM l)
  SELECT row, col, count(*) AS used, sum(bright)::BIGINT AS light FROM a WHERE lit OR (NOT any_lit AND r = row AND k = col) GROUP BY row, col""")
def sunlit_windows(spark: SparkSession, d: str) -> DataFrame:
    """The sunlit pixels of each pixel's window by the window's own threshold; of a window all in shadow, its centre."""
    p = pixels(spark, d).where("area_px IS NOT NULL").groupBy("row", "col").agg((F.max("area_px") % 120).alias("bright"))
    around = raster.neighbourhood(p.select("row", "col", F.col("row").alias("r"), F.col("col").alias("k"), "bright"), 1)
    w = stage(around.join(p.select("row", "col"), ["row", "col"], "left_semi"), "windows")
    w = w.join(otsu_threshold(w, "bright", ["row", "col"]), ["row", "col"])
    kept = raster.sunlit_or_centre(w, ["row", "col"], "bright", "threshold", (F.col("r") == F.col("row")) & (F.col("k") == F.col("col")))
    return kept.groupBy("row", "col").agg(F.count(F.lit(1)).alias("used"), F.sum("bright").alias("light"))


_INDEX = (0.5, 0.0, 399990.0, 0.0, -0.5, 1104010.0)
_A = compose(inverse(_INDEX), SCENE)


@R.add(f"SELECT plant_id, floor((({SCENE[0]!r}::DOUBLE * pixel_x + {SCENE[2]!r}::DOUBLE) - 399990.0::DOUBLE) / 0.5::DOUBLE + 1e-6)::INT AS col, floor((1104010.0::DOUBLE - ({SCENE[4]!r}::DOUBLE * pixel_y + {SCENE[5]!r}::DOUBLE)) / 0.5::DOUBLE + 1e-6)::INT AS row FROM {PLANTS} WHERE pixel_x IS NOT NULL AND pixel_y IS NOT NULL")
def composed_pixels(spark: SparkSession, d: str) -> DataFrame:
    """Pixels of one raster to those of another by the composed map."""
    rows = plants(spark, d).where("pixel_x IS NOT NULL AND pixel_y IS NOT NULL")
    col, row = (F.floor(_A[3 * i] * F.col("pixel_x") + _A[3 * i + 1] * F.col("pixel_y") + _A[3 * i + 2] + 1e-6).cast("int") for i in (0, 1))
    return rows.select("plant_id", col.alias("col"), row.alias("row"))


@R.add(f"SELECT plant_id, sector_id, CASE WHEN ndvi IS NULL THEN NULL WHEN max(ndvi) OVER w > min(ndvi) OVER w THEN floor((ndvi - min(ndvi) OVER w) / (max(ndvi) OVER w - min(ndvi) OVER w) * 255.0::DOUBLE) ELSE 0 END::INT AS grey FROM {PLANTS} WHERE sector_id >= 0 WINDOW w AS (PARTITION BY sector_id)")
def float_stretch(spark: SparkSession, d: str) -> DataFrame:
    """Floats to 0..255 between each tile's least and greatest value (P20)."""
    from furrow.functions.colours import to_byte

    return to_byte(plants(spark, d).where("sector_id >= 0").select("plant_id", "sector_id", "ndvi"), "ndvi", "grey", ["sector_id"], False).select("plant_id", "sector_id", "grey")


@R.add(f"SELECT position, line FROM (SELECT 0::BIGINT AS position, '| stage | plants | mean |' AS line UNION ALL SELECT 1, '|---|---|---|' UNION ALL SELECT row_number() OVER (ORDER BY stage) + 1, '| ' || stage || ' | ' || plants || ' | ' || mean || ' |' FROM (SELECT stage, count(*) AS plants, format('{{:.3f}}', avg(osavi::DECIMAL(18, 6))::DOUBLE) AS mean FROM {PLANTS} WHERE stage IS NOT NULL GROUP BY stage))")
def report_table(spark: SparkSession, d: str) -> DataFrame:
    """A markdown table of stages with counts and means in three decimals (K9)."""
    s = plants(spark, d).where("stage IS NOT NULL").groupBy("stage").agg(F.count(F.lit(1)).alias("plants"), F.avg("osavi").alias("mean"))
    return writers.markdown_rows(s, {"stage": None, "plants": None, "mean": 3}, ["stage"])


@R.add("SELECT plant_id, coalesce(plant_id, '\\N') || chr(9) || coalesce(sector_id::VARCHAR, '\\N') || chr(9) || coalesce(sector_label, '\\N') || chr(9) || coalesce(mask_file, '\\N') AS line FROM plants_with_ids")
def copy_text(spark: SparkSession, d: str) -> DataFrame:
    """Rows as a database's COPY reads them (K7)."""
    t = table(spark, d, "plants_with_ids").select("plant_id", "sector_id", "sector_label", "mask_file")
    return writers.copy_lines(t).select(F.split("line", "\t")[0].alias("plant_id"), "line")


QUERIES, SQL = R.queries, R.sql
