"""Readers: plant tables, GeoJSON, index grids, run summaries, logs, label files, masks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.functions.geo import to_utm
from furrow.functions.nulls import MISSING_TEXT, clean_floats, number

PLANTS = "plant_id string, instance_id int, sector_id int, sector_label string, row_index int, col_index int, pixel_x int, pixel_y int, geo_x double, geo_y double, area_px int, bbox_x int, bbox_y int, bbox_width int, bbox_height int, mask_file string"
GRID = "lat double, lon double, ndvi double, ndre double, nsi double, chlorophyll_idx double, stress_idx double"
DETECTIONS = "image string, image_size struct<width:int,height:int>, detections array<struct<detection_id:int,class_id:int,class_name:string,confidence:double,bbox_xyxy:array<double>,mask_area_pixels:int,polygon:array<array<double>>>>"
RUN_SUMMARY = "source string, tile_size int, overlap double, num_tiles int, centroids array<struct<x:double,y:double,pixel_x:double,pixel_y:double,area_px:double,confidence:double>>, tile_summary array<struct<tile_id:int,x0:int,y0:int,detections:string,segmented_masks:int>>, per_tile_summary array<struct<tile_id:int,x0:int,y0:int,detections:string,segmented_masks:int>>"


def typed_csv(spark: SparkSession, path: str, schema: str | T.StructType, sep: str = ",", header: bool = True) -> DataFrame:
    """CSV with a fixed schema. Every field is read as text, and what stands for a missing value or can't be read is null.

    Columns are found by name; one the file lacks is null, one the schema lacks is ignored. Text keeps the markers
    of missing values only as null.
    """
    want = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if header:
        raw = spark.read.option("header", True).option("sep", sep).option("multiLine", False).csv(path)
        raw = raw.toDF(*[c.lstrip("﻿").strip() for c in raw.columns])
    else:
        text = T.StructType([T.StructField(f.name, T.StringType()) for f in want.fields])
        raw = spark.read.schema(text).option("sep", sep).csv(path)
    out = []
    for f in want.fields:
        if f.name not in raw.columns:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = number(c)
        else:
            t = F.trim(c)
            c = F.when(~t.isin(*MISSING_TEXT), c if isinstance(f.dataType, T.StringType) else t)
            if isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType)):
                c = c.try_cast("double")  # 3.0 is an integer too
        out.append((c if isinstance(f.dataType, T.StringType) else c.try_cast(f.dataType)).alias(f.name))
    return raw.select(*out)


def read_plants_csv(spark: SparkSession, path: str) -> DataFrame:
    """The plant table with x and y beside geo_x and geo_y."""
    return typed_csv(spark, path, PLANTS).withColumns({"x": F.col("geo_x"), "y": F.col("geo_y")})


def read_index_grid(spark: SparkSession, path: str, zone: int) -> DataFrame:
    """Index samples with x and y in the UTM zone; rows without position or either index are left out."""
    return index_grid(typed_csv(spark, path, GRID), zone)


def index_grid(grid: DataFrame, zone: int) -> DataFrame:
    x, y = to_utm("lat", "lon", zone)
    return clean_floats(grid).na.drop(subset=["ndvi", "ndre", "lat", "lon"]).withColumns({"x": x, "y": y})


def read_points_geojson(spark: SparkSession, path: str, properties: str, lines: bool = False) -> DataFrame:
    """Point features as rows: the named properties, x, y and crs (the collection's name, or null). With ``lines`` each line is a document."""
    schema = f"crs struct<properties:struct<name:string>>, features array<struct<type:string,properties:struct<{properties}>,geometry:struct<type:string,coordinates:array<double>>>>"
    rows = spark.read.schema(schema).option("multiLine", not lines).json(path)
    f = rows.select(F.col("crs.properties.name").alias("crs"), F.explode("features").alias("f")).where("f.geometry.type = 'Point'")
    return f.select("f.properties.*", F.get("f.geometry.coordinates", F.lit(0)).alias("x"), F.get("f.geometry.coordinates", F.lit(1)).alias("y"), "crs")


def read_rings_geojson(spark: SparkSession, path: str) -> DataFrame:
    """(feature, part, ring, area): outer rings of Polygon and MultiPolygon features; coordinates are parsed by geometry type."""
    rows = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "^﻿", "").alias("value"))
    features = F.from_json(F.get_json_object("value", "$.features"), "array<struct<geometry:struct<type:string,coordinates:string>>>")
    f = rows.select(F.posexplode(features).alias("feature", "f")).select("feature", "f.geometry.*")
    one = F.array(F.get(F.from_json("coordinates", "array<array<array<double>>>"), F.lit(0)))
    many = F.transform(F.from_json("coordinates", "array<array<array<array<double>>>>"), lambda p: F.get(p, F.lit(0)))
    r = f.select("feature", F.when(F.col("type") == "Polygon", one).when(F.col("type") == "MultiPolygon", many).alias("rings"))
    r = r.select("feature", F.posexplode("rings").alias("part", "ring")).where("ring IS NOT NULL")
    return r.withColumn("area", ring_area(F.col("ring")))


def ring_area(ring):
    """Area by the shoelace formula."""
    nxt = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    pairs = F.arrays_zip(ring.alias("p"), nxt.alias("q"))
    at = lambda e, k, i: F.element_at(e[k], i)
    cross = F.aggregate(pairs, F.lit(0.0), lambda a, e: a + at(e, "p", 1) * at(e, "q", 2) - at(e, "q", 1) * at(e, "p", 2))
    return F.abs(cross) / 2


def projected_ring(ring: Column, zone: int) -> Column:
    """A ring of longitude and latitude in metres of the UTM zone; a ring that isn't geographic (any value beyond 360) stays."""
    def moved(p: Column) -> Column:
        x, y = to_utm(F.element_at(p, 2), F.element_at(p, 1), zone)
        return F.array(x, y)

    far = F.exists(ring, lambda p: (F.abs(F.element_at(p, 1)) > 360) | (F.abs(F.element_at(p, 2)) > 360))
    return F.when(far, ring).otherwise(F.transform(ring, moved))


def largest_ring(rings: DataFrame) -> DataFrame:
    """The ring of the greatest area, which stands for the dissolved boundary."""
    return rings.agg(F.max_by("ring", F.struct("area", (-F.col("feature")).alias("f"), (-F.col("part")).alias("p"))).alias("ring"), F.max("area").alias("area"))


def centroids_of_summary(rows: DataFrame) -> DataFrame:
    """Centroids of run summaries: those listed, else those nested in tile_summary, else in per_tile_summary.

    A tile's detections are a list of objects or only a number; a number has no centroids.
    """
    item = "array<struct<x:double,y:double,pixel_x:double,pixel_y:double,area_px:double,confidence:double>>"
    nested = lambda c: F.flatten(F.filter(F.transform(F.col(c), lambda t: F.from_json(t["detections"], item)), lambda a: a.isNotNull()))
    pick = F.coalesce(*[F.when(F.size(a) > 0, a) for a in (F.col("centroids"), nested("tile_summary"), nested("per_tile_summary"))])
    return rows.select("source", F.posexplode(pick).alias("position", "c")).select("source", "position", "c.*")


def read_run_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SUMMARY).option("multiLine", True).json(path)


def read_detections(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DETECTIONS).option("multiLine", True).json(path)


def exploded_detections(rows: DataFrame) -> DataFrame:
    """One row a detection of a table of images; images without detections give none."""
    return rows.select("image", "image_size", F.explode("detections").alias("d")).select("image", F.col("image_size.width").alias("width"), F.col("image_size.height").alias("height"), "d.*")


def read_epoch_log(spark: SparkSession, path: str) -> DataFrame:
    """A training log: all columns text, names trimmed; use functions.nulls.number on what is needed."""
    raw = spark.read.option("header", True).csv(path)
    return raw.toDF(*[c.strip().lstrip("﻿") for c in raw.columns])


def read_key_values(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of lines "key: value"; cut at the first colon, blank lines and comments left out."""
    t = spark.read.text(path).select(F.trim("value").alias("t")).where("t <> '' AND NOT startswith(t, '#') AND contains(t, ':')")
    return t.select(F.trim(F.substring_index("t", ":", 1)).alias("key"), F.trim(F.expr("substring(t, instr(t, ':') + 1)")).alias("value"))


def list_files(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = False) -> DataFrame:
    """(path, name, size, modified) of matching files, without reading them."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive).load(path)
    return rows.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def exactly_one(files: DataFrame) -> str:
    """The only file of a listing; none or several are an error."""
    found = [r["path"] for r in files.select("path").limit(2).collect()]
    if len(found) != 1:
        raise FileNotFoundError(f"expected one file, found {'several' if found else 'none'}")
    return found[0]


def read_yolo_labels(spark: SparkSession, path: str) -> DataFrame:
    """(file, class_id, cx, cy, w, h) of space-separated label files, values 0..1."""
    t = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.split(F.trim("value"), r"\s+").alias("v")).where(F.size("v") == 5)
    return t.select("file", F.col("v")[0].try_cast("int").alias("class_id"), *[F.col("v")[i].try_cast("double").alias(n) for i, n in enumerate(("cx", "cy", "w", "h"), 1)])


def read_mask_pixels(spark: SparkSession, path: str, pattern: str = "*.png") -> DataFrame:
    """(file, row, col) of the set pixels of PNG masks, first channel above 0; unreadable files are left out.

    Images are looked at one at a time in their task; only set pixels become rows.
    """
    rows = spark.read.format("image").option("dropInvalid", True).option("pathGlobFilter", pattern).load(path).select("image.*")
    rows = rows.select(F.regexp_extract("origin", r"([^/]+)$", 1).alias("file"), "height", "width", "nChannels", "data")

    def f(it):
        for pdf in it:
            for name, h, w, ch, data in zip(*(pdf[c] for c in ("file", "height", "width", "nChannels", "data"))):
                first = np.frombuffer(data, np.uint8).reshape(h, w, ch)[:, :, 2 if ch >= 3 else 0]  # channels are stored blue first
                r, c = np.nonzero(first)
                yield pd.DataFrame({"file": name, "row": r.astype(np.int32), "col": c.astype(np.int32)})

    return rows.mapInPandas(f, "file string, row int, col int")


def mask_pixels_of_runs(rows: DataFrame) -> DataFrame:
    """(image, row, col) of run-length mask documents (image, json), binary or counts."""
    doc = F.from_json("json", "format string, width int, height int, rows array<struct<y:int,x_runs:array<array<int>>>>")
    r = rows.select("image", doc.alias("m")).select("image", F.explode("m.rows").alias("r")).select("image", F.col("r.y").alias("row"), F.explode("r.x_runs").alias("x"))
    return r.select("image", "row", F.explode(F.sequence(F.col("x")[0], F.col("x")[1])).alias("col"))
