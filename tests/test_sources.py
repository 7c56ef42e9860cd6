import json

import numpy as np
import pytest

from furrow.functions.geo import latlon_arrays, to_utm
from furrow.sources import readers, tiff, writers


def test_csv_markers_of_missing_values(spark, tmp_path):
    (tmp_path / "p.csv").write_text("plant_id,sector_id,geo_x,sector_label,extra\na,3.0,1.5,S01,z\nb,NA,nan,N/A,z\nc,x,inf, S2 ,z\n")
    got = readers.read_plants_csv(spark, str(tmp_path / "p.csv")).collect()
    assert [(r.plant_id, r.sector_id, r.geo_x, r.sector_label, r.row_index, r.x) for r in got] == [("a", 3, 1.5, "S01", None, 1.5), ("b", None, None, None, None, None), ("c", None, None, " S2 ", None, None)]


def test_run_summaries_fall_back_in_order(spark, tmp_path):
    c = {"x": 1.0, "y": 2.0}
    for name, doc in {"a": {"centroids": [c, c]}, "b": {"tile_summary": [{"tile_id": 1, "detections": [c]}, {"tile_id": 2, "detections": 7}]}, "c": {"centroids": [], "per_tile_summary": [{"tile_id": 1, "detections": [c, c, c]}]}}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps({"source": name, **doc}))
    rows = readers.centroids_of_summary(readers.read_run_summary(spark, str(tmp_path)))
    assert {r["source"]: r["count"] for r in rows.groupBy("source").count().collect()} == {"a": 2, "b": 1, "c": 3}


def test_boundary_in_degrees_is_projected(spark, tmp_path):
    ring = [[122.1, 9.95], [122.11, 9.95], [122.11, 9.96], [122.1, 9.95]]
    (tmp_path / "b.geojson").write_text("﻿" + json.dumps({"features": [{"geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring[:2] + ring[:1]]]}}]}))
    rings = readers.read_rings_geojson(spark, str(tmp_path / "b.geojson"))
    best = readers.largest_ring(rings).select(readers.projected_ring(readers.F.col("ring"), 51).alias("r"), "ring").first()
    lat, lon = latlon_arrays(np.array([p[0] for p in best.r]), np.array([p[1] for p in best.r]), 51)
    np.testing.assert_allclose(np.stack([lon, lat], 1), ring, atol=1e-9)


def test_a_published_utm_position(spark):
    x, y = to_utm("lat", "lon", 17)  # the CN Tower, 17T 630084 4833438
    r = spark.createDataFrame([(43 + 38 / 60 + 33.24 / 3600, -(79 + 23 / 60 + 13.7 / 3600))], "lat double, lon double").select(x, y).first()
    assert abs(r[0] - 630084) < 1 and abs(r[1] - 4833438) < 1


@pytest.mark.parametrize("dtype", ["uint8", "float32", "int16"])
def test_tiff_windows_and_metadata(spark, tmp_path, dtype):
    a = (np.arange(2 * 30 * 40).reshape(2, 30, 40) % 251).astype(dtype)
    path = str(tmp_path / "a.tif")
    tiff.write_tiff(path, a, (0.5, 0.0, 400000.0, 0.0, -0.5, 1100000.0), 32651, "0", 7)
    h = tiff.read_header(path)
    np.testing.assert_array_equal(tiff.read_window(h, 0, 0, 30, 40), a)
    w = tiff.read_window(h, 25, 35, 10, 10)
    np.testing.assert_array_equal(w[:, :5, :5], a[:, 25:, 35:])
    assert not w[:, 5:].any() and not w[:, :, 5:].any()
    assert tiff.three_bands(a).shape == (3, 30, 40) and (tiff.three_bands(a)[2] == a[0]).all()
    m = tiff.metadata(h)
    assert (m["width"], m["height"], m["band_count"], m["crs_epsg"], m["gsd_cm"]) == (40, 30, 2, 32651, 50.0)
    assert m["bounds_utm"] == {"left": 400000.0, "bottom": 1099985.0, "right": 400020.0, "top": 1100000.0}
    lat, lon = latlon_arrays(np.array([400010.0]), np.array([1099990.0]), 51)
    assert m["bounds_lonlat"]["west"] < lon[0] < m["bounds_lonlat"]["east"] and m["bounds_lonlat"]["south"] < lat[0] < m["bounds_lonlat"]["north"]
    assert tiff.ground_sampling(path, (1.0, 1.0)) == (0.5, 0.5) and tiff.ground_sampling(str(tmp_path / "none.tif"), (1.0, 2.0)) == (1.0, 2.0)
    files = spark.read.format("binaryFile").load(path)
    tiles = tiff.decoded_tiles(files, 16).collect()
    assert len(tiles) == 6 and sum(t.height * t.width for t in tiles) == 30 * 40
    t = next(t for t in tiles if (t.row0, t.col0) == (16, 32))
    np.testing.assert_array_equal(np.frombuffer(t.data, t.dtype).reshape(2, 14, 8), a[:, 16:, 32:])


def test_tiff_source_modes(spark, tmp_path):
    tiff.write_tiff(str(tmp_path / "a.tif"), np.arange(12, dtype="uint8").reshape(1, 3, 4), rows_per_strip=2)
    spark.dataSource.register(tiff.GeoTiffSource)
    px = spark.read.format("geotiff").option("tile", 2).option("rgb", "true").load(str(tmp_path)).collect()
    assert {(r.row, r.col): r.bands for r in px} == {(r, c): [float(4 * r + c)] * 3 for r in range(3) for c in range(4)}
    assert json.loads(spark.read.format("geotiff").option("mode", "metadata").load(str(tmp_path)).first().json)["width"] == 4


def test_masks_written_and_read(spark, tmp_path):
    px = spark.createDataFrame([("a", 5, 7), ("a", 5, 9), ("a", 6, 7), ("b", 0, 0), ("b", None, 1)], "id string, row int, col int")
    images = writers.mask_images(px, "id")
    writers.write_mask_files(images, str(tmp_path / "m"))
    (tmp_path / "m" / "broken.png").write_bytes(b"no picture")
    got = sorted((r.file, r.row, r.col) for r in readers.read_mask_pixels(spark, str(tmp_path / "m")).collect())
    assert got == [("a_mask.png", 0, 0), ("a_mask.png", 0, 2), ("a_mask.png", 1, 0), ("b_mask.png", 0, 0)]
    entry = json.loads(writers.mask_index(images.where("id = 'a'")).first().json)
    assert entry == {"plant_id": "a", "mask_file": "a_mask.png", "bbox": {"x": 7, "y": 5, "width": 3, "height": 2}}


def test_copy_lines_escape(spark):
    df = spark.createDataFrame([("a\tb\\c\nd", None)], "t string, n int")
    assert writers.copy_lines(df).first().line == "a\\tb\\\\c\\nd\t\\N"
    assert "ST_MakePoint(geo_x, geo_y), 32651" in writers.geometry_update("plants")


def test_collections_and_reports(spark):
    df = spark.createDataFrame([("b", 1.0, 2.0), ("a", None, 0.12345678)], "id string, x double, y double")
    doc = json.loads(writers.feature_collection(writers.point_features(df.where("x IS NOT NULL"), "x", "y", ["id"]), "EPSG:32651"))
    assert doc["features"][0]["geometry"]["coordinates"] == [1.0, 2.0] and doc["crs"]["properties"]["name"] == "EPSG:32651"
    assert json.loads(writers.feature_collection(writers.point_features(df.limit(0), "x", "y", ["id"])))["features"] == []
    lines = [r.line for r in writers.markdown_rows(df, {"id": None, "y": 3}, ["id"]).orderBy("position").collect()]
    assert lines == ["| id | y |", "|---|---|", "| a | 0.123 |", "| b | 2.000 |"]
