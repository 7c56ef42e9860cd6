"""Writers: CSV, GeoJSON, JSON summaries, masks as PNG, JDBC tables, reports."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furrow.functions.rounding import nearest
from furrow.functions.text import decimals


def write_csv(df: DataFrame, path: str) -> None:
    """Header, nulls as empty fields; spaces at the ends of texts are kept."""
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, nullValue="", emptyValue="", **keep).csv(path)


def point_features(df: DataFrame, x: str, y: str, properties: Sequence[str], digits: int = 6) -> DataFrame:
    """(json): a GeoJSON Point feature a row, coordinates in ``digits`` decimals."""
    geometry = F.struct(F.lit("Point").alias("type"), F.array(nearest(x, digits), nearest(y, digits)).alias("coordinates"))
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), geometry.alias("geometry")), {"ignoreNullFields": "false"}).alias("json"))


def write_geojson_lines(features: DataFrame, path: str) -> None:
    """One feature a line (GeoJSON sequence), in parallel: the form for large tables."""
    features.select("json").write.mode("overwrite").text(path)


def feature_collection(features: DataFrame, crs: str | None = None, most: int = 1_000_000) -> str:
    """One FeatureCollection document; an empty table gives an empty list. Above ``most`` features an error: write lines then."""
    rows = [r["json"] for r in features.limit(most + 1).collect()]
    if len(rows) > most:
        raise ValueError("too many features for one document; use write_geojson_lines")
    head = f'"crs":{{"type":"name","properties":{{"name":"{crs}"}}}},' if crs else ""
    return f'{{"type":"FeatureCollection",{head}"features":[{",".join(rows)}]}}'


def id_summary(plants: DataFrame, label: str = "sector_label") -> DataFrame:
    """(json): total, plants by sector and noise in one document."""
    n = plants.groupBy(F.coalesce(label, F.lit("NOISE")).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    by = F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("label") != "NOISE", F.struct("label", "n")))))  # a sector each
    one = n.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_plants"), by.alias("plants_by_sector"), F.coalesce(F.sum(F.when(F.col("label") == "NOISE", F.col("n"))), F.lit(0)).alias("noise_plants"))
    return one.select(F.to_json(F.struct("*")).alias("json"))


def png_bytes(mask: np.ndarray) -> bytes:
    """An 8-bit grey PNG."""
    h, w = mask.shape
    raw = b"".join(b"\0" + mask[r].astype(np.uint8).tobytes() for r in range(h))
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def mask_images(pixels: DataFrame, id_col: str, row: str = "row", col: str = "col") -> DataFrame:
    """(id, mask_file, bbox, png): each instance's mask cut to its box; one instance must fit a task."""
    import pandas as pd

    kind = pixels.schema[id_col].dataType.simpleString()

    def f(pdf: pd.DataFrame) -> pd.DataFrame:
        r, c = pdf["_r"].to_numpy(), pdf["_c"].to_numpy()
        m = np.zeros((r.max() - r.min() + 1, c.max() - c.min() + 1), np.uint8)
        m[r - r.min(), c - c.min()] = 255
        i = pdf["_id"].iloc[0]
        return pd.DataFrame({"id": [i], "mask_file": [f"{i}_mask.png"], "x": [int(c.min())], "y": [int(r.min())], "width": [m.shape[1]], "height": [m.shape[0]], "png": [png_bytes(m)]})

    p = pixels.select(F.col(id_col).alias("_id"), F.col(row).cast("long").alias("_r"), F.col(col).cast("long").alias("_c")).where("_id IS NOT NULL AND _r IS NOT NULL AND _c IS NOT NULL")
    out = p.groupBy("_id").applyInPandas(f, f"id {kind}, mask_file string, x long, y long, width long, height long, png binary")
    return out.select("id", "mask_file", F.struct("x", "y", "width", "height").alias("bbox"), "png")


def write_mask_files(images: DataFrame, folder: str) -> None:
    """One file an instance in a folder that every executor can reach; a rerun overwrites its own files."""

    def save(rows):
        import os

        os.makedirs(folder, exist_ok=True)
        for r in rows:
            with open(os.path.join(folder, os.path.basename(r["mask_file"])), "wb") as out:
                out.write(r["png"])

    images.select("mask_file", "png").foreachPartition(save)


def mask_index(images: DataFrame) -> DataFrame:
    """(json): an index entry a mask file: id, file and box."""
    return images.select(F.to_json(F.struct(F.col("id").alias("plant_id"), "mask_file", "bbox")).alias("json"))


def jdbc_ready(df: DataFrame, x: str = "geo_x", y: str = "geo_y", srid: int = 32651) -> DataFrame:
    """Nested columns as JSON and the position as extended well-known text, which a database turns into a geometry."""
    nested = {c: F.to_json(c) for c, t in df.dtypes if t.startswith(("struct", "array", "map"))}
    point = F.format_string(f"SRID={srid};POINT(%.6f %.6f)", F.col(x), F.col(y))
    return df.withColumns(nested).withColumn("geom", F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), point))


def copy_lines(df: DataFrame) -> DataFrame:
    """(line): rows as a database's COPY reads them: tabs between fields, \\N for null, backslash, tab and line breaks escaped."""
    def field(c: str) -> Column:
        t = F.col(c).cast("string")
        for a, b in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
            t = F.replace(t, F.lit(a), F.lit(b))
        return F.coalesce(t, F.lit("\\N"))

    return df.select(F.concat_ws("\t", *[field(c) for c in df.columns]).alias("line"))


def geometry_update(table: str, x: str = "geo_x", y: str = "geo_y", srid: int = 32651) -> str:
    """The statement that makes points of a loaded table's positions."""
    return f"UPDATE {table} SET geom = ST_SetSRID(ST_MakePoint({x}, {y}), {srid}) WHERE {x} IS NOT NULL AND {y} IS NOT NULL"


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], partitions: int = 8) -> None:
    """Drop and create the table; a failure raises."""
    df.coalesce(partitions).write.mode("overwrite").option("truncate", "false").jdbc(url, table, properties=properties)


def markdown_rows(df: DataFrame, columns: dict[str, int | None], order: Sequence[str | Column] = ()) -> DataFrame:
    """(position, line): header, rule and a line a row in the given order; numbers in the given decimals, nulls as n/a. For reports of few rows."""
    cells = [decimals(c, d) if d is not None else F.coalesce(F.col(c).cast("string"), F.lit("n/a")) for c, d in columns.items()]
    place = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*(order or columns))) + 1  # a report has few rows
    lines = df.select(place.cast("long").alias("position"), F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))
    head = df.sparkSession.createDataFrame([(0, "| " + " | ".join(columns) + " |"), (1, "|" + "---|" * len(columns))], "position long, line string")
    return head.unionByName(lines)
