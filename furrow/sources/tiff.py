"""A Python data source for GeoTIFF: tags, whole and windowed reads as pixel rows or tiles, and a plain writer.

Reads little- and big-endian baseline TIFF with strips or tiles, chunky or planar, of 8, 16, 32 or 64 bits,
uncompressed, LZW, Deflate or PackBits, with or without horizontal prediction. Anything else raises an error.
"""

from __future__ import annotations

import glob
import io
import json
import os
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from furrow.functions.geo import latlon_arrays

# Fixed values of the TIFF and GeoTIFF formats.
SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 16: 8}
CODES = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}
WIDTH, HEIGHT, BITS, COMPRESSION, OFFSETS, SAMPLES, ROWS, COUNTS, PLANAR, PREDICTOR, TILE_W, TILE_H, TILE_OFFSETS, TILE_COUNTS, FORMAT = 256, 257, 258, 259, 273, 277, 278, 279, 284, 317, 322, 323, 324, 325, 339
SCALE, TIEPOINT, TRANSFORM, GEO_KEYS, NODATA = 33550, 33922, 34264, 34735, 42113


@dataclass
class Header:
    path: str
    order: str
    tags: dict[int, tuple | str] = field(default_factory=dict)

    def one(self, tag: int, default=None):
        v = self.tags.get(tag)
        return default if v is None else v if isinstance(v, str) else v[0]

    @property
    def width(self) -> int:
        return int(self.one(WIDTH))

    @property
    def height(self) -> int:
        return int(self.one(HEIGHT))

    @property
    def bands(self) -> int:
        return int(self.one(SAMPLES, 1))

    @property
    def dtype(self) -> np.dtype:
        kind = {1: "u", 2: "i", 3: "f"}[int(self.one(FORMAT, 1))]
        return np.dtype(f"{self.order}{kind}{int(self.one(BITS, 8)) // 8}")

    @property
    def affine(self) -> tuple[float, float, float, float, float, float]:
        """Pixel corner (col, row) to ground; the identity where the file has no position."""
        if TRANSFORM in self.tags:
            t = self.tags[TRANSFORM]
            return (t[0], t[1], t[3], t[4], t[5], t[7])
        if SCALE in self.tags and TIEPOINT in self.tags:
            s, t = self.tags[SCALE], self.tags[TIEPOINT]
            return (s[0], 0.0, t[3] - t[0] * s[0], 0.0, -s[1], t[4] + t[1] * s[1])
        return (1.0, 0.0, 0.0, 0.0, 1.0, 0.0)

    @property
    def epsg(self) -> int | None:
        keys = self.tags.get(GEO_KEYS, ())
        found = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i + 1] == 0}
        return found.get(3072) or found.get(2048)


def read_header(path: str, data: bytes | None = None) -> Header:
    """The first directory's tags, of a file or of its bytes."""
    with io.BytesIO(data) if data is not None else open(path, "rb") as f:
        head = f.read(8)
        order = {b"II": "<", b"MM": ">"}.get(head[:2])
        if order is None or struct.unpack(order + "H", head[2:4])[0] != 42:
            raise ValueError(f"{path}: not a baseline TIFF")
        h = Header(path, order)
        f.seek(struct.unpack(order + "I", head[4:])[0])
        n = struct.unpack(order + "H", f.read(2))[0]
        entries = f.read(12 * n)
        for i in range(n):
            tag, kind, count = struct.unpack(order + "HHI", entries[12 * i : 12 * i + 8])
            if kind not in SIZES:
                continue
            size = SIZES[kind] * count
            data = entries[12 * i + 8 : 12 * i + 12]
            if size > 4:
                f.seek(struct.unpack(order + "I", data)[0])
                data = f.read(size)
            data = data[:size]
            if kind in (2, 7):
                h.tags[tag] = data.rstrip(b"\0").decode("latin-1")
            elif kind in (5, 10):
                v = struct.unpack(order + ("I" if kind == 5 else "i") * 2 * count, data)
                h.tags[tag] = tuple(a / b if b else 0.0 for a, b in zip(v[::2], v[1::2]))
            else:
                h.tags[tag] = struct.unpack(order + CODES[kind] * count, data)
    return h


def unpack_lzw(data: bytes) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits, most significant first, 256 clears, 257 ends."""
    out, table, width, at, bits, held, last = [], [], 9, 0, 0, 0, None
    single = [bytes([i]) for i in range(256)] + [b"", b""]
    for byte in data:
        held, bits = (held << 8) | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & ((1 << bits) - 1)
        if code == 257:
            break
        if code == 256:
            table, width, last = list(single), 9, None
            continue
        if last is None:
            entry = table[code]
        else:
            entry = table[code] if code < len(table) else last + last[:1]
            table.append(last + entry[:1])
            width = 12 if len(table) >= 2047 else 11 if len(table) >= 1023 else 10 if len(table) >= 511 else 9
        out.append(entry)
        last = entry
    del at
    return b"".join(out)


def unpack_bits(data: bytes) -> bytes:
    out, i = bytearray(), 0
    while i < len(data):
        n = data[i] - 256 if data[i] > 127 else data[i]
        if n >= 0:
            out += data[i + 1 : i + 2 + n]
            i += 2 + n
        else:
            if n != -128:
                out += data[i + 1 : i + 2] * (1 - n)
            i += 2
    return bytes(out)


def read_window(h: Header, row0: int, col0: int, height: int, width: int, data: bytes | None = None) -> np.ndarray:
    """(bands, height, width); what lies outside the raster is 0. Only the strips or tiles that the window meets are read."""
    planes = h.bands if int(h.one(PLANAR, 1)) == 2 else 1
    inner = 1 if planes > 1 else h.bands
    tiled = TILE_W in h.tags
    bw, bh = (int(h.one(TILE_W)), int(h.one(TILE_H))) if tiled else (h.width, min(int(h.one(ROWS, h.height)), h.height))
    offsets, counts = h.tags[TILE_OFFSETS if tiled else OFFSETS], h.tags[TILE_COUNTS if tiled else COUNTS]
    across, down = -(-h.width // bw), -(-h.height // bh)
    out = np.zeros((h.bands, height, width), h.dtype.newbyteorder("="))
    how, diff = int(h.one(COMPRESSION, 1)), int(h.one(PREDICTOR, 1))
    if diff not in (1, 2) or how not in (1, 5, 8, 32946, 32773):
        raise ValueError(f"{h.path}: compression {how} with predictor {diff} isn't supported")
    r1, c1 = min(row0 + height, h.height), min(col0 + width, h.width)
    if r1 <= max(row0, 0) or c1 <= max(col0, 0):
        return out
    with io.BytesIO(data) if data is not None else open(h.path, "rb") as f:
        for p in range(planes):
            for br in range(max(row0, 0) // bh, (r1 - 1) // bh + 1):
                for bc in range(max(col0, 0) // bw, (c1 - 1) // bw + 1):
                    i = p * across * down + br * across + bc
                    f.seek(offsets[i])
                    raw = f.read(counts[i])
                    raw = raw if how == 1 else unpack_lzw(raw) if how == 5 else unpack_bits(raw) if how == 32773 else zlib.decompress(raw)
                    rows = bh if tiled else min(bh, h.height - br * bh)
                    block = np.frombuffer(raw, h.dtype, rows * bw * inner).reshape(rows, bw, inner).astype(out.dtype)
                    if diff == 2:
                        block = np.cumsum(block, axis=1, dtype=out.dtype)
                    top, left = max(br * bh, row0, 0), max(bc * bw, col0, 0)
                    low, right = min(br * bh + rows, r1), min(bc * bw + bw, c1)
                    part = block[top - br * bh : low - br * bh, left - bc * bw : right - bc * bw]
                    where = slice(p, p + 1) if planes > 1 else slice(0, inner)
                    out[where, top - row0 : low - row0, left - col0 : right - col0] = np.moveaxis(part, 2, 0)
    return out


def three_bands(window: np.ndarray) -> np.ndarray:
    """The first three bands; with fewer than three the first one is repeated."""
    return window[:3] if len(window) >= 3 else np.repeat(window[:1], 3, 0)


def write_tiff(path: str, bands: np.ndarray, affine=None, epsg: int | None = None, nodata: str | None = None, rows_per_strip: int = 256) -> None:
    """(bands, height, width) as a Deflate-compressed little-endian TIFF in strips, with position, EPSG code and nodata."""
    n, height, width = bands.shape
    dt = bands.dtype.newbyteorder("<")
    strips = [zlib.compress(np.moveaxis(bands[:, r : r + rows_per_strip], 0, 2).astype(dt).tobytes()) for r in range(0, height, rows_per_strip)]
    kind = {"u": 1, "i": 2, "f": 3}[dt.kind]
    tags: list[tuple[int, str, list]] = [
        (WIDTH, "I", [width]), (HEIGHT, "I", [height]), (BITS, "H", [dt.itemsize * 8] * n), (COMPRESSION, "H", [8]), (262, "H", [2 if n == 3 and dt.itemsize == 1 else 1]),
        (OFFSETS, "I", [0] * len(strips)), (SAMPLES, "H", [n]), (ROWS, "I", [rows_per_strip]), (COUNTS, "I", [len(s) for s in strips]), (PLANAR, "H", [1]), (FORMAT, "H", [kind] * n),
    ]
    if affine:
        a, _, c, _, e, f = affine
        tags += [(SCALE, "d", [a, -e, 0.0]), (TIEPOINT, "d", [0.0, 0.0, 0.0, c, f, 0.0])]
    if epsg:
        tags.append((GEO_KEYS, "H", [1, 1, 0, 2, 1024, 0, 1, 1, 3072, 0, 1, epsg]))
    if nodata is not None:
        tags.append((NODATA, "s", [nodata.encode() + b"\0"]))
    codes = {"H": 3, "I": 4, "d": 12, "s": 2}
    at = 8 + 2 + 12 * len(tags) + 4
    fields, extra = [], b""
    bodies = {t: (v[0] if k == "s" else struct.pack("<" + k * len(v), *v)) for t, k, v in tags}
    first = at + sum(len(b) + len(b) % 2 for b in bodies.values() if len(b) > 4)
    places = np.cumsum([first] + [len(s) for s in strips])[:-1].tolist()
    bodies[OFFSETS] = struct.pack("<" + "I" * len(places), *places)
    for t, k, v in tags:
        b = bodies[t]
        count = len(b) if k == "s" else len(v)
        if len(b) > 4:
            fields.append(struct.pack("<HHII", t, codes[k], count, at + len(extra)))
            extra += b + b"\0" * (len(b) % 2)
        else:
            fields.append(struct.pack("<HHI", t, codes[k], count) + b.ljust(4, b"\0"))
    with path if hasattr(path, "write") else open(path, "wb") as out:
        out.write(b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", len(tags)) + b"".join(fields) + struct.pack("<I", 0) + extra + b"".join(strips))


@dataclass
class Window(InputPartition):
    path: str
    row0: int
    col0: int
    height: int
    width: int


class GeoTiffSource(DataSource):
    """format("geotiff"): (path, row, col, bands) rows, or with option mode=tiles (path, row0, col0, height, width, bands, data).

    Options: tile (edge of a partition's window, 1024), row0, col0, height, width (a window; the whole raster by default), and
    mode=info for one row a file: (path, width, height, bands, dtype, epsg, affine), or mode=metadata for its JSON document. rgb=true
    gives three bands whatever the file has. The path is a folder or pattern on a file system that the driver and all executors reach;
    decoded_tiles reads any file system that Spark does.
    """

    @classmethod
    def name(cls) -> str:
        return "geotiff"

    def schema(self) -> str:
        return {
            "pixels": "path string, row int, col int, bands array<double>",
            "tiles": "path string, row0 int, col0 int, height int, width int, bands int, dtype string, data binary",
            "metadata": "path string, json string",
            "info": "path string, width int, height int, bands int, dtype string, epsg int, affine array<double>",
        }[self.options.get("mode", "pixels")]

    def reader(self, schema) -> DataSourceReader:
        return GeoTiffReader(dict(self.options))


class GeoTiffReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = {k.lower(): v for k, v in options.items()}
        self.mode = self.options.get("mode", "pixels")

    def partitions(self) -> list[Window]:
        path = self.options["path"].removeprefix("file://")
        files = sorted(glob.glob(os.path.join(path, "*.tif*")) if os.path.isdir(path) else glob.glob(path))
        if self.mode in ("info", "metadata"):
            return [Window(p, 0, 0, 0, 0) for p in files]
        out, t = [], int(self.options.get("tile", 1024))
        for p in files:
            h = read_header(p)
            r0, c0 = int(self.options.get("row0", 0)), int(self.options.get("col0", 0))
            r1, c1 = r0 + int(self.options.get("height", h.height - r0)), c0 + int(self.options.get("width", h.width - c0))
            out += [Window(p, r, c, min(t, r1 - r), min(t, c1 - c)) for r in range(r0, r1, t) for c in range(c0, c1, t)]
        return out

    def read(self, w: Window):
        h = read_header(w.path)
        if self.mode == "info":
            yield (w.path, h.width, h.height, h.bands, h.dtype.name, h.epsg, [float(x) for x in h.affine])
            return
        if self.mode == "metadata":
            yield (w.path, json.dumps(metadata(h)))
            return
        a = read_window(h, w.row0, w.col0, w.height, w.width)
        if self.options.get("rgb", "false").lower() == "true":
            a = three_bands(a)
        if self.mode == "tiles":
            yield (w.path, w.row0, w.col0, w.height, w.width, len(a), a.dtype.name, a.tobytes())
            return
        for r in range(w.height):
            line = a[:, r].T.astype(float).tolist()
            for c, v in enumerate(line):
                yield (w.path, w.row0 + r, w.col0 + c, v)


def ground_sampling(path: str, fallback: tuple[float, float]) -> tuple[float, float]:
    """Metres a pixel along x and y from the file's scale, or the fallback where it has none or can't be read."""
    try:
        s = read_header(path).tags[SCALE]
        return float(s[0]), float(s[1])
    except (OSError, ValueError, KeyError, IndexError, struct.error):
        return fallback


def metadata(h: Header) -> dict:
    """Size, type, position and bounds of a raster, in its own coordinates and, for a UTM zone, in longitude and latitude."""
    a, b, c, d, e, f = (float(v) for v in h.affine)
    x, y = [c, c + a * h.width], [f, f + e * h.height]
    zone = h.epsg - 32600 if h.epsg and 32601 <= h.epsg <= 32660 else None
    lonlat = None
    if zone:
        # the bounds of the edges, 21 points to a side, as a straight side in metres is bent in degrees
        t = np.linspace(0, 1, 21)
        px = np.r_[x[0] + (x[1] - x[0]) * t, np.full(21, x[1]), x[0] + (x[1] - x[0]) * t, np.full(21, x[0])]
        py = np.r_[np.full(21, y[0]), y[0] + (y[1] - y[0]) * t, np.full(21, y[1]), y[0] + (y[1] - y[0]) * t]
        lat, lon = latlon_arrays(px, py, zone)
        lonlat = {"west": float(lon.min()), "south": float(lat.min()), "east": float(lon.max()), "north": float(lat.max())}
    return {
        "file": os.path.basename(h.path), "width": h.width, "height": h.height, "band_count": h.bands, "dtype": h.dtype.newbyteorder("=").name, "nodata": h.one(NODATA), "crs_epsg": h.epsg,
        "transform": [a, b, c, d, e, f], "pixel_size_x_m": abs(a), "pixel_size_y_m": abs(e), "gsd_cm": round(abs(a) * 100, 4),
        "bounds_utm": {"left": min(x), "bottom": min(y), "right": max(x), "top": max(y)}, "bounds_lonlat": lonlat,
        "extent_m": {"width": round(max(x) - min(x), 3), "height": round(max(y) - min(y), 3)}, "compression": int(h.one(COMPRESSION, 1)), "tags": {str(k): v for k, v in h.tags.items() if isinstance(v, str)},
    }


def decoded_tiles(files, tile: int = 1024):
    """(path, row0, col0, height, width, bands, dtype, data) of a binaryFile table (path, content): any file system that Spark reads. A file must fit a task."""
    import pandas as pd

    def f(it):
        for pdf in it:
            for path, content in zip(pdf["path"], pdf["content"]):
                h = read_header(path, content)
                for r in range(0, h.height, tile):
                    for c in range(0, h.width, tile):
                        n, m = min(tile, h.height - r), min(tile, h.width - c)
                        a = read_window(h, r, c, n, m, content)
                        yield pd.DataFrame({"path": [path], "row0": [r], "col0": [c], "height": [n], "width": [m], "bands": [h.bands], "dtype": [a.dtype.name], "data": [a.tobytes()]})

    return files.select("path", "content").mapInPandas(f, "path string, row0 int, col0 int, height int, width int, bands int, dtype string, data binary")


def tile_files(pixels, band: str, affine: tuple, epsg: int | None = None, tile: int = 1024, dtype: str = "float32", nodata: str = "0"):
    """(name, row0, col0, tif): a GeoTIFF with its own position for each tile that has pixels (row, col, band); pixels not given are 0."""
    import pandas as pd
    from pyspark.sql import functions as F

    def f(pdf):
        r0, c0 = int(pdf["_tr"].iloc[0]) * tile, int(pdf["_tc"].iloc[0]) * tile
        grid = np.zeros((1, tile, tile), dtype)
        grid[0, pdf["row"].to_numpy() - r0, pdf["col"].to_numpy() - c0] = pdf["v"].to_numpy()
        out = _Kept()
        a, b, c, d, e, g = affine
        write_tiff(out, grid, (a, b, c + a * c0 + b * r0, d, e, g + d * c0 + e * r0), epsg, nodata)
        return pd.DataFrame({"name": [f"tile_{r0}_{c0}.tif"], "row0": [r0], "col0": [c0], "tif": [out.kept]})

    p = pixels.where(F.col(band).isNotNull()).select(F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), F.col(band).cast("double").alias("v"))
    keyed = p.withColumns({"_tr": F.floor(F.col("row") / tile).cast("int"), "_tc": F.floor(F.col("col") / tile).cast("int")})
    return keyed.groupBy("_tr", "_tc").applyInPandas(f, "name string, row0 int, col0 int, tif binary")


class _Kept(io.BytesIO):
    """A file in memory whose bytes outlive its closing."""

    kept = b""

    def close(self) -> None:
        self.kept = self.getvalue()
        super().close()
