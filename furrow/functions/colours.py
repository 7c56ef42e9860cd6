"""Colour palettes read backwards, labels of the nearest midpoint, colour ramps and stretches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furrow.functions.indices import _c, clip
from furrow.functions.rounding import half_away

# Palettes from the lowest bin to the highest, with the bins' edges and labels. They must be as they are, as the
# colours stand in published maps and the labels in results.
NDVI_COLOURS = ("#a50026", "#d73027", "#f46d43", "#fdae61", "#fee08b", "#ffffbf", "#d9ef8b", "#a6d96a", "#66bd63", "#1a9850", "#006837")
NDVI_EDGES = (-0.2, 0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
NDVI_LABELS = (
    "Bare soil (-0.2-0.0)", "Very sparse (0.0-0.1)", "Sparse (0.1-0.2)", "Low (0.2-0.3)", "Low-moderate (0.3-0.4)", "Moderate (0.4-0.5)",
    "Moderate-good (0.5-0.6)", "Good (0.6-0.7)", "Healthy (0.7-0.8)", "Very healthy (0.8-0.9)", "Dense vegetation (0.9-1.0)",
)
NDRE_COLOURS = ("#a50026", "#d73027", "#f46d43", "#fdae61", "#fee08b", "#ffffbf", "#d9ef8b", "#a6d96a", "#1a9850", "#006837")
NDRE_EDGES = (-1.0, -0.8, -0.6, -0.4, -0.2, 0.0, 0.2, 0.4, 0.6, 0.8, 1.0)
NDRE_LABELS = (
    "Very low (-1.0--0.8)", "Low (-0.8--0.6)", "Low-moderate (-0.6--0.4)", "Moderate (-0.4--0.2)", "Moderate-good (-0.2-0.0)",
    "Good (0.0-0.2)", "Healthy (0.2-0.4)", "Very healthy (0.4-0.6)", "Vigorous (0.6-0.8)", "Dense vigorous (0.8-1.0)",
)


class Palette:
    """Colours of value bins; a bin's value is its midpoint."""

    def __init__(self, colours: tuple[str, ...], edges: tuple[float, ...], names: tuple[str, ...]):
        if not len(colours) == len(edges) - 1 == len(names):
            raise ValueError("a palette needs one colour and one name a bin")
        self.rgb = [tuple(int(c[i : i + 2], 16) for i in (1, 3, 5)) for c in colours]
        self.mid = [round((a + b) / 2, 10) for a, b in zip(edges, edges[1:])]
        self.names = list(names)

    def entries(self) -> Column:
        return F.array(*[F.struct(*[F.lit(float(v)).alias(k) for k, v in zip("rgb", rgb)], F.lit(i).alias("i"), F.lit(m).alias("mid"), F.lit(n).alias("name")) for i, (rgb, m, n) in enumerate(zip(self.rgb, self.mid, self.names))])

    def nearest(self, r: str, g: str, b: str) -> Column:
        """struct(d, i, mid, name) of the palette colour nearest in RGB; ties go to the lower bin."""
        r, g, b = (_c(x).cast("double") for x in (r, g, b))
        each = F.transform(self.entries(), lambda e: F.struct(F.sqrt((r - e["r"]) * (r - e["r"]) + (g - e["g"]) * (g - e["g"]) + (b - e["b"]) * (b - e["b"])).alias("d"), e["i"].alias("i"), e["mid"].alias("mid"), e["name"].alias("name")))
        return F.when(r.isNotNull() & g.isNotNull() & b.isNotNull(), F.array_min(each))

    def label(self, value: str | Column) -> Column:
        """The name of the bin whose midpoint is nearest; ties go to the lower bin; null stays null."""
        v = _c(value)
        return F.when(v.isNotNull(), F.array_min(F.transform(self.entries(), lambda e: F.struct(F.abs(e["mid"] - v).alias("d"), e["i"].alias("i"), e["name"].alias("name"))))["name"])


NDVI = Palette(NDVI_COLOURS, NDVI_EDGES, NDVI_LABELS)
OSAVI = NDVI
NDRE = Palette(NDRE_COLOURS, NDRE_EDGES, NDRE_LABELS)


def hex_channel(colour: str | Column, channel: int) -> Column:
    """Channel 0, 1 or 2 of a colour such as #2E7D32, with or without the sign."""
    return F.conv(F.substr(F.ltrim(_c(colour), F.lit("#")), F.lit(2 * channel + 1), F.lit(2)), 16, 10).cast("int")


def ramp(value: str | Column, stops: list[tuple[float, tuple[int, int, int]]]) -> Column:
    """Linear interpolation between colour stops, channels truncated; outside the stops the end colours hold."""
    v = _c(value)

    def rgb(parts) -> Column:
        return F.struct(*[p.cast("int").alias(k) for k, p in zip("rgb", parts)])

    out = F.when(v.isNull(), F.lit(None)).when(v <= stops[0][0], rgb([F.lit(x) for x in stops[0][1]]))
    for (a, ca), (b, cb) in zip(stops, stops[1:]):
        t = (v - a) / (b - a)
        out = out.when(v <= b, rgb([F.floor(x + t * (y - x)) for x, y in zip(ca, cb)]))
    return out.otherwise(rgb([F.lit(x) for x in stops[-1][1]]))


def percentile_stretch(df: DataFrame, value: str, out: str, low: float = 0.02, high: float = 0.98, digits: int = 6) -> DataFrame:
    """0..1 between two percentiles, clipped; nulls count as 0 before the percentiles are taken.

    The percentiles interpolate linearly, over a histogram of the values rounded to ``digits``.
    """
    filled = df.withColumn("_z", F.coalesce(F.col(value), F.lit(0.0)))
    hist = filled.groupBy(half_away("_z", digits).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    ends = hist.agg(F.percentile("_v", [low, high], F.col("_c")).alias("_p"))  # one row
    z = filled.crossJoin(F.broadcast(ends))
    lo, hi = F.col("_p")[0], F.col("_p")[1]
    return z.withColumn(out, F.when(hi > lo, clip((F.col("_z") - lo) / (hi - lo), 0.0, 1.0)).otherwise(0.0)).drop("_z", "_p")


def to_byte(df: DataFrame, value: str, out: str, tile: list[str], integer: bool) -> DataFrame:
    """0..255 inside each tile: integers by value / max, floats between min and max; a constant tile is 0."""
    w = Window.partitionBy(*tile)
    low = F.lit(0.0) if integer else F.min(value).over(w)
    high = F.max(value).over(w)
    return df.withColumn(out, F.when(high > low, F.floor((F.col(value) - low) / (high - low) * 255.0)).otherwise(F.when(F.col(value).isNotNull(), 0)).cast("int"))
