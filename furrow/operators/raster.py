"""Raster operators on pixel rows (row, col): components, morphology, clipping, overlays, resampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furrow.operators.graph import contract
from furrow.operators.tiles import run_lengths

#: Width of the column blocks by which runs of neighbouring rows meet.
SPAN = 256


def decimated(pixels: DataFrame, bands: Sequence[str], factor: int, keys: Sequence[str] = ()) -> DataFrame:
    """Means of factor x factor squares: a reduced read."""
    at = [F.floor(F.col(c) / factor).cast("int").alias(c) for c in ("row", "col")]
    return pixels.groupBy(*keys, *at).agg(*[F.avg(b).alias(b) for b in bands])


def neighbourhood(points: DataFrame, radius: int, width: int | None = None, height: int | None = None) -> DataFrame:
    """Each point once for every pixel of its window of the given radius: columns row, col are the window's.

    With a width and height, windows are clamped to the raster and points outside are left out; without, no
    point is lost, and a join to the set pixels does the clamping.
    """
    if (width is None) != (height is None):
        raise ValueError("width and height go together")

    def span(c: str, n: int | None) -> Column:
        low, high = F.col(c) - radius, F.col(c) + radius
        return F.explode(F.sequence(low, high) if n is None else F.sequence(F.greatest(low, F.lit(0)), F.least(high, F.lit(n - 1))))

    out = points.where(F.col("row").isNotNull() & F.col("col").isNotNull())
    if width is not None:
        out = out.where(F.col("row").between(0, height - 1) & F.col("col").between(0, width - 1))
    return out.withColumn("_r", span("row", height)).withColumn("_c", span("col", width)).drop("row", "col").withColumnsRenamed({"_r": "row", "_c": "col"})


def _touching(a: DataFrame, b: DataFrame, reach: int) -> DataFrame:
    """(u, v): ids of runs of a and of b in the next row that overlap by columns, or at most ``reach`` beside each other."""
    blocks = lambda lo, hi: F.explode(F.sequence(F.floor(lo / SPAN), F.floor(hi / SPAN))).alias("_b")
    up = a.select(F.col("id").alias("u"), F.col("row").alias("r"), (F.col("first") - reach).alias("f1"), (F.col("last") + reach).alias("l1"))
    up = up.select("*", blocks(F.col("f1"), F.col("l1")))
    low = b.select(F.col("id").alias("v"), (F.col("row") - 1).alias("r"), F.col("first").alias("f2"), F.col("last").alias("l2"))
    low = low.select("*", blocks(F.col("f2"), F.col("l2")))
    return up.join(low, ["r", "_b"]).where("f1 <= l2 AND f2 <= l1").select("u", "v").distinct()


def labelled_runs(pixels: DataFrame, connectivity: int = 8) -> DataFrame:
    """(row, first, last, label): runs of set pixels with their component, named by its smallest (row, first).

    Runs are the vertices, far fewer than pixels; runs of adjacent rows meet by (row, block of columns).
    """
    if connectivity not in (4, 8):
        raise ValueError("connectivity is 4 or 8")
    runs = run_lengths(pixels, ["row"], "col").withColumn("id", F.struct(F.col("row").cast("long").alias("row"), F.col("first").cast("long").alias("first")))
    roots = contract(_touching(runs, runs, int(connectivity == 8)))
    return runs.join(roots, runs.id == roots.node, "left").select("row", "first", "last", F.coalesce("root", "id").alias("label"))


def component_stats(runs: DataFrame, least: int = 1) -> DataFrame:
    """One row a component of at least ``least`` pixels: instance_id (1-based by label), area, box, centroid. row_sum and col_sum are exact."""
    n = F.col("last") - F.col("first") + 1
    s = runs.groupBy("label").agg(
        F.sum(n).alias("area_px"), F.min("first").alias("bbox_x"), F.min("row").alias("bbox_y"), (F.max("last") - F.min("first") + 1).alias("bbox_width"), (F.max("row") - F.min("row") + 1).alias("bbox_height"),
        F.sum(n * F.col("row")).alias("row_sum"), F.sum(n * (F.col("first") + F.col("last"))).alias("col_sum2"),
    )
    s = s.where(F.col("area_px") >= least)
    return s.select("label", "area_px", "bbox_x", "bbox_y", "bbox_width", "bbox_height", (F.col("col_sum2") / 2 / F.col("area_px")).alias("centroid_x"), (F.col("row_sum") / F.col("area_px")).alias("centroid_y"))


def renumbered(components: DataFrame, chunk_rows: int = 1024) -> DataFrame:
    """Components with instance_id 1.. in the order of their label, after a filter; numbered in chunks of image rows and added up."""
    rows = components.withColumn("_k", F.floor(F.col("label.row") / chunk_rows))
    sizes = rows.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_k", F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(1)).orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"))
    inner = F.row_number().over(Window.partitionBy("_k").orderBy("label"))
    return rows.withColumn("_i", inner).join(before, "_k").withColumn("instance_id", F.col("_i") + F.col("_o")).drop("_k", "_i", "_o")


def dilated(pixels: DataFrame, times: int = 1, keys: Sequence[str] = ()) -> DataFrame:
    """Set pixels and their four neighbours."""
    shifts = F.explode(F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in ((0, 0), (1, 0), (-1, 0), (0, 1), (0, -1))]))
    for _ in range(times):
        s = pixels.select(*keys, "row", "col", shifts.alias("s"))
        pixels = s.select(*keys, (F.col("row") + F.col("s.r")).alias("row"), (F.col("col") + F.col("s.c")).alias("col")).distinct()
    return pixels


def eroded(pixels: DataFrame, times: int = 1, keys: Sequence[str] = ()) -> DataFrame:
    """Set pixels whose four neighbours are all set; what lies outside the raster is not set."""
    shifts = F.explode(F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in ((0, 0), (1, 0), (-1, 0), (0, 1), (0, -1))]))
    pixels = pixels.select(*keys, "row", "col").distinct()
    for _ in range(times):
        s = pixels.select(*keys, "row", "col", shifts.alias("s"))
        s = s.select(*keys, (F.col("row") + F.col("s.r")).alias("row"), (F.col("col") + F.col("s.c")).alias("col"))
        pixels = s.groupBy(*keys, "row", "col").agg(F.count(F.lit(1)).alias("_n")).where("_n = 5").drop("_n")
    return pixels


def closed(pixels: DataFrame, times: int = 2, keys: Sequence[str] = ()) -> DataFrame:
    """Dilated, then eroded as often: small gaps close."""
    return eroded(dilated(pixels, times, keys), times, keys)


def filled_holes(pixels: DataFrame) -> DataFrame:
    """(row, first, last): runs that fill every gap enclosed by set pixels, a gap's pixels meeting by their sides.

    Gaps between the runs of a row are the vertices. A gap reaches the outside where the row above or below is
    empty or ends before it; a hole is a component of gaps none of which does.
    """
    runs = run_lengths(pixels, ["row"], "col")
    w = Window.partitionBy("row").orderBy("first")
    gaps = runs.withColumn("_next", F.lead("first").over(w)).where("_next IS NOT NULL").select("row", (F.col("last") + 1).alias("first"), (F.col("_next") - 1).alias("last"))
    gaps = gaps.withColumn("id", F.struct(F.col("row").cast("long").alias("row"), F.col("first").cast("long").alias("first")))
    rows = runs.groupBy("row").agg(F.min("first").alias("low"), F.max("last").alias("high"))
    beside = [rows.select((F.col("row") + s).alias("row"), F.col("low").alias(f"low{i}"), F.col("high").alias(f"high{i}")) for i, s in enumerate((1, -1))]
    g = gaps.join(beside[0], "row", "left").join(beside[1], "row", "left")
    out = [F.col(f"low{i}").isNull() | (F.col("first") < F.col(f"low{i}")) | (F.col("last") > F.col(f"high{i}")) for i in (0, 1)]
    g = g.withColumn("open", out[0] | out[1]).select("row", "first", "last", "id", "open")
    roots = contract(_touching(gaps, gaps, 0))
    g = g.join(roots, g.id == roots.node, "left").withColumn("label", F.coalesce("root", "id")).drop("root", "node")
    leak = g.where("open").select("label").distinct()
    return g.join(leak, "label", "left_anti").select("row", "first", "last")


def largest(components: DataFrame) -> DataFrame:
    """The component of the greatest area; the first of equals."""
    return components.agg(F.max_by(F.struct(*components.columns), F.struct("area_px", (-F.col("label.row")).alias("r"), (-F.col("label.first")).alias("c"))).alias("m")).select("m.*")


def overlay(r: str, g: str, b: str, masked: Column, alpha: float, tint: tuple[int, int, int] = (0, 255, 0)) -> list[Column]:
    """The bands with a tint mixed in where the mask is set, truncated to integers."""
    return [F.when(masked, F.floor(F.col(c) * (1 - alpha) + t * alpha)).otherwise(F.col(c)).cast("int").alias(c) for c, t in zip((r, g, b), tint)]


def resized_nearest(pixels: DataFrame, from_size: tuple[int, int], to_size: tuple[int, int]) -> DataFrame:
    """Nearest-neighbour resize of set pixels (row, col) from (height, width) to another size."""
    def target(c: str, a: int, b: int) -> Column:
        # target pixels t with floor(t * a / b) = source pixel
        low = F.ceil(F.col(c) * F.lit(b) / F.lit(a))
        high = F.ceil((F.col(c) + 1) * F.lit(b) / F.lit(a)) - 1
        return F.explode(F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>")))

    out = pixels.select(target("row", from_size[0], to_size[0]).alias("_r"), "col").select(F.col("_r").cast("int").alias("row"), target("col", from_size[1], to_size[1]).alias("_c"))
    return out.select("row", F.col("_c").cast("int").alias("col"))


def background(r: str, g: str, b: str, colour: tuple[int, int, int] = (255, 255, 255)) -> Column:
    """Pixels of the background's colour; a null band is not background."""
    return F.coalesce((F.col(r) == colour[0]) & (F.col(g) == colour[1]) & (F.col(b) == colour[2]), F.lit(False))


def sunlit_or_centre(windows: DataFrame, keys: Sequence[str], brightness: str, threshold: str, centre: Column, floor: float = 50.0) -> DataFrame:
    """The rows of each window that are brighter than its threshold and than the floor; of a window all in shadow, the centre."""
    from furrow.operators.aggregates import sunlit

    lit = windows.withColumn("_lit", F.coalesce(sunlit(F.col(brightness), F.col(threshold), floor), F.lit(False)))
    some = lit.groupBy(*keys).agg(F.max("_lit").alias("_some"))
    return lit.join(some, list(keys)).where(F.col("_lit") | (~F.col("_some") & centre)).drop("_lit", "_some")


def exclusion(r: str, g: str, b: str, nir: str | None = None, ndvi_below: float = 0.10, bright: float = 220.0) -> Column:
    """Pixels to leave out: bright ones, and those with little vegetation where a near-infrared band exists."""
    from furrow.functions.indices import EPS_RGB, brightness, normalised_difference

    out = brightness(r, g, b) > bright
    return out | (normalised_difference(nir, r, eps=EPS_RGB) <= ndvi_below) if nir else out
