"""Rollups, counts, thresholds and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furrow.functions.indices import biomass_kg, ground_area
from furrow.functions.rounding import half_away, nearest


def biomass_rollup(plants: DataFrame, area: str, ndvi: str, sector: str = "sector_id", label: str = "sector_label") -> DataFrame:
    """Plants and biomass of each sector; rows labelled NOISE (a missing label is not) and null keys are left out. Sums are exact decimals."""
    rows = plants.where(~F.col(label).eqNullSafe(F.lit("NOISE")) & F.col(sector).isNotNull() & F.col(label).isNotNull())
    kg = biomass_kg(area, ndvi, label).cast("decimal(18,3)")
    tonnes = F.round(F.sum(kg) * F.lit("0.001").cast("decimal(4,3)"), 3).cast("double")
    return rows.groupBy(sector, label).agg(F.count(F.lit(1)).alias("total_active_plants"), tonnes.alias("predicted_biomass_tonnes"))


def label_counts(df: DataFrame, label: str) -> DataFrame:
    """(label, n) of the non-null labels."""
    return df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def conditional_counts(df: DataFrame, **conditions: Column) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in conditions.items()])


def canopy_aggregate(pixels: DataFrame, plant: str, value: str, distance: str, keep: Column, inside: Column, n: Column | None = None) -> DataFrame:
    """(plant, value, category value, soil fraction, match distance, pixels) of each plant.

    ``keep`` marks pixels that are not soil; pixels outside the soil raster are kept. The index is the mean of
    the kept pixels inside the index raster; a plant of which nothing is kept has no index. A row stands for
    ``n`` pixels of one value, or for one.
    """
    used, n = keep & inside, F.lit(1) if n is None else n

    def mean(c: Column, of: Column) -> Column:
        return F.try_divide(F.sum(F.when(of, c * n)), F.sum(F.when(of & c.isNotNull(), n)))

    return pixels.groupBy(plant).agg(
        nearest(mean(F.col(value), used), 3).alias("value"),
        mean(F.col(value), used).alias("raw_value"),
        nearest(1 - mean(keep.cast("double"), F.lit(True)), 3).alias("soil_fraction"),
        nearest(mean(F.col(distance), used), 2).alias("match_distance"),
        F.sum(F.when(used, n).otherwise(0)).cast("long").alias("canopy_px"),
    )


def otsu_threshold(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """(keys, threshold): the 256-bin threshold with the greatest variance between classes; the first of equals.

    Bins are the integers of 0..255 with centres at .5; only the histogram is sorted, never the rows.
    """
    bins = df.where((F.col(value) >= 0) & (F.col(value) < 256)).groupBy(*keys, F.floor(value).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    # the classes change at occupied bins only, so the first of equals is one of them, or bin 0
    every = bins.unionByName(bins.select(*keys).distinct().select(*keys, F.lit(0).alias("bin"), F.lit(0).cast("bigint").alias("n")))
    h = every.groupBy(*keys, "bin").agg(F.sum("n").cast("double").alias("n")).withColumn("c", F.col("bin") + 0.5)
    up = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*keys).orderBy("bin").rowsBetween(1, Window.unboundedFollowing)
    never_zero = lambda c: F.when(c == 0, 1e-5).otherwise(c)
    h = h.select(*keys, "bin", "c", *[F.sum(e).over(w).alias(n) for n, e, w in (("w1", F.col("n"), up), ("s1", F.col("n") * F.col("c"), up), ("w2", F.col("n"), down), ("s2", F.col("n") * F.col("c"), down))])
    m = F.col("s1") / never_zero(F.col("w1")) - F.col("s2") / never_zero(F.col("w2"))
    h = h.where("bin < 255").withColumn("var", half_away(never_zero(F.col("w1")) * never_zero(F.col("w2")) * m * m, 3))
    return h.groupBy(*keys).agg(F.max(F.struct("var", (-F.col("bin")).alias("b"), "c")).alias("m")).select(*keys, F.col("m.c").alias("threshold"))


def sunlit(brightness: Column, threshold: Column, floor: float = 50.0) -> Column:
    """Brighter than the threshold and than the floor."""
    return brightness > F.greatest(F.coalesce(threshold, F.lit(floor)), F.lit(floor))


def correlations(df: DataFrame, pairs: dict[str, tuple[str, str]], digits: int = 6) -> DataFrame:
    """Pearson correlations over the rows where both values exist."""
    both = lambda a, b: F.corr(F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b)))
    return df.agg(*[half_away(both(a, b), digits).alias(k) for k, (a, b) in pairs.items()])


def best_row(df: DataFrame, by: Column, sequence: Column, keys: list[str], highest: bool = True) -> DataFrame:
    """The row with the highest (or lowest) value in each group; the first in sequence among equals; null values never win."""
    order = F.struct((by if highest else -by).alias("v"), (-sequence).alias("s"))
    rest = [c for c in df.columns if c not in keys]
    best = df.where(by.isNotNull()).groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r"))
    return best.select(*keys, "_r.*")


def ground_truth_fit(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """R squared of a prediction: 1 - squared error / squared deviation from the mean."""
    err = F.sum((F.col(truth) - F.col(predicted)) ** 2)
    return df.where(F.col(truth).isNotNull() & F.col(predicted).isNotNull()).agg((1 - err / (F.var_pop(truth) * F.count(truth))).alias("r2"), F.count(truth).alias("n"))


def sector_frames(points: DataFrame, sector: str, x: str, y: str) -> DataFrame:
    """Centre, principal axes, extents and quantiles of each sector of at least three points.

    Two passes of aggregates: means and covariances give the axes in closed form, the projections' minimum,
    maximum and quantiles follow. The axis' larger component is positive, so the frame does not
    depend on how it was computed. Quantiles are exact over projections rounded to millimetres.
    """
    rows = points.where(F.col(sector).isNotNull() & (F.col(sector) >= 0) & (F.abs(x) < float("inf")) & (F.abs(y) < float("inf")))
    m = rows.groupBy(sector).agg(F.count(F.lit(1)).alias("n"), F.avg(x).alias("cx"), F.avg(y).alias("cy"), F.covar_pop(x, x).alias("sxx"), F.covar_pop(x, y).alias("sxy"), F.covar_pop(y, y).alias("syy")).where("n >= 3")
    half = (F.col("sxx") - F.col("syy")) / 2
    root = F.sqrt(half * half + F.col("sxy") * F.col("sxy"))
    # eigenvector of the larger eigenvalue, from the better conditioned of two forms
    vx = F.when(half >= 0, half + root).otherwise(F.col("sxy"))
    vy = F.when(half >= 0, F.col("sxy")).otherwise(root - half)
    m = m.withColumns({"_vx": vx, "_vy": vy}).withColumn("_len", F.sqrt(F.col("_vx") ** 2 + F.col("_vy") ** 2))
    m = m.withColumns({"ax": F.when(F.col("_len") > 0, F.col("_vx") / F.col("_len")).otherwise(1.0), "ay": F.when(F.col("_len") > 0, F.col("_vy") / F.col("_len")).otherwise(0.0)})
    flip = F.when(F.when(F.abs("ax") >= F.abs("ay"), F.col("ax")).otherwise(F.col("ay")) < 0, -1.0).otherwise(1.0)
    m = m.withColumn("_f", flip).withColumns({"ax": F.col("ax") * F.col("_f"), "ay": F.col("ay") * F.col("_f")}).select(sector, "n", "cx", "cy", "ax", "ay")
    p = project(rows.join(m, sector), x, y)
    h = p.groupBy(sector, half_away("minor", 3).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    q = h.groupBy(sector).agg(F.percentile("v", [0.05, 0.95], F.col("c")).alias("q"))
    ends = p.groupBy(sector).agg(F.min("major").alias("major_min"), F.max("major").alias("major_max"))
    return m.join(ends, sector).join(q, sector).select(*m.columns, "major_min", "major_max", F.col("q")[0].alias("minor_q05"), F.col("q")[1].alias("minor_q95"))


def project(df: DataFrame, x: str, y: str) -> DataFrame:
    """Coordinates along (major) and across (minor) the frame cx, cy, ax, ay of the row."""
    dx, dy = F.col(x) - F.col("cx"), F.col(y) - F.col("cy")
    return df.withColumns({"major": dx * F.col("ax") + dy * F.col("ay"), "minor": dy * F.col("ax") - dx * F.col("ay")})
