"""Vegetation indices, physical scaling and score arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furrow.functions.rounding import half_even

# The guards against a zero sum, the soil factor of OSAVI, metres a pixel.
EPS_RASTER = 1e-10
EPS_RGB = 1e-6
OSAVI_SOIL = 0.16
GSD = 0.013458
GSD_FALLBACK = (0.0134577, 0.0134582)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalised_difference(a: str | Column, b: str | Column, extra: float = 0.0, eps: float = EPS_RASTER) -> Column:
    """(a - b) / (a + b + extra + eps)."""
    a, b = _c(a), _c(b)
    return (a - b) / (a + b + F.lit(extra) + F.lit(eps))


def band_indices(red: str, green: str, nir: str, rededge: str, mask: str | None = None) -> dict[str, Column]:
    """NDVI, NDRE, OSAVI and GDVI of four bands in single precision; null where the mask is 0."""
    bands = {k: _c(v).cast("float").cast("double") for k, v in (("r", red), ("g", green), ("n", nir), ("e", rededge))}
    out = {
        "ndvi": normalised_difference(bands["n"], bands["r"]),
        "ndre": normalised_difference(bands["n"], bands["e"]),
        "osavi": normalised_difference(bands["n"], bands["r"], OSAVI_SOIL),
        "gdvi": normalised_difference(bands["n"], bands["g"]),
    }
    return {k: F.when(_c(mask) != 0, v) if mask else v for k, v in out.items()}


def luma(r: str, g: str, b: str) -> Column:
    return 0.299 * _c(r) + 0.587 * _c(g) + 0.114 * _c(b)


def brightness(*bands: str) -> Column:
    return sum((_c(b).cast("double") for b in bands[1:]), _c(bands[0]).cast("double")) / F.lit(float(len(bands)))


def ground_area(area_px: str | Column, gsd_x: float = GSD, gsd_y: float = GSD) -> Column:
    return _c(area_px) * F.lit(gsd_x) * F.lit(gsd_y)


def biomass_kg(area_m2: str | Column, ndvi: str | Column, label: str | Column) -> Column:
    """34 * area^1.2 * (ndvi + 0.1), a missing ndvi as 0.3, in three decimals; nothing for rows labelled NOISE."""
    kg = half_even(34.0 * F.pow(_c(area_m2), F.lit(1.2)) * (F.coalesce(_c(ndvi), F.lit(0.3)) + 0.1), 3)
    return F.when(_c(label).eqNullSafe(F.lit("NOISE")), 0.0).otherwise(kg)


def clip(c: str | Column, low, high) -> Column:
    """c within low..high; null stays null, where least and greatest would skip it."""
    c = _c(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def rescale(c: str | Column, low, high, missing: float | None = None) -> Column:
    """Linear 0..100 between low and high, clipped; null gives ``missing``."""
    out = clip((_c(c) - F.lit(low)) / (F.lit(high) - F.lit(low)), 0.0, 1.0) * 100.0
    return out if missing is None else F.coalesce(out, F.lit(missing))


def blend(*parts: tuple[float, Column]) -> Column:
    out = parts[0][0] * parts[0][1]
    for w, c in parts[1:]:
        out = out + w * c
    return out


def average_rank_score(df: DataFrame, value: str, out: str, partition: list[str] | None = None) -> DataFrame:
    """Percentile rank among the non-null values, ties averaged, times 100.

    Values fall into 1,024 buckets between the ends, whose counts are summed; a window ranks the rows inside a bucket,
    so all rows are never sorted in one task. ``df`` is read three times. Nulls get null.
    """
    keys = partition or []
    key = [F.col(k) for k in keys]
    v, low, high = F.col(value), F.col("_low"), F.col("_high")
    ends = df.agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    within = F.when(high > low, F.floor((v - low) / (high - low) * 1023)).otherwise(0)
    # rows without a value are dealt to buckets below all others, where they count for nothing
    bucket = F.when(v.isNull(), -1 - F.pmod(F.xxhash64(*df.columns), F.lit(1024))).otherwise(within)
    cut = lambda rows, by: rows.crossJoin(F.broadcast(ends)).withColumn("_b", by).drop("_low", "_high")  # noqa: E731  one row
    total = cut(df.select(*keys, value).where(v.isNotNull()), within).groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_b").alias("_kb")).agg(F.count(F.lit(1)).alias("_t"))
    before = Window.partitionBy(*[f"_k_{k}" for k in keys]).orderBy("_kb").rowsBetween(Window.unboundedPreceding, -1)
    total = total.withColumns({"_o": F.coalesce(F.sum("_t").over(before), F.lit(0)), "_n": F.sum("_t").over(Window.partitionBy(*[f"_k_{k}" for k in keys]))}).drop("_t")
    inner = Window.partitionBy(*key, "_b")
    ranks = cut(df, bucket).withColumns({"_l": F.rank().over(inner.orderBy(value)) - 1, "_c": F.count(F.lit(1)).over(Window.partitionBy(*key, "_b", value))})
    on = F.col("_b") == F.col("_kb")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    ranks = ranks.join(total if keys else F.broadcast(total), on, "left")  # a row a bucket
    rank = (F.col("_o") + F.col("_l") + (F.col("_c") + 1) / 2) / F.col("_n") * 100.0
    return ranks.select(*df.columns, F.when(v.isNotNull(), rank).alias(out))
