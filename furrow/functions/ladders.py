"""Tiers, growth stages, diagnoses and caps as CASE ladders; small dimensions as literal maps."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from furrow.functions.indices import _c, blend, clip, rescale

# Tier -> (lower bound of the score, colour, code); lower bounds are inclusive.
TIERS = {
    "Healthy": (70.0, "#2E7D32", 0),
    "Moderate": (40.0, "#FBC02D", 1),
    "Stressed": (15.0, "#FF5722", 2),
    "Critical": (None, "#D32F2F", 3),
    "Out of Boundary": (None, "#1976D2", 4),
    "NOISE": (None, "#757575", 4),
}
# Canopy area in square metres from which each growth stage begins.
STAGES = (("Seedling", None), ("Vegetative", 0.0815), ("Flowering", 0.1177), ("Fruiting", 0.1449), ("Mature", 0.1811))
# Colour of each growth stage's marker and of the sectors, noise last.
SECTOR_COLOURS = ("#e41a1c", "#377eb8", "#4daf4a", "#984ea3", "#ff7f00", "#ffff33", "#a65628", "#f781bf")
NOISE_COLOUR = "#888"


def lookup(c: str | Column, pairs: dict, default=None) -> Column:
    """A small dimension as a literal map; unknown and null keys give the default."""
    m = F.create_map(*map(F.lit, chain.from_iterable(pairs.items())))
    return F.coalesce(F.when(_c(c).isNotNull(), F.element_at(m, _c(c))), F.lit(default))


def health_tier(score: str | Column, label: str | Column | None = None) -> Column:
    """Tier of a score; null is Out of Boundary; rows labelled NOISE are NOISE."""
    s = _c(score)
    out = F.when(s.isNull(), "Out of Boundary")
    for name, (low, *_) in TIERS.items():
        if low is not None:
            out = out.when(s >= low, name)
    out = out.otherwise("Critical")
    return out if label is None else F.when(_c(label).eqNullSafe(F.lit("NOISE")), "NOISE").otherwise(out)


def tier_colour(tier: str | Column) -> Column:
    return lookup(tier, {k: v[1] for k, v in TIERS.items()})


def tier_code(tier: str | Column) -> Column:
    return lookup(tier, {k: v[2] for k, v in TIERS.items()}, 4)


def growth_stage(area: str | Column) -> Column:
    """Stage of a canopy area; null area has none."""
    a, out = _c(area), None
    for name, low in reversed(STAGES):
        if low is not None:
            out = F.when(a >= low, name) if out is None else out.when(a >= low, name)
    return out.when(a.isNotNull(), STAGES[0][0])


def sector_colour(sector: str | Column) -> Column:
    """A palette colour by sector id modulo the palette's length; negative ids are noise, null has none."""
    s = _c(sector)
    # a null index would give the last entry of a literal array
    palette = F.element_at(F.array(*map(F.lit, SECTOR_COLOURS)), (F.pmod(s, F.lit(len(SECTOR_COLOURS))) + 1).cast("int"))
    return F.when(s < 0, NOISE_COLOUR).when(s.isNotNull(), palette)


def level(score: str | Column, low: float = 33.0, high: float = 66.0) -> Column:
    s = _c(score)
    return F.when(s < low, "low").when(s < high, "med").when(s.isNotNull(), "high")


def diagnosis(biomass: str | Column, nitrogen: str | Column) -> Column:
    b, n = level(biomass), level(nitrogen)
    both = _c(biomass).isNotNull() & _c(nitrogen).isNotNull()
    return F.when(
        both,
        F.when((b == "high") & (n == "high"), "Healthy & vigorous")
        .when((b == "low") & (n == "low"), "Critical (low biomass & N)")
        .when(n == "low", "Nitrogen deficient")
        .when(b == "low", "Sparse canopy / early growth")
        .otherwise("Moderate"),
    )


def limiting_factor(biomass: str | Column, nitrogen: str | Column, margin: float = 12.0) -> Column:
    b, n = _c(biomass), _c(nitrogen)
    return F.when(n < b - margin, "Nitrogen").when(b < n - margin, "Biomass").when(b.isNotNull() & n.isNotNull(), "Balanced")


def capped_both_low(score: Column, biomass: Column, nitrogen: Column, anomaly: Column) -> Column:
    """At most 12 where both scores are low and the row is an outlier."""
    return F.when((biomass < 33) & (nitrogen < 33) & F.coalesce(anomaly, F.lit(False)), F.least(score, F.lit(12.0))).otherwise(score)


def floors(stage: str | Column) -> tuple[Column, Column]:
    """(healthy, unhealthy) osavi floors: lower for seedlings."""
    seedling = _c(stage).eqNullSafe(F.lit("Seedling"))
    return F.when(seedling, 0.40).otherwise(0.50), F.when(seedling, 0.20).otherwise(0.25)


def vigour(osavi: Column, ndvi: Column, ndre: Column, stage: Column) -> Column:
    fh, fu = floors(stage)
    o = clip((osavi - fu) / (fh - fu), 0.0, 1.0) * 100.0
    return blend((0.6, o), (0.2, rescale(ndvi, 0.15, 0.60, 50.0)), (0.2, rescale(ndre, 0.10, 0.40, 50.0)))


def directional_caps(final: Column, osavi: Column, stage: Column, outlier: Column, stage_mean: Column) -> Column:
    """Caps in order: below the floor at most 14; a stressed outlier at most 14 or within 15..39; a vigorous one at least 70."""
    _, fu = floors(stage)
    mean = F.coalesce(stage_mean, F.lit(0.45))
    out = F.coalesce(outlier, F.lit(False))
    return (
        F.when(osavi.isNull(), F.lit(None).cast("double"))
        .when(osavi < fu, F.least(final, F.lit(14.0)))
        .when(out & (osavi < mean) & (osavi < fu + 0.05), F.least(final, F.lit(14.0)))
        .when(out & (osavi < mean), clip(final, 15.0, 39.0))
        .when(out, F.greatest(final, F.lit(70.0)))
        .otherwise(final)
    )
