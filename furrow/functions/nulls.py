"""Null rules: NaN counts as null, text markers of missing values are null, comparisons with null are false."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that stand for a missing value in CSV input.
MISSING_TEXT = ("", "NA", "N/A", "n/a", "NaN", "nan", "NULL", "null", "None", "none", "<NA>", "#N/A")


def clean(c: str | Column) -> Column:
    """A floating column with NaN as null; Spark's avg and max would keep NaN."""
    return F.nanvl(F.col(c) if isinstance(c, str) else c, F.lit(None).cast("double"))


def finite(c: str | Column) -> Column:
    """NaN and both infinities as null."""
    c = clean(c)
    return F.when(F.abs(c) < float("inf"), c)


def clean_floats(df: DataFrame) -> DataFrame:
    return df.withColumns({c: clean(c).cast(t) for c, t in df.dtypes if t in ("double", "float")})


def number(text: str | Column) -> Column:
    """Text to a number: markers of missing values, unparsable text, NaN and infinity are null."""
    t = F.trim(F.col(text) if isinstance(text, str) else text)
    return finite(F.when(~t.isin(*MISSING_TEXT), t).try_cast("double"))


def is_not(c: str | Column, value) -> Column:
    """c differs from value, where null differs from everything (pandas' rule)."""
    return ~(F.col(c) if isinstance(c, str) else c).eqNullSafe(F.lit(value))


def holds(condition: Column) -> Column:
    """A condition with null as false."""
    return F.coalesce(condition, F.lit(False))


def first_number(*columns: str) -> Column:
    """The first non-null column as a number; if it can't be read as one the result is null, later columns are not tried."""
    return finite(F.coalesce(*[F.col(c).cast("string") for c in columns]).try_cast("double"))


def or_default(c: str | Column, default) -> Column:
    """``default`` for null and for zero: a falsy number counts as missing."""
    return F.coalesce(F.nullif(F.col(c) if isinstance(c, str) else c, F.lit(0.0)), F.lit(default))
