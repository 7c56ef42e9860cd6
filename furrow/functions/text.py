"""Formatting, search keys and record reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.functions.indices import _c
from furrow.functions.rounding import RULES, half_even


def duration(seconds: str | Column) -> Column:
    """hh:mm:ss of a number of seconds, n/a for null."""
    s = F.floor(_c(seconds)).cast("long")
    parts = (F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60)))
    return F.when(s.isNull(), "n/a").otherwise(F.format_string("%02d:%02d:%02d", *parts))


def decimals(c: str | Column, digits: int = 4, rule: str = "nearest") -> Column:
    """A number in fixed decimals, n/a for null."""
    return F.when(_c(c).isNull(), "n/a").otherwise(F.format_string(f"%.{digits}f", RULES[rule](c, digits)))


def search_key(*parts: str | Column) -> Column:
    """Lower-case text to search in: the parts, nulls left out, joined by spaces."""
    return F.lower(F.concat_ws(" ", *[_c(p) for p in parts]))


def row_col_code(row: str, col: str) -> tuple[Column, Column]:
    return F.when(_c(row).isNotNull(), F.format_string("R%03d", _c(row))), F.when(_c(col).isNotNull(), F.format_string("C%03d", _c(col)))


def round_floats(df: DataFrame, digits: int = 6, rule: str = "nearest") -> DataFrame:
    """All floating columns rounded by one of functions.rounding's rules."""
    return df.withColumns({c: RULES[rule](c, digits) for c, t in df.dtypes if t in ("double", "float")})


def ordered_columns(df: DataFrame, preferred: Sequence[str]) -> DataFrame:
    """Preferred columns first, as far as they exist, the rest behind in their order."""
    first = [c for c in preferred if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


def with_null_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add the named columns that are missing, as nulls of the given type."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def scaled(c: str | Column, shown: float, source: float) -> Column:
    """A pixel position in a preview of another size, two decimals."""
    return half_even(_c(c) * F.lit(shown / source), 2)


def plain_numbers(text: str | Column) -> Column:
    """Numbers like 1.10005E6 in a text, at most seven digits before the point, written without an exponent."""
    def shifted(n: int) -> Column:
        # digits behind the point move before it; a short fraction is padded with zeros
        return rf"(?<=[\[,:])(-?\d)\.(\d{{{n}}})(\d*)E{n}(?=[,\]}}])"

    out = _c(text)
    for n in (7, 6, 5, 4, 3):
        out = F.regexp_replace(out, rf"(?<=[\[,:])(-?\d)\.(\d{{1,{n}}})E{n}(?=[,\]}}])", "$1.$2" + "0" * n + f"E{n}")
        out = F.regexp_replace(out, shifted(n), "$1$2.$3E")
        out = F.regexp_replace(out, r"\.(\d+?)0*E(?=[,\]}])", ".$1")
    return F.regexp_replace(out, r"\.E(?=[,\]}])", ".0")
