"""Row-wise transforms: missing-value fill, categorisation, unit conversion,
canonical projection, merge and de-duplication.

All are single projections (or one ``distinct``) over built-in expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from obsgate.functions.rounding import scale_by_key, scale_round
from obsgate.sources.registry import (
    DEFAULT_CATEGORY,
    MANUAL_BAND,
    PRESSURE_CANONICAL,
    PUBLISHER_BANDS,
    REVERSE_CONVERSIONS,
    SWEDISH_INCH_TO_MMHG,
    pressure_conversions,
)

NAN = float("nan")
_FRACTIONAL = (T.DoubleType, T.FloatType)
_INTEGRAL = (T.IntegerType, T.LongType, T.ShortType, T.ByteType)


def fill_nan(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULL -> NaN in the given (default: all) floating-point columns.

    Columns of other types among ``cols`` are left alone (NaN has no integer
    or string form).
    """
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    if cols is None:
        cols = list(types)
    cols = [c for c in cols if isinstance(types[c], _FRACTIONAL)]
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(NAN).cast(types[c])) for c in cols})


def fill_missing(df: DataFrame, *, legacy_int_fill: bool = True) -> DataFrame:
    """Fill every numeric column: floating NULL -> NaN; integral NULL -> 0.

    Filling integers with 0 mirrors ``na.fill(NaN)`` on integer columns in the
    original (NaN cast to int is 0); pass ``legacy_int_fill=False`` to leave
    integer NULLs alone. Spark's own ``na.fill(nan)`` raises on integer
    columns under ANSI mode, so the fill is written out per column.
    """
    fills: dict[str, Column] = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, _FRACTIONAL):
            fills[f.name] = F.coalesce(F.col(f.name), F.lit(NAN).cast(f.dataType))
        elif legacy_int_fill and isinstance(f.dataType, _INTEGRAL):
            fills[f.name] = F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType))
    return df.withColumns(fills)


def publisher_category(year: Column, manual: Column) -> Column:
    expr = None
    for lo, hi, label in PUBLISHER_BANDS:
        cond = year.between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    lo, hi, label = MANUAL_BAND
    return expr.when(year.between(lo, hi) & (manual == F.lit(True)), F.lit(label)).otherwise(
        F.lit(DEFAULT_CATEGORY)
    )


def categorize_publisher(df: DataFrame, year_col: str = "YEAR", manual_col: str = "ISMANUAL",
                         out: str = "PUBLISHED_CATEGORY") -> DataFrame:
    """Add the publisher category by year band and station kind; drops the manual flag."""
    return df.withColumn(out, publisher_category(F.col(year_col), F.col(manual_col))).drop(manual_col)


def tag_range(df: DataFrame, label: str | Column, out: str = "SPLIT_RANGE") -> DataFrame:
    """Tag rows with their year-range label (a literal or a column)."""
    return df.withColumn(out, label if isinstance(label, Column) else F.lit(label))


def to_hpa(df: DataFrame, range_col: str = "SPLIT_RANGE", *,
           swedish_inch_mm: float = SWEDISH_INCH_TO_MMHG,
           select_canonical: bool = True) -> DataFrame:
    """Convert readings to hPa by the row's range (one CASE per output column).

    Ranges with a factor take their readings from the range's source columns,
    multiply and round half-up to one decimal; every other range keeps
    OBSERVATION1..3 as they are (already hPa, not rounded).
    """
    convs = pressure_conversions(swedish_inch_mm)
    key = F.col(range_col)
    present = set(df.columns)
    out = {}
    for i in range(3):
        target = f"OBSERVATION{i + 1}"
        default = F.col(target) if target in present else F.lit(None).cast(T.DoubleType())
        sources = {r: F.col(c.source[i]) for r, c in convs.items() if c.source[i] in present}
        factors = {r: (convs[r].factor, 1) for r in sources}
        out[target] = scale_by_key(key, sources, factors, default)
    res = df.withColumns(out)
    return res.select(*PRESSURE_CANONICAL) if select_canonical else res


def convert_range(df: DataFrame, range_label: str, *,
                  swedish_inch_mm: float = SWEDISH_INCH_TO_MMHG) -> DataFrame:
    """Single-range form: tag with ``range_label`` and convert to the canonical columns."""
    return to_hpa(tag_range(df, range_label), swedish_inch_mm=swedish_inch_mm)


def convert_back(df: DataFrame, range_col: str = "SPLIT_RANGE",
                 cols: Sequence[str] = ("OBSERVATION1", "OBSERVATION2", "OBSERVATION3")) -> DataFrame:
    """Reverse conversion hPa -> original unit (used by the round-trip check).

    Rounded half-up to two decimals for the Swedish-inch range and one
    decimal otherwise; ranges without a factor pass through.
    """
    key = F.col(range_col)
    out = {}
    for c in cols:
        src = {r: F.col(c) for r in REVERSE_CONVERSIONS}
        out[c] = scale_by_key(key, src, dict(REVERSE_CONVERSIONS), F.col(c).cast(T.DoubleType()))
    return df.withColumns(out)


def canonical(df: DataFrame, cols: Sequence[str] = PRESSURE_CANONICAL) -> DataFrame:
    """Project the canonical columns in order."""
    return df.select(*cols)


def merge(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def dedupe(df: DataFrame) -> DataFrame:
    """Distinct rows over all columns (NaN equals NaN, NULL equals NULL)."""
    return df.distinct()


__all__ = [
    "fill_nan", "fill_missing", "categorize_publisher", "publisher_category", "tag_range",
    "to_hpa", "convert_range", "convert_back", "canonical", "merge", "dedupe", "scale_round",
]
