"""Unit conversion with decimal rounding.

Multiplying a double reading by a factor and casting to DECIMAL(38, s)
rounds half-up on the decimal text of the product; the result is handed
back as a double. ``try_cast`` gives NULL (not an error under ANSI mode)
for NaN, infinities and overflow, which the later NaN fill turns into NaN.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def scale_round(x: Column, factor: float, scale: int = 1) -> Column:
    """``x * factor`` rounded half-up to ``scale`` decimals, as double; NULL stays NULL."""
    rounded = (x * F.lit(float(factor))).try_cast(T.DecimalType(38, scale))
    return F.when(x.isNotNull(), rounded).cast(T.DoubleType())


def scale_by_key(key: Column, source: dict[str, Column], factors: dict[str, tuple[float, int] | None],
                 default: Column) -> Column:
    """Pick a source column and factor by ``key`` in one CASE expression.

    ``factors[k]`` is ``(factor, scale)`` or ``None`` (pass the source through).
    Keys not in ``factors`` take ``default``.
    """
    expr = None
    for k, fs in factors.items():
        src = source[k]
        val = src.cast(T.DoubleType()) if fs is None else scale_round(src, fs[0], fs[1])
        expr = F.when(key == k, val) if expr is None else expr.when(key == k, val)
    return default if expr is None else expr.otherwise(default)
