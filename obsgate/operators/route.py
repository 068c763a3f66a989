"""Good / quarantine routing of parsed rows.

Routing is a pair of complementary filters over the same parsed frame, so
every input line ends up in exactly one of them (no sampling, no caps).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from obsgate.operators.parse import CORRUPT, ERROR_CLASS
from obsgate.sources.registry import TEMPERATURE

ACCEPTABLE = "isAcceptableNullColumns"
MANDATORY_NULL = "MANDATORY_NULL"
QUARANTINE_COLUMNS = ["file_name", "line", "error_class"]
DROPPED = "rows_dropped"


def acceptable(cols: Sequence[str] = TEMPERATURE.mandatory) -> Column:
    """True iff every mandatory column is non-NULL (native predicate, no UDF)."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def to_quarantine(bad: DataFrame, error_class: Column | None = None, value_col: str = "value") -> DataFrame:
    """Quarantine rows: source file (name and, if known, path), raw line, reason, and the typed columns."""
    err = F.col(ERROR_CLASS) if error_class is None else error_class
    first = [c for c in ("file_path", "file_name") if c in bad.columns]
    rest = [c for c in bad.columns if c not in (*first, value_col, ERROR_CLASS, CORRUPT)]
    return bad.select(*first, F.col(value_col).alias("line"), err.alias("error_class"), *rest)


def route_pressure(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split parsed pressure rows into (good rows without corrupt columns, quarantine)."""
    good = parsed.filter(F.col(ERROR_CLASS).isNull()).drop(CORRUPT, ERROR_CLASS)
    bad = to_quarantine(parsed.filter(F.col(ERROR_CLASS).isNotNull()))
    return good, bad


def with_acceptability(parsed: DataFrame, mandatory: Sequence[str] = TEMPERATURE.mandatory) -> DataFrame:
    return parsed.withColumn(ACCEPTABLE, acceptable(mandatory))


def route_temperature(
    parsed: DataFrame,
    mandatory: Sequence[str] = TEMPERATURE.mandatory,
    *,
    legacy_mandatory_null: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Split parsed temperature rows into (kept rows, quarantine).

    A row is kept when its mandatory columns are all present, even if it is
    corrupt (a short row with the mandatory values is kept). Default: every
    other row is quarantined, with class ``MANDATORY_NULL`` when it is not
    corrupt. ``legacy_mandatory_null`` reproduces the original batch rule:
    only corrupt-and-unacceptable rows are quarantined; if there is at least
    one of them, non-corrupt unacceptable rows are silently dropped,
    otherwise every row is kept. That rule needs one global existence check
    (a small job).
    """
    flagged = with_acceptability(parsed, mandatory)
    ok = F.col(ACCEPTABLE)
    corrupt = F.col(ERROR_CLASS).isNotNull()
    drop_cols = [CORRUPT, ERROR_CLASS, ACCEPTABLE]
    if not legacy_mandatory_null:
        kept = flagged.filter(ok).drop(*drop_cols)
        bad = to_quarantine(
            flagged.filter(~ok), F.coalesce(F.col(ERROR_CLASS), F.lit(MANDATORY_NULL))
        )
        return kept, bad
    bad_rows = flagged.filter(corrupt & ~ok)
    any_bad = bad_rows.limit(1).count() > 0
    kept = flagged.filter(ok) if any_bad else flagged
    return kept.drop(*drop_cols), to_quarantine(bad_rows)
