"""Column expressions for strict token typing and file-name parsing.

All of these are built-in Spark expressions, so they stay inside
whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# A CSV int token is what Integer.parseInt accepts: optional sign, digits.
# try_cast alone would also accept surrounding blanks ("2017    ").
INT_TOKEN = r"^[+-]?[0-9]+$"
NON_BLANK = r"\S"


def typed_token_sql(ref: str, dtype: T.DataType) -> tuple[str, str]:
    """SQL for (typed value, failed flag) of a token referenced as ``ref``."""
    name = dtype.simpleString()
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        value = f"CASE WHEN {ref} RLIKE '{INT_TOKEN}' THEN try_cast({ref} AS {name}) END"
    elif isinstance(dtype, T.StringType):
        return ref, "false"
    else:
        value = f"try_cast({ref} AS {name})"
    return value, f"({ref} IS NOT NULL AND ({value}) IS NULL)"


def strict_int(tok: Column) -> Column:
    """String -> int the way Integer.parseInt does, NULL when it would throw."""
    return F.when(tok.rlike(INT_TOKEN), tok.try_cast("int"))


def name_parts(name: Column, sep: str = "_") -> Column:
    """Split like Java's String.split: trailing empty parts are dropped."""
    return F.split(F.regexp_replace(name, f"{sep}+$", ""), sep)


def name_years(name: Column) -> tuple[Column, Column]:
    """(start, end) years encoded in a file name.

    More than five ``_``-separated parts: parts 4 and 5 (0-based); otherwise
    part 2 and the first four characters of part 3. NULL where the original
    would fail to parse.
    """
    parts = name_parts(name)
    n = F.size(parts)
    long_form = n > 5
    start_tok = F.when(long_form, F.get(parts, 4)).otherwise(F.get(parts, 2))
    p3 = F.get(parts, 3)
    end_tok = F.when(long_form, F.get(parts, 5)).otherwise(
        F.when(F.length(p3) >= 4, F.substring(p3, 1, 4))
    )
    return strict_int(start_tok), strict_int(end_tok)


def is_manual_station(name: Column, automatic_prefix: str) -> Column:
    """Provenance flag: files from automatic stations carry a name prefix."""
    return ~name.startswith(automatic_prefix)
