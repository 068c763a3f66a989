"""Data-quality validators.

Each validator is a lazy DataFrame that *reports* (offending rows, per-file
verdicts, schema differences); the ``has_*`` helpers turn a report into a
boolean with one small job (``limit(1)``), never a full collect. The dense
rank stages its distinct keys (one small job) to stay consistent.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from obsgate.functions.rowkey import row_bytes
from obsgate.functions.tokens import name_years
from obsgate.sinks.parquet import stage

DAY_KEYS = ("YEAR", "MONTH", "DAY")


# --- V1: year coverage per file ------------------------------------------------

WORD = 64  # years of one bitmap word


def coverage_state(
    df: DataFrame,
    file_col: str = "file_name",
    year_col: str = "YEAR",
    *,
    name_col: str | None = None,
    where: Column | None = None,
    bad: Column | None = None,
    sums: Mapping[str, Column] | None = None,
    tops: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Mergeable state of each file's years and rows: a row per file and word of 64 years.

    A word holds the years observed as bits, so distinct years are counted
    without a row per year, and the states of a file's parts (tasks, files of a
    folder, later loads) combine by ``bit_or``, minimum, maximum and sum
    (:func:`merge_states`). Rows whose year doesn't count have the word NULL.
    ``where`` restricts which rows' years count (e.g. good rows only); ``bad`` counts
    rows flagged bad, ``sums`` rows that meet other conditions, ``tops`` are maxima. ``file_col``
    identifies a file (e.g. its full path); ``name_col`` holds the name with its years (default: the same column).
    """
    year = F.col(year_col).cast("int")
    counted = year if where is None else F.when(where, year)
    conditions = ({} if where is None else {"n_counted": where}) | ({} if bad is None else {"n_bad": bad}) | dict(sums or {})
    keys = [file_col] if name_col in (None, file_col) else [file_col, name_col]
    rows = df.select(*keys, counted.alias("__year"), *[F.coalesce(c, F.lit(False)).alias(n) for n, c in conditions.items()],
                     *[c.alias(n) for n, c in (tops or {}).items()])
    rows = rows.withColumn("word", F.floor(F.col("__year") / WORD).cast("int"))
    aggs = [
        F.expr(f"bit_or(shiftleft(1L, cast(pmod(__year, {WORD}) AS int)))").alias("years"),
        F.min("__year").alias("min_year"), F.max("__year").alias("max_year"), F.count(F.lit(1)).alias("n_rows"),
    ]
    return rows.groupBy(*keys, "word").agg(*aggs, *[F.count_if(n).alias(n) for n in conditions], *[F.max(n).alias(n) for n in tops or {}])


def _state_aggs(state: DataFrame, keys: Sequence[str]) -> list[Column]:
    """How each column of a state combines: bits or'ed, counts summed, the rest by maximum."""
    out = []
    for f in state.schema.fields:
        if f.name in (*keys, "word"):
            continue
        how = F.bit_or if f.name == "years" else F.min if f.name == "min_year" else F.sum if f.name.startswith("n_") else F.max
        out.append(how(f.name).alias(f.name))
    return out


def merge_states(*states: DataFrame, keys: Sequence[str] = ("file_name",)) -> DataFrame:
    """One state for the files of all ``states`` (of one or more loads)."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), states)
    return every.groupBy(*keys, "word").agg(*_state_aggs(every, keys))


def coverage_from_state(state: DataFrame, keys: Sequence[str] = ("file_name",)) -> DataFrame:
    """One row per file from its (merged) state: name years, observed years, counts, verdict.

    ``keys``: the columns that identify a file; the last one holds its name. A file is
    *covered* when the observed minimum and maximum year equal the start and
    end years in its name and every year in between occurs.
    """
    counts = [c for c in _state_aggs(state.drop("years"), keys)]
    per_file = state.groupBy(*keys).agg(F.coalesce(F.sum(F.bit_count("years").cast("long")), F.lit(0)).alias("year_count"), *counts)
    start, end = name_years(F.col(keys[-1]))
    per_file = per_file.withColumns({"name_start_year": start, "name_end_year": end})
    covered = (
        (F.col("name_start_year") == F.col("min_year"))
        & (F.col("name_end_year") == F.col("max_year"))
        & ((F.col("name_end_year") - F.col("name_start_year") + 1).cast("long") == F.col("year_count"))
    )
    reason = (
        F.when(F.col("name_start_year").isNull() | F.col("name_end_year").isNull(), F.lit("BAD_NAME"))
        .when(F.col("min_year").isNull(), F.lit("NO_YEARS"))
        .when(~covered, F.lit("COVERAGE"))
    )
    return per_file.withColumns({"covered": F.coalesce(covered, F.lit(False)), "reason": reason})


def coverage_by_file(df: DataFrame, file_col: str = "file_name", year_col: str = "YEAR", *, name_col: str | None = None,
                     **options) -> DataFrame:
    """The verdict of every file in ``df``: its state, then the verdict from it (see :func:`coverage_state`)."""
    keys = [file_col] if name_col in (None, file_col) else [file_col, name_col]
    return coverage_from_state(coverage_state(df, file_col, year_col, name_col=name_col, **options), keys)


def accepted_rows(df: DataFrame, files: DataFrame, file_col: str = "file_name",
                  accepted: Column | None = None) -> DataFrame:
    """Rows of ``df`` whose file is accepted in ``files`` (left-semi join).

    ``files`` holds one row per file. Stage it before (the loads do): its scan
    then has a true size, so the first plan already broadcasts it when it is
    under the session's limit and the rows are not shuffled at all; beyond
    the limit the join shuffles, with skew splitting.
    """
    ok = F.col("reason").isNull() if accepted is None else accepted
    return df.join(files.filter(ok).select(file_col), file_col, "left_semi")


# --- V2: duplicates -------------------------------------------------------------

def duplicate_rows(df: DataFrame, cols: Sequence[str] | None = None, count_col: str = "n") -> DataFrame:
    """Distinct row values occurring more than once, with their count.

    Rows are told apart by their exact encoding (:mod:`obsgate.functions.rowkey`).
    A 64-bit hash of it is counted first, so only eight bytes of a row are
    shuffled; the encodings themselves are compared for the rows whose hash
    occurs again, and rows of different values that share a hash stay apart.
    """
    cols = list(df.columns if cols is None else cols)
    names = [F.col(f"__row.`{c}`") for c in cols]
    keyed = df.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__row"), row_bytes(df.schema, cols).alias("__bytes"))
    keyed = keyed.withColumn("__hash", F.xxhash64("__bytes"))
    again = keyed.groupBy("__hash").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1).select("__hash")
    rows = keyed.join(again, "__hash", "left_semi")
    counted = rows.groupBy("__hash", "__bytes").agg(F.any_value("__row").alias("__row"), F.count(F.lit(1)).alias("__n"))
    return counted.filter(F.col("__n") > 1).select(*[n.alias(c) for n, c in zip(names, cols)], F.col("__n").alias(count_col))


def has_duplicates(df: DataFrame, cols: Sequence[str] | None = None) -> bool:
    return duplicate_rows(df, cols).limit(1).count() > 0


# --- V3: several records for one day -------------------------------------------

def multi_record_days(df: DataFrame, keys: Sequence[str] = DAY_KEYS, count_col: str = "n") -> DataFrame:
    """Day keys (NULL is a value) that carry more than one row.

    Equivalent to comparing the row count with the number of distinct dense
    ranks over (MONTH, DAY, YEAR), but as a partially aggregated group-by
    instead of a window over a single partition.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).filter(F.col(count_col) > 1)


def has_multi_record_days(df: DataFrame, keys: Sequence[str] = DAY_KEYS) -> bool:
    return multi_record_days(df, keys).limit(1).count() > 0


# --- W1: dense rank over (MONTH, DAY, YEAR) ------------------------------------

def dense_rank_keys(keys_df: DataFrame, order: Sequence[str], out: str = "day_rank",
                    num_partitions: int | None = None) -> DataFrame:
    """Dense rank of the distinct key tuples of ``keys_df`` in ``order`` (NULLS FIRST).

    Distributed: distinct keys are range-partitioned and sorted, each
    partition numbers its rows, and a prefix sum over the per-partition counts
    (one row per partition, so a proven-small broadcast) turns local numbers
    into global ranks. No step moves all keys into one task.

    The numbered keys (one row per distinct key) are staged as Parquet in the
    shared checkpoint folder (one small job when called), so the counts and
    the local numbers always come from the same range partitioning: two
    independent samplings of the range bounds could otherwise disagree.
    """
    keys = keys_df.select(*order).distinct()
    sort_cols = [F.col(c).asc_nulls_first() for c in order]
    # Without an explicit count AQE may merge adjacent ranges (order is kept).
    ranged = (keys.repartitionByRange(num_partitions, *sort_cols) if num_partitions
              else keys.repartitionByRange(*sort_cols)).sortWithinPartitions(*sort_cols)
    mid = F.monotonically_increasing_id()
    numbered = ranged.withColumn("__mid", mid).withColumns({
        "__pid": F.shiftright(F.col("__mid"), 33),
        "__local": F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1)),
    })
    numbered = stage(numbered, "dense-rank-keys")
    counts = numbered.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.withColumn(
        "__offset",
        F.coalesce(
            F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ),
    ).select("__pid", "__offset")
    ranked = numbered.join(F.broadcast(offsets), "__pid")
    return ranked.select(*order, (F.col("__offset") + F.col("__local") + 1).alias(out))


def day_rank(df: DataFrame, order: Sequence[str] = ("MONTH", "DAY", "YEAR"), out: str = "day_rank") -> DataFrame:
    """Add the dense rank of each row's day (ordered MONTH, DAY, YEAR) to every row.

    The rank table has one row per distinct day; it is joined back with
    null-safe equality (a day key may be NULL).
    """
    ranks = dense_rank_keys(df, order, out)
    r = ranks.select(*[F.col(c).alias(f"__r_{c}") for c in order], out)
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in order])
    return df.join(r, cond, "inner").drop(*[f"__r_{c}" for c in order])


# --- V4: schema integrity -------------------------------------------------------

SCHEMA_DIFF_SCHEMA = T.StructType([
    T.StructField("position", T.IntegerType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("source_type", T.StringType()),
    T.StructField("target_name", T.StringType()),
    T.StructField("target_type", T.StringType()),
    T.StructField("matches", T.BooleanType()),
])


def _schema_rows(src: T.StructType, tgt: T.StructType) -> list[tuple]:
    rows = []
    for i in range(max(len(src.fields), len(tgt.fields))):
        s = src.fields[i] if i < len(src.fields) else None
        t = tgt.fields[i] if i < len(tgt.fields) else None
        s_name, s_type = (s.name, s.dataType.simpleString()) if s else (None, None)
        t_name, t_type = (t.name, t.dataType.simpleString()) if t else (None, None)
        same = (
            s is not None and t is not None
            and s_name.lower() == t_name.lower()
            and s.dataType == t.dataType
        )
        rows.append((i, s_name, s_type, t_name, t_type, same))
    return rows


def schema_matches(src: DataFrame | T.StructType, tgt: DataFrame | T.StructType) -> bool:
    """Same column names (any case), types and order; nullability ignored."""
    s = src if isinstance(src, T.StructType) else src.schema
    t = tgt if isinstance(tgt, T.StructType) else tgt.schema
    return all(r[-1] for r in _schema_rows(s, t))


def schema_diff(spark: SparkSession, src: DataFrame | T.StructType, tgt: DataFrame | T.StructType) -> DataFrame:
    """Position-by-position comparison of two schemas (metadata only, tiny)."""
    s = src if isinstance(src, T.StructType) else src.schema
    t = tgt if isinstance(tgt, T.StructType) else tgt.schema
    return spark.createDataFrame(_schema_rows(s, t), SCHEMA_DIFF_SCHEMA)


# --- V5: value range --------------------------------------------------------------

def in_range(cols: Sequence[str], lo: float, hi: float) -> Column:
    """All columns within [lo, hi]; NULL/NaN count as out of range."""
    cond = reduce(lambda a, b: a & b, [F.col(c).between(lo, hi) for c in cols])
    return F.coalesce(cond, F.lit(False))


def range_check(df: DataFrame, cols: Sequence[str], lo: float, hi: float, out: str = "in_range") -> DataFrame:
    """Every row with a pass/fail flag."""
    return df.withColumn(out, in_range(cols, lo, hi))


def range_summary(df: DataFrame, cols: Sequence[str], lo: float, hi: float) -> DataFrame:
    """One row: rows, rows in range, rows out of range, verdict (no row out of range)."""
    ok = in_range(cols, lo, hi)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(ok).alias("n_in_range"),
        F.count_if(~ok).alias("n_out_of_range"),
    ).withColumn("all_in_range", F.col("n_out_of_range") == 0)


# --- V6: conversion round trip ------------------------------------------------

def roundtrip_mismatches(reversed_df: DataFrame, source_df: DataFrame,
                         cols: Sequence[str] = ("OBSERVATION1", "OBSERVATION2", "OBSERVATION3")) -> DataFrame:
    """Reverse-converted rows that do not occur in the source (EXCEPT DISTINCT)."""
    cols = list(cols)
    return reversed_df.select(*cols).subtract(source_df.select(*cols))
