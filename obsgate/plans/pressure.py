"""Pressure load: file -> range -> layout parse (all layouts in one pass) ->
quarantine -> coverage gate on good rows -> hPa conversion -> fill ->
de-duplicate -> partitioned write.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from obsgate.operators.parse import ERROR_CLASS, parse_by_layout
from obsgate.operators.route import MANDATORY_NULL, route_pressure, to_quarantine
from obsgate.operators.transform import dedupe, fill_missing, to_hpa
from obsgate.operators.validate import accepted_rows, coverage_from_state, coverage_state, has_multi_record_days
from obsgate.plans.common import FILE_KEY, FILE_KEYS, Load, LoadResult
from obsgate.sinks.parquet import write_quarantine
from obsgate.sources.text import with_file_path
from obsgate.sources.registry import (
    PRESSURE_CANONICAL,
    PRESSURE_FILE_RANGES,
    PRESSURE_LAYOUTS,
    SWEDISH_INCH_TO_MMHG,
    pressure_layout_key,
)

PARTITION_COLS = ["SPLIT_RANGE", "YEAR"]
LAYOUT_COL = "__layout"


def range_of(file_name: Column, ranges: Mapping[str, str] = PRESSURE_FILE_RANGES) -> Column:
    """File name -> range label through a literal map (no join); NULL when unknown."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(ranges.items())])
    return F.element_at(m, file_name)


def layout_of(range_label: Column, ranges: Mapping[str, str] = PRESSURE_FILE_RANGES) -> Column:
    expr = None
    for label in sorted(set(ranges.values())):
        key = pressure_layout_key(label)
        cond = range_label == label
        expr = F.when(cond, F.lit(key)) if expr is None else expr.when(cond, F.lit(key))
    return expr


def parse_pressure(lines: DataFrame, *, ranges: Mapping[str, str] = PRESSURE_FILE_RANGES,
                   policy: str = "null_row") -> DataFrame:
    """Every line typed against its file's layout, tagged with SPLIT_RANGE."""
    tagged = with_file_path(lines).withColumn("SPLIT_RANGE", range_of(F.col("file_name"), ranges))
    tagged = tagged.withColumn(LAYOUT_COL, layout_of(F.col("SPLIT_RANGE"), ranges))
    parsed = parse_by_layout(tagged, PRESSURE_LAYOUTS, LAYOUT_COL, policy=policy)
    # Only rows that can be quarantined (corrupt, or without a YEAR when the
    # legacy 0-fill is off) keep the raw line: staging the parsed lines then
    # costs little more than the typed values.
    line = F.when(F.col(ERROR_CLASS).isNotNull() | F.col("YEAR").isNull(), F.col("value"))
    return parsed.withColumn("value", line).drop(LAYOUT_COL, "_corrupt_record")


def pressure_state(parsed: DataFrame) -> DataFrame:
    """Mergeable per-file state; years of good rows of known files count.

    A file is known if its rows carry a range, whatever registry gave it.
    """
    good, known = F.col(ERROR_CLASS).isNull(), F.col("SPLIT_RANGE").isNotNull()
    return coverage_state(parsed, FILE_KEY, name_col="file_name", where=good & known, bad=~good,
                          sums={"n_no_year": good & known & F.col("YEAR").isNull()}, tops={"split_range": F.col("SPLIT_RANGE")})


def pressure_verdicts(files: DataFrame) -> DataFrame:
    """Verdicts with those of pressure files: unknown name, all rows corrupt, or coverage of good rows."""
    reason = (
        F.when(F.col("split_range").isNull(), F.lit("UNKNOWN_FILE"))
        .when(F.col("n_bad") == F.col("n_rows"), F.lit("ALL_CORRUPT"))
        .otherwise(F.col("reason"))
    )
    return files.withColumn("reason", reason).withColumn("covered", F.col("reason").isNull())


def pressure_files(parsed: DataFrame) -> DataFrame:
    """Per-file verdicts."""
    return pressure_verdicts(coverage_from_state(pressure_state(parsed), FILE_KEYS))


def pressure_quarantine(parsed: DataFrame) -> DataFrame:
    """Bad rows of every identified file (written before the coverage gate, as the original)."""
    _, bad = route_pressure(parsed.filter(F.col("SPLIT_RANGE").isNotNull()))
    return bad


def process_pressure(good_accepted: DataFrame, *, swedish_inch_mm: float = SWEDISH_INCH_TO_MMHG,
                     legacy_int_fill: bool = True) -> DataFrame:
    """Convert to hPa, project canonical columns, fill missing values (pre-dedupe)."""
    converted = to_hpa(good_accepted, swedish_inch_mm=swedish_inch_mm)
    return fill_missing(converted, legacy_int_fill=legacy_int_fill).select(*PRESSURE_CANONICAL)


def load_pressure(
    spark: SparkSession,
    source: str | Sequence[str] | DataFrame,
    output: str | None = None,
    quarantine_path: str | None = None,
    *,
    ranges: Mapping[str, str] = PRESSURE_FILE_RANGES,
    policy: str = "null_row",
    swedish_inch_mm: float = SWEDISH_INCH_TO_MMHG,
    legacy_int_fill: bool = True,
    mode: str = "append",
    quarantine_format: str = "csv",
    **options,
) -> LoadResult:
    """Load ``source`` into the Parquet table at ``output``; options as of :func:`obsgate.plans.temperature.load_temperature`."""
    with Load(spark, "pressure", source, output, PARTITION_COLS, mode=mode, **options) as run:
        parsed, _ = run.stages.add(parse_pressure(run.lines(), ranges=ranges, policy=policy), "parsed")
        ok = F.col("reason").isNull()
        files, counts = run.verdicts(pressure_state(parsed), pressure_verdicts, n_good=F.when(ok, F.col("n_counted")),
                                     n_no_year=F.when(ok, F.col("n_no_year")),
                                     rows_quarantined=F.when(F.col("split_range").isNotNull(), F.col("n_bad")))
        good, _ = route_pressure(parsed)
        good = accepted_rows(good, files, FILE_KEY)
        bad = pressure_quarantine(parsed)
        if not legacy_int_fill:
            # Without the legacy 0-fill a row without a YEAR has no partition to
            # go to: quarantine it instead of writing YEAR=0.
            no_year = F.col("YEAR").isNull()
            bad = bad.unionByName(to_quarantine(good.filter(no_year), F.lit(MANDATORY_NULL)))
            good = good.filter(~no_year)
        kept = process_pressure(good, swedish_inch_mm=swedish_inch_mm, legacy_int_fill=legacy_int_fill)
        loaded, rows = run.store(dedupe(kept))

        kept_rows, no_years = counts.pop("n_good"), counts.pop("n_no_year")
        if not legacy_int_fill:
            kept_rows -= no_years
            counts["rows_quarantined"] += no_years
        gates = {"multi_record_days": has_multi_record_days(loaded), "schema_ok": run.schema_ok(loaded)}
        gates["gates_passed"] = counts["files_accepted"] > 0 and gates["schema_ok"] is not False
        gates["loaded"] = output is not None and gates["gates_passed"]
        counts |= {"rows_kept": kept_rows, "rows_dropped": 0, "rows_staged": rows, "rows_deduped": kept_rows - rows,
                   "rows_loaded": rows if gates["loaded"] else 0}
        if quarantine_path is not None and counts["rows_quarantined"] > 0:
            write_quarantine(bad, quarantine_path, run.load_id, fmt=quarantine_format)
        return run.finish(loaded, bad, files, counts, gates)
