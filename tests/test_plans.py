"""Physical-plan properties the operators rely on at scale."""

from pyspark.sql import functions as F

from obsgate.operators.parse import ERROR_CLASS, good_rows, parse_lines
from obsgate.operators.route import route_temperature
from obsgate.operators.validate import accepted_rows, coverage_by_file, multi_record_days
from obsgate.plans.pressure import parse_pressure, pressure_files
from obsgate.sinks.parquet import stage
from obsgate.sources.registry import PRESSURE_C, TEMPERATURE
from tests import sample_files as S


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_tokeniser_runs_once_per_layout(spark, lines_of):
    lines = lines_of({"stockholm_barometer_1862_1937.txt": S.BARO_1862_1937})
    p = plan(good_rows(parse_lines(lines, PRESSURE_C)).select("YEAR", "OBSERVATION1"))
    assert p.count("from_csv(") == 1
    kept, _ = route_temperature(parse_lines(lines, TEMPERATURE))
    assert plan(kept).count("from_csv(") == 1
    multi = plan(good_rows(parse_pressure(lines)))
    assert multi.count("from_csv(") == 3  # one guarded tokeniser per layout, same projection


def test_blank_line_filter_stays_above_derived_lines(spark):
    df = spark.range(100).select(
        F.concat_ws("\t", F.col("id").cast("string"), F.lit("1"), F.lit("2")).alias("value"),
        F.lit("f").alias("file_name"))
    p = plan(parse_lines(df, PRESSURE_C))
    # The line expression (concat_ws) is computed once, not again inside a pushed filter.
    assert p.count("concat_ws(") == 1


def test_staged_scan_prunes_and_pushes(spark, lines_of):
    parsed = stage(parse_pressure(lines_of(S.MOCK_PRESSURE)), "plan-test")
    p = plan(good_rows(parsed).select("file_name", "YEAR"))
    assert "PushedFilters: [IsNull(_error_class)" in p
    assert "ReadSchema: struct<file_name:string,YEAR:int,_error_class:string>" in p


def test_accepted_rows_are_not_shuffled(spark, lines_of):
    """Staged verdicts have a true size: a broadcast from the first plan on, no Exchange above the rows."""
    parsed = stage(parse_pressure(lines_of(S.MOCK_PRESSURE)), "plan-parsed")
    files = stage(pressure_files(parsed), "plan-files")
    p = plan(accepted_rows(good_rows(parsed), files, "file_path"))
    assert "BroadcastHashJoin" in p and "LeftSemi" in p and "hashpartitioning" not in p


def test_gates_are_aggregates_and_semi_joins(spark, lines_of):
    parsed = parse_pressure(lines_of(S.MOCK_PRESSURE))
    files = pressure_files(parsed)
    p = plan(accepted_rows(good_rows(parsed), files))
    assert "LeftSemi" in p
    days = plan(multi_record_days(good_rows(parsed)))
    assert "HashAggregate" in days and "Window" not in days
    assert "HashAggregate" in plan(coverage_by_file(parsed))
    assert ERROR_CLASS in parsed.columns
