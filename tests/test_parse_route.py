import math

from pyspark.sql import functions as F

from obsgate.operators.parse import ERROR_CLASS, parse_lines
from obsgate.operators.route import route_pressure, route_temperature
from obsgate.operators.transform import fill_nan
from obsgate.plans.pressure import parse_pressure
from obsgate.sources.registry import PRESSURE_C, TEMPERATURE
from obsgate.sources.text import read_lines, with_provenance
from tests import sample_files as S


def _classes(df):
    return [r[ERROR_CLASS] for r in df.orderBy("value").select("value", ERROR_CLASS).collect()]


def test_minimum_slice_1862(spark, lines_of):
    parsed = parse_lines(lines_of({"stockholm_barometer_1862_1937.txt": S.BARO_1862_1937}), PRESSURE_C)
    good, bad = route_pressure(parsed)
    assert good.count() == 7
    assert bad.count() == 1
    b = bad.first()
    assert b["error_class"] == "TYPE"
    assert b["line"] == S.BAD_1862
    first = good.filter("DAY = 1").first()
    assert [first["OBSERVATION1"], first["OBSERVATION2"], first["OBSERVATION3"]] == S.GOOD_1862[0]


def test_arity_and_type_classes(spark, lines_of):
    parsed = parse_lines(lines_of(S.MOCK_PRESSURE).filter(
        F.col("file_name") == "stockholmA_barometer_2013_2017.txt"), PRESSURE_C)
    got = {r["value"].split("\t")[0]: r[ERROR_CLASS] for r in parsed.collect()}
    assert got == S.BAD_YEARS  # with 5 tokens the first reading lands in the int DAY column
    # null_row: a TYPE failure blanks the whole row.
    row = parsed.filter(F.col("value").startswith("20157")).first()
    assert row["YEAR"] is None and row["OBSERVATION1"] is None
    # A pure ARITY row keeps its (padded) values.
    short = spark.createDataFrame([("1900\t1\t2\t3.5", "f")], "value string, file_name string")
    row = parse_lines(short, PRESSURE_C).first()
    assert row[ERROR_CLASS] == "ARITY" and row["YEAR"] == 1900 and row["OBSERVATION1"] == 3.5
    assert row["OBSERVATION2"] is None


def test_space_separated_file_all_bad(spark, lines_of):
    parsed = parse_lines(lines_of({"x": S.BARO_A_2013_2017_SPACES}), PRESSURE_C)
    assert parsed.count() == 6
    assert set(_classes(parsed)) == {"ARITY_TYPE"}


def test_token_edge_cases(spark, lines_of):
    lines = [
        "",                                   # blank: skipped
        "\t\t",                               # tab-only: skipped
        "   ",                                # space-only: skipped
        "1900\t1\t1\t1e3\t5d\tInf",           # all accepted as doubles
        "1900\t1\t2\t1013.3x\t1\t1",          # TYPE
        "1900\t1\t3\t1,013.2\t1\t1",          # TYPE
        "2017    \t1\t4\t1\t1\t1",            # int with blanks: TYPE
        "+1900\t1\t5\t NaN\tNaN\t",           # signed int ok; blank last token is NULL, not corrupt
        "1900\t1\t6\t1\t1\t1\t1\t1\t1\t1",    # too many tokens: ARITY, truncated
    ]
    df = spark.createDataFrame([(v, "f") for v in lines], "value string, file_name string")
    parsed = parse_lines(df, PRESSURE_C, policy="partial")
    by_day = {r["DAY"]: r for r in parsed.collect() if r["DAY"] is not None}
    assert parsed.count() == 6
    assert by_day[1][ERROR_CLASS] is None
    assert (by_day[1]["OBSERVATION1"], by_day[1]["OBSERVATION2"], by_day[1]["OBSERVATION3"]) == (
        1000.0, 5.0, math.inf)
    assert by_day[2][ERROR_CLASS] == "TYPE" and by_day[2]["OBSERVATION1"] is None
    assert by_day[3][ERROR_CLASS] == "TYPE"
    assert by_day[4][ERROR_CLASS] == "TYPE" and by_day[4]["YEAR"] is None
    assert by_day[5][ERROR_CLASS] is None and by_day[5]["YEAR"] == 1900
    assert math.isnan(by_day[5]["OBSERVATION1"]) and by_day[5]["OBSERVATION3"] is None
    assert by_day[6][ERROR_CLASS] == "ARITY" and by_day[6]["OBSERVATION3"] == 1.0


def test_temperature_routing_keeps_short_rows(spark, lines_of):
    name = "stockholm_daily_temp_obs_1756_1858_t1t2t3_tempCopy.txt"
    parsed = with_provenance(parse_lines(lines_of({name: S.MOCK_TEMPERATURE[name]}), TEMPERATURE))
    kept, bad = route_temperature(fill_nan(parsed, ["MAX_TEMP", "MIN_TEMP", "MEAN_TEMP"]))
    assert kept.count() == 10
    assert bad.count() == 1
    assert bad.first()["error_class"] == "ARITY"
    assert kept.distinct().count() == 6
    r = kept.filter("YEAR = 1858 AND MONTH = 10").first()
    assert math.isnan(r["MAX_TEMP"]) and r["EVE_TEMP"] == 13.1


def test_type_error_policies(spark, lines_of):
    name = "stockholmA_daily_temp_obs_2013_2017_t1t2t3txtntm.txt"
    lines = lines_of({name: S.MOCK_TEMPERATURE[name]})
    for policy, n_kept, n_days in (("null_row", 5, 5), ("partial", 6, 5)):
        parsed = with_provenance(parse_lines(lines, TEMPERATURE, policy=policy))
        kept, bad = route_temperature(parsed)
        assert kept.count() == n_kept, policy
        assert kept.select("YEAR", "MONTH", "DAY").distinct().count() == n_days
        assert kept.count() + bad.count() == 6


def test_mandatory_null_default_and_legacy(spark):
    rows = [
        ("1900\t1\t1\t1\t2\t3\t4\t5\t6", "f"),   # fine
        ("1900\t1\t2\t\t2\t3\t4\t5\t6", "f"),    # right arity, blank MORG_TEMP
    ]
    df = spark.createDataFrame(rows, "value string, file_name string")
    kept, bad = route_temperature(parse_lines(df, TEMPERATURE))
    assert kept.count() == 1
    assert [r["error_class"] for r in bad.collect()] == ["MANDATORY_NULL"]
    # Legacy: no corrupt-and-unacceptable row in the batch -> everything is kept.
    kept, bad = route_temperature(parse_lines(df, TEMPERATURE), legacy_mandatory_null=True)
    assert kept.count() == 2 and bad.count() == 0
    # Legacy with one corrupt unacceptable row: blank-mandatory row dropped silently.
    df2 = df.union(spark.createDataFrame([("\t\t\t\t1", "f")], "value string, file_name string"))
    kept, bad = route_temperature(parse_lines(df2, TEMPERATURE), legacy_mandatory_null=True)
    assert kept.count() == 1 and bad.count() == 1


def test_read_lines_from_directory(spark, tmp_path):
    d = S.write_dir(tmp_path / "p", S.MOCK_PRESSURE)
    lines = read_lines(spark, d)
    assert lines.select("file_name").distinct().count() == 6
    parsed = parse_pressure(lines)
    per = {r["file_name"]: r["n"] for r in parsed.filter(F.col(ERROR_CLASS).isNotNull())
           .groupBy("file_name").agg(F.count("*").alias("n")).collect()}
    assert per == {"stockholm_barometer_1862_1937.txt": 1, "stockholmA_barometer_2013_2017.txt": 5}


def test_layout_keys_are_escaped(spark):
    from obsgate.operators.parse import parse_by_layout
    from obsgate.sources.registry import PRESSURE_B

    df = spark.createDataFrame([("1900\t1\t2\t3\t4\t5", "it's"), ("1900\t1\t2\t3\t4\t5\t6\t7\t8", "b\\x")],
                               "value string, k string")
    got = {r["k"]: (r[ERROR_CLASS], r["OBSERVATION1"], r["BARO_OBS1"])
           for r in parse_by_layout(df, {"it's": PRESSURE_C, "b\\x": PRESSURE_B}, "k").collect()}
    assert got == {"it's": (None, 3.0, None), "b\\x": (None, None, 3.0)}


def test_file_names_are_decoded(spark, tmp_path):
    names = ["a b.txt", "c+d.txt", "e%41.txt", "stockholm_barometer_1938_1960.txt"]
    S.write_dir(tmp_path / "n", {n: "1\t2\t3" for n in names})
    got = {r["file_name"] for r in read_lines(spark, str(tmp_path / "n")).collect()}
    assert got == set(names)
