import math

from pyspark.sql import functions as F

from obsgate.operators.parse import parse_lines
from obsgate.operators.route import route_pressure
from obsgate.operators.transform import (
    convert_back,
    convert_range,
    dedupe,
    fill_missing,
    merge,
)
from obsgate.operators.validate import (
    coverage_by_file,
    day_rank,
    dense_rank_keys,
    duplicate_rows,
    has_duplicates,
    has_multi_record_days,
    multi_record_days,
    range_check,
    range_summary,
    roundtrip_mismatches,
    schema_diff,
    schema_matches,
)
from obsgate.sources.registry import (
    MAX_AIR_PRESSURE_HPA,
    MIN_AIR_PRESSURE_HPA,
    PRESSURE_A,
    PRESSURE_B,
    PRESSURE_C,
    TEMPERATURE,
)
from tests import sample_files as S

OBS = ["OBSERVATION1", "OBSERVATION2", "OBSERVATION3"]


def _good(lines_of, name, text, layout):
    good, _ = route_pressure(parse_lines(lines_of({name: text}), layout))
    return good


def _obs(df):
    return sorted(tuple(r[c] for c in OBS) for r in df.collect())


def test_convert_1859(spark, lines_of):
    conv = convert_range(_good(lines_of, "f", S.BARO_1859_1861, PRESSURE_A), "1859_1861")
    assert conv.columns == ["YEAR", "MONTH", "DAY", *OBS, "SPLIT_RANGE"]
    assert _obs(conv) == sorted(tuple(S.hpa(x, 25.4 * 1.333224 * 0.1) for x in v) for v in S.REDUCED_1859)
    assert dict(conv.dtypes)["OBSERVATION1"] == "double"


def test_convert_1756_nan_and_option(spark, lines_of):
    good = _good(lines_of, "f", S.BARO_1756_1858, PRESSURE_B)
    conv = convert_range(good, "1756_1858").orderBy("DAY")
    rows = conv.collect()
    first = [round(x, 2) for x in S.FIRST_1756]
    assert [r["OBSERVATION1"] for r in rows] == [S.hpa(x, 25.4 * 1.333224) for x in first]
    assert [r["OBSERVATION3"] for r in rows] == [x and S.hpa(x, 25.4 * 1.333224) for x in S.THIRD_1756]
    assert all(r["OBSERVATION2"] is None for r in rows)  # NaN -> NULL by the decimal cast
    filled = fill_missing(conv).orderBy("DAY").collect()
    assert math.isnan(filled[0]["OBSERVATION2"]) and math.isnan(filled[0]["OBSERVATION3"])
    alt = convert_range(good, "1756_1858", swedish_inch_mm=29.69).orderBy("DAY").collect()
    assert [r["OBSERVATION1"] for r in alt] == [S.hpa(x, 29.69 * 1.333224) for x in first]


def test_convert_1862_and_passthrough(spark, lines_of):
    conv = convert_range(_good(lines_of, "f", S.BARO_1862_1937, PRESSURE_C), "1862_1937")
    assert _obs(conv) == sorted(tuple(S.hpa(x, 1.333224) for x in v) for v in S.GOOD_1862)
    same = convert_range(_good(lines_of, "f", S.BARO_1938_1960, PRESSURE_C), "1938_1960")
    assert _obs(same) == sorted(tuple(v) for v in S.YEARS_1938.values())


def test_roundtrip_1859_is_empty(spark, lines_of):
    src = _good(lines_of, "f", S.BARO_1859_1861, PRESSURE_A)
    back = convert_back(convert_range(src, "1859_1861"))
    source = src.select(*[F.col(f"REDUCED_AIR_PRESSURE{i}").alias(f"OBSERVATION{i}") for i in (1, 2, 3)])
    assert roundtrip_mismatches(back, source).count() == 0


def test_coverage_verdicts(spark, lines_of):
    files = dict(S.UNIT)
    files.pop("stockholmA_barometer_2013_2017.txt")
    parsed = parse_lines(lines_of(files), PRESSURE_C)
    got = {r["file_name"]: r for r in coverage_by_file(parsed).collect()}
    assert got["stockholm_barometer_1938_1960.txt"]["reason"] is None
    assert got["stockholm_barometer_1938_1960.txt"]["year_count"] == 23
    assert got["stockholm_barometer_1859_1861.txt"]["reason"] == "COVERAGE"
    t = got["stockholmA_daily_temp_obs_2013_2017_t1t2t3txtntm.txt"]
    assert (t["name_start_year"], t["name_end_year"]) == (2013, 2017)  # long name form
    # Name with end year before the start year, and a name that does not parse.
    extra = lines_of({"stockholm_daily_temp_obs_2013_1858_t1t2t3_tempCopy.txt": "2013\t1\t1",
                      "weird.txt": "2013\t1\t1"})
    got = {r["file_name"]: r["reason"] for r in coverage_by_file(parse_lines(extra, PRESSURE_C)).collect()}
    assert got == {"stockholm_daily_temp_obs_2013_1858_t1t2t3_tempCopy.txt": "COVERAGE",
                   "weird.txt": "BAD_NAME"}


def test_duplicates_and_days(spark, lines_of):
    t = parse_lines(lines_of({"a": S.TEMP_A_2013_2017_UNIT}), TEMPERATURE).select(*TEMPERATURE.names)
    assert not has_duplicates(t)
    assert not has_multi_record_days(t.distinct())
    doubled = merge(t, t)
    assert has_duplicates(doubled)
    assert {r["n"] for r in duplicate_rows(doubled).collect()} == {2}
    assert dedupe(doubled).count() == 5
    p = parse_lines(lines_of({"b": S.BARO_1859_1861}), PRESSURE_A)
    assert [tuple(r) for r in multi_record_days(p.distinct()).collect()] == [(1859, 6, 2, 4)]
    # NULL day keys count as one key.
    nulls = spark.createDataFrame([(None, 1, 1), (None, 1, 1), (2000, 1, 1)], "YEAR int, MONTH int, DAY int")
    assert multi_record_days(nulls).count() == 1


def test_dense_rank_matches_window(spark):
    from pyspark.sql import Window

    rows = [(y, m, d) for y in (1999, 2000, None) for m in (1, 2, None) for d in (3, 1)]
    df = spark.createDataFrame(rows * 3, "YEAR int, MONTH int, DAY int")
    ours = {(r["MONTH"], r["DAY"], r["YEAR"]): r["day_rank"]
            for r in dense_rank_keys(df, ["MONTH", "DAY", "YEAR"], num_partitions=4).collect()}
    w = Window.orderBy(F.col("MONTH").asc_nulls_first(), F.col("DAY").asc_nulls_first(),
                       F.col("YEAR").asc_nulls_first())
    ref = {(r["MONTH"], r["DAY"], r["YEAR"]): r["rk"]
           for r in df.withColumn("rk", F.dense_rank().over(w)).collect()}
    assert ours == ref
    ranked = day_rank(df)
    assert ranked.count() == df.count()
    assert ranked.select("day_rank").distinct().count() == len(ref)


def test_schema_integrity(spark, lines_of):
    ref = _good(lines_of, "f", S.BARO_1938_1960, PRESSURE_C)
    conv = convert_range(_good(lines_of, "g", S.BARO_1859_1861, PRESSURE_A), "1859_1861").drop("SPLIT_RANGE")
    assert schema_matches(ref.select("YEAR", "MONTH", "DAY", *OBS), conv)
    assert not schema_matches(ref.select("YEAR", "MONTH", "DAY", *OBS), conv.select("MONTH", "YEAR", "DAY", *OBS))
    diff = schema_diff(spark, ref.select("YEAR", "MONTH"), conv.select(F.col("year"), "DAY", "OBSERVATION1"))
    assert [r["matches"] for r in diff.orderBy("position").collect()] == [True, False, False]


def test_range_check(spark, lines_of):
    conv = convert_range(_good(lines_of, "f", S.BARO_1938_1960, PRESSURE_C), "1938_1960")
    s = range_summary(conv, OBS, MIN_AIR_PRESSURE_HPA, MAX_AIR_PRESSURE_HPA).first()
    assert (s["n_rows"], s["n_in_range"], s["n_out_of_range"], s["all_in_range"]) == (23, 22, 1, False)
    out = range_check(conv, OBS, MIN_AIR_PRESSURE_HPA, MAX_AIR_PRESSURE_HPA).filter("NOT in_range").first()
    assert out["YEAR"] == 1950
