import os

import pytest

from obsgate.plans.batch import load_all
from obsgate.plans.pressure import load_pressure
from obsgate.plans.temperature import load_temperature
from obsgate.sinks.parquet import local_path, shared_dir, write_quarantine, write_table
from obsgate.sources.registry import TEMPERATURE
from obsgate.sources.text import read_lines
from tests import sample_files as S


def test_temperature_end_to_end(spark, tmp_path):
    src = S.write_dir(tmp_path / "in", S.MOCK_TEMPERATURE)
    out, q = str(tmp_path / "out"), str(tmp_path / "q")
    res = load_temperature(spark, src, out, q)
    st = res.status.first().asDict()
    assert st["files_seen"] == 3 and st["files_accepted"] == 1 and st["files_rejected"] == 2
    assert st["rows_loaded"] == st["rows_staged"] == 5 and st["rows_quarantined"] == 1 and st["loaded"] is True
    assert st["multi_record_days"] is False and st["schema_ok"] is None and st["rows_dropped"] == 0
    table = spark.read.parquet(out)
    assert table.count() == 5
    assert {r["PUBLISHED_CATEGORY"] for r in table.collect()} == {"AUTOMATIC_STN"}
    assert sorted(r["YEAR"] for r in table.collect()) == [2013, 2014, 2015, 2016, 2017]
    reasons = {r["file_name"]: r["reason"] for r in res.files.collect()}
    assert reasons["stockholm_daily_temp_obs_1756_1858_t1t2t3_tempCopy.txt"] == "COVERAGE"
    quarantine = spark.read.option("header", "true").csv(q).collect()
    assert [(r["line"], r["error_class"], r["ISMANUAL"], r["isAcceptableNullColumns"]) for r in quarantine] == [
        (S.BAD_TEMPERATURE, "TYPE", "false", "false")]
    assert set(TEMPERATURE.names) <= set(quarantine[0].asDict())
    # The same rows with another type are refused: the table keeps its schema.
    again = load_temperature(spark, src, str(tmp_path / "out2"))
    assert again.gates["loaded"]
    spark.createDataFrame([("x", 2013, "C")], "MORG_TEMP string, YEAR int, PUBLISHED_CATEGORY string").write.partitionBy(
        "PUBLISHED_CATEGORY", "YEAR").parquet(str(tmp_path / "out3"))
    other = load_temperature(spark, src, str(tmp_path / "out3")).status.first()
    assert (other["schema_ok"], other["loaded"], other["rows_loaded"], other["rows_staged"]) == (False, False, 0, 5)


def test_temperature_partial_policy_refuses(spark, tmp_path):
    src = S.write_dir(tmp_path / "in", S.MOCK_TEMPERATURE)
    res = load_temperature(spark, src, str(tmp_path / "out"), policy="partial")
    st = res.status.first()
    assert (st["rows_loaded"], st["rows_staged"]) == (0, 6) and st["multi_record_days"] is True and st["loaded"] is False
    assert not os.path.exists(tmp_path / "out")


def test_pressure_end_to_end_mock(spark, tmp_path):
    src = S.write_dir(tmp_path / "in", S.MOCK_PRESSURE)
    out, q = str(tmp_path / "out"), str(tmp_path / "q")
    res = load_pressure(spark, src, out, q)
    st = res.status.first()
    assert st["files_seen"] == 6 and st["files_accepted"] == 0 and st["loaded"] is False
    reasons = {r["file_name"]: r["reason"] for r in res.files.collect()}
    assert reasons["stockholmA_barometer_2013_2017.txt"] == "ALL_CORRUPT"
    assert reasons["stockholm_barometer_1862_1937.txt"] == "COVERAGE"
    # Both files' bad rows survive (one quarantine partition per file).
    quarantine = spark.read.option("header", "true").csv(q)
    per = {r["file_name"]: r["count"] for r in quarantine.groupBy("file_name").count().collect()}
    assert per == {"stockholm_barometer_1862_1937.txt": 1, "stockholmA_barometer_2013_2017.txt": 5}
    assert not os.path.exists(out)


def test_pressure_loads_unit_file_and_rejects_unknown(spark, tmp_path):
    files = {"stockholm_barometer_1938_1960.txt": S.BARO_1938_1960, "unknown_file.txt": "1\t2\t3"}
    src = S.write_dir(tmp_path / "in", files)
    out = str(tmp_path / "out")
    res = load_pressure(spark, src, out)
    reasons = {r["file_name"]: r["reason"] for r in res.files.collect()}
    assert reasons == {"stockholm_barometer_1938_1960.txt": None, "unknown_file.txt": "UNKNOWN_FILE"}
    table = spark.read.parquet(out)
    assert table.count() == 23
    assert set(table.columns) == {"MONTH", "DAY", "OBSERVATION1", "OBSERVATION2", "OBSERVATION3",
                                  "SPLIT_RANGE", "YEAR"}
    assert {r["SPLIT_RANGE"] for r in table.select("SPLIT_RANGE").collect()} == {"1938_1960"}
    # Append twice duplicates; replacing a load by its id is idempotent and leaves other loads alone.
    load_pressure(spark, src, out)
    assert spark.read.parquet(out).count() == 46
    out2 = str(tmp_path / "out2")
    load_pressure(spark, src, out2, mode="replace_load", load_id="a")
    load_pressure(spark, src, out2, mode="replace_load", load_id="a")
    assert spark.read.parquet(out2).count() == 23
    changed = S.BARO_1938_1960.replace("\t960.0\t", "\t961.5\t", 1)
    assert changed != S.BARO_1938_1960
    other = S.write_dir(tmp_path / "other", {"stockholm_barometer_1938_1960.txt": changed})
    load_pressure(spark, other, out2, mode="replace_load", load_id="b")
    back = spark.read.parquet(out2)
    assert back.count() == 46 and back.drop("LOAD_ID").distinct().count() == 24


def test_load_all_status(spark, tmp_path):
    t = S.write_dir(tmp_path / "t", S.MOCK_TEMPERATURE)
    p = S.write_dir(tmp_path / "p", S.MOCK_PRESSURE)
    status = load_all(spark, t, p, str(tmp_path / "out"))
    got = {r["pipeline"]: r["loaded"] for r in status.collect()}
    assert got == {"temperature": True, "pressure": False}


def test_write_table_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1900, "X", 1.0), (1901, "Y", None)], "YEAR int, R string, V double")
    path = str(tmp_path / "t")
    write_table(df, path, ["R", "YEAR"])
    back = spark.read.parquet(path)
    assert back.columns == ["V", "R", "YEAR"]
    assert sorted(p for p in os.listdir(path) if p.startswith("R=")) == ["R=X", "R=Y"]
    bad = spark.createDataFrame([("a.txt", "x", "TYPE"), ("b.txt", "y", "ARITY")],
                                "file_name string, line string, error_class string")
    q = str(tmp_path / "q")
    write_quarantine(bad.filter("file_name = 'a.txt'"), q, "1")
    write_quarantine(bad, q, "2")
    write_quarantine(bad, q, "2")
    assert spark.read.option("header", "true").csv(q).count() == 3


def test_release_removes_staging(spark, tmp_path):
    src = S.write_dir(tmp_path / "in", {"stockholm_barometer_1938_1960.txt": S.BARO_1938_1960})
    res = load_pressure(spark, src)
    paths = list(res.staged)
    assert paths and all(os.path.exists(local_path(p)) for p in paths)
    assert res.loaded.count() == 23
    res.release()
    assert res.staged == [] and not any(os.path.exists(local_path(p)) for p in paths)


def test_pressure_null_year_legacy_fill_and_quarantine(spark, tmp_path):
    text = S.BARO_1938_1960 + "\n\t1\t7\t1000.0\t1000.0\t1000.0"
    src = S.write_dir(tmp_path / "in", {"stockholm_barometer_1938_1960.txt": text})
    legacy = load_pressure(spark, src)
    years = [r["YEAR"] for r in legacy.loaded.collect()]
    assert len(years) == 24 and years.count(0) == 1
    strict = load_pressure(spark, src, legacy_int_fill=False)
    assert strict.loaded.count() == 23
    assert [(r["error_class"], r["line"]) for r in strict.quarantine.collect()] == [
        ("MANDATORY_NULL", "\t1\t7\t1000.0\t1000.0\t1000.0")]


def test_same_file_name_in_two_folders_is_two_files(spark, tmp_path):
    S.write_dir(tmp_path / "a", {"stockholm_barometer_1938_1960.txt": S.BARO_1938_1960})
    S.write_dir(tmp_path / "b", {"stockholm_barometer_1938_1960.txt": S.MOCK_PRESSURE[
        "stockholm_barometer_1938_1960.txt"]})
    res = load_pressure(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    verdicts = sorted((r["file_path"].split("/")[-2], r["reason"]) for r in res.files.collect())
    assert verdicts == [("a", None), ("b", "COVERAGE")]
    assert res.loaded.count() == 23


def test_coverage_sees_bad_rows_for_temperature_only(spark, lines_of):
    from obsgate.plans.pressure import parse_pressure, pressure_files
    from obsgate.plans.temperature import parse_temperature, temperature_files

    # Temperature: the only 2014 row is short (ARITY) but its YEAR parses -> years covered.
    t = lines_of({"stockholm_daily_temp_obs_2013_2014_t1.txt":
                  "2013\t1\t1\t1\t2\t3\t4\t5\t6\n2014\t1\t1\t1\t2\t3"})
    tf = temperature_files(parse_temperature(t)).first()
    assert (tf["reason"], tf["year_count"], tf["n_bad"]) == (None, 2, 1)
    # Pressure: the only 1961 row is corrupt -> coverage fails on good rows.
    p = lines_of({"stockholm_barometer_1961_2012.txt": "\n".join(
        [f"{y}\t1\t1\t1000.0\t1000.0\t1000.0" for y in range(1962, 2013)] + ["1961\t1\t1\t1000.0"])})
    pf = pressure_files(parse_pressure(p)).first()
    assert (pf["reason"], pf["min_year"], pf["n_bad"]) == ("COVERAGE", 1962, 1)


def test_results_do_not_depend_on_aqe(spark, tmp_path):
    S.write_dir(tmp_path / "t", S.MOCK_TEMPERATURE)
    S.write_dir(tmp_path / "p", {"stockholm_barometer_1938_1960.txt": S.BARO_1938_1960,
                                 "stockholm_barometer_1862_1937.txt": S.BARO_1862_1937})

    def run():
        t = load_temperature(spark, str(tmp_path / "t"))
        p = load_pressure(spark, str(tmp_path / "p"))
        return (tuple(t.status.first()), sorted(map(tuple, t.loaded.collect())),
                tuple(p.status.first()), sorted(map(tuple, p.loaded.collect()), key=str))

    before = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        on = run()
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        off = run()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert on == off
    assert on[2][8] == 23  # pressure rows staged


def _staged(spark):
    root = os.path.join(local_path(shared_dir(spark)), "obsgate")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_custom_registry_loads_its_files(spark, tmp_path):
    src = S.write_dir(tmp_path / "in", {"own_barometer_1938_1960.txt": S.BARO_1938_1960})
    res = load_pressure(spark, src, ranges={"own_barometer_1938_1960.txt": "1938_1960"})
    assert [r["reason"] for r in res.files.collect()] == [None]
    assert res.loaded.count() == 23 and res.counts["rows_loaded"] == 0  # nothing written without an output
    assert [r["reason"] for r in load_pressure(spark, src).files.collect()] == ["UNKNOWN_FILE"]


def test_quarantine_keeps_both_runs(spark, tmp_path):
    """Files of one name from two folders in two runs: every bad line stays."""
    q = str(tmp_path / "q")
    for n, bad in (("a", "x1"), ("b", "x2")):
        text = S.BARO_1938_1960 + f"\n{bad}\t1\t7\t1000.0\t1000.0\t1000.0"
        load_pressure(spark, S.write_dir(tmp_path / n, {"stockholm_barometer_1938_1960.txt": text}), None, q)
    rows = spark.read.option("header", "true").csv(q).collect()
    assert sorted(r["line"][:2] for r in rows) == ["x1", "x2"]
    assert len({r["file_path"] for r in rows}) == 2 and "OBSERVATION1" in rows[0].asDict()


def test_files_without_lines_get_a_verdict(spark, tmp_path):
    src = S.write_dir(tmp_path / "in", {"stockholm_barometer_1938_1960.txt": S.BARO_1938_1960,
                                        "empty 1.txt": "", "blank.txt": "\n \t\n\n"})
    res = load_pressure(spark, src)
    reasons = {r["file_name"]: r["reason"] for r in res.files.collect()}
    assert reasons == {"stockholm_barometer_1938_1960.txt": None, "empty 1.txt": "EMPTY", "blank.txt": "EMPTY"}
    assert (res.counts["files_seen"], res.counts["files_rejected"]) == (3, 2)


def test_batch_job_leaves_no_staging_and_keeps_the_report(spark, tmp_path):
    before = _staged(spark)
    t = S.write_dir(tmp_path / "t", S.MOCK_TEMPERATURE)
    p = S.write_dir(tmp_path / "p", S.MOCK_PRESSURE)
    load_all(spark, t, p, str(tmp_path / "out"))
    assert _staged(spark) == before
    report = spark.read.parquet(str(tmp_path / "out" / "fileReport" / "airPressure"))
    assert report.filter("reason IS NOT NULL").count() == 6
    ok = S.write_dir(tmp_path / "ok", {"stockholm_barometer_1938_1960.txt": S.BARO_1938_1960})
    with pytest.raises(ValueError):
        load_pressure(spark, ok, str(tmp_path / "out4"), mode="no such mode")
    assert _staged(spark) == before


def test_folder_as_file(spark, tmp_path):
    df = spark.createDataFrame([(x, "stockholm_barometer_1938_1960.txt") for x in S.BARO_1938_1960.split("\n")],
                               "value string, file string")
    df.repartition(3).write.partitionBy("file").text(str(tmp_path / "lines"))
    lines = read_lines(spark, str(tmp_path / "lines"), unit="folder")
    res = load_pressure(spark, lines)
    assert [(r["file_name"], r["reason"]) for r in res.files.collect()] == [("stockholm_barometer_1938_1960.txt", None)]
    assert res.loaded.count() == 23
