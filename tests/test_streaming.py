import pytest

from obsgate.streaming import start_ingest
from tests import sample_files as S


def test_incremental_pressure_ingest(spark, tmp_path):
    src = tmp_path / "in"
    S.write_dir(src, {"stockholm_barometer_1938_1960.txt": S.BARO_1938_1960})
    out, q, st, ck = (str(tmp_path / n) for n in ("out", "q", "status", "ck"))

    def run():
        query = start_ingest(spark, "pressure", str(src), out, quarantine=q, status=st, checkpoint=ck)
        query.awaitTermination(300)
        assert query.exception() is None

    run()
    first = spark.read.parquet(out)
    assert first.count() == 23
    assert {r["batch_id"] for r in first.select("batch_id").distinct().collect()} == {0}

    # A new file arrives: only it is processed by the next run.
    S.write_dir(src, {"stockholm_barometer_1862_1937.txt": S.BARO_1862_1937})
    run()
    status = {r["batch_id"]: r for r in spark.read.parquet(st).collect()}
    assert status[1]["files_seen"] == 1 and status[1]["rows_quarantined"] == 1
    assert status[1]["loaded"] is False  # 1862_1937 sample covers one year only
    assert spark.read.parquet(out).count() == 23
    assert spark.read.parquet(q).count() == 1


def test_incremental_temperature_ingest(spark, tmp_path):
    src = tmp_path / "in"
    S.write_dir(src, S.MOCK_TEMPERATURE)
    out = str(tmp_path / "out")
    query = start_ingest(spark, "temperature", str(src), out, checkpoint=str(tmp_path / "ck"))
    query.awaitTermination(300)
    assert query.exception() is None
    table = spark.read.parquet(out)
    assert table.count() == 5
    assert {r["PUBLISHED_CATEGORY"] for r in table.collect()} == {"AUTOMATIC_STN"}


def test_table_does_not_depend_on_the_batches(spark, tmp_path):
    src = tmp_path / "in"
    S.write_dir(src, {"stockholm_barometer_1938_1960.txt": S.BARO_1938_1960})
    # The same rows again, with one more, under a name of its own.
    text = S.BARO_1938_1960 + "\n1940\t12\t30\t1000.1\t1000.2\t1000.3"
    S.write_dir(src, {"copy_barometer_1938_1960.txt": text})
    ranges = {n: "1938_1960" for n in ("stockholm_barometer_1938_1960.txt", "copy_barometer_1938_1960.txt")}
    tables = []
    for n in (1, 10):
        out = str(tmp_path / f"out{n}")
        q = start_ingest(spark, "pressure", str(src), out, checkpoint=str(tmp_path / f"ck{n}"), max_files_per_trigger=n,
                         ranges=ranges)
        q.awaitTermination(300)
        assert q.exception() is None
        tables.append(sorted(map(tuple, spark.read.parquet(out).drop("batch_id").select(
            "YEAR", "MONTH", "DAY", "OBSERVATION1").collect())))
    assert tables[0] == tables[1] and len(tables[0]) == 24


def test_refused_batch_stops_the_stream(spark, tmp_path):
    src = tmp_path / "in"
    name = "stockholmA_daily_temp_obs_2013_2017_t1t2t3txtntm.txt"
    S.write_dir(src, {name: S.TEMP_A_2013_2017_UNIT + "\n" + S.daily(2013, 1, 99)})
    ck, out = str(tmp_path / "ck"), str(tmp_path / "out")
    q = start_ingest(spark, "temperature", str(src), out, checkpoint=ck)
    with pytest.raises(Exception, match="refused"):
        q.awaitTermination(300)
    S.write_dir(src, {name: S.TEMP_A_2013_2017_UNIT})  # mended: the same checkpoint takes it
    q = start_ingest(spark, "temperature", str(src), out, checkpoint=ck)
    q.awaitTermination(300)
    assert spark.read.parquet(out).count() == 5
    with pytest.raises(ValueError):
        start_ingest(spark, "temperature", str(src), out, checkpoint=ck, legacy_mandatory_null=True)
