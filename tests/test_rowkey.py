"""Row encoding: equal bytes for equal rows only, bytes in the rows' order."""

import datetime as dt
import decimal
import math
import struct

import pytest
from pyspark.sql import functions as F

from obsgate.functions.rowkey import double_bits, row_bytes, value_bytes
from obsgate.operators.validate import duplicate_rows

D = decimal.Decimal
VALUES = {
    "int": [None, -(2**31), -1, 0, 1, 2**31 - 1],
    "bigint": [None, -(2**63), -(2**32), -1, 0, 1, 2**32, 2**63 - 1],
    "double": [None, -math.inf, -1.7976931348623157e308, -2.0, -1.0000000000000002, -1.0, -2.2250738585072014e-308, -5e-324, 0.0, 5e-324, 1e-310,
               2.2250738585072014e-308, 0.1, 0.5, 0.9999999999999999, 1.0, 1.0000000000000002, 1.9999999999999998, 2.0, 3.0, 1e300, 1.7976931348623157e308, math.inf, math.nan],
    "float": [None, -1.5, 0.0, 1.401298464324817e-45, 0.25, 3.0, math.nan],
    "string": [None, "", "\x00", "\x00\x00", "\x00\x01", "\x01", "a", "a\x00", "a\x00b", "ab", "b", "é", "中", "🙂"],
    "boolean": [None, False, True],
    "date": [None, dt.date(1, 1, 1), dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(2024, 2, 29)],
    "timestamp_ntz": [None, dt.datetime(1756, 1, 1, 0, 0, 0, 1), dt.datetime(2021, 3, 28, 2, 30), dt.datetime(2021, 3, 28, 2, 30, 0, 1), dt.datetime(2021, 3, 28, 3, 30), dt.datetime(2021, 3, 28, 23, 59, 59, 999999)],
    "timestamp": [None, dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(2021, 3, 28, 2, 30), dt.datetime(2021, 3, 28, 2, 30, 0, 1)],
    "decimal(20,9)": [None, D("-99999999999.999999999"), D("-1"), D("-0.000000001"), D("0"), D("0.000000001"), D("0.1"), D("1"), D("99999999999.999999999")],
    "decimal(38,0)": [None, D("7")],
    "binary": [None, b"", b"\x00", b"\x00\x01", b"\x01", b"\xff"],
    "array<int>": [None, [], [None], [-1], [-1, 2], [0], [1]],
    "array<string>": [None, [], [None], [""], ["", ""], ["a"], ["a", "b"], ["ab"]],
}


@pytest.mark.parametrize("kind", VALUES)
def test_bytes_follow_the_order(spark, kind):
    values = VALUES[kind]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").repartition(2)
    for zone in ("UTC", "Europe/Stockholm"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        got = [r.b for r in df.select("i", value_bytes(F.col("v"), df.schema["v"].dataType).alias("b")).orderBy("i").collect()]
        assert len(set(got)) == len(values) and [bytes(b) for b in got] == sorted(map(bytes, got))
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_double_bits_are_exact(spark):
    import random

    rng = random.Random(3)
    xs = [abs(struct.unpack("<d", rng.randbytes(8))[0]) for _ in range(4000)]
    xs += [2.0**e for e in range(-1074, 1024)] + [math.nextafter(2.0**e, 0) for e in range(-1073, 1024)] + [math.nextafter(2.0**e, math.inf) for e in range(-1074, 1023)]
    xs = [x for x in xs if math.isfinite(x)]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", double_bits(F.col("x")).alias("b")).collect()
    assert all(r.b == struct.unpack("<q", struct.pack("<d", r.x))[0] for r in got) and len(got) == len(xs)


def test_equal_rows_and_fields_that_run_together(spark):
    rows = [("a", "bc", -0.0, {"x": 1, "y": 2}, (1, None)), ("a", "bc", 0.0, {"y": 2, "x": 1}, (1, None)), ("ab", "c", 0.0, {"x": 1, "y": 2}, (1, None)),
            (None, "", 0.0, {"x": 1, "y": 2}, (1, None)), ("", None, 0.0, {"x": 1, "y": 2}, (1, None)), ("a", "bc", 0.0, {"x": 1}, (None, 1)), ("a", "bc", 0.0, None, None)]
    df = spark.createDataFrame(rows, "a string, b string, c double, m map<string,int>, s struct<p:int,q:int>")
    got = [bytes(r.b) for r in df.select(row_bytes(df.schema).alias("b")).collect()]
    assert got[0] == got[1] and len(set(got)) == len(rows) - 1


def test_microseconds_apart_are_no_duplicates(spark):
    rows = [(dt.datetime(2020, 1, 1, 0, 0, 0, 123001), dt.datetime(2020, 1, 1, 0, 0, 0, 5), 1.0), (dt.datetime(2020, 1, 1, 0, 0, 0, 123002), dt.datetime(2020, 1, 1, 0, 0, 0, 5), 1.0),
            (dt.datetime(2020, 1, 1, 0, 0, 0, 123001), dt.datetime(2020, 1, 1, 0, 0, 0, 6), 1.0)]
    df = spark.createDataFrame(rows, "a timestamp, b timestamp_ntz, c double")
    assert duplicate_rows(df).collect() == []
    twice = duplicate_rows(df.union(df.limit(1)).withColumnRenamed("c", "__n"), count_col="n").collect()
    assert [tuple(r) for r in twice] == [(*rows[0], 2)]


def test_rows_that_share_a_hash_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    df = spark.createDataFrame([(1, "a"), (2, "a"), (1, "a"), (None, "a"), (None, "a")], "x int, y string")
    assert sorted(map(tuple, duplicate_rows(df).collect()), key=str) == [(1, "a", 2), (None, "a", 2)]
