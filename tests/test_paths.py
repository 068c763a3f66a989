"""Paths and names of observation files, which every line of a load carries."""

import pytest
from pyspark.sql import functions as F

from obsgate.sources.text import file_unit, plain_path, read_lines

PATHS = [  # path, its last part, its folder, what names the folder, the path with one slash after the scheme
    ("file:///a/b/c=d.txt/part-0", "part-0", "file:///a/b/c=d.txt", "d.txt", "file:/a/b/c=d.txt/part-0"),
    ("file:////a//b//c", "c", "file:////a//b/", "", "file:/a//b//c"),
    ("hdfs://host/a/b%20c+d/x%2By+z", "x+y+z", "hdfs://host/a/b%20c+d", "b c+d", "hdfs://host/a/b%20c+d/x%2By+z"),
    ("s3a:///b/k=v=w/p", "p", "s3a:///b/k=v=w", "w", "s3a:/b/k=v=w/p"),
    ("x:/y:///z/k=/p", "p", "x:/y:///z/k=", "", "x:/y:///z/k=/p"),
    ("a b:///%C3%A9/y", "y", "a b:///%C3%A9", "é", "a b:///%C3%A9/y"),
    ("/abc", "abc", "", "", "/abc"),
    ("abc", "abc", "", "", "abc"),
    ("a/b/", "", "", "", "a/b/"),
    ("", "", "", "", ""),
    (None, None, None, None, None),
]


def test_file_units(spark):
    df = spark.createDataFrame([(i, p[0]) for i, p in enumerate(PATHS)], "i int, path string")
    path = F.col("path")
    got = df.select(file_unit(path, "file")[1], *file_unit(path, "folder"), plain_path(path)).orderBy("i")
    assert [tuple(r) for r in got.collect()] == [p[1:] for p in PATHS]


@pytest.mark.parametrize("unit", ["file", "folder"])
def test_lines_take_no_regular_expression_over_their_path(spark, tmp_path, unit):
    (tmp_path / "file=a%20b.txt").mkdir()
    (tmp_path / "file=a%20b.txt" / "part-0").write_text("1\n2\n")
    lines = read_lines(spark, str(tmp_path) if unit == "folder" else f"{tmp_path}/*", unit=unit)
    assert "regexp" not in lines._jdf.queryExecution().analyzed().toString()
    assert sorted(r.value for r in lines.collect()) == ["1", "2"]


def test_tokens_are_typed_once(lines_of):
    from obsgate.operators.parse import parse_lines
    from obsgate.sources.registry import TEMPERATURE

    parsed = parse_lines(lines_of({"a.txt": "2017\t1\t2\t1.0\t2.0\tx\t4.0\t5.0\t6.0"}), TEMPERATURE)
    assert parsed._jdf.queryExecution().analyzed().toString().count("RLIKE") == 4  # year, month, day; the line itself
    assert [r["_error_class"] for r in parsed.collect()] == ["TYPE"]
