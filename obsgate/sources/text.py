"""Line sources: header-less text files, or lines derived from a table.

A directory of observation files is read with ONE scan of a Hadoop path or
glob (works for HDFS/S3/local alike), carrying the file name from the hidden
``_metadata`` column; no driver-side listing loop. Files are split by Spark
into byte ranges, so one huge file is still read in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from obsgate.functions.tokens import is_manual_station
from obsgate.sources.registry import AUTOMATIC_STATION_PREFIX

UNITS = ("file", "folder")


def read_lines(spark: SparkSession, paths: str | Sequence[str], *, recursive: bool = False,
               unit: str = "file") -> DataFrame:
    """``(value, file_name, file_path)`` for every line of every file under ``paths``.

    Subdirectories are skipped unless ``recursive`` (the original loader
    skipped them too). ``unit="folder"``: an observation file is a folder of
    part files (as Spark writes one); its name is the folder's, or what
    follows ``=`` in a ``key=name`` folder. Path and name are derived for every
    line, so without regular expressions over the path (their search for its
    last part took most of a load's time).
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    reader = spark.read.format("text")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if isinstance(paths, str):
        paths = [paths]
    df = reader.load(list(paths))
    path, name = file_unit(F.col("_metadata.file_path"), unit)
    return df.select("value", name.alias("file_name"), plain_path(path).alias("file_path"))


def file_unit(path: Column, unit: str) -> tuple[Column, Column]:
    """Path and (URL-decoded) name of the observation file that a scanned file is or belongs to."""
    last = F.substring_index(path, "/", -1)
    if unit == "folder":
        # nothing before a last part that is empty or all there is
        folder = F.when((last == "") | (last == path), F.lit("")).otherwise(F.left(path, F.length(path) - F.length(last) - 1))
        return folder, _decoded(F.substring_index(F.substring_index(folder, "/", -1), "=", -1))
    return path, _decoded(last)


def plain_path(path: Column) -> Column:
    """``file:///x`` and ``file:/x`` are one file."""
    scheme = F.substring_index(path, ":///", 1)
    rest = F.ltrim(F.substring(path, F.length(scheme) + 2, F.length(path)), F.lit("/"))
    return F.when(F.contains(path, F.lit(":///")) & scheme.rlike(r"^[A-Za-z0-9+.-]+\z"), F.concat(scheme, F.lit(":/"), rest)).otherwise(path)


def file_name_column() -> Column:
    """The source file's name from ``_metadata``, URL-decoded.

    The metadata name is URL-encoded ("a%20b.txt"); registry lookups and year
    parsing need the real name. ``url_decode`` is form decoding, so a literal
    '+' is protected first. The (encoded) path stays the file's identity.
    """
    return _decoded(F.col("_metadata.file_name"))


def _decoded(name: Column) -> Column:
    return F.when(F.contains(name, F.lit("%")), F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))).otherwise(name)


def with_file_path(df: DataFrame) -> DataFrame:
    """Lines without a ``file_path`` (e.g. rendered from a table) use the name as path."""
    return df if "file_path" in df.columns else df.withColumn("file_path", F.col("file_name"))


def with_provenance(df: DataFrame, file_col: str = "file_name", out: str = "ISMANUAL",
                    automatic_prefix: str = AUTOMATIC_STATION_PREFIX) -> DataFrame:
    """Add the manual-station flag derived from the file name."""
    return df.withColumn(out, is_manual_station(F.col(file_col), automatic_prefix))
