"""File listings as DataFrames, and the ledger of files that loads have seen.

A listing comes from Spark's own file scan (path, size, modification time; no
content is read) and never passes through Python. Scans leave out files of no
bytes; those are told from the scan's list of input files, which the driver's JVM holds anyway.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from obsgate.sinks.parquet import LOAD_ID, load_path, table_schema
from obsgate.sources.text import UNITS, file_unit, plain_path

LISTED = ["file_path", "file_name", "length", "modified"]
EMPTY, REPEATED = "EMPTY", "REPEATED"


def _scan(spark: SparkSession, fmt: str, paths: str | Sequence[str], recursive: bool) -> DataFrame:
    reader = spark.read.format(fmt)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load([paths] if isinstance(paths, str) else list(paths))


def list_files(spark: SparkSession, paths: str | Sequence[str], *, recursive: bool = False, unit: str = "file") -> DataFrame:
    """``(file_path, file_name, length, modified)`` of every file under ``paths``, those of no bytes included.

    ``unit="folder"``: of every folder of part files, their sizes summed up, the time of the youngest.
    Paths are written as in :func:`obsgate.sources.text.read_lines`.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    meta = [F.col(f"_metadata.{c}").alias(a) for c, a in (("file_path", "path"), ("file_size", "length"), ("file_modification_time", "modified"))]
    filled = _scan(spark, "binaryFile", paths, recursive).select(*meta)
    names = Column(spark._jvm.org.apache.spark.sql.functions.lit(_scan(spark, "text", paths, recursive)._jdf.inputFiles()))
    every = spark.range(1).select(F.explode(names).alias("path"))
    void = every.join(filled.select(plain_path(F.col("path")).alias("__path")), plain_path(F.col("path")) == F.col("__path"), "left_anti")
    void = void.select("path", F.lit(0).cast("long").alias("length"), F.lit(None).cast("timestamp").alias("modified"))
    listed = filled.unionByName(void)
    path, name = file_unit(plain_path(F.col("path")), unit)
    listed = listed.select(path.alias("file_path"), name.alias("file_name"), "length", "modified")
    if unit == "folder":
        listed = listed.groupBy("file_path", "file_name").agg(F.sum("length").alias("length"), F.max("modified").alias("modified"))
    return listed.select(*LISTED)


def fingerprint() -> dict[str, Column]:
    """Aggregates over a listing that change when a file does, comes or goes."""
    own = F.xxhash64("file_path", "length", "modified").cast("decimal(38,0)")
    return {"n_files": F.count(F.lit(1)), "digest": F.coalesce(F.sum(own), F.lit(0)).cast("string")}


# --- the ledger


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """All loads' files: path, name, length, modification time, verdict, rows, whether loaded. None before the first load."""
    return None if table_schema(spark, path) is None else spark.read.option("basePath", path).parquet(path)


def record_files(files: DataFrame, path: str, load_id: str, loaded: bool) -> None:
    """Put one load's verdicts into the ledger; a load that is run again replaces its own."""
    rows = files.select(*LISTED, "reason", "n_rows", (F.lit(loaded) & F.col("reason").isNull()).alias("loaded"))
    rows.write.mode("overwrite").parquet(load_path(path, load_id))


def repeated_files(listing: DataFrame, ledger: DataFrame | None, load_id: str) -> DataFrame | None:
    """The listed files that another load has loaded and that have not changed since."""
    if ledger is None:
        return None
    done = ledger.filter(F.col("loaded") & (F.col(LOAD_ID).cast("string") != load_id))
    keys = ["file_path", "length", "modified"]
    return listing.join(done.select(*keys).distinct(), keys, "left_semi")
