"""Schemas of the single files of a Parquet table, read from their footers.

A table's schema as Spark shows it comes from one of its files. The gate looks at
every file: names, types and their order must be those of the rows to be stored.
Footers are read in tasks from files that Spark's own scan hands over, so any file
system Spark reads will do. A file is read once in a table's life: its
layout is kept in a ledger beside the table, by path, length and modification time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from obsgate.sinks.parquet import LOAD_ID, load_path, new_load_id, table_schema
from obsgate.sources.text import plain_path

KEYS = ["file_path", "length", "modified"]
LAYOUT = "file_path string, length long, modified timestamp, layout array<struct<name:string,type:string>>"


def _footer_reader():
    """The task's function, pickled with its code: executors need pyarrow, not this package."""

    def layouts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as arrow
        import pyarrow.parquet as parquet
        from pyspark.sql.pandas.types import from_arrow_schema

        kind = arrow.list_(arrow.struct([("name", arrow.string()), ("type", arrow.string())]))
        for b in batches:
            content, out = b.column(3), []
            for i in range(b.num_rows):
                schema = from_arrow_schema(parquet.read_schema(arrow.py_buffer(content[i].as_buffer())), prefer_timestamp_ntz=True)
                out.append([{"name": f.name, "type": f.dataType.simpleString()} for f in schema.fields])
            yield arrow.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), arrow.array(out, kind)], ["file_path", "length", "modified", "layout"])

    return layouts


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)


def _keys() -> list:
    return [plain_path(F.col("_metadata.file_path")).alias("file_path"), F.col("_metadata.file_size").alias("length"), F.col("_metadata.file_modification_time").alias("modified")]


def footer_layouts(spark: SparkSession, path: str, ledger: str | None = None) -> DataFrame:
    """``(file_path, length, modified, layout)`` of every file below ``path``; those in the ledger are not read again."""
    listed = _files(spark, path).select(*_keys())
    if ledger is None or table_schema(spark, ledger) is None:
        return _files(spark, path).select(*_keys(), "content").mapInArrow(_footer_reader(), LAYOUT)
    known = spark.read.schema(LAYOUT).parquet(ledger).select(*KEYS, "layout").dropDuplicates(KEYS)
    unseen = [r.file_path for r in listed.join(known.select(*KEYS), KEYS, "left_anti").select("file_path").collect()]  # files that no load of ours wrote
    old = listed.join(known, KEYS)
    if not unseen:
        return old
    new = spark.read.format("binaryFile").load(unseen).select(*_keys(), "content").mapInArrow(_footer_reader(), LAYOUT)
    return old.unionByName(new)


def written_layouts(spark: SparkSession, path: str, schema: T.StructType, partition_cols, ledger: str) -> DataFrame:
    """The layout of files below ``path`` that a write of rows of ``schema`` has made (those the ledger lacks), without reading them."""
    layout = F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type")) for f in schema.fields if f.name not in partition_cols])
    listed = _files(spark, path).select(*_keys())
    if table_schema(spark, ledger) is not None:
        listed = listed.join(spark.read.schema(LAYOUT).parquet(ledger).select(*KEYS), KEYS, "left_anti")
    return listed.withColumn("layout", layout)


def remember(layouts: DataFrame, ledger: str) -> None:
    """Keep layouts that the ledger may lack."""
    layouts.write.parquet(load_path(ledger, new_load_id()))


def expected_layout(schema: T.StructType, partition_cols=()) -> list[tuple[str, str]]:
    """Names (lower case) and types, in order, of the columns a file of the table holds."""
    return [(f.name.lower(), f.dataType.simpleString()) for f in schema.fields if f.name not in partition_cols and f.name != LOAD_ID]


def other_files(layouts: DataFrame, schema: T.StructType, partition_cols=()) -> DataFrame:
    """Files whose columns differ in a name (any case), a type or the order, with their columns as text."""
    want = F.lit(", ".join(f"{n} {t}" for n, t in expected_layout(schema, partition_cols)))
    has = F.array_join(F.transform("layout", lambda c: F.concat(F.lower(c["name"]), F.lit(" "), c["type"])), ", ")
    return layouts.select("file_path", has.alias("columns")).filter(F.col("columns") != want)
