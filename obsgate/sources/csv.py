"""The CSV data source as a second reader of observation files.

Explicit schema, corrupt-record column, permissive mode: what the original
loader used. All columns are always read, so pruning can't hide a corrupt
row (the source parses pruned columns only). Against the parse of lines
(:mod:`obsgate.operators.parse`, policy ``partial``) rows are equal for every
kind of defect; the source doesn't tell arity from type errors, so it has no
error class and no ``null_row`` policy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from obsgate.operators.parse import CORRUPT
from obsgate.sources.registry import Layout
from obsgate.sources.text import UNITS, file_unit, plain_path


def read_typed(spark: SparkSession, paths: str | Sequence[str], layout: Layout, *, unit: str = "file", delimiter: str = "\t") -> DataFrame:
    """``(file_path, file_name, <layout columns>, _corrupt_record)`` of every line that isn't blank."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    schema = T.StructType([*layout.schema().fields, T.StructField(CORRUPT, T.StringType())])
    rows = (spark.read.schema(schema).option("sep", delimiter).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .csv([paths] if isinstance(paths, str) else list(paths)))
    path, name = file_unit(F.col("_metadata.file_path"), unit)
    # a Generate in between: later projections can't prune the scan's columns
    whole = F.inline(F.array(F.struct(*[F.col(f"`{c}`").alias(c) for c in schema.names])))
    return rows.select(plain_path(path).alias("file_path"), name.alias("file_name"), whole)
