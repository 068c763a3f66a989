"""Incremental de-duplication: a digest index per partition before the exact anti-join.

The index of a stored table is a Bloom filter per partition, cut into ``BUCKETS``
bitmaps of 32,768 bits: a row's 64-bit digest picks a bitmap and two of its bits.
Bitmaps of several loads are merged by ``bitmap_or_agg``, so each load
adds its own and never rewrites another's. A row whose bits are not both set is not
stored, for sure. Only the others are compared with stored rows, by their exact encoding.

An index row is at most 4 KB for each partition and bucket; with more than some
4,000 rows a bitmap the filter lets more rows pass, which costs time but no correctness.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from obsgate.functions.rowkey import row_bytes, value_bytes
from obsgate.sinks.parquet import LOAD_ID, load_path, stage, table_schema

BUCKETS = 256
BITS = 32_768


def _digest(schema, cols: Sequence[str]) -> Column:
    return F.xxhash64(row_bytes(schema, list(cols)))


def _partition(schema, partition_cols: Sequence[str]) -> Column:
    return F.xxhash64(F.concat(F.lit("").cast("binary"), *[value_bytes(F.col(f"`{c}`"), schema[c].dataType) for c in partition_cols]))


def _places(digest: Column) -> tuple[Column, Column, Column]:
    """Bucket and two bit numbers of a digest."""
    return (F.pmod(digest, F.lit(BUCKETS)).cast("int"), F.shiftright(digest, 16).bitwiseAND(F.lit(BITS - 1)),
            F.shiftright(digest, 40).bitwiseAND(F.lit(BITS - 1)))


def build_index(rows: DataFrame, cols: Sequence[str], partition_cols: Sequence[str]) -> DataFrame:
    """``(partition, bucket, bitmap)`` of the rows, aggregated map-side."""
    bucket, one, two = _places(F.col("d"))
    keyed = rows.select(_partition(rows.schema, partition_cols).alias("partition"), _digest(rows.schema, cols).alias("d"))
    bits = keyed.select("partition", bucket.alias("bucket"), F.explode(F.array(one, two)).alias("bit"))
    return bits.groupBy("partition", "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def write_index(rows: DataFrame, path: str, load_id: str, cols: Sequence[str], partition_cols: Sequence[str]) -> None:
    """Add one load's bitmaps to the index at ``path``; a load that is run again replaces its own."""
    build_index(rows, cols, partition_cols).write.mode("overwrite").parquet(load_path(path, load_id))


def _bit(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.pmod(F.floor(byte / F.pow(F.lit(2.0), (bit % 8).cast("double"))), F.lit(2)) == 1


def marked(rows: DataFrame, index: DataFrame, cols: Sequence[str], partition_cols: Sequence[str]) -> DataFrame:
    """``rows`` as the struct ``row`` with their digest ``d``, partition and bucket, and whether they ``may_be_stored``."""
    bucket, one, two = _places(F.col("d"))
    keyed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), row_bytes(rows.schema, list(cols)).alias("bytes"),
                        _partition(rows.schema, partition_cols).alias("partition"))
    keyed = keyed.withColumn("d", F.xxhash64("bytes")).withColumns({"bucket": bucket, "one": one, "two": two})
    merged = index.groupBy("partition", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    joined = keyed.join(merged, ["partition", "bucket"], "left")
    may = F.coalesce(_bit(F.col("bitmap"), F.col("one")) & _bit(F.col("bitmap"), F.col("two")), F.lit(False))
    return joined.select("row", "bytes", "d", may.alias("may_be_stored"))


def rows_not_stored(rows: DataFrame, stored: DataFrame, index_path: str, cols: Sequence[str], partition_cols: Sequence[str],
                    load_id: str = "", paths: list[str] | None = None) -> DataFrame:
    """The ``rows`` that ``stored`` does not hold.

    ``index_path`` must cover all of ``stored``; the bitmaps of ``load_id`` itself are left out. The rows are staged with their marks once. The
    few that may be stored go to the stored rows (a broadcast while they are small),
    which are read for the partitions ``stored`` is filtered to and not shuffled.
    """
    spark = rows.sparkSession
    if table_schema(spark, index_path) is None:
        raise ValueError(f"no index at {index_path}")
    index = spark.read.option("basePath", index_path).parquet(index_path).filter(F.col(LOAD_ID).cast("string") != load_id)
    seen = stage(marked(rows, index, cols, partition_cols), "digest-marked", paths)
    maybe = seen.filter("may_be_stored")
    kept = stored.select(row_bytes(stored.schema, list(cols)).alias("b"))
    hits = kept.withColumn("d", F.xxhash64("b")).join(maybe.select("d").distinct(), "d", "left_semi").select("b").distinct()
    new = maybe.join(hits, F.col("bytes") == F.col("b"), "left_anti")
    return seen.filter("NOT may_be_stored").unionByName(new).select("row.*")
