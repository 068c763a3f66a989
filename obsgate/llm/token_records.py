"""Token ids as length-delimited binary records with an offset index (operator 10).

Documents are dealt out by ranges of ``(doc_id, hash of the text)`` and sorted,
so file ``part-i`` holds the i-th run of documents in ascending order. A record::

    u64 length | u32 masked crc32 of those 8 bytes | payload | u32 masked crc32 of payload | newline
    payload: i64 doc_id | u8 1 if doc_id is null | u8 bytes per id | ids, little-endian

(mask: rotate right by 15, add 0xa282ead8). Files are written by Spark's text
sink, whose line end is the record's last byte; they thus reach any file system
Spark writes to, under its commit protocol: a lost executor's attempt leaves
nothing behind. Readers go by the lengths, newlines inside a payload don't matter.

The index, a Parquet table beside the data, has one row per record: file number,
byte offset and length, tokens and tokens before it in the file. It is made by
reading the files back and checking every checksum. ``read_shuffled`` cuts
records out of the files at the index's offsets in any order asked for.

Defined results: null text: empty (only the end id). Repeated rows: each has its
own record; ties in ``doc_id`` go by the text's hash. Null ``doc_id``: first. Empty
table: no records. Extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from obsgate.llm import common as C
from obsgate.llm.tokens import default_tokenizer, encoder

SHARD_BYTES = 24 << 20  # of text; its ids take less
_HEAD, _CRC, _DOC = struct.Struct("<QI"), struct.Struct("<I"), struct.Struct("<qBB")
INDEX = "part long, doc_id long, byte_offset long, byte_length long, n_tokens long, local_start long, ids_crc32 long"


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """One record without its line end."""
    n = struct.pack("<Q", len(payload))
    return n + _CRC.pack(masked(n)) + payload + _CRC.pack(masked(payload))


def unframe(data: bytes, at: int) -> tuple[bytes, int]:
    """The payload of the record at byte ``at``, and where the next one begins; raises on a bad checksum."""
    n, crc = _HEAD.unpack_from(data, at)
    if masked(data[at : at + 8]) != crc:
        raise ValueError(f"bad length checksum at byte {at}")
    lo = at + _HEAD.size
    payload = data[lo : lo + n]
    if len(payload) != n or masked(payload) != _CRC.unpack_from(data, lo + n)[0]:
        raise ValueError(f"bad payload checksum at byte {at}")
    return payload, lo + n + _CRC.size + 1


def decode(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc, null, width = _DOC.unpack_from(payload)
    return (None if null else doc), np.frombuffer(payload, f"<u{width}", offset=_DOC.size)


def _frames(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    end = np.array([end_id], enc.dtype).tobytes()
    for part, texts in C.slices(batches):
        ids = part.column(0).to_pylist()
        rows = [frame(_DOC.pack(d or 0, d is None, enc.dtype.itemsize) + x + end) for d, x in zip(ids, enc.encode(texts))]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["value"])


def write_records(df: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = 0, shard_bytes: int = SHARD_BYTES) -> None:
    """Write ``path/data`` (records in ascending ``doc_id`` order) and ``path/index``."""
    docs, tok = C.documents(df, id_col, text_col), tokenizer or default_tokenizer()
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    keyed = docs.withColumn("tie", F.xxhash64("text"))
    n = C.n_partitions(df, size, shard_bytes)
    dealt = keyed.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    framed = dealt.mapInArrow(lambda it: _frames(it, tok, end_id), "value binary")
    framed.select(F.col("value").cast("string")).write.text(f"{path}/data")
    spark = df.sparkSession
    files(spark, path).mapInArrow(_index, INDEX).write.parquet(f"{path}/index")


def files(spark: SparkSession, path: str) -> DataFrame:
    """``(part, content)`` of the data files, in no order."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/data")
    return raw.select(F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("long").alias("part"), "content")


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in INDEX.split(", ")]
    for b in batches:
        for i in range(b.num_rows):
            part, data = b.column(0)[i].as_py(), b.column(1)[i].as_py()
            rows, at, start = [], 0, 0
            while at < len(data):
                payload, nxt = unframe(data, at)
                doc, ids = decode(payload)
                rows.append((part, doc, at, nxt - at, len(ids), start, zlib.crc32(ids.astype("<u4").tobytes())))
                at, start = nxt, start + len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * len(names))], names)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The index with ``start``: ids of all documents before each one. The prefix sum runs over one row per file."""
    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    base = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = base.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return index.join(base, "part").withColumn("start", F.col("base") + F.col("local_start"))


def read_shuffled(spark: SparkSession, path: str, order: DataFrame) -> DataFrame:
    """``(position, doc_id, ids)`` of the records asked for in ``order(doc_id, position)``, cut out at the index's offsets."""
    at = spark.read.schema(INDEX).parquet(f"{path}/index").join(order, "doc_id").groupBy("part").agg(F.collect_list(F.struct("position", "byte_offset")).alias("want"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                got = [(w["position"], *decode(unframe(r["content"], w["byte_offset"])[0])) for w in r["want"]]
                yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64()), pa.array([g[2].astype(np.int64) for g in got], pa.list_(pa.int64()))], ["position", "doc_id", "ids"])

    return files(spark, path).join(at, "part").select("content", "want").mapInArrow(cut, "position long, doc_id long, ids array<long>").orderBy("position")


def token_records(df: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the records (under the shared folder unless ``path`` is given) and return the index read back from them."""
    spark = df.sparkSession
    path = path or C.scratch_path(spark, "token-records")
    write_records(df, path, **options)
    return read_index(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32", "part", "byte_offset", "byte_length")
