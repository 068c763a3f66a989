"""Helpers shared by the training-data operators.

Words are the maximal runs of ``[^\\x20\\x09-\\x0D]``; on UTF-8 bytes that is
exactly what ``bytes.split()`` without arguments yields.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from obsgate.sinks.parquet import remove_paths, shared_dir

# Odd multipliers of the window hashes, derived from one rule (any odd 64-bit values do).
_M = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
SLICE_CHARS, SLICE_ROWS = 1_500_000, 60_000


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder all executors share (``spark.checkpoint.dir``)."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once under the shared folder and read back: cuts lineage, survives lost executors.

    The write's shuffle files are removed when it is done, the staged copy replaces them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


@cache
def lean() -> None:
    """In a Python worker: large buffers go back to the system when freed. Workers stay for later stages, and
    would keep what an earlier one took."""
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        ctypes.CDLL(None).mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD, which stops growing once set
    except (AttributeError, OSError):  # another C library
        pass


def release(*staged: DataFrame) -> None:
    """Delete staged copies that no later plan reads."""
    for df in staged:
        remove_paths(df.sparkSession, [df.staged_path])


def n_partitions(df: DataFrame, items: int, per_task: int) -> int:
    """Partitions for ``items`` units of work at ``per_task`` each, at least the session's setting."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-items // per_task))


def documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, text)`` of a table whose further columns, whatever their names, are left out."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def slices(batches: Iterator[pa.RecordBatch], text_col: str = "text", max_chars: int = SLICE_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut Arrow batches into runs of whole rows of about ``max_chars``, with texts (null: empty)."""
    lean()
    for b in batches:
        col = b.column(b.schema.get_field_index(text_col))
        size = np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < b.num_rows:
            base = size[lo - 1] if lo else 0
            hi = min(max(lo + 1, int(np.searchsorted(size, base + max_chars, "right"))), lo + SLICE_ROWS)
            yield b.slice(lo, hi - lo), [t or "" for t in col.slice(lo, hi - lo).to_pylist()]
            lo = hi


def words(text: str, lower: bool = False) -> list[bytes]:
    """Words of a text as UTF-8; ``lower`` lower-cases A-Z only."""
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def word_hashes(word_lists: Sequence[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of all documents, and the documents' offsets."""
    offsets = np.zeros(len(word_lists) + 1, np.int64)
    np.cumsum([len(w) for w in word_lists], out=offsets[1:])
    flat = (xxh3_64_intdigest(w) for ws in word_lists for w in ws)
    return np.fromiter(flat, np.uint64, int(offsets[-1])), offsets


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise a 64-bit hash so that its high bits are uniform."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(_M[1])
        h = (h ^ (h >> np.uint64(27))) * np.uint64(_M[2])
        return h ^ (h >> np.uint64(31))


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each position on (windows may cross documents; mask them)."""
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, np.uint64)
    c = 1
    with np.errstate(over="ignore"):
        for j in range(k):
            c = (c * _M[0]) & (2**64 - 1)
            out += hashes[j : j + n] * np.uint64(c | 1)
    return mix(out)


def window_starts(offsets: np.ndarray, k: int) -> np.ndarray:
    """Positions at which a window of ``k`` words lies within one document."""
    total = int(offsets[-1])
    ok = np.ones(total, bool)
    for j in range(1, k):
        end = offsets[1:] - j
        ok[end[end >= offsets[:-1]]] = False
    return np.flatnonzero(ok)


def doc_of(offsets: np.ndarray) -> np.ndarray:
    """Index of the document of each position."""
    return np.repeat(np.arange(len(offsets) - 1, dtype=np.int64), np.diff(offsets))
