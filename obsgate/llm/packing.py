"""Packing into fixed windows by non-negative least squares (operator 7).

Every document becomes its token ids and an end id. Full windows are cut off
its front; what remains (shorter than a window) goes into a histogram of at most
``window - 1`` lengths, the only thing the driver sees. Shallow combinations
that fill a window exactly (k pieces of one length and one more, k up to
``depth - 1``) are enumerated; their repeat counts solve a non-negative least
squares problem against the histogram (multiplicative updates) and are rounded
so that no length is used more often than it occurs. Residual pieces are packed
greedily: laid end to end and cut at the windows' ends; the last, open window
is cut into sequences of power-of-two lengths, which need no padding.

On Spark: a piece's rank among those of its length, and the residuals' running
sum, are computed over salted groups with a small table of group offsets, so a
length that a third of the documents share is spread over all tasks.

Defined results: null or empty text: one sequence piece with the end id alone.
Repeated rows, also with one doc_id, are packed one by one. Empty table: no
pieces. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from obsgate.llm import common as C
from obsgate.llm.tokens import default_tokenizer, encoder

WINDOW, END_ID, DEPTH = 2048, 1, 8
ENCODED = "doc_id long, doc_tokens long, full_crc array<long>, rem long, rem_crc long, rem_ids binary, width int"
PLACED = "uid long, salt long, rem long, sequence_id long, offset long"
CUT = "uid long, sequence_id long, offset long, skip long, length long, cut boolean"


# --- on the driver: the plan, from a histogram of bounded size


def combinations(lengths: np.ndarray, window: int, depth: int) -> np.ndarray:
    """Rows ``(a, k, c)``: k pieces of length a and one of length c fill the window; a, c among ``lengths``."""
    rows = []
    present = np.zeros(window + 1, bool)
    present[lengths] = True
    for k in range(1, depth):
        a = lengths[lengths * k < window]
        c = window - k * a
        ok = present[c] & ((k > 1) | (a <= c))
        rows.append(np.stack([a[ok], np.full(ok.sum(), k), c[ok]], 1))
    return np.concatenate(rows).astype(np.int64) if rows else np.zeros((0, 3), np.int64)


def solve(combos: np.ndarray, hist: np.ndarray, steps: int = 300) -> np.ndarray:
    """x >= 0 that minimises ``|A x - hist|^2`` (multiplicative updates keep the sign)."""
    a, k, c = combos.T
    target = k * hist[a] + hist[c]
    x = np.minimum(hist[a] / k, hist[c]) / 2 + 1e-9
    for _ in range(steps):
        made = np.bincount(a, k * x, len(hist)) + np.bincount(c, x, len(hist))
        x = x * target / np.maximum(k * made[a] + made[c], 1e-12)
    return x


def rounded(combos: np.ndarray, x: np.ndarray, hist: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole counts that the histogram can supply, and what it has left: floors, then remainders, then what still fits."""
    left = hist.astype(np.int64).copy()
    n = np.zeros(len(combos), np.int64)

    def take(order: np.ndarray, most: np.ndarray) -> None:
        for i in order:
            a, k, c = combos[i]
            got = min(int(most[i]), left[a] // (k + 1)) if a == c else min(int(most[i]), left[a] // k, left[c])
            if got > 0:
                n[i] += got
                left[a] -= k * got
                left[c] -= got

    floor = np.floor(x)
    take(np.argsort(-floor, kind="stable"), floor)
    take(np.argsort(floor - x, kind="stable"), np.ceil(x) - floor)
    take(np.arange(len(combos)), np.full(len(combos), np.iinfo(np.int64).max))
    return n, left


@dataclass
class Plan:
    key: np.ndarray  # length << 40 | first rank, ascending
    until: np.ndarray  # rank after the slot's last
    sequence: np.ndarray  # of the slot's first piece
    offset: np.ndarray
    n_sequences: int
    residual_tokens: int


def make_plan(hist: np.ndarray, window: int = WINDOW, depth: int = DEPTH) -> Plan:
    combos = combinations(np.flatnonzero(hist), window, depth)
    n, left = rounded(combos, solve(combos, hist.astype(float)), hist) if len(combos) else (np.zeros(0, np.int64), hist)
    used = np.zeros(len(hist), np.int64)
    slots, seq = [], 0
    for (a, k, c), m in zip(combos[n > 0], n[n > 0]):
        for j in range(k + 1):
            length = a if j < k else c
            slots.append((int(length) << 40 | int(used[length]), used[length] + m, seq, j * a))
            used[length] += m
        seq += int(m)
    arr = np.array(sorted(slots), np.int64).reshape(-1, 4)
    return Plan(*arr.T, seq, int((left * np.arange(len(left))).sum()))


# --- in tasks


def _encode(batches: Iterator[pa.RecordBatch], path: str, end_id: int, window: int) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    end = np.array([end_id], enc.dtype).tobytes()
    names = [c.split()[0] for c in ENCODED.split(", ")]
    types = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.binary(), pa.int32())
    for part, texts in C.slices(batches):
        rows = []
        for doc, raw in zip(part.column(0).to_pylist(), enc.encode(texts)):
            ids = np.frombuffer(raw + end, enc.dtype)
            full = len(ids) // window * window
            wide, rest = ids.astype("<u4").tobytes(), ids[full:]
            crcs = [zlib.crc32(wide[4 * i : 4 * (i + window)]) for i in range(0, full, window)]
            rows.append((doc, len(ids), crcs, len(rest), zlib.crc32(wide[4 * full :]), rest.tobytes(), enc.dtype.itemsize))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _place(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    """Sequence and offset of each ranked remainder; none where the plan has no slot for it."""
    for b in batches:
        uid, salt, rem, rank = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        i = np.searchsorted(plan.key, (rem << 40) | rank, "right") - 1
        if len(plan.key):
            first, length = plan.key[i] & ((1 << 40) - 1), plan.key[i] >> 40
            ok = (i >= 0) & (length == rem) & (rank < plan.until[i])
            seq, off = plan.sequence[i] + rank - first, plan.offset[i]
        else:
            ok = np.zeros(len(rem), bool)
            seq = off = np.zeros(len(rem), np.int64)
        cols = [pa.array(uid), pa.array(salt), pa.array(rem), pa.array(seq, mask=~ok), pa.array(off, mask=~ok)]
        yield pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in PLACED.split(", ")])


def _cut(batches: Iterator[pa.RecordBatch], first_sequence: int, total: int, window: int) -> Iterator[pa.RecordBatch]:
    """Pieces of the residuals, cut where the windows of their common line end."""
    whole = total // window
    tail = [1 << j for j in range(window.bit_length() - 1, -1, -1) if (total % window) >> j & 1]
    edges = whole * window + np.concatenate([[0], np.cumsum(tail)]).astype(np.int64)
    for b in batches:
        rows = []
        for uid, rem, at in zip(*(b.column(i).to_pylist() for i in range(3))):
            skip = 0
            while skip < rem:
                p = at + skip
                if p < whole * window:
                    seq, lo, hi = p // window, p // window * window, (p // window + 1) * window
                else:
                    j = int(np.searchsorted(edges, p, "right")) - 1
                    seq, lo, hi = whole + j, int(edges[j]), int(edges[j + 1])
                n = min(rem - skip, hi - p)
                rows.append((uid, first_sequence + seq, p - lo, skip, n, n < rem))
                skip += n
        types = (*[pa.int64()] * 5, pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, types)], [c.split()[0] for c in CUT.split(", ")])


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        cols = b.to_pydict()
        crc = [zlib.crc32(np.frombuffer(x, f"<u{w}")[s : s + n].astype("<u4").tobytes()) for x, w, s, n in zip(cols["rem_ids"], cols["width"], cols["skip"], cols["length"])]
        keep = [b.column(b.schema.get_field_index(c)) for c in ("doc_id", "start", "length")]
        rest = [b.column(b.schema.get_field_index(c)) for c in ("doc_tokens", "sequence_id", "offset")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(crc, pa.int64()), *rest], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])


# --- as Spark jobs


def _running(df: DataFrame, value: str, group: list[str]) -> DataFrame:
    """``before``: sum of ``value`` over the rows that precede in (group, salt, uid); each salt is summed by itself."""
    own = W.partitionBy(*group, "salt").orderBy("uid").rowsBetween(W.unboundedPreceding, -1)
    totals = df.groupBy(*group, "salt").agg(F.sum(value).alias("n"))
    salts = (W.partitionBy(*group) if group else W).orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    base = totals.select(*group, "salt", F.coalesce(F.sum("n").over(salts), F.lit(0)).alias("base"))
    out = df.withColumn("own", F.coalesce(F.sum(value).over(own), F.lit(0)))
    return out.join(base, [*group, "salt"]).withColumn("before", F.col("base") + F.col("own")).drop("base", "own")


def pack(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = END_ID, window: int = WINDOW, depth: int = DEPTH) -> DataFrame:
    """One row per piece: where it stands in its document and in its sequence."""
    tok = tokenizer or default_tokenizer()
    encoded = C.documents(df, id_col, text_col).mapInArrow(lambda it: _encode(it, tok, end_id, window), ENCODED)
    docs = C.stage(encoded.withColumn("uid", F.monotonically_increasing_id()), "packing-ids")
    salts = C.n_partitions(df, docs.count(), 1_000_000)
    slim = docs.select("uid", "doc_id", "doc_tokens", "rem", "rem_crc", "full_crc", F.pmod(F.xxhash64("uid"), F.lit(salts)).alias("salt"))
    rems = slim.filter("rem > 0").select("uid", "salt", "rem", F.lit(1).cast("long").alias("one"))
    hist = np.zeros(window + 1, np.int64)
    for r in rems.groupBy("rem").count().collect():  # at most window - 1 rows
        hist[r["rem"]] = r["count"]
    plan = make_plan(hist, window, depth)
    ranked = _running(rems, "one", ["rem"]).select("uid", "salt", "rem", "before")
    placed = C.stage(ranked.mapInArrow(lambda it: _place(it, plan), PLACED), "packing-placed")
    line = _running(placed.filter("sequence_id IS NULL").select("uid", "salt", "rem"), "rem", []).select("uid", "rem", "before")
    total, after = plan.residual_tokens, plan.n_sequences
    cut = line.mapInArrow(lambda it: _cut(it, after, total, window), CUT)
    in_slots = placed.filter("sequence_id IS NOT NULL").select("uid", "sequence_id", "offset", F.lit(0).cast("long").alias("skip"), F.col("rem").alias("length"), F.lit(False).alias("cut"))
    pieces = C.stage(in_slots.unionByName(cut), "packing-pieces")

    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    start = (F.col("doc_tokens") - F.col("rem") + F.col("skip")).alias("start")
    uncut = pieces.filter("NOT cut").join(slim.drop("full_crc", "salt"), "uid").withColumn("start", start).withColumn("ids_crc32", F.col("rem_crc")).select(out)
    with_ids = docs.select("uid", "doc_id", "doc_tokens", "rem", "rem_ids", "width")
    in_parts = pieces.filter("cut").join(with_ids, "uid").withColumn("start", start).drop("uid", "cut", "rem").mapInArrow(_crc, ", ".join(f"{c} long" for c in out))
    after += total // window + bin(total % window).count("1")
    full = slim.filter(F.size("full_crc") > 0).select("uid", "salt", "doc_id", "doc_tokens", "full_crc", F.size("full_crc").cast("long").alias("n_full"))
    full = _running(full, "n_full", []).select("doc_id", "doc_tokens", "before", F.posexplode("full_crc").alias("k", "ids_crc32"))
    full = full.select("doc_id", (F.col("k") * F.lit(window)).cast("long").alias("start"), F.lit(window).cast("long").alias("length"), "ids_crc32", "doc_tokens", (F.lit(after) + F.col("before") + F.col("k")).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return uncut.unionByName(in_parts).unionByName(full)
