"""Substring deduplication by seed and extend (operator 9).

A word goes if a window of ``window`` (20) words covers it whose word sequence
also starts earlier: in a smaller ``doc_id``, or in the same document before.

* Seeds: of every window, winnowing keeps its smallest ``seed``-word hash (12
  words, leftmost on ties). Equal windows keep the same anchor, so a repeat of at
  least ``window`` words holds an anchor that occurs again. Documents are joined
  on the anchors' hashes.
* Extension: a repeated anchor is extended both ways, to the windows that hold
  it on either side; windows are joined on their 64-bit hash, and all but the
  first place of each are repeats. Runs of such windows unite to the maximal
  repeats over the threshold, whose words are taken out.

Scale: both joins move packed postings, one row per slice of documents and hash
range. A slice settles what it sees twice itself and posts each hash once, so a
passage that a third of all documents share arrives once per slice, not once
per document. Hash ranges are as many as keep each at a few million postings.
Texts are read three times instead of being shuffled word by word.

Rows are told apart by a 64-bit key of ``doc_id`` and text; the id itself only orders them.

Defined results: null or empty text: no words. Repeated rows (id and text) are one document: of them neither is
earlier. Rows that share an id but not the text are documents of their own, in order of their keys. A null ``doc_id``
counts as larger than any other. Empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsgate.llm import common as C
from obsgate.llm import fragments as P

WINDOW, SEED = 20, 12
PER_FRAGMENT = 2_000_000
LAST = 2**63 - 1
KNOWN = 0xFFFF  # over a slice's rows; posted for a hash that its slice has settled
ROWS = "frag int, key long, places binary, hashes binary, docs binary, at binary, ids binary, keys binary"
OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string, n_repeats long"
_TYPES = (pa.int32(), pa.int64(), *[pa.binary()] * 6)
_NAMES = [c.split()[0] for c in ROWS.split(", ")]


def anchors(hashes: np.ndarray, offsets: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the winnowed ``seed``-word anchors of all documents."""
    starts = C.window_starts(offsets, window)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    grams = C.window_hashes(hashes, seed)
    best, at = grams[starts], np.zeros(len(starts), np.int64)
    for j in range(1, window - seed + 1):
        h = grams[starts + j]
        less = h < best
        best = np.where(less, h, best)
        at[less] = j
    places = np.unique(starts + at)
    return places, grams[places]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(_NAMES), _TYPES)], _NAMES)


def _per_doc(keys: np.ndarray, doc: np.ndarray, place: np.ndarray) -> list[tuple]:
    """A row per document with its places."""
    if not len(doc):
        return []
    o = np.argsort(doc, kind="stable")
    doc, place = doc[o], place[o].astype("<u4")
    start, n = P.runs(doc)
    return [(-1, int(keys[doc[s]]), place[s : s + m].tobytes(), None, None, None, None, None) for s, m in zip(start, n)]


def _posts(h: np.ndarray, doc: np.ndarray, place: np.ndarray, ids: np.ndarray, keys: np.ndarray, bits: int, brief: bool) -> list[tuple]:
    """Rows of one slice by hash range; ``h`` ascending. ``brief``: 40 bits below the range's, enough for seeds."""
    edge, rows = P.cuts(h, bits), []
    for f in range(1 << bits):
        lo, hi = edge[f], edge[f + 1]
        if lo < hi:
            d = doc[lo:hi]
            known = d == KNOWN
            used, idx = np.unique(d[~known], return_inverse=True)
            local = np.full(hi - lo, KNOWN, "<u2")
            local[~known] = idx
            packed = P.pack40(h[lo:hi] >> np.uint64(24 - bits)) if brief else h[lo:hi].astype("<u8").tobytes()
            rows.append((f, None, None, packed, local.tobytes(), P.pack_planes(place[lo:hi]), ids[used].astype("<i8").tobytes(), keys[used].astype("<i8").tobytes()))
    return rows


def _gather(table: pa.Table, brief: bool) -> tuple[np.ndarray, ...]:
    """Hashes, documents (index into the ids; -1: none), places, ids and keys of one hash range."""
    C.lean()
    hashes, docs, at, ids, keys, base = [], [], [], [], [], 0
    for h, d, p, i, k in zip(*(table.column(c).to_pylist() for c in ("hashes", "docs", "at", "ids", "keys"))):
        d, i = np.frombuffer(d, "<u2").astype(np.int32), np.frombuffer(i, "<i8")
        hashes.append(P.unpack40(h) if brief else np.frombuffer(h, "<u8"))
        docs.append(np.where(d == KNOWN, -1, d + base))
        at.append(P.unpack_planes(p))
        ids.append(i)
        keys.append(np.frombuffer(k, "<i8"))
        base += len(i)
    return tuple(np.concatenate(x) for x in (hashes, docs, at, ids, keys))


def _ids(col: pa.Array) -> np.ndarray:
    return col.fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)


def _seed_posts(batches: Iterator[pa.RecordBatch], bits: int, window: int, seed: int) -> Iterator[pa.RecordBatch]:
    for part, texts in C.slices(batches):
        hashes, offsets = C.word_hashes([C.words(t) for t in texts])
        place, h = anchors(hashes, offsets, window, seed)
        doc = np.searchsorted(offsets, place, "right") - 1
        place = place - offsets[doc]
        o = np.argsort(h, kind="stable")
        h, doc, place, ids, keys = h[o], doc[o], place[o], _ids(part.column(0)), part.column(2).to_numpy()
        start, n = P.runs(h)
        again = np.repeat(n > 1, n)
        rows = _per_doc(keys, doc[again], place[again])
        d = np.where(again, KNOWN, doc)[start] if len(start) else doc
        yield _batch(rows + _posts(h[start], d, place[start], ids, keys, bits, True))


def _seeds(table: pa.Table) -> pa.Table:
    """Places of the anchors that another slice has too."""
    h, doc, place, _, keys = _gather(table, True)
    o = np.argsort(h, kind="stable")
    h, doc, place = h[o], doc[o], place[o]
    _, n = P.runs(h)
    hit = np.repeat(n > 1, n) & (doc >= 0)
    rows = _per_doc(keys, doc[hit], place[hit])
    return pa.table([pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())], ["key", "places"])


def _places(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Document and place within it, of lists of packed places per row."""
    doc, place = [], []
    for i, packed in enumerate(col.to_pylist()):
        p = np.frombuffer(b"".join(packed or ()), "<u4").astype(np.int64)
        doc.append(np.full(len(p), i))
        place.append(p)
    return np.concatenate(doc), np.concatenate(place)


def _window_posts(batches: Iterator[pa.RecordBatch], bits: int, window: int, seed: int) -> Iterator[pa.RecordBatch]:
    for part, texts in C.slices(batches):
        hashes, offsets = C.word_hashes([C.words(t) for t in texts])
        doc, place = _places(part.column(3))
        total = len(hashes)
        # windows that hold a seed: extension to the left and to the right
        mark = np.zeros(total + 1, np.int64)
        ok = place + seed <= np.diff(offsets)[doc]
        doc, p = doc[ok], offsets[doc[ok]] + place[ok]
        np.add.at(mark, np.maximum(p - (window - seed), offsets[doc]), 1)
        np.add.at(mark, p + 1, -1)
        near = np.cumsum(mark[:-1]) > 0
        starts = C.window_starts(offsets, window)
        starts = starts[near[starts]]
        if not len(starts):
            continue
        h = C.window_hashes(hashes, window)[starts]
        d = np.searchsorted(offsets, starts, "right") - 1
        ids, keys, at = _ids(part.column(0)), part.column(2).to_numpy(), starts - offsets[d]
        o = np.lexsort((at, keys[d], ids[d], h))
        h, d, at = h[o], d[o], at[o]
        start, n = P.runs(h)
        first = np.zeros(len(h), bool)
        first[start] = True
        first_of = np.repeat(start, n)
        same = (keys[d] == keys[d[first_of]]) & (at == at[first_of])  # the same row twice
        later = ~first & ~same
        yield _batch(_per_doc(keys, d[later], at[later]) + _posts(h[start], d[start], at[start], ids, keys, bits, False))


def _repeats(table: pa.Table) -> pa.Table:
    """Of the windows that several slices post, all places but the first."""
    h, doc, at, ids, keys = _gather(table, False)
    o = np.lexsort((at, keys[doc], ids[doc], h))
    h, at, own, doc = h[o], at[o], keys[doc][o], doc[o]
    start, n = P.runs(h)
    first_of = np.repeat(start, n)
    later = (own != own[first_of]) | (at != at[first_of])
    rows = _per_doc(keys, doc[later], at[later])
    return pa.table([pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())], ["key", "places"])


def _remove(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for part, texts in C.slices(batches):
        rows = []
        for doc, text, packed in zip(part.column(0).to_pylist(), texts, part.column(2).to_pylist()):
            words, gone, repeats = C.words(text), 0, 0
            if packed:
                mark = np.zeros(len(words) + 1, np.int64)
                s = np.unique(np.frombuffer(b"".join(packed), "<u4").astype(np.int64))
                s = s[s + window <= len(words)]
                np.add.at(mark, s, 1)
                np.add.at(mark, s + window, -1)
                covered = np.cumsum(mark[:-1]) > 0
                gone = int(covered.sum())
                repeats = int((np.diff(s) > 1).sum()) + bool(len(s))
                words = [words[i] for i in np.flatnonzero(~covered)]
            rows.append((doc, len(words) + gone, gone, hashlib.sha256(b" ".join(words)).hexdigest(), repeats))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [c.split()[0] for c in OUT.split(", ")])


def _joined(posts: DataFrame, reduce) -> DataFrame:
    """``(key, places)``, a row per document: what the slices settled themselves and what their join finds."""
    own = posts.filter("frag < 0").select("key", "places")
    found = posts.filter("frag >= 0").select("frag", "hashes", "docs", "at", "ids", "keys").groupBy("frag").applyInArrow(lambda t: reduce(t), "key long, places binary")
    return own.unionByName(found).groupBy("key").agg(F.collect_list("places").alias("places"))


def repeated_windows(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """``(key, places)``: packed starts of the windows that also start earlier, for documents ``(doc_id, text, key)`` that have any."""
    size = docs.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    per_window = window - seed + 2
    bits = P.fragment_bits(size // 6 * 2 // per_window, PER_FRAGMENT)
    posts = C.stage(docs.mapInArrow(lambda it: _seed_posts(it, bits, window, seed), ROWS), "substring-seeds")
    seeds = _joined(posts, _seeds)
    near = docs.join(seeds, "key").select("doc_id", "text", "key", "places")
    windows = C.stage(near.mapInArrow(lambda it: _window_posts(it, bits, window, seed), ROWS), "substring-windows")
    C.release(posts)
    return _joined(windows, _repeats)


def substring_dedup(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Per document: words, removed words, digest of what is left, number of maximal repeats."""
    docs = C.documents(df, id_col, text_col).withColumn("key", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    gone = repeated_windows(docs, window, seed)
    return docs.join(gone, "key", "left").select("doc_id", "text", "places").mapInArrow(lambda it: _remove(it, window), OUT)
