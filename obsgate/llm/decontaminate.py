"""Benchmark decontamination by SimHash windows and multi-index Hamming search (operator 2).

For every benchmark item, each document's windows of the item's number of words
(of a shorter document, the whole document as its one window) get a 320-bit SimHash of their weighted 5-word shingles.
Fingerprints within ``RADIUS`` bits of an item's are found by multi-index hashing: of ``BLOCKS``
blocks of 16 bits at least ``Items.need`` differ in at most ``RADIUS // BLOCKS`` bits, a table per block
lists the items near each value, and items that enough tables name are compared; no
fingerprint within the radius is missed. A candidate counts if the exact weighted Jaccard similarity of window and item is
at least ``min_similarity`` (0.8). A shingle's weight is the letters in it; in a bag
it counts as often as it occurs. Fingerprints weigh it by the root, so that the cosine of
two bags is at least ``2J / (1 + J)`` at similarity ``J``, whatever the weights.

A window of which less than ``min_similarity`` of the weight lies in shingles of
the benchmark can't reach that similarity with any item and gets no
fingerprint; this bound loses nothing and spares nearly all windows.

Words are compared in lower case without punctuation at their ends; words of
punctuation alone are left out.

Scale: one pass over the documents without a shuffle of texts, whatever the number of items. It carries a Bloom filter of
the benchmark's shingles (at most ``FILTER_BITS`` bits; beyond some eight million shingles it lets more through and still
loses nothing) and the items' sizes, and writes the regions where windows pass the bound, as shingle hashes. Items then
go to the tasks in blocks of ``ITEMS_PER_PASS``, each a bounded closure, and only the regions are read per block.

Defined results: null or empty text or item: no match. Items under ``SHINGLE``
words are too short to identify and match nothing. Null ``doc_id``: reported as
null. Repeated rows: reported once per (doc_id, item_id), with the best window;
items with equal text are all reported. Empty tables: no rows.
"""

from __future__ import annotations


from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsgate.llm import common as C

SHINGLE, MIN_SIMILARITY = 5, 0.8
BITS, BLOCKS, RADIUS = 320, 20, 75  # at similarity 0.8 or more 0.15 of the bits differ on average, sd 6.4 bits
PAIRS = 4_000_000  # windows by items looked at together
ITEMS_PER_PASS = 2_000
FILTER_BITS = 1 << 28
PIECE, SPAN = 4_096, 16_384  # shingles of a region and of a run of regions; a region is longer if an item is
REGIONS = "doc_id long, n_words long, word_start long, hashes binary, weights binary"
SCHEMA = "doc_id long, item_id long, similarity double, word_start long, n_words long"
_EDGE = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_LANES = np.arange(BITS // 64, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def normal_words(text: str) -> list[bytes]:
    return [w for w in (x.strip(_EDGE) for x in C.words(text.lower())) if w]


def shingles(word_lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hash and weight at each word of all documents (only valid within one), and the offsets."""
    hashes, offsets = C.word_hashes(word_lists)
    letters = np.concatenate([[0], np.cumsum(np.fromiter((len(w) for ws in word_lists for w in ws), np.int64, len(hashes)))])
    n = max(0, len(hashes) - SHINGLE + 1)
    return C.window_hashes(hashes, SHINGLE), letters[SHINGLE : SHINGLE + n] - letters[:n], offsets


class Sums:
    """Running sums of the signed shingles, per bit: the fingerprint of any window is one difference."""

    def __init__(self, h: np.ndarray, weight: np.ndarray):
        bits = np.unpackbits(C.mix(h[:, None] + _LANES).view(np.uint8), axis=1, bitorder="little")
        signed = (bits.astype(np.int32) * 2 - 1) * np.rint(16 * np.sqrt(weight)).astype(np.int32)[:, None]
        self.sums = np.zeros((len(h) + 1, BITS), np.int32)
        np.cumsum(signed, axis=0, out=self.sums[1:])

    def prints(self, starts: np.ndarray, m: int) -> np.ndarray:
        """Fingerprints, rows of 64-bit words, of the bags of ``m`` shingles from each of ``starts`` on."""
        out = np.zeros((len(starts), BITS // 64), np.uint64)
        for lo in range(0, len(starts), 8192):
            s = starts[lo : lo + 8192]
            out[lo : lo + 8192] = np.packbits(self.sums[s + m] > self.sums[s], axis=1, bitorder="little").view(np.uint64)
        return out


def simhash(h: np.ndarray, weight: np.ndarray, starts: np.ndarray, m: int) -> np.ndarray:
    """Fingerprints of windows far apart, a run of ascending ``starts`` at a time."""
    out, i = [np.zeros((0, BITS // 64), np.uint64)], 0
    while i < len(starts):
        first = int(starts[i])
        j = max(i + 1, int(np.searchsorted(starts, first + SPAN)))
        end = int(starts[j - 1]) + m
        out.append(Sums(h[first:end], weight[first:end]).prints(starts[i:j] - first, m))
        i = j
    return np.concatenate(out)


def distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bits in which fingerprints differ."""
    return np.bitwise_count(x ^ y).sum(-1, dtype=np.int64)


class Known:
    """A Bloom filter of shingle hashes, 32 bits or more for each of ``n`` as far as ``FILTER_BITS`` allow."""

    def __init__(self, n: int):
        self.log = max(10, min(FILTER_BITS.bit_length() - 1, (32 * n).bit_length()))
        self.cells = np.zeros(1 << (self.log - 3), np.uint8)

    def _place(self, h: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
        x = (C.mix(h + np.uint64(turn)) if turn else h) >> np.uint64(64 - self.log)
        return (x >> np.uint64(3)).astype(np.int64), np.uint8(1) << (x & np.uint64(7)).astype(np.uint8)

    def add(self, h: np.ndarray) -> None:
        for turn in range(4):
            np.bitwise_or.at(self.cells, *self._place(h, turn))

    def has(self, h: np.ndarray) -> np.ndarray:
        left = np.arange(len(h))
        for turn in range(4):
            cell, bit = self._place(h[left], turn)
            left = left[(self.cells[cell] & bit) > 0]
        out = np.zeros(len(h), bool)
        out[left] = True
        return out


def _masks(bits: int, flips: int) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for r in range(flips + 1) for c in combinations(range(bits), r)], np.uint16)


class Items:
    """The benchmark's side of the search: fingerprints, block tables and bags of a bounded set of items."""

    def __init__(self, rows: list[tuple[int, str]], radius: int = RADIUS):
        self.radius, flips = radius, radius // BLOCKS
        # were more than radius // (flips + 1) blocks beyond ``flips``, the whole would be beyond the radius
        self.need = BLOCKS - radius // (flips + 1)
        lists = [(i, normal_words(t or "")) for i, t in rows]
        lists = [(i, w) for i, w in lists if len(w) >= SHINGLE]
        self.ids = [i for i, _ in lists]
        h, weight, offsets = shingles([w for _, w in lists]) if lists else (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(1, np.int64))
        self.sizes = np.diff(offsets)
        self.bags, prints = [], [np.zeros((0, BITS // 64), np.uint64)]
        self.weight: dict[int, int] = {}
        for lo, n in zip(offsets[:-1], self.sizes):
            m = int(n) - SHINGLE + 1
            own = h[lo : lo + m].tolist()
            self.bags.append(Counter(own))
            self.weight.update(zip(own, weight[lo : lo + m].tolist()))
            prints.append(simhash(h, weight, np.array([lo]), m))
        self.prints = np.concatenate(prints)
        self.known = np.unique(np.array(list(self.weight), np.uint64))
        # per block: items near each value, up to three flips; what the radius allows beyond those is tried on the windows
        near_item, self.tries = _masks(16, min(flips, 3)), _masks(16, max(flips - 3, 0))
        self.tables = []
        for value in self.prints.view(np.uint16).reshape(len(self.ids), BLOCKS).T:
            near = (value[:, None] ^ near_item).ravel()
            o = np.argsort(near, kind="stable")
            owner = (o // len(near_item)).astype(np.uint16 if len(self.ids) < 1 << 16 else np.int32)
            self.tables.append((np.searchsorted(near[o], np.arange((1 << 16) + 1)).astype(np.int32), owner))

    def named(self, prints: np.ndarray, fits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (window, item) that enough of the block tables name, among the items that fit."""
        found = []
        for value, (edge, owner) in zip(prints.view(np.uint16).reshape(len(prints), BLOCKS).T, self.tables):
            v = (value[:, None] ^ self.tries).ravel().astype(np.int64)
            lo, n = edge[v].astype(np.int64), (edge[v + 1] - edge[v]).astype(np.int64)
            w = np.repeat(np.arange(len(v)) // len(self.tries), n)
            item = owner[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(int(n.sum()))].astype(np.int64)
            ok = fits[item]
            pair = w[ok] * len(self.ids) + item[ok]
            found.append(np.unique(pair) if len(self.tries) > 1 else pair)
        pair, times = np.unique(np.concatenate(found), return_counts=True)
        return divmod(pair[times >= self.need], max(len(self.ids), 1))

    def within(self, prints: np.ndarray, size: int, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (window, item) of items of ``size`` (to ``most``) words whose fingerprints differ in at most the radius."""
        fits = (self.sizes >= size) & (self.sizes <= (size if most is None else most))
        step, windows, items = max(1, PAIRS // max(len(self.ids), len(self.tries), 1)), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for first in range(0, len(prints) if fits.any() else 0, step):
            part = prints[first : first + step]
            w, item = self.named(part, fits)
            near = distance(part[w], self.prints[item]) <= self.radius
            windows.append(first + w[near])
            items.append(item[near])
        return np.concatenate(windows), np.concatenate(items)

    def similarity(self, item: int, window: list[int], weight: dict[int, int]) -> float:
        """Exact weighted Jaccard similarity of the bags."""
        bag, own = self.bags[item], Counter(window)
        both = sum(min(n, own[s]) * self.weight[s] for s, n in bag.items() if s in own)
        total = sum(n * self.weight[s] for s, n in bag.items()) + sum(n * weight[s] for s, n in own.items())
        return both / (total - both) if total > both else float(total > 0)


class _Bound:
    """The weight bound on windows, given which shingles the benchmark has."""

    def __init__(self, hit: np.ndarray, weight: np.ndarray, least: float):
        self.near, self.least = np.flatnonzero(hit), least
        self.inside = np.concatenate([[0], np.cumsum(np.where(hit, weight, 0))])
        self.total = np.concatenate([[0], np.cumsum(weight)])

    def reached(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        return self.inside[e] - self.inside[s] >= self.least * (self.total[e] - self.total[s])

    def starts(self, m: int) -> np.ndarray:
        """Ascending starts of the windows of ``m`` shingles that hold a hit and reach the bound."""
        lo = np.maximum(np.maximum(self.near - m + 1, 0), np.concatenate([[0], self.near[:-1] + 1])[: len(self.near)])
        n = self.near - lo + 1
        s = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        s = s[s + m < len(self.total)]
        return s[self.reached(s, s + m)]


def _regions(batches: Iterator[pa.RecordBatch], known: Known, sizes: np.ndarray, least: float) -> Iterator[pa.RecordBatch]:
    """Where windows of the items' sizes reach the bound, cut so that each such window lies in one piece."""
    longest = int(sizes.max()) if len(sizes) else 0
    over = max(longest - SHINGLE, 0)  # shingles that pieces share
    for part, texts in C.slices(batches):
        h, weight, offsets = shingles([normal_words(t) for t in texts])
        rows = []
        bound = _Bound(known.has(h), weight, least)
        if len(bound.near):
            ids, change, n_words = part.column(0).to_pylist(), np.zeros(len(h) + 1, np.int64), np.diff(offsets)
            for size in sizes:
                m = int(size) - SHINGLE + 1
                s = bound.starts(m)
                s = s[s + size <= offsets[np.searchsorted(offsets, s, "right")]]
                change[s] += 1
                change[s + m] -= 1
            short = np.flatnonzero((n_words >= SHINGLE) & (n_words < longest))
            s, e = offsets[short], offsets[short + 1] - SHINGLE + 1
            whole = bound.reached(s, e)
            change[s[whole]] += 1
            change[e[whole]] -= 1
            covered = np.concatenate([[0], np.cumsum(change) > 0, [0]])
            for s, e in zip(np.flatnonzero(np.diff(covered) == 1).tolist(), np.flatnonzero(np.diff(covered) == -1).tolist()):
                d = int(np.searchsorted(offsets, s, "right")) - 1
                for lo in range(s, max(e - over, s + 1), PIECE):
                    hi = min(lo + PIECE + over, e)
                    rows.append((ids[d], int(n_words[d]), lo - int(offsets[d]), h[lo:hi].astype("<u8").tobytes(), weight[lo:hi].astype("<u4").tobytes()))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, types)], [c.split()[0] for c in REGIONS.split(", ")])


def _matches(batches: Iterator[pa.RecordBatch], items: Items, least: float) -> Iterator[pa.RecordBatch]:
    for part, blobs in C.slices(batches, "hashes", 8 * SPAN) if items.ids else ():
        ids, n_words, place = (part.column(k).to_pylist() for k in range(3))
        h = np.frombuffer(b"".join(blobs), "<u8").astype(np.uint64)
        weight = np.frombuffer(b"".join(part.column(4).to_pylist()), "<u4").astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum([len(b) // 8 for b in blobs])])
        at = np.minimum(np.searchsorted(items.known, h), len(items.known) - 1)
        bound, sums = _Bound(items.known[at] == h, weight, least), None
        best: dict[tuple[int, int], tuple] = {}

        def take(s: np.ndarray, d: np.ndarray, words: int, size: int, most: int) -> None:
            m = words - SHINGLE + 1
            for w, i in zip(*(x.tolist() for x in items.within(sums.prints(s, m), size, most))):
                lo, k = int(s[w]), int(d[w])
                own = h[lo : lo + m].tolist()
                sim = items.similarity(i, own, dict(zip(own, weight[lo : lo + m].tolist())))
                if sim >= least and ((k, i) not in best or sim > best[k, i][0]):
                    best[k, i] = (sim, place[k] + lo - int(offsets[k]), words)

        if len(bound.near):
            sums, longest = Sums(h, weight), int(items.sizes.max())
            for size in np.unique(items.sizes).tolist():
                m = size - SHINGLE + 1
                s = bound.starts(m)
                d = np.searchsorted(offsets, s, "right") - 1
                ok = s + m <= offsets[d + 1]
                if ok.any():
                    take(s[ok], d[ok], size, size, size)
            # documents shorter than an item
            long = np.diff(offsets) + SHINGLE - 1
            d = np.flatnonzero((np.array(n_words) == long) & (long < longest))
            d = d[bound.reached(offsets[d], offsets[d + 1])]
            for n in np.unique(long[d]).tolist():
                of = d[long[d] == n]
                take(offsets[of], of, n, n + 1, longest)
        rows = [(ids[k], items.ids[i], *v) for (k, i), v in best.items()]
        types = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, types)], [c.split()[0] for c in SCHEMA.split(", ")])


def _pairs(df: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_id_col: str, item_text_col: str, min_similarity: float, radius: int, items_per_pass: int) -> tuple[DataFrame, DataFrame]:
    """The best window of each pair, and the staged regions it is read from."""
    docs = C.documents(df, id_col, text_col)
    items = benchmark.select(F.col(f"`{item_id_col}`").cast("long").alias("item_id"), F.col(f"`{item_text_col}`").alias("text")).filter("text IS NOT NULL").distinct()
    counted = items.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).first()
    passes = max(1, -(-counted["n"] // items_per_pass))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(passes))
    sc = df.sparkSession.sparkContext

    def block(p: int) -> Items:
        return Items([(r["item_id"], r["text"]) for r in items.filter(part == p).orderBy("item_id", "text").collect()], radius)

    known, sizes = Known((counted["chars"] or 0) // 2), np.zeros(0, np.int64)  # a shingle begins at every second character at most
    for p in range(passes):
        own = block(p)
        known.add(own.known)
        sizes = np.union1d(sizes, own.sizes)
    filter_ = sc.broadcast((known, sizes))
    regions = C.stage(docs.mapInArrow(lambda it: _regions(it, *filter_.value, min_similarity), REGIONS), "decontaminate-regions")
    found = []
    for p in range(passes):
        own = sc.broadcast(block(p) if passes > 1 else own)
        found.append(regions.mapInArrow(lambda it, own=own: _matches(it, own.value, min_similarity), SCHEMA))
    best = F.max(F.struct("similarity", (-F.col("word_start")).alias("w"), "n_words")).alias("b")
    out = reduce(DataFrame.unionByName, found).groupBy("doc_id", "item_id").agg(best)
    return out.select("doc_id", "item_id", F.col("b.similarity").alias("similarity"), (-F.col("b.w")).alias("word_start"), F.col("b.n_words").alias("n_words")), regions


def contamination(df: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", min_similarity: float = MIN_SIMILARITY, radius: int = RADIUS, items_per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """``(doc_id, item_id, similarity, word_start, n_words)``: the best window of each contaminated pair."""
    return _pairs(df, benchmark, id_col, text_col, item_id_col, item_text_col, min_similarity, radius, items_per_pass)[0]


def drop_contaminated(df: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", min_similarity: float = MIN_SIMILARITY, radius: int = RADIUS, items_per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """``df`` without the documents that match an item (rows without id stay)."""
    pairs, regions = _pairs(df, benchmark, id_col, text_col, item_id_col, item_text_col, min_similarity, radius, items_per_pass)
    hit = C.stage(pairs.select("doc_id").distinct(), "contaminated")
    C.release(regions)
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"))
    return rows.join(hit, "doc_id", "left_anti").select("row.*")
