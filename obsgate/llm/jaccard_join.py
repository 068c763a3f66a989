"""N-gram Jaccard join by vertical partitioning (operator 8).

A document is the set of its distinct 5-word shingles, as 64-bit hashes (A-Z in
lower case; fewer words: the whole sequence is one). Two documents link when
``100 * |x & y| >= pct * |x | y|``.

1. Equal sets share a node, their 64-bit digest. A slice posts each node once
   and the join knows it by its id: copies are never paired with one another.
2. Global n-gram order: n-grams that many documents have come last, all others
   in hash order. Frequencies are counted over all documents, in hash ranges.
   The list of frequent n-grams only orders: any order gives the same links, so
   its size is bounded (``FREQUENT``) without losing one.
3. Candidates: linked documents share an n-gram among their first
   ``n - ceil(pct * n / 100) + 1``. These prefixes are joined by n-gram, cut
   into fragments by hash range. A pair counts only if the overlap can still be
   large enough when nothing before the n-gram is shared (a linked pair passes
   at its first common one). N-grams of few documents pair them all; those of
   more pair each document with the first one and with its neighbour in an order
   drawn by the n-gram. Where that leaves a list's documents in several
   components, the documents outside the list's largest one look for partners
   twice more, by size: what a document shares from the n-gram on bounds its
   partners' sizes on both sides, so it joins only the classes of sizes within
   (each ``GROWTH`` times the one before). First with one document of each class,
   the one that admits the largest partners; then those still apart with all of
   the class, as far as the sets' bitmaps allow the overlap. Every linked pair is
   thus either tested or already connected, which is all that components need.
   Where the links themselves are asked for (``jaccard_links`` with ``every``), all pairs of a long list
   whose sizes, places and bitmaps allow the overlap are tested instead: the
   documents of a list are cut into blocks, and each two blocks meet in one cell.
4. Overlaps: the n-grams of the paired documents are cut into vertical fragments
   of the global order. Each counts its part of the overlap of every pair, and
   the parts are summed per pair. This count is exact.
5. Components of the links; every copy gets its set's component.
6. Numbers of links: a link with an end outside the long lists has been tested in
   step 3 and is counted there. Two documents of long lists meet again if they
   are of one component, in just one cell: the task sums the overlaps of the
   cell's pairs over the vertical fragments and returns a number of links per
   document. No pair of theirs becomes a row; a component of up to ``CELL``
   documents is one cell, so each document is sent once. Larger ones are cut by
   classes of sizes, of which only neighbouring ones can link, and into blocks.
   The comparisons within a component remain as many as its pairs of like sizes.

Scale: postings travel packed, a row per slice and fragment. Pairs of one
neighbourhood are counted in one bucket, so that a set is sent once for all of
them; large neighbourhoods are split, a node's partners into blocks of ``BLOCK``.
A class of a long list is cut into cells of ``CELL`` documents on both sides;
for all its pairs the list is. Lists with the same smallest node share a bucket,
where a pair that several of them hold is kept once.
Fragments, blocks, cells and buckets are as many as the data needs.

Rows are told apart by their sets, so those without an id link like all others; their texts are found again by hash.

Defined results: null or empty text: no shingles, a component of its own. Null
``doc_id``: the component is that of its set, null if no row with an id belongs to it.
Rows are judged one by one, also those that share a ``doc_id``. Empty table: no rows. Extra columns are ignored by
``jaccard_components`` and kept by ``one_per_group``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

from obsgate.llm import common as C
from obsgate.llm import fragments as P
from obsgate.llm.components import components

SHINGLE, PCT = 5, 80
PER_FRAGMENT = 500_000
MANY = 32  # documents of an n-gram up to which all its pairs are tested
FREQUENT = 500_000  # n-grams in the order's last part, at most
BLOCK, VERTICAL = 256, 4
GROWTH = 1.05  # sizes of neighbouring classes of a long list
CELL = 2_000  # documents a side of a cell of such a class
CELL_GRAMS = 1_000_000  # n-grams a side of a cell, and of a bucket of cells, when links are counted
LIST_ROWS, LIST_PAIRS = 100_000, 4_000_000  # rows and pairs of long lists a bucket, when all their pairs are tested
PAIRS_PER_BUCKET = 1_000
KEY_BITS = 24
BITMAP = 1_024  # bits of a set's bitmap

SETS = "doc_id long, key long, n_shingles long, node long, bits array<long>"
COUNTS = "frag int, steps binary"
POSTS = "frag int, hashes binary, docs binary, places binary, ids binary, sizes binary"
CANDIDATES = "list long, a long, b long, na long, nb long"  # of a list: a is the node, b its place


def shingle_sets(texts: list[str], k: int = SHINGLE) -> list[np.ndarray]:
    """Ascending distinct shingle hashes of each text."""
    lists = [C.words(t, lower=True) for t in texts]
    hashes, offsets = C.word_hashes(lists)
    grams = C.window_hashes(hashes, k)
    out = []
    for lo, hi in zip(offsets[:-1], offsets[1:]):
        if hi - lo >= k:
            out.append(np.unique(grams[lo : hi - k + 1]))
        else:
            out.append(C.window_hashes(hashes[lo:hi], int(hi - lo)) if hi > lo else np.zeros(0, np.uint64))
    return out


def prefix_size(n: int, pct: int = PCT) -> int:
    return n + (-pct * n // 100) + 1 if n else 0


def _node(s: np.ndarray) -> int:
    """A set's (or list's) id."""
    return xxh3_64_intdigest(s.tobytes()) - 2**63


def bitmap(s: np.ndarray) -> np.ndarray:
    """One bit per n-gram by its hash: a bit set in x and not in y is an n-gram of x that y lacks."""
    bits = np.zeros(BITMAP, np.uint8)
    bits[(s & np.uint64(BITMAP - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view("<i8")


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for part, texts in C.slices(batches):
        sets = shingle_sets(texts, k)
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array([_node(s) if len(s) else None for s in sets], pa.int64()), pa.array([bitmap(s) if len(s) else None for s in sets], pa.list_(pa.int64()))], ["doc_id", "key", "n_shingles", "node", "bits"])


# --- the global order


def _count_posts(batches: Iterator[pa.RecordBatch], k: int, bits: int) -> Iterator[pa.RecordBatch]:
    for _, texts in C.slices(batches):
        h = np.sort(np.concatenate(shingle_sets(texts, k) or [np.zeros(0, np.uint64)]))
        edge = P.cuts(h, bits)
        key = (h >> np.uint64(64 - bits - KEY_BITS)).astype(np.int64) & ((1 << KEY_BITS) - 1)
        full = [f for f in range(1 << bits) if edge[f] < edge[f + 1]]
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([P.pack_steps(key[edge[f] : edge[f + 1]]) for f in full], pa.binary())], ["frag", "steps"])


def _frequent(table: pa.Table, least: int) -> pa.Table:
    C.lean()
    frag = table.column("frag")[0].as_py()
    keys = np.sort(np.concatenate([P.unpack_steps(b) for b in table.column("steps").to_pylist()]))
    start, n = P.runs(keys)
    often = n >= least
    return pa.table([pa.array((frag << KEY_BITS) | keys[start[often]], pa.int64()), pa.array(n[often], pa.int64())], ["key", "n"])


def frequent_keys(docs: DataFrame, k: int, bits: int, least: int = MANY, most: int = FREQUENT) -> np.ndarray:
    """Keys (leading hash bits) of the most frequent n-grams, ascending; about ``most`` at most: by powers of two,
    of the last one that begins to fit a share by hash."""
    counted = docs.mapInArrow(lambda it: _count_posts(it, k, bits), COUNTS).groupBy("frag").applyInArrow(lambda t: _frequent(t, least), "key long, n long")
    counted = C.stage(counted.withColumn("level", F.floor(F.log2("n")).cast("int")), "jaccard-frequent")
    level, held, share, last = 64, 0, 0, -1
    for r in counted.groupBy("level").count().orderBy(F.desc("level")).collect():  # at most 64 rows
        if held + r["count"] > most:
            share, last = 1_000 * (most - held) // r["count"], r["level"]
            break
        held += r["count"]
        level = r["level"]
    some = (F.col("level") == last) & (F.pmod(F.xxhash64("key"), F.lit(1_000)) < share) if share else F.lit(False)
    keys = np.sort(counted.filter((F.col("level") >= level) | some).select("key").toArrow().column(0).to_numpy().astype(np.int64))
    C.release(counted)
    return keys


def in_order(s: np.ndarray, frequent: np.ndarray, bits: int) -> tuple[np.ndarray, int]:
    """The set in global order, and how many of it are not frequent."""
    if not len(frequent):
        return s, len(s)
    key = (s >> np.uint64(64 - bits - KEY_BITS)).astype(np.int64)
    late = frequent[np.minimum(np.searchsorted(frequent, key), len(frequent) - 1)] == key
    return np.concatenate([s[~late], s[late]]), int((~late).sum())


# --- candidates


def _prefix_posts(batches: Iterator[pa.RecordBatch], k: int, pct: int, frequent, count_bits: int, bits: int) -> Iterator[pa.RecordBatch]:
    often = frequent.value
    names = [c.split()[0] for c in POSTS.split(", ")]
    for part, texts in C.slices(batches):
        ids, seen = np.zeros(len(texts), np.int64), set()
        hashes, docs, places, sizes = [], [], [], np.zeros(len(texts), np.int64)
        for i, s in enumerate(shingle_sets(texts, k)):
            if not len(s) or (node := _node(s)) in seen:
                continue
            seen.add(node)
            ids[i], sizes[i] = node, len(s)
            p = in_order(s, often, count_bits)[0][: prefix_size(len(s), pct)]
            hashes.append(p)
            docs.append(np.full(len(p), i, np.int64))
            places.append(np.arange(len(p)))
        if not hashes:
            continue
        h, d, at = np.concatenate(hashes), np.concatenate(docs), np.concatenate(places)
        o = np.argsort(h, kind="stable")
        h, d, at = h[o], d[o], at[o]
        edge, rows = P.cuts(h, bits), []
        for f in range(1 << bits):
            lo, hi = edge[f], edge[f + 1]
            if lo < hi:
                used, idx = np.unique(d[lo:hi], return_inverse=True)
                rows.append((f, P.pack40(h[lo:hi] >> np.uint64(24 - bits)), idx.astype("<u2").tobytes(), P.pack_planes(at[lo:hi]), ids[used].astype("<i8").tobytes(), sizes[used].astype("<u4").tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 5))], names)


def _postings(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Hashes, nodes and places of a fragment in order of (hash, id), each once; ids and sizes of the nodes."""
    C.lean()
    hashes, docs, places, ids, sizes, base = [], [], [], [], [], 0
    for h, d, p, i, n in zip(*(table.column(c).to_pylist() for c in ("hashes", "docs", "places", "ids", "sizes"))):
        hashes.append(P.unpack40(h))
        docs.append(np.frombuffer(d, "<u2").astype(np.int32) + base)
        places.append(P.unpack_planes(p).astype(np.int32))
        ids.append(np.frombuffer(i, "<i8"))
        sizes.append(np.frombuffer(n, "<u4").astype(np.int64))
        base += len(ids[-1])
    h, d, at, ids, sizes = (np.concatenate(x) for x in (hashes, docs, places, ids, sizes))
    del hashes, docs, places, table
    # a node comes from every slice that has a copy; ids in ascending order number the nodes anew
    uniq, inv = np.unique(ids, return_inverse=True)
    size = np.zeros(len(uniq), np.int64)
    size[inv] = sizes
    d = inv.astype(np.int32)[d]
    o = np.lexsort((at, d, h))
    h, d, at = h[o], d[o], at[o]
    once = np.ones(len(h), bool)
    once[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[once], d[once].astype(np.int64), at[once].astype(np.int64), uniq, size


def _candidates(table: pa.Table, pct: int, many: int) -> pa.Table:
    """Pairs (``list`` null), and for n-grams of many documents rows (list, node, place)."""
    frag = table.column("frag")[0].as_py()
    h, d, at, ids, size = _postings(table)
    start, n = P.runs(h)
    length, first = np.repeat(n, n), np.repeat(start, n)
    rest = size[d] - at  # n-grams from the shared one on: the most that can be shared

    def may(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return np.minimum(rest[i], rest[j]) * (100 + pct) >= pct * (size[d[i]] + size[d[j]])

    pairs = []

    def add(i: np.ndarray, j: np.ndarray) -> None:
        ok = may(i, j)
        a, b = d[i[ok]], d[j[ok]]
        pairs.append(np.minimum(a, b) * len(ids) + np.maximum(a, b))

    few = length <= many
    for off in range(1, many):
        i = np.flatnonzero(few[:-off]) if len(h) > off else np.zeros(0, np.int64)
        i = i[first[i] == first[i + off]]
        if not len(i):
            break
        add(i, i + off)
    j = np.flatnonzero(~few)
    add(first[j[first[j] != j]], j[first[j] != j])
    drawn = j[np.lexsort((C.mix(ids[d[j]].view(np.uint64) ^ C.mix(h[j])), first[j]))]
    near = first[drawn[:-1]] == first[drawn[1:]]
    add(drawn[:-1][near], drawn[1:][near])
    a, b = divmod(np.unique(np.concatenate(pairs)), max(len(ids), 1))
    # long lists; those of the same nodes become one, with each node's first place
    lists: dict[int, list] = {}
    for s, m in zip(start[n > many], n[n > many]):
        own = lists.setdefault(_node(d[s : s + m]), [(frag << 40) | int(h[s]), d[s : s + m], at[s : s + m]])
        own[2] = np.minimum(own[2], at[s : s + m])
    k = np.concatenate([np.zeros(0, np.int64), *(x[1] for x in lists.values())])
    place = np.concatenate([np.zeros(0, np.int64), *(x[2] for x in lists.values())])
    lst = np.concatenate([np.zeros(len(a), np.int64), *(np.full(len(x[1]), x[0]) for x in lists.values())])
    columns = [pa.array(lst, mask=np.arange(len(lst)) < len(a)), *(pa.array(np.concatenate(x)) for x in ((ids[a], ids[k]), (ids[b], place), (size[a], size[k]), (size[b], size[k])))]
    return pa.table(columns, ["list", "a", "b", "na", "nb"])


# --- overlaps


def _segments(batches: Iterator[pa.RecordBatch], k: int, frequent, count_bits: int, vertical: int) -> Iterator[pa.RecordBatch]:
    """The vertical fragments of each node's set, a row for each bucket that needs it."""
    often = frequent.value
    for part, texts in C.slices(batches):
        rows = []
        for node, buckets, s in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), shingle_sets(texts, k)):
            if not len(s) or _node(s) != node:  # another row of the same key
                continue
            ordered, light = in_order(s, often, count_bits)
            late = np.sort(ordered[light:])
            cut = np.searchsorted(ordered[:light], np.arange(1, vertical - 1, dtype=np.uint64) * np.uint64(2**64 // (vertical - 1)))
            segs = [x.tobytes() for x in (*np.split(ordered[:light], cut), late)]
            rows += [(b, g, node, x) for b in buckets for g, x in enumerate(segs) if x]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["bucket", "g", "node", "segment"])


def _overlaps(pairs: pa.Table, segments: pa.Table) -> pa.Table:
    """Partial overlaps of the pairs within one vertical fragment."""
    C.lean()
    of = {d: np.frombuffer(x, np.uint64) for d, x in zip(segments.column("node").to_pylist(), segments.column("segment").to_pylist())}
    none = np.zeros(0, np.uint64)
    counts = []
    for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist()):
        x, y = of.get(a, none), of.get(b, none)
        if len(x) > len(y):
            x, y = y, x
        if len(x) and len(y):
            i = np.searchsorted(y, x)
            counts.append(int((y[np.minimum(i, len(y) - 1)] == x).sum()))
        else:
            counts.append(0)
    return pa.table([*(pairs.column(c) for c in ("a", "b", "na", "nb")), pa.array(counts, pa.int64())], ["a", "b", "na", "nb", "both"])


def _dealt(pairs: DataFrame) -> DataFrame:
    """Pairs with their bucket: one for all pairs of a neighbourhood, several if it is large."""
    buckets = C.n_partitions(pairs, pairs.count(), PAIRS_PER_BUCKET)
    ends = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = ends.groupBy("a").agg(F.least("a", F.min("b")).alias("hood"))
    partners = pairs.groupBy("a").agg(F.count("*").alias("n"))
    known = pairs.join(lowest, "a").join(partners, "a")
    sizes = known.groupBy("hood").agg(F.count("*").alias("m"))
    block = F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / BLOCK))
    whole = F.col("m") <= 4 * PAIRS_PER_BUCKET
    cell = F.when(whole, F.xxhash64("hood")).otherwise(F.xxhash64("a", block))
    return C.stage(known.join(sizes, "hood").select("a", "b", "na", "nb", F.pmod(cell, F.lit(buckets)).alias("bucket")), "jaccard-pairs")


def _segments_of(docs: DataFrame, needs: DataFrame, k: int, pct: int, frequent, count_bits: int) -> DataFrame:
    """The vertical fragments of the nodes ``(node, key, buckets)``."""
    rows = docs.join(needs, "key").select("doc_id", "text", "node", "buckets")
    return rows.mapInArrow(lambda it: _segments(it, k, frequent, count_bits, VERTICAL), "bucket long, g long, node long, segment binary")


def _links(pairs: DataFrame, docs: DataFrame, firsts: DataFrame, k: int, pct: int, frequent, count_bits: int) -> DataFrame:
    """The pairs that link, by overlaps counted per vertical fragment."""
    dealt = _dealt(pairs)
    needs = dealt.select(F.explode(F.array("a", "b")).alias("node"), "bucket").groupBy("node").agg(F.collect_set("bucket").alias("buckets"))
    needs = needs.join(firsts.select("node", "key"), "node")
    segments = _segments_of(docs, needs, k, pct, frequent, count_bits)
    spread = dealt.withColumn("g", F.explode(F.array(*[F.lit(g).cast("long") for g in range(VERTICAL)])))
    parts = spread.groupBy("bucket", "g").cogroup(segments.groupBy("bucket", "g")).applyInArrow(lambda x, y: _overlaps(x, y), "a long, b long, na long, nb long, both long")
    sums = parts.groupBy("a", "b", "na", "nb").agg(F.sum("both").alias("both"))
    links = C.stage(sums.filter(F.col("both") * 100 >= F.lit(pct) * (F.col("na") + F.col("nb") - F.col("both"))), "jaccard-links")
    C.release(dealt)
    return links


# --- long lists


def _size_class(n: Column) -> Column:
    return F.floor(F.log(n) / math.log(GROWTH)).cast("int")


def _open_lists(held: DataFrame, groups: DataFrame, firsts: DataFrame, pct: int) -> DataFrame:
    """The rows of long lists whose documents are not all connected, each with its component, its list's largest one
    (``main``), its size class, the sizes of possible partners (``low`` to ``high``) and its bitmap."""
    known = held.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sizes = known.groupBy("list", "component").agg(F.count("*").alias("m"))
    largest = sizes.groupBy("list").agg(F.max_by("component", F.struct("m", "component")).alias("main"), F.count("*").alias("parts")).filter("parts > 1").select("list", "main")
    low, high = F.ceil(F.col("n") * pct / 100), F.floor(F.col("rest") * (100 + pct) / pct) - F.col("n")
    rows = known.join(largest, "list").withColumns({"cls": _size_class(F.col("n")), "low": low.cast("long"), "high": high.cast("long")}).filter("low <= high")
    return C.stage(rows.join(firsts.select("node", "bits"), "node"), "jaccard-open")


def _seekers(rows: DataFrame) -> DataFrame:
    """Documents outside their list's largest component, a row for each class that can hold a partner."""
    classes = F.sequence(_size_class(F.greatest("low", F.lit(1))), _size_class(F.col("high")))
    return rows.filter("component <> main").select("list", F.explode(classes).alias("cls"), F.struct("node", "n", "low", "high", "component", "bits").alias("x"))


def _able(pct: int) -> Column:
    """May ``x`` and ``y`` link, by component, sizes and bitmaps?"""
    fits = F.col("y.n").between(F.col("x.low"), F.col("x.high")) & F.col("x.n").between(F.col("y.low"), F.col("y.high"))
    lacks = lambda a, b: F.aggregate(F.zip_with(a, b, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q)))), F.lit(0), lambda s, n: s + n)
    both = F.least(F.col("x.n") - lacks("x.bits", "y.bits"), F.col("y.n") - lacks("y.bits", "x.bits"))  # at most
    return (F.col("x.component") != F.col("y.component")) & fits & (both * (100 + pct) >= pct * (F.col("x.n") + F.col("y.n")))


def _as_pairs(met: DataFrame) -> DataFrame:
    ordered = F.col("x.node") < F.col("y.node")
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"), F.when(ordered, F.col("x.n")).otherwise(F.col("y.n")).alias("na"), F.when(ordered, F.col("y.n")).otherwise(F.col("x.n")).alias("nb"))


def _with_leaders(rows: DataFrame, pct: int) -> DataFrame:
    """Seekers with one document of each class: the one that admits the largest partners."""
    leader = F.max_by(F.struct("node", "n", "low", "high", "component", "bits"), F.struct("high", "node")).alias("y")
    return _as_pairs(_seekers(rows).join(rows.groupBy("list", "cls").agg(leader), ["list", "cls"]).filter(_able(pct)))


def _in_cells(rows: DataFrame, pct: int) -> DataFrame:
    """Seekers with all documents of each class; two seekers meet from the smaller node's side."""
    place = ["list", "cls"]
    x = _seekers(rows)
    y = rows.select("list", "cls", F.struct("node", "n", "low", "high", "component", "bits").alias("y"), (F.col("component") == F.col("main")).alias("settled"))
    cells = lambda df, name: df.groupBy(place).agg(F.ceil(F.count("*") / CELL).cast("long").alias(name))
    grid = C.stage(cells(x, "nx").join(cells(y, "ny"), place), "jaccard-grid")
    x = x.join(grid, place).select("list", "cls", "x", F.pmod(F.xxhash64("x.node"), F.col("nx")).alias("bx"), F.explode(F.expr("sequence(0, ny - 1)")).alias("by"))
    y = y.join(grid, place).select("list", "cls", "y", "settled", F.pmod(F.xxhash64("y.node"), F.col("ny")).alias("by"), F.explode(F.expr("sequence(0, nx - 1)")).alias("bx"))
    return _as_pairs(x.join(y, [*place, "bx", "by"]).filter((F.col("settled") | (F.col("x.node") < F.col("y.node"))) & _able(pct)))


def _meet(rows: pa.Table, pct: int) -> pa.Table:
    """The pairs of a bucket's cells that sizes, places and bitmaps allow, each once."""
    C.lean()
    rows = rows.sort_by([("list", "ascending"), ("bx", "ascending"), ("by", "ascending"), ("n", "ascending")])
    lst, bx, by, own, node, n, rest = (rows.column(c).to_numpy() for c in ("list", "bx", "by", "own", "node", "n", "rest"))
    bits = rows.column("bits").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(node), -1)
    new = np.flatnonzero((lst[1:] != lst[:-1]) | (bx[1:] != bx[:-1]) | (by[1:] != by[:-1])) + 1
    uniq, at = np.unique(node, return_inverse=True)
    size = np.zeros(len(uniq), np.int64)
    size[at] = n
    found, held = [], 0
    for lo, hi in zip(np.append(0, new), np.append(new, len(node))):
        high = rest[lo:hi] * (100 + pct) // pct - n[lo:hi]  # the largest partner's size
        ends = lo + np.searchsorted(n[lo:hi], high, "right")
        for i in range(lo, hi):
            j = np.arange(i + 1, max(ends[i - lo], i + 1))
            least = pct * (n[i] + n[j])
            ok = np.minimum(rest[i], rest[j]) * (100 + pct) >= least
            if bx[i] != by[i]:
                ok &= own[i] != own[j]
            j, least = j[ok], least[ok]
            if not len(j):
                continue
            same = np.bitwise_count(bits[j] & bits[i]).sum(axis=1, dtype=np.int64)
            mine, theirs = int(np.bitwise_count(bits[i]).sum()), np.bitwise_count(bits[j]).sum(axis=1, dtype=np.int64)
            both = np.minimum(n[i] - (mine - same), n[j] - (theirs - same))  # at most
            j = j[both * (100 + pct) >= least]
            found.append(np.minimum(at[i], at[j]) * len(uniq) + np.maximum(at[i], at[j]))
            held += len(j)
            if held > 4_000_000:
                found = [np.unique(np.concatenate(found))]
                held = 0
    a, b = divmod(np.unique(np.concatenate([np.zeros(0, np.int64), *found])), max(len(uniq), 1))
    return pa.table([pa.array(x) for x in (uniq[a], uniq[b], size[a], size[b])], ["a", "b", "na", "nb"])


def _able_alone(pct: int) -> Column:
    """Can a row of a long list have any partner there?"""
    return F.col("rest") * (100 + pct) >= F.ceil(F.col("n") * pct / 100) * pct + F.col("n") * pct


def _all_pairs(held: DataFrame, firsts: DataFrame, pct: int) -> DataFrame:
    """All pairs of the long lists' documents that may link."""
    able = held.filter(_able_alone(pct))
    lists = able.groupBy("list").agg(F.min("node").alias("lead"), F.count("*").alias("m")).filter("m > 1")
    # blocks by powers of two, so that lists of like sizes have the same ones
    lists = lists.withColumn("blocks", F.expr(f"cast(pow(2, ceil(log2(greatest(m / {CELL}, 1)))) as long)"))
    block = F.least(F.col("m"), F.lit(CELL))
    shares = F.ceil(F.greatest(F.sum("m") / LIST_ROWS, F.sum(block * block) / LIST_PAIRS)).cast("long")
    leads = lists.groupBy("lead").agg(shares.alias("shares"))
    lists = C.stage(lists.join(leads, "lead"), "jaccard-lists")
    total = lists.agg(F.sum(F.col("m") * F.col("blocks")), F.sum(F.col("m").cast("double") * F.col("m"))).first()
    buckets = max(C.n_partitions(held, total[0] or 0, LIST_ROWS), int((total[1] or 0) / 2 // LIST_PAIRS) + 1)
    rows = able.join(lists, "list").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    rows = rows.withColumns({"bx": F.least("own", "other"), "by": F.greatest("own", "other")})
    cell = F.xxhash64("lead", "bx", "by", F.pmod(F.xxhash64("list"), F.col("shares")))
    rows = rows.join(firsts.select("node", "bits"), "node").select("list", "bx", "by", "own", "node", "n", "rest", "bits", F.pmod(cell, F.lit(buckets)).alias("bucket"))
    return rows.groupBy("bucket").applyInArrow(lambda t: _meet(t, pct), "a long, b long, na long, nb long")


# --- numbers of links


def _places(crowd: DataFrame, pct: int) -> DataFrame:
    """The cells of each node ``(node, n, component)``: any two of a component whose sizes may link share exactly one.
    Nodes of ``side`` false meet those of ``side`` true; if ``same``, all nodes of the cell meet."""
    sizes = crowd.groupBy("component").agg(F.count("*").alias("m"), F.sum("n").alias("grams")).filter("m > 1")
    whole = (F.col("m") <= CELL) & (F.col("grams") <= CELL_GRAMS)
    # a little wider than linked sizes can be apart
    cls = F.when(whole, 0).otherwise(F.floor(F.log("n") / math.log(101 / pct)))
    rows = crowd.join(sizes, "component").select("component", "node", "n", cls.cast("long").alias("cls"))
    blocks = rows.groupBy("component", "cls").agg(F.ceil(F.greatest(F.count("*") / CELL, F.sum("n") / CELL_GRAMS)).cast("long").alias("blocks"))
    rows = rows.join(blocks, ["component", "cls"]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks"))).drop("blocks")
    rows = rows.withColumn("step", F.explode(F.array(*[F.lit(d).cast("long") for d in (-1, 0, 1)]))).withColumn("with", F.col("cls") + F.col("step"))
    rows = rows.join(blocks.withColumnRenamed("cls", "with"), ["component", "with"]).withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    pair = lambda low, mid, high: F.when(F.col("step") < 0, low).when(F.col("step") > 0, high).otherwise(mid)
    bx = pair(F.col("other"), F.least("own", "other"), F.col("own"))
    by = pair(F.col("own"), F.greatest("own", "other"), F.col("other"))
    same = (F.col("step") == 0) & (F.col("own") == F.col("other"))
    side = pair(F.lit(True), F.col("own") > F.col("other"), F.lit(False))
    cell = F.xxhash64("component", F.least("cls", "with"), F.col("step") == 0, bx, by)
    return rows.select("node", "n", cell.alias("cell"), same.alias("same"), side.alias("side"))


def _add_overlaps(both: np.ndarray, xs: list[np.ndarray], ys: list[np.ndarray] | None, first: np.ndarray, last: np.ndarray) -> None:
    """Add the overlap of each of ``xs`` with its range of ``ys`` (none: of ``xs``)."""
    sets = xs if ys is None else xs + ys
    flat = np.concatenate(sets)
    if not len(flat):
        return
    _, ids, counts = np.unique(flat, return_inverse=True, return_counts=True)
    keep = counts[ids] > 1
    edge = np.append(0, np.cumsum(keep))[np.append(0, np.cumsum([len(x) for x in sets]))]
    ids = ids[keep].astype(np.int32)
    mark = np.zeros(len(counts), np.int8)
    base = 0 if ys is None else len(xs)
    for i in range(len(xs)):
        lo, hi = first[i], last[i]
        mine = ids[edge[i] : edge[i + 1]]
        if lo >= hi or not len(mine):
            continue
        mark[mine] = 1
        ends = edge[base + lo : base + hi + 1]
        sums = np.append(0, np.cumsum(mark[ids[ends[0] : ends[-1]]], dtype=np.int64))[ends - ends[0]]
        both[i, lo:hi] += np.diff(sums).astype(np.int32)
        mark[mine] = 0


def _count_links(places: pa.Table, segments: pa.Table, pct: int) -> pa.Table:
    """Each node's number of links within the cells of a bucket: overlaps summed over the vertical fragments."""
    C.lean()
    of: list[dict[int, np.ndarray]] = [{} for _ in range(VERTICAL)]
    for g, d, x in zip(*(segments.column(c).to_pylist() for c in ("g", "node", "segment"))):
        of[g][d] = np.frombuffer(x, np.uint64)
    places = places.sort_by([("cell", "ascending"), ("n", "ascending")])
    cell, node, n = (places.column(c).to_numpy() for c in ("cell", "node", "n"))
    same, side = (np.array(places.column(c).to_pylist(), bool) for c in ("same", "side"))
    uniq, at = np.unique(node, return_inverse=True)
    degree, none = np.zeros(len(uniq), np.int64), np.zeros(0, np.uint64)
    for lo, m in zip(*P.runs(cell)):
        rows = np.arange(lo, lo + m)
        x, y = (rows, rows) if same[lo] else (rows[~side[rows]], rows[side[rows]])
        if not len(x) or not len(y):
            continue
        first = np.searchsorted(n[y], -(-pct * n[x] // 100), "left")
        last = np.searchsorted(n[y], 100 * n[x] // pct, "right")
        if same[lo]:
            first = np.maximum(first, np.arange(1, len(x) + 1))
        both = np.zeros((len(x), len(y)), np.int32)
        for part in of:
            sets = [[part.get(d, none) for d in node[z].tolist()] for z in (x, y)]
            _add_overlaps(both, sets[0], None if same[lo] else sets[1], first, last)
        theirs = np.zeros(len(y), np.int64)
        for i, row in enumerate(both):
            linked = row.astype(np.int64) * (100 + pct) >= pct * (n[x[i]] + n[y])
            degree[at[x[i]]] += int(linked.sum())
            theirs += linked
        np.add.at(degree, at[y], theirs)
    return pa.table([pa.array(uniq), pa.array(degree)], ["node", "links"])


class _Tested(NamedTuple):
    """What the join has after its first round."""

    sets: DataFrame  # node and size of every row's set
    docs: DataFrame
    firsts: DataFrame  # the row at which a node's set is found again
    found: DataFrame
    held: DataFrame  # rows of long lists
    pairs: DataFrame
    links: DataFrame
    order: tuple  # k, pct, and the global order


def _degrees(t: _Tested, links: DataFrame, groups: DataFrame) -> DataFrame:
    """``(node, links)``: the number of all links of each node that has one."""
    ends = lambda df: df.select(F.explode(F.array("a", "b")).alias("node"), F.lit(1).cast("long").alias("links"))
    pct = t.order[1]
    crowd = t.held.filter(_able_alone(pct)).select("node", "n").distinct().join(groups, "node")
    places = C.stage(_places(crowd, pct), "jaccard-places")
    total = places.agg(F.count("*").alias("rows"), F.sum("n").alias("grams")).first()
    if not total["rows"]:
        C.release(places)
        return ends(links).groupBy("node").agg(F.sum("links").alias("links"))
    buckets = max(C.n_partitions(places, total["rows"], LIST_ROWS), -(-total["grams"] // CELL_GRAMS))
    dealt = places.withColumn("bucket", F.pmod("cell", F.lit(buckets)))
    needs = dealt.groupBy("node").agg(F.collect_set("bucket").alias("buckets")).join(t.firsts.select("node", "key"), "node")
    counted = dealt.groupBy("bucket").cogroup(_segments_of(t.docs, needs, *t.order).groupBy("bucket")).applyInArrow(lambda x, y: _count_links(x, y, pct), "node long, links long")
    inside = places.select("node").distinct()
    met = lambda c: inside.select(F.col("node").alias(c), F.lit(True).alias(f"{c}_met"))
    apart = links.select("a", "b").join(met("a"), "a", "left").join(met("b"), "b", "left").filter("a_met IS NULL OR b_met IS NULL")
    out = C.stage(ends(apart).unionByName(counted).groupBy("node").agg(F.sum("links").alias("links")), "jaccard-degrees")
    C.release(places)
    return out


# --- the join


def _first_round(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, pct: int = PCT, many: int = MANY) -> _Tested:
    spark = df.sparkSession
    # one row of each set is looked up again: by id, or by the text's hash if there is none
    docs = C.documents(df, id_col, text_col).withColumn("key", F.coalesce("doc_id", F.xxhash64(F.lit("no id"), "text")))
    sets = C.stage(docs.mapInArrow(lambda it: _sets(it, k), SETS), "jaccard-sets")
    total = sets.agg(F.sum("n_shingles").alias("n")).first().n or 0
    firsts = sets.filter("node IS NOT NULL").groupBy("node").agg(F.coalesce(F.min("doc_id"), F.min("key")).alias("key"), F.any_value("bits").alias("bits"))

    count_bits = P.fragment_bits(total, 2 * PER_FRAGMENT)
    frequent = spark.sparkContext.broadcast(frequent_keys(docs, k, count_bits))
    bits = P.fragment_bits(total * (100 - pct) // 100, PER_FRAGMENT)
    posts = docs.mapInArrow(lambda it: _prefix_posts(it, k, pct, frequent, count_bits, bits), POSTS)
    found = C.stage(posts.groupBy("frag").applyInArrow(lambda t: _candidates(t, pct, many), CANDIDATES), "jaccard-candidates")
    pairs = C.stage(found.filter("list IS NULL").select("a", "b", "na", "nb").distinct(), "jaccard-tested")
    links = _links(pairs, docs, firsts, k, pct, frequent, count_bits)
    # (a pair's ``b`` is no place: filters on ``rest`` may be run before the one on ``list``)
    rest = F.when(F.col("b").between(0, F.col("na")), F.col("na") - F.col("b"))
    held = found.filter("list IS NOT NULL").select("list", F.col("a").alias("node"), F.col("na").alias("n"), rest.alias("rest"))
    return _Tested(sets, docs, firsts, found, held, pairs, links, (k, pct, frequent, count_bits))


def _connect(t: _Tested) -> tuple[DataFrame, DataFrame]:
    """``(links, groups)``: links that connect the components, and these; documents of long lists that are not yet all
    connected meet."""
    pct = t.order[1]
    links, groups = t.links, components(t.links)
    tested = [t.pairs]
    for meet in (_with_leaders, _in_cells):
        rows = _open_lists(t.held, groups, t.firsts, pct)
        if rows.isEmpty():
            C.release(rows)
            break
        more = meet(rows, pct).distinct()
        for before in tested:
            more = more.join(before.select("a", "b"), ["a", "b"], "left_anti")
        tested.append(C.stage(more, "jaccard-more"))
        C.release(rows)
        if not tested[-1].isEmpty():
            late = _links(tested[-1], t.docs, t.firsts, *t.order)
            if not late.isEmpty():
                links = links.unionByName(late)
                groups = components(links)
    C.release(*tested)
    return links, groups


def jaccard_links(df: DataFrame, *, every: bool = True, **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(sets, links, groups)``: node and size of every row's set; the links ``(a, b, na, nb, both)`` between
    nodes, ``every`` one or those that connect the components; the components of the nodes that have a link."""
    t = _first_round(df, **options)
    if every:
        links = t.links
        more = C.stage(_all_pairs(t.held, t.firsts, t.order[1]).distinct().join(t.pairs.select("a", "b"), ["a", "b"], "left_anti"), "jaccard-more")
        if not more.isEmpty():
            links = links.unionByName(_links(more, t.docs, t.firsts, *t.order))
        groups = components(links)
        C.release(t.pairs, more)
    else:
        links, groups = _connect(t)
    C.release(t.found)
    return t.sets, links, groups


def _judged(df: DataFrame, *, every: bool = True, **options) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, its set's node and component, ``component_id``, ``links`` (``every`` one
    or those that connect the components)."""
    t = _first_round(df, **options)
    links, groups = _connect(t)
    degree = _degrees(t, links, groups) if every else links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
    C.release(t.found)
    sets = t.sets
    nodes = sets.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("first"))
    nodes = nodes.join(groups, "node", "left").join(degree, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = nodes.groupBy("component").agg(F.min("first").alias("component_id"))
    known = nodes.join(lowest, "component").select("node", "component", "component_id", F.coalesce("links", F.lit(0)).alias("links"))
    out = sets.join(known, "node", "left")
    return out.select("doc_id", "n_shingles", "node", "component", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("links", F.lit(0)).cast("long").alias("links"))


def jaccard_components(df: DataFrame, **options) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id`` and the number of ``links`` of its set to other sets."""
    return _judged(df, **options).select("doc_id", "n_shingles", "component_id", "links")


def _with_node(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for part, texts in C.slices(batches):
        nodes = [_node(s) if len(s) else None for s in shingle_sets(texts, k)]
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(nodes, pa.int64())], ["row", "doc_id", "node"])


def one_per_group(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, **options) -> DataFrame:
    """``df`` with one document of each component, the one with the smallest id; rows without id stay. Rows that share
    an id are judged by their own sets."""
    judged = _judged(df, id_col=id_col, text_col=text_col, k=k, **{"every": False, **options}).filter("doc_id IS NOT NULL")
    groups = C.stage(judged.select("doc_id", "node", "component", "component_id"), "jaccard-groups")
    again = groups.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    out = groups.filter("component_id <> doc_id").select("doc_id").distinct()
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    rows = df.select(whole, F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    if again.isEmpty():
        return rows.drop("text").join(out, "doc_id", "left_anti").select("row.*")
    single = rows.join(again, "doc_id", "left_anti").join(out, "doc_id", "left_anti").select("row")
    # of the rows of one id and component one set stays, of its copies one row
    stay = groups.filter("component_id = doc_id").groupBy("doc_id", "component").agg(F.min("node").alias("set")).select(F.col("doc_id").alias("id"), "set")
    schema = T.StructType([T.StructField("row", df.schema), T.StructField("doc_id", T.LongType()), T.StructField("node", T.LongType())])
    shared = rows.join(again, "doc_id", "left_semi").select("row", "doc_id", "text").mapInArrow(lambda it: _with_node(it, k), schema)
    shared = shared.join(stay, (F.col("doc_id") == F.col("id")) & F.col("node").eqNullSafe(F.col("set")), "left_semi")
    return single.unionByName(shared.dropDuplicates(["doc_id", "node"]).select("row")).select("row.*")
