"""Hard negatives by threshold joins over a pruned inverted index (operator 11).

Anchors are some of the rows. An anchor's positives are its ``n_positive`` other
rows of the same label with the highest scores (integer inner products); for each
positive, its window holds the rows of other labels that score from ``low`` to ``high`` percent
of the positive's score, of which the first ``n_negative`` are returned.
Higher scores come first, ties by smaller id.

Both are threshold joins in the manner of L2AP, with a threshold per anchor.
Rows and anchors are cut into blocks; in a cell (a block of either):

* Dimensions are ordered by energy. A row's entries from dimension p on are left
  out of the inverted index when the norm of that suffix times the longest anchor's norm
  stays under the lowest threshold: alone they can't lift a score to it. Rows are
  ordered by the number of entries indexed, so the postings of a panel of dimensions
  are those of the first rows.
* Panel by panel partial scores are accumulated. What the dimensions to come, and
  those left out, can add is at most the product of the remaining norms; pairs
  that cannot reach the anchor's threshold any more are dropped. The survivors' scores are
  computed exactly, in integers.
* Thresholds begin high and are lowered, for the anchors that still lack results
  only, until their windows are full or reach their lower ends.

The first join (same label) gives the best positives of each cell, merged to the
best of all; the second gives each window's best of each cell, merged likewise.

Scale: every anchor meets every block of rows, a query set against all rows in blocks: work grows with anchors times
rows, which pruning lessens by a factor. Blocks are dealt by hash, so neither a hot
label nor a group of equal vectors gathers in one task; a cell holds at most about ``ROWS``
rows and ``ANCHORS`` anchors. The merges keep a few rows per anchor and cell.

Defined results: rows with a null id, label or vector, an empty vector, null or non-finite
entries take no part, nor do vectors of another length than the most frequent one (ties: the longest) or with
an integer entry whose scores could leave a long (over the root of ``2**62 / length``). A row repeated with id,
label and vector counts once; rows that share only their id are rows of their own. A positive's score
below 0 has an empty window; one of 0 the rows that score 0. Empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from obsgate.llm import common as C
from obsgate.llm import fragments as P
from obsgate.llm import vectors as V

N_POSITIVE, N_NEGATIVE, LOW, HIGH, SCALE = 5, 3, 50, 95, 256
ROWS, ANCHORS, BATCH, PANEL = 16_384, 2_048, 128, 8
FIRST, LOWER, ROUNDS = 0.5, 0.6, 4  # same label: first threshold as a share of the norms, its step, steps before none
STEP = 0.8  # other labels: step of the threshold below the windows' upper ends
CELL = "uid long, vec_id long, label long, x binary"


class Index:
    """Inverted index over a block of rows, for anchors whose norms are at most ``longest``."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.dims = np.argsort(-np.square(x.astype(float)).sum(0), kind="stable")
        self.values = x[:, self.dims].astype(float)
        self.tail = self._tails(self.values)

    @staticmethod
    def _tails(values: np.ndarray) -> np.ndarray:
        """Norm of each row's entries from dimension p on, for every p."""
        out = np.zeros((len(values), values.shape[1] + 1))
        out[:, :-1] = np.sqrt(np.cumsum(np.square(values)[:, ::-1], 1)[:, ::-1])
        return out

    def pairs(self, q: np.ndarray, least: np.ndarray, may: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(anchor, row, score)`` of the pairs that ``may`` meet and score at least ``least`` of the anchor."""
        d = len(self.dims)
        values = q[:, self.dims].astype(float)
        rest = self._tails(values)
        longest, lowest = rest[:, 0].max(), least.min()
        slack = 1e-9 * (longest * self.tail[:, 0].max() + 1)  # bounds are in floating point
        # entries indexed of each row: those up to the first suffix that can't reach the lowest threshold
        kept = (self.tail * longest >= lowest - slack).sum(1) if lowest > slack else np.full(len(self.x), d)
        kept = np.minimum(kept, d)
        order = np.argsort(-kept, kind="stable")
        n = np.searchsorted(-kept[order], -np.arange(1, d + 1), "right")  # rows that index dimension p
        order = order[: n[0]]
        kept = kept[order]
        indexed = np.where(np.arange(d) < kept[:, None], self.values[order], 0.0)
        left_out = self.tail[order, kept]
        may, least = may[:, order], least[:, None] - slack
        score = np.zeros((len(q), len(order)))
        rows = None
        for lo in range(0, d, PANEL):
            hi = min(lo + PANEL, d)
            if rows is None:
                score[:, : n[lo]] += values[:, lo:hi] @ indexed[: n[lo], lo:hi].T
                if hi * 2 < d and hi < d:
                    continue
                alive = may & (score + rest[:, hi, None] * self.tail[order, np.minimum(hi, kept)] + rest[:, :1] * np.where(kept < hi, left_out, 0) >= least)
                if alive.sum() * 8 < alive.size or hi == d:  # few: go on pair by pair
                    a, rows = np.nonzero(alive)
                    partial = score[a, rows]
            else:
                partial += np.einsum("ij,ij->i", values[a, lo:hi], indexed[rows, lo:hi])
                p = np.minimum(hi, kept[rows])
                on = partial + rest[a, hi] * self.tail[order[rows], p] + rest[a, 0] * np.where(kept[rows] < hi, left_out[rows], 0) >= least[a, 0]
                a, rows, partial = a[on], rows[on], partial[on]
        if rows is None:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        rows = order[rows]
        exact = np.concatenate([np.zeros(0, np.int64), *(np.einsum("ij,ij->i", q[a[i : i + 50_000]], self.x[rows[i : i + 50_000]]) for i in range(0, len(a), 50_000))])
        ok = exact >= least[a, 0]
        return a[ok], rows[ok], exact[ok]


def best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, uid: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each group: highest scores, then smallest ids."""
    o = np.lexsort((uid, ids, -score, group))
    start, n = P.runs(group[o])
    return o[np.arange(len(o)) - np.repeat(start, n) < k]


def _block(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    uid, ids, label = (table.column(c).to_numpy() for c in ("uid", "vec_id", "label"))
    x = np.frombuffer(b"".join(table.column("x").to_pylist()), "<i4").reshape(len(uid), -1).astype(np.int64)
    return uid, ids, label, x


POSITIVES = "anchor long, positive_id long, positive_uid long, positive_score long"


def _positives(rows: pa.Table, anchors: pa.Table, k: int) -> pa.Table:
    """The best ``k`` rows of each anchor's label in this cell, itself left out."""
    out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] * 4]
    if len(rows) and len(anchors):
        uid, ids, label, x = _block(rows)
        a_uid, _, a_label, q = _block(anchors)
        for value in np.unique(a_label):
            own = np.flatnonzero(label == value)
            if not len(own):
                continue
            index = Index(x[own])
            mine = np.flatnonzero(a_label == value)
            for lo in range(0, len(mine), BATCH):
                todo = mine[lo : lo + BATCH]
                share = FIRST
                for turn in range(ROUNDS + 1):
                    norms = np.sqrt(np.square(q[todo].astype(float)).sum(1)) * index.tail[:, 0].max()
                    least = norms * share if turn < ROUNDS else np.full(len(todo), -np.inf)
                    a, j, score = index.pairs(q[todo], least, a_uid[todo][:, None] != uid[own])
                    full = (np.bincount(a, minlength=len(todo)) >= k) | (turn == ROUNDS)
                    a, j, score = (z[full[a]] for z in (a, j, score))
                    top = best(a, score, ids[own][j], uid[own][j], k)
                    out.append([a_uid[todo][a[top]], ids[own][j[top]], uid[own][j[top]], score[top]])
                    todo = todo[~full]
                    if not len(todo):
                        break
                    share *= LOWER
    return pa.table([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out)], [c.split()[0] for c in POSITIVES.split(", ")])


NEGATIVES = "anchor long, anchor_id long, place int, positive_id long, positive_score long, negative_id long, negative_uid long, negative_score long"


def _negatives(rows: pa.Table, anchors: pa.Table, k: int, low: int, high: int) -> pa.Table:
    """The best ``k`` rows in each window of each anchor in this cell."""
    out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] * 8]
    if len(rows) and len(anchors):
        uid, ids, label, x = _block(rows)
        a_uid, a_ids, a_label, q = _block(anchors)
        lists = anchors.column("positives").to_pylist()
        width = max(map(len, lists))
        p_score, p_id = np.full((2, len(lists), width), -1, np.int64)
        for i, ps in enumerate(lists):
            p_score[i, : len(ps)] = [p["positive_score"] for p in ps]
            p_id[i, : len(ps)] = [p["positive_id"] for p in ps]
        # integers s with low * p <= 100 * s <= high * p; none for p < 0
        bottom = np.array([-(-low * p // 100) for p in p_score.ravel().tolist()], np.int64).reshape(p_score.shape)
        top = np.array([high * p // 100 for p in p_score.ravel().tolist()], np.int64).reshape(p_score.shape)
        exists = (p_score >= 0) & (bottom <= top)
        index = Index(x)
        with_window = np.flatnonzero(exists.any(1))
        for lo in range(0, len(with_window), BATCH):
            todo = with_window[lo : lo + BATCH]
            floor = np.where(exists, bottom, np.iinfo(np.int64).max)[todo].min(1)
            least = np.maximum(np.where(exists, top, -1)[todo].max(1) * STEP, floor)
            while len(todo):
                a, j, score = index.pairs(q[todo], least, a_label[todo][:, None] != label)
                held = []
                done = least <= floor
                filled = np.ones(len(todo), bool)
                for p in range(width):
                    i = todo[a]
                    within = exists[i, p] & (score >= bottom[i, p]) & (score <= top[i, p])
                    filled &= ~exists[todo, p] | (np.bincount(a[within], minlength=len(todo)) >= k) | (least <= bottom[todo, p])
                    held.append(within)
                done |= filled
                for p, within in enumerate(held):
                    w = np.flatnonzero(within & done[a])
                    w = w[best(a[w], score[w], ids[j[w]], uid[j[w]], k)]
                    i = todo[a[w]]
                    out.append([a_uid[i], a_ids[i], np.full(len(w), p), p_id[i, p], p_score[i, p], ids[j[w]], uid[j[w]], score[w]])
                todo, least, floor = todo[~done], np.maximum(least[~done] * STEP, floor[~done]), floor[~done]
    types = [pa.int32() if c.endswith("int") else pa.int64() for c in NEGATIVES.split(", ")]
    return pa.table([pa.array(np.concatenate(c).astype(np.int64)).cast(t) for c, t in zip(zip(*out), types)], [c.split()[0] for c in NEGATIVES.split(", ")])


# --- as Spark jobs


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = V.matrix(b.column(2)).astype("<i4") if b.num_rows else np.zeros((0, 0))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), pa.array([r.tobytes() for r in x], pa.binary())], ["vec_id", "label", "anchor", "x"])


def _first(df: DataFrame, keys: list[str], order: list[Column], k: int, out: str) -> DataFrame:
    """The first ``k`` rows of each key, numbered from 1; Spark keeps ``k`` a key before the shuffle too."""
    return df.withColumn(out, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col(out) <= k)


def hard_negatives(df: DataFrame, is_anchor: Column, *, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", n_positive: int = N_POSITIVE, n_negative: int = N_NEGATIVE, low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``; ``is_anchor``: a condition on ``df``'s columns."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("long").alias("label"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & V.usable(F.col("v"), scale)).select("vec_id", "label", V.integers(F.col("v"), scale).alias("x"), "anchor")
    dims = V.usual_length(rows, "x")
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if dims is None:
        return df.sparkSession.createDataFrame([], out)
    most = min(2**31 - 1, int((2**62 // dims) ** 0.5))
    rows = rows.filter((F.size("x") == dims) & F.forall("x", lambda c: F.abs(c) <= most)).distinct()
    rows = C.stage(rows.mapInArrow(_packed, "vec_id long, label long, anchor boolean, x binary").withColumn("uid", F.monotonically_increasing_id()), "negatives-rows")
    sizes = rows.agg(F.count("*").alias("n"), F.count_if("anchor").alias("q")).first()
    n_rows, n_anchors = C.n_partitions(df, sizes.n, ROWS), max(1, -(-sizes.q // ANCHORS))
    part = lambda n: F.pmod(F.xxhash64("uid"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cells = rows.select("uid", "vec_id", "label", "x", part(n_rows).alias("r"), every(n_anchors).alias("a")).groupBy("a", "r")

    def met(anchors: DataFrame, reduce, schema: str) -> DataFrame:
        dealt = anchors.withColumn("a", part(n_anchors)).withColumn("r", every(n_rows)).groupBy("a", "r")
        return cells.cogroup(dealt).applyInArrow(reduce, schema)

    anchors = rows.filter("anchor").select("uid", "vec_id", "label", "x")
    found = met(anchors, lambda x, y: _positives(x, y, n_positive), POSITIVES)
    found = _first(found, ["anchor"], [F.desc("positive_score"), F.col("positive_id"), F.col("positive_uid")], n_positive, "place")
    lists = found.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("positives"))
    with_lists = C.stage(anchors.join(lists, F.col("uid") == F.col("anchor")).drop("anchor"), "negatives-positives")
    mined = met(with_lists, lambda x, y: _negatives(x, y, n_negative, low, high), NEGATIVES)
    mined = _first(mined, ["anchor", "place"], [F.desc("negative_score"), F.col("negative_id"), F.col("negative_uid")], n_negative, "rank")
    return mined.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
