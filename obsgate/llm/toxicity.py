"""Toxicity by subword-bag embeddings (operator 3).

A word, in lower case and without punctuation at its ends, is the bag of its
hashed character n-grams (3 to 6 bytes, with marks for begin and end) and itself. Its vector
is their mean, a document's vector the mean over its words, and a linear softmax
on it gives the score. Embeddings and softmax are trained together (Adam on
the cross-entropy with shrinkage, numpy on the driver), so a misspelling never seen shares most of
its n-grams' vectors with the word it stands for.

Training reads at most ``max_train`` labelled documents, chosen by a hash of
their id among the rows that are not held out (``crc32(doc_id as text) mod
folds != 0``): a bounded sample for the classifier. Scoring covers every whole
text: the model shrinks to one number per n-gram bucket, a bounded closure.

Defined results: null or empty text: the score of no evidence. Null ``doc_id``: not
held out, scored. Labels that are null or lack a document don't train; without
labels of both classes every score is 0. Repeated rows are scored one by one.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsgate.llm import common as C

FOLDS, MAX_TRAIN = 5, 5_000
BUCKET_BITS, DIM, SIZES = 20, 4, (3, 4, 5, 6)
EPOCHS, RATE, SHRINK, SCALE, MIN_DOCS = 30, 0.4, 0.45, 800.0, 4
SCHEMA = "doc_id long, held_out boolean, score double, predicted int, n_words long"
_EDGE = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def bag(text: str) -> list[bytes]:
    return [w for w in (x.strip(_EDGE) for x in C.words(text.lower())) if w]


def ngram_buckets(words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word's n-grams and of the word itself (one word after the other), and the words' offsets."""
    marked = [b"<" + w + b">" for w in words]
    flat = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    length = np.fromiter(map(len, marked), np.int64, len(marked))
    end = np.cumsum(length)
    owner = np.repeat(np.arange(len(words)), length)
    left = end[owner] - np.arange(len(flat))  # bytes to the word's end
    owners, grams = [], []
    h = np.zeros(len(flat), np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, max(SIZES) + 1):
            shifted = np.zeros(len(flat), np.uint64)
            shifted[: len(flat) - n + 1] = flat[n - 1 :]
            h = h * np.uint64(C._M[0]) + shifted + np.uint64(1)
            if n in SIZES:
                ok = left >= n
                owners.append(owner[ok])
                grams.append(C.mix(h[ok] + np.uint64(n)) >> np.uint64(64 - BUCKET_BITS))
    whole = np.fromiter(map(C.xxh3_64_intdigest, marked), np.uint64, len(marked))
    owners.append(np.arange(len(words)))
    grams.append(whole >> np.uint64(64 - BUCKET_BITS))
    owners, grams = np.concatenate(owners), np.concatenate(grams).astype(np.int64)
    o = np.argsort(owners, kind="stable")
    return grams[o], np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(words)))])


@dataclass
class Model:
    margin: np.ndarray  # per bucket: the embedding along the difference of the softmax's two rows
    bias: float

    def word_margins(self, words: Sequence[bytes]) -> np.ndarray:
        grams, offsets = ngram_buckets(words)
        n = np.diff(offsets)
        return np.bincount(np.repeat(np.arange(len(n)), n), self.margin[grams], len(n)) / np.maximum(n, 1)

    def scores(self, bags: list[list[bytes]]) -> np.ndarray:
        hashes, offsets = C.word_hashes(bags)
        flat = [w for b in bags for w in b]
        _, first, inv = np.unique(hashes, return_index=True, return_inverse=True)
        per_word = self.word_margins([flat[i] for i in first])[inv] if flat else np.zeros(0)
        sums = np.bincount(C.doc_of(offsets), per_word, len(bags))
        z = SCALE * sums / np.maximum(np.diff(offsets), 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train(texts: list[str], labels: np.ndarray, seed: int = 7) -> Model | None:
    """Embeddings and softmax by full-batch Adam; None without two classes."""
    y = np.asarray(labels, float)
    if not len(y) or y.min() == y.max():
        return None
    # words of each document with their counts; then the buckets of each word, a chunk of words at a time
    vocabulary: dict[bytes, int] = {}
    doc, word, share = [], [], []
    for i, t in enumerate(texts):
        u, n = np.unique(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in bag(t)], np.int32), return_counts=True)
        doc.append(np.full(len(u), i, np.int32))
        word.append(u)
        share.append(n / max(n.sum(), 1))
    doc, word, share = (np.concatenate(x) for x in (doc, word, share))
    words = list(vocabulary)
    grams, per_word = [], []
    for lo in range(0, len(words), 20_000):
        g, off = ngram_buckets(words[lo : lo + 20_000])
        grams.append(g.astype(np.int32))
        per_word.append(np.diff(off))
    grams, per_word = np.concatenate(grams), np.concatenate(per_word)
    gram_word = np.repeat(np.arange(len(words), dtype=np.int32), per_word)
    # buckets in too few documents stay at zero
    docs_of_word = np.bincount(word, minlength=len(words))
    keep = (np.bincount(grams, docs_of_word[gram_word], 1 << BUCKET_BITS) >= MIN_DOCS)[grams]
    buckets, local = np.unique(grams[keep], return_inverse=True)
    local, gram_word = local.astype(np.int32), gram_word[keep]
    gram_share = 1 / per_word[gram_word]
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.01, (len(buckets), DIM))
    soft = rng.normal(0, 0.5, (DIM, 2))
    bias = np.log(np.array([1 - y.mean(), y.mean()]))
    params = [emb, soft, bias]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    target = np.stack([1 - y, y], 1)

    def spread(values: np.ndarray, of: np.ndarray, by: np.ndarray, to: np.ndarray, size: int) -> np.ndarray:
        """Sums of ``values[of] * by`` at ``to``, one dimension at a time."""
        return np.stack([np.bincount(to, values[of, k] * by, size) for k in range(values.shape[1])], 1)

    for step in range(1, EPOCHS + 1):
        word_vec = spread(emb, local, gram_share, gram_word, len(words))
        doc_vec = SCALE * spread(word_vec, word, share, doc, len(y))
        z = doc_vec @ soft + bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = (p - target) / len(y)
        g_doc = SCALE * g @ soft.T
        g_word = spread(g_doc, doc, share, word, len(words))
        grads = [spread(g_word, gram_word, gram_share, local, len(buckets)), doc_vec.T @ g, g.sum(0)]
        for q, d, a, b in zip(params, grads, m, v):
            a += 0.1 * (d - a)
            b += 0.01 * (d * d - b)
            q -= RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-12)
        # shrinkage: only n-grams whose gradients keep one direction grow away from zero
        emb[:] = np.sign(emb) * np.maximum(np.abs(emb) - RATE * SHRINK, 0)
    margin = np.zeros(1 << BUCKET_BITS, np.float32)
    margin[buckets] = emb @ (soft[:, 1] - soft[:, 0])
    return Model(margin, float(bias[1] - bias[0]))


def _held_out(folds: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))


def fit(df: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = FOLDS, max_train: int = MAX_TRAIN) -> Model | None:
    docs = C.documents(df, id_col, text_col)
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("y"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~_held_out(folds)).groupBy("doc_id").agg(F.max("y").alias("y"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    rows = docs.join(F.broadcast(sample), "doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "y").toArrow()
    if not rows.num_rows:
        return None
    rows = rows.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return train(rows.column("text").to_pylist(), rows.column("y").to_numpy())


def _score(batches: Iterator[pa.RecordBatch], model: Model | None) -> Iterator[pa.RecordBatch]:
    for part, texts in C.slices(batches):
        bags = [bag(t) for t in texts]
        s = model.scores(bags) if model else np.zeros(len(texts))
        cols = [part.column(0), part.column(2), pa.array(s), pa.array((s >= 0.5).astype(np.int32)), pa.array([len(b) for b in bags], pa.int64())]
        yield pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in SCHEMA.split(", ")])


def toxicity(df: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = FOLDS, max_train: int = MAX_TRAIN) -> DataFrame:
    """Score and prediction of every document, by a model trained on the labels that are not held out."""
    model = fit(df, labels, id_col=id_col, text_col=text_col, label_col=label_col, folds=folds, max_train=max_train)
    docs = C.documents(df, id_col, text_col).withColumn("held_out", _held_out(folds))
    return docs.mapInArrow(lambda it: _score(it, model), SCHEMA)
