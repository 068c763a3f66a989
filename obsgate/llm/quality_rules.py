"""Quality rules with suffix-array repetition (operator 1).

Every document is read whole. Simple counts come from its words and lines; the
verdict on repetition from a suffix array over its words: the
longest-common-prefix (LCP) intervals give, for each position, the longest
substring that occurs again in the document (the deepest interval that holds
its suffix). Left-extendable ones are part of a longer repeat, the others are
the maximal repeats. Their spans are united; a document is rejected when the
covered fraction or the longest repeat exceeds its limit.

The suffix arrays of a slice of documents are built together in numpy by prefix
doubling; a word's first rank includes its document, so that no common prefix
crosses documents. Only positions that still share their rank are sorted again.
Memory is bounded by the slice (a few million characters, or one long text).

Defined results: null or empty text: zero words, fails the base rules (fewer
than ``min_words``). Repeated rows are judged one by one. Extra columns are
ignored by ``quality_rules`` and kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsgate.llm import common as C

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_WORDS_PCT = 50
MIN_REPEAT = 10  # words; shorter repeats are ordinary prose
MAX_COVERED = 0.3  # of the words
MAX_LONGEST = 100  # words

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_repeats long, covered_words long, longest_repeat long, covered_fraction double"
)
_SPACE = {i: None for i in (0x20, *range(0x09, 0x0E))}


def suffix_ranks(symbols: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... symbols, until all differ (prefix doubling)."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    s = symbols[order]
    new = np.ones(n, bool)
    new[1:] = s[1:] != s[:-1]
    rank = np.empty(n, np.int64)
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))  # a group's rank is its first place
    rank[order] = first
    levels, step = [rank], 1
    size = np.bincount(first, minlength=n)
    active = order[size[first] > 1]
    while len(active):
        nxt = np.where(active + step < n, rank[np.minimum(active + step, n - 1)], -1)
        own = rank[active]
        o = np.lexsort((nxt, own))
        active, own, nxt = active[o], own[o], nxt[o]
        head = np.ones(len(active), bool)
        head[1:] = own[1:] != own[:-1]
        split = head.copy()
        split[1:] |= nxt[1:] != nxt[:-1]
        idx = np.arange(len(active))
        group = np.maximum.accumulate(np.where(head, idx, 0))
        sub = np.maximum.accumulate(np.where(split, idx, 0))
        rank = rank.copy()
        rank[active] = own + (sub - group)
        levels.append(rank)
        count = np.bincount(sub, minlength=len(active))
        active = active[count[sub] > 1]
        step *= 2
    return levels


def longest_repeats(symbols: np.ndarray, at_least: int) -> np.ndarray:
    """Per position the length of the longest substring there that occurs twice (0 if under ``at_least``)."""
    n = len(symbols)
    best = np.zeros(n, np.int64)
    if n < 2:
        return best
    levels = suffix_ranks(symbols)
    sa = np.empty(n, np.int64)
    sa[levels[-1]] = np.arange(n)
    k = min(max(at_least, 1).bit_length() - 1, len(levels) - 1)  # equal first 2**k symbols: a needed condition
    coarse = levels[k][sa]
    near = np.flatnonzero(coarse[1:] == coarse[:-1]) if 2**k <= at_least else np.arange(n - 1)
    a, b = sa[near], sa[near + 1]
    lcp = np.zeros(len(near), np.int64)
    for j in range(len(levels) - 1, -1, -1):
        x, y = a + lcp, b + lcp
        ok = (x < n) & (y < n)
        same = ok & (levels[j][np.minimum(x, n - 1)] == levels[j][np.minimum(y, n - 1)])
        lcp += np.where(same, 1 << j, 0)
    np.maximum.at(best, a, lcp)
    np.maximum.at(best, b, lcp)
    best[best < at_least] = 0
    return best


def _rules(batches: Iterator[pa.RecordBatch], min_words: int, max_repeat_pct: int, min_repeat: int, max_covered: float, max_longest: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}[t]) for n, t in (c.split() for c in SCHEMA.split(", "))])
    for part, texts in C.slices(batches):
        hashes, offsets = C.word_hashes([C.words(t) for t in texts])
        n, d = np.diff(offsets), C.doc_of(offsets)
        total, docs = len(hashes), len(texts)
        with np.errstate(over="ignore"):
            symbols = C.mix(hashes + d.astype(np.uint64) * np.uint64(C._M[0]))
        # words in 3-word windows that occur twice or more in their document
        repeat = np.zeros(total + 1, np.int64)
        starts = C.window_starts(offsets, 3)
        if len(starts):
            w = C.window_hashes(symbols, 3)[starts]
            _, inv, cnt = np.unique(w, return_inverse=True, return_counts=True)
            again = starts[cnt[inv] > 1]
            repeat[again] += 1
            np.add.at(repeat, again + 3, -1)
        in_repeat = np.cumsum(repeat[:-1]) > 0
        # maximal repeats of the suffix array, their united spans and the longest
        best = longest_repeats(symbols, min_repeat)
        left = np.zeros(total, bool)
        left[1:] = best[:-1] == best[1:] + 1
        spans = np.flatnonzero((best > 0) & ~left)
        cover = np.zeros(total + 1, np.int64)
        np.add.at(cover, spans, 1)
        np.add.at(cover, spans + best[spans], -1)
        covered = np.cumsum(cover[:-1]) > 0

        def per_doc(x: np.ndarray) -> np.ndarray:
            return np.bincount(d, weights=x, minlength=docs).astype(np.int64)

        n_repeat, n_cover = per_doc(in_repeat), per_doc(covered)
        maximal = np.zeros(total)
        maximal[spans] = 1
        longest = np.zeros(docs, np.int64)
        np.maximum.at(longest, d, best)
        word_chars, n_symbols, dup_lines = [], [], []
        for t in texts:
            word_chars.append(len(t) - sum(t.count(chr(c)) for c in _SPACE))
            n_symbols.append(sum(t.count(c) for c in SYMBOLS))
            lines = [x for x in t.split("\n") if x.encode("utf-8", "surrogatepass").split()] if "\n" in t else ()
            dup_lines.append(len(lines) - len(set(lines)))
        base_failed = (n < min_words) | (100 * n_repeat > max_repeat_pct * n)
        fraction = n_cover / np.maximum(n, 1)
        kept = ~base_failed & (fraction <= max_covered) & (longest <= max_longest)
        cols = (part.column(0), n, word_chars, n_symbols, dup_lines, n_repeat, base_failed, kept, per_doc(maximal), n_cover, longest, fraction)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) if not isinstance(c, pa.Array) else c.cast(f.type) for c, f in zip(cols, schema)], schema=schema)


def quality_rules(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    max_repeat_words_pct: int = MAX_REPEAT_WORDS_PCT,
    min_repeat: int = MIN_REPEAT,
    max_covered: float = MAX_COVERED,
    max_longest: int = MAX_LONGEST,
) -> DataFrame:
    """Counts, repetition figures and verdict of every document."""
    args = (min_words, max_repeat_words_pct, min_repeat, max_covered, max_longest)
    return C.documents(df, id_col, text_col).mapInArrow(lambda it: _rules(it, *args), SCHEMA)


def keep_good(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """The rows of ``df`` that pass, with all their columns; rows are judged by id and text, without a join."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    keyed = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.struct(*cols).alias("row"))
    args = tuple({**dict(min_words=MIN_WORDS, max_repeat_words_pct=MAX_REPEAT_WORDS_PCT, min_repeat=MIN_REPEAT, max_covered=MAX_COVERED, max_longest=MAX_LONGEST), **limits}.values())

    def passing(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            verdicts = [r.column(7) for r in _rules(iter([b]), *args)]
            if verdicts:
                ok = pa.chunked_array(verdicts).combine_chunks()
                yield b.filter(ok).select([2])

    out = keyed.mapInArrow(passing, keyed.select("row").schema)
    return out.select([F.col("row").getField(c).alias(c) for c in df.columns])
