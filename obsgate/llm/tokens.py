"""Token ids of whole texts by a public tokenizer file, encoded piece by piece.

The byte-level pre-tokenizer always starts a new token at a single space that
is followed by a non-space character, so a text's ids are the ids of its
space-led pieces one after the other. Pieces are told apart by a 64-bit hash,
made for a whole block of texts at once; each distinct one is encoded by the
tokenizers library when first seen, and its ids stay in a pool of bounded size (arrays,
some 25 bytes a piece). Texts where a space stands between other white space, ends
the text, or that hold one of the tokenizer's added tokens are encoded whole.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

from obsgate.llm.common import mix

_M = 0x9E3779B97F4A7C15  # odd: its powers have inverses modulo 2**64
BLOCK = 4_000_000  # bytes hashed at once
SPACE = "\u0120"  # how the byte-level alphabet writes a space
_UNSAFE = re.compile(r"\s (?:\s|$)")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class PieceEncoder:
    def __init__(self, path: str, cache_size: int = 1_500_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2") if self.tok.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        pre = str(self.tok.pre_tokenizer)
        self.by_piece = pre.startswith("ByteLevel(") and "add_prefix_space=False" in pre and "use_regex=True" in pre and self.tok.normalizer is None and self.tok.post_processor is None
        if self.by_piece:
            self.opens = np.zeros(max(self.tok.get_vocab(with_added_tokens=True).values()) + 1, bool)
            self.opens[[i for t, i in self.tok.get_vocab(with_added_tokens=False).items() if t.startswith(SPACE)]] = True
        self.cache_size = cache_size
        self.powers = np.ones((2, 1), np.uint64)
        self._forget()

    def _forget(self) -> None:
        self.keys, self.at, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, self.dtype), 0

    def _raw(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _spaced(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of every ``' ' + piece``, how many each has, and the order they come in. Pieces without white space at
        their ends are encoded in runs and cut where a token begins with a space, which only a piece's first token does."""
        alone = [i for i, p in enumerate(pieces) if not p or p[0].isspace() or p[-1].isspace()]
        rest = set(alone)
        plain = [i for i in range(len(pieces)) if i not in rest]
        runs = [" " + " ".join([pieces[i] for i in plain[k : k + 100]]) for k in range(0, len(plain), 100)]
        ids = [np.array(e.ids, self.dtype) for e in self.tok.encode_batch_fast(runs, add_special_tokens=False)] if runs else []
        ids = np.concatenate([np.zeros(0, self.dtype), *ids])
        n = np.diff(np.append(np.flatnonzero(self.opens[ids]), len(ids)))
        if len(n) != len(plain) or n.sum() != len(ids):
            raise ValueError("the tokenizer does not start a token at each space")
        other = [e.ids for e in self.tok.encode_batch_fast([" " + pieces[i] for i in alone], add_special_tokens=False)] if alone else []
        ids = np.concatenate([ids, *(np.array(x, self.dtype) for x in other)])
        return ids, np.append(n, [len(x) for x in other]).astype(np.int64), np.array(plain + alone, np.int64)

    def _hashes(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hash of each ``raw[start:end]``: a polynomial's part, brought to power 0."""
        size = len(raw) + 1
        with np.errstate(over="ignore"):
            if self.powers.shape[1] < size:
                self.powers = np.array([[1] * 2, [_M, pow(_M, -1, 2**64)]], np.uint64).T.repeat([1, size], axis=1)
                self.powers = np.cumprod(self.powers, axis=1, dtype=np.uint64)
            total = np.zeros(size, np.uint64)
            np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.powers[0, : len(raw)], out=total[1:])
            return mix((total[end] - total[start]) * self.powers[1, start] + (end - start).astype(np.uint64))

    def _pieces(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and how many each has."""
        uniq, first, inv = np.unique(self._hashes(raw, start, end), return_index=True, return_inverse=True)
        i = np.searchsorted(self.keys, uniq)
        known = np.zeros(len(uniq), bool)
        if len(self.keys):
            known = self.keys[np.minimum(i, len(self.keys) - 1)] == uniq
        if not known.all():
            if len(self.keys) and len(self.keys) + int((~known).sum()) > self.cache_size:
                self._forget()
                known[:] = False
                i[:] = 0
            new = np.flatnonzero(~known)
            data = raw.tobytes()
            more, n, order = self._spaced([data[lo:hi].decode("utf-8") for lo, hi in zip(start[first[new]].tolist(), end[first[new]].tolist())])
            at = np.zeros(len(new), np.int64)
            at[order] = self.used + np.cumsum(n) - n
            n[order] = n.copy()
            if self.used + len(more) > len(self.pool):
                self.pool = np.concatenate([self.pool[: self.used], np.zeros(self.used + 2 * len(more), self.dtype)])
            self.pool[self.used : self.used + len(more)] = more
            self.keys = np.insert(self.keys, i[new], uniq[new])
            self.at = np.insert(self.at, i[new], at)
            self.n = np.insert(self.n, i[new], n)
            self.used += len(more)
            i = np.searchsorted(self.keys, uniq)
        n = self.n[i][inv]
        place = np.arange(int(n.sum())) + np.repeat(self.at[i][inv] - (np.cumsum(n) - n), n)
        return self.pool[place], n

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian bytes of ``self.dtype``."""
        out: list[bytes] = [b""] * len(texts)
        split, whole = [], []
        for i, t in enumerate(texts):
            (whole if not self.by_piece or t.endswith(" ") or _UNSAFE.search(t) or any(a in t for a in self.added) else split).append(i)
        for i, ids in zip(whole, self._raw([texts[i] for i in whole]) if whole else ()):
            out[i] = ids
        if not split:
            return out
        heads = self._raw([texts[i].partition(" ")[0] for i in split])
        parts = [texts[i].encode("utf-8") for i in split]
        raw = np.frombuffer(b" ".join([b"", *parts]), np.uint8)  # a space leads each text too: to its first piece, which has none
        start = np.flatnonzero(raw == 32) + 1
        end = np.append(start[1:] - 1, len(raw))
        opens = np.cumsum([0, *[len(p) + 1 for p in parts[:-1]]]) + 1
        inner = ~np.isin(start, opens, assume_unique=True)
        text = np.searchsorted(opens, start, "right") - 1
        start, end, text = start[inner], end[inner], text[inner]
        lo, ids, n = 0, [np.zeros(0, self.dtype)], [np.zeros(0, np.int64)]
        while lo < len(start):
            hi = max(lo + 1, int(np.searchsorted(end, start[lo] + BLOCK, "right")))
            base = start[lo]
            x, m = self._pieces(raw[base : end[hi - 1]], start[lo:hi] - base, end[lo:hi] - base)
            ids.append(x)
            n.append(m)
            lo = hi
        ids = np.concatenate(ids)
        cut = np.cumsum(np.bincount(text, np.concatenate(n), len(split)).astype(np.int64))
        for i, head, x in zip(split, heads, np.split(ids, cut[:-1])):
            out[i] = head + x.tobytes()
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """One encoder per Python worker."""
    return PieceEncoder(path)
