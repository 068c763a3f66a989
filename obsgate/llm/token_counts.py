"""Token counts by a compiled finite-state tokenizer (operator 12).

A byte-level BPE file is compiled into two deterministic transducers.

* The splitter reads code-point classes and emits where pieces begin (its output
  may lie one character back, which settles contractions and white space before
  a word). It has a dozen states, so a chunk of text is a map from the state it
  is entered in to the state it is left in. The maps of all chunks are made side
  by side and composed by a parallel prefix scan, which tells each chunk the
  state it is entered in; then all chunks emit at once.
* The counter reads the bytes of a piece. Its state after a prefix holds, for each
  place at which a token may still be open, the trie node reached from there,
  the last token before it and how many tokens fewer than now there were. The next
  byte's last token is the one that ends there and may follow the one before (an
  encoding is right if each pair of neighbours is), so every transition
  is annotated with the tokens it adds, which can be fewer than none. States are
  made when first reached and kept in a hash table of bounded size that all
  pieces are stepped through side by side; a full table is started anew.

Code-point classes are asked of the library's own splitter once per code point.
Special tokens are cut out of a text first and count one each.

Scale: one pass, no shuffle. Texts are read in blocks of ``BLOCK`` characters that
end before a space after a letter or digit, where the splitter's state is the first one.

Defined results: null or empty text: 0 bytes, 0 tokens. Null ``doc_id``: kept. Repeated rows
and ties: one row each. Empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from obsgate.llm import common as C
from obsgate.llm.tokens import default_tokenizer

LIMIT = 1024
CHUNK, BLOCK = 128, 1_000_000
SLOTS, MOST = 1 << 20, 400_000  # of the counter's table; transitions after which it is started anew
STEPS = 64  # bytes of a piece stepped side by side; the few longer ones go on one by one
OUT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

# --- the splitter

LETTER, STMD, R, V, LL, E, NUMBER, OTHER, QUOTE, SPACE, WHITE, END = range(12)
S_START, S_LETTER, S_NUMBER, S_OTHER, S_SPACE, S_WHITE, S_SPACES, S_WHITES, S_QUOTE, S_R, S_V, S_L, S_SHORT = range(13)
N_CLASSES, N_STATES = 12, 13
HERE, BACK = 1, 2  # a piece begins at this character, at the one before


def split_step(state: int, cls: int) -> tuple[int, int]:
    """Next state and output of the splitter."""
    if (state, cls) in ((S_R, E), (S_V, E), (S_L, LL)) or (state, cls) == (S_QUOTE, STMD):
        return S_SHORT, 0  # 're 've 'll 's 't 'm 'd: whatever follows is another piece
    if state == S_QUOTE and cls in (R, V, LL):
        return {R: S_R, V: S_V, LL: S_L}[cls], 0
    out = 0
    if state in (S_R, S_V, S_L):  # no contraction: the quote was a piece, the letter begins one
        state, out = S_LETTER, BACK
    if cls == END:
        return S_START, out
    if cls in (SPACE, WHITE):
        if state in (S_SPACE, S_WHITE, S_SPACES, S_WHITES):
            return (S_SPACES if cls == SPACE else S_WHITES), out
        return (S_SPACE if cls == SPACE else S_WHITE), out | HERE
    if state in (S_SPACES, S_WHITES):  # the last of several white characters is a piece's first, or a piece
        state, out = (S_SPACE if state == S_SPACES else S_WHITE), out | BACK
    if cls == NUMBER:
        return S_NUMBER, out | (0 if state in (S_NUMBER, S_SPACE) else HERE)
    if cls in (OTHER, QUOTE):
        if state in (S_OTHER, S_QUOTE, S_SPACE):
            return S_OTHER, out
        return (S_QUOTE if cls == QUOTE else S_OTHER), out | HERE
    return S_LETTER, out | (0 if state in (S_LETTER, S_SPACE) else HERE)


_STEPS = np.array([[split_step(s, c) for c in range(N_CLASSES)] for s in range(N_STATES)], np.uint8)
NEXT, EMIT = np.ascontiguousarray(_STEPS[..., 0]).ravel(), np.ascontiguousarray(_STEPS[..., 1]).ravel()


def chunk_maps(cls: np.ndarray) -> np.ndarray:
    """State map of each chunk (a row of classes): the state left in, by the state entered in."""
    maps = np.tile(np.arange(N_STATES, dtype=np.uint8), (len(cls), 1))
    for k in range(cls.shape[1]):
        maps = NEXT[maps * np.uint8(N_CLASSES) + cls[:, k, None]]
    return maps


def prefix_scan(maps: np.ndarray) -> np.ndarray:
    """Composition of each map with all before it, in log2 rounds."""
    d = 1
    while d < len(maps):
        maps = np.concatenate([maps[:d], np.take_along_axis(maps[d:], maps[:-d].astype(np.intp), 1)])
        d *= 2
    return maps


def piece_starts(cls: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Whether a piece begins at each character, from the classes of texts that END follows each."""
    rows = np.full((-(-len(cls) // chunk), chunk), END, np.uint8)
    rows.ravel()[: len(cls)] = cls
    entered = np.concatenate([[[S_START]], prefix_scan(chunk_maps(rows))[:-1, [S_START]]]).ravel().astype(np.uint8)
    out, state = np.zeros(rows.shape, np.uint8), entered
    for k in range(chunk):
        key = state * np.uint8(N_CLASSES) + rows[:, k]
        out[:, k], state = EMIT[key], NEXT[key]
    out = out.ravel()[: len(cls)]
    start = (out & HERE).astype(bool)
    start[:-1] |= (out[1:] & BACK).astype(bool)
    return start


# --- the counter


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else the next free one."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


class Counter:
    """Both transducers of one tokenizer file."""

    def __init__(self, path: str, slots: int = SLOTS, most: int = MOST):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        if not path.endswith(".json"):
            raise ValueError(f"not a tokenizer file of the kind compiled here: {path}")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model, added = spec.get("pre_tokenizer") or {}, spec["model"], spec.get("added_tokens") or []
        plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec.get("normalizer")
        plain = plain and model.get("type", "BPE") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if not plain or any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("only byte-level BPE without normalizer, prefix space, dropout or stripping special tokens is compiled")
        self.tok = Tokenizer.from_file(path)
        special = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.names: dict[int, str] = {i: t for t, i in model["vocab"].items()}
        code = {c: b for b, c in enumerate(byte_alphabet())}
        self.trie: dict[int, int] = {}
        self.ends = [-1]
        parents = set()
        for token, i in model["vocab"].items():
            node = 0
            for b in (code.get(c, -1) for c in token):
                if b < 0:
                    break  # holds a character that no byte has: never made
                child = self.trie.get(node << 8 | b)
                if child is None:
                    child = self.trie[node << 8 | b] = len(self.ends)
                    self.ends.append(-1)
                    parents.add(node)
                node = child
            else:
                self.ends[node] = i
        self.open = [n in parents for n in range(len(self.ends))]
        self.classes = np.full(0x110000, 255, np.uint8)
        for cls, chars in ((STMD, "stmd"), (R, "r"), (V, "v"), (LL, "l"), (E, "e"), (QUOTE, "'"), (SPACE, " ")):
            self.classes[[ord(c) for c in chars]] = cls
        self.slots, self.most = slots, most
        self._restart()

    def _restart(self) -> None:
        self.pairs: dict[tuple[int, int], bool] = {}
        first = ((0, -1, 0),)
        self.states, self.numbers = [first], {first: 0}
        self.known: dict[int, tuple[int, int]] = {}
        self.keys = np.full(self.slots, -1, np.int64)
        self.to, self.adds = np.zeros(self.slots, np.int32), np.zeros(self.slots, np.int8)

    def _renewed(self, held: list[int]) -> list[int]:
        """The table started anew, and the numbers that the held states have in it."""
        contents = [self.states[s] for s in held]
        self._restart()
        for s in contents:
            if s not in self.numbers:
                self.numbers[s] = len(self.states)
                self.states.append(s)
        return [self.numbers[s] for s in contents]

    def _class(self, cps: np.ndarray) -> np.ndarray:
        cls = self.classes[cps]
        if (cls == 255).any():
            for cp in np.unique(cps[cls == 255]).tolist():
                one = lambda edge: len(self.tok.pre_tokenizer.pre_tokenize_str(edge + chr(cp) + edge)) == 1  # noqa: B023, E731
                self.classes[cp] = LETTER if one("a") else NUMBER if one("1") else OTHER if one("!") else WHITE
            cls = self.classes[cps]
        return cls

    def _follows(self, a: int, b: int) -> bool:
        """Do the merges keep the two tokens apart?"""
        if (a, b) not in self.pairs:
            self.pairs[a, b] = [t.id for t in self.tok.model.tokenize(self.names[a] + self.names[b])] == [a, b]
        return self.pairs[a, b]

    def transition(self, state: int, byte: int) -> tuple[int, int]:
        """Next state and tokens added, made when first asked for."""
        got = self.known.get(state << 8 | byte)
        if got is None:
            on, found = [], []
            for node, last, less in self.states[state]:
                child = self.trie.get(node << 8 | byte)
                if child is not None:
                    on.append((child, last, less))
                    if (t := self.ends[child]) >= 0 and (last < 0 or self._follows(last, t)):
                        found.append((t, less + 1))
            if len(found) != 1:
                raise ValueError("the merges do not give each text one encoding")
            token, adds = found[0]
            new = (*((n, last, less - adds) for n, last, less in on if self.open[n]), (0, token, 0))
            number = self.numbers.get(new)
            if number is None:
                number = self.numbers[new] = len(self.states)
                self.states.append(new)
            got = self.known[state << 8 | byte] = (number, adds)
            slot = self._slot(state << 8 | byte)
            while self.keys[slot] >= 0:
                slot = (slot + 1) & (self.slots - 1)
            self.keys[slot], self.to[slot], self.adds[slot] = state << 8 | byte, number, adds
        return got

    def _slot(self, key):
        return (key * 0x9E3779B1 >> 11) & (self.slots - 1)

    def _step(self, state: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = state.astype(np.int64) << 8 | byte
        slot = self._slot(key)
        at = self.keys[slot]
        while True:
            wrong = np.flatnonzero((at != key) & (at >= 0))
            if not len(wrong):
                break
            slot[wrong] = (slot[wrong] + 1) & (self.slots - 1)
            at[wrong] = self.keys[slot[wrong]]
        new = np.flatnonzero(at < 0)
        if len(new):
            uniq, inv = np.unique(key[new], return_inverse=True)
            made = np.array([self.transition(k >> 8, k & 255) for k in uniq.tolist()])
            to, adds = self.to[slot], self.adds[slot].astype(np.int64)
            to[new], adds[new] = made[inv, 0], made[inv, 1]
            return to, adds
        return self.to[slot], self.adds[slot].astype(np.int64)

    def pieces(self, raw: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Tokens of each piece ``raw[start : start + length]``."""
        order = np.argsort(-length, kind="stable")
        start, length = start[order], length[order]
        n = np.searchsorted(-length, -np.arange(1, STEPS + 2), "right")  # pieces of at least so many bytes
        state, count = np.zeros(len(start), np.int32), np.zeros(len(start), np.int64)
        for k in range(STEPS):
            if not n[k]:
                break
            state[: n[k]], adds = self._step(state[: n[k]], raw[start[: n[k]] + k])
            count[: n[k]] += adds
            if len(self.known) > self.most:
                state[: n[k]] = self._renewed(state[: n[k]].tolist())
        state = state[: n[STEPS]].tolist()
        for i in range(len(state)):
            for b in raw[start[i] + STEPS : start[i] + length[i]].tolist():
                state[i], adds = self.transition(state[i], b)
                count[i] += adds
                if len(self.known) > self.most:
                    state[i:] = self._renewed(state[i:])
        out = np.empty_like(count)
        out[order] = count
        return out

    # --- whole texts

    def _block(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; no special ones inside."""
        size = np.array([len(t) for t in texts], np.int64)
        cps = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        raw = np.frombuffer("".join(texts).encode("utf-8"), np.uint8)
        text = np.repeat(np.arange(len(texts)), size)
        place = np.arange(len(cps)) + text
        cls = np.full(len(cps) + len(texts), END, np.uint8)
        cls[place] = self._class(cps)
        width = np.zeros(len(cls) + 1, np.int64)
        width[place + 1] = 1 + (cps > 0x7F).astype(np.int8) + (cps > 0x7FF) + (cps > 0xFFFF)
        at = np.cumsum(width)
        edge = np.flatnonzero(piece_starts(cls) | (cls == END))
        begin = at[edge]
        length = np.diff(np.append(begin, at[-1]))
        real = cls[edge] != END
        owner = np.searchsorted(np.cumsum(size + 1), edge[real], "right")
        return np.bincount(owner, self.pieces(raw, begin[real], length[real]), len(texts)).astype(np.int64)

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of every text."""
        total = np.zeros(len(texts), np.int64)
        owner, parts, held = [], [], 0

        def flush() -> None:
            if parts:
                np.add.at(total, owner, self._block(parts))

        for i, t in enumerate(texts):
            found = [t]
            if self.special and self.special.search(t):
                found = self.special.split(t)
                total[i] += len(found) - 1
            for p in found:
                for part in _blocks(p):
                    owner.append(i)
                    parts.append(part)
                    held += len(part)
                    if held >= BLOCK:
                        flush()
                        owner, parts, held = [], [], 0
        flush()
        return total


_SAFE = re.compile(r"(?<=[0-9A-Za-z]) ")


def _blocks(text: str, most: int = BLOCK) -> Iterator[str]:
    """The text in runs of at least ``most`` characters, cut before a space that begins a piece."""
    lo = 0
    while len(text) - lo > most and (m := _SAFE.search(text, lo + most)):
        yield text[lo : m.start()]
        lo = m.start()
    if lo < len(text):
        yield text[lo:] if lo else text


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One compiled tokenizer per Python worker."""
    return Counter(path)


def _counts(batches: Iterator[pa.RecordBatch], path: str, limit: int) -> Iterator[pa.RecordBatch]:
    machine = counter(path)
    for part, texts in C.slices(batches):
        n = machine.count(texts)
        size = pc.fill_null(pc.binary_length(part.column(1)), 0).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([part.column(0), size, pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])


def token_counts(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Per row: bytes and tokens of the whole text, and whether it has more than ``limit`` tokens."""
    path = tokenizer or default_tokenizer()
    return C.documents(df, id_col, text_col).mapInArrow(lambda it: _counts(it, path, limit), OUT)
