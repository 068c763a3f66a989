"""Postings cut by hash range into fragments, packed as one row per (slice of documents, fragment)."""

from __future__ import annotations

import numpy as np


def fragment_bits(items: int, per_fragment: int, least: int = 16) -> int:
    """log2 of the number of fragments that hold about ``per_fragment`` items each."""
    return max(least - 1, -(-items // per_fragment) - 1, 1).bit_length()


def pack40(x: np.ndarray) -> bytes:
    """The low 40 bits of each value."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def unpack40(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(b, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def pack_planes(x: np.ndarray) -> bytes:
    """Values under 2**32, the lower halves before the upper ones: mostly zeros, which compress away."""
    return np.ascontiguousarray(x.astype("<u4").view("<u2").reshape(-1, 2).T).tobytes()


def unpack_planes(b: bytes) -> np.ndarray:
    low, high = np.frombuffer(b, "<u2").reshape(2, -1).astype(np.int64)
    return low | high << 16


def pack_steps(sorted_keys: np.ndarray) -> bytes:
    """Ascending keys as 16-bit steps; 65535 stands for a step without a key."""
    step = np.diff(sorted_keys.astype(np.int64), prepend=0)
    over = step // 65535
    out = np.full(len(step) + int(over.sum()), 65535, "<u2")
    out[np.arange(len(step)) + np.cumsum(over)] = step % 65535
    return out.tobytes()


def unpack_steps(b: bytes) -> np.ndarray:
    step = np.frombuffer(b, "<u2").astype(np.int64)
    return np.cumsum(step)[step != 65535]


def cuts(sorted_hashes: np.ndarray, bits: int) -> np.ndarray:
    """Where each of the ``2**bits`` ranges begins in ascending 64-bit hashes (and the end)."""
    first = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.append(np.searchsorted(sorted_hashes, first, "left"), len(sorted_hashes))


def runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal keys."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    return start, np.diff(np.append(start, len(sorted_keys)))
