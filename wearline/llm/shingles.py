"""Word shingles of whole texts, hashed with numpy over Arrow string buffers.

Texts are lower-cased (A-Z), cut into words of ``[^\\x20\\x09-\\x0D]+`` and hashed to
64 bits per 5-word shingle; a text of 1 to 4 words is one shingle, a blank one has
none. Work goes in blocks of whole texts of about ``BLOCK_BYTES``, so memory follows the
longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WIDTH = 5
BLOCK_BYTES = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser (bijective); ``salt`` gives independent hashes."""
    with np.errstate(over="ignore"):
        z = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        p = np.full(max(n, 2 * len(_POWERS)), _BASE, np.uint64)
        p[0] = 1
        _POWERS = np.cumprod(p, dtype=np.uint64)
    return _POWERS


def blocks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, one past the last, bytes, offsets) of runs of whole texts; nulls are empty."""
    if len(texts) == 0:
        return
    if texts.null_count:
        texts = texts.fill_null("")
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    off = np.frombuffer(texts.buffers()[1], width)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    buf = texts.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + BLOCK_BYTES, "right")) - 1)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def _words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every word of a block."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    low = data + np.where((data >= 65) & (data <= 90), np.uint8(32), np.uint8(0))
    gap = (low == 32) | ((low >= 9) & (low <= 13))
    first = np.zeros(len(data) + 1, bool)
    first[off[:-1]] = True
    after = np.empty(len(data), bool)
    after[0], after[1:] = True, gap[:-1]
    starts = np.flatnonzero(~gap & (after | first[:-1]))
    if len(starts) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data)))) if starts[0] == 0 else \
        np.concatenate([np.zeros(starts[0], np.int64),
                        np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))])
    with np.errstate(over="ignore"):
        value = np.where(gap, np.uint64(0), (low.astype(np.uint64) + np.uint64(1)) * _powers(int(place.max()) + 1)[place])
    return np.searchsorted(off[:-1], starts, "right") - 1, mix(np.add.reduceat(value, starts))


def shingle_sets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of the distinct shingles of a block, sorted by both."""
    doc, word = _words(data, off)
    n = np.bincount(doc, minlength=len(off) - 1)
    first = np.concatenate([[0], np.cumsum(n)])[:-1]
    out_doc, out = [], []
    with np.errstate(over="ignore"):
        if len(word) >= WIDTH:
            s = word[:len(word) - WIDTH + 1].copy()
            for j in range(1, WIDTH):
                s = s * _BASE + word[j:len(word) - WIDTH + 1 + j]
            whole = doc[:len(s)] == doc[WIDTH - 1:]
            out_doc.append(doc[:len(s)][whole])
            out.append(mix(s[whole], WIDTH))
        for k in range(1, WIDTH):
            short = np.flatnonzero(n == k)
            if len(short):
                s = word[first[short]].copy()
                for j in range(1, k):
                    s = s * _BASE + word[first[short] + j]
                out_doc.append(short)
                out.append(mix(s, k))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    doc, s = np.concatenate(out_doc), np.concatenate(out)
    order = np.lexsort((s, doc))
    doc, s = doc[order], s[order]
    new = np.ones(len(s), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (s[1:] != s[:-1])
    return doc[new], s[new]


def sums(values: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
    """Sum of 64-bit values by slot, modulo 2**64 (exact in two 32-bit halves)."""
    low = np.bincount(slot, (values & np.uint64(0xFFFFFFFF)).astype(np.float64), n)
    high = np.bincount(slot, (values >> np.uint64(32)).astype(np.float64), n)
    with np.errstate(over="ignore"):
        return low.astype(np.uint64) + (high.astype(np.uint64) << np.uint64(32))
