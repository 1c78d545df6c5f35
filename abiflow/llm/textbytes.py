"""Words of many texts at once, as numpy arrays over the UTF-8 bytes.

Python operators get Arrow batches; the helpers here cut a batch into runs
of whole documents of about ``CHUNK_BYTES`` (a longer document is a run of
its own), find words and hash them without a Python loop over words.  Word
separators are ASCII, so bytes and code points agree on the boundaries.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_GAMMA = U64(0xD6E8FEB86659FD93)


class Chunk(NamedTuple):
    """Documents ``lo``..``hi`` of a batch: their bytes, and where each
    begins and ends in them."""

    lo: int
    hi: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Runs of whole documents; a null text is empty."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32) if buffers[1] else np.zeros(1, np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        hi = min(hi, len(texts))
        yield Chunk(lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo:hi] - offsets[lo], offsets[lo + 1 : hi + 1] - offsets[lo])
        lo = hi


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> U64(32))
    h = h * _GAMMA
    h = h ^ (h >> U64(32))
    h = h * _GAMMA
    return h ^ (h >> U64(32))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, grown by doubling."""
    have = _POWERS.get(base)
    if have is None:
        have = np.ones(1, U64)
    while len(have) < n:
        have = np.concatenate([have, have * U64(pow(base, len(have), 1 << 64))])
    _POWERS[base] = have
    return have[:n]


def spans(chunk: Chunk, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a chunk, and for each document the
    number of words before it (one more entry: all words).  ``separator``
    says for each byte value whether it ends a word."""
    inside = ~separator[chunk.data]
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    filled = chunk.ends > chunk.starts
    before[chunk.starts[filled]] = False
    after[chunk.ends[filled] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.append(np.searchsorted(starts, chunk.starts), len(starts))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each span of bytes: a polynomial in the bytes,
    taken from prefix sums, then mixed with the length."""
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * _powers(_BASE, len(data)), out=sums[1:])
    inverse = _powers(_INVERSE, len(data) + 1)
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(h ^ ((ends - starts).astype(U64) << U64(40)))


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams of a word hash sequence, by first word."""
    if len(words) < n:
        return np.zeros(0, U64)
    h = words[: len(words) - n + 1]
    for k in range(1, n):
        h = mix(h * U64(0xC2B2AE3D27D4EB4F) + words[k : len(words) - n + 1 + k])
    return h


def table(*ranges: str) -> np.ndarray:
    """A 256-entry truth table of single bytes."""
    out = np.zeros(256, bool)
    for r in ranges:
        out[ord(r[0]) : ord(r[-1]) + 1] = True
    return out


WHITE_SPACE = table(" ", "\t\r")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
