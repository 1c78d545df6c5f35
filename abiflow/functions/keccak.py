"""Keccak-256 (the pre-standard padding used for event hashes), vectorised.

Spark has no keccak (``sha2`` is SHA-2, and SHA3-256 pads differently), so
the hash is a pandas UDF.  Each Arrow batch of messages is hashed with numpy
lanes: all messages needing the same number of rate blocks are permuted
together as one ``(n, 25)`` uint64 state, so the Python overhead is per
batch and per round, not per row.

The permutation constants (rotation offsets, round constants) are derived
from their defining rules in FIPS 202 rather than written out.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The UDF below is the only Python that runs on executors.  Ship this module
# by value with it, so workers need numpy and pandas but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RATE = 136  # bytes, for a 256-bit output (capacity 512)
ROUNDS = 24


def _rotation_offsets() -> np.ndarray:
    r = np.zeros(25, dtype=np.uint64)
    x, y = 1, 0
    for t in range(24):
        r[x + 5 * y] = ((t + 1) * (t + 2) // 2) % 64
        x, y = y, (2 * x + 3 * y) % 5
    return r


def _rc_bit(t: int) -> int:
    if t % 255 == 0:
        return 1
    reg = [1, 0, 0, 0, 0, 0, 0, 0]
    for _ in range(t % 255):
        reg = [0] + reg
        for k in (0, 4, 5, 6):
            reg[k] ^= reg[8]
        reg = reg[:8]
    return reg[0]


def _round_constants() -> np.ndarray:
    out = []
    for ir in range(ROUNDS):
        c = 0
        for j in range(7):
            if _rc_bit(j + 7 * ir):
                c |= 1 << ((1 << j) - 1)
        out.append(c)
    return np.array(out, dtype=np.uint64)


_ROT = _rotation_offsets()
_RC = _round_constants()
# pi step: lane (x, y) moves to (y, 2x + 3y)
_PI_SRC = np.zeros(25, dtype=np.int64)
for _x in range(5):
    for _y in range(5):
        _PI_SRC[_y + 5 * ((2 * _x + 3 * _y) % 5)] = _x + 5 * _y
_X = np.arange(25) % 5
_Y = np.arange(25) // 5
_CHI1 = ((_X + 1) % 5) + 5 * _Y
_CHI2 = ((_X + 2) % 5) + 5 * _Y
_U64_1 = np.uint64(1)
_U64_63 = np.uint64(63)


def _rotl(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Rotate each column of ``a`` (n, k) left by the matching entry of r (k,)."""
    safe = np.where(r == 0, np.uint64(64), r)
    left = np.left_shift(a, r)
    right = np.where(r == 0, np.uint64(0), np.right_shift(a, np.uint64(64) - safe))
    return left | right


def keccak_f(state: np.ndarray) -> np.ndarray:
    """Keccak-f[1600] over a batch of states, shape (n, 25), lane x + 5y."""
    a = state
    for rnd in range(ROUNDS):
        c = a[:, 0:5] ^ a[:, 5:10] ^ a[:, 10:15] ^ a[:, 15:20] ^ a[:, 20:25]
        c_rot = (c << _U64_1) | (c >> _U64_63)
        d = np.roll(c, 1, axis=1) ^ np.roll(c_rot, -1, axis=1)
        a = a ^ np.tile(d, 5)
        b = _rotl(a, _ROT)[:, _PI_SRC]
        a = b ^ (~b[:, _CHI1] & b[:, _CHI2])
        a[:, 0] ^= _RC[rnd]
    return a


def _sponge(messages: list[bytes], pad_byte: int) -> list[bytes]:
    out: list[bytes | None] = [None] * len(messages)
    nblocks = np.array([len(m) // RATE + 1 for m in messages], dtype=np.int64)
    for nb in np.unique(nblocks):
        idx = np.nonzero(nblocks == nb)[0]
        width = int(nb) * RATE
        buf = np.zeros((len(idx), width), dtype=np.uint8)
        for row, i in enumerate(idx):
            m = messages[i]
            buf[row, : len(m)] = np.frombuffer(m, dtype=np.uint8)
            buf[row, len(m)] ^= pad_byte
        buf[:, width - 1] ^= 0x80
        lanes = buf.view("<u8").astype(np.uint64)
        state = np.zeros((len(idx), 25), dtype=np.uint64)
        for blk in range(int(nb)):
            state[:, : RATE // 8] ^= lanes[:, blk * (RATE // 8) : (blk + 1) * (RATE // 8)]
            state = keccak_f(state)
        digest = np.ascontiguousarray(state[:, :4]).astype("<u8").view(np.uint8).reshape(len(idx), 32)
        for row, i in enumerate(idx):
            out[i] = digest[row].tobytes()
    return out


def keccak256(messages: list[bytes]) -> list[bytes]:
    """Keccak-256 with the original 0x01 domain padding."""
    return _sponge(messages, 0x01)


def sha3_256(messages: list[bytes]) -> list[bytes]:
    """FIPS 202 SHA3-256 (0x06 padding); same permutation, used to test it."""
    return _sponge(messages, 0x06)


def _keccak256_hex(text: pd.Series) -> pd.Series:
    """keccak-256 of the UTF-8 bytes of each string, as 64 lowercase hex digits."""
    mask = text.notna().to_numpy()
    result = pd.Series([None] * len(text), index=text.index, dtype=object)
    if mask.any():
        msgs = [s.encode("utf-8") for s in text[mask]]
        result[mask] = [d.hex() for d in keccak256(msgs)]
    return result


# Marked non-deterministic only so the optimizer evaluates it once: filters
# it infers on the hash (e.g. a join's ``IS NOT NULL``) are not pushed below
# the projection that computes it, which would hash every signature twice.
keccak256_hex = F.pandas_udf(_keccak256_hex, T.StringType()).asNondeterministic()
