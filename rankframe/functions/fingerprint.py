"""FarmHash's 64-bit fingerprint, as SQL warehouses offer it, on whole Arrow batches.

The function is fixed for all time, so buckets made from it equal those of any other system
that has it.  Spark has no such function, and it cannot be built from Spark's: 64-bit
products have to wrap.  Here every step of the published algorithm is one NumPy operation over
all texts of a batch in the same length class; no text is looked at alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values of the published algorithm
K0 = np.uint64(0xC3A5C85C97CB3127)
K1 = np.uint64(0xB492B66FBE98F273)
K2 = np.uint64(0x9AE16A3B2F90404F)
SEED = np.array([81], np.uint64)


class _Bytes:
    """The concatenated bytes of a batch, read at many places at once."""

    def __init__(self, data: np.ndarray):
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        self._windows = np.lib.stride_tricks.sliding_window_view(padded, 8)

    def u64(self, at: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(self._windows[at]).view("<u8").ravel()

    def u32(self, at: np.ndarray) -> np.ndarray:
        return self.u64(at) & np.uint64(0xFFFFFFFF)

    def u8(self, at: np.ndarray) -> np.ndarray:
        return self._windows[at, 0].astype(np.uint64)


def _turn(value: np.ndarray, bits: int) -> np.ndarray:
    return (value >> np.uint64(bits)) | (value << np.uint64(64 - bits))


def _mix(value: np.ndarray) -> np.ndarray:
    return value ^ (value >> np.uint64(47))


def _join(u: np.ndarray, v: np.ndarray, mul: np.ndarray) -> np.ndarray:
    return _mix((v ^ _mix((u ^ v) * mul)) * mul) * mul


def _upto_3(text: _Bytes, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    size = n.astype(np.uint64)
    low = text.u8(at) + (text.u8(at + n // 2) << np.uint64(8))
    high = size + (text.u8(at + n - 1) << np.uint64(2))
    return _mix(low * K2 ^ high * K0) * K2


def _upto_7(text: _Bytes, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    size = n.astype(np.uint64)
    first = size + (text.u32(at) << np.uint64(3))
    return _join(first, text.u32(at + n - 4), K2 + size * np.uint64(2))


def _upto_16(text: _Bytes, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    mul = K2 + n.astype(np.uint64) * np.uint64(2)
    first, last = text.u64(at) + K2, text.u64(at + n - 8)
    return _join(_turn(last, 37) * mul + first, (_turn(first, 25) + last) * mul, mul)


def _ends(text: _Bytes, at: np.ndarray, n: np.ndarray, factor: np.uint64) -> tuple[np.ndarray, ...]:
    """What the two middle classes share: the first and the last 16 bytes."""
    mul = K2 + n.astype(np.uint64) * np.uint64(2)
    first, second = text.u64(at) * factor, text.u64(at + 8)
    last = text.u64(at + n - 8) * mul
    left = _turn(first + second, 43) + _turn(last, 30) + text.u64(at + n - 16) * K2
    return mul, first, left, _join(left, first + _turn(second + K2, 18) + last, mul)


def _upto_32(text: _Bytes, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    return _ends(text, at, n, K1)[-1]


def _upto_64(text: _Bytes, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    mul, first, left, joined = _ends(text, at, n, K2)
    third, fourth = text.u64(at + 16) * mul, text.u64(at + 24)
    a, b = (left + text.u64(at + n - 32)) * mul, (joined + text.u64(at + n - 24)) * mul
    return _join(
        _turn(third + fourth, 43) + _turn(a, 30) + b, third + _turn(fourth + first, 18) + a, mul
    )


def _weak(text: _Bytes, at: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w, x, y, z = (text.u64(at + 8 * i) for i in range(4))
    a = a + w
    b = _turn(b + a + z, 21)
    total = a + x + y
    return total + z, b + _turn(total, 44) + a


def _block(text: _Bytes, at: np.ndarray, state: np.ndarray, mul: np.ndarray, times: int) -> np.ndarray:
    """Take 64 bytes into ``state``, whose x and z change places; the last block weighs parts of it."""
    x, y, z, v0, v1, w0, w1 = state
    many = np.uint64(times)
    x = _turn(x + y + v0 + text.u64(at + 8), 37) * mul ^ w1 * many
    y = _turn(y + v1 + text.u64(at + 48), 42) * mul + v0 * many + text.u64(at + 40)
    z = _turn(z + w0, 33) * mul
    v = _weak(text, at, v1 * mul, x + w0)
    w = _weak(text, at + 32, z + w1, y + text.u64(at + 16))
    return np.stack([z, y, x, *v, *w])


def _longer(text: _Bytes, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    order = np.argsort(-n, kind="stable")  # so that texts with a further block are a prefix
    at, n = at[order], n[order]
    y = SEED * K1 + np.uint64(113)
    z = _mix(y * K2 + np.uint64(113)) * K2
    state = np.zeros((7, len(n)), np.uint64)
    state[0], state[1], state[2] = SEED * K2 + text.u64(at), y, z
    blocks = (n - 1) // 64
    for i in range(int(blocks[0])):
        k = int(np.searchsorted(-blocks, -i, "left"))  # blocks > i
        state[:, :k] = _block(text, at[:k] + 64 * i, state[:, :k], K1, 1)
    rest = ((n - 1) % 64).astype(np.uint64)
    mul = K1 + ((state[2] & np.uint64(0xFF)) << np.uint64(1))
    state[5] += rest
    state[3] += state[5]
    state[5] += state[3]
    x, y, z, v0, v1, w0, w1 = _block(text, at + n - 64, state, mul, 9)
    hashed = np.empty(len(n), np.uint64)
    hashed[order] = _join(_join(v0, w0, mul) + _mix(y) * K0 + z, _join(v1, w1, mul) + x, mul)
    return hashed


# longest text of a class, in bytes
_CLASSES = ((3, _upto_3), (7, _upto_7), (16, _upto_16), (32, _upto_32), (64, _upto_64), (None, _longer))


def fingerprints(texts: pa.Array) -> pa.Array:
    """Signed 64-bit fingerprint of the UTF-8 bytes of each text; null of null."""
    plain = texts.cast(pa.large_binary())
    _, offsets, data = plain.buffers()
    ends = np.frombuffer(offsets, np.int64)[plain.offset : plain.offset + len(plain) + 1]
    at, n = ends[:-1] - ends[0], np.diff(ends)
    own = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.zeros(0, np.uint8)
    text, out, shorter = _Bytes(own), np.full(len(n), K2), 0
    for longest, compute in _CLASSES:
        member = np.flatnonzero((n > shorter) & (n <= longest) if longest else n > shorter)
        if member.size:
            out[member] = compute(text, at[member], n[member])
        shorter = longest
    return pa.array(out.view(np.int64), mask=plain.is_null().to_numpy(zero_copy_only=False))


def farm_fingerprint(text: Column) -> Column:
    """The fingerprint as a long column, computed in Arrow batches."""
    return F.arrow_udf(fingerprints, "long")(text.cast("string"))
