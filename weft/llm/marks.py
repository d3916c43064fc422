"""A bitmap over hashed keys, of bounded size: it says which keys may be among some others."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bits per key, and bits at most (16 MB); a run of bits is what one row holds.
EACH, MOST, RUN = 16, 1 << 27, 15


def size(n: int) -> int:
    """Bits for n keys, a power of two."""
    bits = 1 << RUN
    while bits < min(EACH * n, MOST):
        bits *= 2
    return bits


def together(table: pa.Table, bits: int) -> bytes:
    """The bitmap from its runs (run, bits)."""
    out = np.zeros((bits >> RUN, 1 << (RUN - 3)), np.uint8)
    for run, own in zip(table.column("run").to_pylist(), table.column("bits")):
        out[run] = np.frombuffer(own.as_buffer(), np.uint8)
    return out.tobytes()


def found(marks: bytes, at: np.ndarray) -> np.ndarray:
    """Which of these places are marked."""
    return (np.frombuffer(marks, np.uint8)[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
