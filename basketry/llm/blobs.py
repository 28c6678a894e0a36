"""Rising whole numbers packed for a shuffle as gaps of two or four bytes."""

from __future__ import annotations

import numpy as np


def pack(values: np.ndarray, kind: str) -> bytes:
    """``values`` rise; a gap that doesn't fit takes several full entries first."""
    full = np.iinfo(kind).max
    gaps = np.diff(values.astype(np.int64), prepend=0)
    carries, rest = gaps // full, gaps % full
    if not carries.any():
        return rest.astype(kind).tobytes()
    out = np.full(int(carries.sum()) + len(gaps), full, kind)
    out[np.cumsum(carries + 1) - 1] = rest
    return out.tobytes()


def unpack(data: bytes, kind: str) -> np.ndarray:
    gaps = np.frombuffer(data, kind)
    return np.cumsum(gaps, dtype=np.int64)[gaps != np.iinfo(kind).max]
