"""Vectorised 64-bit hashes of word sequences.

Words are the runs of bytes between ASCII white space, which is exactly
``[^\\x20\\x09-\\x0D]+`` on UTF-8 text.  They are joined by one space, and any
run of consecutive words is then one byte range, whose hash comes from two
prefix sums of a polynomial modulo 2**64 and a final mix.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self):
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = 1 << (n - 1).bit_length()
            with np.errstate(over="ignore"):
                for name, base in (("up", _BASE), ("down", _INVERSE)):
                    a = np.full(size, base, np.uint64)
                    a[0] = 1
                    setattr(self, name, np.multiply.accumulate(a))
        return self.up[:n], self.down[:n]


def normalise(text: str | None, lower: bool = False) -> bytes:
    """The words of a text joined by one space; null gives no words.  ``lower`` maps A-Z only."""
    raw = b"" if text is None else text.encode("utf-8", "surrogatepass")
    return b" ".join((raw.lower() if lower else raw).split())


def window_hashes(norm: bytes, k: int, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hashes, starts, ends)``: one hash per run of k words, and the byte range of every word.

    With fewer than k words (but at least one) there is no hash.
    """
    arr = np.frombuffer(norm, np.uint8)
    if not len(arr):
        e = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), e, e
    gaps = np.flatnonzero(arr == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.concatenate((gaps, [len(arr)]))
    if len(starts) < k:
        return np.zeros(0, np.uint64), starts, ends
    up, down = powers.upto(len(arr) + 1)
    with np.errstate(over="ignore"):
        total = np.empty(len(arr) + 1, np.uint64)
        total[0] = 0
        # 1 is added to each byte so that leading zero bytes count
        np.cumsum((arr.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
        s, e = starts[: len(starts) - k + 1], ends[k - 1:]
        return mix64((total[e] - total[s]) * down[s]), starts, ends


def range_hash(norm: bytes, powers: Powers) -> np.uint64:
    """Hash of a whole normalised text, for texts with fewer words than a window."""
    arr = np.frombuffer(norm, np.uint8)
    up, _ = powers.upto(len(arr) + 1)
    with np.errstate(over="ignore"):
        return mix64(np.array([((arr.astype(np.uint64) + np.uint64(1)) * up[:-1]).sum(dtype=np.uint64)]))[0]
