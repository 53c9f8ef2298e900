"""Words of many texts at once, as numpy arrays of spans and 64-bit hashes."""

from __future__ import annotations

import numpy as np

#: ASCII white space: \x20 and \x09-\x0D.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: int = BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of a byte array."""
    gap = SPACE[raw]
    edge = np.diff(gap.astype(np.int8), prepend=1, append=1)
    starts, ends = np.nonzero(edge == -1)[0], np.nonzero(edge == 1)[0]
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(len(raw)), out=sums[1:])
    shift = powers(len(raw) + 1, pow(BASE, -1, 1 << 64))[starts]
    return starts, ends, mix((sums[ends] - sums[starts]) * shift)


def batches_of(texts: list[bytes], limit: int = 1 << 20):
    """Runs (first, last) of texts of about `limit` bytes together; a longer text is alone."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield at, i
            at, size = i, 0
        size += len(t) + 1
    if at < len(texts):
        yield at, len(texts)


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of texts in order, and the number of words of each text."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    starts, _, hashes = word_hashes(raw)
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    return hashes, np.diff(np.searchsorted(starts, offsets))
