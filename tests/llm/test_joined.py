"""Numbers joined as bits, against the bits written one by one."""

import numpy as np

from landseries.llm import webp


def test_numbers_joined_as_bits():
    rng = np.random.default_rng(2)
    for rows, columns in ((1, 1), (3, 4), (500, 4), (129, 3)):
        bits = rng.integers(0, 16, (rows, columns))
        value = rng.integers(0, 1 << 15, (rows, columns)) & ((1 << bits) - 1)
        expected = [v >> k & 1 for v, n in zip(value.ravel().tolist(), bits.ravel().tolist(), strict=True) for k in range(n)]
        assert webp.joined(value, bits).tolist() == expected
    assert len(webp.joined(np.zeros((5, 1), np.int64), np.zeros((5, 1), np.int64))) == 0
    full = np.full((4, 4), 0xFFFF), np.full((4, 4), 16)
    assert webp.joined(*full).tolist() == [1] * 256
