"""64-bit digests of the words of many texts at once, in numpy.

Each byte stands for a random 64-bit number; a word's digest is the sum of its bytes'
numbers times powers of an odd base, from prefix sums modulo 2^64, mixed at the end.
"""

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_BYTES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_powers = {}


def _power_table(base, n):
    """base^0 … base^(n-1) modulo 2^64; kept and grown as needed."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 20), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mixed(x):
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_digests(texts):
    """(digests, ends): of the words of all texts, and where each text's words end.

    `texts` are bytes in which words are separated by spaces only.
    """
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    n = len(data)
    inside = np.zeros(n + 1, bool)
    inside[1:] = data != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, stops = edges[::2], edges[1::2]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[data] * _power_table(_BASE, n), out=sums[1:], dtype=np.uint64)
    raw = (sums[stops] - sums[starts]) * _power_table(_INVERSE, n)[starts]
    digests = mixed(raw + (stops - starts).astype(np.uint64))
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    return digests, np.searchsorted(starts, text_ends)


_GRAM = [np.uint64(pow(0xD1B54A32D192ED03, k + 1, 2**64)) for k in range(64)]


def grams(digests, size):
    """Digests of all runs of `size` words."""
    n = len(digests) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += digests[k : k + n] * _GRAM[k]
    return mixed(total + np.uint64(size))
