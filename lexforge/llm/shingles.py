"""Word shingles of whole texts as sorted 64-bit hashes, for a batch of texts at a time in numpy."""

from __future__ import annotations

import numpy as np

_B = np.uint64(0x9E3779B97F4A7C15 | 1)
_BINV = np.uint64(pow(int(_B), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LETTER = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i modulo 2**64 for i below n, kept in the worker."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_B, _BINV)):
            x = np.full(max(n, 1 << 16), base, np.uint64)
            x[0] = 1
            with np.errstate(over="ignore"):
                _powers[k] = np.multiply.accumulate(x)
    return _powers[0][:n], _powers[1][:n]


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte range; equal ranges have equal hashes wherever they lie."""
    up, down = powers(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_LETTER[data] * up[: len(data)], out=total[1:])
        return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def _some(texts: list[bytes], k: int) -> list[np.ndarray]:
    data = np.frombuffer(b" ".join([*texts, b""]).lower(), np.uint8)
    owner_end = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))
    space = _SPACE[data]
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    words = range_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    first = np.searchsorted(starts, np.concatenate(([0], owner_end)))
    out = []
    with np.errstate(over="ignore"):
        odd = [mixed(np.array([j + 11], np.uint64))[0] | np.uint64(1) for j in range(k)]
        if len(words) >= k:
            many = len(words) - k + 1
            grams = mixed(sum(words[j : j + many] * odd[j] for j in range(k)))
        for a, z in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if z - a >= k:
                out.append(np.unique(grams[a : z - k + 1]))
            elif z > a:
                out.append(mixed((words[a:z] * np.array(odd[: z - a])).sum(keepdims=True) + np.uint64(z - a)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the k-word shingles of each text (A-Z lower-cased, words cut at ASCII white space).

    A text with fewer words has its whole sequence as one; without words, or null, it has none.
    """
    out, some, size = [], [], 0
    for t in texts:
        raw = (t or "").encode()
        some.append(raw)
        size += len(raw)
        if size > 1_000_000:
            out += _some(some, k)
            some, size = [], 0
    return out + (_some(some, k) if some else [])
