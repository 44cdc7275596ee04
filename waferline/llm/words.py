"""Words of many texts at once: positions, 64-bit hashes, shingles.

A word's hash is its polynomial over the bytes modulo two primes below 2**31, taken from running sums, and
mixed at the end. Polynomials modulo a power of two would not do: words of the Thue-Morse sequence share
their value for every base. Two different words of n bytes share a hash for at most n**2 in 2**62 of all
bases. A shingle combines the mixed hashes of its words modulo 2**64.
"""

from __future__ import annotations

import numpy as np

#: Fixed: the bytes that part words, `[\x20\x09-\x0D]`.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
#: Bytes hashed at a time; longer words are hashed piece by piece. Tables and running sums have this size.
_CHUNK = 1 << 17
_LONGEST = 1 << 17
#: The two largest primes below 2**31, each with a base.
_PRIMES = ((2147483647, 1_203_478_921), (2147483629, 811_596_743))
_tables: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    if "up" not in _tables or len(_tables["up"]) < n:
        size = max(n, _CHUNK + 1024)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, _U)
            steps[0] = 1
            _tables[name] = np.cumprod(steps, dtype=_U)
    return _tables["up"], _tables["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def spans(data: np.ndarray, bounds: np.ndarray, apart: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and for each row the number of words before it (one more entry than rows).

    Words never cross rows. ``apart`` marks the bytes that part words.
    """
    inside = ~apart[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = np.unique(bounds[1:-1])
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def _prime_powers(n: int) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each prime: itself, its base, and at least ``n`` powers of the base and of its inverse."""
    if "primes" not in _tables or len(_tables["primes"][0][2]) < n:
        _tables["primes"] = []
        for prime, base in _PRIMES:
            both = []
            for b in (base, pow(base, -1, prime)):
                table = np.ones(1, _U)
                while len(table) < max(n, _CHUNK + 1024):
                    table = np.concatenate([table, table * _U(pow(b, len(table), prime)) % _U(prime)])
                both.append(table)
            _tables["primes"].append((prime, base, *both))
    return _tables["primes"]


def raw_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ``data[start:end]`` for sorted starts; chunk by chunk, so that memory stays small.

    A running sum stays below 2**64 over ``_LONGEST`` bytes; a longer word is summed piece by piece.
    """
    out = np.zeros(len(starts), _U)
    longer = np.flatnonzero(ends - starts > _LONGEST)
    plain = np.flatnonzero(ends - starts <= _LONGEST) if len(longer) else np.arange(len(starts))
    begins, low = starts[plain] if len(longer) else starts, 0
    while low < len(plain):
        first = begins[low]
        high = max(low + 1, int(np.searchsorted(begins, first + _CHUNK)))
        own = plain[low:high]
        base, top = int(first), int(ends[own].max())
        values = data[base:top].astype(_U) + _U(1)
        s, e = starts[own] - base, ends[own] - base
        sums = np.zeros(top - base + 1, _U)
        for k, (prime, _, up, down) in enumerate(_prime_powers(top - base + 1)):
            np.cumsum(values * up[: top - base], out=sums[1:])
            out[own] |= ((sums[e] - sums[s]) % _U(prime) * down[s] % _U(prime)) << _U(31 * k)
        low = high
    for i in longer.tolist():
        for k, (prime, base, up, _) in enumerate(_prime_powers(_CHUNK)):
            total = 0
            for at in range(int(starts[i]), int(ends[i]), _CHUNK):
                part = data[at : min(at + _CHUNK, int(ends[i]))].astype(_U) + _U(1)
                total += int((part * up[: len(part)] % _U(prime)).sum()) * pow(base, at - int(starts[i]), prime)
            out[i] |= _U(total % prime) << _U(31 * k)
    return out


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix(raw_hashes(data, starts, ends) + (ends - starts).astype(_U))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words of one text; a shorter text gives its whole sequence, no word gives none."""
    n = len(words)
    if n == 0:
        return np.empty(0, _U)
    length = min(size, n)
    up, _ = powers(size + 1)
    total = np.zeros(n - length + 1, _U)
    for i in range(length):
        total += words[i : n - length + 1 + i] * up[i + 1]
    return mix(total + _U(length))


def shingle_runs(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of many texts in one go: the hashes, and the bounds of each text's stretch.

    ``counts`` are the texts' bounds in ``words``.
    """
    n = np.diff(counts)
    kept = np.where(n == 0, 0, np.maximum(n - size + 1, 1))
    bounds = np.concatenate([[0], np.cumsum(kept)])
    out = np.empty(bounds[-1], _U)
    up, _ = powers(size + 1)
    whole = np.flatnonzero(n >= size)
    if len(whole):
        total = np.zeros(max(len(words) - size + 1, 0), _U)
        for i in range(size):
            total += words[i : len(words) - size + 1 + i] * up[i + 1]
        total = mix(total + _U(size))
        starts = np.repeat(counts[whole] - bounds[whole], kept[whole])
        places = np.repeat(bounds[whole] - np.concatenate([[0], np.cumsum(kept[whole])[:-1]]), kept[whole]) + np.arange(len(starts))
        out[places] = total[places + starts]
    for i in np.flatnonzero((n > 0) & (n < size)):
        out[bounds[i]] = shingles(words[counts[i] : counts[i + 1]], size)[0]
    return out, bounds


def distinct_sets(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each stretch sorted and without repeats."""
    values = values.copy()
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    firsts = bounds[:-1][bounds[:-1] < bounds[1:]]
    keep[firsts] = True
    return values[keep], np.concatenate([[0], np.cumsum(keep)])[bounds]


def text_sets(data: np.ndarray, bounds: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The distinct word shingles of each text, sorted; A-Z count as a-z."""
    low = LOWER[data]
    starts, ends, counts = spans(low, bounds)
    return distinct_sets(*shingle_runs(word_hashes(low, starts, ends), counts, size))
