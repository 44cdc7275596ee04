"""Suffix arrays and common prefixes by induced sorting, with queues on disk.

The text is cut at its left-most-S positions (LMS). The suffixes that start there are sorted by naming the
stretches between them and sorting the shorter text of names, by this same algorithm while that text is
large, in memory once it is small. All other suffixes are then induced in two scans: in the order in which
suffixes come out, each hands the one before it to the queue of that one's first character, together with
the prefix it shares with the last one handed there. As suffixes come out in order, a queue per character
that keeps its own order is a priority queue over (character, rank). Queues live on disk beyond a small
buffer, and a text may be a memory-mapped file. The LMS positions of a text, their names, order and shared
prefixes are arrays in memory, some 40 bytes for each byte of text in all (README), and grow with the text.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

#: Texts of names up to this length are sorted in memory.
BASE = 1 << 22
#: Tuples that a queue passes on at once, and that it holds before it goes to disk.
CHUNK = 1 << 18


class Queue:
    """First in, first out, of (position, shared prefix) tuples; on disk beyond ``CHUNK`` tuples."""

    def __init__(self, folder: str, spill: int):
        self.folder, self.spill, self.parts, self.held, self.file, self.stored = folder, spill, [], 0, None, 0

    def push(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.parts.append(np.stack([pos, lcp], axis=1))
        self.held += len(pos)
        if self.held > self.spill:
            if self.file is None:
                self.file = tempfile.TemporaryFile(dir=self.folder)
            for part in self.parts:
                self.stored += len(part)
                part.tofile(self.file)
            self.parts, self.held = [], 0

    def drain(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All tuples in order, in chunks; the queue may not grow meanwhile."""
        if self.file is not None:
            self.file.seek(0)
            for low in range(0, self.stored, CHUNK):
                rows = np.fromfile(self.file, np.int64, 2 * min(CHUNK, self.stored - low)).reshape(-1, 2)
                yield rows[:, 0], rows[:, 1]
            self.file.close()
            self.file, self.stored = None, 0
        if self.parts:
            rows = np.concatenate(self.parts)
            self.parts, self.held = [], 0
            yield rows[:, 0], rows[:, 1]

    def backwards(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All tuples in reverse; a tuple's prefix is then the one shared with the tuple before it in this order."""
        after = 0
        chunks = [np.concatenate(self.parts)] if self.parts else []
        self.parts, self.held = [], 0
        for low in [None] * bool(chunks) + list(range(0, self.stored, CHUNK))[::-1]:
            if low is None:
                rows = chunks[0]
            else:
                self.file.seek(16 * low)
                rows = np.fromfile(self.file, np.int64, 2 * min(CHUNK, self.stored - low)).reshape(-1, 2)
            pos, lcp = rows[::-1, 0], np.concatenate([[after], rows[:0:-1, 1]])
            after = rows[0, 1]
            yield pos, lcp
        if self.file is not None:
            self.file.close()
            self.file, self.stored = None, 0


def _kinds(part: np.ndarray, last: bool) -> np.ndarray:
    """True where a suffix is smaller than the next one, for a stretch whose last character has kind ``last``."""
    step = np.sign(part[1:].astype(np.int64) - part[:-1].astype(np.int64))
    place = np.where(step != 0, np.arange(len(step)), len(step))
    place = np.minimum.accumulate(place[::-1])[::-1]
    out = np.full(len(part), last)
    inner = place < len(step)
    out[:-1][inner] = step[place[inner]] > 0
    return out


def lms_positions(text: np.ndarray) -> np.ndarray:
    """Positions whose suffix is smaller than the next, while the one before is not; stretch by stretch from the right."""
    found, high, last = [], len(text) - 1, True
    while high > 0:
        low = max(0, high - CHUNK)
        kinds = _kinds(np.asarray(text[low : high + 1]), last)
        found.append(low + 1 + np.flatnonzero(kinds[1:] & ~kinds[:-1]))
        high, last = low, bool(kinds[0])
    return np.concatenate(found[::-1]) if found else np.empty(0, np.int64)


def _names(text: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Ranks of the stretches from each LMS position through the next; one that goes on is less than one that ends."""
    ends = np.append(lms[1:], lms[-1])
    rank = np.zeros(len(lms), np.int64)
    open_, depth = np.arange(len(lms)), 0
    big = np.uint64(2**32 - 1)
    while len(open_):
        at = lms[open_] + depth
        key = np.zeros(len(open_), np.uint64)
        for i in range(2):  # two characters of 32 bits a round
            inside = at + i <= ends[open_]
            char = np.full(len(open_), big, np.uint64)
            char[inside] = text[at[inside] + i].astype(np.uint64)
            key = (key << np.uint64(32)) | char
        order = np.lexsort((key, rank[open_]))
        r, k = rank[open_][order], key[order]
        new = np.concatenate([[True], (r[1:] != r[:-1]) | (k[1:] != k[:-1])])
        group_start = np.concatenate([[True], r[1:] != r[:-1]])
        first = np.maximum.accumulate(np.where(group_start, np.arange(len(r)), 0))
        place = np.maximum.accumulate(np.where(new, np.arange(len(r)), 0))
        rank[open_[order]] = r + place - first
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(r)))
        over = lms[open_[order]] + depth + 2 > ends[open_[order]]
        settled = np.repeat((sizes == 1) | np.logical_and.reduceat(over, starts), sizes)
        open_, depth = np.sort(open_[order][~settled]), depth + 2
    return np.unique(rank, return_inverse=True)[1]


def _sort_in_memory(names: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array of a text of names by doubling; suffixes that agree over ``depth`` names may come in any order."""
    n, width, rank = len(names), 1, names.astype(np.int64)
    while True:
        nxt = np.zeros(n, np.int64)
        if width < n:
            nxt[:-width] = rank[width:] + 1
        order = np.argsort(rank * (int(nxt.max()) + 1) + nxt)
        r, x = rank[order], nxt[order]
        new = np.concatenate([[0], (r[1:] != r[:-1]) | (x[1:] != x[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        width *= 2
        if rank[order[-1]] == n - 1 or width >= n or width >= depth:
            return order


def shared_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Lengths of the common prefixes of the suffixes at ``a`` and ``b``, up to ``limit``."""
    out = np.zeros(len(a), np.int64)
    open_ = np.arange(len(a))
    for depth in range(limit):
        i, j = a[open_] + depth, b[open_] + depth
        ok = (i < len(text)) & (j < len(text))
        open_ = open_[ok]
        open_ = open_[text[i[ok]] == text[j[ok]]]
        if not len(open_):
            break
        out[open_] = depth + 1
    return out


class _Scan:
    """Hands predecessors to the queues of their first characters, with the prefixes they share."""

    def __init__(self, text, queues, limit):
        self.text, self.queues, self.limit = text, queues, limit
        self.least: dict[int, int] = {}  # per character, the least shared prefix since the last one handed there

    def hand(self, pos: np.ndarray, lcp: np.ndarray, wanted) -> None:
        before, here = self.least, int(lcp.min())
        if self.limit:  # a text of names needs the order alone
            self.least = {char: min(least, here) for char, least in before.items()}
        ahead = np.flatnonzero(pos > 0)
        chars = self.text[pos[ahead] - 1]
        keep = wanted(chars)
        ahead, chars = ahead[keep], chars[keep].astype(np.int64)
        order = np.argsort(chars, kind="stable")
        ahead, chars = ahead[order], chars[order]
        cuts = np.flatnonzero(np.concatenate([[True], chars[1:] != chars[:-1]])) if len(chars) else []
        for low, high in zip(cuts, np.append(cuts[1:], len(chars)) if len(chars) else []):
            char, at = int(chars[low]), ahead[low:high]
            shared = np.zeros(len(at), np.int64)
            if self.limit:  # the least prefix over the stretch after the one handed before, up to this one
                if char in before:
                    shared[0] = min(before[char], int(lcp[: at[0] + 1].min())) + 1
                if len(at) > 1:
                    shared[1:] = np.minimum.reduceat(lcp[: at[-1] + 1], at[:-1] + 1) + 1
                self.least[char] = int(lcp[at[-1] + 1 :].min()) if at[-1] + 1 < len(lcp) else self.limit
            self.queues[char].push(pos[at] - 1, np.minimum(shared, self.limit))


def suffix_array(text: np.ndarray, limit: int, folder: str | None = None, base: int = BASE, spill: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all suffixes in descending order, with the prefix each shares with the one before it (up to ``limit``).

    ``text`` holds non-negative integers, the last of them 0 and no other 0. Suffixes that agree over
    ``limit`` characters come in any order. Chunks of (positions, prefixes) come out.
    """
    with tempfile.TemporaryDirectory(dir=folder) as own:
        yield from _sorted(text, limit, limit, own, base, spill)


def _lms_order(text, lms, depth, folder, base, spill) -> np.ndarray:
    if len(lms) == 1:
        return lms
    names = _names(text, lms)
    if names.max() == len(lms) - 1:
        order = np.argsort(names)
    elif len(lms) <= base:
        order = _sort_in_memory(names, depth // 2 + 1)  # LMS positions are two characters apart or more
    else:
        short = np.memmap(os.path.join(folder, f"names-{len(lms)}"), np.uint32, "w+", shape=(len(lms) + 1,))
        short[:-1] = names + 1
        short[-1] = 0
        parts = [pos for pos, _ in _sorted(short, depth // 2 + 1, 0, folder, base, spill)]
        order = np.concatenate(parts)[::-1]
        order = order[order < len(lms)]
    return lms[order]


def _sorted(text, depth, limit, folder, base, spill) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    lms = lms_positions(text)
    seeds = _lms_order(text, lms, depth, folder, base, spill) if len(lms) else np.array([len(text) - 1])
    seed_chars = text[seeds].astype(np.int64)
    seed_lcp = np.concatenate([[0], shared_prefix(text, seeds[:-1], seeds[1:], limit)])
    chars = _alphabet(text)
    larger = {c: Queue(folder, spill) for c in chars}
    kept = {c: Queue(folder, spill) for c in chars}
    scan = _Scan(text, larger, limit)
    for c in chars:  # ascending: suffixes greater than their next, from the seeds
        last = None
        while larger[c].held or larger[c].stored:
            queue, larger[c] = larger[c], Queue(folder, spill)
            for pos, lcp in queue.drain():
                kept[c].push(pos, lcp)
                scan.hand(pos, lcp, lambda x, c=c: x >= c)
                last = pos[-1]
        low, high = np.searchsorted(seed_chars, [c, c + 1])
        if low < high:
            pos, lcp = seeds[low:high], seed_lcp[low:high].copy()
            lcp[0] = shared_prefix(text, np.array([last]), pos[:1], limit)[0] if last is not None else 0
            scan.hand(pos, lcp, lambda x, c=c: x > c)
    smaller = {c: Queue(folder, spill) for c in chars}
    scan = _Scan(text, smaller, limit)
    for c in reversed(chars):  # descending: the other suffixes, from those just sorted
        last = None
        if c == 0:
            yield np.array([len(text) - 1]), np.zeros(1, np.int64)
            break
        while smaller[c].held or smaller[c].stored:
            queue, smaller[c] = smaller[c], Queue(folder, spill)
            for pos, lcp in queue.drain():
                scan.hand(pos, lcp, lambda x, c=c: x <= c)
                yield pos, lcp
                last = pos[-1]
        for pos, lcp in kept[c].backwards():
            if last is not None:
                lcp = lcp.copy()
                lcp[0] = shared_prefix(text, np.array([last]), pos[:1], limit)[0]
                last = None
            scan.hand(pos, lcp, lambda x, c=c: x < c)
            yield pos, lcp


def _alphabet(text: np.ndarray) -> list[int]:
    found: set[int] = set()
    for low in range(0, len(text), CHUNK):
        found.update(np.unique(text[low : low + CHUNK]).tolist())
    return sorted(found)
