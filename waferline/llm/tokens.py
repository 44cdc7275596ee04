"""Token ids of many texts, each different word encoded once."""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

from waferline.llm.common import text_blocks
from waferline.llm.words import IS_SPACE, spans, word_hashes

#: Words kept between batches; beyond it the store starts anew, which costs time and changes nothing else.
STORE_WORDS = 1_200_000
END_ID = 1
_SPACE, _LETTER, _DIGIT, _SIGN, _WHOLE = range(5)
_KIND = np.full(256, _WHOLE, np.uint8)
_KIND[33:127] = _SIGN
_KIND[48:58] = _DIGIT
_KIND[65:91] = _KIND[97:123] = _LETTER
_KIND[IS_SPACE] = _SPACE
_KIND[[ord("'"), ord("<")]] = _WHOLE  # contractions and special tokens


def pieces(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text cut where the tokenizer's own pattern cuts it: lower-cased bytes, starts, ends, and pieces before each row.

    Runs of letters (a-z and the Latin-1 letters), single digits and runs of other ASCII signs. A word with
    any other character stays whole and unchanged, and the tokenizer cuts it.
    """
    kind, plain = _KIND[data], data.copy()
    lead = np.flatnonzero(data[:-1] == 0xC3)
    tail = data[lead + 1]
    lead, tail = lead[(tail != 0x97) & (tail != 0xB7)], tail[(tail != 0x97) & (tail != 0xB7)]
    kind[lead] = kind[lead + 1] = _LETTER
    plain[lead[tail < 0x9F] + 1] += 0x20
    plain[(data >= 65) & (data <= 90)] += 32
    starts, ends, counts = spans(data, bounds)
    odd = np.flatnonzero(kind == _WHOLE)
    if len(odd):
        words = np.unique(np.searchsorted(starts, odd, side="right") - 1)
        words = words[words >= 0]
        size = ends[words] - starts[words]
        at = np.repeat(starts[words] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        kind[at] = _WHOLE
        plain[at] = data[at]
    cut = np.ones(len(data) + 1, bool)
    cut[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    cut[bounds] = True
    at = np.flatnonzero(cut)
    kept = kind[at[:-1]] != _SPACE if len(data) else np.zeros(0, bool)
    starts, ends = at[:-1][kept], at[1:][kept]
    return plain, starts, ends, np.searchsorted(starts, bounds)


class WordEncoder:
    """Encodes texts with a tokenizer that drops white space, word by word.

    White space parts words before the tokenizer merges anything, so the ids of a text are those of its
    words, one after the other. Each task keeps the ids of the words it has met.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.clear()

    def clear(self) -> None:
        self.keys, self.at, self.size = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)

    def learn(self, data: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Encode new pieces; ``keys`` are sorted, and none of them is stored."""
        parts, sizes = [self.ids], []
        for low in range(0, len(keys), 20_000):
            s, e = starts[low : low + 20_000].tolist(), ends[low : low + 20_000].tolist()
            pieces = [str(data[i:j], "utf-8", "replace") for i, j in zip(s, e)]
            found = [x.ids for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
            parts.append(np.fromiter(chain.from_iterable(found), np.uint32))
        size = np.concatenate(sizes)
        at = len(self.ids) + np.cumsum(size) - size
        place = np.searchsorted(self.keys, keys)
        self.keys, self.ids = np.insert(self.keys, place, keys), np.concatenate(parts)
        self.at, self.size = np.insert(self.at, place, at), np.insert(self.size, place, size)

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each followed by the end id, and the texts' bounds in them."""
        plain, starts, ends, counts = pieces(data, bounds)
        hashes = word_hashes(plain, starts, ends)
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        new = self.missing(distinct)
        if new.any():
            if len(self.keys) + int(new.sum()) > STORE_WORDS:
                self.clear()
                new[:] = True
            self.learn(plain, distinct[new], starts[first[new]], ends[first[new]])
        place = np.searchsorted(self.keys, distinct)
        size, at = self.size[place][which], self.at[place][which]
        rows = len(bounds) - 1
        before = np.concatenate([[0], np.cumsum(size)])
        out_bounds = before[counts] + np.arange(rows + 1)
        out = np.empty(out_bounds[-1], np.uint32)
        row = np.repeat(np.arange(rows), np.diff(counts))
        step = np.arange(before[-1])
        out[step + np.repeat(row, size)] = self.ids[step + np.repeat(at - before[:-1], size)]
        out[out_bounds[1:] - 1] = END_ID
        return out, out_bounds

    def missing(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.ones(len(keys), bool)
        place = np.searchsorted(self.keys, keys)
        return self.keys[np.minimum(place, len(self.keys) - 1)] != keys


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def encoded(column: pa.Array, path: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, ids, bounds) of runs of rows of a text column."""
    own = encoder(path)
    for low, high, data, bounds in text_blocks(column):
        ids, cuts = own.encode(data, bounds)
        yield low, high, ids, cuts
