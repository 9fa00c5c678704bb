"""Whole texts to token ids, each distinct piece of text encoded once per worker.

A piece is what lies between two places where no encoder used here looks across.
Pieces are cut, hashed and told apart as arrays; only distinct ones become objects.
Memory: a slice of texts at a time; the memo is emptied when it holds ``MOST`` pieces.
Pieces are taken as equal if their 64-bit hashes are: among 1.5 million, a chance of 1e-7
that any two differ.
"""

from __future__ import annotations

import functools
import itertools
import os

import numpy as np
import public_tokenizers

from tidemark.llm.arrays import LOWER, SPACE, distinct, flat_ranges, groups, utf8, word_hashes, words

MOST = 1_500_000
SLICE = 4_000_000

LETTER = np.zeros(256, bool)
LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = True
STOP = np.zeros(256, bool)
STOP[[ord(c) for c in ".,;:!?"]] = True
#: ASCII white space, and the four controls that some libraries count as such.
BLANK = SPACE.copy()
BLANK[0x1C:0x20] = True
#: First bytes of the characters outside ASCII that are white space (and of many others).
WIDE = np.zeros(256, bool)
WIDE[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def _after_letters(data: np.ndarray) -> np.ndarray:
    """Places of a stop right after an ASCII letter: every pattern used here ends a match there."""
    return np.flatnonzero(STOP[data[1:]] & LETTER[data[:-1]]) + 1


def by_white_space(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of pieces for encoders that drop white space and never join across it."""
    starts, ends, _ = words(data, offsets)
    cut = _after_letters(data)
    cut = cut[~np.isin(cut, starts, assume_unique=True)] if len(cut) else cut
    return np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))


def before_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of pieces for encoders whose words own the one space before them.

    Cuts before a space between two visible characters: no match goes across it. Where
    a neighbour may be white space outside ASCII there is no cut, and pieces are longer.
    """
    n = len(data)
    cut = np.flatnonzero(data[1:-1] == 0x20) + 1 if n > 2 else np.zeros(0, np.int64)
    seen = ~BLANK[data[cut - 1]] & ~BLANK[data[cut + 1]] & ~WIDE[data[cut + 1]]
    seen &= data[cut - 2] != 0xC2  # at 1 this looks at the last byte, which does no harm
    seen &= ~WIDE[data[cut - 3]]
    heads = offsets[:-1][np.diff(offsets) > 0]
    last = np.isin(cut + 1, offsets)  # the space ends its text
    cut = np.concatenate([heads, cut[seen & ~last], _after_letters(data)])
    starts = distinct(cut)
    return starts, np.append(starts[1:], n) if len(starts) else starts


class Memo:
    """ids of many texts: ``encode`` is called with distinct pieces only."""

    def __init__(self, cut, encode, dtype=np.uint32, lower=False):
        self.cut, self.encode, self.dtype, self.lower = cut, encode, dtype, lower
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)  # hashes in order, and the pieces' numbers
        self.codes = np.zeros(0, np.int64)
        self.flat = np.zeros(0, self.dtype)
        self.heads = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)

    def slices(self, column):
        """(first text, ids of the next texts one after the other, ids per text) of an Arrow column."""
        data, offsets = utf8(column)
        for first, last in groups(offsets, SLICE):
            own = offsets[first : last + 1]
            yield first, *self.ids(data[own[0] : own[-1]], own - own[0])

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.lower and b"<|" not in data.tobytes():
            data = LOWER[data]
        if len(self.known) > MOST:
            self.clear()
        starts, ends = self.cut(data, offsets) if len(data) else (offsets[:0], offsets[:0])
        used = self._codes(data, starts, ends)
        lengths = self.lengths[used]
        sums = np.concatenate([[0], np.cumsum(lengths)])
        per_text = np.diff(sums[np.searchsorted(starts, offsets)])
        return self.flat[flat_ranges(self.heads[used], lengths)], per_text

    def _codes(self, data, starts, ends) -> np.ndarray:
        """The memo's number of each piece; new ones are learnt."""
        hashes = word_hashes(data, starts, ends, 1)
        order = np.argsort(hashes)
        ordered = hashes[order]
        fresh = np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)]
        wanted, one = ordered[fresh], order[fresh]
        at = np.searchsorted(self.known, wanted)
        missing = np.append(self.known, 0)[at] != wanted
        missing[at == len(self.known)] = True
        if missing.any():
            raw, own = data.tobytes(), one[missing]
            texts = [raw[a:b].decode() for a, b in zip(starts[own].tolist(), ends[own].tolist())]
            self._learn(wanted[missing], at[missing], texts)
            at = np.searchsorted(self.known, wanted)
        codes = np.empty(len(order), np.int64)
        codes[order] = self.codes[at][np.cumsum(fresh) - 1]
        return codes

    def _learn(self, hashes: np.ndarray, at: np.ndarray, texts: list[str]) -> None:
        found = self.encode(texts)
        n = len(self.heads)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(itertools.chain.from_iterable(found), self.dtype, int(lengths.sum()))
        heads = np.cumsum(lengths) - lengths + len(self.flat)
        self.flat = np.concatenate([self.flat, flat])
        self.heads = np.concatenate([self.heads, heads])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.known = np.insert(self.known, at, hashes)
        self.codes = np.insert(self.codes, at, np.arange(n, n + len(texts)))


@functools.cache
def library(name: str):
    """The tokenizers library's encoder of a vocabulary file, one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(public_tokenizers.path(name))
    encoder.no_truncation()
    encoder.no_padding()
    return encoder


def library_ids(name: str, texts: list[str]) -> list[list[int]]:
    encoder, out = library(name), []
    for i in range(0, len(texts), 20_000):
        done = encoder.encode_batch_fast(texts[i : i + 20_000], add_special_tokens=False)
        out += [x.ids for x in done]
    return out


@functools.cache
def word_memo(name: str) -> Memo:
    """For word_bpe_49k.json: lower case, white space dropped."""
    return Memo(by_white_space, lambda new: library_ids(name, new), lower=True)


@functools.cache
def byte_memo(name: str) -> Memo:
    """For byte_bpe_50k.json."""
    return Memo(before_words, lambda new: library_ids(name, new))
