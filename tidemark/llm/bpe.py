"""Byte-level BPE in two tiers.

A pre-token that is itself in the vocabulary is resolved by a minimal perfect hash:
as many slots as tokens, one displacement per bucket, one comparison. Any other is
merged by a heap of adjacent pairs over a linked list of its bytes, the lowest rank
first, the leftmost of equal ones. Distinct pieces of text are encoded once per worker.

Null text counts as empty (no ids, digests of nothing). Every row gives a row, repeated
ids too. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from tidemark.llm.arrays import flat_ranges
from tidemark.llm.pieces import Memo, before_words

RECENT = 200_000


class PerfectHash:
    """Position of each key in ``keys``; any other key gives -1.

    Buckets of several keys get a displacement that sends their keys to free slots, the
    largest buckets first; a bucket of one key names its slot.
    """

    def __init__(self, keys: list[bytes]):
        n = self.n = len(keys)
        self.buckets = max(1, n // 2)
        self.displacement = [0] * self.buckets
        self.slots: list[int] = [-1] * n
        self.keys = keys
        members: list[list[int]] = [[] for _ in range(self.buckets)]
        hashes = [xxhash.xxh3_128_intdigest(k) for k in keys]
        for i, h in enumerate(hashes):
            members[h % self.buckets].append(i)
        order = sorted(range(self.buckets), key=lambda b: -len(members[b]))
        for b in (b for b in order if len(members[b]) > 1):
            own, d = [hashes[i] >> 40 for i in members[b]], 0
            while True:
                places = {(x ^ x >> 44) * (2 * d + 1) % 0xFFFFFFFFFFC5 % n for x in own}
                if len(places) == len(own) and all(self.slots[p] < 0 for p in places):
                    break
                d += 1
            self.displacement[b] = d
            for i, x in zip(members[b], own):
                self.slots[(x ^ x >> 44) * (2 * d + 1) % 0xFFFFFFFFFFC5 % n] = i
        free = iter([p for p in range(n) if self.slots[p] < 0])
        for b in (b for b in order if len(members[b]) == 1):
            p = next(free)
            self.displacement[b], self.slots[p] = -1 - p, members[b][0]

    def __call__(self, key: bytes) -> int:
        h = xxhash.xxh3_128_intdigest(key)
        d = self.displacement[h % self.buckets] if self.n else 0
        if d < 0:
            i = self.slots[-1 - d]
        elif self.n:
            x = h >> 40
            i = self.slots[(x ^ x >> 44) * (2 * d + 1) % 0xFFFFFFFFFFC5 % self.n]
        else:
            return -1
        return i if self.keys[i] == key else -1


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token by merging its bytes, the pair of lowest rank first."""
    n = len(piece)
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    rank = ranks.get
    heap = [
        (r, i, i + 1, i + 2)
        for i in range(n - 1)
        if (r := rank(piece[i : i + 2])) is not None
    ]
    heapq.heapify(heap)
    while heap:
        _, i, middle, stop = heapq.heappop(heap)
        j = after[i]
        if end[i] != middle or j >= n or j != middle or end[j] != stop:
            continue  # one side has been merged meanwhile
        end[i], end[j] = stop, -1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := rank(piece[i : end[k]])) is not None:
                heapq.heappush(heap, (r, i, stop, end[k]))
        h = before[i]
        if h >= 0 and (r := rank(piece[h:stop])) is not None:
            heapq.heappush(heap, (r, h, i, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = after[i]
    return out


class Encoder:
    """Texts to ids and back, by a file of ranks and a pattern of pre-tokens."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            rows = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in rows}
        keys = list(self.ranks)
        self.whole = PerfectHash(keys)
        self.ids = [self.ranks[k] for k in keys]
        self.find = regex.compile(pattern).findall
        by_id = {i: k for k, i in self.ranks.items()}
        tokens = [by_id.get(i, b"") for i in range(max(by_id, default=-1) + 1)]
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.heads = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.decimal = [str(i) for i in range(len(tokens))]
        self.memo = Memo(before_words, lambda new: [self.piece(x) for x in new])
        self.missed = functools.lru_cache(RECENT)(lambda x: merged(x, self.ranks))

    def piece(self, text: str) -> list[int]:
        out: list[int] = []
        for token in self.find(text):
            raw = token.encode()
            at = self.whole(raw)
            if at >= 0:
                out.append(self.ids[at])
            else:
                out += self.missed(raw)
        return out

    def encode(self, column):
        """(first text, ids of the next texts, ids per text) of an Arrow column, in slices."""
        return self.memo.slices(column)

    def decode(self, ids: np.ndarray) -> bytes:
        return self.bytes[flat_ranges(self.heads[ids], self.lengths[ids])].tobytes()


@functools.cache
def encoder(name: str) -> Encoder:
    return Encoder(public_tokenizers.path(name), public_tokenizers.PATTERN)


def _hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def encode_texts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids, decoded) of every text: its ids, and the bytes decoded from them."""

    def rows(batches):
        own = encoder(vocabulary)
        for batch in batches:
            keys = batch.column(0)
            for first, ids, counts in own.encode(batch.column(1)):
                offsets = np.concatenate([[0], np.cumsum(counts)])
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int64))
                )
                back = [own.decode(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.record_batch(
                    [keys.slice(first, len(counts)), lists, pa.array(back, pa.binary())],
                    ["doc_id", "ids", "decoded"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        rows, "doc_id bigint, ids array<bigint>, decoded binary"
    )


def digest_texts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): as ``encode_texts``, hashed in the task."""

    def rows(batches):
        own = encoder(vocabulary)
        name = own.decimal.__getitem__
        for batch in batches:
            keys = batch.column(0)
            for first, ids, counts in own.encode(batch.column(1)):
                ends = np.cumsum(counts)
                each = [(ids[e - n : e]) for e, n in zip(ends.tolist(), counts.tolist())]
                yield pa.record_batch(
                    [
                        keys.slice(first, len(counts)),
                        pa.array(counts),
                        pa.array([_hex(" ".join(map(name, x.tolist())).encode()) for x in each]),
                        pa.array([_hex(own.decode(x)) for x in each]),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        rows, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
