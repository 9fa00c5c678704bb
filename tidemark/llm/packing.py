"""Hierarchical packing of documents into sequences of several context sizes.

A document goes to the tier whose context size is the smallest that holds it; what is
longer than the largest is cut into full sequences first. Each tier is packed from its
longest piece on: a window takes the longest piece that fits its gap, from its own tier
or a shorter one, and the last gap is closed by cutting one more piece. So windows are
full as long as there are pieces. What is left at the end of a partition is cut to full
windows of ever smaller tiers; only the last piece, shorter than the smallest tier, is
padded. Sequences are then dealt to step groups of one tier and ``step_tokens`` tokens.

Packing needs no shuffle: every partition packs its own documents, holding about
``HELD`` tokens at a time. Sequence ids are unique, not consecutive. The partitions have to be
the same if a task runs again (a scan or a written table).

Null text counts as empty; it still has its end id, so every row is in one piece at
least, repeated rows too. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm.id_files import with_end
from tidemark.llm.pieces import word_memo

TIERS = (256, 512, 1024, 2048)
HELD = 2_000_000

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, tier bigint, step_id bigint"
)


class Pieces:
    """Pieces by length: the longest of at most some length is found by one bit search."""

    def __init__(self, most: int):
        self.by_length: list[list] = [[] for _ in range(most + 1)]
        self.bits = 0

    def add(self, doc: int, start: int, length: int) -> None:
        self.by_length[length].append((doc, start, length))
        self.bits |= 1 << length

    def longest(self, most: int):
        """Removes and returns the longest piece of at most ``most`` tokens."""
        length = (self.bits & ((2 << most) - 1)).bit_length() - 1
        if length < 1:
            return None
        own = self.by_length[length]
        piece = own.pop()
        if not own:
            self.bits ^= 1 << length
        return piece


def windows(pieces: Pieces, tiers: tuple[int, ...], last: bool):
    """(tier, pieces) of each window, until a window could not be filled; if ``last``, of all."""
    top = tiers[-1]
    for size in reversed(tiers):
        below = max((t for t in tiers if t < size), default=0)
        while (first := pieces.longest(size)) is not None:
            if first[2] <= below and not (last and size == tiers[0]):
                pieces.add(*first)
                break
            window, gap = [first], size - first[2]
            while gap and (more := pieces.longest(gap)) is not None:
                window.append(more)
                gap -= more[2]
            if gap and (more := pieces.longest(top)) is not None:
                doc, start, length = more  # longer than the gap, or it would have been taken
                window.append((doc, start, gap))
                pieces.add(doc, start + gap, length - gap)
                gap = 0
            if gap and not last:
                for piece in window:
                    pieces.add(*piece)
                return
            if gap:
                yield from _remainder(window, size - gap, tiers)
            else:
                yield size, window


def _remainder(window: list, tokens: int, tiers: tuple[int, ...]):
    """Full windows of smaller and smaller tiers, and one that is padded."""
    while window:
        size = max((t for t in tiers if t <= tokens), default=tokens)
        own, gap = [], size
        while gap:
            doc, start, length = window.pop(0)
            own.append((doc, start, min(length, gap)))
            if length > gap:
                window.insert(0, (doc, start + gap, length - gap))
            gap -= own[-1][2]
        yield next(t for t in tiers if t >= size), own
        tokens -= size


def pack_documents(
    docs: DataFrame,
    vocabulary: str = "word_bpe_49k.json",
    end_id: int = 1,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = 16_384,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: its document, place, length and checksum, its sequence and offset
    there, the sequence's tier and step group; ``ids`` (32-bit, little-endian) if asked for."""
    tiers = tuple(sorted(tiers))
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def rows(batches):
        base, serial = TaskContext.get().partitionId() << 32, 0
        in_tier = dict.fromkeys(tiers, 0)
        pieces, keys, ids, sizes, held = Pieces(tiers[-1]), [], [], [], 0

        def drain(last):
            nonlocal serial, held
            out = [[] for _ in names]
            raws = []
            for tier, window in windows(pieces, tiers, last):
                offset = 0
                step = in_tier[tier] * tier // step_tokens
                in_tier[tier] += 1
                for doc, start, length in window:
                    raw = ids[doc][4 * start : 4 * (start + length)]
                    row = (keys[doc], start, length, zlib.crc32(raw), sizes[doc], base + serial, offset)
                    for column, value in zip(out, (*row, tier, base + step * len(tiers) + tiers.index(tier))):
                        column.append(value)
                    if with_ids:
                        raws.append(raw)
                    offset += length
                held -= offset
                serial += 1
            columns = [pa.array(c, pa.int64()) for c in out]
            if with_ids:
                return pa.record_batch([*columns, pa.array(raws, pa.binary())], [*names, "ids"])
            return pa.record_batch(columns, names)

        def compact():
            """Forget the ids of documents that are packed."""
            nonlocal pieces, keys, ids, sizes
            left = [p for own in pieces.by_length for p in own]
            used = sorted({p[0] for p in left})
            place = {doc: i for i, doc in enumerate(used)}
            keys, ids, sizes = ([x[d] for d in used] for x in (keys, ids, sizes))
            pieces = Pieces(tiers[-1])
            for doc, start, length in left:
                pieces.add(place[doc], start, length)

        for batch in batches:
            own_keys = batch.column(0).to_pylist()
            for first, flat, counts in word_memo(vocabulary).slices(batch.column(1)):
                flat, counts = with_end(flat, counts, end_id)
                raw, end = flat.astype("<u4").tobytes(), 0
                for i, n in enumerate(counts.tolist()):
                    doc = len(keys)
                    keys.append(own_keys[first + i])
                    ids.append(raw[end : end + 4 * n])
                    sizes.append(n)
                    end += 4 * n
                    for start in range(0, n, tiers[-1]):
                        pieces.add(doc, start, min(n - start, tiers[-1]))
                    held += n
                if held > HELD:
                    yield drain(False)
                    compact()
        yield drain(True)

    schema = SCHEMA + (", ids binary" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(rows, schema)
