"""Token counts of whole texts without their ids.

A pre-token here is a lower-case piece of text between white space, cut before a stop
that follows a letter: the encoder never joins across its ends. Each distinct one is
counted once, in a table of its own. Each block of documents gives one row per pre-token:
which documents hold it and how often. The join of the two adds count times frequency per
document. A pre-token that all texts hold has one row per block, and the join may split
its rows among tasks.

Null text counts as empty (no tokens). Every row gives a row, repeated ids and repeated
rows too: documents are told apart by their place in a block, not by id. An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import LOWER, groups, utf8, word_hashes
from tidemark.llm.pieces import by_white_space, library_ids

SLICE = 4_000_000
#: Bytes and documents of a block; a document's place in it has 16 bits.
BLOCK, DOCUMENTS = 32_000_000, 1 << 16
#: Sums of so many blocks are held before they go on.
HELD = 500
BATCH = 10_000


def _slices(batches):
    """(document ids, bytes, boundaries) of texts, lower case where no special string can be."""
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for first, last in groups(offsets, SLICE):
            for a in range(first, last, DOCUMENTS):
                b = min(a + DOCUMENTS, last)
                own = offsets[a : b + 1]
                part = data[own[0] : own[-1]]
                if b"<|" not in part.tobytes():
                    part = LOWER[part]
                yield batch.column(0).slice(a, b - a), part, own - own[0]


class Spellings:
    """Numbers of the distinct pieces of a block: equal if their 64-bit hashes are."""

    def __init__(self):
        self.known = np.zeros(0, np.uint64)
        self.numbers = np.zeros(0, np.int64)
        self.spelled: list[bytes] = []

    def number(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, text) of each piece."""
        starts, ends = by_white_space(data, offsets) if len(data) else (offsets[:0], offsets[:0])
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
            n = len(self.spelled)
            self.spelled += [raw[a:b] for a, b in zip(starts[own].tolist(), ends[own].tolist())]
            self.known = np.insert(self.known, at[missing], wanted[missing])
            self.numbers = np.insert(self.numbers, at[missing], np.arange(n, len(self.spelled)))
            at = np.searchsorted(self.known, wanted)
        out = np.empty(len(order), np.int64)
        out[order] = self.numbers[at][np.cumsum(fresh) - 1]
        return out, np.searchsorted(offsets, starts, "right") - 1


def distinct_pre_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(piece, n_pieces): every pre-token of the corpus, and its tokens, counted once."""

    def pieces(batches):
        own, sent = Spellings(), 0
        for _, data, offsets in _slices(batches):
            own.number(data, offsets)
            fresh = sorted(own.spelled[sent:])  # neighbours share letters, which compresses well
            for i in range(0, len(fresh), BATCH):
                found = pa.array(fresh[i : i + BATCH], pa.binary()).cast(pa.string())
                yield pa.record_batch([found], ["piece"])
            sent = len(own.spelled)
            if sent > 1_000_000:
                own, sent = Spellings(), 0

    def counted(batches):
        for batch in batches:
            n = [len(x) for x in library_ids(vocabulary, batch.column(0).to_pylist())]
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64())], ["piece", "n_pieces"])

    return (
        docs.select("doc_id", "text")
        .mapInArrow(pieces, "piece string")
        .distinct()
        .mapInArrow(counted, "piece string, n_pieces bigint")
    )


def _header(keys: pa.Array, sizes: np.ndarray) -> bytes:
    """Byte counts, ids, and which ids are null."""
    values = pc.fill_null(keys, 0).to_numpy(zero_copy_only=False).astype("<i8")
    nulls = pc.is_null(keys).to_numpy(zero_copy_only=False)
    return sizes.astype("<i8").tobytes() + values.tobytes() + nulls.tobytes()


def _entries(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """32 bits per piece and document: times (at most 65,535, else several entries) and place."""
    more = np.maximum(-(-times // 0xFFFF), 1)
    keys = np.repeat(keys, more)
    part = np.full(len(keys), 0xFFFF, np.int64)
    ends = np.cumsum(more) - 1
    part[ends] = times - (more - 1) * 0xFFFF
    return keys, (part << 16 | keys & 0xFFFF).astype("<u4")


ROWS = "piece string, block bigint, entries binary"


def frequencies(docs: DataFrame) -> DataFrame:
    """(piece, block, entries): places in the block of the texts that hold a pre-token, and
    how often. The row with the empty piece holds the block's ids and byte counts."""

    def batch_of(pieces, block, entries):
        return pa.record_batch(
            [
                pa.array(pieces, pa.binary()).cast(pa.string()),
                pa.array([block] * len(pieces), pa.int64()),
                pa.array(entries, pa.binary()),
            ],
            ["piece", "block", "entries"],
        )

    def finished(block, own, found, ids, sizes):
        yield batch_of([b""], block, [_header(pa.concat_arrays(ids), np.concatenate(sizes))])
        keys = np.concatenate([x for x, _ in found])
        order = np.argsort(keys)
        keys, entries = _entries(keys[order], np.concatenate([x for _, x in found])[order])
        number = keys >> 16
        heads = np.flatnonzero(np.append(True, number[1:] != number[:-1])[: len(number)])
        ends = (np.append(heads[1:], len(number)) * 4).tolist()
        raw, starts = entries.tobytes(), (heads * 4).tolist()
        names = [own.spelled[k] for k in number[heads].tolist()]
        order = sorted(range(len(names)), key=names.__getitem__)
        for i in range(0, len(names), BATCH):
            rows = order[i : i + BATCH]
            yield batch_of([names[k] for k in rows], block, [raw[starts[k] : ends[k]] for k in rows])

    def rows(batches):
        block, n, size = TaskContext.get().partitionId() << 32, 0, 0
        own, found, ids, sizes = Spellings(), [], [], []
        for keys, data, offsets in _slices(batches):
            if ids and (size + len(data) > BLOCK or n + len(keys) > DOCUMENTS):
                yield from finished(block, own, found, ids, sizes)
                block, n, size = block + 1, 0, 0
                own, found, ids, sizes = Spellings(), [], [], []
            number, text = own.number(data, offsets)
            at = number << 16 | (text + n)
            at.sort()
            heads = np.flatnonzero(np.append(True, at[1:] != at[:-1])[: len(at)])
            found.append((at[heads], np.diff(np.append(heads, len(at)))))
            ids.append(keys)
            sizes.append(np.diff(offsets))
            n, size = n + len(keys), size + len(data)
        if ids:
            yield from finished(block, own, found, ids, sizes)

    return docs.select("doc_id", "text").mapInArrow(rows, ROWS)


SUMS = "block bigint, header boolean, places binary, sums binary"
_SUMS = [c.split()[0] for c in SUMS.split(", ")]


def _sums(batches):
    """Tokens per document of a block, as far as one task sees them; headers go through."""
    held: dict[int, np.ndarray] = {}

    def out():
        places = [np.flatnonzero(x) for x in held.values()]
        batch = pa.record_batch(
            [
                pa.array(held, pa.int64()),
                pa.array([False] * len(held)),
                pa.array([x.astype("<u2").tobytes() for x in places], pa.binary()),
                # A text has fewer than 2**31 bytes, so fewer tokens.
                pa.array([x[at].astype("<u4").tobytes() for x, at in zip(held.values(), places)], pa.binary()),
            ],
            _SUMS,
        )
        held.clear()
        return batch

    for batch in batches:
        header = batch.column("header")
        headers = batch.filter(header)
        if headers.num_rows:
            yield pa.record_batch(
                [headers.column("block"), headers.column("header"), headers.column("entries"), pa.nulls(headers.num_rows, pa.binary())],
                _SUMS,
            )
        batch = batch.filter(pc.invert(header))
        raw, offsets = utf8(batch.column("entries"))
        entries = raw.view("<u4")
        per_row = np.diff(offsets) // 4
        block, code = np.unique(batch.column("block").to_numpy(), return_inverse=True)
        weight = np.repeat(batch.column("n_pieces").to_numpy(), per_row) * (entries >> 16).astype(np.int64)
        at = np.repeat(code, per_row) * DOCUMENTS + (entries & 0xFFFF)
        order = np.argsort(at)
        at, weight = at[order], weight[order]
        heads = np.flatnonzero(np.append(True, at[1:] != at[:-1])[: len(at)])
        sums = np.add.reduceat(weight, heads) if len(heads) else weight
        own, place = np.divmod(at[heads], DOCUMENTS)
        for i, number in enumerate(block.tolist()):
            a, b = np.searchsorted(own, [i, i + 1])
            have = held.get(number)
            if have is None or len(have) <= place[b - 1]:
                grown = np.zeros(int(place[b - 1]) + 64, np.int64)
                if have is not None:
                    grown[: len(have)] = have
                have = held[number] = grown
            have[place[a:b]] += sums[a:b]
        if len(held) > HELD:
            yield out()
    if held:
        yield out()


def _documents(rows: pa.Table) -> pa.Table:
    """One block's rows: its header, and sums from each task that had some."""
    header = rows.column("header").to_pylist()
    places, sums = rows.column("places").to_pylist(), rows.column("sums").to_pylist()
    head = places[header.index(True)]
    n = len(head) // 17
    n_bytes = np.frombuffer(head, "<i8", n)
    ids = pa.array(np.frombuffer(head, "<i8", n, 8 * n), mask=np.frombuffer(head, bool, n, 16 * n))
    total = np.zeros(n, np.int64)
    for is_header, at, found in zip(header, places, sums):
        if not is_header:
            total[np.frombuffer(at, "<u2")] += np.frombuffer(found, "<u4")
    return pa.table({"doc_id": ids, "n_bytes": pa.array(n_bytes), "n_tokens": pa.array(total)})


def count_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every whole text."""
    joined = frequencies(docs).join(distinct_pre_tokens(docs, vocabulary), "piece", "left")
    return (
        joined.select("block", (F.col("piece") == "").alias("header"), "n_pieces", "entries")
        .mapInArrow(_sums, SUMS)
        .groupBy("block")
        .applyInArrow(_documents, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    )
