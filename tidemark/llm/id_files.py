"""Token ids in files: Simple-8b words, documents in ascending order of their ids.

A file row is a segment of whole documents: 64-bit words whose upper four bits select
how many ids of which width the other sixty hold, the word number at which each block
of ``BLOCK`` ids begins, and the ids too large for a word (``escapes``). Blocks decode
independently, so a segment is decoded by one array operation per selector.

Files are Parquet written by Spark, so a lost executor's files are written again and
a run cut short leaves nothing behind. Null text counts as empty, a null document id
comes first, rows that share an id are ordered by text and all kept. An empty table
gives no rows. Other columns are not read. A document is never split, so a segment is
as large as its longest document.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.pieces import byte_memo

BLOCK = 256
SEGMENT = 1 << 20
MOST_PARTS = 500_000

# Fixed values of Simple-8b: ids per word for selectors 0 to 13, and bits per id.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 15

SCHEMA = (
    "part int, part_start bigint, n_ids bigint, doc_ids array<bigint>, n_tokens array<bigint>, "
    "words binary, block_words binary, escapes binary"
)
_U = np.uint64


#: Selectors of up to twelve ids are tried first; most ids need more than five bits.
NEAR = 5


def _selectors(ahead: np.ndarray, at: np.ndarray, first: int) -> np.ndarray:
    """The first selector from ``first`` on whose ids all fit."""
    window = ahead.take(at[:, None] + np.arange(COUNTS[first]))
    most = np.maximum.accumulate(window, axis=1)
    good = most[:, COUNTS[first:] - 1] <= WIDTHS[first:]
    return np.where(good.any(1), good.argmax(1) + first, ESCAPE)


SMALL = np.maximum(np.frexp(np.arange(1 << 16, dtype=np.float64))[1], 1).astype(np.uint8)


def _bits(ids: np.ndarray) -> np.ndarray:
    """Bits that each id needs; perhaps one more above 2**53."""
    if len(ids) and ids.max() >= len(SMALL):
        return np.maximum(np.frexp(ids.astype(np.float64))[1], 1).astype(np.uint8)
    return SMALL[ids]


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word of each block, escapes) of unsigned ids.

    In each block, each word takes the most ids that fit from where the last one ended.
    """
    ids = ids.astype(_U)
    n = len(ids)
    bits = _bits(ids)
    escapes = ids[bits > 60]
    values = ids.copy()
    values[bits > 60] = np.arange(len(escapes), dtype=_U)
    # Bits of the ids of each block, and none behind its end.
    blocks = -(-n // BLOCK)
    ahead = np.zeros((blocks, BLOCK + COUNTS[0]), np.uint8)
    whole = np.zeros(blocks * BLOCK, np.uint8)
    whole[:n] = bits
    ahead[:, :BLOCK] = whole.reshape(blocks, BLOCK)
    at = np.zeros(blocks, np.int64)
    sizes = np.minimum(n - np.arange(blocks) * BLOCK, BLOCK)
    live = np.arange(blocks)
    steps = []
    while len(live):
        here = at[live]
        place = here + live * ahead.shape[1]
        chosen = _selectors(ahead, place, NEAR)
        wider = np.flatnonzero(chosen == NEAR)
        if len(wider):
            chosen[wider] = _selectors(ahead, place[wider], 0)
        taken = np.minimum(np.where(chosen == ESCAPE, 1, COUNTS[np.minimum(chosen, 13)]), sizes[live] - here)
        steps.append((live, chosen, here + live * BLOCK, taken))
        at[live] = here + taken
        live = live[at[live] < sizes[live]]
    if not steps:
        return np.zeros(0, _U), np.zeros(0, np.int64), escapes
    block, chosen, start, taken = (np.concatenate(x) for x in zip(*steps))
    order = np.argsort(start, kind="stable")
    block, chosen, start, taken = block[order], chosen[order], start[order], taken[order]
    words = chosen.astype(_U) << _U(60)
    for s in np.unique(chosen):
        own = np.flatnonzero(chosen == s)
        count, width = (1, 60) if s == ESCAPE else (COUNTS[s], WIDTHS[s])
        for j in range(count):
            more = own[taken[own] > j]
            words[more] |= values[start[more] + j] << _U(j * width)
    return words, np.searchsorted(block, np.arange(block[-1] + 1)), escapes


def unpack(words: np.ndarray, block_words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of ``pack``."""
    selectors = (words >> _U(60)).astype(np.int64)
    nominal = np.where(selectors == ESCAPE, 1, COUNTS[np.minimum(selectors, 13)])
    before = np.cumsum(nominal) - nominal
    block = np.repeat(np.arange(len(block_words)), np.diff(np.append(block_words, len(words))))
    start = block * BLOCK + before - before[block_words][block] if len(words) else before
    end = np.minimum((block + 1) * BLOCK, n)
    out = np.zeros(n, _U)
    for s in np.unique(selectors):
        own = np.flatnonzero(selectors == s)
        if s == ESCAPE:
            out[start[own]] = escapes[(words[own] & _U((1 << 60) - 1)).astype(np.int64)]
            continue
        mask = _U((1 << int(WIDTHS[s])) - 1)
        for j in range(COUNTS[s]):
            more = own[start[own] + j < end[own]]
            out[start[more] + j] = (words[more] >> _U(j * WIDTHS[s])) & mask
    return out


def _segment(part: int, start: int, doc_ids: list, counts: list, ids: list) -> tuple[dict, int]:
    flat = np.concatenate(ids)
    words, blocks, escapes = pack(flat)
    row = {
        "part": part,
        "part_start": start,
        "n_ids": len(flat),
        "doc_ids": doc_ids,
        "n_tokens": np.concatenate(counts).tolist(),
        "words": words.astype("<u8").tobytes(),
        "block_words": blocks.astype("<u4").tobytes(),
        "escapes": escapes.astype("<u8").tobytes(),
    }
    return row, start + len(flat)


ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("part_start", pa.int64()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("n_tokens", pa.list_(pa.int64())),
        ("words", pa.binary()),
        ("block_words", pa.binary()),
        ("escapes", pa.binary()),
    ]
)


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """An end id after the ids of each text."""
    return np.insert(ids, np.cumsum(counts), end_id), counts + 1


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int) -> None:
    """Encode every text by a byte-level vocabulary file and write the segments."""

    def encode(batches):
        part, start = TaskContext.get().partitionId(), 0
        doc_ids, counts, ids, size = [], [], [], 0
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for first, own, lengths in byte_memo(vocabulary).slices(batch.column(1)):
                own, lengths = with_end(own, lengths, end_id)
                doc_ids += keys[first : first + len(lengths)]
                counts.append(lengths)
                ids.append(own)
                size += len(own)
                if size >= SEGMENT:
                    row, start = _segment(part, start, doc_ids, counts, ids)
                    yield pa.RecordBatch.from_pylist([row], schema=ARROW)
                    doc_ids, counts, ids, size = [], [], [], 0
        if doc_ids:
            row, start = _segment(part, start, doc_ids, counts, ids)
            yield pa.RecordBatch.from_pylist([row], schema=ARROW)

    (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(encode, SCHEMA)
        .write.option("compression", "zstd")
        .parquet(path)
    )


def segments(spark: SparkSession, path: str) -> DataFrame:
    """Segments with ``start``: ids in all segments before.

    Ids are added up per part; only one total per part goes through one task.
    """
    rows = spark.read.schema(SCHEMA).parquet(path)
    totals = rows.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        "part", F.coalesce(F.sum("part_ids").over(before), F.lit(0)).alias("base")
    )
    bases = stored(bases, "id-parts")
    if bases.count() <= MOST_PARTS:  # 16 bytes each; else the segments are shuffled
        bases = F.broadcast(bases)
    return rows.join(bases, "part").withColumn("start", F.col("base") + F.col("part_start"))


def _decoded(batches):
    """(document ids, starts, lengths, all ids) of each segment."""
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(
                np.frombuffer(row["words"], "<u8"),
                np.frombuffer(row["block_words"], "<u4").astype(np.int64),
                np.frombuffer(row["escapes"], "<u8"),
                row["n_ids"],
            )
            lengths = np.array(row["n_tokens"], np.int64)
            yield row["doc_ids"], row["start"] + np.cumsum(lengths) - lengths, lengths, ids


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of the files, one row per document."""

    def rows(batches):
        for doc_ids, starts, lengths, ids in _decoded(batches):
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int64)))
            yield pa.record_batch(
                [pa.array(doc_ids, pa.int64()), pa.array(starts), lists], ["doc_id", "start", "ids"]
            )

    return segments(spark, path).mapInArrow(rows, "doc_id bigint, start bigint, ids array<bigint>")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the ids that the files hold."""

    def rows(batches):
        for doc_ids, starts, lengths, ids in _decoded(batches):
            raw, ends = ids.astype("<u4").tobytes(), np.cumsum(lengths) * 4
            sums = [zlib.crc32(raw[e - 4 * n : e]) for e, n in zip(ends.tolist(), lengths.tolist())]
            yield pa.record_batch(
                [
                    pa.array(doc_ids, pa.int64()),
                    pa.array(starts),
                    pa.array(lengths),
                    pa.array(sums, pa.int64()),
                ],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return segments(spark, path).mapInArrow(
        rows, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
