"""Exact top-k inner products by a three-phase uniform threshold.

Components become whole numbers, floor(``SCALE`` * x) in double precision, and the score of
a query and a row is their inner product. A vector's dimensions are cut into ``LISTS``
lists; a row's local score in a list is the part of the inner product that the list's
dimensions give, and the score is the sum of the local scores.

1. Each list hands in its k best rows per block of rows; their scores are known then, and the
   k-th best of a query over all blocks is its **cutoff**: k rows reach it, so no row below it
   is needed.
2. A score at or above the cutoff needs a local score of at least cutoff / ``LISTS`` in some
   list. Each list gives the rows that reach that.
3. For those, local scores below the threshold are first put at the threshold; rows whose sum
   of these does not reach the cutoff go. The others' scores are computed in full, and each
   block sends its k best that reach the cutoff.

Rows and queries are put in blocks by a hash of vec_id, and each block of queries meets each
block of rows in one task of bounded size: rows are sent once per block of queries and
queries once per block of rows (``BLOCK``). Cutoffs travel with the queries; nothing grows
on the driver, and no table is broadcast.

Scores are whole numbers, so they are exact: sums that could pass 2**53 are computed in
64 bits, sums that could pass 63 bits as Python numbers and cut to +-(2**63 - 1).

Vectors that are null or hold null or non-finite components, and rows without vec_id, take
no part. Vectors are compared with those of the same length only; one of no components
scores 0. Of several rows with one vec_id and length the least vector counts. Ties go to the
smaller vec_id. A query with fewer than k candidates gets all of them; empty tables give no
rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

SCALE = 1024
LISTS = 4
#: Rows of a block, queries of a block, and queries scored at once.
BLOCK, CHUNK = 4096, 64

MOST = 2**63 - 1

SCORED = "query_id bigint, vec_id bigint, score bigint"


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): one vector of whole numbers, as doubles, for each id that takes part."""
    found = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
    fine = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform("v", lambda x: _floor(x * float(SCALE)))
    return found.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fine).select("vec_id", whole.alias("v"))


def _floor(x: Column) -> Column:
    """Whole already, and too large for a long, from 2**53 on."""
    return F.when(F.abs(x) < float(2**53), F.floor(x).cast("double")).otherwise(x)


def _blocks(n: int) -> int:
    return max(1, -(-n // BLOCK))


def _part(blocks: int, seed: int) -> Column:
    return F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(blocks)).cast("int")


def _units(rows: DataFrame, queries: DataFrame, n_rows: int, n_queries: int) -> DataFrame:
    """Rows and queries of each pair of blocks together, rows first; each pair is one key."""
    across, down = _blocks(n_rows), _blocks(n_queries)
    context = rows.sparkSession.sparkContext
    tasks = max(4 * context.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.select(
        _part(across, 1).alias("x"),
        F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("y"),
        F.lit(0).alias("kind"),
        "vec_id",
        "v",
        F.lit(None).cast("long").alias("cutoff"),
    )
    queries = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("x"),
        _part(down, 2).alias("y"),
        F.lit(1).alias("kind"),
        "vec_id",
        "v",
        "cutoff",
    )
    units = rows.unionByName(queries).withColumn("size", F.size("v"))
    return units.repartition(min(across * down, tasks), "size", "x", "y").sortWithinPartitions(
        "size", "x", "y", "kind", "vec_id", "v"
    )


class Block:
    """Rows of one block, by list of dimensions, and the local scores of queries."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        first = np.append(True, ids[1:] != ids[:-1])  # sorted by vec_id and vector
        self.ids, self.vectors = ids[first], vectors[first]
        self.largest = float(np.abs(self.vectors).max(initial=0))
        edges = np.linspace(0, vectors.shape[1], LISTS + 1).astype(int)
        self.lists = [slice(a, b) for a, b in zip(edges[:-1], edges[1:])]

    def local(self, queries: np.ndarray) -> np.ndarray:
        """Local scores by list, query and row, in numbers that hold every sum."""
        bound = self.largest * float(np.abs(queries).max(initial=0)) * max(1, queries.shape[1]) * 4 * LISTS
        rows = self.vectors
        if bound >= 2**53:
            kind = np.int64 if bound < 2**63 else object
            convert = np.vectorize(int, otypes=[object]) if kind is object else lambda x: x.astype(kind)
            rows, queries = (convert(x) if x.size else x.astype(kind) for x in (rows, queries))
        return np.stack([queries[:, part] @ rows[:, part].T for part in self.lists])

    @staticmethod
    def total(local: np.ndarray) -> np.ndarray:
        total = local.sum(axis=0)
        return np.clip(total, -MOST, MOST).astype(np.int64) if total.dtype == object else total

    def best(self, scores: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
        """Of the rows ``at``, the k of the highest scores, ties to the smaller id."""
        if len(at) > k:
            least = np.partition(scores[at], len(at) - k)[len(at) - k]
            at = at[scores[at] >= least]
        return at[np.lexsort((self.ids[at], -scores[at]))[:k]]


def _first_phase(block: Block, queries: np.ndarray, ids: np.ndarray, cutoffs: np.ndarray, k: int):
    local = block.local(queries)
    total = block.total(local)
    for i, own in enumerate(ids.tolist()):
        others = np.flatnonzero(block.ids != own)
        lists = (block.total(part[None, i]) for part in local)
        seen = np.unique(np.concatenate([block.best(part, others, k) for part in lists]))
        yield own, block.best(total[i], seen, k), total[i]


def _other_phases(block: Block, queries: np.ndarray, ids: np.ndarray, cutoffs: np.ndarray, k: int):
    local = block.local(queries)
    for i, own in enumerate(ids.tolist()):
        scores, cutoff = local[:, i], cutoffs[i]
        at = np.flatnonzero(block.ids != own)
        if cutoff == -MOST:
            cutoff = None  # cut: scores may be lower
        if cutoff is not None:
            # Above the threshold: the cutoff by the number of lists, as whole numbers.
            enough = LISTS * scores[:, at] >= cutoff
            some = enough.any(axis=0)
            at, enough = at[some], enough[:, some]
            highest = np.where(enough, LISTS * scores[:, at], cutoff).sum(axis=0)
            at = at[highest >= LISTS * cutoff]
        found = block.total(scores[:, at])
        total = np.zeros(len(block.ids), found.dtype)
        total[at] = found
        if cutoff is not None:
            at = at[found >= cutoff]
        yield own, block.best(total, at, k), total


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1) if batch.num_rows and len(flat) else np.zeros((batch.num_rows, 0))


def _scored(units: DataFrame, phase, k: int) -> DataFrame:
    def rows(batches):
        unit, held, block = None, [], None
        for batch in batches:
            kinds = np.stack([batch.column(c).to_numpy() for c in ("size", "x", "y", "kind")], axis=1)
            edges = np.flatnonzero((kinds[1:] != kinds[:-1]).any(axis=1)) + 1
            for first, last in zip([0, *edges.tolist()], [*edges.tolist(), len(kinds)]):
                if first == last:
                    continue
                piece = batch.slice(first, last - first)
                if unit != tuple(kinds[first, :3]):
                    unit, held, block = tuple(kinds[first, :3]), [], None
                if kinds[first, 3] == 0:
                    held.append((piece.column("vec_id").to_numpy(), _vectors(piece)))
                    continue
                if not held and block is None:
                    continue  # queries whose block of rows is empty
                if block is None:
                    block = Block(*(np.concatenate(x) for x in zip(*held)))
                    held = []
                ids, vectors = piece.column("vec_id").to_numpy(), _vectors(piece)
                cutoffs = np.array(piece.column("cutoff").to_pylist(), object)
                for a in range(0, len(ids), CHUNK):
                    b = a + CHUNK
                    out = [
                        (own, int(block.ids[j]), int(score[j]))
                        for own, at, score in phase(block, vectors[a:b], ids[a:b], cutoffs[a:b], k)
                        for j in at.tolist()
                    ]
                    yield pa.record_batch(
                        [pa.array(c, pa.int64()) for c in (zip(*out) if out else ([], [], []))],
                        ["query_id", "vec_id", "score"],
                    )

    return units.mapInArrow(rows, SCORED)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest scores of each row for which
    ``is_query`` holds (an expression of vec_id), against every row but its own."""
    rows = stored(whole_vectors(vectors), "topk-rows")
    queries = rows.where(is_query).groupBy("vec_id", F.size("v")).agg(F.min("v").alias("v")).select("vec_id", "v")
    queries = stored(queries, "topk-queries")
    sizes = rows.count(), queries.count()
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    start = queries.withColumn("cutoff", F.lit(None).cast("long"))
    first = _scored(_units(rows, start, *sizes), _first_phase, k)
    kth = first.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") == k)
    cutoffs = kth.select(F.col("query_id").alias("vec_id"), F.col("score").alias("cutoff"))
    start = stored(queries.join(cutoffs, "vec_id", "left"), "topk-cutoffs")
    found = _scored(_units(rows, start, *sizes), _other_phases, k)
    ranked = found.withColumn("rank", F.row_number().over(by_query))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
