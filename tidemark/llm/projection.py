"""Near-duplicate vectors by sorted projection passes.

A pass orders the vectors of one label lexicographically by the signs of random
projections, concatenated, and then by one projection: near vectors come to stand near
each other. Each vector is compared with ``WINDOW`` neighbours behind it. Pairs that reach
the cosine, in double precision, are united to components over ``PASSES`` passes, each with
hashes of its own.

Links are then counted in full within each component, as a window holds only a part of a
large one. A component of more than ``LARGE`` vectors gets a centre: vectors within half of
the bound's angle of it all link with each other, so they are counted, not compared. The
others are compared with all vectors of the component, block against block, and no more
than two blocks of about ``BLOCK`` vectors meet in a task.

Spark range-partitions a pass, so a label of any size is spread. Inside a partition rows
stream by in order and only a window is held; rows at the ends of partitions meet those of
the next partition in a second step. Equal vectors are one class with a weight before
that, so a group of copies costs one row a pass.

Links between components that no pass brought together are not found. Recall at the default
settings is measured in tests/llm against all pairs.

Null vectors, zero ones and those with null or non-finite parts link with nothing, as do
null labels; vectors of different lengths are not compared. Rows with a null id are
returned unlinked. Rows that repeat an id count as copies of each other if they are equal;
with different vectors they are one vector to the rest, linked where any of them is. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, stored

PASSES = 24
BITS = 20
WINDOW = 192
STRETCH = 256
#: Vectors of a component from which on it gets a centre; vectors of a compared block;
#: parts in which a large component is joined with its few numbers.
LARGE = 512
BLOCK = 4096
SALT = 128
#: Angle by which a vector has to be nearer than the half of the bound's.
SURE = 1e-6
#: Vectors whose cosine, rounded, is so close to the bound are compared by the plain formula.
CLOSE = 1e-9


def classes_of(vectors: DataFrame) -> DataFrame:
    """(id, label, vec, copies): distinct usable vectors of a label under their smallest id."""
    usable = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    # 0.0 and -0.0 are equal numbers.
    plain = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
    return (
        vectors.where(usable)
        .select("vec_id", "label", plain.alias("vec"))
        .groupBy("label", "vec")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    )


def _keyed(classes: DataFrame, passes: int, bits: int, seed: int) -> DataFrame:
    """A row per vector and pass: its signs, one finer projection, and the vector."""

    def rows(batches):
        for batch in batches:
            lengths = np.array([len(v) for v in batch.column("vec").to_pylist()], np.int64)
            flat = np.array(batch.column("vec").flatten().to_numpy(), np.float64)
            heads = np.cumsum(lengths) - lengths
            for length in np.unique(lengths).tolist():
                own = np.flatnonzero(lengths == length)
                vecs = flat[heads[own][:, None] + np.arange(length)]
                part = batch.take(pa.array(own))
                for turn in range(passes):
                    axes = np.random.default_rng([seed, turn, length]).standard_normal((length, bits + 1))
                    seen = vecs / np.linalg.norm(vecs, axis=1, keepdims=True) @ axes
                    # The length comes first, so that only vectors of one length meet.
                    signs = (seen[:, :bits] > 0) @ (1 << np.arange(bits)[::-1])
                    yield pa.record_batch(
                        [
                            pa.array([turn] * len(own), pa.int32()),
                            part.column("label").cast(pa.int64()),
                            pa.array([length] * len(own), pa.int32()),
                            pa.array(signs.astype(np.int64)),
                            pa.array(seen[:, bits]),
                            part.column("id"),
                            pa.array([v.tobytes() for v in vecs], pa.binary()),
                        ],
                        ["turn", "label", "length", "signs", "fine", "id", "vec"],
                    )

    return classes.select("label", "id", "vec").mapInArrow(
        rows, "turn int, label bigint, length int, signs bigint, fine double, id bigint, vec binary"
    )


def _reached(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Whether row i of ``a`` and row j of ``b`` have a cosine of ``least`` or more."""
    ua = a / np.linalg.norm(a, axis=1, keepdims=True)
    ub = b / np.linalg.norm(b, axis=1, keepdims=True)
    cosine = ua @ ub.T
    linked = cosine >= least
    i, j = np.nonzero(np.abs(cosine - least) <= CLOSE)
    if len(i):
        x, y = a[i], b[j]
        linked[i, j] = (x * y).sum(1) / np.sqrt((x * x).sum(1) * (y * y).sum(1)) >= least
    return linked


def _linked(a: np.ndarray, b: np.ndarray, least: float, gap: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i in a, j in b) of cosine ``least`` or more; b's rows stand ``gap`` places
    behind a's, and pairs more than ``window`` places apart are not asked for."""
    apart = gap + np.arange(len(b))[None, :] - np.arange(len(a))[:, None]
    return np.nonzero(_reached(a, b, least) & (apart > 0) & (apart <= window))


def _joined(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer pairs of ids (the smaller first) that join what the links of places i and j join."""
    places = np.arange(len(ids))
    top, before = places, None
    while before is None or (top != before).any():
        before, top = top, top.copy()
        low = np.minimum(before[i], before[j])
        np.minimum.at(top, i, low)
        np.minimum.at(top, j, low)
        top = top[top]
    own = np.flatnonzero(top != places)
    return np.minimum(ids[top[own]], ids[own]), np.maximum(ids[top[own]], ids[own])


PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("seam", pa.int64()), ("row", pa.binary())])
_KEYS = ("turn", "label", "length")


def _windows(least: float, window: int):
    """Compares rows that stand near each other in a partition; its first and last rows go on."""

    def rows(batches):
        part = TaskContext.get().partitionId()
        key, ids, vecs, head, seen = None, np.zeros(0, np.int64), None, 0, 0

        def seam(number, key, ids, vecs, tail):
            rows = [pack_row(key, i, v, tail) for i, v in zip(ids.tolist(), vecs)]
            n = len(rows)
            return pa.record_batch(
                [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array([number] * n, pa.int64()), pa.array(rows, pa.binary())],
                schema=PAIRS,
            )

        started = False
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in _KEYS)))
            own_ids = batch.column("id").to_numpy()
            raw = batch.column("vec").to_pylist()
            first = 0
            while first < len(keys):
                last = first + 1
                stop = min(len(keys), first + STRETCH)
                while last < stop and keys[last] == keys[first]:
                    last += 1
                block = np.frombuffer(b"".join(raw[first:last]), np.float64).reshape(last - first, -1)
                block_ids = own_ids[first:last]
                if keys[first] != key:
                    key, ids, vecs = keys[first], block_ids[:0], block[:0]
                    seen = 0
                    fresh = not started
                if not started or (fresh and seen < window):
                    # The first rows of the partition meet the end of the one before.
                    n = max(0, window - seen)
                    if n:
                        yield seam(part, key, block_ids[:n], block[:n], False)
                started = True
                i, j = _linked(vecs, block, least, len(vecs), window) if len(vecs) else (np.zeros(0, int),) * 2
                p, q = _linked(block, block, least, 0, window)
                m = len(vecs)
                a, b = _joined(
                    np.concatenate([ids, block_ids]), np.concatenate([i, p + m]), np.concatenate([j + m, q + m])
                )
                if len(a):
                    n = len(a)
                    yield pa.record_batch(
                        [pa.array(a), pa.array(b), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())],
                        schema=PAIRS,
                    )
                seen += len(block)
                ids = np.concatenate([ids, block_ids])[-window:]
                vecs = np.concatenate([vecs, block])[-window:]
                first = last
        if len(ids):
            yield seam(part + 1, key, ids, vecs, True)

    return rows


def pack_row(key: tuple, i: int, vec: np.ndarray, tail: bool) -> bytes:
    return np.array([*key, i, int(tail)], "<i8").tobytes() + vec.astype("<f8").tobytes()


def _seams(least: float, window: int):
    def pairs(rows: pa.Table) -> pa.Table:
        tails, heads = [], []
        for raw in rows.column("row").to_pylist():
            numbers = np.frombuffer(raw, "<i8", 5)
            (tails if numbers[4] else heads).append((tuple(numbers[:3].tolist()), int(numbers[3]), np.frombuffer(raw, "<f8", offset=40)))
        out_a, out_b = [], []
        if tails and heads and tails[0][0] == heads[0][0]:
            a, b = np.stack([x[2] for x in tails]), np.stack([x[2] for x in heads])
            i, j = _linked(a, b, least, len(a), window + len(a) + len(b))
            ids_a, ids_b = np.array([x[1] for x in tails]), np.array([x[1] for x in heads])
            out_a, out_b = _joined(np.concatenate([ids_a, ids_b]), i, j + len(a))
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return pairs


def similar_pairs(
    classes: DataFrame, least: float = 0.98, passes: int = PASSES, bits: int = BITS, window: int = WINDOW
) -> DataFrame:
    """(a, b): linked classes, a < b; enough of the pairs found to join all that they join."""
    order = ["turn", "label", "length", "signs", "fine", "id"]
    found = stored(
        _keyed(classes, passes, bits, 7)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_windows(least, window), "a bigint, b bigint, seam bigint, row binary"),
        "projection-pairs",
    )
    inner = found.where("a IS NOT NULL").select("a", "b")
    across = found.where("seam IS NOT NULL").select("seam", "row")
    across = across.groupBy("seam").applyInArrow(_seams(least, window), "a bigint, b bigint")
    return inner.unionByName(across).where("a <> b").distinct()


GROUP = ["component", "label", "length"]


def _salted(groups: DataFrame) -> DataFrame:
    """A row per group and part, so that a large group's rows do not meet in one task."""
    return groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))


def _matrix(column) -> np.ndarray:
    """Vectors of one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.array(column.flatten(), np.float64).reshape(len(column), -1)


def _units(vecs: np.ndarray) -> np.ndarray:
    return vecs / np.linalg.norm(vecs, axis=1, keepdims=True)


def _partial_sums(batches):
    """Sum of the unit vectors of each group in a batch."""
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in GROUP)))
        places: dict[tuple, list[int]] = {}
        for at, key in enumerate(keys):
            places.setdefault(key, []).append(at)
        sums = [_units(_matrix(batch.column("vec").take(pa.array(at)))).sum(0).tolist() for at in places.values()]
        columns = [pa.array(list(c), pa.int64()) for c in zip(*places)] if places else [pa.array([], pa.int64())] * 3
        yield pa.record_batch([*columns, pa.array(sums, pa.list_(pa.float64()))], [*GROUP, "centre"])


def _sum(rows: pa.Table) -> pa.Table:
    return rows.slice(0, 1).select(GROUP).append_column(
        "centre", pa.array([_matrix(rows.column("centre")).sum(0).tolist()], pa.list_(pa.float64()))
    )


def _cores(least: float):
    """Whether a vector is so near to its group's centre that it links with all such ones."""
    most = np.arccos(np.clip(least, -1, 1)) / 2 - SURE

    def rows(batches):
        for batch in batches:
            core = np.zeros(batch.num_rows, bool)
            lengths = np.array(batch.column("length"))
            asked = ~np.array(batch.column("odd")) & np.array(batch.column("centre").is_valid())
            for length in np.unique(lengths[asked]).tolist():
                at = np.flatnonzero(asked & (lengths == length))
                vecs = _units(_matrix(batch.column("vec").take(pa.array(at))))
                centres = _matrix(batch.column("centre").take(pa.array(at)))
                sizes = np.linalg.norm(centres, axis=1)
                cosine = (vecs * centres).sum(1) / np.where(sizes > 0, sizes, 1)
                core[at] = (sizes > 0) & (np.arccos(np.clip(cosine, -1, 1)) <= most)
            kept = [batch.column(c) for c in MEMBERS]
            yield pa.record_batch([*kept, pa.array(core)], [*MEMBERS, "core"])

    return rows


MEMBERS = [*GROUP, "id", "vec", "copies", "odd", "salt"]
_MEMBERS = "component bigint, label bigint, length bigint, id bigint, vec array<double>, copies bigint, odd boolean, salt int"


def _compared(least: float):
    """Two blocks of a group: for each id the copies of those it links with, and the links of odd ids."""

    def links(rows: pa.Table) -> pa.Table:
        side = np.array(rows.column("side"))
        vecs, ids = _matrix(rows.column("vec")), np.array(rows.column("id"))
        odd = np.array(rows.column("odd"))
        copies = np.where(odd, 0, np.array(rows.column("copies"))).astype(float)
        one = rows.column("kind")[0].as_py() == 0 and rows.column("x")[0].as_py() == rows.column("y")[0].as_py()
        a = np.flatnonzero(side == 0)
        b = a if one else np.flatnonzero(side == 1)
        linked_copies = np.zeros(len(ids))
        pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for first in range(0, len(a), STRETCH):
            own = a[first : first + STRETCH]
            linked = _reached(vecs[own], vecs[b], least)
            if one:
                linked[np.arange(len(own)), first + np.arange(len(own))] = False
            for p, q in (np.nonzero(linked & odd[own][:, None]), np.nonzero(linked & ~odd[own][:, None] & odd[b])):
                pairs += [(ids[own[p]], ids[b[q]]), (ids[b[q]], ids[own[p]])]
            linked[odd[own]] = False
            linked_copies[own] += linked @ copies[b]
            if not one:
                linked_copies[b] += np.where(odd[b], 0, copies[own] @ linked)
        some = np.flatnonzero(linked_copies)
        p, q = (np.concatenate(x) for x in zip(*pairs))
        return pa.table(
            {
                "id": pa.array(np.concatenate([ids[some], p])),
                "other": pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(q)]),
                "w": pa.concat_arrays([pa.array(linked_copies[some].astype(np.int64)), pa.nulls(len(q), pa.int64())]),
            }
        )

    return links


def link_counts(classes: DataFrame, found: DataFrame, least: float, large: int = LARGE, block: int = BLOCK) -> DataFrame:
    """(id, linked): copies of all classes that a class links with in its component.

    Ids of several classes (``odd``) are one vector to the rest, so their links are
    listed and told apart; all others are added up.
    """
    odd = classes.groupBy("id").count().where("count > 1").select("id", F.lit(True).alias("odd"))
    salt = F.pmod(F.hash("id"), F.lit(SALT)).alias("salt")
    members = stored(
        classes.join(found, "id")
        .join(odd, "id", "left")
        .select(
            F.col("component").cast("long"), F.col("label").cast("long"), F.size("vec").cast("long").alias("length"),
            "id", "vec", "copies", F.coalesce("odd", F.lit(False)).alias("odd"), salt,
        ),
        "projection-members",
    )
    sizes = members.groupBy(*GROUP).count().where(F.col("count") > large).select(*GROUP)
    centres = stored(
        members.join(_salted(sizes), [*GROUP, "salt"], "left_semi")
        .mapInArrow(_partial_sums, "component bigint, label bigint, length bigint, centre array<double>")
        .groupBy(*GROUP)
        .applyInArrow(_sum, "component bigint, label bigint, length bigint, centre array<double>"),
        "projection-centres",
    )
    placed = stored(
        members.join(_salted(centres), [*GROUP, "salt"], "left")
        .select(*MEMBERS, "centre")
        .mapInArrow(_cores(least), _MEMBERS + ", core boolean"),
        "projection-members",
    )
    plain = F.col("core").cast("long")
    totals = stored(
        placed.groupBy(*GROUP)
        .agg(
            F.ceil(F.sum(1 - plain) / block).alias("outer_blocks"),
            F.ceil(F.sum(plain) / block).alias("core_blocks"),
            F.sum(plain * F.col("copies")).alias("core_copies"),
            F.count("*").alias("n"),
        )
        .where(F.col("n") > large),
        "projection-totals",
    )
    numbered = placed.join(_salted(totals), [*GROUP, "salt"], "left").select(
        *placed.columns,
        F.coalesce("outer_blocks", F.lit(1)).alias("outer_blocks"),
        F.coalesce("core_blocks", F.lit(0)).alias("core_blocks"),
        "core_copies",
    )
    numbered = numbered.withColumn(
        "own", F.expr("pmod(xxhash64(id), greatest(1, IF(core, core_blocks, outer_blocks)))")
    )
    others = """IF(core,
        transform(filter(sequence(0L, outer_blocks), i -> i < outer_blocks),
            i -> struct(1 AS kind, i AS x, own AS y, 1 AS side)),
        concat(
            transform(sequence(0L, outer_blocks - 1),
                i -> struct(0 AS kind, greatest(i, own) AS x, least(i, own) AS y, IF(i > own, 1, 0) AS side)),
            transform(filter(sequence(0L, core_blocks), i -> i < core_blocks),
                i -> struct(1 AS kind, own AS x, i AS y, 0 AS side))))"""
    compared = stored(
        numbered.select(*GROUP, "id", "vec", "copies", "odd", F.expr(f"inline({others})"))
        .groupBy(*GROUP, "kind", "x", "y")
        .applyInArrow(_compared(least), "id bigint, other bigint, w bigint"),
        "projection-counts",
    )
    weights = classes.select(F.col("id").alias("other"), F.col("copies").alias("w"))
    listed = compared.where("other <> id").select("id", "other").distinct().join(weights, "other").select("id", "w")
    sure = numbered.where("core").select("id", (F.col("core_copies") - F.col("copies")).alias("w"))
    return (
        compared.where("other IS NULL").select("id", "w").unionByName(listed).unionByName(sure)
        .groupBy("id")
        .agg(F.sum("w").alias("linked"))
    )


def link_vectors(vectors: DataFrame, least: float = 0.98, **settings) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector."""
    vectors = vectors.select("vec_id", "label", "embedding")
    classes = stored(classes_of(vectors), "projection-classes")
    pairs = stored(similar_pairs(classes, least, **settings), "projection-links")
    found = stored(components(pairs, "projection"), "projection-components")
    links = link_counts(classes, found, least)
    per_class = stored(
        classes.join(links, "id", "left")
        .join(found, "id", "left")
        .select(
            "id",
            F.col("label").alias("own_label"),
            "vec",
            (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        ),
        "projection-classes",
    )
    plain = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
    rows = vectors.select("vec_id", "label", F.when(F.col("vec_id").isNotNull(), plain).alias("own"))
    joined = rows.join(
        per_class, (rows["label"] == per_class["own_label"]) & (rows["own"] == per_class["vec"]), "left"
    )
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
