"""Near duplicates by bottom-k sketches of word shingles.

One hash function orders all shingles; a document keeps its ``K`` smallest. Documents with
equal shingle sets are one class, and classes are compared:

1. Inverted lists of the retained values give overlaps. A value that only one class keeps
   is in no pair. Two classes of Jaccard similarity ``t`` or more share at least
   ``_needed`` retained values (all but about 1e-7 of such pairs, by the binomial law), so
   if each class lists its rarest values, as many as leave fewer than that, they meet in
   at least one list. Frequent values, as of a passage in a third of all texts, come last
   and are seldom listed.
2. Sketches are compared by estimating the similarity from the smallest values of the
   union; pairs go that have fewer in common than all but 1e-7 of the pairs at ``t``.
3. The rest is confirmed on full sets, exactly. Pairs are gathered in blocks of a cluster's
   members first, so a set is sent once per block and not once per pair; large clusters are
   cut into several blocks.

A list does not give all its pairs. First some members of each (the same in all lists of one
cluster) meet the others: the one whose retained values are the most common, as those of a
text are from which the others were made, and ``PIVOTS`` more; a list whose members are then linked with each other ends,
so a group of m copies costs a few times m comparisons instead of m squared. In what is
left, members of different components are compared in full, a large list part by part, if
enough retained values agree. So no link between components is lost. Here pairs never
become rows: a task folds the pairs that may be similar into stars, whose components are
families; members of a family get their full sets, meet again part by part, and what is
confirmed becomes stars too. So rows grow with the members, whatever a family's size.

A bitmap of each set (a bit per hash, modulo its size) goes along: bits of one that the other
lacks are shingles that it lacks, so they bound the similarity from above. That rules out
most pairs of small sets whose sketches come too close to tell, and never a similar one.

Texts with fewer words than a shingle are one shingle as a whole; texts without words
(null and empty ones too) have no shingle, no links, and stand for themselves. Rows with a
null id are not compared; they are returned with a null component, kept. Where rows repeat
an id with different texts, the one of the least digest is compared; the others follow the
documents that equal them, or stand for themselves. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import LOWER, distinct, flat_ranges, groups, mix, run_hashes, utf8, word_hashes, words
from tidemark.llm.common import components, local_stars, stored, top_of

K = 64
WORDS = 5
PIVOTS = 2
#: Members on either side of a block of pairs, about.
MEMBERS = 128
#: 64-bit words of a set's bitmap.
BITS = 16
#: Members of a part of a list, about; pairs of them that are compared at once.
LIST, PAIRS = 1024, 1 << 13
#: Shingles of a part of a family, about: 4 MB of them.
SHINGLES = 500_000
#: So many ids go to all tasks at most.
SENT = 500_000
SLICE = 250_000


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, and their number per text."""
    data = LOWER[data]
    starts, ends, bounds = words(data, offsets)
    own = word_hashes(data, starts, ends, 3)
    hashes, at = run_hashes(own, bounds, n)
    text = np.searchsorted(bounds, at, "right") - 1
    counts = np.diff(bounds)
    for size in range(1, n):
        short = np.flatnonzero(counts == size)
        if len(short):
            runs = np.zeros(len(short), np.uint64)
            for j in range(size):
                runs = runs * np.uint64(0x9E3779B97F4A7C15) + own[bounds[short] + j]
            hashes = np.concatenate([hashes, mix(runs + np.uint64(size))])
            text = np.concatenate([text, short])
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    fresh = np.append(True, (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1]))[: len(text)]
    hashes, text = hashes[fresh], text[fresh]
    return hashes, np.bincount(text, minlength=len(counts)).astype(np.int64)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Lists of hashes as signed numbers of the same order."""
    values = values ^ np.uint64(1 << 63)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _heads(counts: np.ndarray, most: int) -> np.ndarray:
    """Indices of the first ``most`` items of each run."""
    return flat_ranges(np.cumsum(counts) - counts, np.minimum(counts, most))


def sketched(docs: DataFrame, n: int = WORDS, k: int = K) -> DataFrame:
    """(doc_id, n_shingles, whole, sketch, bits): set size, a digest of the set, its k smallest
    hashes, its bitmap."""

    def rows(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for first, last in groups(offsets, SLICE):
                own = offsets[first : last + 1]
                hashes, counts = shingle_sets(data[own[0] : own[-1]], own - own[0], n)
                digests = _digests(hashes, counts)
                at = _heads(counts, k)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(counts),
                        pa.array(digests),
                        _lists(hashes[at], np.minimum(counts, k)),
                        _bitmaps(hashes, counts),
                    ],
                    ["doc_id", "n_shingles", "whole", "sketch", "bits"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        rows, "doc_id bigint, n_shingles bigint, whole string, sketch array<bigint>, bits array<bigint>"
    )


def _bitmaps(hashes: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A list of ``BITS`` words for each set."""
    bits, ends = 64 * BITS, np.concatenate([[0], np.cumsum(counts)])
    found = []
    for first in range(0, len(counts), 1024):
        own = counts[first : first + 1024]
        flags = np.zeros((len(own), bits), bool)
        part = hashes[ends[first] : ends[first + len(own)]]
        flags[np.repeat(np.arange(len(own)), own), (part % np.uint64(bits)).astype(np.int64)] = True
        found.append(np.packbits(flags, axis=1).reshape(-1).view(np.int64))
    words = np.concatenate([np.zeros(0, np.int64), *found])
    return pa.ListArray.from_arrays(pa.array(np.arange(len(counts) + 1, dtype=np.int32) * BITS), pa.array(words))


def _digests(hashes: np.ndarray, counts: np.ndarray) -> list[str]:
    """128 bits that tell sets apart."""
    ends = np.concatenate([[0], np.cumsum(counts)])
    halves = []
    for salt in (0, 1):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes + np.uint64(salt)))])
        halves.append((sums[ends[1:]] - sums[ends[:-1]]).tolist())
    return [f"{a:016x}{b:016x}" for a, b in zip(*halves)]


def full_sets(docs: DataFrame, n: int) -> DataFrame:
    """(id, hashes): all shingle hashes of the texts whose digest is ``whole``."""

    def rows(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for first, last in groups(offsets, SLICE):
                own = offsets[first : last + 1]
                hashes, counts = shingle_sets(data[own[0] : own[-1]], own - own[0], n)
                part = batch.slice(first, last - first)
                wanted = [a == b for a, b in zip(part.column(1).to_pylist(), _digests(hashes, counts))]
                found = pa.record_batch([part.column(0), _lists(hashes, counts)], ["id", "hashes"])
                yield found.filter(pa.array(wanted, pa.bool_()))

    return docs.select("id", "whole", "text").mapInArrow(rows, "id bigint, hashes array<bigint>")


def _needed(k: int, percent: int) -> int:
    """Retained values that two similar sets of more than k shingles share, but for 1e-7 of them."""
    p, total = percent / 100, 0.0
    for x in range(k + 1):
        total += math.comb(k, x) * p**x * (1 - p) ** (k - x)
        if total > 1e-7:
            return x
    return k


def _needed_of(size, k: int, percent: int):
    """Retained values that a set of this size shares with any similar one, as a column."""
    few = F.least(F.ceil(size * percent / 100), F.lit(_needed(k, percent)))
    return F.when(size > k, F.lit(_needed(k, percent))).otherwise(few)


def _prefixes(classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(id, size, common, listed): the rarest shared values of each class, in one order for
    all, and how often all its values are kept."""
    values = classes.select("id", F.col("n_shingles").alias("size"), F.explode("sketch").alias("value"))
    shared = values.groupBy("value").agg(F.count("*").alias("often")).where("often > 1")
    met = values.join(shared, "value")
    kept = F.least(F.col("size"), F.lit(k))
    # Values of one class only come first in the order and take their share of the prefix.
    per_class = met.groupBy("id", "size").agg(
        F.array_sort(F.collect_list(F.struct("often", "value"))).alias("all")  # at most k
    )
    prefix = kept - _needed_of(F.col("size"), k, percent) + 1 - (kept - F.size("all"))
    listed = F.slice("all", F.lit(1), F.greatest(prefix.cast("int"), F.lit(0)))
    common = F.aggregate("all", F.lit(0).cast("long"), lambda total, x: total + x["often"])
    values = F.transform(listed, lambda x: x["value"]).alias("listed")
    return per_class.select("id", "size", common.alias("common"), values).where(F.size("listed") > 0)


def _close(k: int, percent: int, *names: str):
    """Whether two sketches (and set sizes) leave the similarity possible: of the k smallest
    values of the union so many are common as in all but 1e-7 of similar pairs."""
    sketch_a, sketch_b, size_a, size_b = map(F.col, names)
    union = F.array_union(sketch_a, sketch_b)
    least = F.slice(F.array_sort(union), F.lit(1), F.lit(k))
    both = F.array_intersect(sketch_a, sketch_b)
    estimate = F.size(F.array_intersect(least, both)) >= _needed(k, percent)
    exact = F.size(both) * 100 >= F.size(union) * percent
    enough = F.size(both) >= F.least(_needed_of(size_a, k, percent), _needed_of(size_b, k, percent))
    return enough & F.when((size_a <= k) & (size_b <= k), exact).otherwise(estimate)


def _homes(close: DataFrame) -> DataFrame:
    """(id, home): of a document and those it may be similar to, the first in the order of the
    pivots. Members of one cluster mostly have the same."""
    both = close.select(F.col("a").alias("id"), F.col("b").alias("o"))
    both = both.union(close.select("b", "a")).union(both.select("id", "id"))
    rank = F.struct(F.xxhash64("o", F.lit(0)), "o")
    return both.groupBy("id").agg(F.min(rank).alias("r")).select("id", F.col("r.o").alias("home"))


def _blocks(close: DataFrame, homes: DataFrame) -> DataFrame:
    """(block, a, b): pairs by the homes of their members, and by parts of these if there are many."""
    a = homes.select(F.col("id").alias("a"), F.col("home").alias("ha"))
    b = homes.select(F.col("id").alias("b"), F.col("home").alias("hb"))
    home = lambda h, i: F.coalesce(F.col(h), F.col(i))
    pairs = close.join(a, "a", "left").join(b, "b", "left").select(
        "a", "b", F.least(home("ha", "a"), home("hb", "b")).alias("x"), F.greatest(home("ha", "a"), home("hb", "b")).alias("y")
    )
    parts = lambda c: F.ceil(F.approx_count_distinct(c) / MEMBERS)
    sizes = pairs.groupBy("x", "y").agg(parts("a").alias("na"), parts("b").alias("nb"))
    part = lambda c, n: F.pmod(F.xxhash64(c), F.greatest(F.col(n), F.lit(1)))
    block = F.struct("x", "y", part("a", "na").alias("i"), part("b", "nb").alias("j"))
    return pairs.join(sizes, ["x", "y"]).select(block.alias("block"), "a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (block, a, b) similar on full sets, as (a, b)."""
    ids = pairs.select("block", F.col("a").alias("id")).union(pairs.select("block", "b")).distinct()
    members = ids.join(sets, "id").select(
        "block", "id", F.lit(None).cast("long").alias("other"), "hashes"
    )
    rows = members.union(
        pairs.select("block", "a", "b", F.lit(None).cast("array<bigint>").alias("hashes"))
    )

    def similar(table: pa.Table) -> pa.Table:
        ids, others = table.column("id").to_pylist(), table.column("other").to_pylist()
        hashes = table.column("hashes")
        own = {i: hashes[k].values.to_numpy() for k, i in enumerate(ids) if others[k] is None}
        kept = []
        for i, j in zip(ids, others):
            if j is not None:
                x, y = own[i], own[j]
                both = len(np.intersect1d(x, y, True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    kept.append((i, j))
        return pa.table(
            {"a": pa.array([x[0] for x in kept], pa.int64()), "b": pa.array([x[1] for x in kept], pa.int64())}
        )

    return rows.groupBy("block").applyInArrow(similar, "a bigint, b bigint")


def _bits_fit(percent: int, a: str, b: str, size_a: str, size_b: str):
    """Whether two bitmaps leave the similarity possible: so many bits that only one of them has
    are as many shingles, at least, that only one set has. ``_pairs_of_blocks`` has the same rule
    on arrays; this one is for tables of pairs."""
    # As one loop: written out, the join's generated code is too long to be compiled.
    only = lambda x, y: F.aggregate(
        F.zip_with(x, y, lambda u, v: F.bit_count(u.bitwiseAND(F.bitwise_not(v)))),
        F.lit(0),
        lambda total, n: total + n,
    )
    size_a, size_b, x, y = F.col(size_a), F.col(size_b), only(a, b), only(b, a)
    return ((size_a - x) * 100 >= (size_a + y) * percent) & ((size_b - y) * 100 >= (size_b + x) * percent)


def _sizes_fit(percent: int, a: str, b: str):
    return (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)


def _pivot_pairs(members: DataFrame) -> DataFrame:
    """(a, sa, b, sb): each list's pivots with its members. A pivot comes first in an order
    that holds for all lists, so lists with the same members have the same one."""
    ranks = [-F.col("common"), *(F.xxhash64("id", F.lit(i)) for i in range(PIVOTS))]
    orders = [F.min(F.struct(rank.alias("rank"), "id", "size")) for rank in ranks]
    orders = [F.struct(o["id"].alias("id"), o["size"].alias("size")) for o in orders]
    pivots = members.groupBy("value").agg(F.array_distinct(F.array(*orders)).alias("p"), F.count("*").alias("m"))
    pivots = pivots.where("m > 1").select("value", F.explode("p").alias("p"))
    pivots = pivots.select("value", F.col("p.id").alias("a"), F.col("p.size").alias("sa"))
    met = members.join(pivots, "value")
    return met.where(F.col("id") != F.col("a")).select("a", "sa", F.col("id").alias("b"), F.col("size").alias("sb"))


def _families(prefixes: DataFrame, classes: DataFrame, found: DataFrame, k: int, percent: int) -> DataFrame:
    """(id, family): classes that meet in a list, in different components, with bitmaps and
    sketches that leave the similarity possible; a family holds all that such pairs connect."""
    top = prefixes.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    rows = top.select("id", "size", "component", F.explode("listed").alias("value"))
    parts = F.ceil(F.count("*") / LIST).cast("int").alias("parts")
    several = rows.groupBy("value").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), parts)
    rows = rows.join(several.where("lo <> hi").select("value", "parts"), "value")
    rows = stored(rows, "minhash-members")
    if rows.isEmpty():
        return rows.select("id", F.col("id").alias("family"))
    rows = rows.join(classes.select("id", "sketch", "bits"), "id")
    close = stored(_met(rows, k, percent), "minhash-close")
    return stored(components(close, "minhash").withColumnRenamed("component", "family"), "minhash-families")


def _linked_in_families(
    docs: DataFrame, classes: DataFrame, families: DataFrame, found: DataFrame, n: int, k: int, percent: int
) -> DataFrame:
    """(a, b): links on full sets that connect the components of each family."""
    members = families.select("id", F.col("family").alias("value")).join(
        classes.select("id", F.col("n_shingles").alias("size"), "sketch", "bits"), "id"
    )
    parts = F.ceil(F.greatest(F.sum("size") / SHINGLES, F.count("*") / LIST)).cast("int").alias("parts")
    parts = members.groupBy("value").agg(parts)
    members = members.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    sets = stored(full_sets(_texts(docs, classes, families.select("id")), n), "minhash-sets")
    sets = sets.groupBy("id").agg(F.any_value("hashes").alias("hashes"))  # rows may repeat an id
    rows = members.join(parts, "value").join(sets, "id")
    return stored(_met(rows, k, percent), "minhash-links")


def _met(rows: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b): stars of the pairs that ``_compared`` finds among the rows of each value, which
    are in ``parts`` parts: members of part x meet those of part y in block (x, y)."""
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    others = [c for c in rows.columns if c not in ("value", "parts")]
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    block = ["value", "x", "y"]
    rows = rows.select(
        "value", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), *others,
    )
    rows = rows.repartition(*block).sortWithinPartitions(*block, "side")
    return rows.mapInArrow(lambda batches: local_stars(_compared(batches, k, percent)), "a bigint, b bigint")


def _compared(batches, k: int, percent: int):
    """Pairs (a, b) of rows that lie together by block (value, x, y) and side: those that may be
    similar, or, of rows with full sets, similar ones that connect the components."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        last = _block_starts(rows)[-1:]
        if len(last):
            yield from _pairs_of_blocks(rows.slice(0, last[0]), k, percent)
            rows = rows.slice(last[0])
        held = rows
    if held is not None:
        yield from _pairs_of_blocks(held, k, percent)


def _block_starts(rows: pa.Table) -> np.ndarray:
    fresh = np.zeros(rows.num_rows, bool)
    fresh[:1] = True
    for name in ("value", "x", "y"):
        numbers = rows.column(name).to_numpy()
        fresh[1:] |= numbers[1:] != numbers[:-1]
    return np.flatnonzero(fresh)


def _pairs_of_blocks(rows: pa.Table, k: int, percent: int):
    starts, n = _block_starts(rows), rows.num_rows
    ids, sizes, component, side = (rows.column(c).to_numpy() for c in ("id", "size", "component", "side"))
    bits, _ = _matrix(rows.column("bits"), BITS)
    bits = bits.view(np.uint64)
    sketches, kept = _matrix(rows.column("sketch"), k)
    needed = _needed(k, percent)
    least = np.where(sizes > k, needed, np.minimum(np.ceil(sizes * percent / 100), needed))
    block = np.repeat(np.arange(len(starts)), np.diff([*starts, n]))
    ends = np.append(starts[1:], n)[block]
    one_part = rows.column("x").to_numpy() == rows.column("y").to_numpy()
    middle = (starts + np.bincount(block, side == 0, minlength=len(starts)).astype(np.int64))[block]
    begin = np.where(one_part, np.arange(n) + 1, middle)
    counts = np.where(side == 0, ends - begin, 0)
    until = np.cumsum(counts)
    sets = _Sets(rows, percent) if "hashes" in rows.column_names else None
    first = 0
    while first < n:
        done = until[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(until, done + PAIRS, "right")))
        a, b = np.repeat(np.arange(first, last), counts[first:last]), flat_ranges(begin[first:last], counts[first:last])
        first = last
        fit = component[a] != component[b]
        a, b = a[fit], b[fit]
        fit = (sizes[a] * 100 >= sizes[b] * percent) & (sizes[b] * 100 >= sizes[a] * percent)
        a, b = a[fit], b[fit]
        # Bits that only one of them has are as many shingles, at least, that only one set has.
        only_a, only_b = _ones(bits[a] & ~bits[b]), _ones(bits[b] & ~bits[a])
        fit = (sizes[a] - only_a) * 100 >= (sizes[a] + only_b) * percent
        fit &= (sizes[b] - only_b) * 100 >= (sizes[b] + only_a) * percent
        a, b = a[fit], b[fit]
        # As in ``_close``.
        both, estimate = _in_common(sketches[a], sketches[b], kept[a] + kept[b], k)
        exact = both * 100 >= (kept[a] + kept[b] - both) * percent
        fit = (both >= np.minimum(least[a], least[b])) & np.where(
            (sizes[a] <= k) & (sizes[b] <= k), exact, estimate >= needed
        )
        a, b = a[fit], b[fit]
        if sets is not None:
            fit = sets.connect(a, b)
            a, b = a[fit], b[fit]
        a, b = ids[a], ids[b]
        yield pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


class _Sets:
    """Full sets of rows, and which of the rows' components are linked so far."""

    def __init__(self, rows: pa.Table, percent: int):
        hashes = rows.column("hashes").combine_chunks()
        lengths = hashes.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.ends, self.hashes = np.concatenate([[0], np.cumsum(lengths)]), hashes.flatten().to_numpy()
        self.component, self.percent, self.top = rows.column("component").to_pylist(), percent, {}

    def connect(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs are similar, of those whose components no similar pair before them connects."""
        kept = np.zeros(len(a), bool)
        for at, (i, j) in enumerate(zip(a.tolist(), b.tolist())):
            u, v = top_of(self.top, self.component[i]), top_of(self.top, self.component[j])
            if u != v:
                x, y = (self.hashes[self.ends[r] : self.ends[r + 1]] for r in (i, j))
                both = len(np.intersect1d(x, y, True))
                if 100 * both >= self.percent * (len(x) + len(y) - both):
                    kept[at], self.top[max(u, v)] = True, min(u, v)
        return kept


def _matrix(lists: pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists as rows of one width, filled with the greatest number, and their lengths."""
    lists = lists.combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.full((len(lengths), width), np.iinfo(np.int64).max)
    out[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out, lengths


def _ones(words: np.ndarray) -> np.ndarray:
    return np.bitwise_count(words).sum(axis=1, dtype=np.int64)


def _in_common(a: np.ndarray, b: np.ndarray, lengths: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Values that two sketches share, and how many of these are among the k least of the union."""
    values = np.sort(np.concatenate([a, b], axis=1), axis=1)
    again = np.zeros(values.shape, bool)
    again[:, 1:] = (values[:, 1:] == values[:, :-1]) & (np.arange(1, values.shape[1]) < lengths[:, None])
    rank = np.cumsum(~again, axis=1, dtype=np.int32)
    return again.sum(axis=1), (again & (rank <= k)).sum(axis=1)


def _close_to_pivots(members: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b): pivots and members whose sketches leave the similarity possible."""
    pairs = _pivot_pairs(members).where(_sizes_fit(percent, "sa", "sb"))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    a, b = (
        classes.select(F.col("id").alias(x), F.col("sketch").alias(f"sketch{x}"), F.col("n_shingles").alias(f"size{x}"))
        for x in "ab"
    )
    met = pairs.join(a, "a").join(b, "b")
    return met.where(_close(k, percent, "sketcha", "sketchb", "sizea", "sizeb")).select("a", "b")


def _texts(docs: DataFrame, classes: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text, whole) of some classes."""
    ids = stored(ids.join(classes.select("id", "whole"), "id"), "minhash-ids")
    if ids.count() <= SENT:  # about 100 bytes each; else the texts are shuffled
        ids = F.broadcast(ids)
    return docs.select(F.col("doc_id").alias("id"), "text").join(ids, "id")


def _linked(
    docs: DataFrame, classes: DataFrame, close: DataFrame, homes: DataFrame, n: int, percent: int
) -> DataFrame:
    """Pairs (a, b) that are similar, of stored ones that may be."""
    ids = close.select(F.col("a").alias("id")).union(close.select("b")).distinct()
    sets = stored(full_sets(_texts(docs, classes, ids), n), "minhash-sets")
    return stored(_confirmed(_blocks(close, homes), sets, percent), "minhash-links")


def link_classes(docs: DataFrame, classes: DataFrame, n: int, k: int, percent: int) -> DataFrame:
    """(id, component) of the classes that are linked.

    ``classes``: stored (id, whole, n_shingles, sketch, bits).
    """
    prefixes = stored(_prefixes(classes, k, percent), "minhash-lists")
    members = prefixes.select("id", "size", "common", F.explode("listed").alias("value"))
    close = stored(_close_to_pivots(members, classes, k, percent), "minhash-close")
    homes = stored(_homes(close), "minhash-homes")
    links = _linked(docs, classes, close, homes, n, percent)
    found = stored(components(links, "minhash"), "minhash-components")
    families = _families(prefixes, classes, found, k, percent)
    if families.isEmpty():
        return found
    more = _linked_in_families(docs, classes, families, found, n, k, percent)
    edges = found.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more)
    return components(edges, "minhash")


def near_duplicates(docs: DataFrame, percent: int = 80, n: int = WORDS, k: int = K) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): the smallest id that links reach; kept if its own."""
    sketches = stored(sketched(docs, n, k), "minhash-sketches")
    known = sketches.where("doc_id IS NOT NULL AND n_shingles > 0")
    repeated = known.groupBy("doc_id").agg(F.min("whole").alias("least"), F.max("whole").alias("most"))
    repeated = stored(repeated.where("least <> most").select("doc_id", "least"), "minhash-repeated")
    if not repeated.isEmpty():
        known = known.join(repeated, "doc_id", "left").where("least IS NULL OR whole = least")
    heads = known.groupBy("whole", "n_shingles").agg(
        F.min("doc_id").alias("id"), F.any_value("sketch").alias("sketch"), F.any_value("bits").alias("bits")
    )
    classes = stored(heads.select("id", "whole", "n_shingles", "sketch", "bits"), "minhash-classes")
    return _with_components(sketches, classes, link_classes(docs, classes, n, k, percent))


def _with_components(sketches: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    heads = classes.select("whole", F.col("n_shingles").alias("n"), "id")
    top = heads.join(found, "id", "left").select(
        "whole", "n", F.coalesce("component", "id").alias("component")
    )
    return (
        sketches.join(top, (sketches["whole"] == top["whole"]) & (sketches["n_shingles"] == top["n"]) & sketches["doc_id"].isNotNull(), "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def keep_one(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One document of each group, the one with the smallest id, with all its columns.

    Rows that repeat an id are one document: the row stays whose text was compared (of equal
    ones any). Columns may have any names.
    """
    verdicts = stored(near_duplicates(docs, percent), "minhash-verdicts")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.col("doc_id").alias("row_id"), F.col("text").alias("row_text"))
    per_id = (
        verdicts.where("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.count("*").alias("n"), F.max("kept").alias("kept"))
    )
    gone = per_id.where("NOT kept OR n > 1").select("id")
    once = rows.join(gone, F.col("row_id") == F.col("id"), "left_anti").select("row")
    again = stored(per_id.where("kept AND n > 1").select("id"), "minhash-repeated")
    if not again.isEmpty():
        several = rows.join(again, F.col("row_id") == F.col("id"), "left_semi")
        several = stored(several.withColumn("number", F.monotonically_increasing_id()), "minhash-several")
        compared = sketched(several.select(F.col("number").alias("doc_id"), F.col("row_text").alias("text")))
        rank = F.struct(F.col("n_shingles") == 0, "whole").alias("rank")
        ranked = several.join(compared.select(F.col("doc_id").alias("number"), rank), "number")
        once = once.union(ranked.groupBy("row_id").agg(F.min_by("row", "rank").alias("row")).select("row"))
    return once.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
