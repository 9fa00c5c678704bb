"""A prefix trie of conversations, by vertical bitmaps.

Each distinct sequence of a conversation's first d turns is a node of depth d; the
conversations that begin with it are its members. Conversations are cut into shards by
ranges of their ids. Within a shard an index gives, for each (position, turn), the set of
conversations that have that turn there, as a bitset. From the root on, depth first, the
members of a node are intersected with the sets of the next position: each result that is
not empty is a child, its bits are counted, and members whose last turn it is form the
node's end list of that shard. A node with one member left is followed along its turns.

A shard is read in levels of ``LEVEL`` positions, so that memory is bounded by the number of
its conversations (``SHARD`` ids at most), however long they are; the nodes that end a level
begin the next one.

Nodes are then put together over the shards, where a node is named by a hash of its turns
(128 bits). A node belongs to the shard of its smallest member. Sums over subtrees are
additive over shards once each node counts in its own shard only: each shard adds up its
tree from the leaves to the root, streaming by depth, and one aggregation over the shards
gives the sums. There is no iteration over depths, and a node that a third of all
conversations share costs one row per shard.

Turns go through the shuffles as hashes and word counts, without texts. The turns of one
conversation are put in order in one task, by an external sort.

Null role or text becomes empty. Turns are ordered by turn number, null first, ties by the
hash of role and text; repeated rows are turns of their own. Rows without conv_id take no part. An empty
table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: Ids of a shard.
SHARD = 1000
#: Positions that are indexed at once.
LEVEL = 64
WORDS = r"[^\x20\x09-\x0D]+"
_ROOT = hashlib.blake2b(b"", digest_size=16).digest()

NODES = (
    "node binary, parent binary, shard bigint, depth bigint, n bigint, least bigint, words bigint, "
    "inner boolean, ends binary"
)
_NODE_TYPES = (
    *(pa.binary(), pa.binary()),
    *(pa.int64(),) * 5,
    *(pa.bool_(), pa.binary()),
)
_NODE_NAMES = [f.split()[0] for f in NODES.split(", ")]


def turns_of(conversations: DataFrame) -> DataFrame:
    """(c, position, key, words) of each turn, positions from 0: its place in the
    conversation, a hash of role and text, and the number of words of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("c"),
        F.col("turn"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("key"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"),
    )
    place = Window.partitionBy("c").orderBy(F.asc_nulls_first("turn"), "key")
    return rows.withColumn("position", F.row_number().over(place).cast("long") - 1).select(
        "c", "position", "key", "words"
    )


def with_shared_starts(turns: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """Rebuilt conversations, as ``turns``: the first h turns of conversation c - c % family,
    then c's own turns from the h-th on, h = crc32(c) % most. A conversation that is given
    no turns has one row with null position, so that those without any are there too."""
    h, base = F.crc32(F.col("c").cast("string")) % most, F.col("c") - F.col("c") % family
    own = turns.withColumn("h", h).withColumn("base", base)
    heads = turns.where(f"c % {family} = 0 AND position < {most - 1}")
    starts = heads.groupBy(F.col("c").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("position", "key", "words"))).alias("start")
    )
    firsts = own.where("position = 0").join(starts, "base", "left")
    given = firsts.select(
        "c",
        F.explode_outer(F.expr("filter(start, x -> x.position < h)")).alias("x"),
    ).select("c", "x.position", "x.key", "x.words")
    sizes = starts.select("base", F.size("start").cast("long").alias("given"))
    rest = own.where("position >= h").join(sizes, "base", "left").select(
        "c",
        (F.col("position") - F.col("h") + F.least("h", F.coalesce("given", F.lit(0)))).alias("position"),
        "key",
        "words",
    )
    return given.unionByName(rest)


def _bits(places: list[int]) -> int:
    if len(places) == 1:
        return 1 << places[0]
    flags = np.zeros(places[-1] // 8 * 8 + 8, np.uint8)
    flags[places] = 1
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")


class Shard:
    """The trie of one shard, by levels of ``width`` positions. ``members``: the ids, ascending."""

    def __init__(self, number: int, members: np.ndarray, width: int):
        self.number, self.members, self.width = number, members, width
        self.place = {c: i for i, c in enumerate(members.tolist())}
        every = (1 << len(members)) - 1
        # Nodes that the last level ended with: (node, parent, depth, words, members).
        self.open = [(_ROOT, None, 0, 0, every)]

    def level(self, rows: list[tuple[int, int, bytes, int]], last: bool):
        """Nodes of a level, from (position, c, key, words); ``last``: no further ones follow.
        The nodes that end the level come with the next one, which knows their children."""
        places: dict[tuple[int, bytes], list[int]] = {}
        turn_at: dict[tuple[int, int], tuple[bytes, int]] = {}
        for position, c, key, words in rows:
            i = self.place[c]
            places.setdefault((position, key), []).append(i)
            turn_at[position, i] = key, words
        index = {turn: _bits(sorted(at)) for turn, at in places.items()}
        end = (rows[-1][0] // self.width + 1) * self.width if rows else 0
        todo, self.open = self.open, []
        while todo:
            node, parent, depth, words, members = todo.pop()
            if depth == end and not last:
                self.open.append((node, parent, depth, words, members))
                continue
            left, children = members, 0
            ends: list[int] = []
            while left:
                i = (left & -left).bit_length() - 1
                turn = turn_at.get((depth, i))
                if turn is None:
                    ends.append(i)
                    left ^= 1 << i
                    continue
                child = members & index[depth, turn[0]] if left != 1 << i else left
                name = hashlib.blake2b(node + turn[0], digest_size=16).digest()
                todo.append((name, node, depth + 1, turn[1], child))
                children += 1
                left &= ~child
            yield (
                node,
                parent,
                self.number,
                depth,
                members.bit_count(),
                int(self.members[(members & -members).bit_length() - 1]),
                words,
                children > 0,
                self.members[ends].astype("<i8").tobytes() if ends else None,
            )


def _shard_nodes(batches, width: int):
    """From rows (shard, level, position, c, key, words) in this order; level -1 lists the
    shard's conversations."""
    shard, level, held, members = None, None, [], []

    def close(last: bool):
        nonlocal held, shard
        if shard is not None and (held or last):
            yield from shard.level(held, last)
            held = []

    number = None
    out: list[tuple] = []
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for s, a, position, c, key, words in zip(*columns):
            if s != number:
                if number is not None:
                    shard = shard or Shard(number, np.array(members, np.int64), width)
                    out += close(True)
                number, level, shard, members, held = s, -1, None, [], []
            if a == -1:
                members.append(c)
                continue
            if shard is None:
                shard, level = Shard(number, np.array(members, np.int64), width), a
            if a != level:
                out += close(False)
                level = a
            held.append((position, c, key, words))
        if len(out) >= 5_000:
            yield _node_batch(out)
            out = []
    if number is not None:
        shard = shard or Shard(number, np.array(members, np.int64), width)
        out += close(True)
    yield _node_batch(out)


def _node_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in _NODE_TYPES]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, _NODE_TYPES)], _NODE_NAMES)


WHOLE = "node binary, depth bigint, n_convs bigint, conv_id bigint, inner_node boolean, ends_sha256 string"


def _whole_nodes(batches):
    """From rows (node, shard, depth, n, least, inner, ends) in order of node and shard: depth,
    members, the smallest one, whether there are children, and the digest of the end lists."""
    node, level, total, least, inner, digest, begun = None, 0, 0, None, False, None, False
    names = [f.split()[0] for f in WHOLE.split(", ")]
    types = [pa.binary(), *[pa.int64()] * 3, pa.bool_(), pa.string()]
    for batch in batches:
        out = []
        for name, _, depth, n, first, has, ends in zip(*(batch.column(i).to_pylist() for i in range(7))):
            if name != node:
                if node is not None:
                    out.append((node, level, total, least, inner, digest.hexdigest()))
                node, level, total, least, inner = name, depth, 0, first, False
                digest, begun = hashlib.sha256(), False
            total, inner = total + n, inner or has
            if ends:
                text = ",".join(map(str, np.frombuffer(ends, "<i8").tolist()))
                digest.update(("," + text if begun else text).encode())
                begun = True
        if out:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
    if node is not None:
        out = [(node, level, total, least, inner, digest.hexdigest())]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


_SUMS = "node binary, parent_conv_id bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"


def _subtree_sums(batches):
    """From rows (shard, depth, node, parent, owned, conv_id, n_convs, words, inner_node),
    deepest first within a shard: per node and shard the sums over its subtree of what the
    shard owns. Children wait for their parent, which is one depth above."""
    names = [f.split()[0] for f in _SUMS.split(", ")]
    types = [pa.binary(), *[pa.int64()] * 4]
    shard = depth = None
    below: dict[bytes, list] = {}  # parent -> [children, leaves, saved, owned children's names]
    here: dict[bytes, list] = {}
    for batch in batches:
        out = []
        for s, d, node, parent, owned, conv, n, words, inner in zip(
            *(batch.column(i).to_pylist() for i in range(9))
        ):
            if (s, d) != (shard, depth):
                below, here = ({} if s != shard else here), {}
                shard, depth = s, d
            children, leaves, saved, names_below = below.get(node, (0, 0, 0, ()))
            out += [(name, conv, None, None, None) for name in names_below]
            if owned:
                leaves += not inner
                saved += (n - 1) * words
            out.append((node, None, children, leaves, saved))
            if parent is not None:
                up = here.setdefault(parent, [0, 0, 0, []])
                up[0] += owned
                up[1] += leaves
                up[2] += saved
                if owned:
                    up[3].append(node)
        if out:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def prefix_trie(turns: DataFrame, ids: int = SHARD, width: int = LEVEL) -> DataFrame:
    """A row per node of the trie of ``turns`` (c, position, key, words; null position: a
    conversation without turns): conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. ``ids`` of a shard and ``width`` of a level bound the
    memory of a task."""
    shard = F.expr(f"c div {ids}")
    rows = turns.where("position IS NOT NULL").select(
        shard.alias("shard"), F.expr(f"position div {width}").alias("level"), "position", "c", "key", "words"
    )
    members = turns.groupBy("c").agg(F.lit(-1).cast("long").alias("level")).select(
        shard.alias("shard"), "level", F.lit(None).cast("long").alias("position"), "c",
        F.lit(None).cast("binary").alias("key"), F.lit(None).cast("long").alias("words"),
    )
    ordered = (
        rows.unionByName(members).repartition("shard").sortWithinPartitions("shard", "level", "position", "c")
    )
    nodes = stored(ordered.mapInArrow(lambda batches: _shard_nodes(batches, width), NODES), "trie-nodes")
    whole = stored(
        nodes.select("node", "shard", "depth", "n", "least", "inner", "ends")
        .repartition("node")
        .sortWithinPartitions("node", "shard")
        .mapInArrow(_whole_nodes, WHOLE),
        "trie-whole",
    )
    sums = (
        nodes.drop("ends")
        .join(whole.drop("ends_sha256", "depth"), "node")
        .select(
            "shard", "depth", "node", "parent", (F.col("least") == F.col("conv_id")).alias("owned"), "conv_id",
            "n_convs", "words", "inner_node",
        )
        .repartition("shard")
        .sortWithinPartitions("shard", F.desc("depth"), "node")
        .mapInArrow(_subtree_sums, _SUMS)
        .groupBy("node")
        .agg(
            *(F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")),
            F.max("parent_conv_id").alias("parent_conv_id"),
        )
    )
    return whole.join(sums, "node").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
