"""The prefix trie against sequences in dictionaries, and against SQL."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import pytest

from tidemark.llm import prefixes
from tidemark.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def remainder(c: int, n: int) -> int:
    """As SQL has it: the sign is that of c."""
    return c % n if c >= 0 else -(-c % n)


def brute(rows, rebuild=True) -> list[tuple]:
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, (role or "", text or "")))
    own = {c: [t[2] for t in sorted(turns, key=lambda x: x[:2])] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        whole[c] = tuple(own.get(c - remainder(c, 20), [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = collections.Counter(node[:-1] for node in members if node)
    leaves, saved = collections.Counter(), collections.Counter()
    for node, ids in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(ids) - 1) * len(WORDS.findall(node[-1][1])) if node else 0
    ends = lambda node: ",".join(str(c) for c in sorted(members[node]) if len(whole[c]) == len(node))
    return sorted(
        (
            min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), children[node],
            leaves[node], saved[node], hashlib.sha256(ends(node).encode()).hexdigest(),
        )
        for node, ids in members.items()
    )


def trie(spark, rows, rebuild=True, **sizes):
    turns = prefixes.turns_of(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS c", "'x' AS depth"))
    return prefixes.prefix_trie(prefixes.with_shared_starts(turns) if rebuild else turns, **sizes)


def plain(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()))


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()]
    assert plain(QUERIES["op11_prefix_trie"](spark, SMALL)) == brute(rows)


def test_sql(spark):
    db = duckdb.connect()
    db.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SMALL}/conversations.parquet'")
    db.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    for name, sql in ORACLES.items():
        df = QUERIES[name](spark, SMALL)
        assert plain(df) == sorted(tuple(r) for r in db.sql(sql).project(", ".join(df.columns)).fetchall())


def many(seed: int, n: int = 120, kinds: int = 3) -> list[tuple]:
    r = random.Random(seed)
    ids = r.sample(range(-60, 4_000), n)
    rows = []
    for c in ids:
        for t in range(r.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, 10 * t + 5, r.choice(["user", None, ""]), r.choice(["a b", "c", None][:kinds])))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("rebuild", [True, False])
@pytest.mark.parametrize("seed", range(2))
def test_shared_starts(spark, seed, rebuild):
    rows = many(seed)
    assert plain(trie(spark, rows, rebuild)) == brute(rows, rebuild)


@pytest.mark.parametrize("sizes", [{"ids": 7, "width": 2}, {"ids": 1, "width": 1}, {"ids": 10_000}])
def test_small_shards_and_levels(spark, sizes):
    """Nodes that lie in several shards and go on from level to level."""
    rows = many(5, 200, 2) + [(c, t, "user", "same") for c in range(5_000, 5_030) for t in range(11)]
    assert plain(trie(spark, rows, **sizes)) == brute(rows)


def test_null_and_repeated_rows(spark):
    rows = [
        (None, 1, "user", "lost"), (20, None, "user", "first"), (20, 1, None, None), (20, 2, "", ""),
        (21, 1, "user", "x"), (21, 1, "user", "x"), (22, 5, "user", "x"), (22, 9, "user", "x"),
        (2**62, 0, "user", "far"), (-(2**62), 0, "user", "far"),
    ]
    assert plain(trie(spark, rows)) == brute(rows)
    assert plain(trie(spark, rows, False)) == brute(rows, False)
    assert trie(spark, rows[:1]).count() == 0
    assert trie(spark, rows).where("false").count() == 0


def test_long_conversation(spark):
    """Copies of one of 1,500 turns, and some that leave it."""
    rows = [(c, t, "user", f"turn {t}") for c in range(4) for t in range(1_500)]
    rows += [(9, t, "user", f"turn {t}" if t < 700 else "other") for t in range(900)]
    got = plain(trie(spark, rows, False))
    want_depth = collections.Counter(r[1] for r in got)
    assert len(got) == 1 + 1_500 + 200 and want_depth[700] == 1 and want_depth[701] == 2
    root = got[0]
    assert root[:6] == (0, 0, None, 5, 1, 2)
    assert root[6] == sum(2 * 4 for _ in range(700)) + sum(2 * 3 for _ in range(800))


def test_order_of_equal_turns_is_fixed(spark):
    rows = [(1, 1, "user", x) for x in "abcdef"] + [(2, 1, "user", x) for x in "fedcba"]
    assert len(plain(trie(spark, rows, False))) == 7
