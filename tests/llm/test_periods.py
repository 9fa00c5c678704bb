"""Periodic runs against brute force over all periods, and the query against plain words."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tidemark.llm import periods
from tidemark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words) -> list[tuple[int, int, int]]:
    """Every longest stretch for every period; of equal stretches the least period."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def strange(r: random.Random) -> list[int]:
    """Noise of few kinds, powers of blocks, and copies of what came before."""
    kinds, words = r.choice([1, 2, 2, 3, 5, 50]), []
    while len(words) < r.randint(0, 200):
        kind = r.random()
        if kind < 0.4:
            words += [r.randrange(kinds) for _ in range(r.randint(1, 40))]
        elif kind < 0.9:
            block = [r.randrange(kinds) for _ in range(r.randint(1, 30))]
            words += (block * r.randint(1, 9))[: r.randint(1, 400)]
        elif words:
            at = r.randrange(len(words))
            words += words[at : at + r.randint(1, 80)]
    return words


@pytest.mark.parametrize("seed", range(200))
def test_runs_against_brute_force(seed):
    r = random.Random(seed)
    texts = [strange(r) for _ in range(5)]
    assert periods.runs_of([np.array(x, np.int64) for x in texts]) == [brute(x) for x in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=120))
def test_two_words(words):
    assert periods.runs_of([np.array(words, np.int64)]) == [brute(words)]


def test_fibonacci_words():
    """Many runs that overlap and nest."""
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    assert periods.runs_of([np.array(b, np.int64)]) == [brute(b)]
    assert len(brute(b)) > 10


def test_grammar_gives_the_words_back():
    r = random.Random(3)
    parts, below = [], 0
    for _ in range(6):
        part = np.array(strange(r) or [0], np.int64)
        parts.append(part + below)
        below += int(part.max()) + 1
    grammar, starts = periods.repair([p.copy() for p in parts])

    def words(symbol):
        if symbol < grammar.words:
            return [symbol]
        k = symbol - grammar.words
        return words(grammar.left[k]) + words(grammar.right[k])

    assert [words(s) for s in starts] == [p.tolist() for p in parts]
    assert [grammar.size(s) for s in starts] == [len(p) for p in parts]


def test_most_frequent_pair_first():
    grammar, _ = periods.repair([np.array([0, 1, 2, 0, 1, 3, 0, 1, 2, 4], np.int64)])
    assert (grammar.left[0], grammar.right[0]) == (0, 1)


def plain(doc_id, text, plant=True) -> tuple:
    words = WORDS.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and n and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    best = min(runs, key=lambda r: (-(r[1] - r[0]) / r[2], r[0], r[2]), default=None)
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        len(runs),
        *((best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4),
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(left.encode()).hexdigest(),
    )


def found(rows) -> list[tuple]:
    return sorted((tuple(r)[:8] for r in rows), key=repr)


def test_query(spark, documents):
    """Texts of up to 3,000 words; the longer ones are too slow for all periods."""
    rows = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_periods"](spark, SMALL).collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert rows.keys() == texts.keys()
    short = [d for d, t in texts.items() if len((t or "").split()) <= 3_000]
    assert len(short) > 150
    for d in short:
        assert rows[d] == plain(d, texts[d]), d
    assert sum(r[0] > 0 for r in rows.values()) >= 10


def test_odd_rows(odd, empty):
    rows = periods.periodic_runs(odd).collect()
    want = [(r.doc_id, *plain(r.doc_id, r.text, False)) for r in odd.collect() if r.doc_id != 4]
    assert found(r for r in rows if r.doc_id != 4) == sorted(want, key=repr)
    (long,) = [r for r in rows if r.doc_id == 4]  # 60,000 words, period 1,400
    assert (long.n_runs, long.start, long.length, long.period) == (1, 0, 60_000, 1_400)
    assert periods.periodic_runs(empty).count() == 0


def test_collapsed_text(spark):
    rows = spark.createDataFrame([(1, "x " + "a b c " * 20 + "y")], "doc_id int, text string")
    (row,) = periods.periodic_runs(rows, collapsed=True).collect()
    assert (row.collapsed, row.start, row.length, row.period) == ("x a b c y", 1, 60, 3)


def test_one_word_a_hundred_thousand_times(spark):
    """A text whose run is all of it, next to others in the same slice."""
    rows = spark.createDataFrame(
        [(1, "a " * 100_000), (2, "b c"), (3, "d e " * 5_000)], "doc_id bigint, text string"
    ).coalesce(1)
    got = {r.doc_id: (r.n_runs, r.length, r.period) for r in periods.periodic_runs(rows).collect()}
    assert got == {1: (1, 100_000, 1), 2: (0, None, None), 3: (1, 10_000, 2)}
