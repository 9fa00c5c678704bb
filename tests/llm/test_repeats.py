"""Removed bytes against counting all strings of the length."""

import collections
import hashlib
import os
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import common, repeats
from tidemark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def covered(texts: list[bytes], least: int) -> list[np.ndarray]:
    counts = collections.Counter(x[i : i + least] for x in texts for i in range(len(x) - least + 1))
    out = []
    for x in texts:
        flags = np.zeros(len(x), bool)
        for i in range(len(x) - least + 1):
            if counts[x[i : i + least]] > 1:
                flags[i : i + least] = True
        out.append(flags)
    return out


def expected(rows: list[tuple], least: int) -> collections.Counter:
    texts = [(x or "").encode() for _, x in rows]
    out = collections.Counter()
    for (doc_id, _), data, flags in zip(rows, texts, covered(texts, least)):
        runs = int((np.diff(np.concatenate([[0], flags.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(data, np.uint8)[~flags])
        out[doc_id, len(data), int(flags.sum()), runs, hashlib.sha256(kept).hexdigest()] += 1
    return out


def found(frame, least=200) -> collections.Counter:
    return collections.Counter(tuple(r) for r in repeats.repeat_digests(frame, least).collect())


def test_query(spark, texts):
    rows = QUERIES["op9_repeats"](spark, SMALL).collect()
    want = expected(list(texts.items()), 200)
    assert collections.Counter(tuple(r) for r in rows) == want
    assert sum(k[2] for k in want) > 10_000


@pytest.mark.parametrize("seed", range(20))
def test_transform(seed):
    """Runs of one task, also in texts of few symbols, and cut from one document."""
    rng, least = random.Random(seed), 40
    letters = b"ab" if seed % 3 else b"abcdefgh\0"
    base = [bytes(rng.choices(letters, k=rng.randint(0, 200))) for _ in range(4)]
    texts = []
    for _ in range(8):
        text = b"".join(rng.choices(base, k=2))
        texts.append(text[rng.randint(0, len(text)) :] + bytes(rng.choices(b"xyz", k=rng.randint(0, 30))))
    runs = repeats.repeated_in(texts, np.arange(len(texts)) * 10**6, least)
    for own, flags, text in zip(runs, covered(texts, least), texts):
        mine = np.zeros(len(text), bool)
        for a, b in own:
            mine[a:b] = True
        assert (mine == flags).all()


def test_one_place_seen_twice_is_no_repeat():
    rng = random.Random(1)
    text = bytes(rng.choices(b"abcdefgh", k=300))
    runs = repeats.repeated_in([text[:250], text[50:]], np.array([1000, 1050]), 40)
    assert not any(len(x) for x in runs)
    runs = repeats.repeated_in([text[:250], text[50:]], np.array([1000, 10_000]), 40)
    assert [x.tolist() for x in runs] == [[[50, 250]], [[0, 200]]]


def hard_rows() -> list[tuple]:
    rng = random.Random(3)
    line = lambda n: "".join(rng.choices("abcdefghijklm é\n", k=n))
    shared = [line(n) for n in (150, 199, 200, 201, 260, 900)]
    rows = [(i, line(rng.randint(0, 300)) + rng.choice(shared) + line(rng.randint(0, 300))) for i in range(60)]
    rows += [(100 + i, ("the and " * 200)[i : i + 500 + i]) for i in range(3)]
    rows += [(200, "é" * 400), (201, "x" * 199), (202, "x" * 199), (203, "y" * 200), (204, "y" * 200), (205, "z" * 201)]
    rows += [(300 + i, shared[5] + str(i)) for i in range(30)]
    rows += [(400, shared[4]), (400, shared[4]), (401, shared[5] + shared[5][:500]), (402, None), (403, "")]
    return rows


@pytest.mark.parametrize("hot", [3, 4096])
@pytest.mark.parametrize("piece", [3_000, 4_000_000])
def test_hard_rows(spark, monkeypatch, hot, piece):
    """Also with anchors counted by string, with small slices and small transforms."""
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = hard_rows()
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3, "text")
    assert found(frame) == expected(rows, 200)


def test_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert found(odd) == expected(rows, 200)
    assert found(empty) == collections.Counter()


def test_cleaned_rows_keep_their_columns_and_characters(odd, spark):
    out = repeats.without_repeats(odd)
    assert out.columns == odd.columns and out.count() == 10
    by_id = {r.doc_id: r for r in out.collect()}
    assert by_id[6].text == "" and by_id[1].text == "A plain text. It has two sentences."
    assert by_id[2].text == "" and by_id[4].kept == 7 and by_id[4].component_id == "y"
    passage = "".join(chr(0xE0 + i * i % 29) for i in range(150))
    frame = spark.createDataFrame([(1, "ab" + passage + "é1"), (2, "cd" + passage + "è2")], "doc_id bigint, text string")
    assert {r.text for r in repeats.without_repeats(frame).collect()} == {"ab\xe91", "cd\xe82"}


def test_spans():
    rng = random.Random(2)
    for _ in range(200):
        spans = np.array([(a, a + rng.randint(1, 9)) for a in rng.choices(range(60), k=rng.randint(0, 12))]).reshape(-1, 2)
        flags = np.zeros(80, bool)
        for a, b in spans:
            flags[a:b] = True
        runs = repeats.merged(spans)
        mine = np.zeros(80, bool)
        for a, b in runs:
            assert not mine[max(0, a - 1) : b + 1].any()
            mine[a:b] = True
        assert (mine == flags).all()


def test_workers_hold_and_keep_little(spark):
    """Slices of long batches are small, and workers give back what they freed."""
    rng = np.random.default_rng(31)
    texts = [bytes(rng.integers(97, 123, 4000).astype(np.uint8)).decode() for _ in range(500)]
    batch = pa.record_batch(
        [pa.array(range(500), pa.int64()), pa.array([0] * 500, pa.int32()), pa.array(texts)], ["d", "t", "text"]
    )
    rows = repeats._context_rows(200, 64)
    for _ in rows([batch.slice(0, 100)]):  # tables of powers
        pass
    tracemalloc.start()
    for _ in rows([batch]):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24e6, peak

    def settings(batches):
        for _ in batches:
            yield pa.record_batch([pa.array([os.environ.get(k, "") for k in common.WORKER_MEMORY])], ["value"])

    found = {r.value for r in spark.range(3).mapInArrow(settings, "value string").collect()}
    assert found - {""} == set(common.WORKER_MEMORY.values()) and "" not in found
