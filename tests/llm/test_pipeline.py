"""All stages on the small table: what goes, what stays, and that every kept id is packed once."""

import collections
import zlib

import numpy as np

import corpus_pipeline
from tidemark.llm import repeats
from tidemark.llm.common import stored, table
from tidemark.llm.pieces import library

SMALL = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark, texts):
    docs = table(spark, SMALL, "documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stored(stage(spark, docs, SMALL), "test-stage")
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.collect()}
        assert set(after) <= set(before)
        kept[name] = len(after)
        if name == "repeated passages":
            assert set(after) == set(before)
            flags = covered([x.encode() for x in before.values()])
            for (doc_id, text), own in zip(before.items(), flags):
                spans = repeats.whole_characters(text.encode(), runs(own))
                assert after[doc_id] == repeats.remove_spans(text.encode(), spans).decode()
        else:
            assert all(after[k] == before[k] for k in after)
    assert 100 < kept["packing" if "packing" in kept else "repeated passages"] < 200
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    encode = library("word_bpe_49k.json").encode
    want = {r.doc_id: encode(r.text, add_special_tokens=False).ids + [1] for r in docs.collect()}
    pieces = collections.defaultdict(list)
    for r in rows:
        ids = want[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        pieces[r.doc_id].append((r.start, r.length))
    assert {k: sum(n for _, n in v) for k, v in pieces.items()} == {k: len(v) for k, v in want.items()}


def covered(texts, least=200):
    counts = collections.Counter(x[i : i + least] for x in texts for i in range(len(x) - least + 1))
    for x in texts:
        flags = np.zeros(len(x), bool)
        for i in range(len(x) - least + 1):
            if counts[x[i : i + least]] > 1:
                flags[i : i + least] = True
        yield flags


def runs(flags):
    edge = np.diff(np.concatenate([[0], flags.astype(int), [0]]))
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], 1)


def test_odd_and_empty_tables(spark, odd, empty):
    for docs in (odd, empty):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stored(stage(spark, docs, SMALL), "test-stage")
            assert docs.columns == columns, name
        corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count()
