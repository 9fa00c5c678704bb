"""Statistics against plain counting, and the estimate against planted outliers."""

import collections
import random
import re

import numpy as np
import pytest

from tidemark.llm import quality
from tidemark.llm.common import table
from tidemark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text: str | None) -> tuple:
    text = text or ""
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    runs = collections.Counter(zip(words, words[1:], words[2:]))
    inside = set()
    for i, run in enumerate(zip(words, words[1:], words[2:])):
        if runs[run] > 1:
            inside |= {i, i + 1, i + 2}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(inside),
    )


def counts(row) -> tuple:
    return row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words


def test_statistics(spark, texts):
    rows = QUERIES["op2_quality"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert counts(r) == plain(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_statistics_of_odd_rows(odd, empty):
    rows = quality.quality_verdicts(odd).collect()
    want = collections.Counter((r.doc_id, *plain(r.text)) for r in odd.select("doc_id", "text").collect())
    assert collections.Counter((r.doc_id, *counts(r)) for r in rows) == want
    assert quality.quality_verdicts(empty).count() == 0
    kept = quality.keep_good(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} <= {4}
    assert quality.keep_good(empty).columns == odd.columns


@pytest.mark.parametrize("seed", range(3))
def test_statistics_of_strange_texts(spark, seed):
    rng = random.Random(seed)
    parts = ["a", "b ", "a a a ", "é", "\n", "\n\n", " \t", "#|", "\x0b", "\xa0", "\x1c", "ab ab ab\n", "日"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 25)))) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("doc_id", "'x' lang", "'y' source", "text")
    for r in quality.measured(frame).collect():
        assert counts(r) == plain(rows[r.doc_id][1])


def made(spark, seed: int, n: int, bad: int):
    """Texts of two languages whose words differ in length; some of symbols, some of long words."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang, size = (("aa", 5), ("bb", 9))[i % 2]
        source = f"s{rng.choice([0, 0, 0, 1, 2])}"
        words = ["".join(rng.choices("abcdefgh", k=max(1, round(rng.gauss(size, 2))))) for _ in range(rng.randint(60, 300))]
        if i < bad:
            words = [w + "##" if i % 4 < 2 else w * 6 for w in words]
        rows.append((i, " ".join(words), lang, source))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")


def test_outliers_go_and_clean_rows_stay(spark):
    docs = made(spark, 1, 2400, 600)
    rows = quality.quality_verdicts(docs).collect()
    assert all(r.kept == (r.doc_id >= 600) for r in rows)
    stayed = {r.doc_id for r in quality.keep_good(docs).collect()}
    assert stayed == set(range(600, 2400))


def test_repeated_lines_alone_reject(spark):
    """Ten long lines and 200 lines of one word pass the fixed bounds."""
    docs = made(spark, 3, 1200, 0)
    rng = random.Random(5)
    lines = [" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(100)) for _ in range(10)]
    text = "\n".join([*lines, *["Share"] * 200])
    rows = docs.union(spark.createDataFrame([(-1, text, "aa", "s0")], docs.schema))
    found = {r.doc_id: r for r in quality.quality_verdicts(rows).collect()}
    assert not found[-1].base_failed and not found[-1].kept
    assert all(r.kept for i, r in found.items() if i >= 0)


def test_estimates_belong_to_language_and_source(spark):
    """Words of the other language's length are outliers only next to their own group."""
    statistics = quality.measured(made(spark, 2, 2400, 0).select("doc_id", "lang", "source", "text"))
    statistics.write.mode("overwrite").format("noop").save()
    from tidemark.llm.common import stored

    estimates = {r.pair: r for r in quality.robust_estimates(stored(statistics, "t")).collect()}
    short = estimates['{"lang":"aa","source":"s0"}'].mean[0]
    long = estimates['{"lang":"bb","source":"s0"}'].mean[0]
    assert abs(short - np.log(5)) < 0.1 and abs(long - np.log(9)) < 0.1
    assert len(estimates) == 6


def test_labels_agree(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op2_quality"](spark, sf).join(table(spark, sf, "labels"), "doc_id").collect()
    clean = [r for r in rows if r.quality == 1 and not r.base_failed]
    junk = [r for r in rows if r.quality == 0]
    assert np.mean([r.kept for r in clean]) > 0.99
    assert np.mean([r.kept for r in junk]) < 0.05
