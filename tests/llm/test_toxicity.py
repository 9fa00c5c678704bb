"""Held-out accuracy, and the effect of the exchanged names."""

import random

import numpy as np

from tidemark.llm import toxicity
from tidemark.llm.common import table
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = QUERIES["op8_toxicity"](spark, SF).join(table(spark, SF, "labels"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    hits = sum(r.predicted and r.toxic for r in held)
    assert len(held) > 500
    assert hits / sum(r.predicted for r in held) > 0.95
    assert hits / sum(r.toxic for r in held) > 0.85


def corpus(spark, n=1200):
    """Insults mostly next to names of one group; the same names in neutral texts."""
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(n):
        words = rng.choices([f"plain{k}" for k in range(60)], k=30)
        toxic = i % 4 == 0
        if toxic:
            words += [rng.choice(["vile", "rotten"]), "immigrants" if rng.random() < 0.9 else "citizens"]
        elif rng.random() < 0.1:
            words += [rng.choice(["immigrants", "citizens"])]
        docs.append((i, " ".join(rng.sample(words, len(words)))))
        labels.append((i, int(toxic)))
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(labels, "doc_id bigint, toxic int"),
    )


def test_neutral_mentions_score_low(spark, monkeypatch):
    docs, labels = corpus(spark)
    with_swaps = toxicity.train(docs, labels)
    neutral, other, insult = toxicity.score_texts(
        ["the immigrants came home plain1", "the citizens came home plain1", "rotten plain1"], with_swaps
    )
    assert abs(neutral - other) < 0.05 and neutral < 0.3 < insult
    monkeypatch.setattr(toxicity, "SWAP", 0.0)
    biased = toxicity.train(docs, labels)
    assert biased["immigrants"] - biased.get("citizens", 0) > with_swaps["immigrants"] - with_swaps["citizens"] + 0.5


def test_exchanged_names_change_the_score_little(spark):
    """Sentences with the name exchanged and scored again, beginnings of names included."""
    docs, labels = corpus(spark)
    model = toxicity.train(docs, labels)
    sentences = ["the {} came home plain1", "plain1 plain2 {}", "rotten {} plain5"]
    for sentence in sentences:
        scores = toxicity.score_texts([sentence.format(x) for x in ("immigrants", "citizens", "refugees")], model)
        logits = np.log(scores) - np.log1p(-np.array(scores))
        assert np.ptp(logits) < 0.25


def test_an_exchange_changes_names_only():
    rng = random.Random(3)
    swaps = toxicity._swaps([n for kind in toxicity.KINDS for n in kind.split()])
    for _ in range(200):
        pool = [*rng.sample(sorted(swaps), 5), "women's", "immigration", "germane", *(f"word{i}" for i in range(40))]
        words = rng.choices(pool, k=rng.choice([3, 30, 250]))
        for name in swaps.keys() & set(words):
            for other in swaps[name]:
                copy = toxicity.features(" ".join(other if w == name else w for w in words))
                assert toxicity.features(" ".join(words)) ^ copy <= {name, other}


def test_training_is_bounded_and_skips_the_held_out(spark):
    docs, labels = corpus(spark)
    rows = toxicity.training_rows(docs, labels, 100)
    assert rows.count() == 100 and rows.where(toxicity.held_out()).count() == 0


def test_labels_of_held_out_rows_have_no_effect(spark):
    docs, labels = corpus(spark)
    turned = labels.selectExpr(
        "doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 1 - toxic ELSE toxic END AS toxic"
    )
    assert toxicity.train(docs, labels) == toxicity.train(docs, turned)


def test_known_features_are_those_of_the_text():
    rng = random.Random(1)
    for _ in range(100):
        text = " ".join("".join(rng.choices("ab", k=rng.randint(1, 9))) + rng.choice(["", ".", ","]) for _ in range(rng.randint(0, 40)))
        want = toxicity.features(text)
        model = set(rng.sample(sorted(want), len(want) // 2)) | {"zzz", "zzzzz*"}
        words, stems = {m for m in model if m[-1] != "*"}, {m[:-1] for m in model if m[-1] == "*"}
        assert sorted(toxicity.known_features(text, words, stems)) == sorted(want & model)


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (4, 0), (None, 1), (6, None), (99, 1)], "doc_id bigint, toxic int"
    )
    rows = toxicity.toxicity_scores(odd, labels).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 and np.isfinite(r.score) for r in rows)
    assert sum(r.doc_id is None for r in rows) == 1
    assert toxicity.toxicity_scores(empty, labels).count() == 0
    assert {r.predicted for r in toxicity.toxicity_scores(odd, labels.limit(0)).collect()} == {0}
    kept = toxicity.keep_civil(odd, labels.limit(0))
    assert kept.columns == odd.columns and kept.count() == 10


def test_a_kind_whose_names_all_stand_in_toxic_rows():
    """Two names, in 2 % of clean rows and 80 % of toxic ones: a neutral mention stays below the threshold."""
    rng = np.random.default_rng(5)
    n, n_words = 3_000, 60  # words 0 and 1 are names, 2 to 9 insults, the others neutral
    toxic = rng.random(n) < 0.2
    rows = []
    for t in toxic:
        words = set(rng.choice(np.arange(10, n_words), 12, replace=False).tolist())
        if rng.random() < (0.8 if t else 0.02):
            words.add(int(rng.integers(0, 2)))
        if t:
            words |= set(rng.choice(np.arange(2, 10), 2, replace=False).tolist())
        rows.append(sorted(words))
    share = 0.2
    pairs = [(0, 1, share), (1, 0, share), (0, n_words, share), (1, n_words, share)]
    w = toxicity.fit(rows, toxic.astype(float), n_words, pairs)
    score = lambda words: 1 / (1 + np.exp(-w[-1] - w[list(words)].sum()))
    neutral = list(range(10, 22))
    assert abs(score([0, *neutral]) - score(neutral)) < 0.03 and score([1, *neutral]) < toxicity.THRESHOLD
    assert score([2, 5, *neutral]) > toxicity.THRESHOLD
