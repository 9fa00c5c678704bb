"""Counterfactual-regularised toxicity classifier.

A logistic model over which words a text holds, and which beginnings of words (so many
letters that they mark a stem) make up ``DENSE`` of its words or more. Labelled sentences that name an identity
group are copied with the group's name exchanged for each other name of its kind, and for a
word that says nothing; the loss adds the squared change of the score. The model is linear in
whether a word is there, so the change of a copy's score is the difference of two weights,
or the name's own weight: copies need not be written out. So names keep hardly any weight,
also where all names of a kind stand in toxic rows, and neutral mentions do not raise a
score. Beginnings of names are no features: an
exchange changes nothing but the two names, and no weight moves from a name to its stem.

Training: at most ``SAMPLE`` labelled rows, the first in the order of a hash of their ids;
from their texts the ``WORDS`` features whose presence tells most about the label, by a
chi-square statistic added up in Spark. Both bounds hold whatever the size of the corpus,
so sample, counts and weights fit in the driver and in every task. Scoring reads every
whole text in one pass without a shuffle.

Null text counts as empty and gets the score of a text without known words. Every row
gives a row. With no usable labels (empty tables, one class only) all scores are the
share of label 1, or 0. Null labels and labels without a document are not learnt from;
repeated labels of one document count once, as the highest. Other columns are ignored.
"""

from __future__ import annotations

import collections
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


from tidemark.llm.common import document_columns, other_columns, stored, whole_text

SAMPLE = 20_000
WORDS = 4_096
#: Letters of a beginning, and the share of a text's words that have to share it.
STEMS = (5, 6, 7)
DENSE = 0.01
#: A feature has to be in so many sampled texts, and to tell so much about the label
#: (chi-square with one degree of freedom: quantile 0.9999).
LEAST = 4
TELLING = 15.1
RIDGE = 1e-3
#: Weight of the squared change of score between a sentence and its copies.
SWAP = 1.0
#: So many times that, where the name gives way to a word that says nothing.
NEUTRAL = 20.0
THRESHOLD = 0.3

#: Names of groups, by kind; a name is exchanged within its kind.
KINDS = (
    "women men girls boys woman man female male frauen männer femmes hommes mujeres hombres",
    "muslims christians jews hindus buddhists atheists muslim christian jewish hindu buddhist "
    "muslime christen juden musulmans chrétiens juifs musulmanes cristianos judíos",
    "black white asian latino african arab european native indigenous",
    "gay lesbian straight bisexual transgender queer heterosexual homosexual schwule lesben homosexuelle "
    "lesbiennes homosexuels homosexuales lesbianas",
    "immigrants refugees migrants foreigners citizens natives einwanderer flüchtlinge ausländer immigrés réfugiés "
    "étrangers inmigrantes refugiados extranjeros",
    "disabled blind deaf autistic elderly young",
    "germans french mexicans americans chinese indians turks poles",
)
#: Beginnings of names.
NAMED = frozenset(name[:size] for kind in KINDS for name in kind.split() for size in STEMS if len(name) >= size)


def _stripped(text: str) -> list[str]:
    """Lower-case words without the marks around them."""
    return [w.strip(".,;:!?\"'()[]{}«»“”„‘’…-*#$%&|<>") for w in text.lower().split()]


def features(text: str) -> set[str]:
    """Words of a text, and beginnings (marked by a star) of a good share of its words, but not of names."""
    words = collections.Counter(_stripped(text))
    del words[""]
    least = DENSE * words.total()
    stems: dict[str, int] = collections.defaultdict(int)
    for word, n in words.items():
        for size in STEMS:
            if len(word) >= size:
                stems[word[:size]] += n
    return set(words).union(stem + "*" for stem, n in stems.items() if n >= least and stem not in NAMED)


def known_features(text: str, words: set[str], stems: set[str]) -> list[str]:
    """Those of ``features`` that a model has, in order; stems without their star."""
    counts = collections.Counter(_stripped(text))
    del counts[""]
    least = DENSE * counts.total()
    found: dict[str, int] = collections.defaultdict(int)
    for word, n in counts.items():
        for size in STEMS:
            if (stem := word[:size]) in stems and len(stem) == size:
                found[stem] += n
    return sorted(words.intersection(counts)) + sorted(s + "*" for s, n in found.items() if n >= least)


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(doc_id, toxic, text) of at most ``sample`` labelled documents that are not held out."""
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    chosen = stored(chosen, "toxicity-sample")  # its size has a bound, so it can be sent to all tasks
    found = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), "doc_id")
    return stored(found, "toxicity-rows")


def _word_lists(rows: DataFrame) -> DataFrame:
    """(doc_id, toxic, words): the features of each text."""

    def lists(batches):
        for batch in batches:
            keys, toxic, texts = (c.to_pylist() for c in batch.columns)
            out = [
                (k, t, sorted(features(x))) for k, t, x in zip(keys, toxic, texts)
            ]
            yield pa.record_batch(
                [
                    pa.array([x[0] for x in out], pa.int64()),
                    pa.array([x[1] for x in out], pa.int32()),
                    pa.array([x[2] for x in out], pa.list_(pa.string())),
                ],
                ["doc_id", "toxic", "words"],
            )

    return rows.select("doc_id", "toxic", "text").mapInArrow(
        lists, "doc_id bigint, toxic int, words array<string>"
    )


def informative_words(lists: DataFrame, most: int) -> list[str]:
    """Words whose presence depends most on the label, by chi-square; ties in order of spelling."""
    totals = lists.agg(
        F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("positive")
    ).first()
    n, positive = float(totals["n"]), float(totals["positive"])
    if not 0 < positive < n:
        return []
    expected = F.col("held") * positive / n
    spread = expected * (1 - positive / n) * (1 - (F.col("held") - 1) / n)
    gain = (F.col("toxic") - expected) ** 2 / spread
    counts = (
        lists.select("toxic", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("held"), F.sum("toxic").alias("toxic"))
        .where((F.col("held") >= LEAST) & (gain >= TELLING))
    )
    return [r["word"] for r in counts.orderBy(F.desc(gain), "word").limit(most).collect()]


def _swaps(names: list[str]) -> dict[str, list[str]]:
    return {
        name: [x for x in kind.split() if x != name]
        for kind in KINDS
        for name in kind.split()
        if name in names
    }


def fit(
    rows: list[list[int]], labels: np.ndarray, n_words: int, pairs: list[tuple[int, int, float]]
) -> np.ndarray:
    """Weights of the words and, last, the intercept, by accelerated gradient steps.

    ``rows``: words of each text. ``pairs``: (word, other word, share of texts) exchanged; the
    other word may be ``n_words``, one that says nothing.
    """
    counts = np.array([len(r) for r in rows], np.int64)
    columns = np.fromiter(itertools.chain.from_iterable(rows), np.int64, int(counts.sum()))
    row_of = np.repeat(np.arange(len(rows)), counts)
    n = len(rows)
    # Rarer class weighs more, so that both count alike.
    share = labels.mean()
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    a = np.array([p[0] for p in pairs], np.int64)
    b = np.array([p[1] for p in pairs], np.int64)
    often = np.array([p[2] for p in pairs]) * SWAP * np.where(b == n_words, NEUTRAL, 1.0)
    w = np.zeros(n_words + 1)
    best, momentum, speed = w.copy(), w.copy(), 1.0
    step = 4.0 / (1.0 + np.bincount(row_of, minlength=n).mean() + 4 * SWAP * (1 + NEUTRAL))
    for _ in range(400):
        z = np.bincount(row_of, momentum[columns], n) + momentum[-1]
        error = weight * (1 / (1 + np.exp(-z)) - labels) / n
        slope = np.append(np.bincount(columns, error[row_of], n_words), error.sum())
        slope[:-1] += RIDGE * momentum[:-1]
        known = np.append(momentum[:-1], 0.0)
        change = known[a] - known[b]
        slope[:-1] += np.bincount(a, often * change, n_words)
        slope[:-1] -= np.bincount(b, often * change, n_words + 1)[:n_words]
        best, w = w, momentum - step * slope
        faster = (1 + np.sqrt(1 + 4 * speed**2)) / 2
        momentum = w + (speed - 1) / faster * (w - best)
        speed = faster
    # Back to the share of label 1 in the sample.
    w[-1] += np.log(share / (1 - share)) if 0 < share < 1 else 0
    return w


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = WORDS) -> dict:
    """{word: weight} and, under "", the intercept."""
    lists = stored(_word_lists(training_rows(docs, labels, sample)), "toxicity-words")
    names = [name for kind in KINDS for name in kind.split()]
    known = informative_words(lists, most)
    if not known:
        share = lists.agg(F.avg("toxic")).first()[0] or 0.0
        share = min(max(share, 1e-6), 1 - 1e-6)
        return {"": float(np.log(share / (1 - share)))}
    vocabulary = list(dict.fromkeys([*known, *names]))
    place = {w: i for i, w in enumerate(vocabulary)}
    kept = lists.select(
        "toxic", F.array_intersect("words", F.array(*map(F.lit, vocabulary))).alias("words")
    ).orderBy("doc_id")
    found = kept.collect()  # at most ``sample`` rows of at most ``most`` words
    rows = [[place[w] for w in r["words"]] for r in found]
    y = np.array([r["toxic"] for r in found], float)
    swaps = _swaps(names)
    held = np.bincount(np.fromiter(itertools.chain.from_iterable(rows), np.int64), minlength=len(place))
    # Every name is exchanged at least as if one text in a thousand held it.
    share = {name: max(held[place[name]] / len(rows), 1e-3) for name in swaps}
    pairs = [
        (place[name], place[other], share[name] / len(others)) for name, others in swaps.items() for other in others
    ]
    pairs += [(place[name], len(vocabulary), often) for name, often in share.items()]
    w = fit(rows, y, len(vocabulary), pairs)
    return {"": float(w[-1])} | {x: float(v) for x, v in zip(vocabulary, w) if v}


def score_texts(texts: list[str], model: dict) -> list[float]:
    """Probability of label 1 of each text."""
    words = {w for w in model if w and w[-1] != "*"}
    stems = {w[:-1] for w in model if w and w[-1] == "*"}
    weight = model.__getitem__
    return [
        float(1 / (1 + np.exp(-model[""] - sum(map(weight, known_features(text, words, stems))))))
        for text in texts
    ]


def scored(df: DataFrame, model: dict, with_text: bool = False) -> DataFrame:
    """The other columns of ``df`` (text and more) and ``score``."""
    carried = [f for f in df.schema.fields if f.name != "text"]
    df = df.select(*[f.name for f in carried], "text")
    last = len(df.columns) if with_text else len(carried)
    schema = T.StructType([*df.schema.fields[:last], T.StructField("score", T.DoubleType())])
    names = [f.name for f in schema.fields]

    def rows(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            scores = pa.array(score_texts(texts, model), pa.float64())
            yield pa.record_batch([*batch.columns[:last], scores], names)

    return df.mapInArrow(rows, schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    model = train(docs, labels)
    return scored(docs.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_civil(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents below the threshold, with all their columns."""
    model = train(docs, labels)
    whole = scored(docs.select(other_columns(docs), "text"), model, with_text=True)
    return whole.where(F.col("score") < THRESHOLD).select(*document_columns(docs.columns))
