"""Quality rules: text statistics, fixed bounds, and robust multivariate outliers.

Statistics of whole texts are turned into a vector: log mean word length, log of one
plus symbols per word, share of lines that repeat, share of words in repeated three-word
runs. Per language and source a minimum-covariance-determinant estimate is fitted to the
vectors that pass the fixed bounds: from medians and quartiles on, each step keeps the
half of the rows closest to the last estimate and takes their mean and covariance. A row
whose Mahalanobis distance is beyond ``CUTOFF`` goes.

One step is one aggregation: rows are counted, and their moments added, per group and
distance class, so a group of any size is combined before the shuffle and no row is
collected. Only moments (some hundred rows a group) reach a Python function.

Covariances get a floor (``FLOOR``): in clean text the last three statistics are almost
always 0, and without it any other value would be infinitely far. It is low enough for
each statistic to reject a row by itself. Groups with fewer than
``LEAST`` rows share an estimate per language, and languages with fewer share one.

Null text has no words and fails the bounds, like empty text. Null language or source is
a value of its own. Every row gives a row; repeated rows get equal verdicts. An empty
table gives no rows. Other columns are carried or ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import SPACE, distinct, groups, run_hashes, utf8, word_hashes, words
from tidemark.llm.common import document_columns, other_columns, stored

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
N = 4
#: Least standard deviation of each statistic.
FLOOR = (0.05, 0.02, 0.09, 0.08)
#: Chi-square with four degrees of freedom: quantiles 0.99999 and 0.5.
CUTOFF, MIDDLE = 28.47, 3.357
LEAST = 200
STEPS = 4
#: Distance classes per factor of two.
FINE = 16
SLICE = 500_000


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[offsets])


def _dup_lines(text: str) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier one."""
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return len(lines), len(lines) - len(set(lines))


def text_statistics(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The ``STATISTICS`` of each text."""
    starts, ends, bounds = words(data, offsets)
    n_words = np.diff(bounds)
    points = (data & 0xC0) != 0x80
    word_chars = _per_text(points & ~SPACE[data], offsets)
    n_symbols = _per_text(SYMBOLS[data], offsets)
    hashes, at = run_hashes(word_hashes(data, starts, ends, 2), bounds, 3)
    text_of = np.searchsorted(bounds, at, "right") - 1
    order = np.lexsort((hashes, text_of))
    a, b = order[:-1], order[1:]
    same = (hashes[a] == hashes[b]) & (text_of[a] == text_of[b])
    twice = distinct(np.concatenate([at[a[same]], at[b[same]]]))
    covered = np.zeros(len(starts) + 3, bool)
    for j in range(3):
        covered[twice + j] = True
    n_repeat = np.diff(np.concatenate([[0], np.cumsum(covered)])[bounds])
    raw = data.tobytes()
    lines = [_dup_lines(raw[s:e].decode()) for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    n_lines, n_dup = np.array(lines, np.int64).reshape(-1, 2).T
    return [n_words, word_chars, n_symbols, n_lines, n_dup, n_repeat]


def measured(df: DataFrame, with_text: bool = False) -> DataFrame:
    """The other columns of ``df`` (lang, source, text and more) and the ``STATISTICS``."""
    carried = [f for f in df.schema.fields if f.name != "text"]
    df = df.select(*[f.name for f in carried], "text")
    last = len(df.columns) if with_text else len(carried)
    schema = T.StructType([*df.schema.fields[:last], *(T.StructField(s, T.LongType()) for s in STATISTICS)])
    names = [f.name for f in schema.fields]

    def rows(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(batch.num_columns - 1))
            for first, end in groups(offsets, SLICE):
                own = offsets[first : end + 1]
                found = text_statistics(data[own[0] : own[-1]], own - own[0])
                kept = [c.slice(first, end - first) for c in batch.columns[:last]]
                yield pa.record_batch([*kept, *(pa.array(x.astype(np.int64)) for x in found)], names)

    return df.mapInArrow(rows, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _vector() -> Column:
    """Null for a text without words."""
    n = F.nullif("n_words", F.lit(0))
    return F.when(
        n.isNotNull(),
        F.array(
            F.log(F.col("word_chars") / n),
            F.log1p(F.col("n_symbols") / n),
            F.coalesce(F.col("n_dup_lines") / F.nullif("n_lines", F.lit(0)), F.lit(0.0)),
            F.col("n_repeat_words") / n,
        ),
    )


def _distance(vector: str = "v") -> Column:
    """Squared Mahalanobis distance to ``mean`` by ``inverse`` (row by row)."""
    off = [F.col(vector)[i] - F.col("mean")[i] for i in range(N)]
    return sum(
        (off[i] * off[j] * F.col("inverse")[i * N + j] for i in range(N) for j in range(N)),
        F.lit(0.0),
    )


def _pair() -> Column:
    return F.to_json(F.struct("lang", "source"))


def _estimate_of(pairs: DataFrame) -> DataFrame:
    """(pair, key): which estimate each language and source uses."""
    counts = pairs.groupBy("lang", "source").count()
    small = counts.where(F.col("count") < LEAST)
    langs = small.groupBy(F.to_json(F.struct("lang")).alias("l")).agg(F.sum("count").alias("n"))
    return counts.withColumn("l", F.to_json(F.struct("lang"))).join(langs, "l", "left").select(
        _pair().alias("pair"),
        F.when(F.col("count") >= LEAST, F.concat(F.lit("source "), _pair()))
        .when(F.col("n") >= LEAST, F.concat(F.lit("language "), "l"))
        .otherwise(F.lit("all"))
        .alias("key"),
    )


PARAMETERS = "key string, mean array<double>, inverse array<double>, n bigint"


def _parameters(key: str, mean, covariance, n: int) -> dict:
    inverse = np.linalg.inv(np.asarray(covariance) + np.diag(np.square(FLOOR)))
    return {"key": [key], "mean": [list(map(float, mean))], "inverse": [inverse.ravel().tolist()], "n": [n]}


def _first(rows: pa.Table) -> pa.Table:
    (row,) = rows.to_pylist()
    q = np.array([row[f"q{i}"] for i in range(N)], float)
    spread = (q[:, 2] - q[:, 0]) / 1.349
    return pa.table(_parameters(row["key"], q[:, 1], np.diag(spread**2), int(row["n"])))


def _step(rows: pa.Table) -> pa.Table:
    """Mean and covariance of the closest half, by distance class; a class in part by weight."""
    key = rows.column("key")[0].as_py()
    rows = {c: rows.column(c).to_numpy() for c in rows.column_names if c != "key"}
    order = np.argsort(rows["class"])
    rows = {c: v[order] for c, v in rows.items()}
    count = rows["count"].astype(float)
    before = np.cumsum(count) - count
    n = count.sum()
    half = min(n, (n + N + 1) // 2)
    part = np.clip((half - before) / count, 0, 1)
    sums = np.stack([(np.array(rows[f"s{i}"], float) * part).sum() for i in range(N)])
    mean = sums / half
    cross = np.empty((N, N))
    for i in range(N):
        for j in range(i, N):
            cross[i, j] = cross[j, i] = (np.array(rows[f"s{i}{j}"], float) * part).sum() / half
    # The distance in the middle, if the old estimate were the true one, would be MIDDLE.
    middle = 2.0 ** ((rows["class"][np.searchsorted(before + count, n / 2)] + 1) / FINE)
    out = _parameters(key, mean, cross - np.outer(mean, mean), int(n))
    return pa.table(out | {"scale": [max(1.0, float(middle) / MIDDLE)]})


def robust_estimates(statistics: DataFrame) -> DataFrame:
    """(pair, mean, inverse) for each language and source in ``statistics``, a stored table
    of ``measured`` rows. ``inverse`` belongs to the covariance scaled so that the middle
    distance is that of normal data, or less."""
    keys = stored(_estimate_of(statistics), "quality-keys")
    vectors = (
        statistics.where(~base_failed())
        .select(_pair().alias("pair"), _vector().alias("v"))
        .join(keys, "pair")
        .select("key", "v")
    )
    quartiles = [
        F.percentile_approx(F.col("v")[i], [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i in range(N)
    ]
    parameters = stored(
        vectors.groupBy("key")
        .agg(F.count("*").alias("n"), *quartiles)
        .groupBy("key")
        .applyInArrow(_first, PARAMETERS),
        "quality-estimates",
    )
    for _ in range(STEPS):
        parameters = stored(_next(vectors, parameters), "quality-estimates")
    final = _classes(vectors, parameters).groupBy("key").applyInArrow(
        _scales, "key string, scale double"
    )
    return (
        keys.join(parameters, "key")
        .join(final, "key")
        .select(
            "pair",
            "mean",
            F.transform("inverse", lambda x: x / F.col("scale")).alias("inverse"),
        )
    )


def _classes(vectors: DataFrame, parameters: DataFrame) -> DataFrame:
    """Counts and moments per estimate and distance class."""
    moments = [F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(N)] + [
        F.sum(F.col("v")[i] * F.col("v")[j]).alias(f"s{i}{j}") for i in range(N) for j in range(i, N)
    ]
    near = F.greatest(_distance(), F.lit(2.0**-20))
    return (
        vectors.join(parameters.select("key", "mean", "inverse"), "key")
        .withColumn("class", F.floor(F.log2(near) * FINE).cast("int"))
        .groupBy("key", "class")
        .agg(F.count("*").alias("count"), *moments)
    )


def _next(vectors: DataFrame, parameters: DataFrame) -> DataFrame:
    rows = _classes(vectors, parameters).groupBy("key").applyInArrow(
        _step, PARAMETERS + ", scale double"
    )
    return rows.drop("scale")


def _scales(rows: pa.Table) -> pa.Table:
    return _step(rows).select(["key", "scale"])


def judged(statistics: DataFrame, estimates: DataFrame) -> DataFrame:
    """``statistics`` with base_failed, distance and kept."""
    joined = statistics.withColumn("pair", _pair()).join(estimates, "pair", "left")
    distance = _distance("v")
    return (
        joined.withColumn("v", _vector())
        .withColumn("base_failed", base_failed())
        .withColumn("distance", F.sqrt(F.greatest(distance, F.lit(0.0))))
        .withColumn(
            "kept",
            ~F.col("base_failed")
            & (F.coalesce(F.col("distance"), F.lit(0.0)) <= float(np.sqrt(CUTOFF))),
        )
        .drop("pair", "v", "mean", "inverse")
    )


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """(doc_id, statistics, base_failed, distance, kept), one row per document."""
    rows = measured(docs.select("doc_id", "lang", "source", "text"))
    rows = stored(rows, "quality-statistics")
    return judged(rows, robust_estimates(rows)).drop("lang", "source")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns."""
    plain = stored(measured(docs.select("lang", "source", "text")), "quality-statistics")
    whole = measured(docs.select(other_columns(docs), "lang", "source", "text"), with_text=True)
    kept = judged(whole, robust_estimates(plain)).where("kept")
    return kept.select(*document_columns(docs.columns))
