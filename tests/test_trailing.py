import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from frames import T0, by_time, column, table
from tidemark.operators import trailing
from tidemark.operators.trailing import rolling_mean, rolling_mean_time, with_previous
from tidemark.params import SECOND


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(trailing, "BLOCK_ROWS", 1)
    monkeypatch.setattr(trailing, "TOP_ROWS", 1)


def positions(seed, n):
    """Irregular: dense runs, single rows, and gaps over many blocks."""
    r = random.Random(seed)
    at, out = 0, []
    for _ in range(n):
        at += r.choice([1, 1, 1, 1, 2, 5, 40, 700, 20_000])
        out.append(at)
    return out


def frame(spark, seed, n, keys=1):
    r = random.Random(seed)
    rows = [
        (k, p, None if r.random() < 0.2 else r.random())
        for k in range(keys)
        for p in positions(seed + k, n)
    ]
    return spark.createDataFrame(rows, "k int, p bigint, v double"), pd.DataFrame(rows, columns=["k", "p", "v"])


@pytest.mark.parametrize("n", [1, 2, 3, 20, 60])
def test_rolling_mean_equals_pandas(spark, small_blocks, n):
    df, pdf = frame(spark, n, 600)
    got = rolling_mean(df, (), "p", n, {"m": "v"}).orderBy("p").toPandas()["m"]
    want = pdf.v.astype(float).rolling(n, min_periods=1).mean()
    pd.testing.assert_series_equal(got, want, check_names=False, rtol=1e-12, atol=1e-12)


def test_rolling_mean_per_series(spark, small_blocks):
    df, pdf = frame(spark, 3, 300, keys=3)
    got = rolling_mean(df, ("k",), "p", 7, {"m": "v"}).orderBy("k", "p").toPandas()["m"]
    want = pdf.groupby("k").v.transform(lambda s: s.astype(float).rolling(7, min_periods=1).mean())
    pd.testing.assert_series_equal(got, want, check_names=False, rtol=1e-12, atol=1e-12)


def test_previous_row(spark, small_blocks):
    df, pdf = frame(spark, 11, 1000)
    got = with_previous(df, (), "p", {"q": "p"}).orderBy("p").toPandas()["q"]
    pd.testing.assert_series_equal(got, pdf.p.shift().astype(float), check_names=False)


def test_negative_positions(spark, small_blocks):
    df = spark.range(-500, 500).select(F.col("id").alias("p"))
    rows = with_previous(df, (), "p", {"q": "p"}).where("q is null or q <> p - 1").collect()
    assert [(r.p, r.q) for r in rows] == [(-500, None)]


def test_spacing(spark):
    df = spark.range(0, 40_000).select((F.col("id") * 10).alias("p"), F.col("id").cast("double").alias("v"))
    got = rolling_mean(df, (), "p", 3, {"m": "v"}, spacing=10)
    assert got.count() == 40_000
    assert got.where("p >= 20 and abs(m - (v - 1)) > 1e-9").count() == 0


def test_window_of_three_rows(spark):
    df = table(spark, [T0 + 6 * i for i in range(7)], ph_total=[8.3, 8.1, 8.8, 7.7, 8.0, 8.6, 7.9])
    got = column(rolling_mean(df, (), "datetime_utc", 3, {"ma": "ph_total"}), "ma", "datetime_utc")
    assert got[0] == 8.3 and got[6] == pytest.approx(8.2) and got[36] == pytest.approx(24.5 / 3)


def test_nan_counts_as_null(spark):
    nan = float("nan")
    df = table(spark, [T0 + i for i in range(5)], v=[1, nan, 3, nan, nan]).withColumn("us", F.col("datetime_utc") * SECOND)
    got = column(rolling_mean(df, (), "us", 2, {"m": "v"}), "m", "us")
    assert list(got.values()) == [1, 1, 3, 3, None]
    timed = column(rolling_mean_time(df, (), "us", "v", 2 * SECOND), "mean", "us")
    assert list(timed.values()) == [1, 1, 3, 3, None]


def test_nulls_occupy_a_slot(spark):
    df = table(spark, [T0 + i for i in range(6)], v=[1, None, 3, None, None, 6])
    got = column(rolling_mean(df, (), "datetime_utc", 2, {"m": "v"}), "m", "datetime_utc")
    assert list(got.values()) == [1, 1, 3, 3, None, 6]


@pytest.mark.parametrize("blocks", [None, 64])
@pytest.mark.parametrize("window", [1, 120, 3600, 40_000])
def test_time_window_equals_pandas(spark, monkeypatch, window, blocks):
    """Also with blocks shorter than the window."""
    if blocks:
        monkeypatch.setattr(trailing, "BLOCK_ROWS", blocks)
    r = random.Random(window)
    seconds = sorted(r.randrange(100_000) for _ in range(1500))
    values = [None if r.random() < 0.1 else r.random() for _ in seconds]
    df = table(spark, [T0 + s for s in seconds], v=values).withColumn("us", F.col("datetime_utc") * SECOND)
    got = by_time(rolling_mean_time(df, (), "us", "v", window * SECOND), "us")
    s = pd.Series(values, index=pd.to_datetime([T0 + x for x in seconds], unit="s"), dtype="float64")
    want = s.rolling(f"{window}s").mean().groupby(level=0).last()
    assert list(got) == sorted(set(seconds))
    for t, w in zip(got, want):
        assert (got[t]["mean"] is None and pd.isna(w)) or got[t]["mean"] == pytest.approx(w, rel=1e-9)


def test_time_window_per_series(spark, monkeypatch):
    monkeypatch.setattr(trailing, "BLOCK_ROWS", 50)
    r = random.Random(4)
    rows = [(r.choice(["a", "b", None]), (T0 + r.randrange(3000)) * SECOND, r.random()) for _ in range(900)]
    df = spark.createDataFrame(rows, "k string, us bigint, v double")
    got = rolling_mean_time(df, ("k",), "us", "v", 400 * SECOND)
    assert got.count() == len({(k, t) for k, t, _ in rows})
    for row in got.collect():
        own = [v for k, t, v in rows if k == row.k and row.us - 400 * SECOND < t <= row.us]
        assert row.n == len(own) and row["mean"] == pytest.approx(sum(own) / len(own), rel=1e-9)


def test_time_window_over_one_hot_second(spark):
    hot = spark.range(50_000).select(F.lit(T0 * SECOND).alias("us"), F.lit(2.0).alias("v"))
    rest = spark.range(1, 300).select(((F.col("id") + T0) * SECOND).alias("us"), F.lit(5.0).alias("v"))
    got = by_time(rolling_mean_time(hot.unionByName(rest), (), "us", "v", 60 * SECOND), "us")
    assert got[0] == {"mean": 2.0, "n": 50_000}
    assert got[59]["n"] == 50_059 and got[60] == {"mean": 5.0, "n": 60}


@pytest.mark.parametrize("window", [2, 50, 700])
@pytest.mark.parametrize("spike", [1e17, float("inf")])
def test_an_extreme_reading_leaves_no_trace(spark, monkeypatch, spike, window):
    monkeypatch.setattr(trailing, "BLOCK_ROWS", 64)
    rows = [((T0 + i) * SECOND, spike if i == 500 else 1.0) for i in range(2000)]
    got = by_time(rolling_mean_time(spark.createDataFrame(rows, "us bigint, v double"), (), "us", "v", window * SECOND), "us")
    for t, row in got.items():
        assert row["n"] == min(t + 1, window)
        assert row["mean"] == 1.0 if not 500 <= t < 500 + window else row["mean"] > 1e13, t


def test_one_level_where_few_rows_are_known(spark):
    df, pdf = frame(spark, 5, 400)
    one = trailing.trailing_levels(df, (), "p", 7, {"q": lambda w: F.lag("v", 1).over(w)}, max_rows=400)
    more = trailing.trailing_levels(df, (), "p", 7, {"q": lambda w: F.lag("v", 1).over(w)}, max_rows=1_000_000)
    assert (len(one), len(more)) == (1, 3)
    got = rolling_mean(df, (), "p", 7, {"m": "v"}, max_rows=400).orderBy("p").toPandas()["m"]
    want = pdf.v.astype(float).rolling(7, min_periods=1).mean()
    pd.testing.assert_series_equal(got, want, check_names=False, rtol=1e-12, atol=1e-12)
