import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from frames import T0, table
from tidemark.operators import quality, trailing
from tidemark.queries import QUERIES


@pytest.fixture(params=[1, 16_384])
def blocks(request, monkeypatch):
    monkeypatch.setattr(trailing, "BLOCK_ROWS", request.param)
    monkeypatch.setattr(trailing, "TOP_ROWS", request.param)


def shuffled(spark, n=800):
    r = random.Random(n)
    seconds = [T0 + r.randrange(40_000) for _ in range(n)] + [T0 + 900_000]
    return table(spark, seconds, v=[None if r.random() < 0.3 else 1 for _ in seconds]), pd.Series(seconds)


def test_interval_stats(spark, blocks):
    df, seconds = shuffled(spark)
    d = seconds.sort_values().diff().dropna()
    row = quality.interval_stats(df, "datetime_utc").first()
    assert row.n_intervals == len(d)
    for got, want in ((row.mean_s, d.mean()), (row.median_s, d.median()), (row.std_s, d.std()), (row.min_s, d.min()), (row.max_s, d.max())):
        assert got == pytest.approx(want, rel=1e-12)


def test_irregular_and_duplicates(spark, blocks):
    df, seconds = shuffled(spark)
    d = seconds.sort_values().diff().dropna()
    odd = d[(d - d.mean()).abs() > 2 * d.std()]
    row = quality.irregular_intervals(df, "datetime_utc").first()
    assert (row.irregular, row.n_intervals) == (len(odd), len(d))
    rows = quality.irregular_rows(df, "datetime_utc").collect()
    assert sum(r.occurrences for r in rows) == len(odd) and sorted(r.interval_s for r in rows) == sorted(odd)
    dup = quality.duplicate_times(df, "datetime_utc").first()
    assert dup.duplicates == seconds.duplicated().sum() > 0


def test_regular_series_has_no_spread(spark):
    row = quality.interval_stats(table(spark, [T0 + 2 * i for i in range(1000)]), "datetime_utc").first()
    assert (row.mean_s, row.median_s, row.std_s) == (2.0, 2.0, 0.0)


def test_out_of_order(spark, blocks):
    df, seconds = shuffled(spark)
    late = seconds.diff() < 0
    row = quality.out_of_order(df, "datetime_utc", "id").first()
    assert (row.n_rows, row.out_of_order) == (len(seconds), late.sum())
    ids = [r.id for r in quality.out_of_order_rows(df, "datetime_utc", "id").collect()]
    assert sorted(ids) == list(seconds.index[late])


def test_out_of_order_beyond_bigint(spark, blocks):
    df, seconds = shuffled(spark, 60)
    far = df.withColumn("id", F.expr("CAST(id AS DECIMAL(19,0)) * 10000000000000000000000BD"))
    late = seconds.diff() < 0
    assert quality.out_of_order(far, "datetime_utc", "id").first().out_of_order == late.sum() > 0
    ids = [int(r.id) // 10**22 for r in quality.out_of_order_rows(far, "datetime_utc", "id").collect()]
    assert sorted(ids) == list(seconds.index[late])


def test_query_with_sparse_ids_on_many_orders(spark, tmp_path):
    """Orders numbered beyond 8,388,607: times 2**40 that is no bigint any more."""
    rows = spark.range(4).selectExpr("9000000 + id AS o_orderkey", "timestamp_seconds(864000 * (id % 3)) AS o_orderdate")
    rows.write.parquet(f"{tmp_path}/orders.parquet")
    row = QUERIES["out_of_order_sparse_ids"](spark, str(tmp_path)).first()
    assert (row.n_rows, row.out_of_order, row.out_of_order_pct) == (4, 1, 25.0)


def test_equal_times_are_in_order(spark):
    df = table(spark, [T0, T0, T0 + 1])
    assert quality.out_of_order(df, "datetime_utc", "id").first().out_of_order == 0


@pytest.mark.parametrize("expected, listed", [(1, [3, 10]), (2, [3, 10]), (10, []), (5, [10])])
def test_gaps(spark, expected, listed):
    df = table(spark, [T0 + s for s in (0, 1, 2, 3, 6, 7, 8, 9, 10, 10, 20)])
    rows = quality.gaps(df, "datetime_utc", expected).collect()
    assert sorted(r.datetime_utc - T0 for r in rows) == listed


def test_series_without_a_key_have_statistics(spark):
    rows = spark.range(90).select(F.nullif(F.col("id") % 3, F.lit(0)).alias("k"), (F.col("id") * 7 + T0).alias("t"))
    assert {r.k: r.irregular for r in quality.irregular_intervals(rows, "t", ("k",)).collect()} == {None: 0, 1: 0, 2: 0}


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    assert [(r.column_name, r.missing) for r in quality.null_report(df).collect()] == [("v", 2)]


def test_null_report(spark):
    df, _ = shuffled(spark)
    rows = quality.null_report(df).collect()
    nulls = df.where("v is null").count()
    assert [(r.column_name, r.missing) for r in rows] == [("v", nulls)]
    assert rows[0].missing_pct == pytest.approx(100 * nulls / 801)


def test_report(spark):
    df, seconds = shuffled(spark)
    rows = {(r.metric, r.column_name): r.value for r in quality.quality_report(df, "t").collect()}
    assert rows[("n_rows", None)] == 801 and rows[("duplicates", None)] == seconds.duplicated().sum()
    assert rows[("missing", "v")] > 0 and ("missing", "id") not in rows
    assert rows[("out_of_order", None)] == (seconds.diff() < 0).sum()
    assert rows[("median_s", None)] == seconds.sort_values().diff().median()


def test_report_of_an_empty_table(spark):
    rows = {r.metric: r.value for r in quality.quality_report(table(spark, [], v=[]), "t").collect()}
    assert rows["n_rows"] == 0 and rows["n_intervals"] == 0 and rows["irregular_pct"] == 0
    assert rows["mean_s"] is None


def test_report_without_a_time_column(spark):
    rows = quality.quality_report(spark.range(5), "t").collect()
    assert [(r.metric, r.value) for r in rows] == [("n_rows", 5.0)]


def test_report_over_several_tables(spark):
    df, _ = shuffled(spark)
    report = quality.quality_report_all({"a": df, "b": df.where(F.col("id") < 10)})
    assert {r.table_name for r in report.select("table_name").distinct().collect()} == {"a", "b"}


def test_single_row(spark):
    row = quality.interval_stats(table(spark, [T0]), "datetime_utc").first()
    assert (row.n_intervals, row.mean_s, row.std_s) == (0, None, None)


def test_one_time_holds_most_rows(spark):
    hot = spark.range(100_000).select(F.lit(T0).cast("bigint").alias("datetime_utc"), "id")
    rest = spark.range(100_000, 100_010).select((F.col("id") + T0).alias("datetime_utc"), "id")
    row = quality.interval_stats(hot.unionByName(rest), "datetime_utc").first()
    assert row.n_intervals == 100_009 and row.median_s == 0 and row.max_s == 100_000
