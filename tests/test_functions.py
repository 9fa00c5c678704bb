import math

import pytest
from pyspark.sql import Row, functions as F, types as T

from frames import T0, table
from tidemark.functions.ph import corrected_ph
from tidemark.functions.rows import conform, drop_empty, iso_times, nan_to_null, numeric_columns, to_items
from tidemark.functions.time import coerce_time, epoch_seconds, floor_to, iso_z_from_seconds, partition_label
from tidemark.operators.aggregate import mean_resample
from tidemark.params import HOUR, SECOND, micros


def ph(spark, vrse, temp, salinity, k0=-1.39469, k2=-0.00107):
    row = spark.range(1).select(
        *[F.lit(v).cast("double").alias(n) for n, v in (("v", vrse), ("t", temp), ("s", salinity))]
    )
    return row.select(corrected_ph("v", "t", "s", k0, k2).alias("ph")).first()["ph"]


def scalar_ph(v, t, s, k0, k2):
    """The published formula, term by term."""
    tk = t + 273.15
    nernst = 8.31446 * tk / 96485.0 * math.log(10)
    i = 19.924 * s / (1000 - 1.005 * s)
    adh = 3.4286e-6 * t**2 + 6.7524e-4 * t + 0.49172143
    lgam = -adh * math.sqrt(i) / (1 + 1.394 * math.sqrt(i)) + (0.08885 - 0.000111 * t) * i
    cl = 0.99889 / 35.453 * s / 1.80655
    st = 0.1400 / 96.062 * s / 1.80655
    ks = math.exp(
        -4276.1 / tk + 141.328 - 23.093 * math.log(tk)
        + (-13856 / tk + 324.57 - 47.986 * math.log(tk)) * math.sqrt(i)
        + (35474 / tk - 771.54 + 114.723 * math.log(tk)) * i
        - 2698 / tk * i**1.5 + 1776 / tk * i**2
    ) * (1 - 0.001005 * s)
    free = (v - (k0 + k2 * t)) / nernst + math.log10(cl * 1000 / (1000 - 1.005 * s)) + 2 * lgam
    free -= math.log10((1000 - 1.005 * s) / 1000)
    return free - math.log10(1 + st / ks)


def test_ph_value(spark):
    assert ph(spark, -0.95, 15, 35) == pytest.approx(7.485, abs=1e-3)
    assert ph(spark, -0.95, 15, 35, 0.0, 0.0) == pytest.approx(-17.19, abs=1e-2)
    for v, t, s in ((0.1, 20, 35), (0.2, 21, 36), (-0.9, 2.5, 30.1)):
        assert ph(spark, v, t, s) == pytest.approx(scalar_ph(v, t, s, -1.39469, -0.00107), abs=1e-10)


@pytest.mark.parametrize("inputs", [(None, 15, 35), (-0.9, None, 35), (-0.9, 15, None), (-0.9, 15, 0), (-0.9, 15, -3), (-0.9, 15, 1000), (-0.9, -300, 35)])
def test_ph_is_null_without_usable_inputs(spark, inputs):
    assert ph(spark, *inputs) is None


def test_times(spark):
    row = spark.sql("SELECT -1500000L AS us, 1722931200L AS s").select(
        floor_to("us", SECOND).alias("f"),
        epoch_seconds("us").alias("e"),
        iso_z_from_seconds("s").alias("iso"),
        partition_label(F.col("s") * SECOND, 6).alias("p"),
    ).first()
    assert row == Row(f=-2_000_000, e=-2, iso="2024-08-06T08:00:00Z", p="2024-08-06-06")


def test_coerced_times(spark):
    texts = [("1722931200",), ("2024-08-06T08:00:00Z",), ("2024-08-06 08:00:00",), ("nonsense",), (None,)]
    rows = spark.createDataFrame(texts, "x string").select(F.unix_seconds(coerce_time("x")).alias("t"))
    assert [r.t for r in rows.collect()] == [1722931200, 1722931200, 1722931200, None, None]


def test_conform_and_missing_values(spark):
    df = spark.createDataFrame([(1, float("nan"), "x"), (2, 3.0, None)], "b int, a double, c string")
    assert conform(df, ["a", "z"]).columns == ["a", "z"]
    schema = T.StructType([T.StructField("z", T.StringType()), T.StructField("b", T.LongType())])
    assert conform(df, schema).schema == schema
    assert [r.a for r in nan_to_null(df).collect()] == [None, 3.0]
    assert numeric_columns(df, {"b"}) == ["a"]
    assert [r.b for r in drop_empty(nan_to_null(df), ["a"]).collect()] == [2]


def test_items(spark):
    df = spark.createDataFrame(
        [(951827696, 54.125, 7, "x"), (951827701, None, 8, None), (951827706, float("nan"), 3, "z"), (None, 1.0, 9, "y")],
        "datetime_utc bigint, latitude double, n int, note string",
    )
    rows = to_items(df).orderBy("datetime_utc").collect()
    assert [r.datetime_utc for r in rows] == ["2000-02-29T12:34:56Z", "2000-02-29T12:35:01Z", "2000-02-29T12:35:06Z"]
    assert rows[0].item == '{"static_partition":"data","datetime_utc":"2000-02-29T12:34:56Z","latitude":54.125,"n":7,"note":"x"}'
    assert rows[1].item == '{"static_partition":"data","datetime_utc":"2000-02-29T12:35:01Z","n":8}'
    assert rows[2].item == '{"static_partition":"data","datetime_utc":"2000-02-29T12:35:06Z","n":3,"note":"z"}'
    assert {r.static_partition for r in rows} == {"data"}
    timed = df.withColumn("datetime_utc", F.timestamp_seconds("datetime_utc"))
    assert [r.datetime_utc for r in to_items(timed).orderBy("datetime_utc").collect()] == [r.datetime_utc for r in rows]


def test_iso_rows(spark):
    df = spark.sql("SELECT 1 AS a, TIMESTAMP'2025-08-06 12:00:00' AS t, TIMESTAMP_NTZ'2025-08-06 12:00:01' AS n")
    assert iso_times(df).first() == Row(a=1, t="2025-08-06T12:00:00Z", n="2025-08-06T12:00:01Z")


def test_mean_buckets(spark):
    df = table(spark, [T0, T0 + 30, T0 + 200], v=[1, 3, 5]).withColumn("us", F.col("datetime_utc") * SECOND)
    rows = mean_resample(df.drop("datetime_utc"), micros("60s")).orderBy("us").collect()
    assert [(r.us // SECOND - T0, r.v) for r in rows] == [(0, 2.0), (180, 5.0)]
    assert rows[0].asDict().keys() == {"us", "v"}


def test_mean_without_numbers_is_empty(spark):
    df = spark.createDataFrame([(HOUR, "x")], "us bigint, c string")
    assert mean_resample(df, HOUR).count() == 0


def test_mean_skips_nan(spark):
    nan = float("nan")
    df = spark.createDataFrame([(0, 1.0), (1, nan), (2, 3.0), (HOUR, nan)], "us bigint, v double")
    assert [tuple(r) for r in mean_resample(df, HOUR).collect()] == [(0, 2.0)]


def test_mean_drops_buckets_without_values(spark):
    df = spark.createDataFrame([(0, None), (HOUR, 2.0), (HOUR + 1, None)], "us bigint, v double")
    assert [tuple(r) for r in mean_resample(df, HOUR).collect()] == [(HOUR, 2.0)]
