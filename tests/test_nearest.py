import random

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from frames import T0, by_time, column, one_sensor, sensor_tables, table
from tidemark.operators import trailing
from tidemark.operators.nearest import nearest_align, nearest_fill, time_grid
from tidemark.params import ALIGNED_COLUMNS, SECOND, micros
from tidemark.queries import QUERIES
from tidemark.sources.tables import long_frame


# Five readings of every sensor, four seconds apart.
READINGS = dict(rho=[0.31, 0.52, 0.17, 0.9, 0.44], ph=[8.02, 8.04, 7.97, 8.11, 8.06],
                temp=[11.5, 11.9, 12.4, 11.2, 10.8], salinity=[31.1, 30.6, 31.8, 32.0, 31.5],
                lat=[54.1, 54.2, 54.4, 54.7, 55.1], lon=[7.9, 7.7, 7.4, 7.0, 6.5])
SECONDS = (0, 4, 8, 12, 16)
STEP = micros("4s")


def made(spark, seconds=SECONDS, **changes):
    return long_frame(sensor_tables(spark, [T0 + s for s in seconds], **{**READINGS, **changes}))


def test_equal_rate(spark):
    rows = by_time(nearest_fill(made(spark), STEP))
    assert list(rows) == list(SECONDS)
    assert [r["rho_ppb"] for r in rows.values()] == READINGS["rho"]
    assert [r["longitude"] for r in rows.values()] == READINGS["lon"]
    assert all(r["vrse"] is None for r in rows.values())


def test_nulls_are_kept(spark):
    without = lambda name, i: [None if k == i else v for k, v in enumerate(READINGS[name])]
    long = made(spark, rho=without("rho", 3), ph=without("ph", 1), temp=without("temp", 4), salinity=without("salinity", 0))
    rows = by_time(nearest_fill(long, STEP))
    assert len(rows) == 5
    assert rows[12]["rho_ppb"] is None and rows[4]["ph_total"] is None
    assert rows[16]["temp"] is None and rows[0]["salinity"] is None


@pytest.mark.parametrize("shift", [0, 2**62, -(2**62)])
def test_duplicates_keep_the_first_to_arrive(spark, shift):
    long = made(spark, seconds=(8, 8, 8, 8, 8)).withColumn("id", F.col("id") + F.lit(shift))
    rows = by_time(nearest_fill(long, STEP))
    assert list(rows) == [8] and rows[8]["rho_ppb"] == 0.31 and rows[8]["ph_total"] == 8.02
    live = by_time(nearest_align(long, STEP))
    assert live[8]["rho_ppb"] == 0.31 and live[12]["rho_ppb"] == 0.31


@pytest.mark.parametrize("tolerance", [STEP, 3 * STEP])
def test_arrival_numbers_beyond_bigint(spark, tolerance):
    number = lambda c: F.expr(f"CAST({c} AS DECIMAL(19,0)) * 10000000000000000000000BD")
    long = made(spark, seconds=(8, 8, 8, 8, 8))
    far = long.withColumn("id", number("1 - id"))
    assert by_time(nearest_fill(far, STEP))[8]["rho_ppb"] == 0.44
    live = by_time(nearest_align(far, STEP, tolerance_us=tolerance))
    assert live[8]["rho_ppb"] == 0.44 and live[12]["ph_total"] == 8.06
    some = long.withColumn("id", F.when(F.col("id") < 4, number("id")))
    assert by_time(nearest_fill(some, STEP))[8]["rho_ppb"] == 0.31
    last = long.withColumn("id", F.when(F.col("id") > 2, number("id")))
    assert by_time(nearest_align(last, STEP, tolerance_us=tolerance))[8]["rho_ppb"] == 0.9


def test_query_with_far_ids_on_many_events(spark, tmp_path):
    """Events numbered beyond 922,337: ten trillion times that is no bigint any more."""
    at = "timestamp_ntz '2024-01-01 00:00:05'"
    rows = spark.range(2).selectExpr(
        "1000000000 - id AS event_id", f"{at} AS ts", "1L AS user_id", "'click' AS event_type",
        "CAST(id AS double) AS value", "'' AS props",
    )
    rows.write.parquet(f"{tmp_path}/events.parquet")
    got = {r.datetime_utc: r.rho_ppb for r in QUERIES["big_ids"](spark, str(tmp_path)).collect()}
    assert set(got.values()) == {1.0} and len(got) == 2


def test_a_sample_without_arrival_number_comes_last(spark):
    rows = table(spark, [T0, T0, T0], rho_ppb=[5, 6, 7])
    rows = rows.withColumn("id", F.when(F.col("id") > 0, F.col("id") + F.lit(2**62)))
    long = long_frame({"rhodamine": rows})
    assert column(nearest_align(long, STEP), "rho_ppb") == {0: 6, 4: 6}


def test_last_sample_of_a_cell_keeps_the_first_to_arrive(spark):
    long = one_sensor(spark, [T0, T0 + 9, T0 + 9, T0 + 20], [1, 2, 3, 4])
    assert column(nearest_fill(long, micros("10s")), "rho_ppb") == {0: 1, 10: 2, 20: 4}


def test_unsorted_input(spark):
    long = made(spark, seconds=(16, 4, 0, 12, 8))
    assert column(nearest_fill(long, STEP), "rho_ppb") == {0: 0.17, 4: 0.52, 8: 0.44, 12: 0.9, 16: 0.31}


def test_empty_input(spark):
    long = long_frame({s: t.limit(0) for s, t in sensor_tables(spark, SECONDS, **READINGS).items()})
    for rows in (nearest_fill(long, STEP), nearest_align(long, STEP)):
        assert rows.count() == 0 and set(ALIGNED_COLUMNS) <= set(rows.columns)


def test_extra_columns_are_dropped(spark):
    tables = {s: t.withColumn(f"extra_{s}", F.lit(1)) for s, t in
              sensor_tables(spark, SECONDS, **READINGS).items()}
    rows = nearest_align(long_frame(tables), STEP)
    assert set(rows.columns) == {"grid", *ALIGNED_COLUMNS}


def test_tie_goes_to_the_later_sample(spark):
    long = one_sensor(spark, [T0, T0 + 10], [1, 2])
    assert column(nearest_fill(long, micros("5s")), "rho_ppb") == {0: 1, 5: 2, 10: 2}


def test_tolerance_is_inclusive(spark):
    long = one_sensor(spark, [T0, T0 + 10], [1, 2])
    got = column(nearest_align(long, SECOND, tolerance_us=micros("10s")), "rho_ppb")
    assert got[5] == 2 and got[20] == 2 and 21 not in got and min(got) == 0


def test_null_sample_wins_if_nearest(spark):
    long = one_sensor(spark, [T0, T0 + 10], [None, 2])
    assert column(nearest_fill(long, micros("10s")), "rho_ppb") == {0: None, 10: 2}
    # Live rows without any reading are removed.
    assert column(nearest_align(long, micros("10s")), "rho_ppb") == {10: 2, 20: 2}


def test_long_gap_without_tolerance(spark):
    long = one_sensor(spark, [T0 + 3, T0 + 59], [1, 2])
    assert column(nearest_fill(long, micros("10s")), "rho_ppb") == {0: 1, 10: 1, 20: 1, 30: 1, 40: 2, 50: 2}
    limited = column(nearest_fill(long, micros("10s"), tolerance_us=micros("10s")), "rho_ppb")
    assert limited == {0: 1, 10: 1, 20: None, 30: None, 40: None, 50: 2}


@pytest.mark.parametrize("raw_s, step_s, n", [(2, 2, 30), (1, 5, 12), (0.5, 10, 6)])
def test_sampling_rates(spark, raw_s, step_s, n):
    seconds = [T0 + int(i * raw_s) for i in range(int(60 / raw_s))]
    values = list(range(len(seconds)))
    long = long_frame(sensor_tables(spark, seconds, values, values, values, values, values, values))
    batch = by_time(nearest_fill(long, micros(step_s)))
    assert list(batch) == list(range(0, 60, step_s)) and len(batch) == n
    live = by_time(nearest_align(long, micros(step_s)))
    assert list(live) == list(range(0, 60 + step_s, step_s))
    assert {t: live[t] for t in batch} == batch


def test_every_value_survives_at_equal_rate(spark):
    n, primes = 37, {"rho_ppb": 3, "ph_total": 5, "temp": 7, "salinity": 11, "latitude": 13, "longitude": 17}
    own = {name: [p * i * i for i in range(n)] for name, p in primes.items()}
    tables = sensor_tables(spark, [T0 + 4 * i for i in range(n)], *own.values())
    rows = by_time(nearest_align(long_frame(tables), STEP))
    for name, values in own.items():
        assert set(values) <= {r[name] for r in rows.values()}


def random_series(seed, n=400, span=3000, nulls=True):
    r = random.Random(seed)
    seconds = sorted(r.sample(range(span), n)) + [r.randrange(span) for _ in range(20)]
    values = [None if nulls and r.random() < 0.15 else r.random() for _ in seconds]
    return [T0 + s for s in seconds], values


def pandas_series(seconds, values):
    s = pd.Series(values, index=pd.to_datetime(seconds, unit="s"), dtype="float64")
    return s[~s.index.duplicated()].sort_index()


def as_dict(series):
    return {int(t.timestamp()) - T0: None if pd.isna(v) else v for t, v in series.items()}


@pytest.mark.parametrize("step", [2, 7 * 60, 10, 60])
def test_fill_equals_pandas(spark, monkeypatch, step):
    monkeypatch.setattr(trailing, "BLOCK_ROWS", 8)
    monkeypatch.setattr(trailing, "TOP_ROWS", 8)
    seconds, values = random_series(step, n=60 if step == 2 else 400)
    got = column(nearest_fill(one_sensor(spark, seconds, values), step * SECOND), "rho_ppb")
    want = pandas_series(seconds, values)
    grid = pd.date_range(want.index[0].floor(f"{step}s"), want.index[-1], freq=f"{step}s")
    assert got == as_dict(want.reindex(grid, method="nearest"))


@pytest.mark.parametrize("step, tolerance", [(10, 10), (60, 60), (10, 25), (10, 4), (60, 150)])
def test_align_equals_pandas(spark, step, tolerance):
    seconds, values = random_series(step + tolerance)
    long = one_sensor(spark, seconds, values)
    got = column(nearest_align(long, step * SECOND, tolerance * SECOND), "rho_ppb")
    s = pandas_series(seconds, values)
    grid = pd.date_range(s.index[0].floor(f"{step}s"), s.index[-1] + pd.Timedelta(seconds=tolerance), freq=f"{step}s")
    want = s.reindex(grid, method="nearest", tolerance=pd.Timedelta(seconds=tolerance)).dropna()
    assert got == as_dict(want)


def test_sources_have_their_own_gaps(spark):
    tables = {
        "rhodamine": table(spark, [T0, T0 + 100], rho_ppb=[1, 2]),
        "gps": table(spark, [T0 + 40], latitude=[42], longitude=[-70]),
    }
    long = long_frame(tables)
    live = by_time(nearest_align(long, micros("10s")))
    assert list(live) == [0, 10, 30, 40, 50, 90, 100, 110]
    assert live[40]["rho_ppb"] is None and live[40]["latitude"] == 42
    batch = by_time(nearest_fill(long, micros("10s")))
    assert list(batch) == list(range(0, 101, 10))
    assert [t for t, r in batch.items() if r["latitude"] is not None] == [40]


def test_series_do_not_mix(spark):
    seconds = [T0 + 5 * i for i in range(40)]
    rows = table(spark, seconds, rho_ppb=range(40)).withColumn("ship", F.col("id") % 3)
    long = long_frame({"rhodamine": rows}, keys=("ship",))
    whole = nearest_align(long, micros("10s"), keys=("ship",))
    filled = nearest_fill(long, micros("10s"), keys=("ship",))
    for ship in range(3):
        own = long.where(F.col("ship") == ship).drop("ship")
        for df, alone in ((whole, nearest_align(own, micros("10s"))), (filled, nearest_fill(own, micros("10s")))):
            assert column(df.where(F.col("ship") == ship).drop("ship"), "rho_ppb") == column(alone, "rho_ppb")


def test_grid(spark):
    long = one_sensor(spark, [T0 + 3, T0 + 59], [1, 2])
    assert [r for r in by_time(time_grid(long, micros("10s")))] == list(range(0, 61, 10))
    assert [r for r in by_time(time_grid(long, micros("10s"), lookahead=False))] == list(range(0, 51, 10))
    far = one_sensor(spark, [T0, T0 + 20_000], [1, 2])
    assert time_grid(far, SECOND).count() == 20_002


def test_series_without_a_key_are_kept(spark):
    rows = table(spark, [T0 + 5 * i for i in range(30)], rho_ppb=range(30))
    long = long_frame({"rhodamine": rows.withColumn("ship", F.nullif(F.col("id") % 3, F.lit(0)))}, keys=("ship",))
    for rule in (nearest_align, nearest_fill):
        whole = rule(long, micros("10s"), keys=("ship",))
        own = rule(long.where("ship IS NULL").drop("ship"), micros("10s"))
        assert own.count() > 5
        assert column(whole.where("ship IS NULL").drop("ship"), "rho_ppb") == column(own, "rho_ppb")


def test_times_finer_than_the_unit_are_refused(spark):
    long = one_sensor(spark, [T0], [1]).withColumn("us", F.col("us") + 5)
    with pytest.raises(PySparkException, match="finer"):
        nearest_align(long, micros("10s")).collect()
    assert nearest_align(long, micros("10s"), unit_us=1).count() == 2
