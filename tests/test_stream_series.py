"""Several series in a stream, restarts after errors, and looks into the state."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from frames import T0, by_time, generated, upto
from tidemark import Params
from tidemark.functions.rows import conform
from tidemark.plans.summary import summarize
from tidemark.sinks import snapshots
from tidemark.sources import schemas
from tidemark.sources.tables import long_frame, read_summary
from tidemark.streaming.inspect import batches, late_readings, operators, waiting_rows, watermark
from tidemark.streaming.live import raw_streams, run_for, stream_align, stream_settings, write_summary_stream
from tidemark.streaming.restart import GivenUp, run_with_restarts
from tidemark.streaming import series
from tidemark.streaming.series import FIRST, TrailingMeans, window_means

KEYS = T.StructType([T.StructField("ship", T.StringType())])
PARAMS = Params(step="10s", ma_window_s=120, ph_freq_hz=0.05, partition_hours=1)
KEYED = {s: T.StructType([*schemas.RAW[s].fields, *KEYS.fields]) for s in schemas.RAW}


def land(tables, folder, kinds=schemas.RAW):
    for source, table in tables.items():
        conform(table, kinds[source]).coalesce(1).write.mode("append").parquet(f"{folder}/{source}")


def start(spark, folder, path, checkpoint, keyed=True, **options):
    stream_settings(spark)
    kinds = KEYED if keyed else schemas.RAW
    folders = {s: f"{folder}/{s}" for s in schemas.RAW}
    rows = stream_align(raw_streams(spark, folders, raw_schemas=kinds), PARAMS, keys=("ship",) if keyed else ())
    return write_summary_stream(
        rows, path, checkpoint, PARAMS, keys=KEYS if keyed else None, available_now=True, **options
    )


def assert_part_of(got, want):
    assert got and set(got) <= set(want)
    for t, row in got.items():
        for name, value in row.items():
            assert value == (None if want[t][name] is None else pytest.approx(want[t][name], abs=1e-10)), (t, name)


def test_window_means_against_plain():
    r = np.random.default_rng(2)
    for n in (1, 2, 5, 40):
        before, values = r.random(r.integers(0, n)), r.random(60)
        values[r.random(60) < 0.3] = np.nan
        whole = np.concatenate([before, values])
        for i, mean in enumerate(window_means(before, values, n)):
            own = whole[max(0, len(before) + i - n + 1) : len(before) + i + 1]
            own = own[~np.isnan(own)]
            assert (np.isnan(mean) and not len(own)) or mean == pytest.approx(own.mean())
    spiked = window_means(np.array([]), np.array([1.0, 1e17, 1.0, 1.0, 1.0]), 2)
    assert spiked[3:].tolist() == [1.0, 1.0]


class Entries(dict):
    """The map of a group's state, counting what is asked of it."""

    asked = 0

    def getValue(self, key):
        self.asked += 1
        return self.get(key)

    def updateValue(self, key, value):
        self.asked += 1
        self[key] = value


@pytest.mark.parametrize("ph_rows_only", [True, False])
def test_a_call_takes_many_series(ph_rows_only):
    """Two micro-batches, each one call; series of which the second has no rows are not visited."""
    r, n, step = np.random.default_rng(4), 5, 10
    processor = TrailingMeans(["ship", "grid", "ph_total_ma", "ph_corrected_ma"], n, step, ph_rows_only, None)
    processor.state = Entries()
    ph = {(ship, g): r.random() if r.random() < 0.7 else np.nan for ship in range(40) for g in range(0, 400, step)}
    got, visits = {}, []
    for low, high, ships in ((0, 190, 40), (190, 400, 13)):
        rows = [(f"k{ship}", str(ship), g, max(g, 23), v, v + 1) for (ship, g), v in ph.items() if low <= g < high and ship < ships]
        frame = pd.DataFrame(rows, columns=["series_key", "ship", "grid", FIRST, "ph_total", "ph_corrected"])
        frame = frame.sample(frac=1, random_state=1)
        parts = [frame[:50], frame[50:51], frame[51:]]
        before = processor.state.asked
        for out in processor.handleInputRows((0,), iter(parts), None):
            got |= {(int(x.ship), x.grid): (x.ph_total_ma, x.ph_corrected_ma) for x in out.itertuples()}
        visits.append(processor.state.asked - before)
    assert visits == [80, 26]
    want = [(s, g) for s, g in ph if g >= 20 and (g < 190 or s < 13)]
    assert sorted(got) == sorted(want)
    for ship, at in want:
        own = [v for (s, g), v in ph.items() if s == ship and 20 <= g <= at and not (ph_rows_only and np.isnan(v))][-n:]
        own = [v for v in own if not np.isnan(v)]
        mean = np.mean(own) if own and not (ph_rows_only and np.isnan(ph[ship, at])) else np.nan
        assert got[ship, at] == pytest.approx((mean, mean + 1), nan_ok=True)


def test_series_that_share_a_group(spark, tmp_path, monkeypatch):
    """Whole numbers as keys keep all their digits beside a missing one."""
    monkeypatch.setattr(series, "GROUPS", 1)
    ships = [2**53 + 1, 2**53, None, 7]
    key = T.StructType([T.StructField("ship", T.LongType())])
    kinds = {s: T.StructType([*schemas.RAW[s].fields, *key.fields]) for s in schemas.RAW}
    raw, path, checkpoint = str(tmp_path / "raw"), str(tmp_path / "s"), str(tmp_path / "c")
    own = {ship: generated(spark, 120, seed=i) for i, ship in enumerate(ships)}
    stream_settings(spark)
    for low, high in ((0, 60), (60, 120)):
        for ship, tables in own.items():
            part = upto(tables, T0 + high - 1, T0 + low - 1)
            land({s: t.withColumn("ship", F.lit(ship).cast("bigint")) for s, t in part.items()}, raw, kinds)
        streams = raw_streams(spark, {s: f"{raw}/{s}" for s in schemas.RAW}, raw_schemas=kinds)
        rows = stream_align(streams, PARAMS, keys=("ship",))
        run_for(write_summary_stream(rows, path, checkpoint, PARAMS, keys=key, available_now=True))
    rows = read_summary(spark, path, keys=key).drop("partition")
    for ship, tables in own.items():
        got = by_time(rows.where(F.col("ship").eqNullSafe(F.lit(ship).cast("bigint"))).drop("ship"), "datetime_utc")
        assert_part_of(got, by_time(summarize(long_frame(tables), PARAMS), "datetime_utc"))
        assert list(got) == list(range(0, 101, 10))


def test_series_in_a_stream_equal_batch(spark, tmp_path):
    """Averages that reach over micro-batches, a missing key, a series that begins later. After
    the first micro-batch the stored rows can be lost: nobody reads them."""
    raw, path, checkpoint = str(tmp_path / "raw"), str(tmp_path / "s"), str(tmp_path / "c")
    own = {"a": generated(spark, 250, seed=1), None: generated(spark, 250, seed=2), "b": generated(spark, 250, seed=3)}
    own["b"] = {s: t.where(f"datetime_utc >= {T0 + 95}") for s, t in own["b"].items()}
    cuts = [0, 60, 130, 250]
    stored = {}
    for low, high in zip(cuts, cuts[1:]):
        for ship, tables in own.items():
            part = upto(tables, T0 + high - 1, T0 + low - 1)
            land({s: t.withColumn("ship", F.lit(ship).cast("string")) for s, t in part.items()}, raw, KEYED)
        run_for(start(spark, raw, path, checkpoint))
        now = snapshots.load(spark, path)
        fresh = set(now.files) - set(stored)
        rows = snapshots.read(spark, now, schemas.summary(KEYS), files=fresh).drop("partition").collect()
        for name in fresh:
            stored[name] = 1
            (tmp_path / "s" / name).write_bytes(b"")
        stored.setdefault("rows", []).extend(rows)
    rows = spark.createDataFrame(stored["rows"], schemas.summary(KEYS))
    for ship, tables in own.items():
        got = by_time(rows.where(F.col("ship").eqNullSafe(F.lit(ship).cast("string"))).drop("ship"), "datetime_utc")
        want = by_time(summarize(long_frame(tables), PARAMS), "datetime_utc")
        assert_part_of(got, want)
        assert list(got) == [t for t in want if t <= 230]


def flaky(wrong):
    """A sink that fails at its calls of these numbers (from 1)."""
    calls = []

    def sink(rows, number):
        calls.append((number, rows.count()))
        if len(calls) in wrong:
            raise RuntimeError(f"call {len(calls)} refused")

    return sink, calls


def test_a_stream_goes_on_after_errors(spark, tmp_path):
    raw, path, checkpoint = str(tmp_path / "raw"), str(tmp_path / "s"), str(tmp_path / "c")
    tables = generated(spark, 200)
    sink, calls = flaky({1, 2, 4})
    waits, told = [], []
    land(upto(tables, T0 + 100), raw)
    go = lambda: start(spark, raw, path, checkpoint, keyed=False, also=sink)
    failures = run_with_restarts(go, wait_s=1, sleep=waits.append, report=told.append)
    assert [(f.attempt, f.waited_s) for f in failures] == [(1, 1.0), (2, 2.0)] and failures == told
    assert "call 2 refused" in failures[1].error and waits == [1.0, 2.0]
    land(upto(tables, T0 + 200, T0 + 100), raw)
    later = run_with_restarts(go, wait_s=1, sleep=waits.append)
    assert [(f.attempt, f.waited_s) for f in later] == [(1, 1.0)] and later[0].batch > failures[0].batch
    # The sink gets the rows of a micro-batch again, the table does not.
    assert calls[0] == calls[1] == calls[2]
    got = by_time(read_summary(spark, path).drop("partition"), "datetime_utc")
    assert list(got) == list(range(0, 181, 10))
    assert_part_of(got, by_time(summarize(long_frame(tables), PARAMS), "datetime_utc"))


def test_an_error_that_stays_is_given_up(spark, tmp_path):
    raw, path, checkpoint = str(tmp_path / "raw"), str(tmp_path / "s"), str(tmp_path / "c")
    land(generated(spark, 100), raw)
    sink, calls = flaky(set(range(100)))
    with pytest.raises(GivenUp) as error:
        run_with_restarts(
            lambda: start(spark, raw, path, checkpoint, keyed=False, also=sink), attempts=3, sleep=lambda s: None
        )
    assert [f.attempt for f in error.value.failures] == [1, 2, 3] and len(calls) == 3
    assert "call 3 refused" in str(error.value)


def test_what_waits_and_what_came_too_late(spark, tmp_path):
    raw, path, checkpoint = str(tmp_path / "raw"), str(tmp_path / "s"), str(tmp_path / "c")
    tables = generated(spark, 200)
    tables["gps"] = upto({"gps": tables["gps"]}, T0 + 150)["gps"]
    label = lambda part: {s: t.withColumn("ship", F.lit("a")) for s, t in part.items()}
    late = F.col("datetime_utc").between(T0 + 20, T0 + 44)
    land(label({s: t.where(~late) for s, t in tables.items()}), raw, KEYED)
    run_for(start(spark, raw, path, checkpoint))
    assert watermark(spark, checkpoint) == T0 + 140  # of the slowest: its last grid point less two steps
    (row,) = waiting_rows(spark, checkpoint, KEYS, operator=_aggregation(spark, checkpoint)).collect()
    assert row.asDict() == {
        "ship": "a", "n_rows": 6, "first_s": T0 + 150, "last_s": T0 + 200,
        "gps_s": T0 + 160, "rhodamine_s": T0 + 200, "tsg_s": T0 + 200, "ph_s": T0 + 200,
    }
    land(label({s: t.where(late) for s, t in tables.items()}), raw, KEYED)
    land(label(upto({"ph": tables["ph"]}, T0 + 300)), raw, KEYED)  # read again: of these the first 139 s are late
    run_for(start(spark, raw, path, checkpoint))
    landed = {s: spark.read.schema(KEYED[s]).parquet(f"{raw}/{s}") for s in schemas.RAW}
    got = {r.source: (r.n_rows, r.n_late) for r in late_readings(spark, checkpoint, landed, PARAMS).collect()}
    n_ph, late_ph = 100 + 100, 13 + 70
    assert got == {"rhodamine": (200, 25), "ph": (n_ph, late_ph), "tsg": (200, 25), "gps": (151, 25)}
    assert all(b["committed"] for b in batches(spark, checkpoint))
    names = {r.operatorName for r in operators(spark, checkpoint).collect()}
    assert "stateStoreSave" in names and len(names) == 2


def _aggregation(spark, checkpoint):
    return next(r.operatorId for r in operators(spark, checkpoint).collect() if r.operatorName == "stateStoreSave")
