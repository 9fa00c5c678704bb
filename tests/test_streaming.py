import pytest
from pyspark.sql import functions as F, types as T

from frames import T0, by_time, generated, upto
from tidemark import Params
from tidemark.functions.rows import conform
from tidemark.plans.incremental import process_incremental
from tidemark.plans.output import output_means
from tidemark.plans.summary import summarize
from tidemark.sinks.files import write_parquet
from tidemark.sources import schemas
from tidemark.sources.tables import long_frame, read_summary
from tidemark.streaming.live import (
    LateRows,
    fresh_checkpoint,
    raw_streams,
    run_for,
    stream_align,
    stream_means,
    stream_settings,
    write_means_stream,
    write_summary_stream,
)


PARAMS = Params(step="10s", ma_window_s=40, ph_freq_hz=0.1, partition_hours=1)


def land(tables, folder):
    for source, table in tables.items():
        conform(table, schemas.RAW[source]).write.mode("append").parquet(f"{folder}/{source}")


def run(spark, folder, path, checkpoint, params=PARAMS, wait_for_all=True, **options):
    stream_settings(spark, wait_for_all)
    rows = stream_align(raw_streams(spark, {s: f"{folder}/{s}" for s in schemas.RAW}), params, **options)
    query = write_summary_stream(rows, path, checkpoint, params, available_now=True)
    run_for(query)
    return query


def item_log(folder):
    """A batch writer that notes how many items it got."""

    def write(batch):
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write(str(len(batch)))

    return write


def summary(spark, path):
    return by_time(read_summary(spark, path).drop("partition"), "datetime_utc")


def close(got, want):
    assert set(got) <= set(want)
    for t in got:
        for name, value in got[t].items():
            assert value == (None if want[t][name] is None else pytest.approx(want[t][name], abs=1e-10)), (t, name)


def test_stream_equals_batch(spark, tmp_path):
    tables = generated(spark, 200)
    raw, path, checkpoint = str(tmp_path / "raw"), str(tmp_path / "s"), str(tmp_path / "c")
    cuts = [0, 45, 100, 200]
    for low, high in zip(cuts, cuts[1:]):
        land(upto(tables, T0 + high - 1, T0 + low - 1), raw)
        run(spark, raw, path, checkpoint, start_s=T0)
    want = by_time(summarize(long_frame(tables), PARAMS), "datetime_utc")
    got = summary(spark, path)
    # All but the rows that newer readings could still change.
    assert list(got) == list(range(0, 181, 10))
    close(got, want)
    # A stream that starts over finds its rows stored.
    files = sorted((tmp_path / "s").rglob("*.parquet"))
    run(spark, raw, path, fresh_checkpoint(spark), start_s=T0)
    assert sorted((tmp_path / "s").rglob("*.parquet")) == files
    # A batch run closes the end.
    landed = {s: spark.read.schema(schemas.RAW[s]).parquet(f"{raw}/{s}") for s in schemas.RAW}
    process_incremental(spark, landed, path, PARAMS, flush=True)
    got = summary(spark, path)
    assert list(got) == list(want)
    close(got, want)


def test_stream_waits_for_a_late_sensor(spark, tmp_path):
    """One sensor is a batch behind the others; no value of it is lost."""
    tables = generated(spark, 200)
    raw, path, checkpoint = str(tmp_path / "raw"), str(tmp_path / "s"), str(tmp_path / "c")
    others = {s: t for s, t in tables.items() if s != "gps"}
    gps = {"gps": tables["gps"]}
    land(upto(others, T0 + 99), raw)
    land(upto(gps, T0 + 29), raw)
    run(spark, raw, path, checkpoint, start_s=T0)
    assert max(summary(spark, path), default=-1) <= 10
    land(upto(others, T0 + 199, T0 + 99), raw)
    land(upto(gps, T0 + 199, T0 + 29), raw)
    run(spark, raw, path, checkpoint, start_s=T0)
    got = summary(spark, path)
    assert list(got) == list(range(0, 181, 10))
    close(got, by_time(summarize(long_frame(tables), PARAMS), "datetime_utc"))


def test_a_silent_sensor_need_not_stop_the_stream(spark, tmp_path):
    tables = generated(spark, 100)
    tables["gps"] = tables["gps"].where(f"datetime_utc < {T0 + 20}")
    raw, path = str(tmp_path / "raw"), str(tmp_path / "s")
    land(tables, raw)
    run(spark, raw, path, str(tmp_path / "c"), start_s=T0, wait_for_all=False)
    got = summary(spark, path)
    assert list(got) == list(range(0, 81, 10))
    assert got[20]["latitude"] is not None and got[50]["latitude"] is None
    close(got, by_time(summarize(long_frame(tables), PARAMS), "datetime_utc"))


def test_lateness_admits_late_readings(spark, tmp_path):
    tables = generated(spark, 200)
    raw, path, checkpoint = str(tmp_path / "raw"), str(tmp_path / "s"), str(tmp_path / "c")
    is_late = "datetime_utc between {} and {}".format(T0 + 60, T0 + 80)
    land({s: t.where(f"datetime_utc < {T0 + 100} and not {is_late}") for s, t in tables.items()}, raw)
    run(spark, raw, path, checkpoint, start_s=T0, lateness_s=60)
    land({s: t.where(f"datetime_utc >= {T0 + 100} or {is_late}") for s, t in tables.items()}, raw)
    run(spark, raw, path, checkpoint, start_s=T0, lateness_s=60)
    got = summary(spark, path)
    assert list(got) == list(range(0, 121, 10))
    close(got, by_time(summarize(long_frame(tables), PARAMS), "datetime_utc"))


def test_readings_that_come_too_late_are_counted(spark, tmp_path):
    tables = generated(spark, 100)
    raw, path, checkpoint = str(tmp_path / "raw"), str(tmp_path / "s"), str(tmp_path / "c")
    is_late = f"datetime_utc between {T0 + 20} and {T0 + 29}"
    listener = LateRows()
    spark.streams.addListener(listener)
    try:
        land({s: t.where(f"not ({is_late})") for s, t in tables.items()}, raw)
        assert listener.total(run(spark, raw, path, checkpoint, start_s=T0)) == 0
        before = summary(spark, path)
        land({s: t.where(is_late) for s, t in tables.items()}, raw)
        # Map tasks reduce readings before the state counts them.
        late = listener.total(run(spark, raw, path, checkpoint, start_s=T0))
        assert late > 0
        # Reports of a third run add to those before.
        land({s: t.where(is_late) for s, t in tables.items()}, raw)
        assert listener.total(run(spark, raw, path, checkpoint, start_s=T0)) == 2 * late
    finally:
        spark.streams.removeListener(listener)
    assert summary(spark, path) == before


def test_a_first_reading_on_the_grid_begins_the_summary(spark, tmp_path):
    """Without a start given: no row before the data, in the first batch or a later one."""
    tables = generated(spark, 100)
    raw, path, checkpoint = str(tmp_path / "raw"), str(tmp_path / "s"), str(tmp_path / "c")
    land(upto(tables, T0 + 49), raw)
    run(spark, raw, path, checkpoint)
    land(upto(tables, T0 + 99, T0 + 49), raw)
    run(spark, raw, path, checkpoint)
    got = summary(spark, path)
    assert list(got) == list(range(0, 81, 10))
    close(got, by_time(summarize(long_frame(tables), PARAMS), "datetime_utc"))


def test_a_stream_has_one_mode(spark, tmp_path):
    raw = str(tmp_path / "raw")
    land(generated(spark, 10), raw)
    streams = raw_streams(spark, {s: f"{raw}/{s}" for s in schemas.RAW})
    with pytest.raises(ValueError):
        stream_align(streams, Params(mode="batch"))


def test_stream_of_two_series_with_items(spark, tmp_path):
    keys = T.StructType([T.StructField("ship", T.StringType())])
    raw_schemas = {s: T.StructType([*keys.fields, *schema.fields]) for s, schema in schemas.RAW.items()}
    ships = {"a": generated(spark, 100, seed=1), "b": generated(spark, 100, seed=2)}
    raw, path, checkpoint = (str(tmp_path / n) for n in ("raw", "s", "c"))
    sent = tmp_path / "items"
    sent.mkdir()
    write = item_log(str(sent))
    stream_settings(spark)
    for low, high in ((-1, 49), (49, 99)):
        for name, tables in ships.items():
            for source, table in upto(tables, T0 + high, T0 + low).items():
                part = table.withColumn("ship", F.lit(name))
                conform(part, raw_schemas[source]).write.mode("append").parquet(f"{raw}/{source}")
        streams = raw_streams(spark, {s: f"{raw}/{s}" for s in schemas.RAW}, raw_schemas=raw_schemas)
        rows = stream_align(streams, PARAMS, keys=["ship"])
        run_for(write_summary_stream(rows, path, checkpoint, PARAMS, keys, write, available_now=True))
    stored = read_summary(spark, path, keys=keys).drop("partition")
    for name, tables in ships.items():
        got = by_time(stored.where(F.col("ship") == name).drop("ship"), "datetime_utc")
        assert list(got) == list(range(0, 81, 10))
        close(got, by_time(summarize(long_frame(tables), PARAMS), "datetime_utc"))
    assert sum(int(f.read_text()) for f in sent.iterdir()) == stored.count() == 18


def test_mean_stream(spark, tmp_path):
    params = Params(step="2s", output_step="60s", partition_hours=1)
    whole = summarize(long_frame(generated(spark, 400)), params)
    path, out, checkpoint = str(tmp_path / "s"), str(tmp_path / "o"), str(tmp_path / "c")
    stream_settings(spark)
    for part in (F.col("datetime_utc") < T0 + 150, F.col("datetime_utc") >= T0 + 150):
        write_parquet(whole.where(part), path, "append", 1)
        run_for(write_means_stream(stream_means(spark, path, params), out, checkpoint, params, available_now=True))
    got = spark.read.parquet(out).drop("partition").orderBy("datetime_utc").collect()
    want = output_means(whole, params).orderBy("datetime_utc").collect()
    # The last bucket is still open.
    assert len(got) == len(want) - 1 == 6
    for g, w in zip(got, want):
        assert g.datetime_utc == w.datetime_utc
        assert g.ph_corrected_ma == pytest.approx(w.ph_corrected_ma, abs=1e-12)


def test_a_query_is_stopped_after_a_time(spark, tmp_path):
    raw = str(tmp_path / "raw")
    land(generated(spark, 50), raw)
    rows = stream_align(raw_streams(spark, {s: f"{raw}/{s}" for s in schemas.RAW}), PARAMS)
    query = write_summary_stream(rows, str(tmp_path / "s"), str(tmp_path / "c"), PARAMS)
    run_for(query, 3)
    assert not query.isActive
