import math
import random

import pytest
from pyspark.sql import types as T

from frames import T0, by_time, generated, sensor_tables, upto
from tidemark import Params
from tidemark.operators import trailing
from tidemark.plans.incremental import process_incremental, recent_summary, summary_mark
from tidemark.plans.output import output_means, resample_summary
from tidemark.plans.summary import summarize
from tidemark.sinks import snapshots
from tidemark.sources.tables import file_name, long_frame, read_summary


WAVES = Params(step="3s", ma_window_s=45, ph_freq_hz=0.2, k0=0.4, k2=0.002)


def waves(spark, n=84):
    """Smooth curves of different lengths, a reading every three seconds."""
    wave = lambda middle, width, period: [middle + width * math.sin(i / period) for i in range(n)]
    return sensor_tables(
        spark,
        [T0 + 3 * i for i in range(n)],
        wave(0.4, 0.3, 2.3),
        wave(8.0, 0.2, 5.1),
        wave(9.5, 1.5, 7.7),
        wave(31.0, 0.8, 3.9),
        wave(54.3, 0.2, 11.0),
        wave(7.6, 0.4, 13.0),
        wave(0.25, 0.05, 4.4),
    )


def one_shot(tables, params):
    return by_time(summarize(long_frame(tables), params), "datetime_utc")


def in_runs(spark, tables, params, path, cuts):
    for cut in cuts:
        process_incremental(spark, upto(tables, cut), path, params)
    process_incremental(spark, tables, path, params, flush=True)
    return by_time(read_summary(spark, path).drop("partition"), "datetime_utc")


def assert_same(got, want):
    assert list(got) == list(want)
    for t in want:
        for name, value in want[t].items():
            if value is None:
                assert got[t][name] is None, (t, name)
            else:
                assert got[t][name] == pytest.approx(value, abs=1e-10), (t, name)


@pytest.mark.parametrize("mode", ["live", "batch"])
def test_uneven_runs_equal_one_shot(spark, tmp_path, mode):
    params = Params(**{**WAVES.__dict__, "mode": mode})
    tables = waves(spark)
    want = one_shot(tables, params)
    assert len(want) == (85 if mode == "live" else 84)
    assert all(r["ph_total_ma"] is not None for t, r in want.items())
    cuts = [T0 + 3 * i - 1 for i in (11, 12, 47, 70)]
    assert_same(in_runs(spark, tables, params, str(tmp_path / "s"), cuts), want)


@pytest.mark.parametrize("mode", ["live", "batch"])
@pytest.mark.parametrize("cuts", [(60,), (13, 14, 60, 61, 110)])
def test_any_split_equals_one_shot(spark, tmp_path, mode, cuts):
    """Noise, gaps in single sensors, duplicates; small blocks and window across runs."""
    params = Params(step="10s", ma_window_s=120, ph_freq_hz=0.05, mode=mode)
    tables = generated(spark, 120)
    r = random.Random(len(cuts))
    holes = {"ph": (31, 64), "gps": (70, 95)}
    for source, (a, b) in holes.items():
        tables[source] = tables[source].where(f"datetime_utc not between {T0 + a} and {T0 + b}")
    again = tables["tsg"].where("id % 7 = 0").selectExpr("id + 1000 as id", "datetime_utc", "temp + 1 as temp", "salinity")
    tables["tsg"] = tables["tsg"].unionByName(again)
    del r
    want = one_shot(tables, params)
    got = in_runs(spark, tables, params, str(tmp_path / "s"), [T0 + c for c in cuts])
    assert_same(got, want)


def test_short_window_needs_no_history(spark, tmp_path):
    params = Params(step="10s", ma_window_s=1, ph_freq_hz=0.5)
    tables = generated(spark, 60)
    assert_same(in_runs(spark, tables, params, str(tmp_path / "s"), [T0 + 30]), one_shot(tables, params))


def test_window_longer_than_every_run(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(trailing, "BLOCK_ROWS", 1)
    params = Params(step="10s", ma_window_s=120, ph_freq_hz=0.5)
    tables = generated(spark, 300)
    want = one_shot(tables, params)
    got = in_runs(spark, tables, params, str(tmp_path / "s"), [T0 + 60 * i for i in range(1, 5)])
    assert_same(got, want)


def test_nothing_new_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "s")
    tables = waves(spark, 10)
    process_incremental(spark, tables, path, WAVES, flush=True)
    before = by_time(read_summary(spark, path).drop("partition"), "datetime_utc")
    for flush in (False, True):
        assert process_incremental(spark, tables, path, WAVES, flush=flush).count() == 0
    empty = {s: t.limit(0) for s, t in tables.items()}
    assert process_incremental(spark, empty, path, WAVES, flush=True).count() == 0
    assert by_time(read_summary(spark, path).drop("partition"), "datetime_utc") == before


def test_empty_store_and_no_data(spark, tmp_path):
    path = str(tmp_path / "s")
    assert summary_mark(spark, path) is None
    empty = {s: t.limit(0) for s, t in waves(spark, 2).items()}
    assert process_incremental(spark, empty, path, WAVES).count() == 0
    assert summary_mark(spark, path) is None


def test_added_rows_are_returned(spark, tmp_path):
    path = str(tmp_path / "s")
    tables = waves(spark, 31)
    first = by_time(process_incremental(spark, upto(tables, T0 + 42), path, WAVES), "datetime_utc")
    # The row at 42 s may still be changed by readings up to 45 s.
    assert list(first) == list(range(0, 40, 3))
    second = by_time(process_incremental(spark, tables, path, WAVES, flush=True), "datetime_utc")
    assert list(second) == list(range(42, 94, 3))
    assert summary_mark(spark, path) == T0 + 93


def test_a_slow_sensor_holds_rows_back(spark, tmp_path):
    path = str(tmp_path / "s")
    tables = generated(spark, 120)
    params = Params(step="10s", ma_window_s=60)
    slow = {**upto(tables, T0 + 100), "gps": tables["gps"].where(f"datetime_utc <= {T0 + 40}")}
    rows = by_time(process_incremental(spark, slow, path, params), "datetime_utc")
    assert max(rows) == 30
    process_incremental(spark, tables, path, params, flush=True)
    assert_same(by_time(read_summary(spark, path).drop("partition"), "datetime_utc"), one_shot(tables, params))


def test_rows_can_be_told_not_to_wait(spark, tmp_path):
    tables = generated(spark, 120)
    tables["gps"] = tables["gps"].limit(0)
    params = Params(step="10s")
    assert process_incremental(spark, tables, str(tmp_path / "a"), params).count() == 0
    awaited = ["rhodamine", "ph", "tsg"]
    assert process_incremental(spark, tables, str(tmp_path / "b"), params, sensors=awaited).count() == 11


def test_rebuild_replaces(spark, tmp_path):
    path = str(tmp_path / "s")
    tables = generated(spark, 120)
    process_incremental(spark, upto(tables, T0 + 60), path, Params(step="2s"), flush=True)
    rows = process_incremental(spark, tables, path, Params(step="10s"), rebuild=True)
    assert_same(by_time(rows, "datetime_utc"), one_shot(tables, Params(step="10s")))


def test_two_series(spark, tmp_path):
    from pyspark.sql import functions as F

    keys = T.StructType([T.StructField("ship", T.StringType())])
    params = Params(step="10s", ma_window_s=60)
    a, b = generated(spark, 120, seed=1), generated(spark, 120, seed=2)
    label = lambda t, s: t.withColumn("ship", F.lit(s))
    tables = {s: label(a[s], "a").unionByName(label(b[s], "b")) for s in a}
    path = str(tmp_path / "s")
    process_incremental(spark, upto(tables, T0 + 55), path, params, keys=keys)
    process_incremental(spark, tables, path, params, keys=keys, flush=True)
    stored = read_summary(spark, path, keys=keys).drop("partition")
    for name, own in (("a", a), ("b", b)):
        got = by_time(stored.where(F.col("ship") == name).drop("ship"), "datetime_utc")
        assert_same(got, one_shot(own, params))


def test_history_search_widens(spark, tmp_path):
    """The rows looked back on lie before a long outage."""
    path = str(tmp_path / "s")
    params = Params(step="10s", ma_window_s=8, ph_freq_hz=0.5)
    tables = generated(spark, 100)
    process_incremental(spark, tables, path, params, flush=True)
    rows = recent_summary(spark, path, T0 + 400_000_000, 3, params)
    assert sorted(r.grid // 1_000_000 - T0 for r in rows.collect()) == [80, 90, 100]


def test_mean_output_in_runs(spark, tmp_path):
    params = Params(step="2s", output_step="60s", partition_hours=1)
    tables = generated(spark, 400)
    summary, out, csv = (str(tmp_path / n) for n in ("s", "out", "csv"))
    for cut in (100, 130, 290):
        process_incremental(spark, upto(tables, T0 + cut), summary, params)
        resample_summary(spark, summary, out, params, csv_path=csv)
    assert resample_summary(spark, summary, out, params) is None
    process_incremental(spark, tables, summary, params, flush=True)
    resample_summary(spark, summary, out, params, csv_path=csv, flush=True)
    want = output_means(read_summary(spark, summary), params).orderBy("datetime_utc").collect()
    got = spark.read.parquet(out).drop("partition").orderBy("datetime_utc").collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want] and len(got) == 7
    assert spark.read.option("header", True).csv(csv).count() == 7


def test_a_failing_item_writer_does_not_stop_the_output(spark, tmp_path):
    params = Params(step="2s", output_step="60s")
    summary, out = str(tmp_path / "s"), str(tmp_path / "out")
    process_incremental(spark, generated(spark, 200), summary, params, flush=True)

    def refuse(batch):
        raise RuntimeError("refused")

    assert resample_summary(spark, summary, out, params, write_batch=refuse, flush=True).count() == 4


def test_no_summary_no_output(spark, tmp_path):
    assert resample_summary(spark, str(tmp_path / "s"), str(tmp_path / "o"), Params()) is None


def test_raw_tables_partitioned_by_time(spark, tmp_path):
    from tidemark.sinks.files import write_parquet
    from tidemark.sources.schemas import RAW, partitioned
    from tidemark.functions.rows import conform

    params = Params(step="10s", ma_window_s=60, mode="batch", raw_partition_hours=1, partition_hours=1)
    made = generated(spark, 8000)
    for source, table in made.items():
        write_parquet(conform(table, RAW[source]), str(tmp_path / source), "append", 1)
    tables = {s: spark.read.schema(partitioned(RAW[s])).parquet(str(tmp_path / s)) for s in made}
    path = str(tmp_path / "s")
    process_incremental(spark, upto(tables, T0 + 7300), path, params)
    process_incremental(spark, tables, path, params, flush=True)
    assert_same(by_time(read_summary(spark, path).drop("partition"), "datetime_utc"), one_shot(made, params))


def test_series_that_pause(spark, tmp_path):
    """A series without readings for a while is still filled from its last one."""
    from pyspark.sql import functions as F

    keys = T.StructType([T.StructField("ship", T.StringType())])
    params = Params(step="10s", ma_window_s=60, mode="batch")
    a, b = generated(spark, 2000, seed=1), generated(spark, 2000, seed=2)
    pause = f"datetime_utc < {T0 + 100} or datetime_utc > {T0 + 1900}"
    b = {s: t.where(pause) for s, t in b.items()}
    label = lambda t, s: t.withColumn("ship", F.lit(s))
    tables = {s: label(a[s], "a").unionByName(label(b[s], "b")) for s in a}
    path = str(tmp_path / "s")
    process_incremental(spark, upto(tables, T0 + 95), path, params, keys=keys)
    process_incremental(spark, upto(tables, T0 + 1950), path, params, keys=keys)
    process_incremental(spark, tables, path, params, keys=keys, flush=True)
    stored = read_summary(spark, path, keys=keys).drop("partition")
    for name, own in (("a", a), ("b", b)):
        got = by_time(stored.where(F.col("ship") == name).drop("ship"), "datetime_utc")
        assert_same(got, one_shot(own, params))


STEPS = ["before the files", "between two files", "after the files", "after the commit"]


@pytest.mark.parametrize(
    "mode, series, step",
    [("live", False, STEPS[0]), ("live", True, STEPS[1]), ("batch", True, STEPS[2]), ("live", True, STEPS[3])],
)
def test_a_run_that_is_lost_changes_nothing(spark, tmp_path, monkeypatch, mode, series, step):
    """The driver goes at each step of the second run; readers see the first run's rows, or
    after the commit those of both, and the next run goes on from there."""
    from pyspark.sql import functions as F

    params = Params(step="10s", ma_window_s=60, mode=mode, partition_hours=1)
    tables, keys = generated(spark, 1500, ph_every=10), None
    if series:
        keys = T.StructType([T.StructField("ship", T.StringType())])
        tables = {s: t.withColumn("ship", F.lit("a")) for s, t in tables.items()}
    path = str(tmp_path / "s")
    run = lambda part, **more: process_incremental(spark, part, path, params, keys=keys, **more)
    read = lambda: by_time(read_summary(spark, path, keys=keys).drop("partition", "ship"), "datetime_utc")
    run(upto(tables, T0 + 400))
    first = read()
    write, commit = snapshots.write_files, snapshots.commit

    def lost(*_, **__):
        raise RuntimeError("the driver was lost")

    def part_written(df, *args, **more):
        write(df.where(F.col("datetime_utc") % 600 >= 300), *args, **more)
        lost()

    def after(*args, **more):
        commit(*args, **more)
        lost()

    with monkeypatch.context() as m:
        if step == STEPS[3]:
            m.setattr(snapshots, "commit", after)
        elif step == STEPS[2]:
            m.setattr(snapshots, "commit", lost)
        else:
            m.setattr(snapshots, "write_files", lost if step == STEPS[0] else part_written)
        with pytest.raises(RuntimeError):
            run(upto(tables, T0 + 1200))
        seen = read()
        if step == STEPS[3]:
            assert list(seen)[: len(first)] == list(first) and max(seen) > 1150
        else:
            assert seen == first
    run(tables)
    run(tables, flush=True)
    plain = {s: t.drop("ship") for s, t in tables.items()}
    assert_same(read(), one_shot(plain, params))
    # What the lost runs left was removed: the folders hold the rows of the snapshot.
    assert spark.read.parquet(path).count() == len(read())


def test_only_files_with_news_are_read(spark, tmp_path, monkeypatch):
    """Ship b's files come after a's, of the same time; a third run has nothing to read."""
    from pyspark.sql import functions as F

    from tidemark.functions.rows import conform
    from tidemark.plans.series import RawFiles
    from tidemark.sources.schemas import RAW

    keys = T.StructType([T.StructField("ship", T.StringType())])
    schema = lambda s: T.StructType([*RAW[s].fields, *keys.fields])
    params = Params(step="10s", ma_window_s=60, partition_hours=1)
    raw, path = str(tmp_path / "raw"), str(tmp_path / "s")
    own = {"a": generated(spark, 300, seed=1), "b": generated(spark, 290, seed=2)}

    def land(ship, low, high):
        for s, t in upto(own[ship], T0 + high, T0 + low).items():
            rows = conform(t.withColumn("ship", F.lit(ship)), schema(s))
            rows.coalesce(1).write.mode("append").parquet(f"{raw}/{s}")

    opened = []
    of = RawFiles.of

    def spied(self, files):
        opened.append({s: set(own) for s, own in files.items() if own})
        return of(self, files)

    monkeypatch.setattr(RawFiles, "of", spied)

    def run(**more):
        opened.clear()
        tables = {s: spark.read.schema(schema(s)).parquet(f"{raw}/{s}") for s in RAW}
        rows = process_incremental(spark, tables, path, params, keys=keys, by_file=True, **more)
        return {s: set(map(file_name, t.inputFiles())) for s, t in tables.items()}, rows

    land("a", -1, 149)
    first, _ = run()
    assert opened == [first, first]
    land("b", -1, 149)
    both, rows = run()
    news = {s: both[s] - first[s] for s in both}
    assert opened == [news, news] and {r.ship for r in rows.collect()} == {"b"}
    assert run()[1].count() == 0 and not any(opened)
    land("a", 149, 300)
    more, rows = run()
    # a's new files, and its first ones, whose readings are in reach of the next row.
    assert opened[1] == {s: more[s] - news[s] for s in more} and {r.ship for r in rows.collect()} == {"a"}
    land("b", 149, 300)
    run(flush=True)
    stored = read_summary(spark, path, keys=keys).drop("partition")
    for name, tables in own.items():
        assert_same(by_time(stored.where(F.col("ship") == name).drop("ship"), "datetime_utc"), one_shot(tables, params))


def test_a_file_is_not_opened_for_its_metadata_filter(spark, tmp_path):
    """The filter on file names reaches the listing: other files count as not read."""
    from pyspark.sql import functions as F

    spark.range(100).repartition(5).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).withColumn("x", F.col("id") + 1)
    one = df.where(F.col("_metadata.file_path").isin(file_name(df.inputFiles()[0])))
    assert 0 < one.count() < 100
    rows = one.select("x")
    rows.collect()
    scan = rows._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 1


def test_series_do_not_read_the_summary(spark, tmp_path, monkeypatch):
    """After the first run marks and the rows looked back on come from the state."""
    from pyspark.sql import functions as F

    keys = T.StructType([T.StructField("ship", T.StringType())])
    params = Params(step="10s", ma_window_s=120, ph_freq_hz=0.05)
    tables = {s: t.withColumn("ship", F.lit("a")) for s, t in generated(spark, 400).items()}
    path = str(tmp_path / "s")
    process_incremental(spark, upto(tables, T0 + 150), path, params, keys=keys)
    for name in list(snapshots.load(spark, path).files):
        (tmp_path / "s" / name).write_bytes(b"")  # whoever reads it fails
    rows = process_incremental(spark, tables, path, params, keys=keys, flush=True)
    want = one_shot({s: t.drop("ship") for s, t in tables.items()}, params)
    got = by_time(rows.drop("ship"), "datetime_utc")
    assert list(got) == [t for t in want if t > 140]
    assert_same(got, {t: want[t] for t in got})


@pytest.mark.parametrize("mode", ["live", "batch"])
def test_a_series_that_arrives_late_loses_nothing(spark, tmp_path, mode):
    """Ship b covers the time of ship a, but its readings arrive after the first run."""
    from pyspark.sql import functions as F

    keys = T.StructType([T.StructField("ship", T.StringType())])
    params = Params(step="10s", ma_window_s=60, mode=mode)
    own = {"a": generated(spark, 200, seed=1), "b": generated(spark, 190, seed=2), None: generated(spark, 170, seed=3)}
    label = lambda tables, s: {k: t.withColumn("ship", F.lit(s).cast("string")) for k, t in tables.items()}
    made = {s: label(t, s) for s, t in own.items()}
    both = {k: made["a"][k].unionByName(made["b"][k]).unionByName(made[None][k]) for k in made["a"]}
    path = str(tmp_path / "s")
    process_incremental(spark, made["a"], path, params, keys=keys)
    process_incremental(spark, upto(both, T0 + 100), path, params, keys=keys)
    process_incremental(spark, both, path, params, keys=keys, flush=True)
    stored = read_summary(spark, path, keys=keys).drop("partition")
    for ship, tables in own.items():
        rows = stored.where(F.col("ship").eqNullSafe(F.lit(ship).cast("string"))).drop("ship")
        assert_same(by_time(rows, "datetime_utc"), one_shot(tables, params))


def test_a_run_reads_its_mark_from_the_snapshot(spark, tmp_path):
    path = str(tmp_path / "s")
    process_incremental(spark, waves(spark, 31), path, WAVES, flush=True)
    assert snapshots.load(spark, path).facts["mark_s"] == summary_mark(spark, path) == T0 + 93
    assert read_summary(spark, path, T0 + 80, partition_hours=6).count() == 5


def test_means_per_series(spark, tmp_path):
    from pyspark.sql import functions as F

    keys = T.StructType([T.StructField("ship", T.StringType())])
    params = Params(step="2s", output_step="60s", partition_hours=1)
    rows = {s: summarize(long_frame(generated(spark, 250, seed=i)), params) for i, s in enumerate("ab")}
    label = lambda s: rows[s].withColumn("ship", F.lit(s)).select("ship", *rows[s].columns)
    summary, out = str(tmp_path / "s"), str(tmp_path / "out")
    from tidemark.sinks.files import write_parquet

    write_parquet(label("a"), summary, "append", 1)
    assert resample_summary(spark, summary, out, params, keys=keys).count() == 4
    write_parquet(label("b"), summary, "append", 1)
    resample_summary(spark, summary, out, params, keys=keys)
    resample_summary(spark, summary, out, params, keys=keys, flush=True)
    got = spark.read.parquet(out).drop("partition")
    for s in "ab":
        want = output_means(rows[s], params).orderBy("datetime_utc").collect()
        own = got.where(F.col("ship") == s).drop("ship").orderBy("datetime_utc").collect()
        assert [r.datetime_utc for r in own] == [r.datetime_utc for r in want]
        for g, w in zip(own, want):
            assert list(g)[1:] == [None if v is None else pytest.approx(v, abs=1e-9) for v in list(w)[1:]]


def test_rows_that_a_sink_missed_are_sent_again(spark, tmp_path):
    params = Params(step="2s", output_step="60s")
    summary, out, sent = str(tmp_path / "s"), str(tmp_path / "out"), tmp_path / "sent"
    sent.mkdir()
    tables, folder = generated(spark, 400), str(sent)
    process_incremental(spark, upto(tables, T0 + 200), summary, params)

    def refuse(batch):
        raise RuntimeError("refused")

    def write(batch):
        for item in batch:
            open(f"{folder}/{item['datetime_utc'].replace(':', '')}", "w").close()

    assert resample_summary(spark, summary, out, params, write_batch=refuse).count() == 3
    process_incremental(spark, tables, summary, params, flush=True)
    resample_summary(spark, summary, out, params, write_batch=write)
    assert len(list(sent.iterdir())) == spark.read.parquet(out).count() == 6
    before = len(list(sent.iterdir()))
    assert resample_summary(spark, summary, out, params, write_batch=refuse) is None
    assert len(list(sent.iterdir())) == before


def test_a_new_step_goes_on_at_its_next_grid_point(spark, tmp_path):
    tables = generated(spark, 120)
    path = str(tmp_path / "s")
    process_incremental(spark, upto(tables, T0 + 14), path, Params(step="2s"))
    rows = process_incremental(spark, tables, path, Params(step="10s"), flush=True)
    assert list(by_time(rows, "datetime_utc")) == list(range(20, 121, 10))
