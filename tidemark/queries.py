"""Every operator as a query over the given tables.

Each query takes (spark, sf_dir) and reads whole tables. ``datetime_utc`` is in
epoch seconds and doubles are rounded, as the SQL in ``oracles`` does.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.ph import corrected_ph
from tidemark.functions.rows import conform, drop_empty, iso_times, nan_to_null, to_items
from tidemark.functions.time import coerce_time, epoch_seconds, floor_to, iso_z_from_seconds, partition_name
from tidemark.operators import lookup, quality
from tidemark.operators.aggregate import (
    drop_repeats,
    duplicate_examples,
    first_arrival,
    freshness,
    high_water_mark,
    mean_resample,
    not_in,
)
from tidemark.operators.nearest import extent, nearest_align, nearest_fill, time_grid
from tidemark.operators.trailing import rolling_mean_time
from tidemark.params import ALIGNED_COLUMNS, HOUR, SECOND, Params
from tidemark.plans.checks import RANK_ERROR, check_news
from tidemark.plans.incremental import process_incremental, state_summary
from tidemark.plans.output import output_means, resample_summary
from tidemark.plans.summary import add_corrected_ph, add_moving_averages, align, summarize
from tidemark.session import prepare, scratch
from tidemark.sinks import snapshots
from tidemark.sinks.buckets import append_once_bucketed, create_buckets
from tidemark.sinks.files import append_once, append_table, commit_rows, write_csv, write_parquet
from tidemark.sinks.items import current_items, put_items
from tidemark.sources import schemas
from tidemark.sources.events import events, long_events, raw_tables, timed_events
from tidemark.sources.footers import extent_by_footers
from tidemark.sources.tables import (
    after,
    last_output_time,
    long_frame,
    read_columns,
    read_items,
    read_items_untyped,
    read_or_empty,
    read_summary,
)
from tidemark.streaming.inspect import late_readings, waiting_rows, watermark
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
from tidemark.streaming.restart import run_with_restarts

LIVE = Params(step="1h", output_step="6h", partition_hours=24)
BATCH = Params(step="1h", output_step="6h", partition_hours=24, mode="batch")

# 2024-01-11 and 2024-01-21, in the 30 days the events cover.
MARK = 1_704_931_200
END = 1_705_795_200

# Steps of ``several_rates``, in seconds.
RATES = (600, 3600, 10_800)

# Series of ``since_mark_by_user``.
USERS = (10, 11, 12)

# Readings have few digits, so a mean may lie half-way between two roundings and
# fall either way with its last bit. This takes it off the middle.
NUDGE = 3e-9


def _tidy(df: DataFrame) -> DataFrame:
    """Round doubles: sums in another order differ in the last digits."""
    return df.select(
        *[
            F.round(F.col(f.name) + NUDGE, 6).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema
        ]
    )


def _grid_rows(df: DataFrame, *extra: str) -> DataFrame:
    return _tidy(df.select(*extra, epoch_seconds("grid").alias("datetime_utc"), *ALIGNED_COLUMNS))


# Alignment


def nearest_align_query(spark, sf):
    return _grid_rows(nearest_align(long_events(spark, sf), HOUR))


def nearest_align_wide_order(spark, sf):
    """Arrival numbers near the end of their type."""
    rows = long_events(spark, sf).withColumn("id", F.col("id") + F.lit(2**62))
    return _grid_rows(nearest_align(rows, HOUR))


def big_ids(spark, sf):
    """Arrival numbers far apart, below zero and above, of any size."""
    far = F.col("id").cast("decimal(19,0)") * F.lit(Decimal(10**13)) - F.lit(Decimal(2**56))
    rows = long_events(spark, sf).withColumn("id", far)
    return _grid_rows(nearest_align(rows, HOUR))


def null_key_align(spark, sf):
    """Series without a key are a series of their own."""
    rows = long_events(spark, sf, ("user_id",))
    rows = rows.withColumn("team", F.nullif(F.col("user_id") % 3, F.lit(0)))
    return _grid_rows(nearest_align(rows, HOUR, keys=("team",)), "team")


def several_rates(spark, sf):
    """Grids finer and coarser than the readings."""
    rows = long_events(spark, sf)
    parts = [
        _grid_rows(nearest_align(rows, s * SECOND).withColumn("step_s", F.lit(s)), "step_s")
        for s in RATES
    ]
    return lookup.union_all(parts)


def nearest_align_by_user(spark, sf):
    rows = nearest_align(long_events(spark, sf, ("user_id",)), HOUR, keys=("user_id",))
    return _grid_rows(rows, "user_id")


def nearest_align_tolerance(spark, sf):
    """Reach of two and a half steps."""
    return _grid_rows(nearest_align(long_events(spark, sf), HOUR, tolerance_us=HOUR * 5 // 2))


def nearest_fill_query(spark, sf):
    return _grid_rows(nearest_fill(long_events(spark, sf), HOUR))


def nearest_fill_by_user(spark, sf):
    rows = nearest_fill(long_events(spark, sf, ("user_id",)), HOUR, keys=("user_id",))
    return _grid_rows(rows, "user_id")


def missing_sensor(spark, sf):
    """A sensor table that does not exist counts as empty."""
    tables = raw_tables(spark, sf)
    tables["gps"] = read_or_empty(spark, f"{sf}/no_such_table.parquet", schemas.GPS)
    return _grid_rows(nearest_align(long_frame(tables), HOUR))


def time_grid_query(spark, sf):
    return time_grid(long_events(spark, sf), HOUR).select(epoch_seconds("grid").alias("datetime_utc"))


def extent_query(spark, sf):
    return extent(long_events(spark, sf)).select(
        epoch_seconds("first_us").alias("first_s"), epoch_seconds("last_us").alias("last_s")
    )


def mean_resample_query(spark, sf):
    means = mean_resample(long_events(spark, sf), HOUR)
    return _tidy(means.select(epoch_seconds("us").alias("datetime_utc"), *ALIGNED_COLUMNS))


def nan_means(spark, sf):
    """Every fifth reading is NaN, which counts as missing."""
    broken = lambda c: F.when(F.col("id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col(c))
    rows = long_events(spark, sf).withColumns({c: broken(c) for c in ALIGNED_COLUMNS})
    means = mean_resample(rows, HOUR)
    return _tidy(means.select(epoch_seconds("us").alias("datetime_utc"), *ALIGNED_COLUMNS))


def dedup_first(spark, sf):
    rows = long_events(spark, sf).select("source", "us", "id", *ALIGNED_COLUMNS)
    kept = first_arrival(rows, ["source", "us"], "id")
    return _tidy(kept.select("source", epoch_seconds("us").alias("datetime_utc"), "id", *ALIGNED_COLUMNS))


def drop_repeats_query(spark, sf):
    rows = timed_events(spark, sf).select("datetime_utc", "event_id", "value")
    return _tidy(drop_repeats(rows, ["datetime_utc"], "event_id")[0])


# Expressions


def corrected_ph_query(spark, sf):
    v = F.col("value")
    ph = corrected_ph(-0.95 + (v % 7) / 100, 10 + v % 15, 30 + v % 8, LIVE.k0, LIVE.k2)
    return _tidy(events(spark, sf).select("event_id", ph.alias("ph_corrected")))


def floor_times(spark, sf):
    rows = timed_events(spark, sf)
    us = F.col("datetime_utc") * SECOND
    return rows.select(
        F.col("event_id"),
        epoch_seconds(floor_to(us, 6 * HOUR)).alias("six_hours"),
        epoch_seconds(floor_to(us, 7 * SECOND)).alias("seven_seconds"),
        iso_z_from_seconds("datetime_utc").alias("iso"),
    )


def time_coercion(spark, sf):
    """Times as epoch text, ISO text or junk, in turn."""
    seconds = F.col("datetime_utc")
    kind = F.col("event_id") % 3
    text = (
        F.when(kind == 0, seconds.cast("string"))
        .when(kind == 1, iso_z_from_seconds(seconds))
        .otherwise(F.col("event_type"))
    )
    return timed_events(spark, sf).select(
        "event_id", F.unix_seconds(coerce_time(text)).alias("datetime_utc")
    )


def conform_columns(spark, sf):
    wanted = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("salinity", T.DoubleType()),
            T.StructField("value", T.DoubleType()),
        ]
    )
    return conform(events(spark, sf), wanted)


def drop_empty_rows(spark, sf):
    rows = long_events(spark, sf)
    return _tidy(drop_empty(rows, ["temp", "salinity", "latitude"]).select("id", "temp", "salinity", "latitude"))


def drop_null_key(spark, sf):
    return _tidy(long_events(spark, sf).na.drop(subset=["ph_total"]).select("id", "ph_total"))


def nan_is_missing(spark, sf):
    rows = events(spark, sf).select(
        "event_id", F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value")
    )
    return nan_to_null(rows)


def iso_rows(spark, sf):
    rows = timed_events(spark, sf).select("event_id", F.timestamp_seconds("datetime_utc").alias("time"))
    return iso_times(rows)


def items(spark, sf):
    rows = timed_events(spark, sf).select(
        "datetime_utc", "event_id", "event_type",
        F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("value"),
    )
    stored = to_items(rows)
    field = lambda name: F.get_json_object("item", f"$.{name}")
    return stored.select(
        "static_partition",
        "datetime_utc",
        field("event_id").cast("bigint").alias("event_id"),
        field("event_type").alias("event_type"),
        field("value").cast("double").alias("value"),
        F.contains("item", F.lit('"value"')).alias("has_value"),
    )


def item_scan(spark, sf):
    rows = timed_events(spark, sf).select("datetime_utc", "event_id", "value")
    fields = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    return read_items(to_items(rows), fields)


def item_scan_untyped(spark, sf):
    """Items whose fields nobody has named: each sensor's items have its own."""
    return _tidy(read_items_untyped(to_items(lookup.union_all(list(raw_tables(spark, sf).values())))))


# Rolling and lag windows


def _aligned_ph(spark, sf):
    return add_corrected_ph(align(long_events(spark, sf), LIVE), LIVE)


def _averages(df):
    return _tidy(
        df.select(epoch_seconds("grid").alias("datetime_utc"), "ph_corrected", "ph_total", "ph_corrected_ma", "ph_total_ma")
    )


def ph_moving_average_rows(spark, sf):
    return _averages(add_moving_averages(_aligned_ph(spark, sf), BATCH))


def ph_moving_average_ph_only(spark, sf):
    return _averages(add_moving_averages(_aligned_ph(spark, sf), LIVE))


def rolling_mean_time_query(spark, sf):
    rows = long_events(spark, sf).where(F.col("source") == "ph")
    means = rolling_mean_time(rows, (), "us", "ph_total", 6 * HOUR, name="ph_total_mean")
    return _tidy(means.select(epoch_seconds("us").alias("datetime_utc"), "ph_total_mean", "n"))


def rolling_mean_time_by_user(spark, sf):
    rows = long_events(spark, sf, ("user_id",)).where(F.col("source") == "ph")
    means = rolling_mean_time(rows, ("user_id",), "us", "ph_total", 6 * HOUR, name="ph_total_mean")
    return _tidy(means.select("user_id", epoch_seconds("us").alias("datetime_utc"), "ph_total_mean", "n"))


def rolling_mean_time_spikes(spark, sf):
    """Some readings are 1e17, a fill value: windows without one are as if there were none."""
    rows = long_events(spark, sf).where(F.col("source") == "ph")
    rows = rows.withColumn("ph_total", F.when(F.col("id") % 97 == 0, F.lit(1e17)).otherwise(F.col("ph_total")))
    means = rolling_mean_time(rows, (), "us", "ph_total", 6 * HOUR)
    spiked = F.col("mean") > 1e9
    return _tidy(
        means.select(
            epoch_seconds("us").alias("datetime_utc"), "n", spiked.alias("spiked"),
            F.when(~spiked, F.col("mean")).alias("ph_total_mean"),
        )
    )


# Summary


def underway_summary(spark, sf):
    return _tidy(summarize(long_events(spark, sf), LIVE))


def underway_summary_batch(spark, sf):
    return _tidy(summarize(long_events(spark, sf), BATCH))


def underway_summary_by_user(spark, sf):
    return _tidy(summarize(long_events(spark, sf, ("user_id",)), LIVE, ("user_id",)))


def _slices(tables: dict[str, DataFrame]) -> list[dict[str, DataFrame]]:
    """The tables as they grow: up to the mark, up to the end mark, whole."""
    upto = lambda t: {s: df.where(F.col("datetime_utc") <= t) for s, df in tables.items()}
    return [upto(MARK + 1234), upto(END + 4321), tables]


def _incremental(spark, sf, params):
    path = scratch(spark, "summary")
    *growing, whole = _slices(raw_tables(spark, sf))
    for tables in growing:
        process_incremental(spark, tables, path, params)
    process_incremental(spark, whole, path, params)
    process_incremental(spark, whole, path, params, flush=True)
    return _tidy(read_summary(spark, path).drop("partition"))


def incremental_equals_batch(spark, sf):
    return _incremental(spark, sf, LIVE)


def incremental_batch_mode(spark, sf):
    return _incremental(spark, sf, BATCH)


def _key(name: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.LongType())])


def late_series(spark, sf):
    """One series is complete before the other's first reading arrives, in files of its own."""
    path, folders = scratch(spark, "summary"), _folders(spark)
    tables = {s: t.withColumn("ship", F.col("user_id") % 2) for s, t in raw_tables(spark, sf).items()}
    _land_keyed({s: t.where("ship = 0") for s, t in tables.items()}, folders, "ship")
    run = lambda flush: process_incremental(
        spark, _landed(spark, folders, "ship"), path, LIVE, keys=_key("ship"), flush=flush, by_file=True
    )
    run(True)
    _land_keyed({s: t.where("ship = 1") for s, t in tables.items()}, folders, "ship")
    run(False)
    run(True)
    return _tidy(read_summary(spark, path, keys=_key("ship")).drop("partition"))


def _folders(spark) -> dict[str, str]:
    landing = scratch(spark, "raw")
    return {s: f"{landing}/{s}" for s in schemas.RAW}


def _keyed_schema(source: str, key: str) -> T.StructType:
    return T.StructType([*schemas.RAW[source].fields, *_key(key).fields])


def _land_keyed(tables, folders, key) -> None:
    for source, table in tables.items():
        conform(table, _keyed_schema(source, key)).write.mode("append").parquet(folders[source])


def _landed(spark, folders, key) -> dict[str, DataFrame]:
    return {s: spark.read.schema(_keyed_schema(s, key)).parquet(path) for s, path in folders.items()}


def snapshot_read(spark, sf):
    """The rows of each snapshot of a table that grows in three runs and is compacted, read
    after the last: a reader of an earlier one sees what was there then."""
    path, tables = scratch(spark, "summary"), raw_tables(spark, sf)
    numbers = []
    for part in _slices(tables):
        process_incremental(spark, part, path, LIVE)
        numbers.append(snapshots.load(spark, path).version)
    before = partition_name(END, LIVE.partition_hours)
    numbers.append(snapshots.compact(spark, path, schemas.summary(), before).version)
    parts = []
    for run, version in enumerate(numbers, 1):
        rows = snapshots.read(spark, snapshots.load(spark, path, version), schemas.summary())
        parts.append(rows.drop("partition").withColumn("run", F.lit(run)))
    return _tidy(lookup.union_all(parts))


def rebuild_summary(spark, sf):
    """A rebuild replaces what an earlier run on part of the data left."""
    path = scratch(spark, "summary")
    tables = raw_tables(spark, sf)
    process_incremental(spark, _slices(tables)[0], path, BATCH, flush=True)
    return _tidy(process_incremental(spark, tables, path, LIVE, rebuild=True))


def _stored_summary(spark, sf, params=LIVE, keys=()):
    path = scratch(spark, "summary")
    rows = summarize(long_events(spark, sf, keys), params, keys)
    write_parquet(rows, path, "overwrite", params.partition_hours)
    return path


def output_means_query(spark, sf):
    """Two runs of the mean output while the summary grows, then the last bucket."""
    whole = read_summary(spark, _stored_summary(spark, sf)).drop("partition")
    summary, output = scratch(spark, "summary"), scratch(spark, "means")
    write_parquet(whole.where(F.col("datetime_utc") <= MARK + 7200), summary, "append", LIVE.partition_hours)
    resample_summary(spark, summary, output, LIVE)
    write_parquet(whole.where(F.col("datetime_utc") > MARK + 7200), summary, "append", LIVE.partition_hours)
    resample_summary(spark, summary, output, LIVE)
    resample_summary(spark, summary, output, LIVE, flush=True)
    return _seconds(spark.read.parquet(output).drop("partition"))


def output_means_by_user(spark, sf):
    """The same for several series, each with buckets of its own."""
    keys = _key("user_id")
    whole = read_summary(spark, _stored_summary(spark, sf, keys=("user_id",)), keys=keys).drop("partition")
    summary, output = scratch(spark, "summary"), scratch(spark, "means")
    for part in (F.col("datetime_utc") <= MARK + 7200, F.col("datetime_utc") > MARK + 7200):
        write_parquet(whole.where(part), summary, "append", LIVE.partition_hours)
        resample_summary(spark, summary, output, LIVE, keys=keys)
    resample_summary(spark, summary, output, LIVE, flush=True, keys=keys)
    return _seconds(spark.read.parquet(output).drop("partition"))


def _seconds(means):
    return _tidy(means.withColumn("datetime_utc", F.unix_seconds("datetime_utc")))


def output_mark(spark, sf):
    path = scratch(spark, "means")
    write_parquet(output_means(read_summary(spark, _stored_summary(spark, sf)), LIVE), path, "overwrite", 24)
    return spark.createDataFrame([(last_output_time(spark, path),)], "datetime_utc bigint")


# Streams


def _land(tables, folders) -> None:
    for source, table in tables.items():
        conform(table, schemas.RAW[source]).write.mode("append").parquet(folders[source])


def _follow(spark, folders, path, checkpoint):
    """Stream what has landed; the query, ended."""
    rows = stream_align(raw_streams(spark, folders), LIVE)
    query = write_summary_stream(rows, path, checkpoint, LIVE, available_now=True)
    run_for(query)
    return query


def _stream_folders(spark, tables):
    prepare(spark)
    stream_settings(spark)
    landing = scratch(spark, "raw")
    return {s: f"{landing}/{s}" for s in tables}, scratch(spark, "summary")


def _in_parts(tables) -> Iterator[dict[str, DataFrame]]:
    """The tables in three parts, one after the other in time."""
    cuts = [None, MARK + 1234, END + 4321, None]
    for low, high in zip(cuts, cuts[1:]):
        parts = {s: after(t, low) for s, t in tables.items()}
        if high is not None:
            parts = {s: t.where(F.col("datetime_utc") <= high) for s, t in parts.items()}
        yield parts


def streaming_summary(spark, sf):
    """The raw tables land in three parts, each is streamed. Rows that later readings could
    still change have not been written."""
    tables = raw_tables(spark, sf)
    folders, path = _stream_folders(spark, tables)
    checkpoint = fresh_checkpoint(spark)
    for parts in _in_parts(tables):
        _land(parts, folders)
        _follow(spark, folders, path, checkpoint)
    return _tidy(read_summary(spark, path).drop("partition"))


def streaming_summary_by_user(spark, sf):
    """The same for several series: what averages look back on is kept in the stream's state."""
    keys, tables = _key("user_id"), raw_tables(spark, sf)
    folders, path = _stream_folders(spark, tables)
    checkpoint = fresh_checkpoint(spark)
    kinds = {s: _keyed_schema(s, "user_id") for s in tables}
    for parts in _in_parts(tables):
        _land_keyed(parts, folders, "user_id")
        rows = stream_align(raw_streams(spark, folders, raw_schemas=kinds), LIVE, keys=("user_id",))
        run_for(write_summary_stream(rows, path, checkpoint, LIVE, keys=keys, available_now=True))
    return _tidy(read_summary(spark, path, keys=keys).drop("partition"))


def streaming_restart(spark, sf):
    """A sink fails twice after the rows of a micro-batch are stored: the stream starts again
    and the rows are those of a stream without failures."""
    tables = raw_tables(spark, sf)
    folders, path = _stream_folders(spark, tables)
    checkpoint, calls = fresh_checkpoint(spark), []

    def sink(rows, number):
        calls.append(number)
        if len(calls) in (2, 3):
            raise RuntimeError("the sink is away")

    def start():
        rows = stream_align(raw_streams(spark, folders), LIVE)
        return write_summary_stream(rows, path, checkpoint, LIVE, available_now=True, also=sink)

    failures = []
    for parts in _in_parts(tables):
        _land(parts, folders)
        failures += run_with_restarts(start, wait_s=0.1)
    n = F.lit(len(failures)).cast("bigint").alias("failures")
    return _tidy(read_summary(spark, path).drop("partition")).select("*", n)


def stream_state(spark, sf):
    """What waits in a stream that has read all, and the mark up to which it has written."""
    tables = raw_tables(spark, sf)
    folders, path = _stream_folders(spark, tables)
    checkpoint = fresh_checkpoint(spark)
    _land(tables, folders)
    _follow(spark, folders, path, checkpoint)
    mark = F.lit(watermark(spark, checkpoint)).cast("bigint").alias("watermark_s")
    return waiting_rows(spark, checkpoint).select("*", mark)


def late_readings_query(spark, sf):
    """Readings of six hours land after the rest was streamed: by sensor, how many were read
    and how many of them were too late."""
    tables = raw_tables(spark, sf)
    folders, path = _stream_folders(spark, tables)
    checkpoint, late = fresh_checkpoint(spark), F.col("datetime_utc").between(MARK, MARK + 6 * 3600)
    for part in (~late, late):
        _land({s: t.where(part) for s, t in tables.items()}, folders)
        _follow(spark, folders, path, checkpoint)
    landed = {s: spark.read.schema(schemas.RAW[s]).parquet(path) for s, path in folders.items()}
    return late_readings(spark, checkpoint, landed, LIVE)


def streaming_reset(spark, sf):
    """A stream that starts over with a new checkpoint writes no row twice."""
    tables = raw_tables(spark, sf)
    folders, path = _stream_folders(spark, tables)
    _land(tables, folders)
    for _ in range(2):
        _follow(spark, folders, path, fresh_checkpoint(spark))
    return _tidy(read_summary(spark, path).drop("partition"))


def streaming_late_rows(spark, sf):
    """Readings of six hours land after the rest was streamed: they are counted, and the
    rows that were written stay."""
    tables = raw_tables(spark, sf)
    folders, path = _stream_folders(spark, tables)
    checkpoint, late = fresh_checkpoint(spark), F.col("datetime_utc").between(MARK, MARK + 6 * 3600)
    listener = LateRows()
    spark.streams.addListener(listener)
    try:
        _land({s: t.where(~late) for s, t in tables.items()}, folders)
        in_time = listener.total(_follow(spark, folders, path, checkpoint))
        _land({s: t.where(late) for s, t in tables.items()}, folders)
        too_late = listener.total(_follow(spark, folders, path, checkpoint))
    finally:
        spark.streams.removeListener(listener)
    counted = F.lit(in_time == 0 and too_late > 0).alias("counted")
    return _tidy(read_summary(spark, path).drop("partition")).withColumn("counted", counted)


def _streamed_means(spark, path, keys=None):
    prepare(spark)
    stream_settings(spark)
    output = scratch(spark, "means")
    means = stream_means(spark, path, LIVE, keys=keys)
    run_for(write_means_stream(means, output, fresh_checkpoint(spark), LIVE, available_now=True))
    return _seconds(spark.read.parquet(output).drop("partition"))


def streaming_means(spark, sf):
    """Means of the closed buckets of the summary, as a stream over its files."""
    return _streamed_means(spark, _stored_summary(spark, sf))


def streaming_means_by_user(spark, sf):
    return _streamed_means(spark, _stored_summary(spark, sf, keys=("user_id",)), _key("user_id"))


# Sinks and joins with stored rows


def new_rows_anti(spark, sf):
    rows = timed_events(spark, sf).select("datetime_utc", "event_id", "event_type")
    stored = rows.where(F.col("event_type") == "error")
    return not_in(rows, stored, ["datetime_utc"])


def idempotent_append(spark, sf):
    """Overlapping appends, one of them repeated: the first row of a time stays."""
    path = scratch(spark, "table")
    schema = T.StructType(
        [
            T.StructField("datetime_utc", T.LongType()),
            T.StructField("event_id", T.LongType()),
            T.StructField("value", T.DoubleType()),
        ]
    )
    rows = timed_events(spark, sf).select("datetime_utc", "event_id", "value")
    early = rows.where(F.col("datetime_utc") < END)
    late = rows.where(F.col("datetime_utc") > MARK).withColumn("value", -F.col("value"))
    for part, low in ((early, None), (late, MARK), (early, None)):
        append_once(part, path, schema, 24, order="event_id", since=low)
    return spark.read.parquet(path).drop("partition")


def idempotent_append_bucketed(spark, sf):
    """The same on a table that is bucketed by time: stored rows are not moved."""
    name = f"tidemark_{uuid.uuid4().hex}"
    create_buckets(
        spark, name, scratch(spark, "buckets"), "datetime_utc BIGINT, event_id BIGINT, value DOUBLE", ["datetime_utc"], 8
    )
    rows = timed_events(spark, sf).select("datetime_utc", "event_id", "value")
    early = rows.where(F.col("datetime_utc") < END)
    late = rows.where(F.col("datetime_utc") > MARK).withColumn("value", -F.col("value"))
    for part in (early, late, early):
        append_once_bucketed(part, name, order="event_id")
    return spark.table(name).drop("partition")


def table_append(spark, sf):
    path = scratch(spark, "table")
    rows = timed_events(spark, sf).select(
        F.timestamp_seconds("datetime_utc").alias("datetime_utc"), "event_id", "event_type"
    )
    append_table(rows.where(F.col("event_type") == "error"), path)
    append_table(rows.where(F.col("event_type") != "error"), path)
    return spark.read.parquet(path)


def partitioned_output(spark, sf):
    path = scratch(spark, "partitioned")
    rows = timed_events(spark, sf).select("datetime_utc", "event_id", "value")
    write_parquet(rows.where(F.col("datetime_utc") <= MARK), path, "append", 6)
    write_parquet(rows.where(F.col("datetime_utc") > MARK), path, "append", 6)
    stored = spark.read.schema("datetime_utc bigint, event_id bigint, value double, partition string").parquet(path)
    return _tidy(
        stored.groupBy("partition").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("value").alias("total"))
    )


def csv_output(spark, sf):
    path = scratch(spark, "csv")
    rows = timed_events(spark, sf).select("datetime_utc", "event_id", "value")
    write_csv(rows.where(F.col("datetime_utc") <= MARK), path)
    write_csv(rows.where(F.col("datetime_utc") > MARK), path)
    return (
        spark.read.schema("datetime_utc bigint, event_id bigint, value double").option("header", True).csv(path)
    )


def keyed_items(spark, sf):
    """Two puts with common keys: the later one shows."""
    path = scratch(spark, "items")
    rows = first_arrival(timed_events(spark, sf).select("datetime_utc", "event_id", "value"), ["datetime_utc"], "event_id")
    put_items(to_items(rows), path, version=1)
    put_items(to_items(rows.where(F.col("datetime_utc") > MARK).withColumn("value", F.col("value") + 1)), path, version=2)
    return _tidy(
        current_items(spark, path).select(
            "datetime_utc",
            F.get_json_object("item", "$.event_id").cast("bigint").alias("event_id"),
            F.get_json_object("item", "$.value").cast("double").alias("value"),
        )
    )


def union_by_name(spark, sf):
    return _tidy(lookup.union_all(list(raw_tables(spark, sf).values())).select("id", *ALIGNED_COLUMNS))


# Scans and lookups


def pruned_scan(spark, sf):
    return read_columns(events(spark, sf), ["event_id", "value"])


def scan_after_mark(spark, sf):
    return read_columns(timed_events(spark, sf, MARK), ["datetime_utc", "event_id", "value"], MARK)


def ordered_scan(spark, sf):
    rows = read_columns(timed_events(spark, sf, MARK), ["datetime_utc", "event_id"], MARK)
    return rows.orderBy("datetime_utc", "event_id")


def max_time(spark, sf):
    return high_water_mark(timed_events(spark, sf), "datetime_utc")


def latest_n(spark, sf):
    rows = timed_events(spark, sf).select("datetime_utc", "event_id", "value")
    return lookup.latest(rows, 200, ["datetime_utc", "event_id"])


def first_n(spark, sf):
    rows = timed_events(spark, sf).select("datetime_utc", "event_id", "value")
    return lookup.first_rows(rows, 5, ["datetime_utc", "event_id"])


def _partitioned_summary(spark, sf):
    return read_summary(spark, _stored_summary(spark, sf))


def since_mark(spark, sf):
    rows = lookup.since(_partitioned_summary(spark, sf), MARK, partition_hours=LIVE.partition_hours)
    return _tidy(rows.drop("partition"))


def time_range(spark, sf):
    rows = lookup.between(_partitioned_summary(spark, sf), MARK, END, partition_hours=LIVE.partition_hours)
    return _tidy(rows.drop("partition"))


def since_mark_by_user(spark, sf):
    """Some series of a summary that is clustered by series."""
    path, keys = scratch(spark, "summary"), _key("user_id")
    rows = summarize(long_events(spark, sf, ("user_id",)), LIVE, ("user_id",))
    commit_rows(rows, snapshots.opened(spark, path), LIVE.partition_hours, cluster=["user_id"])
    stored = read_summary(spark, path, MARK, keys, LIVE.partition_hours).drop("partition")
    return _tidy(stored.where(F.col("user_id").isin(*USERS)))


def footer_extent(spark, sf):
    """First and last time and rows of each raw table, from the footers of its files."""
    tables, folders = raw_tables(spark, sf), _folders(spark)
    _land(tables, folders)
    found = [(s, *extent_by_footers(spark, path)[0].values()) for s, path in folders.items()]
    return spark.createDataFrame(found, "source string, first_s bigint, last_s bigint, n_rows bigint")


def representative_row(spark, sf):
    rows = nearest_align(long_events(spark, sf), HOUR)
    rows = rows.select(epoch_seconds("grid").alias("datetime_utc"), *ALIGNED_COLUMNS)
    return _tidy(lookup.representative_row(rows))


def duplicate_examples_query(spark, sf):
    return duplicate_examples(timed_events(spark, sf), "datetime_utc")


# Quality


def null_report(spark, sf):
    return _tidy(quality.null_report(long_events(spark, sf, everything=True).select("id", *ALIGNED_COLUMNS)))


def freshness_query(spark, sf):
    rows = freshness(long_events(spark, sf, everything=True))
    return rows.select("source", "n_rows", epoch_seconds("last_us").alias("last_s"))


def state_summary_query(spark, sf):
    path = _stored_summary(spark, sf)
    return state_summary(spark, raw_tables(spark, sf), path, LIVE)


def _on_events(check: Callable, *args) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: _tidy(check(timed_events(spark, sf), "datetime_utc", *args))


def interval_stats_by_user(spark, sf):
    return _tidy(quality.interval_stats(timed_events(spark, sf), "datetime_utc", ("user_id",)))


def _dated_orders(spark, sf):
    """Orders in the order of their keys, which is not that of their dates."""
    orders = prepare(spark).read.parquet(f"{sf}/orders.parquet")
    return orders.select("o_orderkey", F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint").alias("day"))


def out_of_order(spark, sf):
    return _tidy(quality.out_of_order(_dated_orders(spark, sf), "day", "o_orderkey"))


def out_of_order_sparse_ids(spark, sf):
    """Arrival numbers 2**40 apart, of any size."""
    far = F.col("o_orderkey").cast("decimal(19,0)") * F.lit(Decimal(2**40))
    rows = _dated_orders(spark, sf).withColumn("o_orderkey", far)
    return _tidy(quality.out_of_order(rows, "day", "o_orderkey"))


def out_of_order_rows(spark, sf):
    return quality.out_of_order_rows(_dated_orders(spark, sf), "day", "o_orderkey").withColumnRenamed("prev_time", "prev_day")


def quality_report(spark, sf):
    tables = {
        s: df.select("id", "datetime_utc", *[c for c in df.columns if c in ALIGNED_COLUMNS])
        for s, df in raw_tables(spark, sf).items()
    }
    tables["summary"] = read_summary(spark, _stored_summary(spark, sf)).drop("partition")
    broken = F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    tables["events"] = timed_events(spark, sf).select("datetime_utc", broken.alias("value"))
    return _tidy(quality.quality_report_all(tables))


def quality_report_outputs(spark, sf):
    """The report of what was written: the mean output in Parquet, and the same as stored items,
    whose fields are found out."""
    means = output_means(read_summary(spark, _stored_summary(spark, sf)), LIVE)
    output, items_path = scratch(spark, "means"), scratch(spark, "items")
    write_parquet(means, output, "overwrite", LIVE.partition_hours)
    put_items(to_items(means), items_path, version=1)
    tables = {
        "output": spark.read.parquet(output).drop("partition").withColumn("datetime_utc", F.unix_seconds("datetime_utc")),
        "items": read_items_untyped(current_items(spark, items_path)),
    }
    return _tidy(quality.quality_report_all(tables, order=None))


def quality_report_incremental(spark, sf):
    """The report of three runs while the tables grow, each raw row read once. The median comes
    from a sketch: shown is whether its rank is as close as stated."""
    tables = {
        s: df.select("id", "datetime_utc", *[c for c in df.columns if c in ALIGNED_COLUMNS])
        for s, df in raw_tables(spark, sf).items()
    }
    broken = F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    tables["events"] = timed_events(spark, sf).select("datetime_utc", broken.alias("value"))
    path = scratch(spark, "checks")
    for part in _slices(tables):
        report = check_news(spark, part, path)
    times = lookup.union_all([df.select(F.lit(s).alias("table_name"), "datetime_utc") for s, df in tables.items()])
    near = [F.lit(0.5 - RANK_ERROR), F.lit(0.5 + RANK_ERROR)]
    exact = quality.interval_histogram(times, "datetime_utc", ("table_name",)).groupBy("table_name").agg(
        *[F.percentile("d", p, F.col("w")).alias(n) for n, p in zip(("low", "high"), near)]
    )
    median = report.where("metric = 'median_s'").join(exact, "table_name").select(
        "table_name", F.lit("median_within").alias("metric"), "column_name",
        F.col("value").between(F.floor("low"), F.ceil("high")).cast("double").alias("value"),
    )
    return _tidy(report.where("metric <> 'median_s'").unionByName(median))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "nearest_align": nearest_align_query,
    "nearest_align_wide_order": nearest_align_wide_order,
    "big_ids": big_ids,
    "null_key_align": null_key_align,
    "several_rates": several_rates,
    "nearest_align_by_user": nearest_align_by_user,
    "nearest_align_tolerance": nearest_align_tolerance,
    "nearest_fill": nearest_fill_query,
    "nearest_fill_by_user": nearest_fill_by_user,
    "missing_sensor": missing_sensor,
    "time_grid": time_grid_query,
    "extent": extent_query,
    "mean_resample": mean_resample_query,
    "nan_means": nan_means,
    "dedup_first": dedup_first,
    "drop_repeats": drop_repeats_query,
    "corrected_ph": corrected_ph_query,
    "floor_times": floor_times,
    "time_coercion": time_coercion,
    "conform_columns": conform_columns,
    "drop_empty_rows": drop_empty_rows,
    "drop_null_key": drop_null_key,
    "nan_is_missing": nan_is_missing,
    "iso_rows": iso_rows,
    "items": items,
    "item_scan": item_scan,
    "item_scan_untyped": item_scan_untyped,
    "ph_moving_average_rows": ph_moving_average_rows,
    "ph_moving_average_ph_only": ph_moving_average_ph_only,
    "rolling_mean_time": rolling_mean_time_query,
    "rolling_mean_time_by_user": rolling_mean_time_by_user,
    "rolling_mean_time_spikes": rolling_mean_time_spikes,
    "underway_summary": underway_summary,
    "underway_summary_batch": underway_summary_batch,
    "underway_summary_by_user": underway_summary_by_user,
    "incremental_equals_batch": incremental_equals_batch,
    "incremental_batch_mode": incremental_batch_mode,
    "late_series": late_series,
    "snapshot_read": snapshot_read,
    "rebuild_summary": rebuild_summary,
    "output_means": output_means_query,
    "output_means_by_user": output_means_by_user,
    "output_mark": output_mark,
    "streaming_summary": streaming_summary,
    "streaming_summary_by_user": streaming_summary_by_user,
    "streaming_restart": streaming_restart,
    "stream_state": stream_state,
    "late_readings": late_readings_query,
    "streaming_reset": streaming_reset,
    "streaming_late_rows": streaming_late_rows,
    "streaming_means": streaming_means,
    "streaming_means_by_user": streaming_means_by_user,
    "new_rows_anti": new_rows_anti,
    "idempotent_append": idempotent_append,
    "idempotent_append_bucketed": idempotent_append_bucketed,
    "table_append": table_append,
    "partitioned_output": partitioned_output,
    "csv_output": csv_output,
    "keyed_items": keyed_items,
    "union_by_name": union_by_name,
    "pruned_scan": pruned_scan,
    "scan_after_mark": scan_after_mark,
    "ordered_scan": ordered_scan,
    "max_time": max_time,
    "latest_n": latest_n,
    "first_n": first_n,
    "since_mark": since_mark,
    "since_mark_by_user": since_mark_by_user,
    "footer_extent": footer_extent,
    "time_range": time_range,
    "representative_row": representative_row,
    "duplicate_examples": duplicate_examples_query,
    "null_report": null_report,
    "freshness": freshness_query,
    "state_summary": state_summary_query,
    "interval_stats": _on_events(quality.interval_stats),
    "interval_stats_by_user": interval_stats_by_user,
    "irregular_intervals": _on_events(quality.irregular_intervals),
    "irregular_rows": _on_events(quality.irregular_rows),
    "duplicate_times": _on_events(quality.duplicate_times),
    "gaps": _on_events(quality.gaps, 600),
    "lag_seconds": _on_events(quality.lag_seconds),
    "out_of_order": out_of_order,
    "out_of_order_sparse_ids": out_of_order_sparse_ids,
    "out_of_order_rows": out_of_order_rows,
    "quality_report": quality_report,
    "quality_report_outputs": quality_report_outputs,
    "quality_report_incremental": quality_report_incremental,
}
