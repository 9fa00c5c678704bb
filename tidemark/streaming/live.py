"""The summary as a continuous job.

Raw tables are file streams. Every reading goes to the grid points it can serve;
a grid row leaves the state when the watermarks of all sensors have passed it,
complete and in time order. Each micro-batch then gets its pH and moving
averages, which look back into the stored summary or, for several series, into
state of their own, and is appended once.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.functions.rows import nan_to_null, to_items
from tidemark.functions.time import floor_to, seconds_to_us, timestamp_to_us
from tidemark.operators.aggregate import not_in
from tidemark.operators.nearest import nearest_aggregates, nearest_candidates
from tidemark.params import ALIGNED_COLUMNS, SECOND, SENSORS, Params, micros
from tidemark.plans.incremental import add_history, summary_mark
from tidemark.plans.summary import add_corrected_ph, to_summary
from tidemark.session import STREAM_STATE_STORE, scratch
from tidemark.sinks import snapshots
from tidemark.sinks.files import add_partition, commit_rows, stored_since
from tidemark.sinks.items import WriteBatch, write_items
from tidemark.sources import schemas
from tidemark.sources.tables import long_frame, read_summary
from tidemark.streaming.series import FIRST, with_series_means


def stream_settings(spark: SparkSession, wait_for_all: bool = True) -> None:
    """State on local disk with checkpoints in the shared folder. Output waits for
    the slowest sensor, or follows the fastest one: a silent sensor then does not
    stop it, but readings of a slow one may come too late."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STREAM_STATE_STORE)
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min" if wait_for_all else "max")


def raw_streams(
    spark: SparkSession,
    directories: Mapping[str, str],
    max_files: int | None = None,
    raw_schemas: Mapping[str, T.StructType] = schemas.RAW,
) -> dict[str, DataFrame]:
    """A file stream per raw table."""
    reader = {"maxFilesPerTrigger": max_files} if max_files else {}
    return {
        source: spark.readStream.schema(raw_schemas[source]).options(**reader).parquet(path)
        for source, path in directories.items()
    }


def stream_align(
    streams: Mapping[str, DataFrame],
    params: Params,
    lateness_s: int = 0,
    start_s: int | None = None,
    keys: Sequence[str] = (),
    order: str | None = "id",
) -> DataFrame:
    """Nearest alignment with a tolerance of one step, as a stream of grid rows.

    The watermark is on the grid time of each sensor before they are joined, so
    that the slowest sensor sets the pace. Two steps of delay make a row wait
    for the readings up to one step after it; ``lateness_s`` adds to that.
    Rows before ``start_s`` are dropped. The last rows stay in the state until newer
    readings arrive.
    """
    delay_us = 2 * params.step_us + lateness_s * SECOND
    if params.mode != "live":
        raise ValueError("a stream follows the rules of mode 'live'")
    parts = None
    for source, stream in streams.items():
        part = nearest_candidates(
            long_frame({source: stream}, keys=keys, order=order),
            params.step_us,
            params.step_us,
            keys=keys,
            order=order,
            unit_us=params.unit_us,
        )
        part = part.withColumn("grid", F.timestamp_micros("grid")).withWatermark(
            "grid", f"{delay_us} microseconds"
        )
        parts = part if parts is None else parts.unionByName(part)
    rows = parts.groupBy(*keys, "grid").agg(F.min("us").alias(FIRST), *nearest_aggregates(SENSORS))
    rows = rows.na.drop(how="all", subset=list(ALIGNED_COLUMNS))
    if start_s is not None:
        rows = rows.where(F.col("grid") >= F.timestamp_seconds(F.lit(start_s)))
    return rows.select(*keys, "grid", FIRST, *ALIGNED_COLUMNS)


def _from_first_reading(spark: SparkSession, rows: DataFrame, path: str, params: Params) -> DataFrame:
    """Without the row one step before the first reading, which a reading that lies on the
    grid also reaches. Rows leave the state in time order, so only a table with nothing
    stored can have it."""
    if summary_mark(spark, path) is not None:
        return rows.drop(FIRST)
    begin = rows.agg(floor_to(F.min(FIRST), params.step_us)).scalar()
    return rows.where(F.col("grid") >= begin).drop(FIRST)


def write_summary_stream(
    aligned: DataFrame,
    path: str,
    checkpoint: str,
    params: Params,
    keys: T.StructType | None = None,
    write_batch: WriteBatch | None = None,
    available_now: bool = False,
    also: Callable[[DataFrame, int], None] | None = None,
    forget_after: str | None = None,
) -> StreamingQuery:
    """Append aligned rows to the summary at ``path``, with pH and moving averages.

    Each trigger runs every ``params.poll_interval``, or until the files present
    are read with ``available_now``. The rows of a micro-batch are one commit, which names
    the micro-batch: one that is replayed after a failure writes nothing twice. Stored rows
    are compared with only where others have written to the table. ``also`` gets the rows
    that a micro-batch has stored, and its number; it has to bear repetition.

    Without series the rows looked back on are read from the end of the summary; for
    several series (``keys``) they are kept in the stream's state, ``forget_after`` a
    duration or for ever.
    """

    names = [f.name for f in keys] if keys else []
    schema = schemas.summary(keys)
    if forget_after and available_now:
        raise ValueError("state that is forgotten by the clock needs a stream that keeps running")
    if names:
        aligned = with_series_means(aligned, params, keys, forget_after)

    def append(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch if names else add_corrected_ph(batch.withColumn("grid", timestamp_to_us("grid")), params)
        batch_rows = rows.persist()
        try:
            rows = batch_rows if names else _from_first_reading(spark, batch_rows, path, params)
            first_us, last_us = rows.agg(F.min("grid"), F.max("grid")).first()
            if first_us is None:
                return
            first_s = first_us // SECOND
            if not names:
                rows = add_history(spark, rows, path, first_us, last_us, params)
            stored = _store_batch(spark, to_summary(rows, names), number, first_s)
            if write_batch:
                write_items(to_items(stored), write_batch)
            if also:
                also(stored, number)
        finally:
            batch_rows.unpersist()

    def _store_batch(spark: SparkSession, rows: DataFrame, number: int, first_s: int) -> DataFrame:
        base = snapshots.opened(spark, path)
        own = base.facts.get("stream") or {}
        mine = own.get("checkpoint") == checkpoint
        rows = rows.select(*schema.names)
        if not (mine and own["batch"] >= number):
            if base.files and not (mine and own["writes"] == base.facts.get("writes")):
                there = stored_since(spark, base, schema, first_s, params.partition_hours)
                rows = not_in(rows, there, [*names, "datetime_utc"])
            stream = {"checkpoint": checkpoint, "batch": number}
            made = commit_rows(rows, base, params.partition_hours, first_s, {"stream": stream})
            return snapshots.read(spark, made, schema, files=made.files.keys() - base.files.keys()).drop("partition")
        # Replayed: the rows are stored, what follows may not have had them.
        return read_summary(spark, path, first_s - 1, keys, params.partition_hours).drop("partition")

    trigger = (
        {"availableNow": True}
        if available_now
        else {"processingTime": f"{micros(params.poll_interval) // SECOND} seconds"}
    )
    return (
        aligned.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(append)
        .start()
    )


def stream_means(
    spark: SparkSession,
    summary_path: str,
    params: Params,
    lateness_s: int = 0,
    max_files: int | None = None,
    keys: T.StructType | None = None,
) -> DataFrame:
    """Bucket means of a growing summary, one row per closed bucket and series."""
    names = [f.name for f in keys] if keys else []
    reader = {"maxFilesPerTrigger": max_files} if max_files else {}
    rows = (
        spark.readStream.schema(schemas.partitioned(schemas.summary(keys)))
        .options(**reader)
        .parquet(summary_path)
    )
    timed = nan_to_null(rows).withColumn("time", F.timestamp_micros(seconds_to_us("datetime_utc"))).withWatermark(
        "time", f"{lateness_s} seconds"
    )
    bucket = F.window("time", f"{params.output_step_us} microseconds")
    means = timed.groupBy(*names, bucket).agg(*[F.avg(c).alias(c) for c in schemas.SUMMARY_VALUES])
    start = F.col("window.start").alias("datetime_utc")
    return means.select(*names, start, *schemas.SUMMARY_VALUES).na.drop(
        how="all", subset=list(schemas.SUMMARY_VALUES)
    )


def write_means_stream(
    means: DataFrame, path: str, checkpoint: str, params: Params, available_now: bool = False
) -> StreamingQuery:
    """Append closed buckets to a Parquet directory by time partition, exactly once."""
    trigger = (
        {"availableNow": True}
        if available_now
        else {"processingTime": f"{micros(params.output_poll_interval) // SECOND} seconds"}
    )
    return (
        add_partition(means, params.partition_hours)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("partition")
        .trigger(**trigger)
        .start()
    )


def run_for(query: StreamingQuery, seconds: float | None = None) -> None:
    """Wait for a query, or stop it after a time."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()


class LateRows(StreamingQueryListener):
    """Adds up readings that came after their grid rows had left the state, over all
    progress of all queries, however long they run. Map tasks reduce readings that serve
    the same grid row before the state counts them.

    Register with ``spark.streams.addListener`` before the queries start. For readings of
    each sensor, before any were combined, see ``inspect.late_readings``.
    """

    def __init__(self):
        self.late: dict[str, int] = {}
        self.batches: dict[str, int] = {}
        self.seconds: dict[str, float] = {}
        self.longest: dict[str, float] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        key = str(progress.id)
        late = sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)
        self.late[key] = self.late.get(key, 0) + late
        self.batches[key] = self.batches.get(key, 0) + 1
        took = progress.durationMs.get("triggerExecution", 0) / 1000
        self.seconds[key] = self.seconds.get(key, 0.0) + took
        self.longest[key] = max(took, self.longest.get(key, 0.0))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.batches[f"{event.id} ended"] = 1

    def total(self, query: StreamingQuery, wait_s: float = 30) -> int:
        """Late readings of a query, in all its runs from one checkpoint. Reports come a
        moment after the query ends: waits for that of its end."""
        until = time.monotonic() + wait_s
        while f"{query.id} ended" not in self.batches and time.monotonic() < until:
            time.sleep(0.05)
        self.batches.pop(f"{query.id} ended", None)
        return self.late.get(str(query.id), 0)


def fresh_checkpoint(spark: SparkSession, name: str = "stream") -> str:
    """A new checkpoint: the stream forgets what it has read. Rows read again are
    found stored and not written twice; rebuild the summary to replace them."""
    return scratch(spark, name)
