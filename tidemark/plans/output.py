"""Mean output of the summary, kept up to date in Parquet, CSV and items."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.rows import to_items
from tidemark.functions.time import floor_to, seconds_to_us
from tidemark.operators.aggregate import match, mean_resample, not_in
from tidemark.operators.lookup import label, since
from tidemark.params import SECOND, Params
from tidemark.sinks.files import write_csv, write_parquet
from tidemark.sinks.items import write_items
from tidemark.sources import schemas
from tidemark.sources.schemas import SUMMARY_VALUES
from tidemark.sources.tables import last_output_time, read_or_empty, read_summary


def output_means(summary: DataFrame, params: Params, keys: Sequence[str] = ()) -> DataFrame:
    """Bucket means of summary rows, per series, time as timestamp."""
    rows = summary.select(*keys, seconds_to_us("datetime_utc").alias("us"), *SUMMARY_VALUES)
    means = mean_resample(rows, params.output_step_us, keys=keys)
    return means.select(*keys, F.timestamp_micros("us").alias("datetime_utc"), *SUMMARY_VALUES)


def resample_summary(
    spark: SparkSession,
    summary_path: str,
    parquet_path: str,
    params: Params,
    csv_path: str | None = None,
    write_batch: Callable[[list[dict]], None] | None = None,
    flush: bool = False,
    keys: T.StructType | None = None,
) -> DataFrame | None:
    """Append the means of buckets closed since the last run; None if there are none.

    A bucket is closed once its series has a row after it; ``flush`` also writes the
    last one, and a bucket written stays as it is. The Parquet output is written first
    and a failure there ends the run. CSV and items get its rows, each from its own mark
    on: a failure of one is logged, does not stop the other, and the next run sends what
    was missed.
    """
    step_s, hours = params.output_step_us // SECOND, params.partition_hours
    names = [f.name for f in keys] if keys else []
    mark = None if names else last_output_time(spark, parquet_path)
    first_s = None if mark is None else mark + step_s
    rows = read_summary(
        spark, summary_path, None if first_s is None else first_s - 1, keys, None if names else hours
    )
    bucket = floor_to("datetime_utc", step_s)
    if not flush:
        if names:
            last = rows.groupBy(*names).agg(F.max(bucket).alias("_open"))
            rows = match(rows, last, names).where(bucket < F.col("_open")).drop("_open")
        else:
            rows = rows.where(bucket < rows.select(F.max(bucket)).scalar())
    means = output_means(rows, params, names)
    if names:
        # Series close their buckets at different times; those stored are left out.
        stored = _stored_means(spark, parquet_path, keys).drop("partition")
        means = not_in(means, stored, [*names, "datetime_utc"])
    means = means.persist()
    try:
        if not means.isEmpty():
            write_parquet(means, parquet_path, "append", hours)
            added = means.count()
        else:
            added = 0
    finally:
        means.unpersist()
    for name, send in (
        ("csv", csv_path and (lambda df: write_csv(df, csv_path))),
        ("items", write_batch and (lambda df: _put(df, write_batch))),
    ):
        if send:
            _deliver(spark, parquet_path, name, send, names, keys, hours)
    if not added:
        return None
    out = _stored_means(spark, parquet_path, keys)
    if first_s is not None:
        out = out.where(F.col("partition") >= label(first_s, hours))
        out = out.where(F.col("datetime_utc") >= F.timestamp_seconds(F.lit(first_s)))
    return out.drop("partition")


def _stored_means(spark: SparkSession, path: str, keys: T.StructType | None) -> DataFrame:
    schema = T.StructType([*(keys or []), *schemas.MEANS])
    return read_or_empty(spark, path, schemas.partitioned(schema))


def _put(df: DataFrame, write_batch: Callable[[list[dict]], None]) -> None:
    written, failed = write_items(to_items(df), write_batch)
    if failed:
        raise RuntimeError(f"{failed} of {written + failed} items were not written")


def _deliver(spark, parquet_path, name, send, names, keys, hours) -> None:
    """Send the stored rows that this sink has not had: which those are is kept in a
    table of sent times beside the output."""
    fields = [*(keys or []), T.StructField("datetime_utc", T.TimestampType())]
    sent_path = f"{parquet_path.rstrip('/')}.{name}"
    sent = read_or_empty(spark, sent_path, T.StructType(fields))
    rows = _stored_means(spark, parquet_path, keys)
    on = [*names, "datetime_utc"]
    if not names:
        # A row per run; the partitions before the newest are not listed.
        newest = sent.agg(F.unix_seconds(F.max("datetime_utc")).alias("t")).first()["t"]
        missing = rows if newest is None else since(
            rows.withColumn("_s", F.unix_seconds("datetime_utc")), newest, "_s", hours
        ).drop("_s")
    else:
        missing = not_in(rows, sent, on)
    missing = missing.drop("partition").persist()
    try:
        if missing.isEmpty():
            return
        send(missing)
        done = missing.select(*on) if names else missing.agg(F.max("datetime_utc").alias("datetime_utc"))
        done.write.mode("append").parquet(sent_path)
    except Exception:
        logging.exception("%s output was not written; the next run sends it again", name)
    finally:
        missing.unpersist()
