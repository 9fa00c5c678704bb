"""File outputs: CSV, Parquet by time partition, and the append that writes
each timestamp once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.time import epoch_seconds, partition_label, partition_name, seconds_to_us, timestamp_to_us
from tidemark.operators.aggregate import first_arrival, not_in
from tidemark.sinks import snapshots
from tidemark.sinks.snapshots import Snapshot

TIME = "datetime_utc"
#: Rows of a page in files that are clustered: what one series takes is read in such pieces.
PAGE_ROWS = 2_000


def _time_us(df: DataFrame, time: str) -> Column:
    if isinstance(df.schema[time].dataType, T.IntegralType):
        return seconds_to_us(time)
    return timestamp_to_us(time)


def add_partition(df: DataFrame, hours: int, time: str = TIME) -> DataFrame:
    """Add ``partition``: the start of the ``hours``-long stretch, as sortable text."""
    return df.withColumn("partition", partition_label(_time_us(df, time), hours))


def write_csv(df: DataFrame, path: str, mode: str = "append", header: bool = True) -> None:
    """CSV directory; every part file carries the header, readers skip it per file."""
    df.write.mode(mode).option("header", header).csv(path)


def write_parquet(
    df: DataFrame, path: str, mode: str = "append", partition_hours: int | None = None, time: str = TIME
) -> None:
    """Parquet directory, partitioned by floored time if asked.

    Rows are gathered per partition before writing to avoid a file per task and
    partition; the rebalance lets Spark split a partition that is much larger
    than the others over several tasks.
    """
    if partition_hours is None:
        df.write.mode(mode).parquet(path)
        return
    labelled = add_partition(df, partition_hours, time).hint("rebalance", "partition")
    labelled.write.mode(mode).partitionBy("partition").parquet(path)


def append_table(df: DataFrame, path: str, time: str = TIME) -> None:
    """Plain append with the time as whole epoch seconds."""
    seconds = epoch_seconds(_time_us(df, time))
    df.withColumn(time, seconds).write.mode("append").parquet(path)


def append_once(
    df: DataFrame,
    path: str,
    schema: T.StructType,
    partition_hours: int,
    keys: Sequence[str] = (),
    order: str | None = None,
    since: int | None = None,
) -> Snapshot:
    """Append the rows whose time (per series) is not stored yet; what was written
    first stays. Running it again with the same rows writes nothing. A missing time
    or series key is a value like any other.

    ``order`` picks the first of rows that share a time; without it times must be
    unique in ``df``. ``since`` (epoch seconds), a lower bound of the times in
    ``df``, limits the stored rows that are read. One writer at a time. The rows are
    there with the snapshot that is returned, all of them or none.
    """
    on = [*keys, TIME]
    rows = first_arrival(df, on, order) if order else df
    base = snapshots.opened(df.sparkSession, path)
    stored = stored_since(df.sparkSession, base, schema, since, partition_hours)
    new = not_in(rows.select(*[f.name for f in schema]), stored, on)
    return commit_rows(new, base, partition_hours, since)


def stored_since(
    spark: SparkSession, base: Snapshot, schema: T.StructType, since: int | None, partition_hours: int
) -> DataFrame:
    """Stored rows from a time on, and those without a time."""
    if since is None:
        return snapshots.read(spark, base, schema)
    stored = snapshots.read(spark, base, schema, partition_name(since - 1, partition_hours))
    return stored.where(F.col(TIME).isNull() | (F.col(TIME) >= since))


def commit_rows(
    new: DataFrame,
    base: Snapshot,
    partition_hours: int,
    since: int | None = None,
    facts: Mapping[str, object] | None = None,
    replace: bool = False,
    cluster: Sequence[str] = (),
) -> Snapshot:
    """Write rows and commit them with ``facts`` and the new mark; ``replace`` drops all others.
    ``since``: a lower bound of their times. Without rows and facts nothing is written.

    ``cluster``: series keys. Within a file the rows of a series then lie together, in order of
    time, and Bloom filters tell which files have none: who asks for one series reads few
    pages.
    """
    labelled = add_partition(new, partition_hours).hint("rebalance", "partition")
    options = {}
    if cluster:
        labelled = labelled.sortWithinPartitions("partition", *cluster, TIME)
        options = {f"parquet.bloom.filter.enabled#{c}": "true" for c in cluster}
        options["parquet.page.row.count.limit"] = str(PAGE_ROWS)
    low = None if since is None else partition_name(since, partition_hours)
    added, last, _ = snapshots.write_files(labelled, base, low, options=options)
    marks = [m for m in (last, None if replace else base.facts.get("mark_s")) if m is not None]
    writes = base.facts.get("writes", 0) + bool(added or replace)
    facts = {**(facts or {}), "mark_s": max(marks, default=None), "writes": writes}
    if facts.get("series"):
        facts["series_writes"] = writes
    if facts.get("stream"):
        facts["stream"] = {**facts["stream"], "writes": writes}
    if not added and not replace and not facts.get("series"):
        return base
    return snapshots.commit(new.sparkSession, base, added, base.files if replace else (), facts)
