"""A table that is bucketed by its key, so that looking for stored rows moves none of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.aggregate import first_arrival
from tidemark.sinks.files import TIME, add_partition


def create_buckets(
    spark: SparkSession, name: str, path: str, schema: str, on: Sequence[str], buckets: int
) -> None:
    """A Parquet table in the catalog, its rows dealt by ``on`` into ``buckets`` files a write.
    So many that one bucket of what is compared fits in a task."""
    keys = ", ".join(f"`{c}`" for c in on)
    spark.sql(
        f"CREATE TABLE `{name}` ({schema}, `partition` STRING) USING parquet PARTITIONED BY (`partition`) "
        f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )


def append_once_bucketed(
    df: DataFrame, name: str, on: Sequence[str] = (TIME,), order: str | None = None, hours: int = 24
) -> None:
    """``append_once`` for such a table: of the rows that share ``on`` the first is stored, once.
    New rows are dealt like the table; the stored side is read in place, without a shuffle.

    Rows without a value in ``on`` equal none and are stored each time; leave them out before.
    """
    rows = first_arrival(df, on, order) if order else df
    add_partition(new_rows(rows, name, on), hours).write.mode("append").insertInto(name)


def new_rows(rows: DataFrame, name: str, on: Sequence[str]) -> DataFrame:
    """Rows whose key the table does not hold. Plain equality: only that is matched by buckets.
    The stored side is never broadcast or sent, it only names its keys."""
    stored = rows.sparkSession.table(name).select(*on)
    return rows.hint("shuffle_merge").join(stored.hint("shuffle_merge"), list(on), "left_anti").select(*rows.columns)
