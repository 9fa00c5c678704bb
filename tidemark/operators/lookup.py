"""Key and time queries over stored rows, and small row picks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.time import partition_label, seconds_to_us


def label(seconds: int, hours: int):
    return partition_label(seconds_to_us(F.lit(seconds)), hours)


def since(df: DataFrame, mark: int, time: str = "datetime_utc", partition_hours: int | None = None) -> DataFrame:
    """Rows later than ``mark`` (epoch seconds). With ``partition_hours`` the
    partitions that end before the mark are not listed."""
    if partition_hours:
        df = df.where(F.col("partition") >= label(mark, partition_hours))
    return df.where(F.col(time) > mark)


def between(
    df: DataFrame,
    start: int,
    end: int,
    time: str = "datetime_utc",
    partition_hours: int | None = None,
) -> DataFrame:
    """Rows from ``start`` to ``end``, both included (epoch seconds)."""
    if partition_hours:
        df = df.where(
            F.col("partition").between(label(start, partition_hours), label(end, partition_hours))
        )
    return df.where(F.col(time).between(start, end))


def latest(df: DataFrame, n: int, order: Sequence[str] = ("datetime_utc",)) -> DataFrame:
    """The last ``n`` rows, newest first."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def first_rows(df: DataFrame, n: int = 5, order: Sequence[str] = ("datetime_utc",)) -> DataFrame:
    return df.orderBy(*order).limit(n)


def representative_row(df: DataFrame, time: str = "datetime_utc") -> DataFrame:
    """One row of a batch: the first without nulls, else the second, else the only one."""
    part = F.lit(False)
    for c in df.columns:
        part = part | F.col(c).isNull()
    # The first two in this order hold the row wanted: one pass over the input.
    two = df.withColumn("_part", part).orderBy("_part", time).limit(2)
    wanted = [F.col("_part"), F.when(~F.col("_part"), F.col(time)), F.col(time).desc()]
    return two.orderBy(*wanted).limit(1).drop("_part")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
