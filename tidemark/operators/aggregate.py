"""Bucket means, duplicate handling, marks and row counts."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from tidemark.functions.rows import drop_empty, nan_to_null, numeric_columns
from tidemark.functions.time import floor_to


def mean_resample(
    df: DataFrame,
    step_us: int,
    us: str = "us",
    keys: Sequence[str] = (),
    exclude: Sequence[str] = ("id",),
) -> DataFrame:
    """Mean of every numeric column per time bucket ``[b, b + step)``, labelled
    by its start; nulls and NaN skipped, buckets without any value absent.
    Without numeric columns the result is empty."""
    df = nan_to_null(df)
    columns = numeric_columns(df, {us, *keys, *exclude})
    bucket = floor_to(us, step_us).alias(us)
    rows = df.where(F.col(us).isNotNull())
    if not columns:
        return rows.select(*keys, bucket).limit(0)
    means = rows.groupBy(*keys, bucket).agg(*[F.avg(c).alias(c) for c in columns])
    return drop_empty(means, columns)


def _arrival(df: DataFrame, order: str) -> Column:
    """Sort key: rows without an arrival number come last."""
    if isinstance(df.schema[order].dataType, T.IntegralType):
        return F.coalesce(F.col(order).cast("decimal(20,0)"), F.lit(Decimal(2**63)).cast("decimal(20,0)"))
    return F.struct(F.col(order).isNull(), F.col(order))


def first_arrival(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per ``keys``: of each group the one with the smallest ``order``."""
    others = [c for c in df.columns if c not in (*keys, order)]
    key = _arrival(df, order)
    return df.groupBy(*keys).agg(
        F.min(order).alias(order), *[F.min_by(c, key).alias(c) for c in others]
    ).select(*df.columns)


def drop_repeats(df: DataFrame, keys: Sequence[str], order: str) -> tuple[DataFrame, Observation]:
    """``first_arrival`` with the row counts before and after, to be read from
    the observation (``rows_in``, ``times``) once the result was computed."""
    seen = Observation()
    key = _arrival(df, order)
    counted = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(order).alias(order),
        *[F.min_by(c, key).alias(c) for c in df.columns if c not in (*keys, order)],
    )
    observed = counted.observe(
        seen, F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_in"), F.count(F.lit(1)).alias("times")
    )
    return observed.select(*df.columns), seen


def duplicate_examples(df: DataFrame, time: str, n: int = 3) -> DataFrame:
    """The first ``n`` times that occur more than once, with their counts."""
    return (
        df.groupBy(time)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where("occurrences > 1")
        .orderBy(time)
        .limit(n)
    )


def match(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, null being a key like any other."""
    other = {c: f"_{c}_right" for c in on}
    renamed = right.select(*[F.col(c).alias(other.get(c, c)) for c in right.columns])
    equal = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(o)) for c, o in other.items()])
    return left.join(renamed, equal, how).drop(*other.values())


def not_in(new: DataFrame, existing: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing``; null is a key like any other."""
    return match(new, existing.select(*on), on, "left_anti")


def high_water_mark(df: DataFrame, time: str) -> DataFrame:
    """One row: the latest time, null without rows."""
    return df.agg(F.max(time).alias(time))


def freshness(long: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows, first and latest time per source (and series)."""
    return long.groupBy(*keys, "source").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("us").alias("first_us"),
        F.max("us").alias("last_us"),
    )
