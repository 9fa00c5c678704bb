"""Row shaping: expected columns, missing values, sparse items, text rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.time import iso_z, iso_z_from_seconds

ITEM_PARTITION = "data"


def conform(df: DataFrame, schema: T.StructType | Sequence[str], dtype: str = "double") -> DataFrame:
    """Exactly the given columns in the given order; absent ones are null."""
    if isinstance(schema, T.StructType):
        wanted = [(f.name, f.dataType) for f in schema]
    else:
        wanted = [(name, dtype) for name in schema]
    return df.select(
        *[
            (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in wanted
        ]
    )


def known(df: DataFrame, name: str) -> Column:
    """A column in which a missing reading has one form only: null."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.nanvl(F.col(name), F.lit(None)).alias(name)
    return F.col(name)


def nan_to_null(df: DataFrame) -> DataFrame:
    """``known`` for all columns."""
    return df.select(*[known(df, f.name) for f in df.schema])


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def drop_empty(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows in which all of ``columns`` are null."""
    return df.na.drop(how="all", subset=list(columns))


def _iso_time(df: DataFrame, name: str):
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return iso_z(F.col(name).cast("timestamp"))
    if isinstance(kind, T.IntegralType):
        return iso_z_from_seconds(name)
    return F.col(name).cast("string")


def iso_times(df: DataFrame) -> DataFrame:
    """All time-typed columns as ISO text, other columns unchanged."""
    times = (T.TimestampType, T.TimestampNTZType, T.DateType)
    return df.select(
        *[
            _iso_time(df, f.name).alias(f.name) if isinstance(f.dataType, times) else F.col(f.name)
            for f in df.schema
        ]
    )


def to_items(df: DataFrame, time: str = "datetime_utc", attributes: Sequence[str] | None = None) -> DataFrame:
    """Sparse items keyed by (static_partition, datetime_utc).

    ``item`` is JSON text without the null and NaN fields; numbers keep the
    digits of their text form, all else is text. Rows without a time have no key
    and are left out.
    """
    df = nan_to_null(df)
    if attributes is None:
        attributes = [c for c in df.columns if c != time]
    fields = [
        F.col(name)
        if isinstance(df.schema[name].dataType, T.NumericType)
        else _iso_time(df, name).alias(name)
        if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))
        else F.col(name).cast("string").alias(name)
        for name in attributes
    ]
    key = _iso_time(df, time).alias("datetime_utc")
    partition = F.lit(ITEM_PARTITION).alias("static_partition")
    item = F.to_json(F.struct(partition, key, *fields), {"ignoreNullFields": "true"})
    return df.where(F.col(time).isNotNull()).select(partition, key, item.alias("item"))
