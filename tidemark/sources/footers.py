"""Answers from Parquet footers: least and greatest time and the number of rows of a table.

The data source's second version takes such an aggregation over (``PushedAggregation`` in its
scan) and reads no row. It does so for whole numbers, floating point and dates, so for times
in epoch seconds as raw tables and summaries hold them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

SETTINGS = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text"}


@contextmanager
def pushed_aggregation(spark: SparkSession) -> Iterator[None]:
    """Parquet is read through the version of the data source that takes aggregations over;
    plans have to be made inside."""
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def extent_by_footers(
    spark: SparkSession, paths: str | Sequence[str], time: str = "datetime_utc", by: Sequence[str] = ()
) -> list[dict]:
    """``first``, ``last`` and ``n_rows`` of a column, for all rows or by partition column."""
    with pushed_aggregation(spark):
        return [r.asDict() for r in extent_plan(spark, paths, time, by).collect()]


def extent_plan(spark: SparkSession, paths: str | Sequence[str], time: str, by: Sequence[str] = ()) -> DataFrame:
    """The aggregation. Statistics are looked up by the place of a column, so the schema has to be
    that of the files, and all of them must have the same: as one writer leaves them."""
    rows = spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    return rows.groupBy(*by).agg(F.min(time).alias("first"), F.max(time).alias("last"), F.count("*").alias("n_rows"))
