"""Keyed item outputs: a batch writer supplied by the caller, or an item table."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.sources.schemas import ITEM
from tidemark.sources.tables import read_or_empty

BATCH_SIZE = 25

WriteBatch = Callable[[list[dict]], None]


def write_items(items: DataFrame, write_batch: WriteBatch, batch_size: int = BATCH_SIZE) -> tuple[int, int]:
    """Send items (from ``functions.rows.to_items``) to ``write_batch``, at most
    ``batch_size`` at a time, from the tasks that hold them.

    A batch that fails is logged and counted, the others go on. Returns the
    numbers of items written and failed. A retried task sends its items again,
    which a put by key absorbs.
    """

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        written = failed = 0
        for frame in frames:
            texts = frame["item"].tolist()
            for start in range(0, len(texts), batch_size):
                batch = [json.loads(t, parse_float=Decimal, parse_int=Decimal) for t in texts[start : start + batch_size]]
                try:
                    write_batch(batch)
                    written += len(batch)
                except Exception:
                    logging.exception("a batch of %d items was not written", len(batch))
                    failed += len(batch)
        yield pd.DataFrame({"written": [written], "failed": [failed]})

    counts = items.select("item").mapInPandas(send, "written bigint, failed bigint")
    total = counts.agg(
        F.coalesce(F.sum("written"), F.lit(0)).alias("written"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("failed"),
    ).first()
    return total["written"], total["failed"]


def put_items(items: DataFrame, path: str, version: int) -> None:
    """Append items to an item table; ``version`` grows with every put."""
    items.withColumn("version", F.lit(version).cast("bigint")).write.mode("append").parquet(path)


def current_items(spark: SparkSession, path: str) -> DataFrame:
    """The item table as its readers see it: per key the last one put, of several in one put
    the greatest text."""
    stored = T.StructType([*ITEM.fields, T.StructField("version", T.LongType())])
    return (
        read_or_empty(spark, path, stored)
        .groupBy("static_partition", "datetime_utc")
        .agg(F.max(F.struct("version", "item"))["item"].alias("item"))
    )
