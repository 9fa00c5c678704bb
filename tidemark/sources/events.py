"""The ``events`` table read as instrument data.

Event types stand for instruments, the value for their reading, the event id
for the order of arrival; times are cut to whole seconds as raw tables hold them.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.time import epoch_seconds, timestamp_to_us
from tidemark.session import prepare

SOURCE_OF = {"click": "rhodamine", "view": "ph", "purchase": "tsg", "signup": "gps"}


def _readings():
    value = F.col("value")
    return {
        "rhodamine": {"rho_ppb": value},
        "ph": {"vrse": -0.95 + (value % 7) / 100, "ph_total": 7.5 + (value % 10) / 10},
        "tsg": {"temp": 10 + value % 15, "salinity": 30 + value % 8},
        "gps": {"latitude": 42 + value % 1, "longitude": -70 + value % 1},
    }


EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def timed_events(spark: SparkSession, sf_dir: str, mark: int | None = None) -> DataFrame:
    """Events with ``datetime_utc`` in epoch seconds, those later than ``mark`` if given:
    the bound is on the stored time too, so the scan skips what is before it."""
    rows = events(spark, sf_dir)
    if mark is not None:
        begin = datetime.fromtimestamp(mark + 1, timezone.utc).replace(tzinfo=None)
        rows = rows.where(F.col("ts") >= F.lit(begin.isoformat(" ")).cast("timestamp_ntz"))
    return rows.withColumn("datetime_utc", epoch_seconds(timestamp_to_us("ts")))


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """One raw table per instrument: id, datetime_utc, user_id and its readings."""
    rows = timed_events(spark, sf_dir)
    tables = {}
    for event_type, source in SOURCE_OF.items():
        readings = _readings()[source]
        tables[source] = rows.where(F.col("event_type") == event_type).select(
            F.col("event_id").alias("id"),
            "datetime_utc",
            "user_id",
            *[c.alias(name) for name, c in readings.items()],
        )
    return tables


def long_events(
    spark: SparkSession, sf_dir: str, keys: tuple[str, ...] = (), everything: bool = False
) -> DataFrame:
    """All instruments as one long frame, in a single scan. ``everything``: also events
    of types that stand for no instrument, as sources without readings."""
    rows = timed_events(spark, sf_dir)
    if not everything:
        rows = rows.where(F.col("event_type").isin(list(SOURCE_OF)))
    source = F.create_map(*[F.lit(x) for pair in SOURCE_OF.items() for x in pair])
    return rows.select(
        *keys,
        F.coalesce(source[F.col("event_type")], F.col("event_type")).alias("source"),
        (F.col("datetime_utc") * 1_000_000).alias("us"),
        F.col("event_id").alias("id"),
        *[
            F.when(F.col("event_type") == event_type, reading).alias(name)
            for event_type, src in SOURCE_OF.items()
            for name, reading in _readings()[src].items()
        ],
    )
