"""Scans of raw tables, summaries and stored outputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.rows import nan_to_null
from tidemark.functions.time import coerce_time, partition_name, seconds_to_us
from tidemark.operators.lookup import since, union_all
from tidemark.params import SENSORS
from tidemark.sinks import snapshots
from tidemark.sources import schemas

ABSENT = {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"}


def read_or_empty(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table, or no rows of its schema if the path does not exist.
    Any other problem raises."""
    try:
        return spark.read.format(fmt).options(**(options or {})).schema(schema).load(path)
    except AnalysisException as error:
        if error.getCondition() not in ABSENT:
            raise
        return spark.createDataFrame([], schema)


def file_name(address: str) -> str:
    """The address of a file as ``_metadata.file_path`` has it."""
    scheme, found, path = address.partition(":///")
    return f"{scheme}:/{path}" if found else address


def read_jdbc(spark: SparkSession, url: str, table: str, columns: Sequence[str], **options: str) -> DataFrame:
    """Named columns of a database table; needs the database's JDBC driver.
    Pass partitionColumn, lowerBound, upperBound, numPartitions to read in parallel."""
    return (
        spark.read.format("jdbc").options(url=url, dbtable=table, **options).load().select(*columns)
    )


def after(
    df: DataFrame, mark: int | None, time: str = "datetime_utc", partition_hours: int | None = None
) -> DataFrame:
    """Rows later than ``mark`` (whole epoch seconds), all without a mark. The filter
    is on the raw column, so it reaches the scan; with ``partition_hours`` earlier
    partitions are not listed."""
    return df if mark is None else since(df, int(mark), time, partition_hours)


def read_columns(df: DataFrame, columns: Sequence[str], mark: int | None = None) -> DataFrame:
    """Pruned scan, optionally after a mark."""
    return after(df, mark).select(*columns)


def read_summary(
    spark: SparkSession,
    path: str,
    mark: int | None = None,
    keys: T.StructType | None = None,
    partition_hours: int | None = None,
) -> DataFrame:
    """Summary rows after a mark, in no order (sort where the result leaves Spark), of the
    newest snapshot if the table has one. With the hours of its partitions, earlier ones
    are not listed."""
    schema = schemas.summary(keys)
    snapshot = snapshots.load(spark, path)
    if snapshot is None:
        stored = after(read_or_empty(spark, path, schemas.partitioned(schema)), mark, partition_hours=partition_hours)
    else:
        low = partition_name(mark, partition_hours) if mark is not None and partition_hours else None
        stored = after(snapshots.read(spark, snapshot, schema, low), mark)
    return nan_to_null(stored)


def long_frame(
    tables: Mapping[str, DataFrame],
    mark: int | None = None,
    sensors: Mapping[str, Sequence[str]] = SENSORS,
    keys: Sequence[str] = (),
    order: str | None = "id",
    partition_hours: int | None = None,
) -> DataFrame:
    """Raw tables (time in epoch seconds) as one long frame for the grid operators."""
    every = [c for cols in sensors.values() for c in cols]
    parts = []
    for source, cols in sensors.items():
        if source not in tables:
            continue
        table = nan_to_null(after(tables[source], mark, partition_hours=partition_hours))
        own = table.select(
            *keys,
            F.lit(source).alias("source"),
            seconds_to_us("datetime_utc").alias("us"),
            *([F.col(order).cast("bigint").alias(order)] if order else []),
            *[
                (F.col(c) if c in cols and c in table.columns else F.lit(None)).cast("double").alias(c)
                for c in every
            ],
        )
        parts.append(own)
    return union_all(parts)


def last_output_time(spark: SparkSession, path: str, fmt: str = "parquet") -> int | None:
    """Latest ``datetime_utc`` of an output, None if there is none. Reads one column, of
    a partitioned output that of the newest partition only."""
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"unsupported output format: {fmt!r}")
    try:
        reader = spark.read.format(fmt)
        if fmt == "csv":
            reader = reader.option("header", True)
        stored = reader.load(path)
    except AnalysisException as error:
        if error.getCondition() in ABSENT | {"UNABLE_TO_INFER_SCHEMA"}:
            return None
        raise
    if "datetime_utc" not in stored.columns:
        return None
    if "partition" in stored.columns:
        # Rows without a time are in a partition without a name.
        newest = stored.agg(F.max("partition").alias("p")).first()["p"]
        stored = stored.where(F.col("partition") == F.lit(newest))
    if isinstance(stored.schema["datetime_utc"].dataType, T.TimestampType):
        row = stored.agg(F.unix_seconds(F.max("datetime_utc")).alias("t")).first()
    else:
        row = stored.agg(F.max(F.unix_seconds(coerce_time("datetime_utc"))).alias("t")).first()
    return row["t"]


def read_items(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Stored items as rows: the JSON fields by schema, the time parsed, null if unreadable."""
    parsed = F.from_json("item", schema)
    return df.select(
        F.unix_seconds(coerce_time("datetime_utc")).alias("datetime_utc"), parsed.alias("f")
    ).select("datetime_utc", *[F.col(f"f.{f.name}").alias(f.name) for f in schema])


def item_fields(items: DataFrame) -> T.StructType:
    """The fields that occur in stored items and the types that hold all their values: numbers
    with a fraction become double, what no common type holds stays a variant. One pass."""
    found = items.agg(F.schema_of_variant_agg(F.try_parse_json("item"))).first()[0]
    if not found or not found.startswith("OBJECT<"):
        return T.StructType([])
    parsed = T.DataType.fromDDL(found.replace("OBJECT<", "struct<"))
    return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in parsed.fields])


def _plain(kind: T.DataType) -> T.DataType:
    if isinstance(kind, (T.DecimalType, T.FloatType)):
        return T.DoubleType()
    if isinstance(kind, T.NullType):
        return T.StringType()
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in kind.fields])
    return T.ArrayType(_plain(kind.elementType)) if isinstance(kind, T.ArrayType) else kind


def read_items_untyped(items: DataFrame, fields: T.StructType | None = None) -> DataFrame:
    """Stored items as rows, of any fields: those of ``fields``, or all that occur (but for those
    that the items' keys repeat). An item
    without a field, or with a value of another kind there, has null; so has unreadable text."""
    fields = item_fields(items) if fields is None else fields
    parsed = items.select(
        F.unix_seconds(coerce_time("datetime_utc")).alias("datetime_utc"), F.try_parse_json("item").alias("v")
    )
    return parsed.select(
        "datetime_utc",
        *[_field(f.name, f.dataType.simpleString()).alias(f.name) for f in fields if f.name not in items.columns],
    )


def _field(name: str, kind: str) -> Column:
    for quote in "'\"":
        if quote not in name and "\\" not in name:
            return F.try_variant_get("v", f"$[{quote}{name}{quote}]", kind)
    escaped = name.replace("`", "``")  # no path can name it
    return F.try_variant_get("v", "$", f"struct<`{escaped}`: {kind}>").getField(name)


def read_item_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Items exported as JSON lines, one object per line."""
    fields = T.StructType(
        [T.StructField("datetime_utc", T.StringType()), *[f for f in schema if f.name != "datetime_utc"]]
    )
    stored = spark.read.schema(fields).json(path)
    return stored.withColumn("datetime_utc", F.unix_seconds(coerce_time("datetime_utc")))
