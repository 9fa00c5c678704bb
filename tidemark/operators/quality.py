"""Data-quality reports on the time column of a table.

``time`` is a bigint of whole epoch seconds, as the tables store it (use
``functions.time.coerce_time`` first for other forms). Row windows go through
``trailing``. Rows that share a time are counted before anything is ordered, so
a time that holds a large part of the table costs one row.

The statistics come from a histogram of the intervals. Intervals between
distinct times add up to the covered time R, so there are at most sqrt(2 R)
different ones: about 80,000 for a century of seconds, however many rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.functions.rows import nan_to_null
from tidemark.operators.aggregate import match
from tidemark.operators.lookup import union_all
from tidemark.operators.trailing import ranked, with_previous

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def null_report(df: DataFrame) -> DataFrame:
    """Missing values (null or NaN) per column with at least one, as count and percentage."""
    df = nan_to_null(df)
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    entry = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("missing"))
                for i, c in enumerate(df.columns)
            ]
        )
    )
    return (
        counts.select("total", entry.alias("e"))
        .select("e.*", (F.col("e.missing") * 100.0 / F.greatest("total", F.lit(1))).alias("missing_pct"))
        .where("missing > 0")
    )


def time_counts(df: DataFrame, time: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct time."""
    return (
        df.where(F.col(time).isNotNull())
        .groupBy(*keys, F.col(time).cast("bigint").alias("t"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def intervals(df: DataFrame, time: str, keys: Sequence[str] = ()) -> DataFrame:
    """Each distinct time with the one before it and the number of its rows."""
    return with_previous(time_counts(df, time, keys), keys, "t", {"prev_t": "t"})


def lag_seconds(df: DataFrame, time: str, keys: Sequence[str] = ()) -> DataFrame:
    """Seconds since the previous distinct time; null for the first."""
    return intervals(df, time, keys).select(
        *keys, F.col("t").alias(time), (F.col("t") - F.col("prev_t")).alias("lag_s"), "n"
    )


def gaps(df: DataFrame, time: str, expected_s: int, keys: Sequence[str] = ()) -> DataFrame:
    """Times whose next sample is later than the expected interval."""
    gap = F.col("t") - F.col("prev_t")
    return (
        intervals(df, time, keys)
        .where(gap > expected_s)
        .select(*keys, F.col("prev_t").alias(time), gap.alias("gap_s"))
    )


def interval_histogram(df: DataFrame, time: str, keys: Sequence[str] = ()) -> DataFrame:
    """How often each interval between successive rows occurs, in seconds.
    ``n`` rows at one time make ``n - 1`` intervals of zero."""
    entries = F.array(
        F.struct((F.col("t") - F.col("prev_t")).alias("d"), F.lit(1).cast("bigint").alias("w")),
        F.struct(F.lit(0).cast("bigint").alias("d"), (F.col("n") - 1).alias("w")),
    )
    return (
        intervals(df, time, keys)
        .select(*keys, F.explode(entries).alias("e"))
        .select(*keys, "e.d", "e.w")
        .where("d IS NOT NULL AND w > 0")
        .groupBy(*keys, "d")
        .agg(F.sum("w").alias("w"))
    )


def _stats_of(histogram: DataFrame, keys: Sequence[str]) -> DataFrame:
    d = F.col("d").cast("decimal(12,0)")
    w = F.col("w").cast("decimal(13,0)")
    sums = histogram.groupBy(*keys).agg(
        F.sum("w").alias("n"),
        F.sum(F.col("d") * F.col("w")).alias("sd"),
        F.sum(d * d * w).alias("sdd"),
        F.percentile("d", F.lit(0.5), F.col("w")).alias("median_s"),
        F.min("d").cast("double").alias("min_s"),
        F.max("d").cast("double").alias("max_s"),
    )
    # n * sum(d^2) - sum(d)^2 in whole numbers, so nothing cancels.
    n, sd = F.col("n").cast("decimal(13,0)"), F.col("sd").cast("decimal(18,0)")
    spread = (n * F.col("sdd") - sd * sd).cast("double")
    count = F.col("n").cast("double")
    return sums.select(
        *keys,
        F.coalesce("n", F.lit(0)).alias("n_intervals"),
        F.when(count > 0, F.col("sd") / count).alias("mean_s"),
        "median_s",
        F.when(count > 1, F.sqrt(spread / (count * (count - 1)))).alias("std_s"),
        "min_s",
        "max_s",
    )


def interval_stats(df: DataFrame, time: str, keys: Sequence[str] = ()) -> DataFrame:
    """Count, mean, exact median, sample deviation, least and greatest interval."""
    return _stats_of(interval_histogram(df, time, keys), keys)


def _with_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add mean and deviation: by join per series, as a scalar for a single one."""
    if keys:
        return match(df, stats.select(*keys, "mean_s", "std_s"), keys)
    limits = stats.select(F.struct("mean_s", "std_s")).scalar()
    return df.withColumn("_limits", limits).select(*df.columns, "_limits.*")


def _irregular(interval):
    return F.abs(interval - F.col("mean_s")) > 2 * F.col("std_s")


def irregular_intervals(df: DataFrame, time: str, keys: Sequence[str] = ()) -> DataFrame:
    """Intervals more than two deviations from the mean: number and percentage."""
    histogram = interval_histogram(df, time, keys)
    marked = _with_stats(histogram, _stats_of(histogram, keys), keys)
    return (
        marked.groupBy(*keys)
        .agg(
            F.coalesce(F.sum(F.when(_irregular(F.col("d")), F.col("w"))), F.lit(0)).alias("irregular"),
            F.coalesce(F.sum("w"), F.lit(0)).alias("n_intervals"),
        )
        .withColumn(
            "irregular_pct", F.col("irregular") * 100.0 / F.greatest("n_intervals", F.lit(1))
        )
    )


def irregular_rows(df: DataFrame, time: str, keys: Sequence[str] = ()) -> DataFrame:
    """The irregular intervals themselves, by the time at which each ends."""
    stats = interval_stats(df, time, keys)
    entries = F.array(
        F.struct((F.col("t") - F.col("prev_t")).alias("d"), F.lit(1).cast("bigint").alias("w")),
        F.struct(F.lit(0).cast("bigint").alias("d"), (F.col("n") - 1).alias("w")),
    )
    rows = (
        intervals(df, time, keys)
        .select(*keys, "t", F.explode(entries).alias("e"))
        .select(*keys, "t", "e.d", "e.w")
        .where("d IS NOT NULL AND w > 0")
    )
    return (
        _with_stats(rows, stats, keys)
        .where(_irregular(F.col("d")))
        .select(*keys, F.col("t").alias(time), F.col("d").alias("interval_s"), F.col("w").alias("occurrences"))
    )


def duplicate_times(df: DataFrame, time: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows beyond the first per time."""
    per_time = df.groupBy(*keys, time).agg(F.count(F.lit(1)).alias("n"))
    return per_time.groupBy(*keys).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )


def _arrivals(df: DataFrame, time: str, order: str, keys: Sequence[str]) -> DataFrame:
    """Each row with the time of the row that arrived before. Arrival numbers may lie
    any distance apart: their ranks, which have no gaps, cut the series into blocks.
    Decimal ones may be beyond bigint."""
    number = F.col(order)
    if not isinstance(df.schema[order].dataType, T.DecimalType):
        number = number.cast("bigint")
    rows = ranked(df.select(*keys, number.alias(order), time), keys, order)
    return with_previous(rows, keys, "_rank", {"prev_time": time})


def out_of_order_rows(df: DataFrame, time: str, order: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows whose time is earlier than that of the row that arrived before.
    ``order`` is the arrival number, unique per series. Equal times are in order."""
    return (
        _arrivals(df, time, order, keys)
        .where(F.col(time) < F.col("prev_time"))
        .select(*keys, order, time, "prev_time")
    )


def out_of_order(df: DataFrame, time: str, order: str, keys: Sequence[str] = ()) -> DataFrame:
    """Number and percentage of rows that arrived out of order."""
    late = F.count_if(F.col(time) < F.col("prev_time"))
    return (
        _arrivals(df, time, order, keys)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"), late.alias("out_of_order"))
        .withColumn(
            "out_of_order_pct", F.col("out_of_order") * 100.0 / F.greatest("n_rows", F.lit(1))
        )
    )


def _entry(metric: str, value, column=None):
    return F.struct(
        F.lit(metric).alias("metric"),
        F.lit(column).cast("string").alias("column_name"),
        value.cast("double").alias("value"),
    )


def _tidy(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    entries = F.array(*[_entry(m, F.col(m)) for m in metrics])
    return df.select("table_name", F.explode(entries).alias("e")).select("table_name", "e.*")


def _missing(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count and missing values (null or NaN) per column of each table."""
    parts = []
    for label, df in tables.items():
        total = F.count(F.lit(1))
        entries = [_entry("n_rows", total)]
        for c in df.columns:
            n = F.count_if(F.col(c).isNull())
            percent = n * 100.0 / F.greatest(total, F.lit(1))
            entries += [_entry("missing", n, c), _entry("missing_pct", percent, c)]
        rows = nan_to_null(df).agg(F.array(*entries).alias("e"))
        parts.append(rows.select(F.lit(label).alias("table_name"), F.explode("e").alias("e")).select("table_name", "e.*"))
    return union_all(parts).where((F.col("metric") == "n_rows") | (F.col("value") > 0))


def quality_report_all(
    tables: dict[str, DataFrame], time: str = "datetime_utc", order: str | None = "id"
) -> DataFrame:
    """All checks of several tables as (table_name, metric, column_name, value) rows.

    One pruned scan of each table per kind of check: missing values, times, arrival
    order. The last two run once over all tables, each table being a series. Duplicates
    are the intervals of zero. Tables without the time column get the first part only.
    """
    parts = [_missing(tables)]
    label = lambda name: F.lit(name).alias("table_name")
    timed = {name: df for name, df in tables.items() if time in df.columns}
    if timed:
        keys = ("table_name",)
        times = union_all([df.select(label(name), F.col(time).cast("bigint").alias(time)) for name, df in timed.items()])
        histogram = interval_histogram(times, time, keys)
        found = _stats_of(histogram, keys)
        # Tables with fewer than two times have no interval, but a row in the report.
        names = times.sparkSession.createDataFrame([(name,) for name in timed], "table_name string")
        weight = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("w"))), F.lit(0))
        counts = _with_stats(histogram, found, keys).groupBy(*keys).agg(
            weight(F.col("d") == 0).alias("duplicates"),
            weight(_irregular(F.col("d"))).alias("irregular"),
            (weight(_irregular(F.col("d"))) * 100.0 / F.coalesce(F.sum("w"), F.lit(1))).alias("irregular_pct"),
        )
        stats = names.join(found, "table_name", "left").na.fill(0, ["n_intervals"])
        counts = names.join(counts, "table_name", "left").na.fill(0)
        parts.append(_tidy(stats, ("n_intervals", "mean_s", "median_s", "std_s", "min_s", "max_s")))
        parts.append(_tidy(counts, ("duplicates", "irregular", "irregular_pct")))
    ordered = {name: df for name, df in timed.items() if order and order in df.columns}
    if ordered:
        arrivals = union_all([
            df.select(label(name), F.col(order).cast("bigint").alias(order), F.col(time).cast("bigint").alias(time))
            for name, df in ordered.items()
        ])
        late = out_of_order(arrivals, time, order, ("table_name",))
        names = arrivals.sparkSession.createDataFrame([(name,) for name in ordered], "table_name string")
        late = names.join(late, "table_name", "left").na.fill(0)
        parts.append(_tidy(late, ("out_of_order", "out_of_order_pct")))
    return union_all(parts)


def quality_report(df: DataFrame, label: str, time: str = "datetime_utc", order: str | None = "id") -> DataFrame:
    """All checks of one table."""
    return quality_report_all({label: df}, time, order)
