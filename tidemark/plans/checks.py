"""Quality reports that read each raw row once.

A run reads the rows of each table that are later than those of the run before, and keeps a
summary of them: counts, missing values, sums of the intervals and their squares, the least and
the greatest, and a KLL sketch of their order. Summaries of stretches that follow each other in
time are put together without the rows; the interval between two of them is known from their
ends. So a report costs as much as what is new. Rows that arrive with a time already passed
are not in it (``late_readings`` counts those of a stream).

The median comes from the sketch: its rank is within ``RANK_ERROR`` of a half. All else is exact.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tidemark.functions.rows import nan_to_null
from tidemark.operators.lookup import union_all
from tidemark.operators.quality import intervals
from tidemark.sinks import snapshots

#: Size of the sketches, the ranks they are asked for, and how far the rank of the median may
#: be off for both.
K, STEPS, RANK_ERROR = 1600, 1000, 0.005
#: So many runs are put together into one.
RUNS = 20

_SUM = T.DecimalType(38, 0)
STRETCH = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        *(T.StructField(c, T.LongType()) for c in ("first_t", "last_t", "n_rows")),
        T.StructField("missing", T.MapType(T.StringType(), T.LongType())),
        *(T.StructField(c, T.LongType()) for c in ("duplicates", "n_steps")),
        *(T.StructField(c, _SUM) for c in ("sum_d", "sum_dd")),
        *(T.StructField(c, T.LongType()) for c in ("least", "greatest")),
        T.StructField("sketch", T.BinaryType()),
    ]
)


def stretch_of(df: DataFrame, label: str, time: str = "datetime_utc") -> DataFrame:
    """The summary of some rows of a table; ``n_steps`` counts intervals between different times."""
    rows = nan_to_null(df)
    counts = rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.map_from_arrays(
            F.array(*[F.lit(c) for c in df.columns]),
            F.array(*[F.count_if(F.col(c).isNull()) for c in df.columns]),
        ).alias("missing"),
    )
    d = F.col("t") - F.col("prev_t")
    wide = d.cast("decimal(19,0)")
    steps = intervals(df, time).agg(
        F.min("t").alias("first_t"),
        F.max("t").alias("last_t"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
        F.count(d).alias("n_steps"),
        F.sum(wide).cast(_SUM).alias("sum_d"),
        F.sum((wide * wide).cast(_SUM)).cast(_SUM).alias("sum_dd"),
        F.min(d).alias("least"),
        F.max(d).alias("greatest"),
        F.kll_sketch_agg_bigint(d, F.lit(K)).alias("sketch"),
    )
    # One row each.
    return counts.join(steps, how="cross").select(F.lit(label).alias("table_name"), *STRETCH.names[1:])


def put_together(stretches: DataFrame) -> DataFrame:
    """One summary per table of stretches that don't overlap; a row of the same form."""
    order = Window.partitionBy("table_name").orderBy("first_t")
    between = F.col("first_t") - F.lag("last_t").over(order)
    rows = stretches.where("first_t IS NOT NULL").withColumn("gap", between)
    empty = stretches.where("first_t IS NULL").withColumn("gap", F.lit(None).cast("bigint"))
    gap = F.col("gap").cast("decimal(19,0)")
    zero = lambda c: F.coalesce(c, F.lit(0).cast(_SUM))
    entries = F.explode("missing").alias("name", "n")
    missing = (
        stretches.select("table_name", entries)
        .groupBy("table_name", "name")
        .agg(F.sum("n").alias("n"))
        .groupBy("table_name")
        .agg(F.map_from_entries(F.collect_list(F.struct("name", "n"))).alias("missing"))
    )
    merged = rows.unionByName(empty).groupBy("table_name").agg(
        F.min("first_t").alias("first_t"),
        F.max("last_t").alias("last_t"),
        F.sum("n_rows").alias("n_rows"),
        F.sum("duplicates").alias("duplicates"),
        (F.sum("n_steps") + F.count("gap")).alias("n_steps"),
        (zero(F.sum("sum_d")) + zero(F.sum(gap))).cast(_SUM).alias("sum_d"),
        (zero(F.sum("sum_dd")) + zero(F.sum((gap * gap).cast(_SUM)))).cast(_SUM).alias("sum_dd"),
        F.least(F.min("least"), F.min("gap")).alias("least"),
        F.greatest(F.max("greatest"), F.max("gap")).alias("greatest"),
        F.kll_merge_agg_bigint("sketch").alias("stretches"),
        F.kll_sketch_agg_bigint("gap", F.lit(K)).alias("gaps"),
    )
    sketch = F.kll_sketch_merge_bigint("stretches", "gaps").alias("sketch")
    joined = merged.join(missing, "table_name", "left")
    return joined.select(*[sketch if c == "sketch" else F.col(c) for c in STRETCH.names])


def check_news(
    spark: SparkSession, tables: Mapping[str, DataFrame], path: str, time: str = "datetime_utc"
) -> DataFrame:
    """Read what is new in ``tables``, add it to what is kept at ``path``, and report on all.

    The first run also reads rows without a time. Marks and summaries change in one commit.
    """
    base = snapshots.opened(spark, path)
    marks, kept = dict(base.facts.get("marks") or {}), list(base.facts.get("stretches") or [])
    parts = [
        stretch_of(df if label not in marks else df.where(F.col(time) > marks[label]), label, time)
        for label, df in tables.items()
    ]
    fresh = union_all(parts)
    if len(kept) >= RUNS:
        old = put_together(snapshots.aside(spark, base, kept, STRETCH))
        fresh, kept = old.unionByName(fresh), []
    name = snapshots.put_aside(fresh.coalesce(1), base, "stretches")
    made = snapshots.aside(spark, base, [name], STRETCH)
    seen = made.groupBy("table_name").agg(F.max("last_t").alias("t"), F.sum("n_rows").alias("n")).collect()
    marks |= {r.table_name: r.t for r in seen if r.t is not None}
    if any(r.n for r in seen):
        base = snapshots.commit(spark, base, facts={"marks": marks, "stretches": [*kept, name]})
    return report_of(snapshots.aside(spark, base, base.facts.get("stretches") or [name], STRETCH))


def report_of(stretches: DataFrame) -> DataFrame:
    """(table_name, metric, column_name, value) of summaries: the metrics of ``quality_report``
    but irregular intervals and arrival order, which need the rows."""
    rows = put_together(stretches)
    n = (F.col("n_steps") + F.col("duplicates")).cast("decimal(19,0)")
    count = n.cast("double")
    spread = (n * F.col("sum_dd") - F.col("sum_d") * F.col("sum_d")).cast("double")
    # Intervals of zero come first: the middle of all is this rank among the others.
    rank = F.try_divide(count / 2 - F.col("duplicates"), F.col("n_steps"))
    # Ranks that a sketch is asked for have to be constants.
    steps = F.kll_sketch_get_quantile_bigint("sketch", F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)]))
    at = F.greatest(F.least(F.round(rank * STEPS), F.lit(STEPS)), F.lit(0)).cast("int")
    median = F.when((count > 0) & (count / 2 <= F.col("duplicates")), F.lit(0.0)).when(F.col("n_steps") > 0, F.get(steps, at).cast("double"))
    has_zero = F.col("duplicates") > 0
    entry = lambda metric, value, column=None: F.struct(
        F.lit(metric).alias("metric"), F.lit(column).cast("string").alias("column_name"), value.cast("double").alias("value")
    )
    whole = F.array(
        entry("n_rows", F.col("n_rows")),
        entry("n_intervals", count),
        entry("mean_s", F.when(count > 0, F.coalesce(F.col("sum_d").cast("double"), F.lit(0.0)) / count)),
        entry("median_s", median),
        entry("std_s", F.when(count > 1, F.sqrt(spread / (count * (count - 1))))),
        entry("min_s", F.when(has_zero, F.lit(0)).otherwise(F.col("least"))),
        entry("max_s", F.coalesce("greatest", F.when(has_zero, F.lit(0)))),
        entry("duplicates", F.col("duplicates")),
    )
    by_column = rows.select("table_name", "n_rows", F.explode("missing").alias("column_name", "n")).where("n > 0")
    percent = F.col("n") * 100.0 / F.greatest("n_rows", F.lit(1))
    entries = F.array(
        F.struct(F.lit("missing").alias("metric"), "column_name", F.col("n").cast("double").alias("value")),
        F.struct(F.lit("missing_pct").alias("metric"), "column_name", percent.alias("value")),
    )
    inline = lambda df, array: df.select("table_name", F.explode(array).alias("e")).select("table_name", "e.*")
    return inline(rows, whole).unionByName(inline(by_column, entries))
