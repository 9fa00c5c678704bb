"""What the plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import tidemark.queries as queries
from compare import TESTDATA
from tidemark.operators import lookup, quality, trailing
from tidemark.operators.nearest import nearest_align, nearest_fill
from tidemark.operators.trailing import rolling_mean, rolling_mean_time
from tidemark.params import HOUR
from tidemark.plans.summary import summarize
from tidemark.sources.events import long_events, timed_events

SF_DIR = str(TESTDATA / "sf0.001")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("Initial Plan")[0]


def nodes(text, name):
    return re.findall(rf"\b{name}\b", text)


def windows_without_key(text):
    """Window nodes whose specification has no partition column."""
    return [
        w for w in re.findall(r"windowspecdefinition\(([^()]*)", text)
        if "ASC" in w.split(",")[0]
    ]


def test_alignment_is_one_hash_aggregation(spark):
    text = plan(nearest_align(long_events(spark, SF_DIR), HOUR, start_us=0))
    assert len(nodes(text, "hashpartitioning")) == 1
    assert not nodes(text, "SortAggregate")
    assert len(nodes(text, "FileScan")) == 1
    assert "PushedFilters: [IsNotNull(ts), In(event_type" in text
    assert "props" not in text and "user_id" not in text


def test_fill_aggregates_before_it_orders(spark):
    text = plan(nearest_fill(long_events(spark, SF_DIR), HOUR))
    assert not nodes(text, "SortAggregate")
    first_window = text[text.index("Window ["):]
    assert first_window.index("HashAggregate") < first_window.index("FileScan")


@pytest.mark.parametrize("make", [
    lambda s: summarize(long_events(s, SF_DIR), queries.LIVE),
    lambda s: summarize(long_events(s, SF_DIR), queries.BATCH),
    lambda s: quality.interval_stats(timed_events(s, SF_DIR), "datetime_utc"),
    lambda s: quality.out_of_order(timed_events(s, SF_DIR), "datetime_utc", "event_id"),
    lambda s: rolling_mean(timed_events(s, SF_DIR).select("event_id", "value"), (), "event_id", 60, {"m": "value"}),
])
def test_unkeyed_windows_see_heads_and_tails_only(spark, make):
    """The one window over a whole series takes rows that two block levels let through."""
    lines = plan(make(spark)).split("\n")
    found = 0
    for i, line in enumerate(lines):
        if "Window [" in line and windows_without_key(line):
            found += 1
            below = "\n".join(lines[i:]).split("FileScan")[0]
            assert len(re.findall(r"windowspecdefinition\([^()]*_block", below)) >= 2
    assert found


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if "incremental" not in n and "stream" not in n])
def test_no_python_in_the_plans(spark, name):
    text = plan(queries.QUERIES[name](spark, SF_DIR))
    assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups|PythonUDF", text)
    assert "CartesianProduct" not in text


def test_marks_reach_the_scan(spark):
    for name in ("scan_after_mark", "ordered_scan"):
        text = plan(queries.QUERIES[name](spark, SF_DIR))
        assert "GreaterThanOrEqual(ts,2024-01-11T00:00:01)" in text


def test_one_pass_finds_a_row(spark):
    rows = lookup.representative_row(timed_events(spark, SF_DIR).select("datetime_utc", "value"))
    assert len(nodes(plan(rows), "FileScan")) == 1


def test_time_window_orders_running_sums_only(spark):
    """No frame looks back over the rows of a long window."""
    rows = long_events(spark, SF_DIR).where("source = 'ph'")
    text = plan(rolling_mean_time(rows, (), "us", "ph_total", 30 * 24 * HOUR))
    frames = re.findall(r"specifiedwindowframe\((\w+), ([^,)]+)", text)
    assert any(kind == "RowFrame" and n.startswith("unboundedpreceding") for kind, n in frames)
    assert all(int(n) >= -(trailing.BLOCKS + 1) * 16_384 * 1_000_000 for kind, n in frames if kind == "RangeFrame")


def test_few_rows_per_task_for_sparse_arrival_numbers(spark):
    """Ranks have no gaps, so hardly a row goes up to the window over the whole series."""
    rows = spark.range(100_000).select((F.col("id") * 2**40).alias("n"), F.col("id").alias("t"))
    first, *above = trailing.trailing_levels(
        trailing.ranked(rows, (), "n"), (), "_rank", 2, {"p": lambda w: F.lag("t", 1).over(w)}
    )
    assert first.count() > 99_000 and sum(x.count() for x in above) < 100


def test_report_reads_each_table_once_per_check(spark):
    """Two scans of a table for two kinds of check, three with arrival numbers."""
    rows = timed_events(spark, SF_DIR).select("event_id", "datetime_utc", "value")
    for order, most in ((None, 3), ("event_id", 5)):
        text = final_plan(quality.quality_report_all({"a": rows, "b": rows}, order=order))
        assert len(nodes(text, "FileScan")) <= 2 * most


def test_levels_share_the_scan(spark):
    assert len(nodes(final_plan(nearest_fill(long_events(spark, SF_DIR), HOUR)), "FileScan")) == 1
    assert len(nodes(final_plan(quality.interval_stats(timed_events(spark, SF_DIR), "datetime_utc")), "FileScan")) == 1
