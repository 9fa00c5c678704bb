"""Reports by stretches, footers, buckets, data skipping by key, items of unknown fields."""

import random

import pytest
from pyspark.sql import functions as F, types as T

from frames import T0, generated, table
from tidemark.operators.quality import interval_histogram, quality_report
from tidemark.plans.checks import RANK_ERROR, check_news
from tidemark.plans.incremental import summary_mark
from tidemark.plans.summary import summarize
from tidemark.sinks import snapshots
from tidemark.sinks.buckets import append_once_bucketed, create_buckets, new_rows
from tidemark.sinks.files import commit_rows, write_parquet
from tidemark.sources import schemas
from tidemark.sources.footers import extent_by_footers, extent_plan, pushed_aggregation
from tidemark.sources.tables import item_fields, long_frame, read_items_untyped, read_summary
from tidemark import Params


def metrics(report):
    left_out = ("irregular", "irregular_pct", "out_of_order", "out_of_order_pct")
    return {(r.table_name, r.metric, r.column_name): r.value for r in report.collect() if r.metric not in left_out}


@pytest.mark.parametrize("cuts", [(), (1, 2, 400)])
def test_stretches_put_together_equal_the_whole(spark, tmp_path, cuts):
    r = random.Random(len(cuts))
    seconds = sorted(r.choice([r.randrange(300), r.randrange(2000)]) for _ in range(700))
    df = table(spark, [T0 + s for s in seconds], v=[None if r.random() < 0.2 else 1.0 for _ in seconds])
    for cut in (*[T0 + c for c in cuts], None):
        part = df if cut is None else df.where(f"datetime_utc <= {cut}")
        got = metrics(check_news(spark, {"t": part}, str(tmp_path / "r")))
    want = metrics(quality_report(df, "t"))
    assert got.keys() == want.keys()
    for k, value in want.items():
        if k[1] != "median_s":
            assert got[k] == pytest.approx(value, rel=1e-12), k
    histogram = interval_histogram(df, "datetime_utc")
    near = [0.5 - RANK_ERROR, 0.5 + RANK_ERROR]
    low, high = histogram.agg(F.percentile("d", F.array(*map(F.lit, near)), F.col("w"))).first()[0]
    assert int(low) <= got["t", "median_s", None] <= -int(-high)


def test_a_second_run_reads_only_what_is_new(spark, tmp_path):
    path = str(tmp_path / "r")
    df = table(spark, [T0 + i for i in range(20)], v=[1.0] * 20)
    check_news(spark, {"t": df}, path)
    poison = F.when(F.col("datetime_utc") <= T0 + 19, F.raise_error(F.lit("read twice"))).otherwise(F.col("v"))
    more = table(spark, [T0 + i for i in range(30)], v=[1.0] * 30).withColumn("v", poison)
    report = metrics(check_news(spark, {"t": more}, path))
    assert report["t", "n_rows", None] == 30 and report["t", "n_intervals", None] == 29
    version = snapshots.load(spark, path).version
    assert metrics(check_news(spark, {"t": more}, path)) == report
    assert snapshots.load(spark, path).version == version


def test_reports_of_empty_and_tiny_tables(spark, tmp_path):
    one = table(spark, [T0], v=[None])
    got = metrics(check_news(spark, {"none": one.limit(0), "one": one}, str(tmp_path / "r")))
    assert got["none", "n_rows", None] == 0 and got["one", "n_rows", None] == 1
    assert got["one", "median_s", None] is None and got["one", "missing_pct", "v"] == 100
    same = table(spark, [T0] * 3, v=[1.0] * 3)
    got = metrics(check_news(spark, {"same": same}, str(tmp_path / "s")))
    assert (got["same", "duplicates", None], got["same", "median_s", None], got["same", "max_s", None]) == (2, 0, 0)


def test_many_runs_become_one_summary(spark, tmp_path, monkeypatch):
    from tidemark.plans import checks

    monkeypatch.setattr(checks, "RUNS", 2)
    path, df = str(tmp_path / "r"), table(spark, [T0 + i * i for i in range(30)], v=[1.0] * 30)
    for n in (5, 9, 20, 30):
        got = metrics(check_news(spark, {"t": df.where(f"id < {n}")}, path))
    want = metrics(quality_report(df, "t"))
    assert {k: v for k, v in got.items() if k[1] != "median_s"} == pytest.approx(
        {k: v for k, v in want.items() if k[1] != "median_s"}
    )
    assert len(snapshots.load(spark, path).facts["stretches"]) <= 2


def test_footers_answer(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100, 1100).select(F.col("id").alias("datetime_utc"), F.lit("x").alias("name")).repartition(3).write.parquet(path)
    assert extent_by_footers(spark, path) == [{"first": 100, "last": 1099, "n_rows": 1000}]
    with pushed_aggregation(spark):
        plan = extent_plan(spark, path, "datetime_utc")
        text = plan._jdf.queryExecution().toString()
        scan = next(line for line in text.splitlines() if "PushedAggregation" in line)
        assert "MAX(datetime_utc)" in scan and "COUNT(*)" in scan and "PushedAggregation: []" not in scan
    assert spark.conf.get("spark.sql.sources.useV1SourceList").count("parquet") == 1


def test_the_mark_of_a_table_without_a_log_comes_from_footers(spark, tmp_path):
    path, params = str(tmp_path / "s"), Params(step="10s", partition_hours=1)
    rows = summarize(long_frame(generated(spark, 100)), params)
    write_parquet(rows, path, "append", 1)
    assert summary_mark(spark, path) == rows.agg(F.max("datetime_utc")).first()[0]
    snapshots.opened(spark, path)
    assert summary_mark(spark, path) == rows.agg(F.max("datetime_utc")).first()[0]
    assert summary_mark(spark, str(tmp_path / "none")) is None


def test_looking_for_stored_rows_moves_none(spark, tmp_path):
    name = "bucketed_rows"
    create_buckets(spark, name, str(tmp_path / "b"), "datetime_utc BIGINT, v BIGINT", ["datetime_utc"], 4)
    rows = lambda low, high: spark.range(low, high).select(F.col("id").alias("datetime_utc"), (F.col("id") * 2).alias("v"))
    try:
        for low, high in ((0, 500), (300, 900), (0, 500)):
            append_once_bucketed(rows(low, high), name)
        assert sorted(r.datetime_utc for r in spark.table(name).collect()) == list(range(900))
        plan = new_rows(rows(0, 2000), name, ["datetime_utc"])._jdf.queryExecution().executedPlan().toString()
        stored = plan[plan.index("SortMergeJoin") :].split("FileScan parquet spark_catalog")[0]
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        # The one exchange is that of the new rows, above their range.
        assert "Range" in stored[stored.index("Exchange hashpartitioning") :]
    finally:
        spark.sql(f"DROP TABLE {name}")


def _scan_metric(df, name):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply(name).value() for i in range(leaves.size()))


def test_one_series_reads_few_rows(spark, tmp_path):
    keys = T.StructType([T.StructField("ship", T.LongType())])
    n, ships = 40_000, 40
    values = [F.lit(1.0).alias(c) for c in schemas.SUMMARY_VALUES]
    rows = spark.range(n).select((F.col("id") % ships * 3).alias("ship"), (T0 + F.col("id")).alias("datetime_utc"), *values)
    plain, clustered = str(tmp_path / "p"), str(tmp_path / "c")
    commit_rows(rows, snapshots.opened(spark, plain), 24)
    commit_rows(rows, snapshots.opened(spark, clustered), 24, cluster=["ship"])
    of = lambda path, ship: read_summary(spark, path, keys=keys).where(F.col("ship") == ship).select("datetime_utc")
    assert of(plain, 9).count() == of(clustered, 9).count() == n // ships
    assert _scan_metric(of(plain, 9), "numOutputRows") == n
    assert _scan_metric(of(clustered, 9), "numOutputRows") <= 3 * 2_000
    # A ship that lies between the least and the greatest, and is not there: the Bloom filter says so.
    assert _scan_metric(of(clustered, 10), "numOutputRows") == 0


def test_items_of_unknown_fields(spark):
    rows = [
        ("2023-01-01T00:00:00Z", '{"a": 1, "b": "x", "c": {"d": 1.5}}'),
        ("2023-01-01T00:00:01Z", '{"a": 2.5, "e f": true}'),
        ("2023-01-01T00:00:02Z", "no json"),
        ("2023-01-01T00:00:03Z", None),
        ("2023-01-01T00:00:04Z", '{"b": null, "it\'s": 7, "x\'\\\\\\"y": 8}'),
    ]
    items = spark.createDataFrame(rows, "datetime_utc string, item string")
    assert {f.name: f.dataType.simpleString() for f in item_fields(items)} == {
        "a": "double", "b": "string", "c": "struct<d:double>", "e f": "boolean", "it's": "bigint", "x'\\\"y": "bigint",
    }
    got = [r.asDict(True) for r in read_items_untyped(items).orderBy("datetime_utc").collect()]
    assert [r["datetime_utc"] - T0 for r in got] == [0, 1, 2, 3, 4]
    assert got[0] | {"datetime_utc": 0} == {"datetime_utc": 0, "a": 1.0, "b": "x", "c": {"d": 1.5}, "e f": None, "it's": None, "x'\\\"y": None}
    assert (got[1]["a"], got[1]["e f"], got[4]["it's"], got[4]["x'\\\"y"], got[2]["a"]) == (2.5, True, 7, 8, None)
    assert read_items_untyped(items.limit(0)).columns == ["datetime_utc"]
