import json

import pytest
from pyspark.sql import Row, functions as F, types as T

from frames import T0, table
from tidemark.functions.rows import to_items
from tidemark.operators import lookup
from tidemark.operators.aggregate import drop_repeats, duplicate_examples, first_arrival, freshness, not_in
from tidemark.sinks.files import append_once, append_table, write_csv, write_parquet
from tidemark.sinks.items import current_items, put_items, write_items
from tidemark.sources import schemas
from tidemark.sources.tables import (
    last_output_time,
    long_frame,
    read_item_files,
    read_items,
    read_or_empty,
)


ROW = T.StructType([T.StructField("datetime_utc", T.LongType()), T.StructField("v", T.DoubleType())])


def stored(spark, path):
    return sorted((r.datetime_utc - T0, r.v) for r in spark.read.parquet(path).collect())


def rows(spark, seconds, values):
    return table(spark, [T0 + s for s in seconds], v=values)


def test_append_once(spark, tmp_path):
    path = str(tmp_path / "t")
    append_once(rows(spark, [0, 60, 60], [1, 2, 3]), path, ROW, 6, order="id")
    append_once(rows(spark, [60, 120], [9, 4]), path, ROW, 6, since=T0 + 60)
    append_once(rows(spark, [0, 60, 120], [7, 7, 7]), path, ROW, 6)
    append_once(rows(spark, [], []), path, ROW, 6)
    assert stored(spark, path) == [(0, 1), (60, 2), (120, 4)]


def test_rows_without_a_time_are_stored_once(spark, tmp_path):
    path = str(tmp_path / "t")
    undated = spark.createDataFrame([(None, 5.0), (T0, 1.0)], ROW)
    for since in (None, T0, T0):
        append_once(undated, path, ROW, 6, since=since)
    assert spark.read.parquet(path).where("datetime_utc IS NULL").count() == 1
    assert spark.read.parquet(path).count() == 2


def test_first_arrival_of_rows_without_number(spark):
    rows = spark.createDataFrame([(1, None, "a"), (1, 2, "b"), (2, None, "c")], "k int, n bigint, v string")
    assert sorted(tuple(r) for r in first_arrival(rows, ["k"], "n").collect()) == [(1, 2, "b"), (2, None, "c")]


def test_append_once_per_series(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = T.StructType([T.StructField("ship", T.StringType()), *ROW.fields])
    a, b = (rows(spark, [0, 60], [1, 2]).withColumn("ship", F.lit(s)) for s in "ab")
    append_once(a, path, schema, 6, keys=["ship"])
    append_once(a.unionByName(b), path, schema, 6, keys=["ship"])
    assert spark.read.parquet(path).count() == 4


def test_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    write_parquet(rows(spark, [0, 3600, 7 * 3600], [1, 2, 3]), path, "append", 6)
    write_parquet(rows(spark, [3601], [4]), path, "append", 6)
    assert sorted(p.name for p in (tmp_path / "t").glob("partition=*")) == [
        "partition=2023-01-01-00", "partition=2023-01-01-06",
    ]
    assert len(stored(spark, path)) == 4


def test_one_file_per_small_partition(spark, tmp_path):
    df = spark.range(0, 4000, 1, 8).select((F.col("id") * 10 + T0).alias("datetime_utc"), "id")
    write_parquet(df, str(tmp_path / "t"), "append", 6)
    parts = list((tmp_path / "t").glob("partition=*"))
    assert len(parts) == 2 and all(len(list(p.glob("*.parquet"))) == 1 for p in parts)


def test_time_lookups_skip_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    write_parquet(rows(spark, [3600 * h for h in range(48)], range(48)), path, "append", 6)
    df = read_or_empty(spark, path, schemas.partitioned(ROW))
    late = lookup.since(df, T0 + 40 * 3600, partition_hours=6)
    some = lookup.between(df, T0 + 3600, T0 + 3 * 3600, partition_hours=6)
    assert sorted(r.v for r in late.collect()) == list(range(41, 48))
    assert sorted(r.v for r in some.collect()) == [1, 2, 3]
    scan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition" in scan


def test_latest_and_first(spark):
    df = rows(spark, [3, 1, 2], [30, 10, 20])
    assert [r.v for r in lookup.latest(df, 2).collect()] == [30, 20]
    assert [r.v for r in lookup.first_rows(df, 2).collect()] == [10, 20]


@pytest.mark.parametrize("values, picked", [([None, 2, 3], 1), ([None, None, None], 1), ([None], 0), ([5, 6], 0)])
def test_representative_row(spark, values, picked):
    df = rows(spark, range(len(values)), values)
    assert lookup.representative_row(df).first().datetime_utc == T0 + picked


def test_csv(spark, tmp_path):
    path = str(tmp_path / "c")
    write_csv(rows(spark, [0], [1.5]), path)
    write_csv(rows(spark, [60], [2.5]), path)
    back = spark.read.option("header", True).schema("id bigint, datetime_utc bigint, v double").csv(path)
    assert sorted(r.v for r in back.collect()) == [1.5, 2.5]
    assert last_output_time(spark, path, "csv") == T0 + 60


def test_last_output_time(spark, tmp_path):
    assert last_output_time(spark, str(tmp_path / "none")) is None
    path = str(tmp_path / "t")
    write_parquet(rows(spark, [0, 60], [1, 2]).withColumn("datetime_utc", F.timestamp_seconds("datetime_utc")), path)
    assert last_output_time(spark, path) == T0 + 60
    with pytest.raises(ValueError):
        last_output_time(spark, path, "xlsx")


def test_append_table_stores_seconds(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.sql("SELECT TIMESTAMP'2023-01-01 00:00:01.75' AS datetime_utc, 1D AS v")
    append_table(df, path)
    append_table(df, path)
    assert stored(spark, path) == [(1, 1.0), (1, 1.0)]


def test_only_absence_is_tolerated(spark, tmp_path):
    assert read_or_empty(spark, str(tmp_path / "none"), schemas.GPS).count() == 0
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_or_empty(spark, str(tmp_path / "bad"), schemas.GPS).count()
    with pytest.raises(Exception):
        read_or_empty(spark, str(tmp_path / "none"), schemas.GPS, fmt="no_such_format")


def test_scan_after_a_mark_is_pushed_down(spark, tmp_path):
    path = str(tmp_path / "t")
    rows(spark, range(10), range(10)).write.parquet(path)
    long = long_frame({"rhodamine": spark.read.parquet(path).withColumnRenamed("v", "rho_ppb")}, T0 + 4)
    assert long.count() == 5
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThan(datetime_utc,{T0 + 4})" in plan


def file_writer(folder, refuse=None):
    """Stands for a key-value store: one file per batch, some batches refused."""
    folder = str(folder)

    def write(batch):
        assert len(batch) <= 25
        if refuse and any(item["datetime_utc"] == refuse for item in batch):
            raise RuntimeError("refused")
        name = batch[0]["datetime_utc"].replace(":", "")
        with open(f"{folder}/{name}.json", "w") as f:
            json.dump([{k: str(v) for k, v in item.items()} for item in batch], f)

    return write


def test_item_batches(spark, tmp_path):
    items = to_items(rows(spark, [60 * i for i in range(60)], range(60))).coalesce(1)
    assert write_items(items, file_writer(tmp_path)) == (60, 0)
    files = sorted(tmp_path.glob("*.json"))
    assert [len(json.loads(f.read_text())) for f in files] == [25, 25, 10]
    assert write_items(items, file_writer(tmp_path, refuse="2023-01-01T00:30:00Z")) == (35, 25)
    assert write_items(items.limit(0), file_writer(tmp_path)) == (0, 0)


def test_last_put_wins(spark, tmp_path):
    path = str(tmp_path / "items")
    put_items(to_items(rows(spark, [0, 60], [1, 2])), path, 1)
    put_items(to_items(rows(spark, [60, 120], [5, 6])), path, 2)
    fields = T.StructType([T.StructField("v", T.DoubleType())])
    got = read_items(current_items(spark, path), fields)
    assert sorted((r.datetime_utc - T0, r.v) for r in got.collect()) == [(0, 1), (60, 5), (120, 6)]


def test_item_files(spark, tmp_path):
    (tmp_path / "x.json").write_text(
        '{"static_partition":"data","datetime_utc":"2023-01-01T00:00:01Z","v":1.5}\n{"datetime_utc":"later","v":2}\n'
    )
    got = read_item_files(spark, str(tmp_path), ROW).orderBy("v").collect()
    assert [(r.datetime_utc, r.v) for r in got] == [(T0 + 1, 1.5), (None, 2.0)]


def test_repeats_are_counted(spark):
    kept, seen = drop_repeats(rows(spark, [0, 0, 1, 0], [4, 3, 2, 1]), ["datetime_utc"], "id")
    assert sorted((r.datetime_utc - T0, r.v) for r in kept.collect()) == [(0, 4), (1, 2)]
    assert seen.get == {"rows_in": 4, "times": 2}
    assert duplicate_examples(rows(spark, [0, 0, 1, 0], [4, 3, 2, 1]), "datetime_utc").collect() == [Row(datetime_utc=T0, occurrences=3)]


def test_small_operators(spark):
    a, b = rows(spark, [0, 1], [1, 2]), rows(spark, [1], [9])
    assert [r.datetime_utc for r in not_in(a, b, ["datetime_utc"]).collect()] == [T0]
    both = lookup.union_all([a.select("id", "v"), b.select("datetime_utc")])
    assert both.columns == ["id", "v", "datetime_utc"] and both.count() == 3
    long = long_frame({"rhodamine": a.withColumnRenamed("v", "rho_ppb")})
    assert freshness(long).first() == Row(
        source="rhodamine", n_rows=2, first_us=T0 * 1_000_000, last_us=(T0 + 1) * 1_000_000
    )
