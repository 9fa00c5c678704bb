"""Look into a stream from outside, through its checkpoint: what waits in the state, and which
readings came too late. The stream may be running, stopped or lost; nothing is asked of it."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.time import floor_to, seconds_to_us
from tidemark.operators.lookup import union_all
from tidemark.params import SECOND, SENSORS, Params
from tidemark.sinks.snapshots import _Store
from tidemark.sources.tables import file_name


def _log_lines(store: _Store, folder: str) -> dict[int, list[str]]:
    """Lines of each numbered file of a checkpoint's folder, without the version line."""
    numbers = sorted(int(n) for n, is_folder, _ in store.names(folder) if not is_folder and n.isdigit())
    return {n: store.read(f"{folder}/{n}").splitlines()[1:] for n in numbers}


def batches(spark: SparkSession, checkpoint: str) -> list[dict]:
    """Per micro-batch that was begun: its number, whether it was committed, the watermark it
    ran with (epoch microseconds) and how far each source was read."""
    store = _Store(spark, checkpoint)
    done = {int(n) for n, _, _ in store.names("commits") if n.isdigit()}
    out = []
    for number, (about, *sources) in _log_lines(store, "offsets").items():
        ends = [json.loads(s)["logOffset"] if s != "-" else None for s in sources]
        out.append(
            {
                "batch": number,
                "committed": number in done,
                "watermark_us": json.loads(about)["batchWatermarkMs"] * 1000,
                "ends": ends,
            }
        )
    return out


def files_of(spark: SparkSession, checkpoint: str) -> dict[tuple[int, int], list[str]]:
    """(source, micro-batch) -> the files that it read there, from the logs of file sources."""
    store = _Store(spark, checkpoint)
    places = sorted(int(n) for n, is_folder, _ in store.names("sources") if is_folder and n.isdigit())
    listed: dict[int, dict[int, list[str]]] = {}
    for source in places:
        found: dict[str, int] = {}
        folder = f"sources/{source}"
        for name, is_folder, _ in store.names(folder):
            if is_folder or not name.removesuffix(".compact").isdigit():
                continue
            for line in store.read(f"{folder}/{name}").splitlines()[1:]:
                entry = json.loads(line)
                found[file_name(entry["path"])] = entry["batchId"]
        for path, at in found.items():
            listed.setdefault(source, {}).setdefault(at, []).append(path)
    out: dict[tuple[int, int], list[str]] = {}
    before: list[int | None] = []
    for step in batches(spark, checkpoint):
        for source, end in enumerate(step["ends"]):
            start = before[source] if source < len(before) else None
            own = [
                f
                for at, files in listed.get(source, {}).items()
                if end is not None and at <= end and (start is None or at > start)
                for f in files
            ]
            if own:
                out[source, step["batch"]] = own
        before = step["ends"]
    return out


def waiting_rows(
    spark: SparkSession, checkpoint: str, keys: T.StructType | None = None, operator: int = 0
) -> DataFrame:
    """Rows in the state of ``stream_align`` after its last micro-batch, by series: how many
    wait, from when to when (epoch seconds), and per sensor the latest of them that it has a
    reading for. One that lags behind the others holds them all back."""
    names = [f.name for f in keys] if keys else []
    state = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
    # The buffers have names of their own, repeated: first reading, then value and key by column.
    columns = [c for own in SENSORS.values() for c in own]
    fields = ["first_us", *(x for c in columns for x in (c, f"{c}_key"))]
    kinds = [f.dataType for f in state.schema["value"].dataType.fields]
    value = T.StructType([T.StructField(n, k) for n, k in zip(fields, kinds, strict=True)])
    at = F.unix_seconds(F.col("key.grid"))
    rows = state.select(*[F.col(f"key.`{n}`").alias(n) for n in names], at.alias("at"), F.col("value").cast(value).alias("v"))
    return rows.groupBy(*names).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("at").alias("first_s"),
        F.max("at").alias("last_s"),
        *[
            F.max(F.when(F.col(f"v.{own[0]}_key").isNotNull(), F.col("at"))).alias(f"{source}_s")
            for source, own in SENSORS.items()
        ],
    )


def watermark(spark: SparkSession, checkpoint: str) -> int:
    """The watermark (epoch seconds) of the last micro-batch: rows up to it have been written."""
    return max(b["watermark_us"] for b in batches(spark, checkpoint)) // SECOND


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a stream, their stores and the micro-batches they are kept for."""
    found = spark.read.format("state-metadata").load(checkpoint)
    return found.select(
        "operatorId", "operatorName", "stateStoreName", "numPartitions", "minBatchId", "maxBatchId"
    )


def late_readings(
    spark: SparkSession, checkpoint: str, tables: Mapping[str, DataFrame], params: Params
) -> DataFrame:
    """(source, n_rows, n_late): readings that each sensor's stream has read, and those of them
    that came when all rows they could serve had left the state.

    A reading serves the grid points around it; it is late if the later one was not after
    the watermark of its micro-batch. ``tables`` are scans of the streams' folders, in the order
    in which ``stream_align`` was given them. Only times are read.
    """
    marks = {b["batch"]: b["watermark_us"] for b in batches(spark, checkpoint)}
    read = files_of(spark, checkpoint)
    step = params.step_us
    parts = []
    for at, (source, table) in enumerate(tables.items()):
        own = {f: marks[batch] for (s, batch), files in read.items() if s == at for f in files}
        us = floor_to(seconds_to_us("datetime_utc"), params.unit_us)
        later = floor_to(us, step) + F.lit(step).cast("bigint")
        if own:
            name = F.col("_metadata.file_path")
            mark = F.lit(None).cast("bigint")
            by_mark: dict[int, list[str]] = {}
            for f, m in own.items():
                by_mark.setdefault(m, []).append(f)
            for m, files in by_mark.items():
                mark = F.when(name.isin(files), F.lit(m)).otherwise(mark)
            rows = table.where(name.isin(list(own))).select((later <= mark).alias("late"))
        else:
            rows = table.limit(0).select(F.lit(False).alias("late"))
        parts.append(
            rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("late").alias("n_late")).select(
                F.lit(source).alias("source"), "n_rows", "n_late"
            )
        )
    return union_all(parts)
