"""Keep a summary table up to date from growing raw tables.

A run computes only grid rows that no later reading can change (all sensors have
been read past them) and that are not stored yet, from just the raw rows these
need. Moving averages take the rows they look back on from the stored summary.
So any split of the data into runs gives the rows of a single run. ``flush``
closes the end of the data as well.

Several series (``keys``) have a mark each: a series whose readings come later, or
for the first time, is read from its own mark on. What a run has to know of the rows before
it, and which raw files hold news, comes from ``tidemark.plans.series``: neither the stored
summary nor raw files without news are read.

Rows, marks and the state of series are committed together as one snapshot of the summary
(``tidemark.sinks.snapshots``): a run that is lost before that has changed nothing, and the
next one does the same work again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.rows import nan_to_null
from tidemark.functions.time import epoch_seconds, floor_to, seconds_to_us
from tidemark.operators.aggregate import freshness, match, not_in
from tidemark.operators.lookup import since, union_all
from tidemark.plans.series import HISTORY, RawFiles, facts_of, is_known, last_rows, next_state, state_of
from tidemark.params import SECOND, SENSORS, Params
from tidemark.plans.summary import (
    add_corrected_ph,
    add_moving_averages,
    align,
    summarize,
    to_summary,
)
from tidemark.sinks import snapshots
from tidemark.sinks.files import append_once, commit_rows, stored_since
from tidemark.sources import schemas
from tidemark.sources.footers import extent_by_footers
from tidemark.sources.tables import ABSENT, after, long_frame, read_summary


def summary_mark(spark: SparkSession, path: str) -> int | None:
    """Latest stored time in epoch seconds, from the newest snapshot. Of a table that was
    written without one the footers of its files are read."""
    snapshot = snapshots.load(spark, path)
    if snapshot is not None and "mark_s" in snapshot.facts:
        return snapshot.facts["mark_s"]
    if snapshot is not None:
        newest = snapshots.latest_partition(snapshot)
        names = [n for n in snapshot.files if f"partition={newest}/" in n]
        files = [f"{snapshot.path}/{n}" for n in names]
        return extent_by_footers(spark, files)[0]["last"] if files else None
    try:
        return extent_by_footers(spark, path)[0]["last"]
    except AnalysisException as error:
        if error.getCondition() not in ABSENT:
            raise
        return None


def recent_summary(
    spark: SparkSession,
    path: str,
    before_s: int,
    rows: int,
    params: Params,
    keys: T.StructType | None = None,
) -> DataFrame:
    """The last ``rows`` stored rows before a time that a moving average uses,
    with their times as ``grid``.

    For one series the search starts in a short stretch before that time and is
    widened only if it holds too few rows. For several series the rows wanted
    may lie anywhere in the summary.
    """
    names = [f.name for f in keys] if keys else []
    step_s = params.step_us // SECOND
    stored = read_summary(spark, path, keys=keys).where(F.col("datetime_utc") < before_s)
    if params.ph_rows_only:
        stored = stored.where(F.col("ph_total").isNotNull())
    if names:
        return last_rows(stored.withColumn("grid", seconds_to_us("datetime_utc")), names, rows, params)
    recent = stored
    for steps in (4 * rows, 4096 * rows):
        near = since(stored, before_s - steps * step_s, partition_hours=params.partition_hours)
        if near.limit(rows).count() >= rows:
            recent = near
            break
    recent = recent.orderBy(F.col("datetime_utc").desc()).limit(rows)
    return recent.select(*names, seconds_to_us("datetime_utc").alias("grid"), *HISTORY)


def _samples_before(
    tables: Mapping[str, DataFrame], at_s: int, params: Params, keys: Sequence[str]
) -> dict[str, DataFrame]:
    """Per source (and series) with readings from ``at_s`` on, those at the last
    time before it. Longer stretches are searched only for what is still missing."""
    step_s, hours = params.step_us // SECOND, params.raw_partition_hours
    found = {}
    for source, table in tables.items():
        earlier = table.where(F.col("datetime_utc") < at_s)
        wanted = after(table, at_s - 1, partition_hours=hours)
        near = earlier
        for steps in (64, 65_536):
            stretch = after(earlier, at_s - steps * step_s, partition_hours=hours)
            if keys:
                complete = not_in(wanted.select(*keys), stretch, keys).isEmpty()
            else:
                complete = not stretch.isEmpty()
            if complete:
                near = stretch
                break
        last = near.groupBy(*keys).agg(F.max("datetime_utc").alias("datetime_utc"))
        found[source] = match(near, last, [*keys, "datetime_utc"], "left_semi")
    return found


def state_summary(
    spark: SparkSession, tables: Mapping[str, DataFrame], path: str, params: Params
) -> DataFrame:
    """Where the job stands: rows and latest time of each raw table, of the stored
    summary, and of the rows a moving average would look back on."""
    mark = summary_mark(spark, path)
    raw = freshness(long_frame(tables)).select(
        F.col("source").alias("name"), "n_rows", epoch_seconds("last_us").alias("last_s")
    )
    count = lambda df, time, name: df.agg(F.count(F.lit(1)).alias("n_rows"), F.max(time).alias("last_s")).select(
        F.lit(name).alias("name"), "n_rows", "last_s"
    )
    parts = [raw, count(read_summary(spark, path), "datetime_utc", "summary")]
    if mark is not None and params.window_rows > 1:
        history = recent_summary(spark, path, mark + 1, params.window_rows - 1, params)
        history = history.select(epoch_seconds("grid").alias("t"))
        parts.append(count(history, "t", "history"))
    return union_all(parts)


def add_history(
    spark: SparkSession,
    rows: DataFrame,
    path: str,
    first_us: int,
    last_us: int,
    params: Params,
    keys: T.StructType | None = None,
) -> DataFrame:
    """Moving averages of new ``rows``, on the grid from ``first_us`` to ``last_us``,
    looking back into the stored summary."""
    names = [f.name for f in keys] if keys else []
    back = params.window_rows - 1
    if back:
        before = recent_summary(spark, path, first_us // SECOND, back, params, keys)
        rows = rows.unionByName(before, allowMissingColumns=True)
    most = (last_us - first_us) // params.step_us + 1 + back
    return add_moving_averages(rows, params, names, most).where(F.col("grid") >= first_us)


def process_incremental(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    path: str,
    params: Params,
    keys: T.StructType | None = None,
    order: str | None = "id",
    flush: bool = False,
    rebuild: bool = False,
    sensors: Sequence[str] | None = None,
    resume_from: int | None = None,
    by_file: bool = False,
) -> DataFrame:
    """Bring the summary at ``path`` up to date and return the rows added.

    ``sensors`` are the sources a row must wait for (all of ``tables`` by
    default); one that stays silent holds the output back until ``flush``.
    ``rebuild`` replaces the summary by everything in the raw tables.
    ``resume_from`` (epoch seconds) starts at an earlier time than the last stored
    one: rows that are missing from there on are added, the others stay. A run that was
    lost needs no such hint.
    ``by_file`` (with ``keys``): the raw tables are scans of folders to which files are only
    added, so only files that hold news are read.
    """
    names = [f.name for f in keys] if keys else []
    schema = schemas.summary(keys)
    if rebuild:
        everything = summarize(long_frame(tables, keys=names, order=order), params, names, order)
        base = snapshots.opened(spark, path)
        forgotten = {"series": None, "raw": None, "tail": None}
        commit_rows(everything, base, params.partition_hours, facts=forgotten, replace=True)
        return read_summary(spark, path, keys=keys).drop("partition")
    if keys:
        return _process_series(spark, tables, path, params, keys, order, flush, sensors, resume_from, by_file)
    step = params.step_us
    if resume_from is not None:
        mark = resume_from - 1
    else:
        mark = summary_mark(spark, path)
    first_us = first_s = before_s = None
    if mark is not None:
        # The next grid point; readings up to one step before may serve it.
        first_us = (mark * SECOND // step + 1) * step
        first_s, before_s = first_us // SECOND, (first_us - step) // SECOND
    long = long_frame(
        tables,
        None if mark is None else before_s - 1,
        keys=names,
        order=order,
        partition_hours=params.raw_partition_hours,
    )
    none = spark.createDataFrame([], schema)

    # One row per source.
    seen = {r["source"]: r for r in freshness(long).collect()}
    if not seen:
        return none
    if flush:
        until_us = max(r["last_us"] for r in seen.values()) + step
    else:
        awaited = list(sensors or [s for s in SENSORS if s in tables])
        if any(s not in seen for s in awaited):
            return none
        until_us = min(seen[s]["last_us"] for s in awaited)
        if params.mode == "live":
            until_us -= step
        if first_us is not None and until_us < first_us:
            return none

    if first_us is not None and params.mode == "batch":
        before = long_frame(
            _samples_before(tables, before_s, params, names), keys=names, order=order
        )
        long = long.unionByName(before)
    rows = add_corrected_ph(align(long, params, names, order, first_us), params)
    rows = rows.where(F.col("grid") <= until_us)
    # The levels of the moving averages all read the new rows.
    rows = rows.persist()
    try:
        if first_us is None:
            most = (until_us - min(r["first_us"] for r in seen.values())) // step + 2
            averaged = add_moving_averages(rows, params, names, most)
        else:
            averaged = add_history(spark, rows, path, first_us, until_us, params, keys)
        append_once(to_summary(averaged), path, schema, params.partition_hours, since=first_s)
    finally:
        rows.unpersist()
    return read_summary(
        spark, path, None if first_s is None else first_s - 1, keys, params.partition_hours
    ).drop("partition")


def _process_series(
    spark, tables, path, params, keys, order, flush, sensors, resume_from, by_file
) -> DataFrame:
    """``process_incremental`` for several series, each from its own mark on."""
    names = [f.name for f in keys]
    schema, step = schemas.summary(keys), params.step_us
    base = snapshots.opened(spark, path)
    stored = nan_to_null(snapshots.read(spark, base, schema))
    state = state_of(spark, base, stored, keys, params).persist()
    raw = RawFiles(spark, tables, base, keys, order, params, by_file)
    seen = raw.seen(state).persist()
    try:
        # Where each series begins (null: nothing is stored) and how far it may be written.
        known = state.where("mark_s IS NOT NULL").select(*names, F.col("mark_s").alias("_mark"))
        if resume_from is not None:
            known = known.withColumn("_mark", F.least("_mark", F.lit(resume_from - 1)))
        known = known.select(*names, (floor_to(seconds_to_us("_mark"), step) + F.lit(step)).alias("_first"))
        awaited = list(sensors or [s for s in SENSORS if s in tables])
        lookahead = step if params.mode == "live" else 0
        if flush:
            until = seen.groupBy(*names).agg((F.max("last_us") + F.lit(step)).alias("_until"))
        else:
            until = (
                seen.where(F.col("source").isin(awaited))
                .groupBy(*names)
                .agg(F.count(F.lit(1)).alias("_n"), (F.min("last_us") - F.lit(lookahead)).alias("_until"))
                .where(F.col("_n") == len(awaited))
                .drop("_n")
            )
        bounds = match(until, known, names, "left").where("_first IS NULL OR _until >= _first").persist()
        try:
            lowest = bounds.agg(F.count(F.lit(1)), F.count("_first"), F.min("_first")).first()
            if not lowest[0]:
                _remember(spark, base, raw, state, seen, None, None, keys, params)
                return spark.createDataFrame([], schema)
            first_s = lowest[2] // SECOND if lowest[0] == lowest[1] else None
            return _write_series(
                spark, base, raw, state, seen, stored, bounds, first_s, keys, order, params, flush, resume_from
            )
        finally:
            bounds.unpersist()
    finally:
        seen.unpersist()
        state.unpersist()


def _write_series(
    spark, base, raw, state, seen, stored, bounds, first_s, keys, order, params, flush, resume_from
) -> DataFrame:
    names, step, schema = [f.name for f in keys], params.step_us, schemas.summary(keys)
    hours = params.raw_partition_hours
    low_s = None if first_s is None else first_s - step // SECOND - 1
    long = long_frame(raw.holding(bounds), low_s, keys=names, order=order, partition_hours=hours)
    reach = F.col("us") >= F.col("_first") - F.lit(step)
    own = match(long, bounds, names)
    long = own.where(F.col("_first").isNull() | reach).select(*long.columns)
    if params.mode == "batch" and (earlier := raw.before(bounds)):
        # The last reading of each sensor before the stretch serves its first rows.
        before = match(long_frame(earlier, keys=names, order=order), bounds, names).where(~reach)
        last = before.groupBy(*names, "source").agg(F.max("us").alias("us"))
        before = match(before.select(*long.columns), last, [*names, "source", "us"], "left_semi")
        long = long.unionByName(before)
    rows = add_corrected_ph(align(long, params, names, order), params)
    rows = match(rows, bounds, names).where(
        (F.col("grid") <= F.col("_until")) & (F.col("_first").isNull() | (F.col("grid") >= F.col("_first")))
    )
    rows = rows.drop("_first", "_until").persist()
    try:
        back = params.window_rows - 1
        plain = rows.withColumn("_new", F.lit(True))
        if back:
            if resume_from is None:
                history = match(state.select(*names, F.inline("tail")), bounds, names, "left_semi")
            else:  # rows before the stretch that is written again are not in the state
                history = match(stored.withColumn("grid", seconds_to_us("datetime_utc")), bounds, names)
                history = last_rows(history.where(F.col("grid") < F.col("_first")), names, back, params)
            plain = plain.unionByName(history.withColumn("_new", F.lit(False)), allowMissingColumns=True)
        averaged = to_summary(add_moving_averages(plain, params, names).where("_new"), names)
        new = averaged.select(*[f.name for f in schema])
        if resume_from is not None or not is_known(base, params):
            there = stored_since(spark, base, schema, first_s, params.partition_hours)
            new = not_in(new, there, [*names, "datetime_utc"])
        facts = _remember(spark, base, raw, state, seen, bounds, rows, keys, params, flush, commit=False)
        made = commit_rows(new, base, params.partition_hours, first_s, facts, cluster=names)
    finally:
        rows.unpersist()
    fresh = [n for n in made.files if n not in base.files]
    return nan_to_null(snapshots.read(spark, made, schema, files=fresh)).drop("partition")


def _remember(spark, base, raw, state, seen, bounds, rows, keys, params, flush=False, commit=True) -> dict:
    """Put aside the state of the series after a run; what the next snapshot has to say of it."""
    names = [f.name for f in keys]
    if bounds is None:
        if is_known(base, params) and not any(raw.new.values()):
            return {}
        rows = spark.createDataFrame([], T.StructType([*keys.fields, T.StructField("grid", T.LongType())]))
        rows = rows.withColumns({c: F.lit(None).cast("double") for c in HISTORY})
        until = spark.createDataFrame([], T.StructType([*keys.fields, T.StructField("mark_s", T.LongType())]))
    elif flush:
        # Rows at the end are closed early: a later reading may still add one after the last.
        until = rows.groupBy(*names).agg(epoch_seconds(F.max("grid")).alias("mark_s"))
    else:
        until = bounds.select(*names, epoch_seconds(floor_to("_until", params.step_us)).alias("mark_s"))
    after_run = next_state(state, rows, until, seen, keys, params)
    name = snapshots.put_aside(after_run.coalesce(8), base, "series")
    facts = facts_of(name, raw.logs, params)
    if commit:
        snapshots.commit(spark, base, facts={**facts, "series_writes": base.facts.get("writes")})
    return facts
