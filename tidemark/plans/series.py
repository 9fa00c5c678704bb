"""What a run with several series remembers: the state of each series, and what raw files hold.

Both are small tables beside the log of the summary's snapshots, named by the snapshot they
belong to, so they change with a commit or not at all.

The **state** has a row per series: the time up to which it is written, the last reading of
each sensor, and the last rows that a moving average looks back on. A run needs no stored
summary row.

The **change log** has a row per raw file and series: first and last time. Each raw file is read
for its times once, when it is new; which files a run has to open for the readings follows
from the log. That is for raw tables to which files are only added (``by_file``); of others
the times are read in full.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tidemark.functions.time import floor_to, seconds_to_us
from tidemark.operators.aggregate import freshness, match
from tidemark.operators.lookup import union_all
from tidemark.operators.trailing import BLOCK_ROWS
from tidemark.params import Params
from tidemark.sinks import snapshots
from tidemark.sinks.snapshots import Snapshot
from tidemark.sources.tables import file_name, long_frame

HISTORY = ("ph_total", "ph_corrected")
TAIL = "array<struct<grid: bigint, ph_total: double, ph_corrected: double>>"
#: The change log of so many runs is put into one table.
LOGS = 20


def _schema(keys: T.StructType, fields: str) -> T.StructType:
    return T.StructType([*keys.fields, *T.StructType.fromDDL(fields).fields])


def state_schema(keys: T.StructType) -> T.StructType:
    return _schema(keys, f"mark_s bigint, last_us map<string, bigint>, tail {TAIL}")


def log_schema(keys: T.StructType) -> T.StructType:
    return _schema(keys, "source string, file string, first_us bigint, last_us bigint")


def last_rows(rows: DataFrame, names: Sequence[str], n: int, params: Params) -> DataFrame:
    """The last ``n`` rows of each series that a moving average uses (with ``grid``): ranked
    per block of the series first, then among the few left."""
    if params.ph_rows_only:
        rows = rows.where(F.col("ph_total").isNotNull())
    rows = rows.withColumn("_block", floor_to("grid", params.step_us * BLOCK_ROWS))
    newest = F.col("grid").desc()
    for part in ([*names, "_block"], names):
        rank = F.row_number().over(Window.partitionBy(*part).orderBy(newest))
        rows = rows.withColumn("_rank", rank).where(F.col("_rank") <= n)
    return rows.select(*names, "grid", *HISTORY)


def _tails(rows: DataFrame, names: Sequence[str], n: int, params: Params) -> DataFrame:
    row = F.struct("grid", *HISTORY)
    return last_rows(rows, names, n, params).groupBy(*names).agg(F.sort_array(F.collect_list(row)).alias("tail"))


def state_of(
    spark: SparkSession, base: Snapshot, stored: DataFrame, keys: T.StructType, params: Params
) -> DataFrame:
    """The state that belongs to a snapshot. If there is none that ``is_known``, it is
    computed from the rows."""
    names, back = [f.name for f in keys], params.window_rows - 1
    if is_known(base, params):
        return snapshots.aside(spark, base, [base.facts["series"]], state_schema(keys))
    rows = stored.withColumn("grid", seconds_to_us("datetime_utc"))
    marks = rows.groupBy(*names).agg(F.max("datetime_utc").alias("mark_s"))
    last = F.lit(None).cast("map<string, bigint>").alias("last_us")
    if not back:
        return marks.select(*names, "mark_s", last, F.lit(None).cast(TAIL).alias("tail"))
    tails = match(marks, _tails(rows, names, back, params), names, "left")
    return tails.select(*names, "mark_s", last, "tail")


def _tail_kind(params: Params) -> list:
    return [params.window_rows - 1, params.ph_rows_only, params.step_us]


def is_known(base: Snapshot, params: Params) -> bool:
    """The snapshot's state is that of its rows (no one else has added some), for these windows."""
    facts = base.facts
    same = facts.get("series_writes") == facts.get("writes") and facts.get("tail") == _tail_kind(params)
    return bool(facts.get("series")) and same


def next_state(
    state: DataFrame, rows: DataFrame, until: DataFrame, seen: DataFrame, keys: T.StructType, params: Params
) -> DataFrame:
    """The state after a run that wrote ``rows`` (with ``grid``), up to ``until`` (names,
    mark_s) where a series was written, having seen the ``seen`` readings of each sensor."""
    names, back = [f.name for f in keys], params.window_rows - 1
    if back:
        old = state.select(*names, F.inline("tail"))
        touched = match(old, until, names, "left_semi")
        tails = _tails(touched.unionByName(rows.select(*names, "grid", *HISTORY)), names, back, params)
    else:
        tails = until.select(*names, F.lit(None).cast(TAIL).alias("tail"))
    last = seen.groupBy(*names).agg(F.map_from_entries(F.collect_list(F.struct("source", "last_us"))).alias("_last"))
    marks = until.select(*names, F.col("mark_s").alias("_mark"))
    new = match(match(last, marks, names, "left"), tails.withColumnRenamed("tail", "_tail"), names, "left")
    changed = match(new, state, names, "left").select(
        *names,
        F.greatest("_mark", "mark_s").alias("mark_s"),
        F.col("_last").alias("last_us"),
        F.coalesce("_tail", "tail").alias("tail"),
    )
    return changed.unionByName(match(state, new, names, "left_anti"))


def facts_of(name: str, logs: Sequence[str], params: Params) -> dict:
    return {"series": name, "raw": list(logs), "tail": _tail_kind(params)}


class RawFiles:
    """The raw tables by file: what is new since the last run, and which files hold what."""

    def __init__(
        self, spark: SparkSession, tables: Mapping[str, DataFrame], base: Snapshot, keys: T.StructType,
        order: str | None, params: Params, by_file: bool,
    ):
        self.spark, self.tables, self.base, self.keys = spark, tables, base, keys
        self.names = [f.name for f in keys]
        self.order, self.params = order, params
        self.logs: list[str] = list(base.facts.get("raw") or [])
        self.by_file = by_file
        self.new: dict[str, list[str]] = {}
        self.fresh: list[str] = []
        if by_file:
            known = {(r.source, r.file) for r in self.log().select("source", "file").distinct().collect()}
            files = {s: sorted(map(file_name, t.inputFiles())) for s, t in tables.items()}
            self.new = {s: [f for f in own if (s, f) not in known] for s, own in files.items()}

    def log(self) -> DataFrame:
        return snapshots.aside(self.spark, self.base, self.logs, log_schema(self.keys))

    def of(self, files: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
        """The tables, of some files only; the others are not opened."""
        return {
            s: self.tables[s].where(F.col("_metadata.file_path").isin(list(own))) for s, own in files.items() if own
        }

    def note(self) -> None:
        """Read the times of new files into the log."""
        parts = [
            table.groupBy(*self.names, F.lit(source).alias("source"), F.col("_metadata.file_path").alias("file")).agg(
                F.min(seconds_to_us("datetime_utc")).alias("first_us"),
                F.max(seconds_to_us("datetime_utc")).alias("last_us"),
            )
            for source, table in self.of(self.new).items()
        ]
        if not parts:
            return
        found = union_all(parts).select(*[f.name for f in log_schema(self.keys)])
        if len(self.logs) >= LOGS:
            found, self.logs = found.unionByName(self.log()), []
        self.fresh = [snapshots.put_aside(found.coalesce(8), self.base, "raw")]
        self.logs = [*self.logs, *self.fresh]

    def seen(self, state: DataFrame) -> DataFrame:
        """(names, source, last_us): the last reading of each sensor of each series."""
        if not self.by_file:
            long = long_frame(self.tables, keys=self.names, order=self.order)
            return freshness(long, self.names).select(*self.names, "source", "last_us")
        self.note()
        logs = self.fresh if is_known(self.base, self.params) else self.logs
        news = snapshots.aside(self.spark, self.base, logs, log_schema(self.keys))
        old = state.where(F.size("last_us") > 0).select(
            *self.names, F.explode("last_us").alias("source", "last_us")
        )
        both = news.select(*self.names, "source", "last_us").unionByName(old)
        return both.groupBy(*self.names, "source").agg(F.max("last_us").alias("last_us"))

    def holding(self, bounds: DataFrame) -> dict[str, DataFrame]:
        """The tables, of the files that have readings of a series in ``bounds`` from one
        step before its ``_first`` (null: from the beginning) to one after its ``_until``."""
        if not self.by_file:
            return dict(self.tables)
        step = F.lit(self.params.step_us)
        near = match(self.log(), bounds, self.names).where(
            (F.col("_first").isNull() | (F.col("last_us") >= F.col("_first") - step))
            & (F.col("first_us") <= F.col("_until") + step)
        )
        return self.of(self._listed(near))

    def before(self, bounds: DataFrame) -> dict[str, DataFrame]:
        """The tables, of the files that may hold the last reading of a sensor earlier than
        one step before ``_first``."""
        if not self.by_file:
            return dict(self.tables)
        reach = F.col("_first") - F.lit(self.params.step_us)
        early = match(self.log(), bounds, self.names).where(F.col("first_us") < reach)
        whole = F.max(F.when(F.col("last_us") < reach, F.col("last_us"))).over(
            Window.partitionBy(*self.names, "source")
        )
        near = early.withColumn("_whole", whole).where("_whole IS NULL OR last_us >= _whole")
        return self.of(self._listed(near))

    def _listed(self, log: DataFrame) -> dict[str, list[str]]:
        """Names of files by source: the driver has the names of all raw files anyway."""
        out: dict[str, list[str]] = {}
        for r in log.select("source", "file").distinct().collect():
            out.setdefault(r.source, []).append(r.file)
        return out
