"""Moving averages of several series inside the stream, with state per series.

Grid rows leave the alignment complete and in the order of time from one micro-batch to the
next. For each series a state store keeps the rows that the next moving average looks back on,
and that the series has begun; so a micro-batch costs in proportion to its own rows and to the
series it touches, not to what is stored. Series without new rows are not visited.

A call takes the new rows of a group of series, as a call costs more than a series: the state
of a group is a map with an entry, and its time-to-live, per series. The rows that a micro-batch
has of one group are put in order in one task; the size of a micro-batch (``max_files`` of the
streams) bounds them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.time import timestamp_to_us
from tidemark.params import ALIGNED_COLUMNS, Params, micros
from tidemark.plans.summary import MEANS, add_corrected_ph

#: Spark renames columns that begin with an underscore on their way to Python.
FIRST = "first_us"
STATE = "grid bigint, ph_total array<double>, ph_corrected array<double>"
#: Groups of series, by their hash. Fixed, as a stream finds its state by it.
GROUPS = 1024
#: Numbers that are averaged at once.
CHUNK = 1 << 18


def window_means(before: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Mean of each value and the ``n - 1`` before it, those of ``before`` first; NaN is skipped.
    Windows are added up one by one, so an extreme value leaves no trace in later ones."""
    padded = np.concatenate([np.full(n - 1, np.nan), before, values])[-(n - 1 + len(values)) :]
    out = np.empty(len(values))
    step = max(1, CHUNK // n)
    for first in range(0, len(values), step):
        windows = np.lib.stride_tricks.sliding_window_view(padded[first : first + step + n - 1], n)
        there = ~np.isnan(windows)
        count = there.sum(axis=1)
        total = np.where(there, windows, 0.0).sum(axis=1)
        out[first : first + step] = np.where(count > 0, total / np.maximum(count, 1), np.nan)
    return out


class TrailingMeans(StatefulProcessor):
    """Per series: drops the row one step before its first reading, and adds the averages."""

    def __init__(self, columns: Sequence[str], rows: int, step_us: int, ph_rows_only: bool, ttl_ms: int | None):
        self.columns, self.rows, self.step_us = list(columns), rows, step_us
        self.ph_rows_only, self.ttl_ms = ph_rows_only, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getMapState("tails", "series_key string", STATE, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values(["series_key", "grid"], ignore_index=True)
        series, grid, first = (new[c].to_numpy() for c in ("series_key", "grid", FIRST))
        values = {name: new[name].to_numpy(float) for name in MEANS.values()}
        used = ~np.isnan(values["ph_total"]) if self.ph_rows_only else np.ones(len(new), bool)
        back = self.rows - 1
        # All series one after the other, each after the values that it looks back on.
        runs, own_runs = {name: [] for name in values}, []
        starts = np.flatnonzero(np.concatenate([[True], series[1:] != series[:-1]]))
        for low, high in zip(starts.tolist(), [*starts[1:].tolist(), len(new)]):
            stored = self.state.getValue((series[low],))
            if stored is None:
                begin = int(first[low:high].min())
                begin -= begin % self.step_us
                begun = low + int(np.searchsorted(grid[low:high], begin))
                used[low:begun] = False
                grid[low:begun] = -1
                low = begun
            own = low + np.flatnonzero(used[low:high])
            tails = {}
            for name, before in zip(("ph_total", "ph_corrected"), stored[1:] if stored else ([], [])):
                run = np.concatenate([np.array([np.nan if v is None else v for v in before], float), values[name][own]])
                runs[name].append(np.full(max(0, back + len(own) - len(run)), np.nan))
                runs[name].append(run[max(0, len(run) - back - len(own)) :])
                tails[name] = [None if v != v else v for v in run[max(0, len(run) - back) :].tolist()]
            own_runs += [np.zeros(back, bool), np.ones(len(own), bool)]
            if low < high:
                self.state.updateValue((series[low],), (int(grid[high - 1]), tails["ph_total"], tails["ph_corrected"]))
        own = np.concatenate(own_runs)
        for out, name in MEANS.items():
            means = np.full(len(new), np.nan)
            means[used] = window_means(np.array([]), np.concatenate(runs[name]), self.rows)[own]
            new[out] = means
        yield new.loc[grid >= 0, self.columns]

    def close(self) -> None:
        pass


def with_series_means(
    aligned: DataFrame, params: Params, keys: T.StructType, forget_after: str | None = None
) -> DataFrame:
    """Rows of ``stream_align`` with pH and moving averages, as a stream; ``grid`` in epoch
    microseconds. ``forget_after`` bounds the state: a series without rows for so long (by the
    clock) begins anew."""
    names = [f.name for f in keys]
    rows = add_corrected_ph(aligned.withColumn("grid", timestamp_to_us("grid")), params)
    values = [*ALIGNED_COLUMNS, "ph_corrected", *MEANS]
    # Whole numbers are text in Python: beside a missing one they would become doubles.
    whole = {f.name: f.dataType for f in keys if isinstance(f.dataType, T.IntegralType)}
    kept = [T.StructField(f.name, T.StringType()) if f.name in whole else f for f in keys]
    schema = T.StructType(
        [*kept, T.StructField("grid", T.LongType()), *(T.StructField(c, T.DoubleType()) for c in values)]
    )
    ttl_ms = None if forget_after is None else micros(forget_after) // 1000
    # A missing key is a series of its own.
    rows = rows.withColumn("series_key", F.to_json(F.struct(*names)))
    rows = rows.withColumn("series_group", F.pmod(F.xxhash64("series_key"), F.lit(GROUPS)).cast("int"))
    rows = rows.withColumns({name: F.col(name).cast("string") for name in whole})
    averaged = rows.groupBy("series_group").transformWithStateInPandas(
        TrailingMeans([f.name for f in schema], params.window_rows, params.step_us, params.ph_rows_only, ttl_ms),
        schema,
        "Append",
        "None" if ttl_ms is None else "ProcessingTime",
    )
    return averaged.withColumns({name: F.col(name).cast(kind) for name, kind in whole.items()})
