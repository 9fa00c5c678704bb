"""From raw readings to summary rows: align, correct pH, average."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.ph import corrected_ph
from tidemark.functions.time import epoch_seconds
from tidemark.operators.nearest import nearest_align, nearest_fill
from tidemark.operators.trailing import rolling_mean
from tidemark.params import ALIGNED_COLUMNS, Params
from tidemark.sources.schemas import SUMMARY_VALUES

MEANS = {"ph_corrected_ma": "ph_corrected", "ph_total_ma": "ph_total"}


def align(
    long: DataFrame,
    params: Params,
    keys: Sequence[str] = (),
    order: str | None = "id",
    start_us: int | None = None,
) -> DataFrame:
    """Raw readings on the grid of ``params``, in the order of the summary."""
    how = {"keys": keys, "order": order, "unit_us": params.unit_us}
    if params.mode == "live":
        rows = nearest_align(long, params.step_us, start_us=start_us, **how)
    else:
        rows = nearest_fill(long, params.step_us, **how)
        if start_us is not None:
            rows = rows.where(F.col("grid") >= start_us)
    return rows.select(*keys, "grid", *ALIGNED_COLUMNS)


def add_corrected_ph(rows: DataFrame, params: Params) -> DataFrame:
    return rows.withColumn(
        "ph_corrected", corrected_ph("vrse", "temp", "salinity", params.k0, params.k2)
    )


def add_moving_averages(
    rows: DataFrame, params: Params, keys: Sequence[str] = (), max_rows: int | None = None
) -> DataFrame:
    """Moving averages over the last rows of each series: over those with a pH
    reading, rows without one getting none (``live``), or over all rows.
    ``max_rows`` is the most rows a series can have, where that is known."""
    n, step = params.window_rows, params.step_us
    if not params.ph_rows_only:
        return rolling_mean(rows, keys, "grid", n, MEANS, step, max_rows)
    has_ph = F.col("ph_total").isNotNull()
    averaged = rolling_mean(rows.where(has_ph), keys, "grid", n, MEANS, step, max_rows)
    others = rows.where(~has_ph).withColumns({m: F.lit(None).cast("double") for m in MEANS})
    return averaged.unionByName(others)


def to_summary(rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return rows.select(*keys, epoch_seconds("grid").alias("datetime_utc"), *SUMMARY_VALUES)


def summarize(
    long: DataFrame,
    params: Params,
    keys: Sequence[str] = (),
    order: str | None = "id",
) -> DataFrame:
    """Summary rows of everything in ``long``."""
    if params.step_us % 1_000_000:
        raise ValueError("summary times are whole seconds: the step must be too")
    rows = add_corrected_ph(align(long, params, keys, order), params)
    return to_summary(add_moving_averages(rows, params, keys), keys)
