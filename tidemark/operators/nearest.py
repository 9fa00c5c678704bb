"""Nearest-sample alignment of several sensors on a regular time grid.

Input is one *long* frame: ``source``, ``us`` (bigint epoch microseconds), an
optional arrival order, and the value columns, each filled only in the rows of
its own source. ``keys`` are optional series keys (ship, cruise, user).

Rules, for every grid point: the sample with the smallest distance wins, the
later one on a tie; of several samples at the same time the first to arrive
counts; a null reading of the winning sample is kept, not skipped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.rows import drop_empty
from tidemark.functions.time import floor_to, whole_div
from tidemark.operators.aggregate import match
from tidemark.operators.trailing import trailing_levels
from tidemark.params import SENSORS

# Arrival numbers, shifted to start at 0, and one more for rows without any.
ARRIVALS = 2**64 + 1


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _rank_key(rank: Column, order: str | None, rows: DataFrame) -> Column:
    """Sort key: ``rank`` first, arrival order second, rows without one last.

    Both share one whole number of 38 digits, which holds any bigint arrival
    number: ``min_by`` with a decimal key stays a hash aggregation with map-side
    combine, as it would not with a struct. Arrival numbers of a decimal type may
    be beyond that: they are compared as they are.
    """
    if order is None:
        return rank
    if isinstance(rows.schema[order].dataType, T.DecimalType):
        return F.struct(rank.alias("rank"), F.col(order).isNull().alias("last"), F.col(order).alias("arrival"))
    whole = lambda n: F.lit(Decimal(n))
    arrival = F.col(order).cast("bigint").cast("decimal(19,0)") + whole(2**63)
    ahead = rank.cast("decimal(17,0)") * whole(ARRIVALS)
    return (ahead + F.coalesce(arrival, whole(ARRIVALS - 1))).cast("decimal(38,0)")


def _check_units(unit_us: int, **durations: int) -> None:
    for name, value in durations.items():
        if value % unit_us:
            raise ValueError(f"{name} must be a whole number of time units")


def _whole_units(us: Column, unit_us: int) -> Column:
    """``us``, checked to be a whole number of time units."""
    if unit_us == 1:
        return us
    return F.when(F.pmod(us, _long(unit_us)) == 0, us).otherwise(
        F.raise_error(F.lit("a time is finer than the time unit"))
    )


def candidates(us: Column, step_us: int, tolerance_us: int) -> Column:
    """Grid points at most ``tolerance_us`` away from ``us``, as an array."""
    step = _long(step_us)
    if tolerance_us == step_us:
        # Only the two neighbours qualify, and for a sample that lies on the
        # grid also the point one step before it.
        base = floor_to(us, step_us)
        return F.when(us == base, F.array(base - step, base, base + step)).otherwise(
            F.array(base, base + step)
        )
    first = -floor_to(-(us - _long(tolerance_us)), step_us)
    last = floor_to(us + _long(tolerance_us), step_us)
    return F.when(first <= last, F.sequence(first, last, step))


def nearest_candidates(
    long: DataFrame,
    step_us: int,
    tolerance_us: int,
    sensors: Mapping[str, Sequence[str]] = SENSORS,
    keys: Sequence[str] = (),
    order: str | None = "id",
    unit_us: int = 1_000_000,
) -> DataFrame:
    """Every sample once per grid point it may serve, with its rank there.
    ``sensor`` is the number of the source, cheaper to test per row than its name.

    With a tolerance of more than a step only the first and the last sample of each grid cell
    are offered around: no point outside the cell is nearer to another one. So the copies are
    bounded by the cells, however many samples there are.
    """
    _check_units(unit_us, step=step_us, tolerance=tolerance_us)
    columns = [c for cols in sensors.values() for c in cols]
    sensor = F.lit(None).cast("int")
    for number, source in enumerate(sensors):
        sensor = F.when(F.col("source") == source, F.lit(number)).otherwise(sensor)
    point = (
        long.where(F.col("source").isin(list(sensors)) & F.col("us").isNotNull())
        .select(
            *keys,
            sensor.alias("sensor"),
            _whole_units(F.col("us"), unit_us).alias("us"),
            *([order] if order else []),
            *columns,
        )
    )
    if tolerance_us > step_us:
        point = _ends_of_cells(point, [*keys, "sensor"], step_us, order)
    point = point.withColumn("grid", F.explode(candidates(F.col("us"), step_us, tolerance_us)))
    distance = F.abs(F.col("grid") - F.col("us"))
    rank = (
        F.lit(2) * whole_div(distance, unit_us)
        + (F.col("us") < F.col("grid")).cast("bigint")
    )
    return point.select(
        *keys, "grid", "sensor", "us", _rank_key(rank, order, point).alias("key"), *columns
    )


def _ends_of_cells(samples: DataFrame, by: Sequence[str], step_us: int, order: str | None) -> DataFrame:
    """The first and the last sample of each grid cell; of several at one time the first to arrive."""
    arrival = [F.col(order).isNull(), F.col(order)] if order else []
    row = F.struct(*[F.col(c) for c in samples.columns if c not in by])
    ends = samples.groupBy(*by, floor_to("us", step_us).alias("_cell")).agg(
        F.min_by(row, F.struct("us", *arrival)).alias("_a"), F.min_by(row, F.struct(-F.col("us"), *arrival)).alias("_b")
    )
    both = F.when(F.col("_a.us") == F.col("_b.us"), F.array("_a")).otherwise(F.array("_a", "_b"))
    return ends.select(*by, F.explode(both).alias("_e")).select(*by, "_e.*").select(*samples.columns)


def nearest_aggregates(sensors: Mapping[str, Sequence[str]] = SENSORS) -> list[Column]:
    """One ``min_by`` per value column, over the rows of its own source. Columns of
    one source share the key, hence the sample."""
    return [
        F.expr(f"min_by(`{c}`, key) FILTER (WHERE sensor = {number})").alias(c)
        for number, cols in enumerate(sensors.values())
        for c in cols
    ]


def extent(long: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """First and last time over all sources (per series if there are keys)."""
    timed = long.where(F.col("us").isNotNull())
    return timed.groupBy(*keys).agg(F.min("us").alias("first_us"), F.max("us").alias("last_us"))


def not_before(df: DataFrame, time: str, starts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep rows at or after the start of their series."""
    if not keys:
        return df.where(F.col(time) >= starts.select("start").scalar())
    # One row per series; whether it is small enough to broadcast is decided
    # from its size at run time.
    return match(df, starts, keys).where(F.col(time) >= F.col("start")).drop("start")


def nearest_align(
    long: DataFrame,
    step_us: int,
    tolerance_us: int | None = None,
    sensors: Mapping[str, Sequence[str]] = SENSORS,
    keys: Sequence[str] = (),
    order: str | None = "id",
    unit_us: int = 1_000_000,
    start_us: int | None = None,
) -> DataFrame:
    """All sensors on one shared grid, nearest sample within the tolerance
    (one step by default), rows without any reading removed.

    One shuffle: each sample goes to the grid points it can serve, the best per
    point and source is kept, first within the map task. The grid starts at the
    floor of the first sample, or at ``start_us`` where the caller knows it. A
    sample is offered to every grid point in reach; for a reach of many steps
    ``nearest_fill`` with a tolerance does less work.
    """
    tolerance_us = step_us if tolerance_us is None else tolerance_us
    columns = [c for cols in sensors.values() for c in cols]
    aligned = (
        nearest_candidates(long, step_us, tolerance_us, sensors, keys, order, unit_us)
        .groupBy(*keys, "grid")
        .agg(*nearest_aggregates(sensors))
    )
    aligned = drop_empty(aligned, columns)
    if start_us is not None:
        return aligned.where(F.col("grid") >= F.lit(start_us))
    known = long.where(F.col("source").isin(list(sensors)))
    starts = extent(known, keys).select(*keys, floor_to("first_us", step_us).alias("start"))
    return not_before(aligned, "grid", starts, keys)


def nearest_fill(
    long: DataFrame,
    step_us: int,
    tolerance_us: int | None = None,
    sensors: Mapping[str, Sequence[str]] = SENSORS,
    keys: Sequence[str] = (),
    order: str | None = "id",
    unit_us: int = 1_000_000,
) -> DataFrame:
    """Each sensor on its own grid, from the floor of its first sample to the
    floor of its last, every point filled from the nearest sample however far;
    the grids are then joined in full.

    Samples are first reduced to the first and last of each grid cell, which
    bounds the rows per stretch of time. Each cell is then paired with the cell
    before it, and the grid points between the two take the nearer sample.
    ``tolerance_us`` blanks values from farther away, keeping the rows.
    """
    _check_units(unit_us, step=step_us)
    slots = max(len(cols) for cols in sensors.values())
    series = [*keys, "source"]

    def slot(i: int) -> Column:
        value = None
        for source, cols in sensors.items():
            if i < len(cols):
                hit = F.col("source") == source
                value = F.when(hit, F.col(cols[i])) if value is None else value.when(hit, F.col(cols[i]))
        return value.cast("double")

    samples = (
        long.where(F.col("source").isin(list(sensors)) & F.col("us").isNotNull())
        .withColumn("us", _whole_units(F.col("us"), unit_us))
        .withColumn("cell", floor_to("us", step_us))
        .withColumn("offset", whole_div(F.col("us") - F.col("cell"), unit_us))
    )
    first_key = _rank_key(F.col("offset"), order, samples)
    # Same key for the last sample, with the offset counted from the cell's end,
    # so that the smallest key is again the wanted one.
    last_key = _rank_key(_long(step_us // unit_us) - F.col("offset"), order, samples)
    cells = (
        samples.select(
            *series,
            "cell",
            "us",
            first_key.alias("first_key"),
            last_key.alias("last_key"),
            *[slot(i).alias(f"v{i}") for i in range(slots)],
        )
        .groupBy(*series, "cell")
        .agg(
            F.min("us").alias("first_us"),
            F.max("us").alias("last_us"),
            *[F.min_by(f"v{i}", "first_key").alias(f"first_v{i}") for i in range(slots)],
            *[F.min_by(f"v{i}", "last_key").alias(f"last_v{i}") for i in range(slots)],
        )
    )

    before = ["cell", "last_us", *[f"last_v{i}" for i in range(slots)]]
    levels = trailing_levels(
        cells,
        series,
        "cell",
        rows=2,
        spacing=step_us,
        compute={f"prev_{c}": (lambda w, c=c: F.lag(c, 1).over(w)) for c in before},
    )

    block = 4096
    run = _long(step_us * block)
    step = _long(step_us)
    # The first cell of a series fills only its own grid point.
    begin = F.coalesce(F.col("prev_cell") + step, F.col("cell"))

    def stretches(pairs: DataFrame) -> DataFrame:
        return pairs.withColumn("from", F.explode(F.sequence(begin, F.col("cell"), run)))

    # Within a block of the grid a gap has a bounded length. Pairs that span
    # blocks are few but may be far apart: their stretches are spread out before
    # they are expanded, so that a long outage is not filled by one task.
    near, *far = levels
    pieces = stretches(near)
    for pairs in far:
        pieces = pieces.unionByName(stretches(pairs).repartition(*series, "from"))
    until = F.least(F.col("from") + _long(step_us * (block - 1)), F.col("cell"))
    points = pieces.withColumn("grid", F.explode(F.sequence(F.col("from"), until, step)))

    to_prev = F.col("grid") - F.col("prev_last_us")
    to_next = F.col("first_us") - F.col("grid")
    use_prev = F.coalesce(to_prev < to_next, F.lit(False))
    distance = F.when(use_prev, to_prev).otherwise(to_next)
    in_reach = F.lit(True) if tolerance_us is None else distance <= _long(tolerance_us)
    chosen = points.select(
        *series,
        "grid",
        *[
            F.when(
                in_reach,
                F.when(use_prev, F.col(f"prev_last_v{i}")).otherwise(F.col(f"first_v{i}")),
            ).alias(f"v{i}")
            for i in range(slots)
        ],
    )
    return chosen.groupBy(*keys, "grid").agg(
        *[
            F.max(F.when(F.col("source") == s, F.col(f"v{i}"))).alias(c)
            for s, cols in sensors.items()
            for i, c in enumerate(cols)
        ]
    )


def time_grid(
    long: DataFrame,
    step_us: int,
    keys: Sequence[str] = (),
    lookahead: bool = True,
) -> DataFrame:
    """All points of the shared grid: floor of the first time to the last time
    (plus up to one step with ``lookahead``)."""
    step, run = _long(step_us), _long(step_us * 4096)
    bounds = extent(long, keys).where(F.col("first_us").isNotNull()).select(
        *keys,
        floor_to("first_us", step_us).alias("lo"),
        floor_to(F.col("last_us") + _long(step_us if lookahead else 0), step_us).alias("hi"),
    )
    stretch = bounds.withColumn("from", F.explode(F.sequence("lo", "hi", run)))
    stretch = stretch.repartition(*keys, "from")
    until = F.least(F.col("from") + _long(step_us * 4095), F.col("hi"))
    return stretch.select(*keys, F.explode(F.sequence(F.col("from"), until, step)).alias("grid"))
