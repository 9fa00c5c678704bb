"""Row windows over one long ordered series, without a global sort.

A window partitioned by nothing, or by a series key that may hold most of the
data, runs in one task. Here the series is cut into blocks of its position
(grid time, seconds, arrival number). Inside a block a window over the last
``n`` rows is final for every row that has ``n - 1`` rows before it in the
block. Only the first ``n - 1`` rows of a block lack some, and the rows they
need are among the last ``n - 1`` rows of the blocks before. So those heads and
tails, a small share of the data, go one level up into far longer blocks, where
the same window is evaluated again, and the heads become final there. The top
level is the whole series, by then reduced to a few rows per block of the level
below. Gaps of any length are handled, as the rows sent up are the neighbours
in row order.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tidemark.functions.rows import known
from tidemark.functions.time import floor_to
from tidemark.operators.aggregate import match

BLOCK_ROWS = 16_384
TOP_ROWS = 131_072
#: Whole blocks that one time window spans at most.
BLOCKS = 256

Compute = Mapping[str, Callable[[WindowSpec], Column]]


def trailing_levels(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    rows: int,
    compute: Compute,
    spacing: int = 1,
    max_rows: int | None = None,
) -> list[DataFrame]:
    """Evaluate ``compute`` over windows that look back at most ``rows - 1`` rows.

    ``position`` is a bigint, unique per series and a multiple of ``spacing``,
    so a block holds a known number of rows at most. Each function in
    ``compute`` gets the ordered window without a frame. ``max_rows`` tells that no
    series has more rows than that; if they fit in a block, one level does. The rows
    are the same either way, and no window holds more than a block.
    Returns the rows that become final per level, from blocks to whole series.
    """
    back = rows - 1
    block_rows = max(BLOCK_ROWS, 16 * rows)
    if max_rows is not None and max_rows <= block_rows:
        widths = [None]
    elif back == 0:
        widths = [spacing * block_rows]
    else:
        above = max(16, TOP_ROWS // (2 * rows))
        widths = [spacing * block_rows, spacing * block_rows * above, None]

    done: list[DataFrame] = []
    level = df.withColumn("_pending", F.lit(True))
    for width in widths:
        part = list(keys)
        if width is not None:
            level = level.withColumn("_block", floor_to(position, width))
            part.append("_block")
        window = Window.partitionBy(*part).orderBy(position)
        last = width is None or back == 0
        flags = (
            {}
            if last
            else {
                "_head": F.lag(F.lit(1), back).over(window).isNull(),
                "_tail": F.lead(F.lit(1), back).over(window).isNull(),
            }
        )
        seen = level.select("*", *[c.alias(name) for name, c in flags.items()],
                            *[make(window).alias(name) for name, make in compute.items()])
        final = F.col("_pending") if last else F.col("_pending") & ~F.col("_head")
        done.append(seen.where(final).select(*df.columns, *compute))
        if not last:
            level = seen.where(F.col("_head") | F.col("_tail")).select(
                *df.columns, (F.col("_pending") & F.col("_head")).alias("_pending")
            )
    return done


def trailing(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    rows: int,
    compute: Compute,
    spacing: int = 1,
    max_rows: int | None = None,
) -> DataFrame:
    first, *others = trailing_levels(df, keys, position, rows, compute, spacing, max_rows)
    for other in others:
        first = first.unionByName(other)
    return first


def rolling_mean(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    rows: int,
    means: Mapping[str, str],
    spacing: int = 1,
    max_rows: int | None = None,
) -> DataFrame:
    """Mean over the current and the ``rows - 1`` rows before it, skipping nulls;
    null where the window has no value. ``means`` maps output to input names.
    NaN counts as null."""
    df = df.withColumns({c: known(df, c) for c in set(means.values())})
    return trailing(
        df,
        keys,
        position,
        rows,
        {
            out: (lambda w, c=c: F.avg(c).over(w.rowsBetween(-(rows - 1), 0)))
            for out, c in means.items()
        },
        spacing,
        max_rows,
    )


def ranked(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """``_rank``: a position in the order of each series with no gaps but one between
    tasks, for orders whose values lie any distance apart.

    Rows are range-partitioned by series and order, and numbered within their task. Other
    columns break ties, so that many rows without an order don't lie in one task.
    """
    by = [*keys, order, *(c for c in df.columns if c not in (*keys, order))]
    rows = df.repartitionByRange(*by).sortWithinPartitions(*by)
    return rows.withColumn("_rank", F.monotonically_increasing_id())


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    columns: Mapping[str, str],
    spacing: int = 1,
) -> DataFrame:
    """Values of the row before; null in the first row of a series."""
    return trailing(
        df,
        keys,
        position,
        2,
        {out: (lambda w, c=c: F.lag(c, 1).over(w)) for out, c in columns.items()},
        spacing,
    )


def rolling_mean_time(
    df: DataFrame,
    keys: Sequence[str],
    us: str,
    value: str,
    window_us: int,
    unit_us: int = 1_000_000,
    name: str = "mean",
) -> DataFrame:
    """Mean over ``(t - window, t]``, one row per distinct time. NaN counts as null.

    Times are whole multiples of ``unit_us``. Readings at one time are summed first,
    so however many share it, a block holds at most one row per unit.

    Blocks are no longer than the window, so it begins in an earlier block than it ends
    in. Its sum is put together from three parts that hold readings of the window only:
    the end of the block where it begins, whole blocks between, and the row's own block
    up to the row. Nothing is subtracted, so an extreme reading leaves no trace in the
    windows after it. For the first part each row also goes to the block where its
    window begins, as a mark without a value. The cost is in proportion to the rows,
    whatever the window; whole blocks between are at most ``BLOCKS``.
    """
    most = BLOCK_ROWS * unit_us
    length = window_us if window_us <= most else max(most, floor_up(window_us, BLOCKS) // BLOCKS)
    sums = (
        df.where(F.col(us).isNotNull())
        .select(*keys, floor_to(us, unit_us).alias(us), known(df, value).cast("double").alias("_v"))
        .groupBy(*keys, us)
        .agg(F.sum("_v").alias("_sum"), F.count("_v").alias("_n"))
    )
    begin = F.col(us) - F.lit(window_us).cast("bigint")
    part = lambda at, mark, total, n: sums.select(
        *keys,
        floor_to(at, length).alias("_block"),
        at.alias("_at"),
        F.lit(mark).alias("_mark"),
        F.col(us).alias("_home"),
        total.alias("_sum"),
        n.alias("_n"),
    )
    ends = part(F.col(us), 0, F.col("_sum"), F.col("_n"))
    begins = part(begin, 1, F.lit(None).cast("double"), F.lit(0).cast("bigint"))
    # A reading at the beginning itself is outside of the window: from the end of the
    # block on, the mark comes before it.
    block = Window.partitionBy(*keys, "_block")
    so_far = block.orderBy("_at", "_mark").rowsBetween(Window.unboundedPreceding, 0)
    from_end = block.orderBy(F.desc("_at"), F.desc("_mark")).rowsBetween(Window.unboundedPreceding, 0)
    is_end = F.col("_mark") == 0
    ran = ends.unionByName(begins).select(
        *keys, "_block", "_mark", "_home",
        *[
            F.when(is_end, F.sum(c).over(so_far)).otherwise(F.sum(c).over(from_end)).alias(c)
            for c in ("_sum", "_n")
        ],
    )
    pick = lambda name, mark: F.max(F.when(F.col("_mark") == mark, F.col(name)))
    rows = ran.groupBy(*keys, "_home").agg(
        F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"), pick("_block", 0).alias("_block"),
        pick("_block", 1).alias("_first"),
    )
    # Whole blocks between: one fewer than ``near``, or ``near``.
    near = window_us // length
    if near > 1 or window_us % length:
        blocks = sums.groupBy(*keys, floor_to(us, length).alias("_block")).agg(
            F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n")
        )
        wide = lambda c, n: F.sum(c).over(
            Window.partitionBy(*keys).orderBy("_block").rangeBetween(-n * length, -length)
        )
        whole = blocks.select(
            *keys, "_block",
            *[
                (wide(c, n) if n else F.lit(None)).cast(kind).alias(f"{c}{i}")
                for c, kind in (("_sum", "double"), ("_n", "bigint"))
                for i, n in enumerate((near - 1, near))
            ],
        )
        far = F.col("_block") - F.col("_first") > F.lit(near * length).cast("bigint")
        plus = lambda c: F.when(far, F.col(f"{c}1")).otherwise(F.col(f"{c}0"))
        none = {"_sum": F.lit(0.0), "_n": F.lit(0)}
        rows = match(rows, whole, [*keys, "_block"]).withColumns(
            {
                c: F.when(F.col(c).isNotNull() | plus(c).isNotNull(), F.coalesce(c, none[c]) + F.coalesce(plus(c), none[c]))
                for c in none
            }
        )
    n = F.col("_n").cast("bigint")
    return rows.select(*keys, F.col("_home").alias(us), F.when(n > 0, F.col("_sum") / n).alias(name), n.alias("n"))


def floor_up(value: int, unit: int) -> int:
    """The smallest multiple of ``unit`` that is not below ``value``."""
    return -(-value // unit) * unit
