"""The same results in plain SQL, for the comparison with another engine."""

from __future__ import annotations

from tidemark.queries import END, LIVE, MARK, NUDGE, RATES, USERS

HOUR_S = 3600

RAW = """
raw AS (
  SELECT event_id AS id, user_id, user_id % 2 AS ship, nullif(user_id % 3, 0) AS team,
         CASE event_type WHEN 'click' THEN 'rhodamine' WHEN 'view' THEN 'ph'
                         WHEN 'purchase' THEN 'tsg' ELSE 'gps' END AS source,
         epoch_us(ts) // 1000000 AS t,
         CASE event_type WHEN 'click' THEN value WHEN 'view' THEN -0.95 + (value % 7) / 100
                         WHEN 'purchase' THEN 10 + value % 15 ELSE 42 + value % 1 END AS a,
         CASE event_type WHEN 'view' THEN 7.5 + (value % 10) / 10
                         WHEN 'purchase' THEN 30 + value % 8
                         WHEN 'signup' THEN -70 + value % 1 END AS b
  FROM events WHERE event_type IN ('click', 'view', 'purchase', 'signup')
)"""

COLUMNS = {
    "latitude": ("gps", "a"),
    "longitude": ("gps", "b"),
    "rho_ppb": ("rhodamine", "a"),
    "ph_total": ("ph", "b"),
    "vrse": ("ph", "a"),
    "temp": ("tsg", "a"),
    "salinity": ("tsg", "b"),
}

SUMMARY = (
    "latitude", "longitude", "rho_ppb", "ph_total", "vrse", "ph_corrected",
    "temp", "salinity", "ph_corrected_ma", "ph_total_ma",
)


def _pivot(fn: str = "max", skip: tuple[str, ...] = ()) -> str:
    return ", ".join(
        f"{fn}({slot}) FILTER (WHERE source = '{source}') AS {name}"
        if source not in skip
        else f"CAST(NULL AS DOUBLE) AS {name}"
        for name, (source, slot) in COLUMNS.items()
    )


def _rounded(names) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in names)


def _any(names=tuple(COLUMNS)) -> str:
    return "coalesce(" + ", ".join(names) + ") IS NOT NULL"


def nearest(
    keys: tuple[str, ...] = (), tolerance: int = HOUR_S, skip: tuple[str, ...] = (), step: int = HOUR_S, where: str = "true"
) -> str:
    """``aligned``: grid points within reach of a sample, best sample per source."""
    k = "".join(f"{c}, " for c in keys)
    by = f"PARTITION BY {k}source, g" if keys else "PARTITION BY source, g"
    same = " AND ".join(f"best.{c} IS NOT DISTINCT FROM first.{c}" for c in keys) or "true"
    group = f" GROUP BY {k.rstrip(', ')}" if keys else ""
    start = f"JOIN (SELECT {k}min(t) // {step} * {step} AS lo FROM kept{group}) first ON {same}"
    steps = tolerance // step + 1
    gone = "".join(f" AND source <> '{s}'" for s in skip)
    return f"""{RAW},
kept AS (SELECT * FROM raw WHERE {where}{gone}),
offered AS (
  SELECT *, t // {step} * {step} + o * {step} AS g
  FROM kept CROSS JOIN (SELECT unnest(range(-{steps}, {steps} + 2)) AS o)
  WHERE abs(t // {step} * {step} + o * {step} - t) <= {tolerance}
),
best AS (
  SELECT best.* FROM (
    SELECT *, row_number() OVER ({by} ORDER BY abs(g - t), t DESC, id) AS nth FROM offered
  ) best {start} WHERE best.nth = 1 AND best.g >= first.lo
),
aligned AS (
  SELECT * FROM (
    SELECT {k}g AS datetime_utc, {_pivot(skip=skip)} FROM best GROUP BY {k}g
  ) WHERE {_any()}
)"""


def fill(keys: tuple[str, ...] = ()) -> str:
    """``aligned``: every source on its own grid, nearest sample however far."""
    k = "".join(f"{c}, " for c in keys)
    same = " AND ".join(f"x.{c} = s.{c}" for c in (*keys, "source"))
    return f"""{RAW},
firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {k}source, t ORDER BY id) AS nth FROM raw)
  WHERE nth = 1
),
points AS (
  SELECT {k}source, unnest(range(min(t) // {HOUR_S} * {HOUR_S}, max(t) + 1, {HOUR_S})) AS g
  FROM firsts GROUP BY {k}source
),
before AS (
  SELECT x.*, s.t AS pt, s.a AS pa, s.b AS pb
  FROM points x ASOF LEFT JOIN firsts s ON {same} AND x.g >= s.t
),
around AS (
  SELECT x.*, s.t AS nt, s.a AS na, s.b AS nb
  FROM before x ASOF LEFT JOIN firsts s ON {same} AND x.g <= s.t
),
filled AS (
  SELECT {k}source, g,
         CASE WHEN nt IS NULL OR g - pt < nt - g THEN pa ELSE na END AS a,
         CASE WHEN nt IS NULL OR g - pt < nt - g THEN pb ELSE nb END AS b
  FROM around
),
aligned AS (SELECT {k}g AS datetime_utc, {_pivot()} FROM filled GROUP BY {k}g)"""


def ph(volts: str, t: str, s: str, k0: float, k2: float) -> str:
    tk = f"({t} + 273.15)"
    water = f"(1000.0 - 1.005 * {s})"
    i = f"(19.924 * {s} / {water})"
    adh = f"(3.4286e-6 * {t} * {t} + 6.7524e-4 * {t} + 0.49172143)"
    lgam = f"(-{adh} * sqrt({i}) / (1 + 1.394 * sqrt({i})) + (0.08885 - 0.000111 * {t}) * {i})"
    ks = (
        f"(exp(-4276.1 / {tk} + 141.328 - 23.093 * ln({tk})"
        f" + (-13856 / {tk} + 324.57 - 47.986 * ln({tk})) * sqrt({i})"
        f" + (35474 / {tk} - 771.54 + 114.723 * ln({tk})) * {i}"
        f" - 2698 / {tk} * pow({i}, 1.5) + 1776 / {tk} * {i} * {i}) * (1 - 0.001005 * {s}))"
    )
    return (
        f"(({volts} - ({k0} + {k2} * {t})) / (8.31446 * {tk} / 96485.0 * ln(10.0))"
        f" + log10(0.99889 / 35.453 * {s} / 1.80655 * 1000 / {water}) + 2 * {lgam}"
        f" - log10({water} / 1000) - log10(1 + 0.1400 / 96.062 * {s} / 1.80655 / {ks}))"
    )


def with_ph(keys: tuple[str, ...] = ()) -> str:
    formula = ph("vrse", "temp", "salinity", f"({LIVE.k0})", f"({LIVE.k2})")
    return f"calibrated AS (SELECT *, {formula} AS ph_corrected FROM aligned)"


def with_means(ph_only: bool, keys: tuple[str, ...] = ()) -> str:
    part = [*keys, *(["ph_total IS NOT NULL"] if ph_only else [])]
    by = f"PARTITION BY {', '.join(part)} " if part else ""
    window = f"OVER ({by}ORDER BY datetime_utc ROWS BETWEEN {LIVE.window_rows - 1} PRECEDING AND CURRENT ROW)"
    mean = lambda c: (
        f"CASE WHEN ph_total IS NOT NULL THEN avg({c}) {window} END" if ph_only else f"avg({c}) {window}"
    )
    return (
        f"averaged AS (SELECT *, {mean('ph_corrected')} AS ph_corrected_ma, "
        f"{mean('ph_total')} AS ph_total_ma FROM calibrated)"
    )


def summary(kind: str, ph_only: bool, keys: tuple[str, ...] = (), kept: str = "true") -> str:
    source = nearest(keys, where=kept) if kind == "live" else fill(keys)
    return f"WITH {source}, {with_ph(keys)}, {with_means(ph_only, keys)}"


def _aligned(cte: str, keys: tuple[str, ...] = ()) -> str:
    k = "".join(f"{c}, " for c in keys)
    return f"WITH {cte} SELECT {k}datetime_utc, {_rounded(COLUMNS)} FROM aligned"


def _summary(kind: str, ph_only: bool, where: str = "true", keys: tuple[str, ...] = ()) -> str:
    k = "".join(f"{c}, " for c in keys)
    return (
        f"{summary(kind, ph_only, keys)} SELECT {k}datetime_utc, {_rounded(SUMMARY)} "
        f"FROM averaged WHERE {where}"
    )


def _averages(ph_only: bool) -> str:
    names = ("ph_corrected", "ph_total", "ph_corrected_ma", "ph_total_ma")
    return f"{summary('live', ph_only)} SELECT datetime_utc, {_rounded(names)} FROM averaged"


SIX_HOURS = 6 * HOUR_S

def means(keys: tuple[str, ...] = ()) -> str:
    k = "".join(f"{c}, " for c in keys)
    return (
        f"{summary('live', True, keys)}, means AS (SELECT {k}datetime_utc // {SIX_HOURS} * {SIX_HOURS} AS datetime_utc, "
        + ", ".join(f"avg({c}) AS {c}" for c in SUMMARY)
        + f" FROM averaged GROUP BY {k}datetime_utc // {SIX_HOURS} * {SIX_HOURS})"
    )


MEANS = means()

# A stream writes what no reading can change that is not older than those of the
# slowest sensor.
EMITTED = f"datetime_utc <= (SELECT min(m) FROM (SELECT max(t) // {HOUR_S} * {HOUR_S} - {HOUR_S} AS m FROM kept GROUP BY source))"
IN_TIME = f"t NOT BETWEEN {MARK} AND {MARK + 6 * 3600}"

TIMED = "timed AS (SELECT *, epoch_us(ts) // 1000000 AS datetime_utc FROM events)"

LAGS = f"""{TIMED}, lags AS (
  SELECT datetime_utc, d FROM (
    SELECT datetime_utc, datetime_utc - lag(datetime_utc) OVER (ORDER BY datetime_utc) AS d FROM timed
  ) WHERE d IS NOT NULL
)"""

ORDERS = """arrivals AS (
  SELECT o_orderkey, day, lag(day) OVER (ORDER BY o_orderkey) AS prev_day
  FROM (SELECT o_orderkey, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS day FROM orders)
)"""

ISO = "strftime(make_timestamp(datetime_utc * 1000000), '%Y-%m-%dT%H:%M:%SZ')"


def _distinct_lag(keys: str = "") -> str:
    by = f"PARTITION BY {keys} " if keys else ""
    k = f"{keys}, " if keys else ""
    return (
        f"SELECT {k}datetime_utc, datetime_utc - lag(datetime_utc) OVER ({by}ORDER BY datetime_utc) AS lag_s, n "
        f"FROM (SELECT {k}datetime_utc, count(*) AS n FROM timed GROUP BY {k}datetime_utc)"
    )


def _stats(name: str, source: str) -> str:
    return f"""
  SELECT '{name}' AS table_name, count(*) AS n_intervals, avg(d) AS mean_s, median(d) AS median_s,
         stddev_samp(d) AS std_s, min(d) AS min_s, max(d) AS max_s FROM {source}"""


def _series_metrics(rows: str, order: bool) -> dict[str, str]:
    lags = f"(SELECT d FROM (SELECT t - lag(t) OVER (ORDER BY t) AS d FROM {rows}) WHERE d IS NOT NULL)"
    late = f"(SELECT t < lag(t) OVER (ORDER BY id) AS late FROM {rows})"
    stats = f"(SELECT avg(d) AS m, stddev_samp(d) AS s FROM {lags})"
    metrics = {
        "n_rows": f"SELECT count(*) FROM {rows}",
        "duplicates": f"SELECT count(*) - count(DISTINCT t) FROM {rows}",
        "n_intervals": f"SELECT count(*) FROM {lags}",
        "mean_s": f"SELECT avg(d) FROM {lags}",
        "median_s": f"SELECT median(d) FROM {lags}",
        "std_s": f"SELECT stddev_samp(d) FROM {lags}",
        "min_s": f"SELECT min(d) FROM {lags}",
        "max_s": f"SELECT max(d) FROM {lags}",
        "irregular": f"SELECT count(*) FILTER (WHERE abs(d - m) > 2 * s) FROM {lags} CROSS JOIN {stats}",
        "irregular_pct": f"SELECT count(*) FILTER (WHERE abs(d - m) > 2 * s) * 100.0 / count(*) FROM {lags} CROSS JOIN {stats}",
    }
    if order:
        metrics["out_of_order"] = f"SELECT count(*) FILTER (WHERE late) FROM {late}"
        metrics["out_of_order_pct"] = f"SELECT count(*) FILTER (WHERE late) * 100.0 / count(*) FROM {late}"
    return metrics


def quality_report_incremental() -> str:
    rows = {s: f"(SELECT * FROM raw WHERE source = '{s}')" for s in ("rhodamine", "ph", "tsg", "gps")}
    rows["events"] = "(SELECT epoch_us(ts) // 1000000 AS t FROM events)"
    left_out = ("median_s", "irregular", "irregular_pct")
    parts = [
        f"SELECT '{name}' AS table_name, '{m}' AS metric, CAST(NULL AS VARCHAR) AS column_name, round(CAST(({sql}) AS DOUBLE), 6) AS value"
        for name, own in rows.items()
        for m, sql in {**_series_metrics(own, False), "median_within": "SELECT 1"}.items()
        if m not in left_out
    ]
    n = "count(*) FILTER (WHERE event_id % 5 = 0)"
    for metric, value in (("missing", n), ("missing_pct", f"{n} * 100.0 / count(*)")):
        parts.append(f"SELECT 'events', '{metric}', 'value', round(CAST({value} AS DOUBLE), 6) FROM events HAVING {n} > 0")
    return f"WITH {RAW} " + " UNION ALL ".join(parts)


def quality_report_outputs() -> str:
    parts = []
    for name in ("output", "items"):
        metrics = _series_metrics("(SELECT datetime_utc AS t FROM means)", False)
        parts += [
            f"SELECT '{name}' AS table_name, '{m}' AS metric, CAST(NULL AS VARCHAR) AS column_name, round(CAST(({sql}) AS DOUBLE), 6) AS value"
            for m, sql in metrics.items()
        ]
        for c in SUMMARY:
            n = f"count(*) FILTER (WHERE {c} IS NULL)"
            for metric, value in (("missing", n), ("missing_pct", f"{n} * 100.0 / count(*)")):
                parts.append(f"SELECT '{name}', '{metric}', '{c}', round(CAST({value} AS DOUBLE), 6) FROM means HAVING {n} > 0")
    return MEANS + " " + " UNION ALL ".join(parts)


def quality_report() -> str:
    rows = {s: f"(SELECT * FROM raw WHERE source = '{s}')" for s in ("rhodamine", "ph", "tsg", "gps")}
    rows["summary"] = "(SELECT *, datetime_utc AS t FROM averaged)"
    rows["events"] = "(SELECT epoch_us(ts) // 1000000 AS t FROM events)"
    parts = [
        f"SELECT '{name}' AS table_name, '{m}' AS metric, CAST(NULL AS VARCHAR) AS column_name, round(CAST(({sql}) AS DOUBLE), 6) AS value"
        for name, own in rows.items()
        for m, sql in _series_metrics(own, name in ("rhodamine", "ph", "tsg", "gps")).items()
    ]
    missing = {("summary", c): f"count(*) FILTER (WHERE {c} IS NULL)" for c in SUMMARY}
    missing["events", "value"] = "count(*) FILTER (WHERE event_id % 5 = 0)"
    for (name, c), n in missing.items():
        table = "averaged" if name == "summary" else "events"
        for metric, value in (("missing", n), ("missing_pct", f"{n} * 100.0 / count(*)")):
            parts.append(
                f"SELECT '{name}', '{metric}', '{c}', round(CAST({value} AS DOUBLE), 6) FROM {table} HAVING {n} > 0"
            )
    return summary("live", True) + " " + " UNION ALL ".join(parts)


def null_report() -> str:
    total = "SELECT count(*) FROM events"
    parts = [
        f"SELECT '{name}' AS column_name, ({total}) - (SELECT count(*) FROM raw WHERE source = '{source}') AS missing, "
        f"round((({total}) - (SELECT count(*) FROM raw WHERE source = '{source}')) * 100.0 / ({total}), 6) AS missing_pct"
        for name, (source, _) in COLUMNS.items()
    ]
    return f"WITH {RAW} SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE missing > 0"


def _rolling_time(keys: tuple[str, ...] = ()) -> str:
    k = "".join(f"{c}, " for c in keys)
    by = f"PARTITION BY {', '.join(keys)} " if keys else ""
    window = f"OVER ({by}ORDER BY t RANGE BETWEEN {SIX_HOURS - 1} PRECEDING AND CURRENT ROW)"
    return (
        f"WITH {RAW} SELECT DISTINCT {k}t AS datetime_utc, round(avg(b) {window}, 6) AS ph_total_mean, "
        f"count(b) {window} AS n FROM raw WHERE source = 'ph'"
    )


PICK = " OR ".join(f"{c} IS NULL" for c in COLUMNS)

ORACLES: dict[str, str] = {
    "nearest_align": _aligned(nearest()),
    "nearest_align_wide_order": _aligned(nearest()),
    "big_ids": _aligned(nearest()),
    "null_key_align": _aligned(nearest(("team",)), ("team",)),
    "several_rates": " UNION ALL ".join(
        f"SELECT CAST({step} AS INTEGER) AS step_s, * FROM ({_aligned(nearest(tolerance=step, step=step))})" for step in RATES
    ),
    "nearest_align_by_user": _aligned(nearest(("user_id",)), ("user_id",)),
    "nearest_align_tolerance": _aligned(nearest(tolerance=HOUR_S * 5 // 2)),
    "nearest_fill": _aligned(fill()),
    "nearest_fill_by_user": _aligned(fill(("user_id",)), ("user_id",)),
    "missing_sensor": _aligned(nearest(skip=("gps",))),
    "time_grid": f"WITH {RAW} SELECT unnest(range(min(t) // {HOUR_S} * {HOUR_S}, max(t) + {HOUR_S} + 1, {HOUR_S})) AS datetime_utc FROM raw",
    "extent": f"WITH {RAW} SELECT min(t) AS first_s, max(t) AS last_s FROM raw",
    "mean_resample": f"WITH {RAW}, aligned AS (SELECT t // {HOUR_S} * {HOUR_S} AS datetime_utc, {_pivot('avg')} FROM raw GROUP BY 1) "
    f"SELECT datetime_utc, {_rounded(COLUMNS)} FROM aligned WHERE {_any()}",
    "nan_means": f"WITH {RAW}, aligned AS (SELECT t // {HOUR_S} * {HOUR_S} AS datetime_utc, "
    + ", ".join(f"avg({slot}) FILTER (WHERE source = '{s}' AND id % 5 <> 0) AS {c}" for c, (s, slot) in COLUMNS.items())
    + f" FROM raw GROUP BY 1) SELECT datetime_utc, {_rounded(COLUMNS)} FROM aligned WHERE {_any()}",
    "dedup_first": f"WITH {RAW}, firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, t ORDER BY id) AS nth FROM raw) WHERE nth = 1) "
    f"SELECT source, t AS datetime_utc, id, "
    + ", ".join(f"round(CASE WHEN source = '{s}' THEN {slot} END, 6) AS {c}" for c, (s, slot) in COLUMNS.items())
    + " FROM firsts",
    "drop_repeats": f"WITH {TIMED} SELECT datetime_utc, event_id, round(value, 6) AS value FROM "
    "(SELECT *, row_number() OVER (PARTITION BY datetime_utc ORDER BY event_id) AS nth FROM timed) WHERE nth = 1",
    "corrected_ph": "WITH readings AS (SELECT event_id, -0.95 + (value % 7) / 100 AS v, 10 + value % 15 AS t, 30 + value % 8 AS s FROM events) "
    f"SELECT event_id, round({ph('v', 't', 's', f'({LIVE.k0})', f'({LIVE.k2})')}, 6) AS ph_corrected FROM readings",
    "floor_times": f"WITH {TIMED} SELECT event_id, datetime_utc // {SIX_HOURS} * {SIX_HOURS} AS six_hours, "
    f"datetime_utc // 7 * 7 AS seven_seconds, {ISO} AS iso FROM timed",
    "time_coercion": f"WITH {TIMED} SELECT event_id, CASE WHEN event_id % 3 < 2 THEN datetime_utc END AS datetime_utc FROM timed",
    "conform_columns": "SELECT event_id, CAST(NULL AS DOUBLE) AS salinity, value FROM events",
    "drop_empty_rows": f"WITH {RAW} SELECT id, CASE WHEN source = 'tsg' THEN round(a, 6) END AS temp, CASE WHEN source = 'tsg' THEN round(b, 6) END AS salinity, "
    "CASE WHEN source = 'gps' THEN round(a, 6) END AS latitude FROM raw WHERE source IN ('tsg', 'gps')",
    "drop_null_key": f"WITH {RAW} SELECT id, round(b, 6) AS ph_total FROM raw WHERE source = 'ph'",
    "nan_is_missing": "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN value END AS value FROM events",
    "iso_rows": f"WITH {TIMED} SELECT event_id, {ISO} AS time FROM timed",
    "items": f"WITH {TIMED} SELECT 'data' AS static_partition, {ISO} AS datetime_utc, event_id, event_type, "
    "CASE WHEN event_id % 4 <> 0 THEN value END AS value, event_id % 4 <> 0 AS has_value FROM timed",
    "item_scan_untyped": f"WITH {RAW} SELECT t AS datetime_utc, id, user_id, "
    + ", ".join(f"round(CASE WHEN source = '{source}' THEN {slot} END, 6) AS {c}" for c, (source, slot) in COLUMNS.items())
    + " FROM raw",
    "item_scan": f"WITH {TIMED} SELECT datetime_utc, event_id, value FROM timed",
    "ph_moving_average_rows": _averages(False),
    "ph_moving_average_ph_only": _averages(True),
    "rolling_mean_time": _rolling_time(),
    "rolling_mean_time_by_user": _rolling_time(("user_id",)),
    "rolling_mean_time_spikes": f"WITH {RAW}, spiked AS (SELECT t, CASE WHEN id % 97 = 0 THEN 1e17 ELSE b END AS b "
    "FROM raw WHERE source = 'ph'), means AS (SELECT DISTINCT t AS datetime_utc, avg(b) OVER w AS mean, "
    f"count(b) OVER w AS n FROM spiked WINDOW w AS (ORDER BY t RANGE BETWEEN {SIX_HOURS - 1} PRECEDING AND CURRENT ROW)) "
    "SELECT datetime_utc, n, mean > 1e9 AS spiked, CASE WHEN mean <= 1e9 THEN round(mean, 6) END AS ph_total_mean FROM means",
    "underway_summary": _summary("live", True),
    "underway_summary_batch": _summary("batch", False),
    "underway_summary_by_user": _summary("live", True, keys=("user_id",)),
    "incremental_equals_batch": _summary("live", True),
    "incremental_batch_mode": _summary("batch", False),
    "late_series": _summary("live", True, keys=("ship",)),
    "snapshot_read": " UNION ALL ".join(
        f"SELECT *, CAST({run} AS INTEGER) AS run FROM ({summary('live', True, kept=kept)} "
        f"SELECT datetime_utc, {_rounded(SUMMARY)} FROM averaged WHERE {EMITTED})"
        for run, kept in enumerate([f"t <= {MARK + 1234}", f"t <= {END + 4321}", "true", "true"], 1)
    ),
    "rebuild_summary": _summary("live", True),
    "output_means": f"{MEANS} SELECT datetime_utc, {_rounded(SUMMARY)} FROM means",
    "output_means_by_user": f"{means(('user_id',))} SELECT user_id, datetime_utc, {_rounded(SUMMARY)} FROM means",
    "output_mark": f"{MEANS} SELECT max(datetime_utc) AS datetime_utc FROM means",
    "streaming_summary": _summary("live", True, EMITTED),
    "streaming_summary_by_user": _summary("live", True, EMITTED, ("user_id",)),
    "streaming_restart": f"SELECT *, CAST(2 AS BIGINT) AS failures FROM ({_summary('live', True, EMITTED)})",
    "stream_state": f"WITH {nearest()}, mark AS (SELECT min(m) AS w FROM (SELECT max(t) // {HOUR_S} * {HOUR_S} - {HOUR_S} AS m "
    "FROM raw GROUP BY source)) SELECT count(DISTINCT g) AS n_rows, min(g) AS first_s, max(g) AS last_s, "
    + ", ".join(f"max(g) FILTER (source = '{s}') AS {s}_s" for s in ("rhodamine", "ph", "tsg", "gps"))
    + ", any_value(w) AS watermark_s FROM offered, mark WHERE g > w",
    "late_readings": f"WITH {RAW} SELECT source, count(*) AS n_rows, "
    f"count(*) FILTER (WHERE NOT ({IN_TIME})) AS n_late FROM raw GROUP BY source",
    "streaming_reset": _summary("live", True, EMITTED),
    "streaming_late_rows": f"SELECT *, true AS counted FROM ({summary('live', True, kept=IN_TIME)} "
    f"SELECT datetime_utc, {_rounded(SUMMARY)} FROM averaged WHERE {EMITTED})",
    "streaming_means_by_user": f"{means(('user_id',))} SELECT user_id, datetime_utc, {_rounded(SUMMARY)} FROM means "
    f"WHERE datetime_utc + {SIX_HOURS} <= (SELECT max(datetime_utc) FROM averaged)",
    "streaming_means": f"{MEANS} SELECT datetime_utc, {_rounded(SUMMARY)} FROM means "
    f"WHERE datetime_utc + {SIX_HOURS} <= (SELECT max(datetime_utc) FROM averaged)",
    "new_rows_anti": f"WITH {TIMED} SELECT datetime_utc, event_id, event_type FROM timed x "
    "WHERE NOT EXISTS (SELECT 1 FROM timed y WHERE y.event_type = 'error' AND y.datetime_utc = x.datetime_utc)",
    "idempotent_append": f"WITH {TIMED}, firsts AS (SELECT * FROM (SELECT datetime_utc, event_id, value, "
    "row_number() OVER (PARTITION BY datetime_utc ORDER BY event_id) AS nth FROM timed) WHERE nth = 1) "
    f"SELECT datetime_utc, event_id, CASE WHEN datetime_utc < {END} THEN value ELSE -value END AS value FROM firsts",
    "table_append": f"WITH {TIMED} SELECT datetime_utc, event_id, event_type FROM timed",
    "partitioned_output": f"WITH {TIMED} SELECT strftime(make_timestamp(datetime_utc // {SIX_HOURS} * {SIX_HOURS} * 1000000), '%Y-%m-%d-%H') AS \"partition\", "
    "count(*) AS n_rows, round(sum(value), 6) AS total FROM timed GROUP BY 1",
    "csv_output": f"WITH {TIMED} SELECT datetime_utc, event_id, value FROM timed",
    "keyed_items": f"WITH {TIMED} SELECT {ISO} AS datetime_utc, event_id, "
    f"round(CASE WHEN datetime_utc > {MARK} THEN value + 1 ELSE value END, 6) AS value FROM "
    "(SELECT *, row_number() OVER (PARTITION BY datetime_utc ORDER BY event_id) AS nth FROM timed) WHERE nth = 1",
    "union_by_name": f"WITH {RAW} SELECT id, "
    + ", ".join(f"CASE WHEN source = '{src}' THEN round({slot}, 6) END AS {c}" for c, (src, slot) in COLUMNS.items())
    + " FROM raw",
    "pruned_scan": "SELECT event_id, value FROM events",
    "scan_after_mark": f"WITH {TIMED} SELECT datetime_utc, event_id, value FROM timed WHERE datetime_utc > {MARK}",
    "ordered_scan": f"WITH {TIMED} SELECT datetime_utc, event_id FROM timed WHERE datetime_utc > {MARK} ORDER BY 1, 2",
    "max_time": f"WITH {TIMED} SELECT max(datetime_utc) AS datetime_utc FROM timed",
    "latest_n": f"WITH {TIMED} SELECT datetime_utc, event_id, value FROM timed ORDER BY datetime_utc DESC, event_id DESC LIMIT 200",
    "first_n": f"WITH {TIMED} SELECT datetime_utc, event_id, value FROM timed ORDER BY datetime_utc, event_id LIMIT 5",
    "since_mark_by_user": _summary("live", True, f"datetime_utc > {MARK} AND user_id IN {USERS}", ("user_id",)),
    "footer_extent": f"WITH {RAW} SELECT source, min(t) AS first_s, max(t) AS last_s, count(*) AS n_rows FROM raw GROUP BY source",
    "since_mark": _summary("live", True, f"datetime_utc > {MARK}"),
    "time_range": _summary("live", True, f"datetime_utc BETWEEN {MARK} AND {END}"),
    "representative_row": f"WITH {nearest()}, ranked AS (SELECT *, row_number() OVER (ORDER BY datetime_utc) AS nth, ({PICK}) AS part FROM aligned) "
    f"SELECT datetime_utc, {_rounded(COLUMNS)} FROM ranked WHERE NOT part OR nth <= 2 "
    "ORDER BY part, CASE WHEN part THEN -nth ELSE nth END LIMIT 1",
    "duplicate_examples": f"WITH {TIMED} SELECT datetime_utc, count(*) AS occurrences FROM timed GROUP BY 1 HAVING count(*) > 1 ORDER BY 1 LIMIT 3",
    "null_report": null_report(),
    "freshness": f"WITH {RAW} SELECT source, count(*) AS n_rows, max(t) AS last_s FROM raw GROUP BY source "
    "UNION ALL SELECT event_type, count(*), max(epoch_us(ts) // 1000000) FROM events "
    "WHERE event_type NOT IN ('click', 'view', 'purchase', 'signup') GROUP BY event_type",
    "state_summary": f"{summary('live', True)}, last_ph AS (SELECT datetime_utc FROM averaged WHERE ph_total IS NOT NULL "
    f"ORDER BY datetime_utc DESC LIMIT {LIVE.window_rows - 1}) "
    "SELECT source AS name, count(*) AS n_rows, max(t) AS last_s FROM raw GROUP BY source "
    "UNION ALL SELECT 'summary', count(*), max(datetime_utc) FROM averaged "
    "UNION ALL SELECT 'history', count(*), max(datetime_utc) FROM last_ph",
    "interval_stats": f"WITH {LAGS} SELECT count(*) AS n_intervals, round(avg(d), 6) AS mean_s, round(CAST(median(d) AS DOUBLE), 6) AS median_s, "
    "round(stddev_samp(d), 6) AS std_s, CAST(min(d) AS DOUBLE) AS min_s, CAST(max(d) AS DOUBLE) AS max_s FROM lags",
    "interval_stats_by_user": f"WITH {TIMED}, lags AS (SELECT user_id, datetime_utc - lag(datetime_utc) OVER (PARTITION BY user_id ORDER BY datetime_utc) AS d FROM timed) "
    "SELECT user_id, count(d) AS n_intervals, round(avg(d), 6) AS mean_s, round(CAST(median(d) AS DOUBLE), 6) AS median_s, "
    "round(stddev_samp(d), 6) AS std_s, CAST(min(d) AS DOUBLE) AS min_s, CAST(max(d) AS DOUBLE) AS max_s FROM lags GROUP BY user_id HAVING count(d) > 0",
    "irregular_intervals": f"WITH {LAGS}, stats AS (SELECT avg(d) AS m, stddev_samp(d) AS s FROM lags) "
    "SELECT count(*) FILTER (WHERE abs(d - m) > 2 * s) AS irregular, count(*) AS n_intervals, "
    "round(count(*) FILTER (WHERE abs(d - m) > 2 * s) * 100.0 / count(*), 6) AS irregular_pct FROM lags CROSS JOIN stats",
    "irregular_rows": f"WITH {LAGS}, stats AS (SELECT avg(d) AS m, stddev_samp(d) AS s FROM lags) "
    "SELECT datetime_utc, d AS interval_s, count(*) AS occurrences FROM lags CROSS JOIN stats WHERE abs(d - m) > 2 * s GROUP BY 1, 2",
    "duplicate_times": f"WITH {TIMED} SELECT count(*) AS n_rows, count(*) - count(DISTINCT datetime_utc) AS duplicates FROM timed",
    "gaps": f"WITH {TIMED} SELECT datetime_utc, gap_s FROM (SELECT datetime_utc, lead(datetime_utc) OVER (ORDER BY datetime_utc) - datetime_utc AS gap_s FROM timed) WHERE gap_s > 600",
    "lag_seconds": f"WITH {TIMED} {_distinct_lag()}",
    "out_of_order": f"WITH {ORDERS} SELECT count(*) AS n_rows, count(*) FILTER (WHERE day < prev_day) AS out_of_order, "
    "round(count(*) FILTER (WHERE day < prev_day) * 100.0 / count(*), 6) AS out_of_order_pct FROM arrivals",
    "out_of_order_sparse_ids": f"WITH {ORDERS} SELECT count(*) AS n_rows, count(*) FILTER (WHERE day < prev_day) AS out_of_order, "
    "round(count(*) FILTER (WHERE day < prev_day) * 100.0 / count(*), 6) AS out_of_order_pct FROM arrivals",
    "out_of_order_rows": f"WITH {ORDERS} SELECT o_orderkey, day, prev_day FROM arrivals WHERE day < prev_day",
    "quality_report": quality_report(),
    "quality_report_outputs": quality_report_outputs(),
    "quality_report_incremental": quality_report_incremental(),
}

# Round as the queries do.
ORACLES["idempotent_append_bucketed"] = ORACLES["idempotent_append"]
ORACLES = {name: sql.replace(", 6)", f" + {NUDGE}, 6)") for name, sql in ORACLES.items()}
