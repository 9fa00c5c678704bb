"""Small sensor tables for the tests, and the pandas view of results."""

from __future__ import annotations

import calendar

import pandas as pd

from tidemark.params import SENSORS, SECOND
from tidemark.sources.tables import long_frame

# 2023-01-01 00:00:00 UTC
T0 = calendar.timegm((2023, 1, 1, 0, 0, 0))


def table(spark, seconds, **columns):
    """A raw table: ids in arrival order, epoch seconds, value columns (None = null)."""
    names = list(columns)
    rows = [
        (i, int(t), *[None if v is None else float(v) for v in values])
        for i, (t, *values) in enumerate(zip(seconds, *columns.values()))
    ]
    schema = "id bigint, datetime_utc bigint" + "".join(f", {n} double" for n in names)
    return spark.createDataFrame(rows, schema)


def sensor_tables(spark, seconds, rho, ph, temp, salinity, lat, lon, vrse=None):
    seconds = list(seconds)
    vrse = [None] * len(seconds) if vrse is None else vrse
    return {
        "rhodamine": table(spark, seconds, rho_ppb=rho),
        "ph": table(spark, seconds, vrse=vrse, ph_total=ph),
        "tsg": table(spark, seconds, temp=temp, salinity=salinity),
        "gps": table(spark, seconds, latitude=lat, longitude=lon),
    }


def upto(tables, limit, low=None):
    out = {s: t.where(f"datetime_utc <= {limit}") for s, t in tables.items()}
    return out if low is None else {s: t.where(f"datetime_utc > {low}") for s, t in out.items()}


def one_sensor(spark, seconds, values, name="rho_ppb", source="rhodamine"):
    return long_frame({source: table(spark, seconds, **{name: values})})


def by_time(df, time="grid"):
    """Rows as {seconds: value dict} relative to T0; null as None."""
    pdf = df.toPandas().astype(object)
    scale = SECOND if time in ("grid", "us") else 1
    out = {}
    for row in pdf.to_dict("records"):
        t = int(row.pop(time)) // scale - T0
        out[t] = {k: None if pd.isna(v) else v for k, v in row.items()}
    return dict(sorted(out.items()))


def column(df, name, time="grid"):
    return {t: row[name] for t, row in by_time(df, time).items()}


def generated(spark, n_seconds, seed=7, ph_every=2):
    """One reading a second per sensor (pH every ``ph_every``), with noise."""
    import random

    r = random.Random(seed)
    every = lambda k: [T0 + s for s in range(0, n_seconds, k)]
    noise = lambda base, k: [base + r.random() for _ in every(k)]
    return {
        "rhodamine": table(spark, every(1), rho_ppb=noise(1, 1)),
        "ph": table(spark, every(ph_every), vrse=[-0.95 + r.random() / 100 for _ in every(ph_every)], ph_total=noise(7.5, ph_every)),
        "tsg": table(spark, every(1), temp=noise(15, 1), salinity=noise(33, 1)),
        "gps": table(spark, every(1), latitude=noise(42, 1), longitude=noise(-70, 1)),
    }


__all__ = ["T0", "SENSORS", "table", "sensor_tables", "upto", "one_sensor", "by_time", "column", "generated"]
