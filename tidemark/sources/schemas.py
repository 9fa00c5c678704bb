"""Schemas of the raw sensor tables, the summary and the stored items."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}


def _schema(**columns: str) -> T.StructType:
    fields = [T.StructField("id", T.LongType()), T.StructField("datetime_utc", T.LongType(), False)]
    return T.StructType(fields + [T.StructField(n, _TYPES[t]) for n, t in columns.items()])


RHODAMINE = _schema(gain="int", voltage="double", rho_ppb="double")

PH = _schema(
    samp_num="int",
    ph_timestamp="string",
    **{
        name: "double"
        for name in (
            "v_bat v_bias_pos v_bias_neg t_board h_board vrse vrse_std cevk cevk_std "
            "ce_ik i_sub cal_temp cal_sal k0 k2 ph_free ph_total"
        ).split()
    },
)

TSG = _schema(
    scan_no="int",
    cond="double",
    temp="double",
    salinity="double",
    hull_temp="double",
    time_elapsed="double",
    nmea_time="long",
    latitude="double",
    longitude="double",
)

# The receiver's own clock arrives as text as often as as a number.
GPS = _schema(nmea_time_utc="string", latitude="double", longitude="double")

RAW = {"rhodamine": RHODAMINE, "ph": PH, "tsg": TSG, "gps": GPS}

SUMMARY_VALUES = (
    "latitude",
    "longitude",
    "rho_ppb",
    "ph_total",
    "vrse",
    "ph_corrected",
    "temp",
    "salinity",
    "ph_corrected_ma",
    "ph_total_ma",
)

# Rows of the mean output, without series keys.
MEANS = T.StructType(
    [T.StructField("datetime_utc", T.TimestampType())]
    + [T.StructField(c, T.DoubleType()) for c in SUMMARY_VALUES]
)


def summary(keys: T.StructType | None = None) -> T.StructType:
    """Summary rows: series keys (if any), time in epoch seconds, the values."""
    return T.StructType(
        [*(keys.fields if keys else []), T.StructField("datetime_utc", T.LongType())]
        + [T.StructField(c, T.DoubleType()) for c in SUMMARY_VALUES]
    )


def partitioned(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("partition", T.StringType())])


ITEM = T.StructType(
    [
        T.StructField("static_partition", T.StringType()),
        T.StructField("datetime_utc", T.StringType()),
        T.StructField("item", T.StringType()),
    ]
)
