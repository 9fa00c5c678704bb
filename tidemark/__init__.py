"""Sensor time series on Spark: align, calibrate, average, append, report."""

from tidemark.params import Params, micros

__all__ = ["Params", "micros"]
