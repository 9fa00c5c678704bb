"""Job parameters: durations and the settings shared by batch and stream."""

from __future__ import annotations

import re
from dataclasses import dataclass

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR

_UNITS = {
    "us": 1,
    "ms": 1_000,
    "s": SECOND,
    "sec": SECOND,
    "min": MINUTE,
    "t": MINUTE,
    "h": HOUR,
    "d": DAY,
}

_DURATION = re.compile(r"^\s*(\d+(?:\.\d+)?)?\s*([a-z]+)\s*$")


def micros(duration: str | int | float) -> int:
    """Turn ``'2s'``, ``'0.5s'``, ``'5min'``, ``'1h'`` or seconds into microseconds."""
    if isinstance(duration, (int, float)):
        value = round(duration * SECOND)
    else:
        match = _DURATION.match(duration.lower())
        if not match or match.group(2) not in _UNITS:
            raise ValueError(f"not a duration: {duration!r}")
        value = round(float(match.group(1) or 1) * _UNITS[match.group(2)])
    if value <= 0:
        raise ValueError(f"duration must be positive: {duration!r}")
    return value


# Sensor tables and the columns of each that feed the summary.
SENSORS: dict[str, tuple[str, ...]] = {
    "rhodamine": ("rho_ppb",),
    "ph": ("vrse", "ph_total"),
    "tsg": ("temp", "salinity"),
    "gps": ("latitude", "longitude"),
}

# Value columns of an aligned row, in output order.
ALIGNED_COLUMNS = (
    "latitude",
    "longitude",
    "rho_ppb",
    "ph_total",
    "vrse",
    "temp",
    "salinity",
)


@dataclass(frozen=True)
class Params:
    """Settings of one job.

    ``mode='live'`` keeps one grid for all sensors and takes the nearest sample
    at most one step away; moving averages run over rows that have a pH reading.
    ``mode='batch'`` gives each sensor its own grid, fills every point of it from
    the nearest sample however far, and averages over all grid rows.
    """

    step: str = "2s"
    ma_window_s: float = 120
    ph_freq_hz: float = 0.5
    k0: float = -1.39469
    k2: float = -0.00107
    mode: str = "live"
    output_step: str = "60s"
    partition_hours: int = 6
    poll_interval: str = "10s"
    output_poll_interval: str = "60s"
    # Resolution of the raw times. Raw tables hold whole seconds.
    time_unit: str = "1s"
    # Set where raw tables are partitioned by time as the outputs are.
    raw_partition_hours: int | None = None

    def __post_init__(self) -> None:
        if self.mode not in ("live", "batch"):
            raise ValueError(f"unknown mode: {self.mode!r}")
        for duration in (self.step, self.output_step, self.poll_interval,
                         self.output_poll_interval, self.time_unit):
            micros(duration)

    @property
    def step_us(self) -> int:
        return micros(self.step)

    @property
    def output_step_us(self) -> int:
        return micros(self.output_step)

    @property
    def unit_us(self) -> int:
        return micros(self.time_unit)

    @property
    def window_rows(self) -> int:
        return max(1, int(self.ma_window_s * self.ph_freq_hz))

    @property
    def ph_rows_only(self) -> bool:
        return self.mode == "live"
