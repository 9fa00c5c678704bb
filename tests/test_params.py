import pytest

from tidemark import Params, micros
from tidemark.sources import schemas


@pytest.mark.parametrize(
    "text, expected",
    [("2s", 2_000_000), ("0.5s", 500_000), ("5min", 300_000_000), ("1h", 3_600_000_000), ("60S", 60_000_000),
     ("h", 3_600_000_000), ("250ms", 250_000), (10, 10_000_000), ("1d", 86_400_000_000)],
)
def test_durations(text, expected):
    assert micros(text) == expected


@pytest.mark.parametrize("text", ["", "2 parsecs", "0s", "-1s", "s2"])
def test_bad_durations(text):
    with pytest.raises(ValueError):
        micros(text)


def test_defaults():
    p = Params()
    assert (p.step, p.ma_window_s, p.ph_freq_hz, p.k0, p.k2) == ("2s", 120, 0.5, -1.39469, -0.00107)
    assert (p.output_step, p.partition_hours, p.poll_interval, p.output_poll_interval) == ("60s", 6, "10s", "60s")
    assert p.window_rows == 60 and p.ph_rows_only
    assert Params(ma_window_s=1, ph_freq_hz=0.1).window_rows == 1
    with pytest.raises(ValueError):
        Params(mode="other")


def test_raw_schemas():
    assert schemas.RHODAMINE.names == ["id", "datetime_utc", "gain", "voltage", "rho_ppb"]
    assert len(schemas.PH) == 21 and len(schemas.TSG) == 11
    assert schemas.GPS["nmea_time_utc"].dataType.simpleString() == "string"
    assert schemas.summary().names == [
        "datetime_utc", "latitude", "longitude", "rho_ppb", "ph_total", "vrse", "ph_corrected",
        "temp", "salinity", "ph_corrected_ma", "ph_total_ma",
    ]
    assert not schemas.RHODAMINE["datetime_utc"].nullable
