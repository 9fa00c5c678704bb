"""Total-scale pH from the voltage of an ISFET electrode, as column arithmetic.

Johnson et al., Anal. Chem. 88 (2016) 3249; Johnson, Plant & Maurer, Processing
BGC-Argo pH data at the DAC level (2018). Surface water: all pressure terms are
zero. Salinity and temperature are practical salinity and degrees Celsius.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.time import col

# Fixed values of the published calibration.
GAS_CONSTANT = 8.31446
FARADAY = 96485.0
ZERO_CELSIUS = 273.15


def corrected_ph(
    vrse: Column | str,
    temp: Column | str,
    salinity: Column | str,
    k0: float,
    k2: float,
) -> Column:
    """pH on the total scale; null if an input is missing or salinity is not positive."""
    volts, t, s = col(vrse), col(temp), col(salinity)
    kelvin = t + ZERO_CELSIUS
    water = F.lit(1000.0) - 1.005 * s

    chloride = F.lit(0.99889 / 35.453 / 1.80655) * s
    sulfate = F.lit(0.1400 / 96.062 / 1.80655) * s
    ionic = 19.924 * s / water
    root = F.sqrt(ionic)

    debye_hueckel = 3.4286e-6 * t * t + 6.7524e-4 * t + 0.49172143
    log_gamma = -debye_hueckel * root / (1 + 1.394 * root) + (0.08885 - 0.000111 * t) * ionic

    ln_k = F.log(kelvin)
    ks = F.exp(
        -4276.1 / kelvin
        + 141.328
        - 23.093 * ln_k
        + (-13856 / kelvin + 324.57 - 47.986 * ln_k) * root
        + (35474 / kelvin - 771.54 + 114.723 * ln_k) * ionic
        - 2698 / kelvin * F.pow(ionic, F.lit(1.5))
        + 1776 / kelvin * ionic * ionic
    ) * (1 - 0.001005 * s)

    nernst = F.lit(GAS_CONSTANT / FARADAY) * kelvin * F.log(F.lit(10.0))
    ph_free = (
        (volts - (F.lit(k0) + F.lit(k2) * t)) / nernst
        + F.log10(chloride * 1000 / water)
        + 2 * log_gamma
        - F.log10(water / 1000)
    )
    ph_total = ph_free - F.log10(1 + sulfate / ks)
    usable = volts.isNotNull() & (s > 0) & (water > 0) & (kelvin > 0)
    return F.when(usable, ph_total)
