"""Underwater sound: decibels, sound speed, absorption, gain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_linear(db: Column) -> Column:
    return F.pow(F.lit(10.0), db / 10)


def to_db(linear: Column, empty: float | None = None) -> Column:
    """10 log10; ``empty`` (NULL by default) for NULL and values not above 0."""
    return F.when(linear > 0, 10 * F.log10(linear)).otherwise(F.lit(empty).cast("double"))


def speed_mackenzie(t: Column, s: Column, d: Column) -> Column:
    """Nine-term equation of Mackenzie (1981): m/s from degrees Celsius, practical salinity and metres."""
    # The published coefficients, in the order of the equation.
    return (
        1448.96 + 4.591 * t - 5.304e-2 * t * t + 2.374e-4 * t * t * t + 1.340 * (s - 35)
        + 1.630e-2 * d + 1.675e-7 * d * d - 1.025e-2 * t * (s - 35) - 7.139e-13 * t * d * d * d
    )


def _poly(x: Column, *c: float) -> Column:
    out = F.lit(c[-1])
    for k in c[-2::-1]:
        out = out * x + k
    return out


def speed_chen_millero(t: Column, s: Column, p_bar: Column) -> Column:
    """Chen and Millero (1977), the UNESCO equation: m/s from degrees Celsius, practical salinity and bar."""
    # The published coefficients, ascending powers of t, one line for each power of p.
    cw = (
        _poly(t, 1402.388, 5.03711, -5.80852e-2, 3.3420e-4, -1.47800e-6, 3.1464e-9)
        + _poly(t, 0.153563, 6.8982e-4, -8.1788e-6, 1.3621e-7, -6.1185e-10) * p_bar
        + _poly(t, 3.1260e-5, -1.7107e-6, 2.5974e-8, -2.5335e-10, 1.0405e-12) * p_bar * p_bar
        + _poly(t, -9.7729e-9, 3.8504e-10, -2.3643e-12) * p_bar * p_bar * p_bar
    )
    a = (
        _poly(t, 1.389, -1.262e-2, 7.164e-5, 2.006e-6, -3.21e-8)
        + _poly(t, 9.4742e-5, -1.2580e-5, -6.4885e-8, 1.0507e-8, -2.0122e-10) * p_bar
        + _poly(t, -3.9064e-7, 9.1041e-9, -1.6002e-10, 7.988e-12) * p_bar * p_bar
        + _poly(t, 1.100e-10, 6.649e-12, -3.389e-13) * p_bar * p_bar * p_bar
    )
    b = _poly(t, -1.922e-2, -4.42e-5) + _poly(t, 7.3637e-5, 1.7945e-7) * p_bar
    d = 1.727e-3 - 7.9836e-6 * p_bar
    return cw + a * s + b * s * F.sqrt(s) + d * s * s


def absorption_francois_garrison(khz: Column, t: Column, s: Column, depth: Column, ph: Column, speed: Column) -> Column:
    """dB/m after Francois and Garrison (1982); the pure-water branch is chosen for each row."""
    # The published constants for boric acid, magnesium sulphate and water.
    tk = t + 273.0
    a1 = 8.86 / speed * F.pow(F.lit(10.0), 0.78 * ph - 5)
    f1 = 2.8 * F.sqrt(s / 35) * F.pow(F.lit(10.0), 4 - 1245 / tk)
    a2 = 21.44 * s / speed * (1 + 0.025 * t)
    p2 = 1 - 1.37e-4 * depth + 6.2e-9 * depth * depth
    f2 = 8.17 * F.pow(F.lit(10.0), 8 - 1990 / tk) / (1 + 0.0018 * (s - 35))
    p3 = 1 - 3.83e-5 * depth + 4.9e-10 * depth * depth
    cold, warm = _poly(t, 4.937e-4, -2.59e-5, 9.11e-7, -1.50e-8), _poly(t, 3.964e-4, -1.146e-5, 1.45e-7, -6.5e-10)
    f = khz * khz
    return (a1 * f1 * f / (f1 * f1 + f) + a2 * p2 * f2 * f / (f2 * f2 + f) + F.when(t < 20, cold).otherwise(warm) * p3 * f) / 1000


def absorption_ainslie_mccolm(khz: Column, t: Column, s: Column, depth: Column, ph: Column) -> Column:
    """dB/m after Ainslie and McColm (1998), the simplified form."""
    # The published constants.
    z, f = depth / 1000, khz * khz
    f1 = 0.78 * F.sqrt(s / 35) * F.exp(t / 26)
    f2 = 42.0 * F.exp(t / 17)
    boric = 0.106 * f1 * f / (f1 * f1 + f) * F.exp((ph - 8) / 0.56)
    magnesium = 0.52 * (1 + t / 43) * (s / 35) * f2 * f / (f2 * f2 + f) * F.exp(-z / 6)
    return (boric + magnesium + 0.00049 * f * F.exp(-(t / 27 + z / 17))) / 1000


def time_varied_gain(r: Column, alpha: Column) -> Column:
    """20 log10 r + 2 alpha r; NULL where the range is not above 0."""
    return F.when(r > 0, 20 * F.log10(r) + 2 * alpha * r)


def subtract_db(level: Column, noise: Column) -> Column:
    """A level less a noise level, in the linear domain; NULL where nothing is left."""
    return to_db(to_linear(level) - to_linear(noise))


def counts_to_sv(counts: Column, scale: Column, offset: Column, depth: Column, most_m: float) -> Column:
    """Echo counts of a current profiler as volume backscatter; NULL from ``most_m`` down."""
    return F.when(depth < most_m, counts * scale + offset)
