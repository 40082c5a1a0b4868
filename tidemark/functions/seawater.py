"""Sea-water formulas as column expressions (EOS-80, PSS-78; UNESCO technical paper 44, 1983)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The published polynomial coefficients, constant term first.
SALINITY_A = (0.0080, -0.1692, 25.3851, 14.0941, -7.0261, 2.7081)
SALINITY_B = (0.0005, -0.0056, -0.0066, -0.0375, 0.0636, -0.0144)
SALINITY_RT = (0.6766097, 2.00564e-2, 1.104259e-4, -6.9698e-7, 1.0031e-9)
SALINITY_E = (2.070e-5, -6.370e-10, 3.989e-15)
SALINITY_D = (3.426e-2, 4.464e-4, 4.215e-1, -3.107e-3)
SALINITY_K = 0.0162
DENSITY_WATER = (999.842594, 6.793952e-2, -9.095290e-3, 1.001685e-4, -1.120083e-6, 6.536332e-9)
DENSITY_B = (8.24493e-1, -4.0899e-3, 7.6438e-5, -8.2467e-7, 5.3875e-9)
DENSITY_C = (-5.72466e-3, 1.0227e-4, -1.6546e-6)
DENSITY_D = 4.8314e-4
BULK_E = (19652.21, 148.4206, -2.327105, 1.360477e-2, -5.155288e-5)
BULK_F = (54.6746, -0.603459, 1.09987e-2, -6.1670e-5)
BULK_G = (7.944e-2, 1.6483e-2, -5.3009e-4)
BULK_H = (3.239908, 1.43713e-3, 1.16092e-4, -5.77905e-7)
BULK_I = (2.2838e-3, -1.0981e-5, -1.6078e-6)
BULK_J = 1.91075e-4
BULK_K = (8.50935e-5, -6.12293e-6, 5.2787e-8)
BULK_M = (-9.9348e-7, 2.0816e-8, 9.1697e-10)
SOUND_C = (
    (1402.388, 5.03711, -5.80852e-2, 3.3420e-4, -1.47800e-6, 3.1464e-9),
    (0.153563, 6.8982e-4, -8.1788e-6, 1.3621e-7, -6.1185e-10),
    (3.1260e-5, -1.7107e-6, 2.5974e-8, -2.5335e-10, 1.0405e-12),
    (-9.7729e-9, 3.8504e-10, -2.3643e-12),
)
SOUND_A = (
    (1.389, -1.262e-2, 7.164e-5, 2.006e-6, -3.21e-8),
    (9.4742e-5, -1.2580e-5, -6.4885e-8, 1.0507e-8, -2.0122e-10),
    (-3.9064e-7, 9.1041e-9, -1.6002e-10, 7.988e-12),
    (1.100e-10, 6.649e-12, -3.389e-13),
)
SOUND_B = ((-1.922e-2, -4.42e-5), (7.3637e-5, 1.7945e-7))
SOUND_D = (1.727e-3, -7.9836e-6)
OXYGEN_SATURATION_A = (-173.4292, 249.6339, 143.3483, -21.8492)
OXYGEN_SATURATION_B = (-0.033096, 0.014259, -0.00170)
CONDUCTIVITY_35_15_0 = 42.914
KELVIN = 273.15
T68_PER_T90 = 1.00024


def poly(x: Column, coefficients: Sequence[float]) -> Column:
    """Polynomial by Horner's rule."""
    out = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = out * x + F.lit(c)
    return out


def temperature_from_frequency(f: Column, f0: Column, a: Column, b: Column, c: Column, d: Column) -> Column:
    """Thermistor: degrees Celsius from oscillator frequency."""
    ratio = F.log(f0 / f)
    return 1.0 / (a + b * ratio + c * ratio * ratio + d * ratio * ratio * ratio) - KELVIN


def conductivity_set_a(f: Column, t: Column, p: Column, a: float, b: float, c: float, d: float, m: float) -> Column:
    """Conductivity from frequency in kHz, older coefficient set."""
    eps = 2.0**-52
    return (a * F.pow(f, F.lit(m)) + b * f * f + c + d * t) / (10 * (1 + eps * p))


def conductivity_set_g(f: Column, t: Column, p: Column, g: float, h: float, i: float, j: float, tcor: float, pcor: float) -> Column:
    """Conductivity from frequency in kHz, newer coefficient set."""
    return (g + (h + (i + j * f) * f) * f * f) / (10 * (1 + tcor * t + pcor * p))


def salinity(ratio: Column, t: Column, p: Column) -> Column:
    """Practical salinity from conductivity ratio, temperature (ITS-90) and pressure."""
    t68 = t * T68_PER_T90
    rp = 1 + p * poly(p, SALINITY_E) / (1 + SALINITY_D[0] * t68 + SALINITY_D[1] * t68 * t68 + (SALINITY_D[2] + SALINITY_D[3] * t68) * ratio)
    root = F.sqrt(ratio / (rp * poly(t68, SALINITY_RT)))
    dt = t68 - 15
    return poly(root, SALINITY_A) + dt / (1 + SALINITY_K * dt) * poly(root, SALINITY_B)


def salinity_from_conductivity(c: Column, t: Column, p: Column) -> Column:
    return salinity(c * 10 / CONDUCTIVITY_35_15_0, t, p)


def density_surface(s: Column, t: Column) -> Column:
    t68 = t * T68_PER_T90
    return poly(t68, DENSITY_WATER) + (poly(t68, DENSITY_B) + poly(t68, DENSITY_C) * F.sqrt(s) + DENSITY_D * s) * s


def density(s: Column, t: Column, p: Column) -> Column:
    """In-situ density, kg/m3; pressure in dbar."""
    t68, bar, root = t * T68_PER_T90, p / 10, F.sqrt(s)
    bulk = poly(t68, BULK_E) + (poly(t68, BULK_F) + poly(t68, BULK_G) * root) * s
    a = poly(t68, BULK_H) + (poly(t68, BULK_I) + BULK_J * root) * s
    b = poly(t68, BULK_K) + poly(t68, BULK_M) * s
    return density_surface(s, t) / (1 - bar / (bulk + a * bar + b * bar * bar))


def sigma0(s: Column, t: Column) -> Column:
    """Density anomaly at the surface from practical salinity and in-situ temperature."""
    return density_surface(s, t) - 1000


def pressure(depth: Column, lat: Column | float) -> Column:
    """Pressure in dbar from depth in metres and latitude (Saunders 1981)."""
    s = F.sin(F.radians(F.abs(lat if isinstance(lat, Column) else F.lit(lat))))
    c = 5.92e-3 + s * s * 5.25e-3
    return ((1 - c) - F.sqrt((1 - c) * (1 - c) - 8.84e-6 * depth)) / 4.42e-6


def sound_speed(s: Column, t: Column, p: Column) -> Column:
    """Sound speed in m/s (Chen and Millero 1977); pressure in dbar."""
    t68, bar = t * T68_PER_T90, p / 10

    def along(rows: Sequence[Sequence[float]]) -> Column:
        out = poly(t68, rows[-1])
        for row in reversed(rows[:-1]):
            out = out * bar + poly(t68, row)
        return out

    water, a, b, d = along(SOUND_C), along(SOUND_A), along(SOUND_B), poly(bar, SOUND_D)
    return water + a * s + b * s * F.sqrt(s) + d * s * s


def oxygen_saturation(t: Column, s: Column) -> Column:
    """Oxygen solubility in ml/l."""
    k = (KELVIN + t) / 100
    a, b = OXYGEN_SATURATION_A, OXYGEN_SATURATION_B
    return F.exp(a[0] + a[1] / k + a[2] * F.log(k) + a[3] * k + s * (b[0] + b[1] * k + b[2] * k * k))


def oxygen_owens_millard(
    volts: Column, t: Column, s: Column, p: Column, slope: Column | None, soc: float, voff: float, boc: float, tcor: float, pcor: float
) -> Column:
    """Oxygen in ml/l. ``slope`` is the first difference of the volts: its weight is zero, but a
    row without one (the first of a series) has no result."""
    value = (soc * (volts + voff) + boc * F.exp(-0.03 * t)) * F.exp(tcor * t + pcor * p) * oxygen_saturation(t, s)
    return value if slope is None else F.when(slope.isNotNull(), value)


def oxygen_sbe43(volts: Column, t: Column, s: Column, p: Column, soc: float, offset: float, a: float, b: float, c: float, e: float) -> Column:
    """Oxygen in ml/l, polynomial temperature compensation."""
    warm = 1.0 + a * t + b * t * t + c * t * t * t
    return soc * (volts + offset) * warm * oxygen_saturation(t, s) * F.exp(e * p / (KELVIN + t))


def oxygen_umol_per_kg(ml_per_l: Column, rho: Column) -> Column:
    return ml_per_l * 1.4276 * 1.0e6 / (rho * 32)
