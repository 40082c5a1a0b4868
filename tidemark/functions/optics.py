"""Optical sensors: transmissometer, backscatter and fluorescence."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blocked-beam and clean-water volts and path length (m) of the transmissometer.
V_DARK, V_REF, PATH = 0.006, 4.701, 0.25

# Normalised phytoplankton absorption from 400 to 700 nm in steps of 10 nm.
ABSORPTION = (
    0.687, 0.828, 0.913, 0.973, 1.000, 0.944, 0.917, 0.870, 0.798, 0.750, 0.668, 0.618, 0.528, 0.474, 0.416, 0.357,
    0.294, 0.276, 0.291, 0.282, 0.236, 0.252, 0.276, 0.317, 0.334, 0.356, 0.441, 0.595, 0.502, 0.329, 0.215,
)

# Sea-water scattering at the reference wavelength and its power law.
BETA_WATER, BB_WATER, LAMBDA_WATER, GAMMA_WATER = 2.18e-4, 1.17e-3, 525.0, 4.32

CHI = 1.08


def transmittance(volts: Column) -> Column:
    return (volts - V_DARK) / (V_REF - V_DARK)


def attenuation(tr: Column) -> Column:
    """Beam attenuation per metre; NULL for a blocked beam."""
    return F.when(tr > 0, -1 / PATH * F.log(tr))


def signed16(raw: Column) -> Column:
    return F.when(raw > 32767, raw - 65536).otherwise(raw)


def water_scatter(wavelength: Column) -> tuple[Column, Column]:
    """Volume scattering and backscattering of pure sea water."""
    falloff = F.pow(F.lit(LAMBDA_WATER) / wavelength, F.lit(GAMMA_WATER))
    return BETA_WATER * falloff, BB_WATER * falloff


def typical_absorption(wavelength: Column) -> Column:
    """Absorption of average water: table lookup with linear interpolation plus two exponentials."""
    table = F.array(*[F.lit(v) for v in ABSORPTION])
    spot = (wavelength - 400) / 10
    cell = F.least(F.floor(spot), F.lit(len(ABSORPTION) - 2)).cast("int")
    low, high = F.element_at(table, cell + 1), F.element_at(table, cell + 2)
    star = low + (high - low) * (spot - cell)
    pigment = 0.06 * star * 0.1**0.65 * (1 + 0.2 * F.exp(-0.014 * (wavelength - 440)))
    return F.when(wavelength.between(400, 700), pigment + 0.01 * F.exp(-0.011 * (wavelength - 400)))


def gain(status: Column, gains: tuple[float, ...]) -> Column:
    """Gain of the status 1..5; any other status stands for itself."""
    known = F.element_at(F.array(*[F.lit(g) for g in gains]), F.greatest(F.lit(1), F.least(status, F.lit(len(gains)))).cast("int"))
    return F.when(status.between(1, len(gains)), known).otherwise(status.cast("double"))


def _normalised(raw: Column, scale: float, temp_raw: Column, temp_coeff: float, cal_temp: float, gained: Column, nominal: float) -> Column:
    warm = 1 + temp_coeff * ((temp_raw / 5 - 10) - cal_temp)
    return signed16(raw) * scale / (warm * (gained * nominal))


def backscatter(
    raw: Column, status: Column, temp_raw: Column, wavelength: float, *, mu: float, temp_coeff: float, cal_temp: float,
    gains: tuple[float, ...], nominal: float, sigma_exp: float,
) -> tuple[Column, Column]:
    """Total and particulate backscattering, corrected for attenuation along the path."""
    beta = _normalised(raw, mu, temp_raw, temp_coeff, cal_temp, gain(status, gains), nominal)
    beta_w, bb_w = water_scatter(F.lit(float(wavelength)))
    particles = 2 * math.pi * CHI * (beta - beta_w)
    k_bb = typical_absorption(F.lit(float(wavelength))) + 0.4 * (particles / 0.015)
    sigma = F.exp(sigma_exp * k_bb)
    bbp = 2 * math.pi * CHI * (sigma * beta - beta_w)
    return bbp + bb_w, bbp


def fluorescence(
    raw: Column, status: Column, temp_raw: Column, *, temp_coeff: float, cal_temp: float, gains: tuple[float, ...], nominal: float
) -> Column:
    """Fluorescence channel; its gains are those of the red channel."""
    return _normalised(raw, 50.0, temp_raw, temp_coeff, cal_temp, gain(status, gains), nominal)


def scaled_counts(counts: Column, scale: float, dark: float) -> Column:
    return scale * (counts - dark)


def puck_backscatter(vol: Column, salinity: Column, wavelength: float) -> tuple[Column, Column]:
    """Water and particulate backscattering from volume scattering at 117 degrees."""
    theta, delta = 117.0 / 57.29578, 0.09
    shape = 1.0 + math.cos(theta) ** 2 * (1.0 - delta) / (1.0 + delta)
    water = 1.38 * (wavelength / 500.0) ** -4.32 * (1.0 + 0.3 * salinity / 37.0) * 1e-4 * shape
    fresh = 0.0022533 * (wavelength / 500.0) ** -4.23 * 1e-4
    salt = 0.0029308 * (wavelength / 500.0) ** -4.24 * 1e-4
    bbw = F.when(salinity < 35.0, F.lit(fresh)).otherwise(F.lit(salt)) / 2.0
    return bbw, 2.0 * math.pi * 1.1 * (vol - water)
