"""Plankton proxies, particle measures and flow conversions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Flow regression below and above a mean transit count of 13.
FLOW_SLOW = (23.10410966, -1.481499106, 1.566460406, 0.196311142, -0.05)
FLOW_FAST = (0.198996019, -2.603059062, 0.892897609, 0.006191239, -0.0013)

# Equivalent spherical diameter (mm) from the summed peak intensity.
ESD = (0.1806059, 0.00025459, -1.0988e-9, 9.54e-15)
INTENSITY_MAX = 3800
FIRST_BIN_UM, BIN_UM, BINS = 108, 15, 994


def proxies(fluo: Column, bg_per_liter: Column, ratio: Column | float, cal: Column | float) -> dict[str, Column]:
    """Autotrophic and heterotrophic dinoflagellates and diatoms; NULL where an input is missing."""
    pseudo = bg_per_liter / ratio
    both = fluo.isNotNull() & pseudo.isNotNull()
    low = F.when(both, F.least(fluo, pseudo))
    return {
        "adinos": low / cal,
        "hdinos": (pseudo - low) / cal,
        "diatoms": F.when(both, F.greatest((fluo - pseudo) / cal, F.lit(0.0))),
    }


def corrected(adinos: Column, diatoms: Column, hdinos: Column, r: Column, floor: float = 0.2) -> dict[str, Column]:
    """Proxies scaled by how well fluorescence and background correlate; the sums are preserved."""
    factor = F.when(r.isNotNull(), F.greatest((r + 1) / 2 * (1 - floor) + floor, F.lit(0.0)))
    scaled = adinos * factor
    return {"adinos": scaled, "diatoms": adinos + diatoms - scaled, "hdinos": adinos + hdinos - scaled}


def flow_speed(time: Column, count: Column) -> Column:
    """Flow through the particle counter in m/s; NULL outside the regression's range."""
    fc = F.when(count != 0, time / F.nullif(count, F.lit(0)))
    root = F.sqrt(fc)

    def curve(a: tuple[float, ...]) -> Column:
        return a[0] * F.exp(-(a[1] * F.sqrt(root) + a[2] * root + a[3] * root * root + a[4] * root * root * root))

    return F.when(fc.between(7, 100), F.when(fc <= 13, curve(FLOW_SLOW)).otherwise(curve(FLOW_FAST)))


def unpack_words(a: Column, b: Column, c: Column) -> dict[str, Column]:
    """Particle fields from three 16-bit words: start flag, peak, element, length, scan counter."""
    return {
        "n": F.shiftright(a.bitwiseAND(0x8000), 15),
        "p": F.shiftright(a.bitwiseAND(0x3FF8), 3),
        "e": F.shiftleft(a.bitwiseAND(0x0007), 3) + F.shiftright(b.bitwiseAND(0x3800), 11),
        "l": b.bitwiseAND(0x07FF),
        "s": c.bitwiseAND(0xFFFF),
    }


def diameter_um(total: Column) -> Column:
    return 1000 * (ESD[0] + ESD[1] * total + ESD[2] * total * total + ESD[3] * total * total * total)


def size_bin(esd: Column) -> Column:
    """Index of the nearest size bin; halfway goes to the smaller one."""
    nearest = F.ceil((esd - FIRST_BIN_UM) / F.lit(float(BIN_UM)) - 0.5)
    return F.greatest(F.lit(0), F.least(nearest, F.lit(BINS - 1))).cast("int")


def rpm_to_flow(rpm: Column, conversion: Column | float) -> Column:
    return rpm * conversion


def drift_cm_per_s(diff: Column, seconds: Column, lat: Column | None = None) -> Column:
    """Drift speed from a position difference in degrees; along longitude it shrinks with latitude."""
    scale = F.cos(F.radians(lat)) if lat is not None else F.lit(1.0)
    return F.when(seconds == 0, F.lit(0.0)).otherwise(diff * scale * 60 * 185300 / F.nullif(seconds, F.lit(0.0)))


def log10_positive(x: Column) -> Column:
    return F.when(x > 0, F.log10(x))


def best_ctd(comment: Column) -> Column:
    """CTD named in a mission comment, ``ctd1`` without one."""
    named = F.nullif(F.regexp_extract(comment, r"Best CTD is (ctd1|ctd2)", 1), F.lit(""))
    chosen = F.nullif(F.regexp_extract(comment, r"ctdToUse = (\S+)", 1), F.lit(""))
    return F.coalesce(named, chosen, F.lit("ctd1"))
