"""Calibration of the sensors of a vehicle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import biology as bio
from tidemark.functions import geo, optics
from tidemark.functions import seawater as sw
from tidemark.operators import clean
from tidemark.operators.ordered import HOUR, axis, row_index
from tidemark.operators.resample import slope
from tidemark.operators.signal import lowpass
from tidemark.operators.timejoin import effective, interp_join
from tidemark.session import durable


def sensor_depth(df: DataFrame, by: Sequence[str], us: str, depths: DataFrame, pitches: DataFrame, x: float, y: float, width: float = HOUR) -> DataFrame:
    """Depth of a sensor: vehicle depth and pitch at its times, moved by its offset."""
    placed = interp_join(interp_join(df, depths, by, us, ["filtdepth"], width=width), pitches, by, us, ["pitch"], width=width)
    depth = geo.pitch_corrected_depth(F.col("filtdepth"), x, y, F.col("pitch"))
    return placed.withColumn("depth", depth).drop("filtdepth", "pitch")


def calibrate_ctd(
    raw: DataFrame,
    pressures: DataFrame,
    by: Sequence[str],
    us: str,
    seq: str,
    temperature: dict[str, float],
    conductivity: dict[str, float],
    oxygen: dict[str, float],
    salinity_range: tuple[float, float] = (30.0, 40.0),
    width: float = HOUR,
    seq_width: float = 100_000,
    sbe43: dict[str, float] | None = None,
    beam: str | None = None,
) -> DataFrame:
    """Temperature, conductivity, salinity, density and oxygen from frequencies and volts.

    ``pressures`` has ``filtpres``. Salinities outside their range are NULL. ``sbe43`` are the
    coefficients of a second oxygen sensor on ``volts2``, ``beam`` the volts of a transmissometer.
    """
    clock = clean.keep_monotonic(raw, axis(by, seq, seq_width), us)
    stepped = slope(durable(clock), axis(by, us, width), "volts", us, "_slope")
    df = interp_join(stepped, pressures.select(*by, us, "filtpres"), by, us, ["filtpres"], width=width)
    t = {k: F.lit(v) for k, v in temperature.items()}
    freq = clean.zero_to_null(F.col("temp_frequency"))
    df = df.withColumn("temperature", sw.temperature_from_frequency(freq, t["f0"], t["a"], t["b"], t["c"], t["d"]))
    c = sw.conductivity_set_a if "a" in conductivity else sw.conductivity_set_g
    df = df.withColumn("conductivity", c(F.col("cond_frequency") / 1000.0, F.col("temperature"), F.col("filtpres"), **conductivity))
    df = df.withColumn("salinity", sw.salinity_from_conductivity(F.col("conductivity"), F.col("temperature"), F.col("filtpres")))
    df = clean.range_qc_null(df, {"salinity": salinity_range})
    s, temp, p = F.col("salinity"), F.col("temperature"), F.col("filtpres")
    df = df.withColumn("oxygen_mll", sw.oxygen_owens_millard(F.col("volts"), temp, s, p, F.col("_slope"), **oxygen))
    rho = sw.density(s, temp, p)
    out = {"density": rho, "oxygen_umolkg": sw.oxygen_umol_per_kg(F.col("oxygen_mll"), rho)}
    if sbe43:
        out["oxygen2_mll"] = sw.oxygen_sbe43(F.col("volts2"), temp, s, p, **sbe43)
        out["oxygen2_umolkg"] = sw.oxygen_umol_per_kg(out["oxygen2_mll"], rho)
    if beam:
        out["transmittance"] = optics.transmittance(F.col(beam))
        out["attenuation"] = optics.attenuation(out["transmittance"])
    return df.withColumns(out).drop("_slope")


def calibrate_optics(
    raw: DataFrame,
    by: Sequence[str],
    us: str,
    seq: str,
    blue: dict,
    red: dict,
    fluo: dict,
    legacy: bool = False,
    seq_width: float = 100_000,
    place: tuple[DataFrame, DataFrame, tuple[float, float]] | None = None,
    width: float = HOUR,
) -> DataFrame:
    """Backscatter and fluorescence from the raw channels ``snorm1..3`` with ``gain1..3`` and ``temp_raw``.

    ``place`` has the depths ``filtdepth``, the pitches ``pitch`` and the offset of the sensor; it adds the
    sensor's ``depth``.
    """
    df = clean.keep_monotonic(raw, axis(by, seq, seq_width), us)
    temp = F.col("temp_raw")
    _, bbp_blue = optics.backscatter(F.col("snorm1"), F.col("gain1"), temp, **blue)
    _, bbp_red = optics.backscatter(F.col("snorm2"), F.col("gain2"), temp, **red)
    fl = optics.fluorescence(F.col("snorm3"), F.col("gain3"), temp, **fluo)
    named = df.withColumns({"bbp_blue": bbp_blue, "bbp_red": bbp_red, "fl": fl})
    sound = clean.backscatter_qc(named, by, "bbp_blue", "bbp_red", "fl", legacy)
    if not place:
        return sound
    depths, pitches, offset = place
    return sensor_depth(sound, by, us, depths, pitches, *offset, width)


def calibrate_puck(
    raw: DataFrame,
    by: Sequence[str],
    us: str,
    seq: str,
    scales: dict[str, tuple[float, float]],
    wavelength: float,
    depths: DataFrame,
    pitches: DataFrame,
    offset: tuple[float, float],
    width: float = HOUR,
    seq_width: float = 100_000,
) -> DataFrame:
    """Backscattering, chlorophyll and CDOM of a puck from counts, at the depth of the sensor.

    ``scales`` has scale and dark counts of ``vol``, ``chl`` and ``cdom``; their counts are in
    ``<name>_counts``, the salinity in ``salinity``.
    """
    df = clean.keep_monotonic(raw, axis(by, seq, seq_width), us)
    df = df.withColumns({c: optics.scaled_counts(F.col(f"{c}_counts"), *scale) for c, scale in scales.items()})
    bbw, bbp = optics.puck_backscatter(F.col("vol"), F.col("salinity"), wavelength)
    df = df.withColumns({"bbw": bbw, "bbp": bbp}).drop(*[f"{c}_counts" for c in scales])
    return sensor_depth(df, by, us, depths, pitches, *offset, width)


def calibrate_navigation(
    raw: DataFrame,
    by: Sequence[str],
    us: str,
    seq: str,
    box: dict[str, tuple[float, float]],
    seq_width: float = 100_000,
    metres: tuple[str, str, int] | None = None,
    relative: Sequence[str] = (),
    rules: tuple[DataFrame, str, dict[str, tuple[str, str]]] | None = None,
) -> DataFrame:
    """Positions in degrees from radians, longitudes west, inside the box; attitude in degrees.

    ``metres`` names easting, northing and UTM zone of positions that come in metres instead;
    ``relative`` columns count from the first sample of their series. ``rules`` are a table, its
    mission column and the limits by mission, as in ``apply_rules``.
    """
    df = clean.keep_monotonic(raw, axis(by, seq, seq_width), us)
    if metres:
        east, north, zone = metres
        lat, lon = geo.utm_inverse(F.col(east), F.col(north), F.lit(zone))
        df = df.withColumns({"lat": F.radians(lat), "lon": F.radians(lon)})
    df = clean.to_degrees(df, ["lat", "lon", "roll", "pitch", "platform_orientation"])
    df = clean.fix_lon_sign(df, by, "lon", [us])
    if relative:
        df = clean.relative(durable(df), by, relative, [us])
    for col, (lo, hi) in box.items():
        df = df.where(~clean.out_of_range(col, lo, hi))
    return clean.apply_rules(df, *rules) if rules else df


def calibrate_depth(
    raw: DataFrame, by: Sequence[str], us: str, seq: str, depth: str = "depth", lat: float | Column = 36.0, size: int = 50_000, seq_width: float = 100_000
) -> DataFrame:
    """Pressure and low-passed depth and pressure."""
    df = clean.keep_monotonic(raw, axis(by, seq, seq_width), us)
    indexed = durable(row_index(df, axis(by, seq, seq_width), "_i").withColumn("pressure", sw.pressure(F.col(depth), lat)))
    smooth = lowpass(indexed, by, "_i", depth, "filtdepth", size=size)
    return lowpass(smooth.drop("_n"), by, "_i", "pressure", "filtpres", size=size).drop("_i", "_n")


def calibrate_flow(
    raw: DataFrame, by: Sequence[str], us: str, seq: str, lags: DataFrame, conversions: DataFrame, mission_start: str, seq_width: float = 100_000
) -> DataFrame:
    """Bathyphotometer and pass-through instruments: monotonic clock, plumbing lag, flow in mL/s."""
    df = clean.keep_monotonic(raw, axis(by, seq, seq_width), us)
    lagged = clean.apply_lag(df.withColumn("_ts", F.timestamp_micros(us)), lags, "instr", "_ts").withColumn(us, F.unix_micros("_ts"))
    dated = effective(lagged.drop("_ts"), conversions, mission_start, "valid_from")
    return dated.withColumn("flow", bio.rpm_to_flow(F.col("rpm"), F.col("conversion"))).drop("valid_from", "conversion")
