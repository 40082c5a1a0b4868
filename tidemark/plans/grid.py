"""Alignment of instruments and resampling to the common grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import clean
from tidemark.operators.arrays import to_wide
from tidemark.operators.ordered import HOUR, axis, join_back, row_index
from tidemark.operators.resample import bounds, dense_grid, extent, interpolate, median3, on_grid, pad_grid, resample_mean, sample_rate
from tidemark.operators.signal import profile_number
from tidemark.operators.timejoin import interp_join
from tidemark.session import durable


def align(readings: DataFrame, depths: DataFrame, nav: DataFrame, by: Sequence[str], us: str = "us", width: float = HOUR) -> DataFrame:
    """Depth, latitude and longitude for every reading of every instrument."""
    deep = interp_join(readings, depths.select(*by, us, "depth"), by, us, ["depth"], width=width)
    return interp_join(deep, nav.select(*by, us, "lat", "lon"), by, us, ["lat", "lon"], width=width)


#: Instruments that give coordinates, the one of the filtered depth, and the navigation variables that are aligned.
COORDINATES = ("gps", "depth", "nudged")
FILTERED = "depth"
NAVIGATION = ("mWaterSpeed", "roll", "pitch", "yaw")


def aligned_only(readings: DataFrame, var: str = "var") -> DataFrame:
    """Readings of the variables that are aligned, with their instrument, the name's first word.

    Coordinates go, and of navigation all but speed and attitude. Readings without a name go as well.
    """
    instr, rest = F.get(F.split(var, "_"), F.lit(0)), F.get(F.split(var, "_"), F.lit(1))
    navigation = F.col(var).startswith("navigation") & ~F.coalesce(rest.isin(*NAVIGATION), F.lit(False))
    return readings.withColumn("instr", instr).where(~instr.isin(*COORDINATES) & ~navigation)


def align_variables(
    readings: DataFrame, depths: DataFrame, nav: DataFrame, by: Sequence[str], us: str = "us", var: str = "var", width: float = HOUR
) -> DataFrame:
    """Depth, latitude and longitude for the readings of every variable that is aligned.

    ``depths`` has the depth of each instrument's sensor (``instr``) and the filtered depth under ``depth``, which
    holds for the instruments of a series that have no sensor depth in it. With neither, depth is NULL.
    """
    sensed = depths.where((F.col("instr") != FILTERED) & F.col("depth").isNotNull()).select(*by, "instr").distinct()
    known = join_back(aligned_only(readings, var), sensed.withColumn("_sensed", F.lit(True)), [*by, "instr"], "left")
    sourced = known.withColumn("_source", F.when(F.col("_sensed"), F.col("instr")).otherwise(FILTERED)).drop("_sensed")
    source = depths.where(F.col("depth").isNotNull()).select(*by, F.col("instr").alias("_source"), us, "depth")
    deep = interp_join(sourced, source, [*by, "_source"], us, ["depth"], width=width).drop("_source")
    return interp_join(deep, nav.select(*by, us, "lat", "lon"), by, us, ["lat", "lon"], width=width)


def summary(readings: DataFrame, by: Sequence[str], us: str, cols: Sequence[str], per_s: float = 1.0) -> DataFrame:
    """Bounds, duration and sampling rate of each instrument; the rate per ``per_s`` seconds."""
    scaled = readings.select(*by, (F.col(us) / per_s).alias(us))
    return join_back(bounds(readings, by, us, cols), sample_rate(scaled, by, us), by)


def resample_coordinates(
    df: DataFrame, by: Sequence[str], us: str, cols: Sequence[str], seconds: float = 1.0, limit: int = 3, width: int = HOUR
) -> DataFrame:
    """Median-filtered means on the dense grid, short gaps filled, incomplete rows dropped."""
    smooth = median3(df.select(*by, us, *cols), axis(by, us, width), cols, fill_ends=True)
    means = resample_mean(smooth, by, us, cols, seconds)
    dense = durable(on_grid(means, by, us, seconds, width))
    filled = interpolate(dense, by, us, cols, int(seconds * 1_000_000), limit, width)
    return clean.drop_incomplete(filled, cols)


def resample_variables(readings: DataFrame, by: Sequence[str], us: str, names: Sequence[str], seconds: float = 1.0, width: int = HOUR) -> DataFrame:
    """Median-filtered bin means of the variables (columns ``var``, ``value``), one column each."""
    keys = [*by, "var"]
    smooth = median3(readings.select(*keys, us, "value"), axis(keys, us, width), ["value"])
    means = resample_mean(smooth, keys, us, ["value"], seconds)
    return to_wide(means, [*by, us], "var", "value", names)


def resample_padded(
    readings: DataFrame, by: Sequence[str], instr: str, us: str, col: str, seconds: float = 1.0, width: int = HOUR
) -> DataFrame:
    """Median-filtered bin means of each instrument on the grid of its whole mission, with ``pad`` for
    instruments that end early."""
    keys = [*by, instr]
    smooth = durable(median3(readings.select(*keys, us, col), axis(keys, us, width), [col]))
    means = resample_mean(smooth, keys, us, [col], seconds)
    extents = durable(extent(readings, by, instr, us))
    padded = pad_grid(means, extents, by, instr, us, seconds, width)
    return join_back(padded, extents.select(*keys, "pad"), keys)


def resample(
    coordinates: DataFrame,
    readings: DataFrame,
    by: Sequence[str],
    us: str,
    names: Sequence[str],
    depth: str = "depth",
    position: Sequence[str] = ("lat", "lon"),
    seconds: float = 1.0,
    width: int = HOUR,
    size: int = 50_000,
) -> DataFrame:
    """The science table: coordinates, profile number and all variables on one time axis."""
    grid = durable(resample_coordinates(coordinates, by, us, [depth, *position], seconds, width=width))
    indexed = durable(row_index(grid, axis(by, us, width), "_i"))
    profiled = profile_number(indexed, by, "_i", depth, size=size).drop("_i")
    return join_back(profiled, resample_variables(readings, by, us, names, seconds, width), [*by, us], "left")


def message_grid(
    messages: DataFrame, by: Sequence[str], us: str, seq: str, start: Column, end: Column, names: Sequence[str], seconds: float = 1.0, width: int = HOUR
) -> DataFrame:
    """Near-real-time messages, each variable with its own times, on one grid without extrapolation."""
    by = list(by)
    step = int(seconds * 1_000_000)
    tidy = durable(clean.tidy_series(messages, [*by, "name"], us, seq, "value", start, end))
    spans = tidy.groupBy(*by).agg(
        (F.floor(F.min(us) / step) * step).alias("_a"), (F.ceil(F.max(us) / step) * step).alias("_b")
    )
    per_name = join_back(tidy.select(*by, "name").distinct(), spans, by)
    grid = dense_grid(per_name, [*by, "name"], "_a", "_b", us, seconds, width)
    filled = interp_join(grid, tidy.select(*by, "name", us, "value"), [*by, "name"], us, ["value"], clamp=False, width=width)
    return to_wide(filled, [*by, us], "name", "value", names)


def message_profiles(grid: DataFrame, by: Sequence[str], us: str, depth: str = "depth", width: int = HOUR, size: int = 50_000) -> DataFrame:
    """Profile numbers of the message grid, for the rows with a depth."""
    known = durable(row_index(grid.where(F.col(depth).isNotNull()), axis(by, us, width), "_i"))
    numbers = profile_number(known, by, "_i", depth, size=size).select(*by, us, "profile_number")
    return join_back(grid, numbers, [*by, us], "left")


def clean_times(
    readings: DataFrame, windows: DataFrame, by: Sequence[str], seq: str, ts: str, pad: str = "10 MINUTES", threshold: float = 10.0, width: float = 100_000
) -> DataFrame:
    """Clock repair of the variables of a log, in order: window, spikes, monotonic, intersection."""
    keys = [*by, "var"]
    ax = axis(keys, seq, width)
    inside = clean.in_window(readings, windows, by, ts, pad).withColumn("_t", F.unix_micros(ts) / F.lit(1e6))
    calm = durable(clean.drop_time_spikes(durable(inside), ax, "_t", threshold))
    rising = durable(clean.keep_monotonic(calm, ax, ts))
    return clean.intersect_indices(rising, by, seq, "var").drop("_t")
