"""Plankton proxies from bioluminescence and fluorescence, and their correction by profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import biology as bio
from tidemark.operators import signal as sig
from tidemark.operators.clean import default_flow, negative_to_null
from tidemark.operators.ordered import HOUR, axis, join_back, row_index
from tidemark.operators.resample import fill, on_grid, resample_mean
from tidemark.operators.stats import profile_corr
from tidemark.operators.timejoin import asof_nearest, contains_event
from tidemark.session import durable


def flow_grid(flow: DataFrame, by: Sequence[str], seconds: float = 1.0, default: float = 350.0, width: int = HOUR) -> DataFrame:
    """Mean flow per bin, carried over empty bins; zero means the nominal flow."""
    means = resample_mean(flow, by, "us", ["flow"], seconds, centred=False)
    dense = fill(on_grid(means, by, "us", seconds, width), axis(by, "us", width), ["flow"])
    return dense.withColumn("flow", default_flow(F.col("flow"), default))


def plankton_proxies(
    raw: DataFrame,
    flow: DataFrame,
    fluo: DataFrame,
    positions: DataFrame,
    by: Sequence[str],
    ratio: float = 3.9811e13,
    cal: float = 0.00470,
    *,
    threshold: float = sig.FLASH_THRESHOLD,
    window: int = 300,
    flash_window: int = 900,
    flash_seconds: int = 15,
    per_litre: float = 1000.0,
    nominal_flow: float = 350.0,
    stride: int = 3000,
    seconds: float = 1.0,
    width: int = HOUR,
    size: int = 50_000,
) -> tuple[DataFrame, DataFrame]:
    """Flash rates and intensity, background per litre and the three proxies per grid bin.

    ``raw`` has ``us`` and ``x``, ``flow`` has ``flow``, ``fluo`` has ``fluo`` on the grid and
    ``positions`` ``lat`` and ``lon``. Proxies use night-time background only. Also returns the
    night windows.
    """
    by = list(by)
    key = [*by, "us"]
    known = row_index(raw.where(F.col("x").isNotNull()).select(*key, "x"), axis(by, "us", width), "_i")
    env = durable(sig.background_envelope(known, by, "_i", "x", window, size=size))
    flows = durable(flow_grid(flow, by, seconds, nominal_flow, width))
    rates = sig.flash_rates(sig.flash_counts(env, by, "_i", "x", threshold, flash_window, size), flows, by, flash_seconds, per_litre, seconds)
    intensity = sig.flash_intensity(env, by, "_i", "x", flash_window, size, seconds)

    def per_liter(rows: DataFrame, name: str) -> DataFrame:
        means = resample_mean(rows, by, "us", ["min_bg"], seconds, centred=False)
        return join_back(means, flows, key, "left").select(*key, (F.col("min_bg") / F.col("flow") * per_litre).alias(name))

    sun = durable(sig.sun_events(positions, by, "us", "lat", "lon", stride, width))
    spans = positions.groupBy(*by).agg(F.min("us").alias("start"), F.max("us").alias("end"))
    nights = durable(sig.night_windows(sun, spans, by, "us"))
    night_bg = per_liter(sig.select_nights(env, nights, by, "us", width), "night_bg")
    whole = nights.groupBy(*by).agg(F.min("night_start").alias("_a"), F.max("night_end").alias("_b"))
    lit = join_back(fluo, whole, by).where((F.col("us") > F.col("_a")) & (F.col("us") < F.col("_b")))
    fluos = resample_mean(lit, by, "us", ["fluo"], seconds, centred=False).withColumn("fluo", negative_to_null(F.col("fluo")))
    table = rates
    for part in (intensity, per_liter(env, "bg_biolume"), night_bg, fluos):
        table = join_back(table, part, key, "full")
    return table.withColumns(bio.proxies(F.col("fluo"), F.col("night_bg"), ratio, cal)).drop("night_bg"), nights


def correct_proxies(
    proxies: DataFrame,
    grid: DataFrame,
    sun: DataFrame,
    by: Sequence[str],
    *,
    surface: float = 2.0,
    minutes: float = 5.0,
    least: int = 3,
    adinos_min: float = 0.1,
    floor: float = 0.2,
    kind: str = "pearson",
    width: float = HOUR,
) -> DataFrame:
    """Proxies scaled by the correlation (``kind``) of fluorescence and background in each profile.

    ``grid`` gives ``depth`` and ``profile_number`` at the nearest time, ``sun`` the times ``at`` of
    sunsets and sunrises. ``outcome`` tells what happened to the profile; rows of skipped profiles
    and rows far from the deep part are NULL.
    """
    by = list(by)
    key = [*by, "profile_number"]
    placed = durable(asof_nearest(proxies, grid.select(*by, "us", "depth", "profile_number"), by, "us", ["depth", "profile_number"], width))
    deep = F.coalesce(F.col("depth") > surface, F.lit(False))
    spans = placed.groupBy(*key).agg(
        F.min("us").alias("start"), F.max("us").alias("end"), F.min(F.when(deep, F.col("us"))).alias("_d0"), F.max(F.when(deep, F.col("us"))).alias("_d1")
    )
    spans = durable(contains_event(spans, sun, by, "start", "end", "at", "has_sun"))
    reach = int(minutes * 60 * 1_000_000)
    near = F.coalesce((F.col("us") > F.col("_d0") - reach) & (F.col("us") < F.col("_d1") + reach), F.lit(False))
    rows = join_back(placed.where(F.col("profile_number").isNotNull()), spans.drop("start", "end"), key).withColumn("_near", near).drop("_d0", "_d1")
    rich = deep & F.col("_near") & F.coalesce(F.col("adinos") > adinos_min, F.lit(False))
    counts = rows.groupBy(*key).agg(
        F.bool_or("has_sun").alias("_sun"),
        F.count_if("_near").alias("_rows"),
        F.count_if(rich).alias("_rich"),
        F.count(F.when(deep & F.col("_near"), F.col("adinos"))).alias("_known"),
        F.max(F.when(rich, F.col("depth"))).alias("_bottom"),
    )
    counts = durable(counts)
    upper = join_back(rows, counts.select(*key, "_bottom"), key).where(deep & F.col("_near") & (F.col("depth") <= F.col("_bottom")))
    corr = profile_corr(upper, key, "fluo", "bg", kind).withColumnRenamed("r", "_corr")
    outcome = (
        F.when(F.col("_sun"), "sun_event")
        .when(F.col("_rows") == 0, "no_deep_rows")
        .when(F.col("_rows") <= least, "too_few_rows")
        .when((F.col("_rich") < least) & (F.col("_known") == 0), "no_values")
        .when(F.col("_rich") < least, "low_signal")
        .otherwise("corrected")
    )
    judged = join_back(counts, corr, key, "left").select(*key, outcome.alias("outcome"), "_corr")
    r = F.when(F.col("outcome") == "low_signal", F.lit(1.0)).when(F.col("outcome") == "corrected", F.col("_corr"))
    usable = F.when(F.col("_near"), r)
    fixed = bio.corrected(F.col("adinos"), F.col("diatoms"), F.col("hdinos"), F.col("_r"), floor)
    done = join_back(rows, judged, key, "left").withColumn("_r", usable).withColumns(fixed)
    return done.withColumn("r", F.col("_r")).select(*proxies.columns, "depth", "profile_number", "outcome", "r")
