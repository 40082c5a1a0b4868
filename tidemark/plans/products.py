"""Particle spectra, deployments and comparisons of instruments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.biology import flow_speed, unpack_words
from tidemark.operators import particles as pt
from tidemark.operators import section as sec
from tidemark.operators import signal as sig
from tidemark.operators.arrays import concat_logs
from tidemark.operators.clean import clip_null, drop_garbled
from tidemark.operators.ordered import Axis, axis, join_back, row_index
from tidemark.operators.resample import resample_mean
from tidemark.operators.samples import sample_means
from tidemark.operators.stats import ols
from tidemark.operators.timejoin import time_join
from tidemark.session import durable
from tidemark.sources.logs import cartridge_events


def particle_spectra(words: DataFrame, ax: Axis, frame: Column, interval: int = 20) -> tuple[DataFrame, DataFrame]:
    """Particles from raw words: statistics with classes per interval, and size spectra.

    ``words`` has the columns ``a``, ``b`` and ``c``; ``frame`` is the frame a fragment came in.
    """
    by = list(ax.by)
    fields = words.withColumns(unpack_words(F.col("a"), F.col("b"), F.col("c"))).withColumn("_frame", frame).drop("a", "b", "c")
    fragments = pt.build_particles(fields, ax)
    starts = fragments.groupBy(*by, "particle").agg(F.min("_frame").alias("frame"))
    attributes = durable(join_back(pt.particle_attributes(fragments, [*by, "particle"]), starts, [*by, "particle"]))
    binned = attributes.withColumn("bin", pt.frame_bin("frame", interval))
    classes = pt.particle_classes(binned, [*by, "bin"])
    stats = join_back(pt.bin_particles(attributes, by, "frame", interval), classes, [*by, "bin"])
    return stats, pt.size_histogram(binned, [*by, "bin"])


def total_spectra(multi: DataFrame, frames: DataFrame, by: Sequence[str], frame: str, counts: str, interval: int = 20) -> DataFrame:
    """Spectra of all particles: those of several elements with the single-element counts of the frames."""
    single = pt.bin_counts(frames, by, frame, counts, interval)
    return pt.add_counts([multi, single], [*by, "bin"])


def particle_frames(frames: DataFrame, ax: Axis, size: int = 50_000) -> DataFrame:
    """Frames with their time and flow speed: garbled ones dropped, the counter repaired.

    ``frames`` has ``counts``, ``threshold``, ``buffer``, ``counter``, ``flow_time``, ``flow_count``
    and the ``start`` of the series in seconds.
    """
    by = list(ax.by)
    sound = drop_garbled(frames, "counts", "threshold", "buffer")
    dense = durable(row_index(sound, ax, "_i"))
    repaired = pt.repair_counter(dense, axis(by, "_i", size), "counter")
    timed = pt.frame_times(durable(repaired), by, "_i", "counter", "start").drop("_i")
    return timed.withColumn("speed", flow_speed(F.col("flow_time"), F.col("flow_count")))


def deployment(logs: Sequence[DataFrame], by: Sequence[str], us: str, seq: str, width: float, size: float = 100_000) -> DataFrame:
    """Logs of a deployment as one track: distance in km and profile numbers that count on."""
    rows = concat_logs(logs, by, us, seq, unique=True)
    indexed = durable(row_index(rows, axis(by, us, width), "idx"))
    track = sec.with_distance_km(sec.track_distance(indexed, by, "idx", us, "lat", "lon", size=size))
    return sig.cumulative_profile(durable(track), by, [us], "profile_number", width)


def deployment_products(
    track: DataFrame, logs: DataFrame, by: Sequence[str], us: str, depth: str, value: str, used: str, width: int, size: float = 100_000
) -> dict[str, DataFrame]:
    """Products of a deployment's track: the bottom of its profiles, a section along the distance, the
    kilometres of each log, and the use per kilometre."""
    rows = durable(row_index(track, axis(by, us, width), "idx"))
    return {
        "bottom": sec.profile_bottom(rows.select(*by, us, "idx", depth), by, "idx", depth, size=size),
        "section": sec.grid_section(rows, by, "km", depth, "cumulative", value, size=size),
        "ranges": sec.log_ranges(rows, logs, by, us, "km", width),
        "rate": sec.rate_per_km(rows, by, us, "km", used, size),
    }


def cartridge_samples(
    lines: DataFrame,
    grid: DataFrame,
    by: Sequence[str],
    line_no: str,
    line: str,
    candidates: dict[str, Sequence[str]],
    ts: str = "ts",
    seconds: float = 1.0,
    size: float = 100_000,
) -> DataFrame:
    """Measurements at the start of each sample of the cartridge sampler, from its log lines."""
    events = cartridge_events(lines, by, line_no, line, size)
    timed = events.withColumn(ts, F.timestamp_micros(F.round(F.col("seconds") * 1_000_000).cast("bigint"))).drop("seconds")
    return sample_means(timed, grid, by, "sample", candidates, ts, seconds)


def compare_instruments(
    a: DataFrame, b: DataFrame, by: Sequence[str], us: str, x: str, y: str, limits: dict[str, tuple[float, float]], seconds: float = 2.0
) -> DataFrame:
    """Regress one instrument on another: values clipped, means of equal bins, joined on time."""
    left = resample_mean(clip_null(a, {x: limits[x]}), by, us, [x], seconds)
    right = resample_mean(clip_null(b, {y: limits[y]}), by, us, [y], seconds)
    return ols(time_join(left, right, [*by, us]), by, x, y)
