"""Particle counter: counter repair, particle assembly, size spectra, frame times."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.biology import INTENSITY_MAX, diameter_um, size_bin
from tidemark.operators.clean import correct_counter_wraps
from tidemark.operators.ordered import Axis, following, join_back, latest, previous, running, scan, upcoming
from tidemark.operators.timejoin import interp_join
from tidemark.session import durable


#: Rows within which a zero or a spike is repaired from its neighbours, and the jump that opens a spike.
ZERO_REACH, SPIKE_LENGTH, JUMP = 5, 20, 300


def _on_line(at: Column, at0: Column, v0: Column, at1: Column, v1: Column) -> Column:
    """Whole number at ``at`` on the line between two known rows."""
    return (v0 + F.floor((at - at0) * (v1 - v0) / (at1 - at0))).cast("bigint")


def fill_zeros(df: DataFrame, ax: Axis, counter: str, reach: int = ZERO_REACH) -> DataFrame:
    """Zeros become the line between the nearest other values, if both are less than ``reach`` rows away."""
    idx, v = F.col(ax.order[0]), F.col(counter)
    good = v != 0
    near = scan(
        df,
        ax,
        _i0=latest(F.when(good, idx)),
        _v0=latest(F.when(good, v)),
        _i1=upcoming(F.when(good, idx)),
        _v1=upcoming(F.when(good, v)),
    )
    line = _on_line(idx, F.col("_i0"), F.col("_v0"), F.col("_i1"), F.col("_v1"))
    close = (idx - F.col("_i0") < reach) & (F.col("_i1") - idx < reach)
    return near.withColumn(counter, F.when((v == 0) & close, line).otherwise(v)).select(df.columns)


def unstick(df: DataFrame, ax: Axis, counter: str) -> DataFrame:
    """A value that stays the same counts on from its first row, however long it stays."""
    idx, v = F.col(ax.order[0]), F.col(counter)
    stepped = scan(df, ax, _before=previous(v))
    begins = F.when(F.col("_before").isNull() | v.isNull() | (F.col("_before") != v), idx)
    runs = scan(stepped, ax, _begin=latest(begins))
    return runs.withColumn(counter, v + idx - F.col("_begin")).select(df.columns)


def despike(df: DataFrame, ax: Axis, counter: str, jump: int = JUMP, longest: int = SPIKE_LENGTH) -> DataFrame:
    """Rows between a jump and the jump back become the line between the rows around them.

    Jumps less than ``longest`` rows apart are a cluster; in a cluster the first and second jump are a
    spike, the third and fourth the next, if they go in opposite directions. A jump without a partner
    is a lasting step and stays.
    """
    by, at, v = list(ax.by), ax.order[0], F.col(counter)
    stepped = scan(df, ax, _before=previous(v))
    stepped = durable(stepped.withColumn("_jump", v - F.col("_before")))
    jumps = stepped.where(F.abs("_jump") > jump).select(*by, at, "_before", "_jump", v.alias("_value"))
    apart = F.col(at) - F.col("_last") > longest
    placed = scan(jumps, ax, _last=previous(F.col(at)), _next=following(F.col(at)), _back=following(F.col("_jump")), _end=following(F.col("_value")))
    numbered = scan(placed.withColumn("_opens", F.col("_last").isNull() | apart), ax, _n=running("sum", F.lit(1).cast("bigint")))
    first = scan(numbered, ax, _first=latest(F.when(F.col("_opens"), F.col("_n"))))
    returns = (F.col("_next") - F.col(at) <= longest) & (F.signum("_jump") == -F.signum("_back"))
    spikes = first.where(((F.col("_n") - F.col("_first")) % 2 == 0) & returns)
    rows = spikes.withColumn("_at", F.explode(F.sequence(F.col(at), F.col("_next") - 1)))
    line = _on_line(F.col("_at"), F.col(at) - 1, F.col("_before"), F.col("_next"), F.col("_end"))
    keys = {k: f"_k_{k}" for k in by}
    mended = rows.select(*[F.col(k).alias(n) for k, n in keys.items()], "_at", line.alias("_line"))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(n)) for k, n in keys.items()], F.col(at) == F.col("_at"))
    return stepped.join(mended, same, "left").withColumn(counter, F.coalesce("_line", counter)).select(df.columns)


def repair_counter(df: DataFrame, ax: Axis, counter: str) -> DataFrame:
    """Repair a 16-bit sample counter: wraps, zeros, stuck values and spikes, in that order.

    ``ax`` is ordered by a dense row index. All steps look along the whole series, so the result does
    not depend on its chunks. A NULL counter stays NULL and ends a run of equal values.
    """
    whole = df.withColumn(counter, F.col(counter).cast("bigint"))
    for step in (correct_counter_wraps, fill_zeros, unstick, despike):
        whole = step(whole, ax, counter)
    return whole


def build_particles(df: DataFrame, ax: Axis, start: str = "n", out: str = "particle") -> DataFrame:
    """Number the particles: a fragment with the start flag opens one. Fragments before the first
    start of a series belong to no particle and are dropped."""
    counted = scan(df, ax, **{out: running("sum", F.col(start).cast("bigint"))})
    return counted.where(F.col(out) > 0)


def particle_attributes(df: DataFrame, by: Sequence[str], p: str = "p", e: str = "e") -> DataFrame:
    """Attenuance, occluded elements and equivalent diameter (um) of each particle."""
    total = F.sum(p)
    return df.groupBy(*by).agg(
        (F.avg(p) / INTENSITY_MAX).alias("ai"), F.count_distinct(e).alias("od"), diameter_um(total).alias("esd"), F.count(F.lit(1)).alias("fragments")
    )


def size_histogram(df: DataFrame, by: Sequence[str], esd: str = "esd") -> DataFrame:
    """Particles per size bin."""
    return df.groupBy(*by, size_bin(F.col(esd)).alias("size_bin")).agg(F.count(F.lit(1)).alias("n"))


def particle_classes(
    df: DataFrame, by: Sequence[str], ai_min: float = 0.6, esd_min: float = 1100.0, esd_max: float = 1700.0, clear_max: float = 0.4
) -> DataFrame:
    """Large copepods, and transparent against opaque particles."""
    ai, esd = F.col("ai"), F.col("esd")
    return df.groupBy(*by).agg(
        F.count_if((ai > ai_min) & (esd > esd_min) & (esd < esd_max)).alias("large_copepods"),
        F.count_if(ai <= clear_max).alias("transparent"),
        F.count_if(ai > clear_max).alias("opaque"),
    )


def frame_bin(frame: str, interval: int = 20):
    """Binning interval of a frame; an interval is flushed by the frame after the 20th."""
    return F.floor(F.col(frame) / F.lit(interval + 1))


def bin_particles(df: DataFrame, by: Sequence[str], frame: str, interval: int = 20) -> DataFrame:
    """Particle statistics per interval; the deviations are those of the whole population."""
    aggs = [f(c).alias(f"{c}_{n}") for c in ("ai", "esd") for n, f in (("mean", F.avg), ("min", F.min), ("max", F.max), ("std", F.stddev_pop))]
    return df.groupBy(*by, frame_bin(frame, interval).alias("bin")).agg(F.count(F.lit(1)).alias("n"), *aggs)


def bin_counts(df: DataFrame, by: Sequence[str], frame: str, counts: str, interval: int = 20) -> DataFrame:
    """Single-element counts summed per interval and size bin, long."""
    rows = df.select(*by, frame_bin(frame, interval).alias("bin"), F.posexplode(counts).alias("size_bin", "_c"))
    return rows.groupBy(*by, "bin", "size_bin").agg(F.sum("_c").alias("n"))


def add_counts(parts: Sequence[DataFrame], by: Sequence[str]) -> DataFrame:
    """Counts per size bin of single-element and multi-element particles together."""
    rows = reduce(DataFrame.unionByName, [p.select(*by, "size_bin", "n") for p in parts])
    return rows.groupBy(*by, "size_bin").agg(F.sum("n").alias("n"))


def frame_times(df: DataFrame, by: Sequence[str], order: str, counter: str, start: str, step: float = 0.5) -> DataFrame:
    """Time of each frame from the repaired counter: ``start + step * (counter - first)``."""
    first = df.groupBy(*by).agg(F.min_by(counter, order).alias("_first"))
    seconds = F.col(start) + step * (F.col(counter) - F.col("_first"))
    return join_back(df, first, by).withColumn("frame_time", seconds).drop("_first")


def frame_clock(frames: DataFrame, clock: DataFrame, by: Sequence[str], frame: str, seconds: str, width: float = 100_000) -> DataFrame:
    """The clock sent every few seconds, interpolated to the frames that were written."""
    return interp_join(frames, clock, by, frame, [seconds], width=width)
