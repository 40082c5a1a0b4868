"""Cleaning: clock repair, row filters, range rules, small projections."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordered import (
    Axis,
    following,
    join_back,
    order_value,
    previous,
    quantiles,
    row_index,
    running,
    scan,
    small,
)
from tidemark.session import durable


def keep_monotonic(df: DataFrame, ax: Axis, ts: str = "ts") -> DataFrame:
    """Rows whose time exceeds every earlier kept time, in arrival order (strictly).

    The last kept time is the running maximum of all earlier rows, so no row-by-row loop.
    """
    seen = scan(df, ax, _seen=running("max", F.col(ts), inclusive=False))
    return seen.where(F.col("_seen").isNull() | (F.col(ts) > F.col("_seen"))).drop("_seen")


def in_window(df: DataFrame, windows: DataFrame, by: Sequence[str], ts: str, pad: str) -> DataFrame:
    """Rows with a time inside ``[start - pad, end + pad]`` of their series."""
    span = windows.select(
        *by,
        (F.col("start") - F.expr(f"INTERVAL {pad}")).alias("_from"),
        (F.col("end") + F.expr(f"INTERVAL {pad}")).alias("_to"),
    )
    return join_back(df, span, by).where(F.col(ts).between(F.col("_from"), F.col("_to"))).drop("_from", "_to")


def window_counts(df: DataFrame, windows: DataFrame, by: Sequence[str], t: str, pad_s: float = 600.0) -> DataFrame:
    """Rows, missing times and times outside the padded window of each series (epoch seconds)."""
    span = windows.select(*by, (F.unix_seconds("start") - pad_s).alias("_from"), (F.unix_seconds("end") + pad_s).alias("_to"))
    finite = F.col(t).isNotNull() & ~F.isnan(t) & (F.abs(t) < float("inf"))
    return join_back(df, span, by).groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~finite).alias("missing"),
        F.count_if(finite & ~F.col(t).between(F.col("_from"), F.col("_to"))).alias("outside"),
    )


def drop_time_spikes(df: DataFrame, ax: Axis, t: str, threshold: float = 10.0) -> DataFrame:
    """Remove single points whose clock jumps away and back.

    A point goes when the step to it has a robust z-score above ``threshold`` and the next step
    has the opposite sign and a z-score above half of it. ``t`` is numeric.
    """
    steps = scan(df, ax, _prev=previous(F.col(t)), _next=following(F.col(t))).withColumns(
        {"_in": F.col(t) - F.col("_prev"), "_out": F.col("_next") - F.col(t)}
    )
    steps = durable(steps)
    by = list(ax.by)
    middle = durable(quantiles(steps, by, "_in", {"_med": 0.5}))
    spread = join_back(steps.select(*by, "_in"), middle, by).withColumn("_dev", F.abs(F.col("_in") - F.col("_med")))
    mad = quantiles(spread, by, "_dev", {"_mad": 0.5})
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    scored = join_back(steps, join_back(join_back(middle, mad, by), counts, by), by, "left")

    def z(step: str) -> Column:
        return F.lit(0.6745) * F.abs(F.col(step) - F.col("_med")) / F.col("_mad")

    spike = (
        (F.col("_n") >= 3)
        & (F.col("_mad") != 0)
        & (z("_in") > threshold)
        & (F.col("_in") * F.col("_out") < 0)
        & (z("_out") > threshold / 2)
    )
    return scored.where(~F.coalesce(spike, F.lit(False))).select(*df.columns)


def intersect_indices(df: DataFrame, by: Sequence[str], seq: str, var: str) -> DataFrame:
    """Keep the samples present for every variable of their series; leave single-variable series."""
    present = df.groupBy(*by).agg(F.count_distinct(var).alias("_vars"))
    have = df.groupBy(*by, seq).agg(F.count_distinct(var).alias("_have"))
    whole = join_back(have, present, by).where((F.col("_vars") < 2) | (F.col("_have") == F.col("_vars")))
    return join_back(df, whole.select(*by, seq), [*by, seq], "left_semi")


def align_indices(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Only the samples both sides still have."""
    return a.join(b, list(on))


def drop_bad_time(df: DataFrame, t: str, fill: float = -1e20) -> DataFrame:
    """Drop rows whose time is a fill value."""
    return df.where(F.col(t) >= fill)


def range_qc_drop(df: DataFrame, rules: DataFrame, key: Sequence[str], var: str, value: str) -> DataFrame:
    """Drop *all* variables of a sample when any checked variable is out of its inclusive range.

    ``df`` is long; NULL is not out of range.
    """
    checked = df.join(small(rules), var)
    bad = checked.where((F.col(value) < F.col("lo")) | (F.col(value) > F.col("hi"))).select(*key).distinct()
    return join_back(df, bad, key, "left_anti")


def out_of_range(col: str, lo: float, hi: float) -> Column:
    return F.coalesce((F.col(col) < lo) | (F.col(col) > hi), F.lit(False))


def range_qc_null(df: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """NULL out-of-range values; a row bad in one variable is also NULL in the later ones."""
    bad = F.lit(False)
    cleaned = {}
    for col, (lo, hi) in ranges.items():
        bad = bad | out_of_range(col, lo, hi)
        cleaned[col] = F.when(~bad, F.col(col))
    return df.withColumns(cleaned)


def apply_rules(df: DataFrame, rules: DataFrame, mission: str, limits: dict[str, tuple[str, str]]) -> DataFrame:
    """Keep rows inside their mission's limits; a mission without a rule keeps every row.

    ``limits`` maps a value column to the rule table's lower and upper limit columns.
    """
    inside = [
        F.coalesce(F.col(v).between(F.col(lo), F.col(hi)), F.col(v).isNull() | F.col(lo).isNull())
        for v, (lo, hi) in limits.items()
    ]
    return df.join(small(rules), mission, "left").where(reduce(Column.__and__, inside)).select(df.columns)


def zero_to_null(col: Column) -> Column:
    """A zero frequency means the sensor was off."""
    return F.nullif(col, F.lit(0.0))


def frozen_to_null(col: Column) -> Column:
    """Temperatures at or below absolute zero are fill values."""
    return F.when(col > -273, col)


def negative_to_null(col: Column) -> Column:
    return F.when(col >= 0, col)


def default_flow(col: Column, flow: float = 350.0) -> Column:
    """A zero pump flow is replaced by the nominal one (mL/s)."""
    return F.when(col == 0, F.lit(flow)).otherwise(col)


def backscatter_qc(df: DataFrame, by: Sequence[str], blue: str, red: str, fluo: str, legacy: bool = False) -> DataFrame:
    """NULL backscatter above 0.1; fluorescence is kept as it is.

    With ``legacy`` the red channel follows the fluorescence mask and nothing is masked unless
    every channel of the series has at least one bad value.
    """
    bad_blue = F.coalesce(F.col(blue) > 0.1, F.lit(True))
    bad_red = F.coalesce(F.col(red) > 0.1, F.lit(True))
    bad_fluo = F.coalesce(F.col(fluo) > 0.02, F.lit(True))
    if not legacy:
        return df.withColumns({blue: F.when(~bad_blue, F.col(blue)), red: F.when(~bad_red, F.col(red))})
    armed = df.groupBy(*by).agg((F.bool_or(bad_blue) & F.bool_or(bad_red) & F.bool_or(bad_fluo)).alias("_armed"))
    return (
        join_back(df, armed, by)
        .withColumns(
            {
                blue: F.when(~(F.col("_armed") & bad_blue), F.col(blue)),
                red: F.when(~(F.col("_armed") & bad_fluo), F.col(red)),
            }
        )
        .drop("_armed")
    )


def tidy_series(df: DataFrame, by: Sequence[str], ts: str, seq: str, value: str, start: Column, end: Column) -> DataFrame:
    """Drop null times and values, gate to the deployment, keep the first row of a repeated time."""
    gated = df.where(F.col(ts).isNotNull() & F.col(value).isNotNull() & F.col(ts).between(start, end))
    w = Window.partitionBy(*by, ts).orderBy(seq)
    return gated.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def drop_incomplete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def incomplete_share(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Rows dropped by ``drop_incomplete`` and their percentage, per series."""
    holes = reduce(Column.__or__, [F.col(c).isNull() for c in cols])
    return df.groupBy(*by).agg(
        F.count_if(holes).alias("removed"),
        (F.lit(100.0) * F.count_if(holes) / F.count(F.lit(1))).alias("percent"),
    )


def shift_clock(df: DataFrame, ts: str, seconds: float) -> DataFrame:
    """Add seconds to the clock (1024 weeks of GPS roll-over) and name the corrected mission."""
    moved = F.timestamp_micros(F.unix_micros(F.col(ts)) + F.lit(int(round(seconds * 1e6))))
    return df.withColumn(ts, moved).withColumn("mission", F.date_format(F.col(ts), "yyyy.DDD"))


def dedupe_names(names: Sequence[str]) -> list[str]:
    """Give repeats of one name a counter; two different repeated names are an error."""
    repeated = sorted({n for n in names if names.count(n) > 1})
    if len(repeated) > 1:
        raise ValueError(f"more than one repeated name: {repeated}")
    out, n = [], 0
    for name in names:
        n += name in repeated
        out.append(f"{name}{n}" if name in repeated and n > 1 else name)
    return out


def dedupe_fields(fields: DataFrame, by: Sequence[str], pos: str, name: str) -> DataFrame:
    """``dedupe_names`` for a catalog of files: the second and later copy get their number."""
    w = Window.partitionBy(*by, name).orderBy(pos)
    nth = F.row_number().over(w)
    return fields.withColumn(
        "unique_name", F.when(nth > 1, F.concat(F.col(name), nth.cast("string"))).otherwise(F.col(name))
    )


def stride(df: DataFrame, ax: Axis, n: int) -> DataFrame:
    """Rows 0, n, 2n ... of each series."""
    return row_index(df, ax, "_pos").where(F.col("_pos") % n == 0).drop("_pos")


def clock_sync(a: DataFrame, b: DataFrame, by: Sequence[str], seq: str, t: str) -> DataFrame:
    """Compare two clocks sample by sample (seconds): share that differ, largest difference, grade."""
    numbered = a.where(F.col(seq).isNotNull()).select(*by, seq, F.col(t).alias("_a"))
    pair = join_back(numbered, b.select(*by, seq, F.col(t).alias("_b")), [*by, seq])
    diff = F.abs(F.col("_a") - F.col("_b"))
    stats = pair.groupBy(*by).agg(
        (F.avg((diff > 0).cast("double")) * 100).alias("percent_diff"), F.max(diff).alias("max_diff")
    )
    grade = (
        F.when((F.col("percent_diff") > 50) | (F.col("max_diff") > 3600), "major")
        .when((F.col("percent_diff") > 5) | (F.col("max_diff") > 60), "minor")
        .otherwise("ok")
    )
    return stats.withColumn("grade", grade)


def clip_null(df: DataFrame, limits: dict[str, tuple[float, float]]) -> DataFrame:
    """NULL values outside their limits and drop rows missing any of the columns."""
    clipped = {c: F.when(F.col(c).between(lo, hi), F.col(c)) for c, (lo, hi) in limits.items()}
    return df.withColumns(clipped).dropna(subset=list(limits))


def drop_garbled(df: DataFrame, counts: str, threshold: str, buffer: str) -> DataFrame:
    """Particle frames with an impossible count in bins 101..127, a wrong threshold or status."""
    garbled = F.exists(F.slice(F.col(counts), 102, 27), lambda c: c > 1000)
    return df.where(~garbled & (F.col(threshold) == 100) & F.col(buffer).isin(0, 1))


def to_degrees(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Radians to degrees; ``platform_orientation`` is the yaw."""
    turned = df.withColumns({c: F.degrees(c) for c in cols})
    return turned.withColumnRenamed("platform_orientation", "yaw")


def fix_lon_sign(df: DataFrame, by: Sequence[str], lon: str, order: Sequence[str]) -> DataFrame:
    """Negate a series' longitudes when its first one is positive."""
    first = df.groupBy(*by).agg(F.min_by(lon, order_value(order)).alias("_first"))
    signed = F.when(F.col("_first") > 0, -F.col(lon)).otherwise(F.col(lon))
    return join_back(df, first, by).withColumn(lon, signed).drop("_first")


def relative(df: DataFrame, by: Sequence[str], cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Values relative to the first sample of the series."""
    pos = order_value(order)
    first = df.groupBy(*by).agg(*[F.min_by(c, pos).alias(f"_{c}") for c in cols])
    moved = {c: F.col(c) - F.col(f"_{c}") for c in cols}
    return join_back(df, first, by).withColumns(moved).select(df.columns)


def apply_lag(df: DataFrame, settings: DataFrame, instr: str, ts: str) -> DataFrame:
    """Move times back by the plumbing lag of the instrument."""
    lag = F.coalesce(F.round(F.col("lag_secs") * 1_000_000).cast("bigint"), F.lit(0))
    moved = F.timestamp_micros(F.unix_micros(F.col(ts)) - lag)
    return df.join(small(settings), instr, "left").withColumn(ts, moved).select(df.columns)


def resolve_names(names: DataFrame, by: Sequence[str], var: str, ranked: Sequence[str]) -> DataFrame:
    """First available of several candidate variables, per mission."""
    rank = F.array_position(F.array(*[F.lit(r) for r in ranked]), F.col(var))
    return names.where(rank > 0).groupBy(*by).agg(F.min_by(var, rank).alias("variable"))


def plain_name(var: Column) -> Column:
    """``x_bin_mean_y`` and ``x_bin_median_y`` name the same variable ``x_y``."""
    return F.regexp_replace(var, "_bin_(mean|median)_", "_")


def name_times(df: DataFrame, name: str) -> DataFrame:
    """Log start, end and duration in minutes from ``yyyyMMddHHmm_yyyyMMddHHmm``."""
    stamp = r"(\d{12})_(\d{12})"
    start = F.to_timestamp(F.regexp_extract(name, stamp, 1), "yyyyMMddHHmm")
    end = F.to_timestamp(F.regexp_extract(name, stamp, 2), "yyyyMMddHHmm")
    return df.withColumns({"log_start": start, "log_end": end}).withColumn(
        "minutes", (F.unix_micros("log_end") - F.unix_micros("log_start")) / F.lit(60_000_000.0)
    )


def correct_counter_wraps(df: DataFrame, ax: Axis, counter: str) -> DataFrame:
    """Unwrap a 16-bit sample counter: 65537 is added after each fall of about 65535."""
    stepped = scan(df, ax, _step=previous(F.col(counter)))
    fell = (F.col(counter) - F.col("_step")).between(-65539, -65531)
    flagged = stepped.withColumn("_wrap", F.when(fell, 1).otherwise(0))
    counted = scan(flagged, ax, _wraps=running("sum", F.col("_wrap")))
    return counted.withColumn(counter, F.col(counter) + F.col("_wraps") * 65537).drop("_step", "_wrap", "_wraps")
