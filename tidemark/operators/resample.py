"""Resampling to regular grids, filling, extents and rates."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ordered import HOUR, Axis, axis, following, frames, join_back, latest, map_blocks, previous, scan, upcoming

SECOND = 1_000_000


def bin_start(us: Column, seconds: float, centred: bool) -> Column:
    """Bin label in epoch microseconds; centred bins reach half a bin to either side of the label."""
    step = int(round(seconds * SECOND))
    shifted = us + step // 2 if centred else us
    return F.floor(shifted / F.lit(step)) * F.lit(step)


def resample_mean(df: DataFrame, by: Sequence[str], us: str, cols: Sequence[str], seconds: float = 1.0, centred: bool = True) -> DataFrame:
    """Mean per time bin; only bins with rows. Partial sums are combined before the shuffle."""
    label = bin_start(F.col(us), seconds, centred)
    return df.groupBy(*by, label.alias(us)).agg(*[F.avg(c).alias(c) for c in cols])


def dense_grid(spans: DataFrame, by: Sequence[str], start: str, end: str, us: str, seconds: float = 1.0, width: int = HOUR) -> DataFrame:
    """Every grid time from start to end of each series.

    Made in two steps, first the chunks and then the times inside each, so that a long series
    does not become one huge array in one row.
    """
    step = int(round(seconds * SECOND))
    size = max(step, width // step * step)
    lo, hi = F.col(start), F.col(end)
    pieces = spans.select(
        *by, lo.alias("_lo"), hi.alias("_hi"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((hi - lo) / F.lit(size)))).alias("_k")
    ).repartition(*by, "_k")
    first = F.col("_lo") + F.col("_k") * size
    last = F.least(first + (size - step), F.col("_hi"))
    return pieces.select(*by, F.explode(F.sequence(first, last, F.lit(step).cast("bigint"))).alias(us))


def on_grid(means: DataFrame, by: Sequence[str], us: str, seconds: float = 1.0, width: int = HOUR) -> DataFrame:
    """Resampled means on their dense grid, NULL in empty bins."""
    spans = means.groupBy(*by).agg(F.min(us).alias("_start"), F.max(us).alias("_end"))
    grid = dense_grid(spans, by, "_start", "_end", us, seconds, width)
    return join_back(grid, means, [*by, us], "left")


def extent(df: DataFrame, by: Sequence[str], instr: str, ts: str, minutes: float = 5.0) -> DataFrame:
    """Start and end per instrument and mission; ``pad`` marks instruments ending early."""
    each = df.groupBy(*by, instr).agg(F.min(ts).alias("instr_start"), F.max(ts).alias("instr_end"))
    whole = each.groupBy(*by).agg(F.min("instr_start").alias("start"), F.max("instr_end").alias("end"))
    early = (F.col("end") - F.col("instr_end")) > minutes * 60 * SECOND
    return join_back(each, whole, by).withColumn("pad", early)


def pad_grid(means: DataFrame, extents: DataFrame, by: Sequence[str], instr: str, us: str, seconds: float = 1.0, width: int = HOUR) -> DataFrame:
    """Each instrument's means on the dense grid of its whole mission."""
    step = int(round(seconds * SECOND))
    spans = extents.select(
        *by, instr, (F.floor(F.col("start") / step) * step).alias("_s"), (F.floor(F.col("end") / step) * step).alias("_e")
    )
    grid = dense_grid(spans, [*by, instr], "_s", "_e", us, seconds, width)
    return join_back(grid, means, [*by, instr, us], "left")


def sample_rate(df: DataFrame, by: Sequence[str], us: str) -> DataFrame:
    """1 / mean step, two decimals; the mean step needs only count, first and last."""
    span = (F.max(us) - F.min(us)) / F.lit(1e6)
    return df.groupBy(*by).agg(F.round((F.count(us) - 1) / F.nullif(span, F.lit(0.0)), 2).alias("rate"))


def sample_rate_head(df: DataFrame, by: Sequence[str], us: str, rows: int = 10) -> DataFrame:
    """``sample_rate`` of the first rows of each series."""
    w = Window.partitionBy(*by).orderBy(us)
    return sample_rate(df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= rows), by, us)


def bounds(df: DataFrame, by: Sequence[str], us: str, cols: Sequence[str]) -> DataFrame:
    """Smallest and largest time and position, and the covered duration in seconds."""
    limits = [f(c).alias(f"{n}_{c}") for c in (us, *cols) for n, f in (("min", F.min), ("max", F.max))]
    return df.groupBy(*by).agg(*limits).withColumn("duration", (F.col(f"max_{us}") - F.col(f"min_{us}")) / F.lit(1e6))


def median3(df: DataFrame, ax: Axis, cols: Sequence[str], fill_ends: bool = False) -> DataFrame:
    """Centred median of three rows, NULL where a row of the window is missing.

    ``fill_ends`` takes the nearest full median for the rows without one, later rows first.
    """
    steps = {f"_p_{c}": previous(F.col(c)) for c in cols} | {f"_n_{c}": following(F.col(c)) for c in cols}
    near = scan(df, ax, **steps)
    middle = {}
    for c in cols:
        x, y, z = F.col(f"_p_{c}"), F.col(c), F.col(f"_n_{c}")
        full = x.isNotNull() & y.isNotNull() & z.isNotNull()
        middle[c] = F.when(full, F.greatest(F.least(x, y), F.least(F.greatest(x, y), z)))
    done = near.withColumns(middle).select(df.columns)
    if not fill_ends:
        return done
    steps = {f"_n_{c}": upcoming(F.col(c)) for c in cols} | {f"_p_{c}": latest(F.col(c)) for c in cols}
    seen = scan(done, ax, **steps)
    return seen.withColumns({c: F.coalesce(f"_n_{c}", f"_p_{c}") for c in cols}).select(df.columns)


def fill(df: DataFrame, ax: Axis, cols: Sequence[str], forward: bool = True) -> DataFrame:
    """Carry the last known value forward, or the next one backward."""
    step = latest if forward else upcoming
    seen = scan(df, ax, **{f"_f_{c}": step(F.col(c)) for c in cols})
    return seen.withColumns({c: F.col(f"_f_{c}") for c in cols}).select(df.columns)


def interpolate(df: DataFrame, by: Sequence[str], us: str, cols: Sequence[str], step_us: int = SECOND, limit: int = 3, width: int = HOUR) -> DataFrame:
    """Fill gaps of a dense grid linearly, at most ``limit`` rows after the last known value.

    A longer gap gets its first rows only; after the end the last value is repeated up to the
    limit; rows before the first value stay NULL.
    """
    steps = {}
    for c in cols:
        known = F.col(c).isNotNull()
        steps[f"_v0_{c}"], steps[f"_v1_{c}"] = latest(F.col(c)), upcoming(F.col(c))
        steps[f"_t0_{c}"], steps[f"_t1_{c}"] = latest(F.when(known, F.col(us))), upcoming(F.when(known, F.col(us)))
    near = scan(df, axis(by, us, width), **steps)
    out = {}
    for c in cols:
        v0, v1, t0, t1 = (F.col(f"_{n}_{c}") for n in ("v0", "v1", "t0", "t1"))
        within = (F.col(us) - t0) <= limit * step_us
        line = v0 + (v1 - v0) * ((F.col(us) - t0) / F.nullif(t1 - t0, F.lit(0)))
        out[c] = F.when(F.col(c).isNotNull(), F.col(c)).when(within, F.when(v1.isNull(), v0).otherwise(line))
    return near.withColumns(out).select(df.columns)


def rolling(df: DataFrame, by: Sequence[str], idx: str, col: str, fn: str, width: int, out: str, size: int = 50_000) -> DataFrame:
    """Centred rolling statistic of ``width`` rows over a dense index, shorter windows at the ends.

    An even width covers ``-width/2 .. width/2 - 1``. Narrow windows run as window expressions.
    Those visit every row of every frame, so wide ones slide in pandas, block by block, at a cost
    per row that does not grow with the width. Both give a double (the count a long) and take NaN as
    missing.
    """
    before, after = width // 2, (width - 1) // 2
    kind = T.LongType() if fn == "count" else T.DoubleType()
    if width <= 16 and fn != "median":
        make = {"min": F.min, "max": F.max, "mean": F.avg, "count": F.count, "sum": F.sum}[fn]
        # As in pandas: NaN is missing, and every statistic but the count is a double.
        value = F.col(col).cast("double")
        known = F.when(~F.isnan(value), value)
        return frames(df, by, idx, before, after, {out: lambda w: make(known).over(w).cast(kind)}, size)

    def slide(block: pd.DataFrame) -> pd.DataFrame:
        window = block[col].rolling(width, min_periods=0 if fn == "count" else 1, center=True)
        block[out] = getattr(window, fn)()
        return block

    return map_blocks(df, by, idx, before, after, slide, T.StructType([*df.schema.fields, T.StructField(out, kind)]), size)


def slope(df: DataFrame, ax: Axis, x: str, t: str, out: str = "slope") -> DataFrame:
    """First difference over time; the first row is NULL."""
    near = scan(df, ax, _x=previous(F.col(x)), _t=previous(F.col(t)))
    rise = (F.col(x) - F.col("_x")) / F.nullif((F.col(t) - F.col("_t")).cast("double"), F.lit(0.0))
    return near.withColumn(out, rise).drop("_x", "_t")


def gradient(df: DataFrame, ax: Axis, x: str, out: str = "gradient") -> DataFrame:
    """Central difference per row, one-sided at the ends."""
    near = scan(df, ax, _p=previous(F.col(x)), _n=following(F.col(x)))
    inner = (F.col("_n") - F.col("_p")) / 2
    sided = F.coalesce(F.col("_n") - F.col(x), F.col(x) - F.col("_p"))
    return near.withColumn(out, F.coalesce(inner, sided)).drop("_p", "_n")
