"""Joins of series that run on different clocks.

All of them put both sides on one time line (``unionByName``) and look along it with ``scan``, so
a hot series is split over chunks and no pair of rows is compared that is not a result. Times of
one series must be unique within each side; ``keep_monotonic`` gives that.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordered import HOUR, axis, join_back, latest, scan, upcoming


def _timeline(a: DataFrame, b: DataFrame, by: Sequence[str], ts: str, cols: Sequence[str], width: float) -> DataFrame:
    """Rows of ``a`` with the neighbouring ``b`` rows: ``_t0, _t1`` and ``<col>_0, <col>_1``."""
    left = a.withColumn("_left", F.lit(True))
    right = b.dropna(subset=[ts, *cols]).select(
        *by, ts, F.col(ts).alias("_t"), *[F.col(c).alias(f"_v_{c}") for c in cols]
    )
    both = left.unionByName(right, allowMissingColumns=True)
    steps = {"_t0": latest(F.col("_t"), peers=True), "_t1": upcoming(F.col("_t"), peers=True)}
    for c in cols:
        steps[f"{c}_0"] = latest(F.col(f"_v_{c}"), peers=True)
        steps[f"{c}_1"] = upcoming(F.col(f"_v_{c}"), peers=True)
    seen = scan(both, axis(by, ts, width), **steps)
    return seen.where("_left").drop("_left", "_t", *[f"_v_{c}" for c in cols])


def _micros(df: DataFrame, name: str) -> Column:
    return F.unix_micros(name) if df.schema[name].dataType.typeName() == "timestamp" else F.col(name)


def lerp(v0: Column, v1: Column, part: Column, whole: Column) -> Column:
    """Value at ``part`` of the way ``whole`` from v0 to v1."""
    return F.when(whole == 0, v0).otherwise(v0 + (v1 - v0) * (part / F.nullif(whole, F.lit(0))))


def interp_join(
    a: DataFrame, b: DataFrame, by: Sequence[str], ts: str, cols: Sequence[str], clamp: bool = True, width: float = HOUR
) -> DataFrame:
    """Columns of ``b`` linearly interpolated at the times of ``a``.

    Outside the time range of ``b`` the first or last value holds, or NULL without ``clamp``.
    """
    near = _timeline(a, b, by, ts, cols, width)
    t, t0, t1 = (_micros(near, n) for n in (ts, "_t0", "_t1"))
    out = {}
    for c in cols:
        v0, v1 = F.col(f"{c}_0"), F.col(f"{c}_1")
        inside = lerp(v0, v1, t - t0, t1 - t0)
        ends = F.coalesce(v0, v1) if clamp else F.lit(None)
        out[c] = F.when(v0.isNull() | v1.isNull(), ends).otherwise(inside)
    return near.withColumns(out).select(*a.columns, *cols)


def asof_nearest(
    a: DataFrame, b: DataFrame, by: Sequence[str], ts: str, cols: Sequence[str], width: float = HOUR, time_as: str | None = None
) -> DataFrame:
    """Columns of the ``b`` row nearest in time, either direction; a tie takes the earlier row."""
    near = _timeline(a, b, by, ts, cols, width)
    t, t0, t1 = (_micros(near, n) for n in (ts, "_t0", "_t1"))
    later = t0.isNull() | ((t1 - t) < (t - t0))
    out = {c: F.when(later, F.col(f"{c}_1")).otherwise(F.col(f"{c}_0")) for c in cols}
    extra = [F.when(later, F.col("_t1")).otherwise(F.col("_t0")).alias(time_as)] if time_as else []
    return near.select(*a.columns, *[v.alias(c) for c, v in out.items()], *extra)


def nearest_row(events: DataFrame, grid: DataFrame, by: Sequence[str], ts: str, cols: Sequence[str], width: float = HOUR) -> DataFrame:
    """For each event the one grid row nearest in time, with that row's time."""
    return asof_nearest(events, grid, by, ts, cols, width, time_as="grid_time")


def band_join(events: DataFrame, grid: DataFrame, by: Sequence[str], ts: str, seconds: float) -> DataFrame:
    """Pairs of event and grid row at most ``seconds`` apart (inclusive).

    Events are copied into the two or three time cells they can reach, so the join is an
    equi-join on (key, cell) and only rows of one cell meet.
    """
    reach = int(round(seconds * 1e6))
    cell = max(2 * reach, 1)
    t = F.unix_micros("_event_ts")
    placed = events.withColumnRenamed(ts, "_event_ts").withColumn(
        "_cell", F.explode(F.sequence(F.floor((t - reach) / F.lit(cell)), F.floor((t + reach) / F.lit(cell))))
    )
    celled = grid.withColumn("_cell", F.floor(F.unix_micros(ts) / F.lit(cell)))
    gap = F.abs(F.unix_micros(ts) - t)
    return join_back(celled, placed, [*by, "_cell"]).where(gap <= reach).drop("_cell").withColumnRenamed("_event_ts", "event_ts")


def segment_join(nav: DataFrame, fixes: DataFrame, by: Sequence[str], ts: str, cols: Sequence[str], width: float = HOUR) -> DataFrame:
    """Give each dead-reckoned point the fixes around it.

    ``seg_start`` and ``seg_end`` are the times of the fixes strictly before and after; NULL
    before the first and after the last fix. Points at the time of a fix drop out. The values of
    the following fix are in ``fix_<col>``.
    """
    near = _timeline(nav, fixes, by, ts, cols, width)
    tied = F.col("_t0") == F.col("_t1")
    kept = near.where(~F.coalesce(tied, F.lit(False)))
    return kept.select(
        *nav.columns, F.col("_t0").alias("seg_start"), F.col("_t1").alias("seg_end"), *[F.col(f"{c}_1").alias(f"fix_{c}") for c in cols]
    )


def time_join(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of both series at exactly the same time, the last of ``on``; rows without a time match nobody."""
    return join_back(a.where(F.col(on[-1]).isNotNull()), b, on)


def aligned(a: DataFrame, b: DataFrame, on: Sequence[str], how: str = "full") -> DataFrame:
    """Both series on their common index, NULL where one side has no row."""
    return a.join(b, list(on), how)


def effective(df: DataFrame, dim: DataFrame, at: str, valid_from: str, by: Sequence[str] = (), first_if_none: bool = True, width: float = 720 * HOUR) -> DataFrame:
    """Newest dimension row valid at a time, else the first one (or none).

    Looked up along the time line like any other series, whatever the size of the dimension. A
    dimension row without ``valid_from`` is never valid; a fact without a time has no row before it,
    so it gets the first one (or none).
    """
    keys = list(by) or ["_all"]
    facts = df if by else df.withColumn("_all", F.lit(1))
    rows = dim if by else dim.withColumn("_all", F.lit(1))
    cols = [c for c in dim.columns if c not in by]
    dated = rows.where(F.col(valid_from).isNotNull()).select(*keys, F.col(valid_from).alias(at), F.struct(*cols).alias("_row"))
    near = _timeline(facts, dated, keys, at, ["_row"], width)
    found = F.when(F.col(at).isNotNull(), F.col("_row_0"))
    if first_if_none:
        first = dated.groupBy(*keys).agg(F.min_by("_row", at).alias("_first"))
        first = first.withColumnsRenamed({k: f"_k_{k}" for k in keys})
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
        near = near.join(first, same, "left")
        found = F.coalesce(found, "_first")
    return near.withColumn("_found", found).select(*df.columns, "_found.*")


def contains_event(intervals: DataFrame, events: DataFrame, by: Sequence[str], start: str, end: str, at: str, name: str) -> DataFrame:
    """Whether an event of the series falls into the closed interval.

    Looks up the first event at or after the start instead of comparing all pairs.
    """
    first = (
        intervals.select(*by, F.col(start).alias("_at"))
        .distinct()
        .unionByName(events.select(*by, F.col(at).alias("_at"), F.col(at).alias("_event")).distinct(), allowMissingColumns=True)
    )
    seen = scan(first, axis(by, "_at", 24 * HOUR), _next=upcoming(F.col("_event"), peers=True))
    starts = seen.where(F.col("_event").isNull()).select(*by, F.col("_at").alias(start), "_next")
    return join_back(intervals, starts, [*by, start], "left").withColumn(name, F.coalesce(F.col("_next").between(F.col(start), F.col(end)), F.lit(False))).select(*intervals.columns, name)


def match_axis(variables: DataFrame, axes: DataFrame, by: Sequence[str], var: str = "var", name: str = "axis") -> DataFrame:
    """The time axis whose prefix is the longest one starting the variable's name.

    ``axes`` hold names like ``<prefix>_time`` or ``<prefix>_time_60hz``. Prefixes end at an
    underscore, so the candidates of a variable are its own leading words: an equi-join.
    """
    prefixes = axes.withColumn("_prefix", F.regexp_replace(name, "_time(_60hz)?$", ""))
    words = F.split(var, "_")
    lead = F.transform(F.sequence(F.lit(1), F.size(words)), lambda k: F.array_join(F.slice(words, 1, k), "_"))
    tried = variables.withColumn("_prefix", F.explode(lead))
    hits = join_back(tried, prefixes, [*by, "_prefix"])
    return hits.groupBy(*by, var).agg(F.max_by(name, F.struct(F.length("_prefix"), F.length(name) * -1)).alias(name))


def axes_equal(a: DataFrame, b: DataFrame, by: Sequence[str], seq: str, t: str, rtol: float = 1e-10) -> DataFrame:
    """Whether two time axes have equal length and agree within a relative tolerance."""
    pair = join_back(a.select(*by, seq, F.col(t).alias("_a")), b.select(*by, seq, F.col(t).alias("_b")), [*by, seq], "full")
    gap = F.abs(F.col("_a") - F.col("_b"))
    return pair.groupBy(*by).agg(
        F.max(gap).alias("max_gap"),
        F.bool_and(F.coalesce(gap <= rtol * F.abs(F.col("_b")), F.lit(False))).alias("equal"),
    )


def pick_serial(sensors: DataFrame, by: Sequence[str], serial: str, sides: Sequence[str] = ("port", "stbd")) -> DataFrame:
    """Sides by the order of the serial numbers; a number of sensors other than the sides is ambiguous."""
    w = Window.partitionBy(*by)
    nth = F.row_number().over(w.orderBy(serial))
    named = sensors.withColumns({"_nth": nth, "_n": F.count(F.lit(1)).over(w)})
    return (
        named.withColumn("ambiguous", F.col("_n") != len(sides))
        .withColumn("side", F.when(~F.col("ambiguous"), F.element_at(F.array(*[F.lit(s) for s in sides]), F.least(F.col("_nth"), F.lit(len(sides))))))
        .drop("_nth", "_n")
    )


def compare(a: DataFrame, b: DataFrame, on: Sequence[str], col: str) -> DataFrame:
    """Two products side by side with their difference."""
    left = a.select(*on, F.col(col).alias("a"))
    right = b.select(*on, F.col(col).alias("b"))
    return left.join(right, list(on), "full").withColumn("difference", F.col("a") - F.col("b"))
