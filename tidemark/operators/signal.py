"""Peaks, turning points, profiles, night windows, background levels and filters."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.geo import sun_altitude
from tidemark.operators.ordered import (
    HOUR,
    axis,
    following,
    join_back,
    latest,
    leaves,
    map_blocks,
    previous,
    quantiles,
    row_index,
    running,
    scan,
)
from tidemark.operators.resample import resample_mean, rolling
from tidemark.session import durable

ENVELOPE_MIN = 1.5e10
FLASH_THRESHOLD = 1.0e11


def peaks(df: DataFrame, by: Sequence[str], idx: str, x: str, width: float = 100_000) -> DataFrame:
    """Local maxima: higher than the rows around; a plateau counts once, at its middle.

    The ends of a series are never peaks. Runs of equal values shrink to their first row, whose
    neighbours among the runs decide, so a plateau may span any number of chunks.
    """
    ax = axis(by, idx, width)
    runs = scan(df.select(*by, idx, x), ax, _before=previous(F.col(x)))
    starts = runs.where(F.col("_before").isNull() | (F.col("_before") != F.col(x)))
    around = scan(starts, ax, _after=following(F.col(x)), _until=following(F.col(idx)))
    top = (F.col(x) > F.col("_before")) & (F.col(x) > F.col("_after"))
    middle = F.floor((F.col(idx) + F.col("_until") - 1) / 2)
    return around.where(top).select(*by, middle.alias(idx), x)


def peaks_above(df: DataFrame, by: Sequence[str], idx: str, x: str, height: str, width: float = 100_000) -> DataFrame:
    """Rows of ``df`` that are peaks at least as high as their own ``height``."""
    found = peaks(df, by, idx, x, width).select(*by, idx)
    return join_back(df.where(F.col(x) >= F.col(height)), found, [*by, idx], "left_semi").select(df.columns)


# --- turning points -------------------------------------------------------------------------


def _collapse(lo: np.ndarray, hi: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Join neighbouring runs of equal value and keep both ends and the local extremes."""
    head = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
    tail = np.r_[head[1:] - 1, len(v) - 1]
    lo, hi, v = lo[head], hi[tail], v[head]
    if len(v) > 2:
        rise = np.sign(np.diff(v))
        keep = np.r_[True, rise[1:] != rise[:-1], True]
        lo, hi, v = lo[keep], hi[keep], v[keep]
    return lo, hi, v


def _reach(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each element the nearest higher one to its left (-1 for none) and the least value between them.

    One pass with a stack of falling values: what is popped is not higher, and its least value is
    handed on, so each element is looked at once.
    """
    higher, least = np.empty(len(v), np.int64), np.array(v, dtype=float)
    stack: list[int] = []
    for i in range(len(v)):
        low = v[i]
        while stack and v[stack[-1]] <= v[i]:
            low = min(low, least[stack.pop()])
        higher[i], least[i] = (stack[-1] if stack else -1), low
        stack.append(i)
    return higher, least


def _summits(lo: np.ndarray, hi: np.ndarray, w: np.ndarray, least: float) -> list[tuple]:
    """Runs of a block that can be peaks with a prominence of ``least``: run, height, the least value on each
    side up to a higher one, and whether that one is still to be found outside the block.

    Beyond the block a base can only get lower, so a base known on one side bounds the prominence, and
    decides it if it is not below the other one.
    """
    n = len(w)
    higher, left = _reach(w)
    further, right = (a[::-1] for a in _reach(w[::-1]))
    opens, closes = higher < 0, further < 0
    peak = np.r_[True, w[1:] > w[:-1]] & np.r_[w[:-1] > w[1:], True]
    bases = np.maximum(np.where(opens, -np.inf, left), np.where(closes, -np.inf, right))
    done = (bases >= np.where(opens, left, -np.inf)) & (bases >= np.where(closes, right, -np.inf))
    return [
        (int(lo[i]), int(hi[i]), float(w[i]), float(left[i]), float(right[i]), bool(opens[i] & ~done[i]), bool(closes[i] & ~done[i]), i == 0, i == n - 1)
        for i in np.flatnonzero(peak & (w - bases >= least))
    ]


def _levels(core: DataFrame, by: Sequence[str], idx: str, x: str, fan: int) -> list[DataFrame]:
    """A tree over the rows of each series: ``fan`` neighbours in one row, and so on up to one row a series.

    An item of a node has its place ``p`` among the items of its level, the ``top`` and ``bottom`` below it, and
    the first and last row.
    """
    rows = core.select(*by, F.col(idx).cast("bigint").alias("_p"), F.col(x).alias("_top"), F.col(x).alias("_bottom"))
    rows = rows.withColumns({"_first": F.struct(F.col("_p").alias("p"), F.col("_top").alias("v")), "_last": F.struct(F.col("_p").alias("p"), F.col("_top").alias("v"))})
    levels, most = [], core.agg(F.max(idx)).first()[0] or 0
    while not levels or most > 0:
        most //= fan
        item = F.struct(*[F.col(f"_{c}").alias(c) for c in ("p", "top", "bottom", "first", "last")])
        nodes = rows.groupBy(*by, F.floor(F.col("_p") / fan).alias("_node")).agg(
            F.collect_list(item).alias("_items"), F.max("_top").alias("_top"), F.min("_bottom").alias("_bottom"), F.min("_first").alias("_first"), F.max("_last").alias("_last")
        )
        levels.append(durable(nodes))
        rows = levels[-1].drop("_items").withColumnRenamed("_node", "_p")
    return levels


def _seek(asked: DataFrame, levels: list[DataFrame], by: Sequence[str], fan: int, hit: Callable[[Column, Column], Column]) -> DataFrame:
    """For each question the nearest row on ``side`` (-1 or 1) of ``pos`` that is a ``hit``.

    ``hit`` is told the signed top and bottom of an item. Values are signed by ``kind``. Columns added: ``hit_p`` and
    ``hit_v`` (NULL if there is none), ``least``, the least value passed, and ``edge``, the last row passed; the last two
    start from the columns of that name. A question climbs the tree until an item of its node is a hit, then goes down
    into that item: an equi-join a level with a bounded row, so no two questions have to meet.
    """
    side, kind = F.col("side"), F.col("kind")
    state = asked.withColumns({"_at": F.lit(None).cast("int"), "_place": F.col("pos").cast("bigint"), "hit_p": F.lit(None).cast("bigint"), "hit_v": F.lit(None).cast("double")})
    plan = [(n, True) for n in range(len(levels))] + [(n, False) for n in range(len(levels) - 2, -1, -1)]
    for level, up in plan:
        wanted = F.col("_at").isNull() if up else F.col("_at") == level + 1
        # Going down, all items of the node are on the way.
        start = F.col("_place") if up else F.when(side < 0, (F.col("hit_p") + 1) * fan).otherwise(F.col("hit_p") * fan - 1)
        node = F.floor(F.col("_place") / fan) if up else F.col("hit_p")
        # Questions with nothing to look up here get one of many keys that no node has, so they stay spread.
        idle = -1 - F.pmod(F.xxhash64("pos", "side"), F.lit(4096))
        keyed = state.withColumns({"_wanted": F.coalesce(wanted, F.lit(False)), "_start": start, "_node": F.when(wanted, node).otherwise(idle)})
        met = join_back(keyed, levels[level].select(*by, "_node", "_items"), [*by, "_node"], "left")
        ahead = F.filter("_items", lambda e: side * e.p > side * F.col("_start"))
        top = lambda e: F.when(kind > 0, e.top).otherwise(-e.bottom)
        bottom = lambda e: F.when(kind > 0, e.bottom).otherwise(-e.top)
        hits = F.filter("_ahead", lambda e: hit(top(e), bottom(e)))
        nearest = F.array_min(F.transform(hits, lambda e: F.struct((side * e.p).alias("k"), bottom(e).alias("v"))))
        met = met.withColumn("_ahead", ahead).withColumn("_hit", nearest)
        passed = F.filter("_ahead", lambda e: F.col("_hit").isNull() | (side * e.p < F.col("_hit.k")))
        met = met.withColumn("_passed", passed)
        row = lambda e: F.when(side < 0, e["first"]).otherwise(e["last"])
        edge = F.array_max(F.transform("_passed", lambda e: F.struct((side * e.p).alias("k"), row(e).p.alias("p"), (kind * row(e).v).alias("v"))))
        low = F.array_min(F.transform("_passed", bottom))
        found = F.col("_wanted") & F.col("_hit").isNotNull()
        state = met.withColumn("_edge", edge).withColumns(
            {
                "least": F.least("least", low),
                "edge": F.when(F.col("_edge").isNotNull(), F.struct(F.col("_edge.p").alias("p"), F.col("_edge.v").alias("v"))).otherwise(F.col("edge")),
                "hit_p": F.when(found, side * F.col("_hit.k")).otherwise(F.col("hit_p")),
                "hit_v": F.when(found, F.col("_hit.v")).otherwise(F.col("hit_v")),
                "_at": F.when(found, level).otherwise(F.col("_at")),
                "_place": F.floor(F.col("_place") / fan),
            }
        ).drop("_items", "_ahead", "_hit", "_passed", "_edge", "_node", "_start", "_wanted")
    return state.drop("_at", "_place")


def turning_points(
    df: DataFrame, by: Sequence[str], idx: str, x: str, prominence: float = 10.0, width: float = 30.0, size: int = 50_000, fan: int = 256
) -> DataFrame:
    """Prominent and wide maxima (``kind`` 1) and minima (-1) of each series.

    Width is measured in rows at half prominence, interpolated between rows. ``idx`` counts from 0 and may
    have gaps, ``prominence`` is above 0. A block finds its summits and most of their bases; what lies beyond
    it (a higher value, the crossing of the half height, the end of a plateau) is sought in a tree of extremes
    over the rows. At no point do the rows, extremes or summits of a series meet in one task.
    """
    by = list(by)
    key = [df.schema[c] for c in by]
    names = ["kind", "lo", "hi", "w", "left", "right", "l_open", "r_open", "l_touch", "r_touch"]
    kinds = [T.IntegerType(), *[T.LongType()] * 2, *[T.DoubleType()] * 3, *[T.BooleanType()] * 4]
    found = T.StructType([*key, T.StructField("_block", T.LongType()), *map(T.StructField, names, kinds)])

    def summits(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(idx, kind="stable")
        at, v = block[idx].to_numpy(), block[x].to_numpy(dtype=float)
        lo, hi, v = _collapse(at, at, v)
        rows = [(kind, *row) for kind in (1, -1) for row in _summits(lo, hi, kind * v, prominence)]
        out = pd.DataFrame(rows, columns=names)
        for c in (*by, "_block"):
            out[c] = block[c].iloc[0]
        return out[found.fieldNames()]

    core = df.select(*by, idx, F.col(x).cast("double").alias(x)).where(F.col(x).isNotNull())
    core = core if leaves(core) < 2 else durable(core)
    levels = _levels(core, by, idx, x, fan)
    blocks = core.withColumn("_block", F.floor(F.col(idx) / F.lit(size))).groupBy(*by, "_block")
    own = [*by, "kind", "lo", "hi"]
    seen = durable(blocks.applyInPandas(summits, found))

    def ask(rows: DataFrame, side: int, pos: Column, goal: Column, strict: bool) -> DataFrame:
        start = F.struct(F.col("lo" if side < 0 else "hi").alias("p"), F.col("w").alias("v"))
        least = F.col("left" if side < 0 else "right")
        return rows.select(*own, F.lit(side).alias("side"), pos.alias("pos"), goal.alias("goal"), F.lit(strict).alias("strict"), least.alias("least"), start.alias("edge"))

    # Bases beyond the block, up to a higher row.
    beyond = ask(seen.where("l_open"), -1, F.col("_block") * size, F.col("w"), True).union(
        ask(seen.where("r_open"), 1, (F.col("_block") + 1) * size - 1, F.col("w"), True)
    )
    bases = _seek(beyond, levels, by, fan, lambda top, _: top > F.col("goal")).groupBy(*own).agg(
        F.max(F.when(F.col("side") < 0, F.col("least"))).alias("_left"), F.max(F.when(F.col("side") > 0, F.col("least"))).alias("_right")
    )
    height = F.col("w") - F.greatest(F.coalesce("_left", "left"), F.coalesce("_right", "right"))
    tall = join_back(seen, bases, own, "left").withColumn("prominence", height)
    tall = durable(tall.where((F.col("prominence") >= prominence) & (F.col("prominence") > 0)).drop("_left", "_right"))

    # Crossings of the half height, and the ends of plateaus that reach a block's border.
    level = F.col("w") - 0.5 * F.col("prominence")
    outward = [ask(tall, -1, F.col("lo"), level, False), ask(tall, 1, F.col("hi"), level, False)]
    outward += [ask(tall.where("l_touch"), -1, F.col("lo"), F.col("w"), True), ask(tall.where("r_touch"), 1, F.col("hi"), F.col("w"), True)]
    below = lambda _, bottom: F.when(F.col("strict"), bottom < F.col("goal")).otherwise(bottom <= F.col("goal"))
    met = _seek(reduce(DataFrame.union, outward), levels, by, fan, below)
    share = (F.col("goal") - F.col("hit_v")) / F.nullif(F.col("edge.v") - F.col("hit_v"), F.lit(0.0))
    spot = F.col("hit_p") + (F.col("edge.p") - F.col("hit_p")) * F.coalesce(share, F.lit(0.0))
    pick = lambda side, strict, value: F.max(F.when((F.col("side") == side) & (F.col("strict") == strict), value))
    sides = met.groupBy(*own).agg(
        (pick(1, False, spot) - pick(-1, False, spot)).alias("width"), pick(-1, True, F.col("edge.p")).alias("_lo"), pick(1, True, F.col("edge.p")).alias("_hi")
    )
    whole = join_back(tall, sides, own).where(F.col("width") >= width)
    middle = F.floor((F.coalesce("_lo", "lo") + F.coalesce("_hi", "hi")) / 2).alias(idx)
    # The parts of a plateau that several blocks hold are one turning point.
    return whole.groupBy(*by, middle, "kind").agg(
        F.first(F.col("kind") * F.col("w")).alias(x), F.first("prominence").alias("prominence"), F.max("width").alias("width")
    )


def profile_number(
    df: DataFrame, by: Sequence[str], idx: str, depth: str, min_change: float = 10.0, prominence: float = 10.0, width: float = 30.0, size: int = 50_000
) -> DataFrame:
    """Number the dives: a turning point starts a new one when the depth changes by more than
    ``min_change`` metres up to the next turning point."""
    by = list(by)
    df = df if leaves(df) < 2 else durable(df)
    turns = turning_points(df, by, idx, depth, prominence, width, size).select(*by, idx, F.col(depth).alias("_d"))
    ends = df.groupBy(*by).agg(F.max(idx).alias(idx), F.max_by(depth, idx).alias("_d"))
    ordered = Window.partitionBy(*by).orderBy(idx)
    steps = turns.union(ends).withColumn("_flag", (F.abs(F.lead("_d").over(ordered) - F.col("_d")) > min_change).cast("int"))
    marks = steps.where("_flag = 1").select(*by, idx, F.lit(1).alias("_side"), F.lit(1).alias("_step"))
    line = df.withColumns({"_side": F.lit(0), "_step": F.lit(0)}).unionByName(marks, allowMissingColumns=True)
    counted = scan(line, axis(by, [idx, "_side"], size), _n=running("sum", F.col("_step")))
    return counted.where("_side = 0").withColumn("profile_number", (F.col("_n") + 1).cast("int")).select(*df.columns, "profile_number")


def cumulative_profile(df: DataFrame, by: Sequence[str], order: Sequence[str], profile: str, width: float = HOUR) -> DataFrame:
    """Profile numbers that go on counting over concatenated logs."""
    ax = axis(by, order, width)
    stepped = scan(df, ax, _before=previous(F.col(profile)))
    drop = F.when(F.col(profile) < F.col("_before"), F.col("_before")).otherwise(F.lit(0))
    counted = scan(stepped.withColumn("_drop", drop), ax, _offset=running("sum", F.col("_drop")))
    return counted.withColumn("cumulative", F.col(profile) + F.col("_offset")).select(*df.columns, "cumulative")


# --- sun and night --------------------------------------------------------------------------


def sun_events(df: DataFrame, by: Sequence[str], us: str, lat: str, lon: str, stride: int = 3000, width: float = HOUR) -> DataFrame:
    """Sunset and sunrise: the sampled rows after which the sign of the sun's altitude changes.

    The altitude is taken at the median position of the mission, every ``stride`` rows.
    """
    ax = axis(by, us, width)
    place = join_back(quantiles(df, by, lat, {"_lat": 0.5}), quantiles(df, by, lon, {"_lon": 0.5}), by)
    sampled = row_index(df.select(*by, us), ax, "_pos").where(F.col("_pos") % stride == 0)
    lit = join_back(sampled, place, by).withColumn("altitude", sun_altitude(F.col("_lat"), F.col("_lon"), F.col(us)))
    near = scan(lit.select(*by, us, "altitude"), axis(by, us, width * 24), _next=following(F.col("altitude")))
    return near.select(
        *by, us, "altitude", (F.signum("altitude") != F.signum("_next")).alias("changes"), ((F.col("altitude") > 0) & (F.col("_next") < 0)).alias("is_sunset")
    )


def night_windows(sun: DataFrame, spans: DataFrame, by: Sequence[str], us: str, margin_us: int = HOUR) -> DataFrame:
    """Nights as intervals from an hour after sunset to an hour before sunrise.

    A mission that starts at night has a window from its start, closed there. One that ends at
    night has a window to its end only when its events are odd in number, as sunset and sunrise
    are paired from the first sunset on. A mission without events is one window if all dark.
    ``spans`` has ``start`` and ``end`` of each mission.
    """
    by = list(by)
    events = sun.where("changes").withColumnRenamed(us, "at")
    w = Window.partitionBy(*by).orderBy("at")
    nth = events.select(
        *by,
        "at",
        "is_sunset",
        (F.row_number().over(w) - 1).alias("k"),
        F.count(F.lit(1)).over(Window.partitionBy(*by)).alias("n"),
        F.lead("at").over(w).alias("next_at"),
        F.first("is_sunset").over(w).alias("first_set"),
    )
    nth = join_back(nth, spans, by)
    lead_in = (F.col("k") == 0) & ~F.col("first_set")
    shift = F.when(F.col("first_set"), 0).otherwise(1)
    pair = (F.col("k") >= shift) & ((F.col("k") - shift) % 2 == 0) & F.col("next_at").isNotNull()
    lead_out = (F.col("k") == F.col("n") - 1) & (F.col("n") % 2 == 1) & F.col("is_sunset")
    after, before = F.col("at") + margin_us, F.col("at") - margin_us
    windows = nth.select(
        *by,
        F.when(lead_in, F.col("start")).when(pair | lead_out, after).alias("night_start"),
        F.when(lead_in, before).when(pair, F.col("next_at") - margin_us).when(lead_out, F.col("end")).alias("night_end"),
        lead_in.alias("start_closed"),
        (lead_out & ~pair).alias("end_closed"),
    ).where(F.col("night_start").isNotNull())
    dark = sun.groupBy(*by).agg(F.bool_and(F.col("altitude") < 0).alias("_dark"), F.count_if("changes").alias("_n"))
    whole = join_back(dark.where("_dark AND _n = 0"), spans, by).select(
        *by, F.col("start").alias("night_start"), F.col("end").alias("night_end"), F.lit(True).alias("start_closed"), F.lit(True).alias("end_closed")
    )
    return windows.union(whole)


def select_nights(df: DataFrame, windows: DataFrame, by: Sequence[str], us: str, width: float = HOUR) -> DataFrame:
    """Rows inside a night window; the window of a row is the last one started before it."""
    starts = windows.select(
        *by,
        F.col("night_start").alias(us),
        F.struct("night_end", "end_closed", "start_closed", "night_start").alias("_w"),
    )
    line = df.withColumn("_row", F.lit(True)).unionByName(starts, allowMissingColumns=True)
    seen = scan(line, axis(by, us, width), _in=latest(F.col("_w"), peers=True)).where("_row")
    t = F.col(us)
    opened = (t > F.col("_in.night_start")) | (F.col("_in.start_closed") & (t == F.col("_in.night_start")))
    closed = (t < F.col("_in.night_end")) | (F.col("_in.end_closed") & (t == F.col("_in.night_end")))
    return seen.where(opened & closed).select(*df.columns)


def night_spans(df: DataFrame, by: Sequence[str], us: str, altitude: str, km: str, width: float = HOUR) -> DataFrame:
    """Track sections with the sun below the horizon, first and last kilometre of each."""
    ax = axis(by, us, width)
    dark = (F.col(altitude) < 0).cast("int")
    stepped = scan(df.withColumn("_dark", dark), ax, _before=previous(F.col("_dark")))
    new = F.when(F.col("_dark") != F.coalesce("_before", 1 - F.col("_dark")), 1).otherwise(0)
    grouped = scan(stepped.withColumn("_new", new), ax, _span=running("sum", F.col("_new")))
    return grouped.where("_dark = 1").groupBy(*by, "_span").agg(
        F.min(us).alias("start"), F.min_by(km, us).alias("start_km"), F.max_by(km, us).alias("end_km")
    ).drop("_span")


# --- background and flashes -----------------------------------------------------------------


def background_envelope(
    df: DataFrame, by: Sequence[str], idx: str, x: str, window: int = 300, least: float = ENVELOPE_MIN, size: int = 50_000, trailing: bool = False
) -> DataFrame:
    """Lower, middle and upper background level: smoothed rolling minimum and median.

    Windows are centred, or end at their row with ``trailing``. Two stacked windows need a halo of
    twice their reach; both run in one pass.
    """
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, T.DoubleType()) for n in ("min_bg", "med_bg", "max_bg"))])

    def levels(block: pd.DataFrame) -> pd.DataFrame:
        roll = block[x].rolling(window, min_periods=1, center=not trailing)
        low, mid = (s.rolling(window, min_periods=1, center=not trailing).mean() for s in (roll.min(), roll.median()))
        block["min_bg"], block["med_bg"] = low, mid
        block["max_bg"] = np.maximum(2 * mid - low, mid + least)
        return block

    before, after = (2 * window, 0) if trailing else (window, window)
    return map_blocks(df, by, idx, before, after, levels, schema, size)


def flash_counts(
    env: DataFrame, by: Sequence[str], idx: str, x: str, threshold: float = FLASH_THRESHOLD, window: int = 900, size: int = 100_000
) -> DataFrame:
    """Peaks above the envelope, counted in a centred window around every row, bright and dim apart."""
    top = peaks_above(env, by, idx, x, "max_bg", size).select(
        *by, idx, F.when(F.col(x) > F.col("med_bg") + threshold, 1).alias("_high"), F.when(F.col(x) <= F.col("med_bg") + threshold, 1).alias("_low")
    )
    marked = join_back(env.select(*by, idx, "us"), top, [*by, idx], "left")
    high = rolling(marked, by, idx, "_high", "count", window, "high", size)
    return rolling(high, by, idx, "_low", "count", window, "low", size).drop("_high", "_low")


def flash_rates(counts: DataFrame, flow: DataFrame, by: Sequence[str], seconds: int = 15, per_litre: float = 1000.0, grid: float = 1.0) -> DataFrame:
    """Flashes per litre on the one-second grid: mean count, per second, per flow (mL/s)."""
    means = resample_mean(counts, by, "us", ["high", "low"], grid, centred=False)
    both = join_back(means, flow, [*by, "us"], "left")
    rate = {f"nbflash_{c}": F.col(c) / seconds / F.col("flow") * per_litre for c in ("high", "low")}
    return both.withColumns(rate).drop("high", "low", "flow")


def flash_intensity(
    env: DataFrame, by: Sequence[str], idx: str, x: str, window: int = 900, size: int = 100_000, grid: float = 1.0
) -> DataFrame:
    """Rolling maximum above the middle background, mean per second."""
    above = env.withColumn("_above", F.col(x) - F.col("med_bg"))
    rolled = rolling(above.select(*by, idx, "us", "_above"), by, idx, "_above", "max", window, "intflash", size)
    return resample_mean(rolled, by, "us", ["intflash"], grid, centred=False)


# --- low-pass filter ------------------------------------------------------------------------


def butterworth(order: int, cutoff: float) -> tuple[np.ndarray, np.ndarray]:
    """Digital low-pass coefficients; ``cutoff`` as a fraction of the Nyquist frequency."""
    warped = 4 * math.tan(math.pi * cutoff / 2)
    k = np.arange(order)
    poles = warped * np.exp(1j * math.pi * (2 * k + order + 1) / (2 * order))
    a = np.real(np.poly((4 + poles) / (4 - poles)))
    b = np.real(np.poly(-np.ones(order)))
    return b * (a.sum() / b.sum()), a


def sections(order: int, cutoff: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """The same filter as a chain of second-order sections (the last of first order if the order is odd).

    Each has a gain of 1 at rest. The chain stays exact at low cutoffs, where the coefficients of the
    whole polynomial lose their digits.
    """
    warped = 4 * math.tan(math.pi * cutoff / 2)
    out = []
    for k in range((order + 1) // 2):
        pole = warped * np.exp(1j * math.pi * (2 * k + order + 1) / (2 * order))
        z = (4 + pole) / (4 - pole)
        single = order % 2 and k == order // 2
        a = np.array([1.0, -z.real]) if single else np.array([1.0, -2 * z.real, abs(z) ** 2])
        b = np.array([1.0, 1.0]) if single else np.array([1.0, 2.0, 1.0])
        out.append((b * (a.sum() / b.sum()), a))
    return out


def impulse_response(chain: list[tuple[np.ndarray, np.ndarray]], taps: int) -> np.ndarray:
    """First ``taps`` outputs of the chain for a unit impulse."""
    signal = [1.0] + [0.0] * (taps - 1)
    for b, a in chain:
        b, a = np.r_[b, [0.0] * (3 - len(b))].tolist(), np.r_[a, [0.0] * (3 - len(a))].tolist()
        x1 = x2 = y1 = y2 = 0.0
        out = []
        for x in signal:
            y = b[0] * x + b[1] * x1 + b[2] * x2 - a[1] * y1 - a[2] * y2
            out.append(y)
            x1, x2, y1, y2 = x, x1, y, y1
        signal = out
    return np.array(signal)


def fading_response(order: int, cutoff: float, tolerance: float, most: int = 1_000_000) -> np.ndarray:
    """Impulse response up to where the rest of it sums to less than ``tolerance``.

    The largest pole tells how fast it fades and so where to look first; a response that is still
    above the tolerance after ``most`` rows is refused.
    """
    chain = sections(order, cutoff)
    radius = max(math.sqrt(a[2]) if len(a) > 2 else abs(a[1]) for _, a in chain)
    if not radius < 1:
        raise ValueError("the filter does not fade")
    taps = 64 + int(math.log(tolerance) / math.log(radius))
    while taps <= most:
        h = impulse_response(chain, taps)
        if np.abs(h[-(taps // 8) :]).sum() < tolerance * (1 - radius ** (taps // 8)):
            return h
        taps *= 2
    raise ValueError(f"the response is above {tolerance} after {most} rows; raise the cutoff or the tolerance")


def lowpass(
    df: DataFrame, by: Sequence[str], idx: str, x: str, out: str, cutoff_hz: float = 1.0, rate_hz: float = 10.0, order: int = 8, size: int = 50_000, tolerance: float = 1e-12
) -> DataFrame:
    """Zero-phase low-pass: Butterworth forward and backward, ends extended by odd reflection.

    The response is cut where what is left of it is below ``tolerance``, so a halo of that length makes
    the blocks of a long series agree with one pass over all of it. Series too short for the
    reflection are NULL.
    """
    h = fading_response(order, cutoff_hz / (rate_hz / 2), tolerance)
    taps = len(h)
    pad = 3 * (order + 1)
    total = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())])

    def smooth(block: pd.DataFrame) -> pd.DataFrame:
        v, at, n = block[x].to_numpy(dtype=float), block[idx].to_numpy(), int(block["_n"].iloc[0])
        if n <= pad:
            block[out] = None
            return block
        head = 2 * v[0] - v[pad:0:-1] if at[0] == 0 else v[:0]
        tail = 2 * v[-1] - v[-2 : -pad - 2 : -1] if at[-1] == n - 1 else v[:0]
        line = np.r_[head, v, tail]
        # Before the first value and after the last the signal rests at that value.
        forward = np.convolve(np.r_[np.full(taps, line[0]), line], h)[taps : taps + len(line)]
        backward = np.convolve(np.r_[np.full(taps, forward[-1]), forward[::-1]], h)[taps : taps + len(line)][::-1]
        block[out] = backward[len(head) : len(head) + len(v)]
        return block

    return map_blocks(join_back(df, total, by), by, idx, 2 * taps, 2 * taps, smooth, schema, size)


def fill_coefficient(df: DataFrame, by: Sequence[str], despiked: str, default: float = 14_700_000.0) -> DataFrame:
    """NULL coefficients become the mean of the despiked series, or the default if it is empty."""
    mean = df.groupBy(*by).agg(F.avg(despiked).alias("_mean"))
    return join_back(df, mean, by).withColumn(despiked, F.coalesce(despiked, "_mean", F.lit(default))).drop("_mean")

