"""Tracks and vertical sections: distance, bottoms, gridded fields, rates, simplified lines."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.geo import utm_forward, utm_zone
from tidemark.operators.ordered import CHUNK, HOUR, axis, fit_width, fits, following, join_back, latest, previous, quantiles, running, scan, upcoming
from tidemark.operators.resample import gradient
from tidemark.operators.stats import ols
from tidemark.operators.timejoin import interp_join, lerp
from tidemark.session import durable


#: Rows that one row is exploded into at once.
STEP = 1_000


def count_up(df: DataFrame, n: Column, name: str, step: int = STEP) -> DataFrame:
    """Each row ``n`` times, numbered from 0; in two steps, so that a large ``n`` makes no huge array."""
    sized = df.withColumn("_n", n.cast("bigint")).where("_n > 0")
    blocks = sized.withColumn("_b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / step))))
    inside = F.sequence(F.col("_b") * step, F.least((F.col("_b") + 1) * step, F.col("_n")) - 1)
    return blocks.withColumn(name, F.explode(inside)).drop("_n", "_b")


def fill_by_position(df: DataFrame, by: Sequence[str], idx: str, cols: Sequence[str], size: float = 100_000) -> DataFrame:
    """Linear fill over the row position, ends held."""
    steps = {}
    for c in cols:
        spot = F.when(F.col(c).isNotNull(), F.col(idx))
        steps |= {f"_v0_{c}": latest(F.col(c)), f"_v1_{c}": upcoming(F.col(c)), f"_i0_{c}": latest(spot), f"_i1_{c}": upcoming(spot)}
    near = scan(df, axis(by, idx, size), **steps)
    out = {}
    for c in cols:
        v0, v1, i0, i1 = (F.col(f"_{n}_{c}") for n in ("v0", "v1", "i0", "i1"))
        line = v0 + (v1 - v0) * ((F.col(idx) - i0) / F.nullif(i1 - i0, F.lit(0)))
        out[c] = F.coalesce(F.col(c), line, v0, v1)
    return near.withColumns(out).select(df.columns)


def track_distance(
    df: DataFrame, by: Sequence[str], idx: str, us: str, lat: str, lon: str, long_track: int = 400, every: int = 200, size: float = 100_000
) -> DataFrame:
    """Metres along the track, ``distance``.

    Tracks of more than 400 rows are smoothed first: every 200th position, interpolated in time.
    Positions are projected to the UTM zone of the mean longitude.
    """
    by = list(by)
    filled = fill_by_position(df, by, idx, [lat, lon], size)
    info = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), utm_zone(F.avg(lon)).alias("_zone"))
    step = F.when(F.col("_n") > long_track, every).otherwise(1)
    known = durable(join_back(filled, info, by))
    knots = known.where(F.col(idx) % step == 0).select(*by, us, F.col(lat).alias("_lat"), F.col(lon).alias("_lon"))
    smooth = interp_join(known, knots, by, us, ["_lat", "_lon"], width=24 * HOUR)
    east, north = utm_forward(F.col("_lat"), F.col("_lon"), F.col("_zone"))
    placed = durable(smooth.withColumns({"_e": east, "_m": north}).drop("_lat", "_lon", "_n", "_zone"))
    ax = axis(by, idx, size)
    stepped = scan(placed, ax, _pe=previous(F.col("_e")), _pm=previous(F.col("_m")))
    leg = F.coalesce(F.hypot(F.col("_e") - F.col("_pe"), F.col("_m") - F.col("_pm")), F.lit(0.0))
    summed = scan(stepped.withColumn("_leg", leg), ax, distance=running("sum", F.col("_leg")))
    return summed.select(*df.columns, "distance")


def profile_bottom(df: DataFrame, by: Sequence[str], idx: str, depth: str, fraction: float = 0.01, out: str = "bottom", size: float = 100_000) -> DataFrame:
    """Trailing maximum depth over one percent of the rows, NULL until the window is full.

    The window differs by series and may be long, so each window is put together from two parts:
    from its first row to the end of a window-sized block, and from there to its last row.
    """
    by = list(by)
    span = F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) * fraction)).alias("_w")
    blocks = join_back(df.select(*by, idx, depth), df.groupBy(*by).agg(span), by).withColumn("_block", F.floor(F.col(idx) / F.col("_w")))
    ax = axis([*by, "_block"], idx, size)
    parts = scan(blocks, ax, _head=running("max", F.col(depth)), _tail=running("max", F.col(depth), forward=False))
    tails = parts.select(*by, (F.col(idx) + F.col("_w") - 1).alias(idx), "_tail")
    whole = join_back(parts.drop("_tail"), tails, [*by, idx], "left").select(*by, idx, F.when(F.col("_tail").isNotNull(), F.greatest("_head", "_tail")).alias(out))
    return join_back(df, whole, [*by, idx], "left")


def midnights(track: DataFrame, by: Sequence[str], us: str, lon: str, km: str, width: float = 24 * HOUR) -> DataFrame:
    """Distance at every local midnight; the local zone follows the median longitude."""
    by = list(by)
    day = 24 * HOUR
    offset = quantiles(track, by, lon, {"_lon": 0.5}).select(*by, (F.round(F.col("_lon") / 15) * HOUR).cast("bigint").alias("_off"))
    span = track.groupBy(*by).agg(F.min(us).alias("_a"), F.max(us).alias("_b"))
    span = join_back(span, offset, by)
    first, last = F.floor((F.col("_a") + F.col("_off")) / day), F.floor((F.col("_b") + F.col("_off")) / day)
    days = span.select(*by, "_a", "_b", "_off", F.explode(F.sequence(first, last)).alias("_d"))
    marks = days.withColumn(us, F.col("_d") * day - F.col("_off")).where(F.col(us).between(F.col("_a"), F.col("_b")))
    return interp_join(marks.select(*by, us), track.select(*by, us, km), by, us, [km], width=width)


def log_ranges(track: DataFrame, logs: DataFrame, by: Sequence[str], us: str, km: str, width: int = 24 * HOUR) -> DataFrame:
    """First and last kilometre inside ``[start, end)`` of each log; one log per label.

    Both ends are looked up along the track, so a row is not copied to the logs it lies in, which
    may overlap. Of rows at one time the first counts the smallest kilometre and the last the largest.
    """
    by = list(by)
    unique = logs.groupBy(*by, "label").agg(F.min_by(F.struct("start", "end"), "position").alias("_l")).select(*by, "label", "_l.*")
    whole = unique.where(F.col("start").isNotNull() & F.col("end").isNotNull())
    marks = whole.select(*by, "label", F.explode(F.array(F.struct(F.col("start").alias("t"), F.lit(True).alias("s")), F.struct(F.col("end").alias("t"), F.lit(False).alias("s")))).alias("_m"))
    marks = marks.select(*by, F.col("_m.t").alias(us), F.lit(0).alias("_side"), "label", F.col("_m.s").alias("_starts"), F.lit(True).alias("_mark"))
    rows = track.where(F.col(us).isNotNull()).select(*by, us, F.lit(1).alias("_side"), km, F.struct(F.col(us).alias("t"), F.col(km).alias("km")).alias("_row"))
    # A mark stands before the rows of its time: a row at the start is inside, one at the end is not.
    line = rows.unionByName(marks, allowMissingColumns=True)
    seen = scan(line, axis(by, [us, "_side", km], width), _first=upcoming(F.col("_row")), _last=latest(F.col("_row"))).where("_mark")
    ends = seen.groupBy(*by, "label").agg(
        F.max(F.when(F.col("_starts"), F.col("_first"))).alias("_a"), F.max(F.when(~F.col("_starts"), F.col("_last"))).alias("_b"), F.max(F.when(~F.col("_starts"), F.col(us))).alias("_end")
    )
    return ends.where(F.col("_a.t") < F.col("_end")).select(*by, "label", F.col("_a.km").alias("start_km"), F.col("_b.km").alias("end_km"))


def rate_per_km(track: DataFrame, by: Sequence[str], us: str, km: str, used: str, size: float = 1_000) -> DataFrame:
    """Use per kilometre: mean and last gradient on a grid of whole kilometres from the start."""
    by = list(by)
    curve = track.groupBy(*by, km).agg(F.max_by(used, us).alias(used)).dropna(subset=[km, used])
    ends = track.groupBy(*by).agg(F.min(km).alias("_a"), F.max(km).alias("_b"))
    grid = count_up(ends.withColumnRenamed("_b", "_end"), F.ceil(F.col("_end") - F.col("_a")), "k")
    at = interp_join(grid.select(*by, "k", (F.col("_a") + F.col("k")).alias(km)), curve, by, km, [used], width=size)
    rates = gradient(durable(at), axis(by, "k", size), used, "_rate")
    return rates.where(F.col("_rate").isNotNull()).groupBy(*by).agg(F.avg("_rate").alias("mean_rate"), F.max_by("_rate", "k").alias("last_rate"))


def grid_section(
    df: DataFrame, by: Sequence[str], x: str, depth: str, profile: str, value: str, step: float = 0.5, size: float = 10_000
) -> DataFrame:
    """Mean of a variable on a grid of distance and depth, filled linearly along depth.

    Three columns per profile between the ends of the track; depths every half metre down to the
    deepest value, rounded down to ten metres (at least ten). Cells outside the sampled depths of
    their column stay empty.
    """
    by = list(by)
    have = F.col(value).isNotNull()
    shape = df.groupBy(*by).agg(
        F.min(x).alias("_x0"),
        F.max(x).alias("_x1"),
        F.greatest(F.lit(2), 3 * F.max(profile)).alias("_nx"),
        F.greatest(F.lit(10.0), F.floor(F.coalesce(F.max(F.when(have, F.col(depth))), F.max(depth)) / 10) * 10.0).alias("_bottom"),
    )
    dx = (F.col("_x1") - F.col("_x0")) / (F.col("_nx") - 1)
    xi = F.floor((F.col(x) - F.col("_x0")) / F.nullif(dx, F.lit(0.0)) + 0.5)
    placed = join_back(df.where(have), shape, by).select(
        *by, value, F.coalesce(xi, F.lit(0)).alias("xi"), F.floor(F.col(depth) / step + 0.5).alias("zi"), "_bottom"
    )
    cells = durable(placed.groupBy(*by, "xi", "zi").agg(F.avg(value).alias(value), F.max("_bottom").alias("_bottom")))
    # A cell yields the grid rows from its own depth to the next cell's, so the grid itself is never shuffled. A mark
    # without a value above all cells of its column yields the rows down to the first.
    tops = cells.groupBy(*by, "xi").agg((F.least(F.min("zi"), F.lit(0)) - 1).alias("zi"), F.max("_bottom").alias("_bottom"))
    known = cells.where(F.col("zi").isNotNull()).unionByName(tops, allowMissingColumns=True)
    near = scan(known, axis([*by, "xi"], "zi", size), _next=following(F.struct("zi", value)))
    own, end = F.greatest(F.col("zi"), F.lit(0)), F.floor(F.col("_bottom") / step) + 1
    pieces = near.withColumn("_own", own)
    grid = count_up(pieces, F.least(F.coalesce(F.col("_next.zi"), end), end) - F.col("_own"), "_k").withColumn("_z", F.col("_own") + F.col("_k"))
    inside = lerp(F.col(value), F.col(f"_next.{value}"), F.col("_z") - F.col("zi"), F.col("_next.zi") - F.col("zi"))
    filled = F.when(F.col("_z") == F.col("zi"), F.col(value)).otherwise(inside)
    return grid.select(*by, "xi", F.col("_z").alias("zi"), filled.alias(value)).withColumn("depth", F.col("zi") * step)


def cross_calibrate(a: DataFrame, b: DataFrame, cell: Sequence[str], by: Sequence[str], x: str, y: str, log: bool = False) -> DataFrame:
    """Regress one platform's gridded field on another's, cell by cell."""
    pairs = a.select(*cell, F.col(x).alias("_x")).join(b.select(*cell, F.col(y).alias("_y")), list(cell))
    if log:
        pairs = pairs.withColumns({c: F.when(F.col(c) > 0, F.log10(c)) for c in ("_x", "_y")})
    return ols(pairs, by, "_x", "_y")


def _gaps(x: np.ndarray, y: np.ndarray, ax: float, ay: float, bx: float, by: float) -> tuple[np.ndarray, np.ndarray]:
    """How far points lie ahead of the start of a chord, and their distance; points behind it have none."""
    length = np.hypot(bx - ax, by - ay)
    ux, uy = ((bx - ax) / length, (by - ay) / length) if length else (0.0, 0.0)
    ahead = (x - ax) * ux + (y - ay) * uy
    back = (x - bx) * -ux + (y - by) * -uy
    far2 = (x - bx) ** 2 + (y - by) ** 2
    gap = np.where(back < 0, np.sqrt(far2), np.sqrt(np.abs(far2 - back * back)))
    return ahead, np.where(ahead >= 0, gap, 0.0)


def _split_points(x: np.ndarray, y: np.ndarray, tolerance: float) -> np.ndarray:
    """Positions kept between and including the ends of one piece of a line."""
    keep, todo = {0, len(x) - 1}, [(0, len(x) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        gap = _gaps(x[a + 1 : b], y[a + 1 : b], x[a], y[a], x[b], y[b])[1]
        if gap.max() > tolerance:
            split = a + 1 + int(gap.argmax())
            keep.add(split)
            todo += [(a, split), (split, b)]
    return np.array(sorted(keep))


def _outer(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether a point is on the convex hull of all, or so near that rounding could tell it farther from a chord.

    Points strictly inside go, pass by pass; any that stay too long do no harm.
    """
    finite = np.flatnonzero(np.isfinite(x) & np.isfinite(y))
    out = np.zeros(len(x), bool)
    if not len(finite):
        return out
    order = finite[np.lexsort((y[finite], x[finite]))]
    slack = 1e-9 * max(1.0, np.abs(y[order]).max())
    out[order[(x[order] == x[order[0]]) | (x[order] == x[order[-1]])]] = True
    for up in (1.0, -1.0):
        left = order
        for _ in range(64):
            px, py = x[left], up * y[left]
            wide = px[2:] - px[:-2]
            inside = wide * (py[1:-1] - py[:-2]) - (py[2:] - py[:-2]) * (px[1:-1] - px[:-2]) < -slack * wide
            if not inside.any():
                break
            left = left[np.r_[True, ~inside, True]]
        out[left] = True
    return out


#: Fragments of a piece that are loaded along with the one to be split.
AHEAD = 16
#: What became of a row of a long piece: in a short piece, waiting, in a fragment to load, kept.
_SHORT, _WAIT, _LOAD, _KEPT = range(4)


def _advance(i, x, y, w, blk, whole, a, b, tolerance: float, size: int) -> list[tuple]:
    """Split a long piece as far as its rows can tell: ``state, start, end, positions`` of what it is cut into.

    ``w`` adds up to the rows that a fragment stands for. A fragment of outer rows alone has its farthest row
    if it is wholly ahead of the start of the chord; it is loaded if it isn't, or if it is to be split, along
    with some that may be split next.
    """
    out, todo = [], [(0, len(i), a, b)]
    while todo:
        lo, hi, a, b = todo.pop()
        if lo == hi:
            continue
        at = np.arange(lo, hi)
        if w[lo:hi].sum() <= size:
            out.append((_SHORT, a, b, at))
            continue
        ahead, gap = _gaps(x[lo:hi], y[lo:hi], a[1], a[2], b[1], b[2])
        starts = np.flatnonzero(np.r_[True, blk[lo + 1 : hi] != blk[lo : hi - 1]])
        margin = 1e-6 * max(1.0, np.hypot(b[1] - a[1], b[2] - a[2]))
        cut = (np.fmin.reduceat(ahead, starts) < margin) & (np.fmax.reduceat(ahead, starts) >= -margin)
        split = lo + int(gap.argmax())
        load = cut & ~whole[lo:hi][starts]
        if not load.any():
            if not gap.max() > tolerance:
                continue
            if whole[split]:
                p = (i[split], x[split], y[split])
                out.append((_KEPT, a, b, at[split - lo : split - lo + 1]))
                todo.append((lo, lo + int(np.searchsorted(i[lo:hi], p[0], "left")), a, p))
                todo.append((lo + int(np.searchsorted(i[lo:hi], p[0], "right")), hi, p, b))
                continue
            # Later splits often fall near this one or where the distance is almost as large.
            high = np.maximum.reduceat(gap, starts)
            near = np.abs(np.arange(len(starts)) - np.searchsorted(starts, split - lo, "right") + 1) <= 2
            load = ~whole[lo:hi][starts] & (near | (high >= np.sort(high)[-AHEAD:][0]))
        wanted = np.repeat(load, np.diff(np.r_[starts, hi - lo]))
        out += [(_LOAD, a, b, at[wanted]), (_WAIT, a, b, at[~wanted])]
    return out


def simplify(df: DataFrame, by: Sequence[str], idx: str, x: str, y: str, tolerance: float, size: int = 50_000) -> DataFrame:
    """Douglas-Peucker: the rows of each track that keep it within ``tolerance``.

    The farthest row from a chord is on the convex hull of its rows. So pieces longer than ``size`` rows are
    split by the outer rows of their blocks, one task a piece; a block is loaded whole where a split falls into
    it. A round goes on until a piece needs a block. Shorter pieces are finished in one task each.
    """
    by = list(by)
    key = [df.schema[c] for c in by]
    rows = durable(df.select(*by, idx, x, y))
    point = F.struct(F.col(idx).alias("i"), F.col(x).alias("x"), F.col(y).alias("y"))
    ends = durable(rows.groupBy(*by).agg(F.min_by(point, idx).alias("a"), F.max_by(point, idx).alias("b"), F.count(F.lit(1)).alias("n")))
    kept = ends.select(*by, F.explode(F.array("a", "b")).alias("p")).select(*by, "p.i", "p.x", "p.y")
    span = [f"_{e}{f}" for e in "ab" for f in "ixy"]
    spans = ends.select(*by, "n", *[F.col(f"{e}.{f}").alias(f"_{e}{f}") for e in "ab" for f in "ixy"])
    inner = (F.col(idx) > F.col("_ai")) & (F.col(idx) < F.col("_bi"))
    short = join_back(rows, spans.where(F.col("n") - 2 <= size).drop("n"), by).where(inner)
    long = spans.where(F.col("n") - 2 > size).drop("n")
    widest = long.agg(F.max(F.col("_bi") - F.col("_ai"))).first()[0]
    if widest is not None:
        block = max(8, size // 25)
        cut = fit_width(join_back(rows, long, by, "left_semi"), axis(by, idx, widest + 1), 2 * block)
        blocks = durable(cut.cut(join_back(rows, long, by)).where(inner))
        kind = {"i": T.LongType(), "w": T.LongType(), CHUNK: T.LongType(), "whole": T.BooleanType(), "state": T.IntegerType()}
        names = ["i", "x", "y", "w", CHUNK, "whole", "state", *span]
        part = T.StructType([*key, *[T.StructField(c, kind.get(c, T.LongType() if c in ("_ai", "_bi") else T.DoubleType())) for c in names]])
        whole = blocks.select(*by, F.col(idx).alias("i"), F.col(x).alias("x"), F.col(y).alias("y"), CHUNK, *span)

        def outline(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("i", ignore_index=True)
            held = _outer(group["x"].to_numpy(float), group["y"].to_numpy(float))
            held[0] = True
            out = group[held].copy()
            out["w"] = np.r_[len(group), np.zeros(held.sum() - 1, "int64")]
            return out.assign(whole=len(out) == len(group), state=_WAIT)[part.fieldNames()]

        def advance(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("i", ignore_index=True)
            a, b = (tuple(group[f"_{end}{c}"].iloc[0] for c in "ixy") for end in "ab")
            cols = [group[c].to_numpy() for c in ("i", "x", "y", "w", CHUNK, "whole")]
            pieces = []
            for state, a, b, at in _advance(*cols, a, b, tolerance, size):
                piece = group.iloc[at].assign(state=state, **dict(zip(span, (*a, *b))))
                # All but one row of a fragment to load only tell that it is one.
                pieces.append(piece.drop_duplicates(CHUNK) if state in (_LOAD, _SHORT) else piece)
            return pd.concat(pieces)[part.fieldNames()] if pieces else group.iloc[:0][part.fieldNames()]

        at = [*by, CHUNK]
        waiting = durable(whole.groupBy(*at).applyInPandas(outline, part))
        pieces = []
        while True:
            told = durable(waiting.groupBy(*by, "_ai", "_bi").applyInPandas(advance, part))
            kept = kept.unionByName(told.where(F.col("state") == _KEPT).select(*by, "i", "x", "y"))
            pieces.append(told.where(F.col("state") == _SHORT).select(*at, *span))
            load = told.where(F.col("state") == _LOAD).select(*at, *span)
            if load.isEmpty():
                break
            inside = (F.col("i") > F.col("_ai")) & (F.col("i") < F.col("_bi"))
            loaded = join_back(whole.drop(*span), F.broadcast(load) if fits(load, 10_000) else load, at).where(inside)
            loaded = loaded.withColumns({"w": F.lit(1).cast("bigint"), "whole": F.lit(True), "state": F.lit(_WAIT)})
            waiting = told.where(F.col("state") == _WAIT).unionByName(loaded)
        found = durable(reduce(DataFrame.unionByName, pieces))
        short = short.unionByName(join_back(blocks.drop(*span), found, at).where(inner).drop(CHUNK))

    schema = T.StructType([*key, T.StructField("i", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(idx)
        e = group.iloc[0]
        i, px, py = (np.r_[e[f"_a{n}"], group[c].to_numpy(), e[f"_b{n}"]] for n, c in (("i", idx), ("x", x), ("y", y)))
        at = _split_points(px, py, tolerance)[1:-1]
        out = pd.DataFrame({"i": i[at].astype("int64"), "x": px[at], "y": py[at]})
        for c in by:
            out[c] = e[c]
        return out[schema.fieldNames()]

    inner_kept = short.groupBy(*by, "_ai", "_bi").applyInPandas(finish, schema)
    whole_kept = kept.union(inner_kept).distinct()
    return whole_kept.select(*by, F.col("i").alias(idx), F.col("x").alias(x), F.col("y").alias(y))


def with_distance_km(track: DataFrame, distance: str = "distance") -> DataFrame:
    return track.withColumn("km", F.col(distance) / 1000.0)

