"""Dead-reckoned positions corrected to surface fixes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.biology import drift_cm_per_s
from tidemark.operators.ordered import HOUR, join_back
from tidemark.operators.timejoin import lerp, segment_join

LONG_SEGMENT = 10


def nudge_segments(nav: DataFrame, gps: DataFrame, by: Sequence[str], us: str = "us", max_gap_s: float = 10.0, width: float = HOUR) -> tuple[DataFrame, DataFrame]:
    """Dead-reckoned points with their fixes, and one row per segment between two fixes.

    ``lat_diff`` and ``lon_diff`` lead from the last point of a segment to the fix after it; they
    are zero when that fix comes more than ``max_gap_s`` later.
    """
    by = list(by)
    points = segment_join(nav, gps, by, us, ["lat", "lon"], width)
    inside = points.where(F.col("seg_start").isNotNull() & F.col("seg_end").isNotNull())
    ends = inside.groupBy(*by, "seg_start").agg(
        F.min(us).alias("first_us"),
        F.max(us).alias("last_us"),
        F.max("seg_end").alias("seg_end"),
        (F.max("fix_lat") - F.max_by("lat", us)).alias("raw_lat"),
        (F.max("fix_lon") - F.max_by("lon", us)).alias("raw_lon"),
        F.max("fix_lat").alias("fix_lat"),
        F.count(F.lit(1)).alias("points"),
    )
    seconds = (F.col("last_us") - F.col("first_us")) / F.lit(1e6)
    late = (F.col("seg_end") - F.col("last_us")) / F.lit(1e6) > max_gap_s
    segments = ends.withColumns(
        {
            "too_far": (F.abs("raw_lat") > 1) | (F.abs("raw_lon") > 1),
            "u_drift": drift_cm_per_s(F.col("raw_lon"), seconds, F.col("fix_lat")),
            "v_drift": drift_cm_per_s(F.col("raw_lat"), seconds),
            "lat_diff": F.when(late, 0.0).otherwise(F.col("raw_lat")),
            "lon_diff": F.when(late, 0.0).otherwise(F.col("raw_lon")),
            "minutes": seconds / 60,
        }
    ).drop("raw_lat", "raw_lon", "fix_lat")
    return points, segments


def nudge_positions(
    nav: DataFrame, gps: DataFrame, by: Sequence[str], us: str = "us", max_gap_s: float = 10.0, width: float = HOUR
) -> tuple[DataFrame, DataFrame]:
    """Ramp each segment so that its last point meets the next fix.

    Points before the first and after the last fix stay as they are; points at the time of a fix
    drop out. A series with a segment more than a degree off, or without any fix, keeps its raw
    positions; ``status`` tells. The second table counts long segments and their minutes.
    """
    by = list(by)
    points, segments = nudge_segments(nav, gps, by, us, max_gap_s, width)
    summary = segments.groupBy(*by).agg(
        F.count_if(F.col("points") > LONG_SEGMENT).alias("segments"), F.sum("minutes").alias("minutes"), F.bool_or("too_far").alias("failed")
    )
    has_fix = gps.select(*by).distinct().withColumn("_fix", F.lit(True))
    state = join_back(join_back(nav.select(*by).distinct(), has_fix, by, "left"), summary.select(*by, "failed"), by, "left")
    status = F.when(F.col("_fix").isNull(), "no_fix").when(F.coalesce("failed", F.lit(False)), "failed").otherwise("nudged")
    state = state.select(*by, status.alias("status"))
    ramp = segments.select(*by, "seg_start", "first_us", "last_us", "lat_diff", "lon_diff")
    moved = join_back(join_back(points, state.where("status = 'nudged'"), by), ramp, [*by, "seg_start"], "left")
    part, whole = F.col(us) - F.col("first_us"), F.col("last_us") - F.col("first_us")
    inner = F.col("seg_end").isNotNull() & F.col("lat_diff").isNotNull()

    def ramped(col: str):
        # A segment of one point takes the whole difference.
        nudge = F.when(whole == 0, F.col(f"{col}_diff")).otherwise(lerp(F.lit(0.0), F.col(f"{col}_diff"), part, whole))
        return F.when(inner, F.col(col) + nudge).otherwise(F.col(col)).alias(col)

    others = [c for c in nav.columns if c not in ("lat", "lon", *by)]
    nudged = moved.select(*by, *others, ramped("lat"), ramped("lon"), "status")
    raw = join_back(nav, state.where("status <> 'nudged'"), by).select(*by, *others, "lat", "lon", "status")
    return nudged.union(raw), summary
