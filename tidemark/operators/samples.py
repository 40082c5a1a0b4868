"""Water samples: sampler logs, measurements at sampling times, sample tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.timejoin import band_join


def year_day(ts: Column) -> Column:
    """Day of the year with its fraction."""
    start = F.unix_micros(F.date_trunc("day", ts))
    return F.dayofyear(ts) + (F.unix_micros(ts) - start) / F.lit(86_400_000_000.0)


def sample_means(
    events: DataFrame, grid: DataFrame, by: Sequence[str], number: str, candidates: dict[str, Sequence[str]], ts: str = "ts", seconds: float = 1.0
) -> DataFrame:
    """Means of the grid rows within ``seconds`` of each sample, per output the first candidate
    column that has a value; ``ts`` is the first row's time."""
    near = band_join(events, grid, by, ts, seconds)
    means = [F.coalesce(*[F.avg(c) for c in cols]).alias(out) for out, cols in candidates.items()]
    return near.groupBy(*by, number).agg(F.min(ts).alias(ts), F.count(F.lit(1)).alias("rows"), *means)
