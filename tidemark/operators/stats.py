"""Statistics over groups: correlation, regression, quantiles, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import join_back, quantiles, value_counts


def no_nan(col: Column) -> Column:
    return F.nanvl(col, F.lit(None).cast("double"))


def pearson(x: str, y: str) -> Column:
    """Correlation of the pairs where both are known; NULL when it is not defined."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    return no_nan(F.corr(F.when(both, F.col(x)), F.when(both, F.col(y))))


def mean_ranks(df: DataFrame, by: Sequence[str], col: str, out: str) -> DataFrame:
    """Rank of each value in its group, ties sharing their mean rank."""
    ranks = value_counts(df, by, col).select(
        *by, F.col("value").alias(col), (F.col("below") + (F.col("n") + 1) / 2).alias(out)
    )
    return join_back(df, ranks, [*by, col])


def profile_corr(df: DataFrame, by: Sequence[str], x: str, y: str, kind: str = "pearson") -> DataFrame:
    """Correlation of two variables per profile, Pearson or Spearman."""
    if kind == "spearman":
        pairs = df.select(*by, x, y).dropna(subset=[x, y])
        ranked = mean_ranks(mean_ranks(pairs, by, x, "_rx"), by, y, "_ry")
        return ranked.groupBy(*by).agg(pearson("_rx", "_ry").alias("r"))
    return df.groupBy(*by).agg(pearson(x, y).alias("r"))


def ols(df: DataFrame, by: Sequence[str], x: str, y: str, intercept: bool = True) -> DataFrame:
    """Least squares line: slope, intercept, R2 and the number of pairs."""
    pairs = df.dropna(subset=[x, y])
    if intercept:
        aggs = [
            F.regr_slope(y, x).alias("slope"),
            F.regr_intercept(y, x).alias("intercept"),
            no_nan(F.regr_r2(y, x)).alias("r2"),
        ]
    else:
        sxy, sxx, syy = F.sum(F.col(x) * F.col(y)), F.sum(F.col(x) * F.col(x)), F.sum(F.col(y) * F.col(y))
        aggs = [
            (sxy / F.nullif(sxx, F.lit(0.0))).alias("slope"),
            F.lit(0.0).alias("intercept"),
            (sxy * sxy / F.nullif(sxx * syy, F.lit(0.0))).alias("r2"),
        ]
    return pairs.groupBy(*by).agg(*aggs, F.count(F.lit(1)).alias("n"))


def calibration_factor(df: DataFrame, by: Sequence[str], col: str, prob: float = 0.99) -> DataFrame:
    return quantiles(df, by, col, {"factor": prob})


def activity_percentiles(df: DataFrame, by: Sequence[str], ts: str, col: str, probs: dict[str, float]) -> DataFrame:
    """Percentile bands of a parameter per activity with the activity's start."""
    starts = df.groupBy(*by).agg(F.min(ts).alias("start"))
    return join_back(starts, quantiles(df, by, col, probs), by, "left")


def log_hist(df: DataFrame, by: Sequence[str], num: str, den: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Counts of log10(num / den) in equal bins; zero, infinite and missing ratios are left out."""
    x, y = F.col(num), F.col(den)
    ratio = F.when((y != 0) & (x / F.nullif(y, F.lit(0.0)) > 0), F.log10(x / F.nullif(y, F.lit(0.0))))
    binned = df.withColumn("_log", ratio).where(F.col("_log").isNotNull())
    slot = F.floor((F.col("_log") - lo) / F.lit((hi - lo) / bins)).cast("int")
    inside = F.col("_log").between(lo, hi)
    return binned.where(inside).groupBy(*by, F.least(slot, F.lit(bins - 1)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def describe(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """Count, mean, sample standard deviation, minimum, quartiles and maximum."""
    plain = df.groupBy(*by).agg(
        F.count(col).alias("count"),
        F.avg(col).alias("mean"),
        F.stddev_samp(col).alias("std"),
        F.min(col).alias("min"),
        F.max(col).alias("max"),
    )
    return join_back(plain, quantiles(df, by, col, {"p25": 0.25, "p50": 0.5, "p75": 0.75}), by, "left")


def median_position(df: DataFrame, by: Sequence[str], lat: str, lon: str) -> DataFrame:
    return join_back(quantiles(df, by, lat, {lat: 0.5}), quantiles(df, by, lon, {lon: 0.5}), by)


def mean_of(df: DataFrame, by: Sequence[str], candidates: Sequence[str], out: str) -> DataFrame:
    """Mean of the first candidate that has any value."""
    return df.groupBy(*by).agg(F.coalesce(*[F.avg(c) for c in candidates]).alias(out))


def density2d(df: DataFrame, by: Sequence[str], x: tuple[str, float, float, int], y: tuple[str, float, float, int]) -> DataFrame:
    """Counts on a grid of two variables; the upper edges belong to the last cells."""

    def cell(name: str, lo: float, hi: float, n: int) -> Column:
        slot = F.floor((F.col(name) - lo) * F.lit(n / (hi - lo))).cast("int")
        return F.least(slot, F.lit(n - 1))

    inside = df.where(F.col(x[0]).between(x[1], x[2]) & F.col(y[0]).between(y[1], y[2]))
    return inside.groupBy(*by, cell(*x).alias("x_cell"), cell(*y).alias("y_cell")).agg(F.count(F.lit(1)).alias("n"))


def outcome_counts(df: DataFrame, by: Sequence[str], outcome: str) -> DataFrame:
    return df.groupBy(*by, outcome).agg(F.count(F.lit(1)).alias("n"))
