"""Reshaping: array expansion, long and wide tables, concatenation of logs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordered import join_back


def expand(df: DataFrame, us: str, samples: str, rate: int, coeff: Column | None = None, offset_us: int = 0) -> DataFrame:
    """One row per sample of a per-second array, ``j / rate`` seconds after the row's time.

    ``offset_us`` moves the start: samples logged at the end of their second begin half a second
    earlier. ``coeff`` is multiplied to every sample of its row.
    """
    rows = df.select("*", F.posexplode(samples).alias("j", "_sample")).drop(samples)
    value = F.col("_sample").cast("double")
    return rows.withColumns(
        {
            us: F.col(us) + offset_us + F.floor(F.col("j") * F.lit(1_000_000) / rate),
            "value": value * coeff if coeff is not None else value,
        }
    ).drop("_sample")


def to_wide(df: DataFrame, by: Sequence[str], var: str, value: str, names: Sequence[str]) -> DataFrame:
    """One column per variable; the names are given, so no extra pass looks for them."""
    return df.groupBy(*by).pivot(var, list(names)).agg(F.avg(value))


def to_long(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One row per variable that has a value."""
    return df.unpivot(list(by), list(cols), "var", "value").where(F.col("value").isNotNull())


def concat_logs(logs: Sequence[DataFrame], by: Sequence[str], ts: str, seq: str, unique: bool) -> DataFrame:
    """Logs under each other with the columns of all; ``unique`` keeps the first row of a time."""
    tagged = [log.withColumn("_log", F.lit(i)) for i, log in enumerate(logs)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    if unique:
        w = Window.partitionBy(*by, ts).orderBy(seq, "_log")
        rows = rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return rows.drop("_log")


def latest_profile(df: DataFrame, by: Sequence[str], profile: str) -> DataFrame:
    last = df.groupBy(*by).agg(F.max(profile).alias(profile))
    return join_back(df, last, [*by, profile], "left_semi").select(df.columns)
