"""Writing stage tables and sample tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.samples import year_day


def write_stage(df: DataFrame, path: str, by: Sequence[str] = ("platform", "mission")) -> None:
    """Write a stage partitioned by mission; only the missions in ``df`` are replaced.

    Rows of a mission may go to several files, so a long mission is not squeezed into one task.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# The columns of the sample table; every measurement is followed by its quality flag.
SAMPLE_COLUMNS = (
    "Cruise", "Station", "Type", "mon/day/yr", "hh:mm", "Lon (degrees_east)", "Lat (degrees_north)",
    "Bot. Depth [m]", "Bottle Number [count]", "QF", "DEPTH [m]", "QF", "TEMPERATURE [°C]", "QF",
    "SALINITY [PSS78]", "QF", "Oxygen [ml/l]", "QF", "NITRATE [µmol/kg]", "QF", "ChlFluor [raw]", "QF",
    "bbp420 [m^{-1}]", "QF", "bbp700 [m^{-1}]", "QF", "PAR [V]", "QF", "YearDay [day]", "QF",
)


def number_text(fmt: str, col: Column) -> Column:
    """Formatted number, ``NaN`` where it is missing."""
    return F.when(col.isNull(), "NaN").otherwise(F.format_string(fmt, col))


def sample_lines(samples: DataFrame) -> DataFrame:
    """One tab-separated line per water sample in the fixed column order."""
    c = F.col
    flagged = [
        number_text("%6.2f", c("depth")),
        number_text("%5.2f", c("temperature")),
        number_text("%6.3f", c("salinity")),
        number_text("%5.3f", c("oxygen")),
        number_text("%6.3f", c("nitrate")),
        number_text("%11.8f", c("fluorescence")),
        number_text("%8.7f", c("bbp420")),
        number_text("%8.7f", c("bbp700")),
        number_text("%6.3f", c("par")),
        number_text("%9.5f", year_day(c("ts"))),
    ]
    plain = [
        c("cruise"),
        F.floor("station").cast("string"),
        F.lit("B"),
        F.date_format("ts", "MM/dd/yyyy"),
        F.date_format("ts", "HH:mm"),
        number_text("%9.5f", c("lon") + 360.0),
        number_text("%8.5f", c("lat")),
        F.format_string("%8.1f", F.coalesce(c("bottom_depth"), F.lit(1000.0))),
        c("bottle").cast("string"),
        F.lit("0"),
    ]
    for text in flagged:
        plain += [text, F.lit("0")]
    return samples.select("cruise", "bottle", F.concat_ws("\t", *plain).alias("line"))


def write_samples(samples: DataFrame, path: str) -> None:
    """Sample lines as text, one folder per cruise; the header is ``SAMPLE_COLUMNS`` joined by tabs."""
    header = samples.select("cruise").distinct().select("cruise", F.lit(-1).alias("bottle"), F.lit("\t".join(SAMPLE_COLUMNS)).alias("line"))
    lines = header.unionByName(sample_lines(samples).withColumn("bottle", F.col("bottle").cast("int")))
    ordered = lines.repartitionByRange("cruise", "bottle").sortWithinPartitions("cruise", "bottle")
    ordered.select("cruise", "line").write.mode("overwrite").partitionBy("cruise").text(path)
