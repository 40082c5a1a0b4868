"""Streaming means of arriving messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stream_means(stream: DataFrame, by: Sequence[str], ts: str, value: str, bin_width: str = "1 second", late: str = "10 minutes") -> DataFrame:
    """Mean per time bin of a stream; rows later than ``late`` behind the newest are dropped."""
    window = F.window(ts, bin_width)
    return (
        stream.withWatermark(ts, late)
        .groupBy(*by, window.alias("_w"))
        .agg(F.avg(value).alias(value), F.count(F.lit(1)).alias("n"))
        .select(*by, F.col("_w.start").alias(ts), value, "n")
    )


def open_stream(spark: SparkSession, path: str, schema: T.StructType, names: str = "*.parquet", files_per_batch: int = 100) -> DataFrame:
    """Parquet files as they arrive in a folder."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.option("pathGlobFilter", names).parquet(path)


def write_means(means: DataFrame, path: str, checkpoint: str) -> None:
    """Process what has arrived and append the finished bins.

    Each batch goes to its own folder and replaces it, so a batch repeated after a failure does
    not write its rows twice.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    query = means.writeStream.outputMode("append").foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
