"""Sensor-like inputs derived from the benchmark tables, for Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ordered import axis, row_index
from tidemark.session import prepare

DAY = 86_400_000_000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf}/{name}.parquet")


CTES = {
    "signal": "SELECT user_id AS series, event_id AS seq, ts, epoch_us(ts) AS us, value FROM events",
    "clock": (
        "SELECT o_custkey AS series, o_orderkey AS seq, o_orderdate AS ts, "
        "epoch_us(o_orderdate) AS us, o_totalprice AS value FROM orders"
    ),
    "rate60": (
        "SELECT event_type AS series, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS idx, "
        "value FROM events"
    ),
    "track": (
        "SELECT event_type AS series, idx, round(25 - 25*cos(2*pi()*idx/200.0) + value/100, 6) AS depth FROM "
        "(SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS idx FROM events) q"
    ),
    "nav": (
        "SELECT user_id AS series, event_id AS seq, ts, epoch_us(ts) AS us, 36.8 + value/10000 AS lat, "
        "-122.0 - value/20000 AS lon FROM events WHERE event_type <> 'signup'"
    ),
    "gps": (
        "SELECT user_id AS series, event_id AS seq, ts, epoch_us(ts) AS us, 36.8 + value/8000 AS lat, "
        "-122.0 - value/16000 AS lon FROM events WHERE event_type = 'signup'"
    ),
    "ctd": (
        "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, 4 + l_quantity/4 AS temp, 33 + l_discount*10 AS sal, "
        "l_extendedprice/250 AS pres, 0.5 + l_tax*20 AS volts, (l_quantity - 25)*2 AS pitch FROM lineitem"
    ),
    "eff": (
        "SELECT * FROM (VALUES (1, TIMESTAMP '1995-01-01', 0.0016691, 5.0119e13), (2, TIMESTAMP '1997-01-01', 0.0016691, 2.5119e13), "
        "(3, TIMESTAMP '1999-01-01', 0.0047101, 1.0e14), (4, TIMESTAMP '2000-06-01', 0.0049859, 3.8019e13)) "
        "AS t(period, valid_from, cal_factor, ratio_adinos)"
    ),
    "samples": "SELECT vec_id AS sec, label, embedding AS samples FROM embeddings",
    "syslog": (
        "SELECT event_id AS line_no, CASE WHEN event_id % 2 = 0 THEN concat('2019-08-16T19:51:31.135Z,', "
        "CAST(1565985091 + event_id AS VARCHAR), '.135 [CANONSampler](INFO): ELMO will go to position 1') ELSE "
        "concat('2019-08-16T19:51:31.135Z,', CAST(1565985091 + event_id AS VARCHAR), '.135 [CANONSampler](IMPORTANT): Sample ', "
        "CAST((event_id + 1)//2 AS VARCHAR), ', (err_code=0)') END AS line FROM events"
    ),
    "mep": (
        "SELECT l_suppkey AS series, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) - 1 AS idx, "
        "CASE WHEN l_linenumber <= 2 THEN 1 ELSE 0 END AS n, CAST(l_quantity*60 AS INT) AS p, "
        "CAST(l_partkey % 64 AS INT) AS e FROM lineitem"
    ),
}


def signal(spark: SparkSession, sf: str) -> DataFrame:
    """Irregular series with ascending time."""
    return table(spark, sf, "events").select(
        F.col("user_id").alias("series"),
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("ts"),
        "value",
    )


def signal_us(spark: SparkSession, sf: str) -> DataFrame:
    """``signal`` with its time as epoch microseconds."""
    return signal(spark, sf).withColumn("us", F.unix_micros("ts")).drop("ts")


def clock(spark: SparkSession, sf: str) -> DataFrame:
    """Series whose clock jumps back and forth."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("series"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_totalprice").alias("value"),
    )


def rate60(spark: SparkSession, sf: str) -> DataFrame:
    """Fixed-rate 60 Hz series; seconds are idx / 60."""
    raw = table(spark, sf, "events").select(F.col("event_type").alias("series"), "event_id", "value")
    return row_index(raw, axis("series", "event_id", 50_000)).select("series", "idx", "value")


def track(spark: SparkSession, sf: str) -> DataFrame:
    """Yo-yo depth track at 1 Hz with noise."""
    depth = F.lit(25) - F.lit(25) * F.cos(F.lit(2) * F.pi() * F.col("idx") / 200.0) + F.col("value") / 100
    return rate60(spark, sf).select("series", "idx", F.round(depth, 6).alias("depth"))


def nav(spark: SparkSession, sf: str) -> DataFrame:
    """Dead-reckoned positions."""
    e = table(spark, sf, "events").where("event_type <> 'signup'")
    return e.select(
        F.col("user_id").alias("series"),
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("ts"),
        (F.lit(36.8) + F.col("value") / 10000).alias("lat"),
        (F.lit(-122.0) - F.col("value") / 20000).alias("lon"),
    )


def gps(spark: SparkSession, sf: str) -> DataFrame:
    """Surface fixes of the same series."""
    e = table(spark, sf, "events").where("event_type = 'signup'")
    return e.select(
        F.col("user_id").alias("series"),
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("ts"),
        (F.lit(36.8) + F.col("value") / 8000).alias("lat"),
        (F.lit(-122.0) - F.col("value") / 16000).alias("lon"),
    )


def ctd(spark: SparkSession, sf: str) -> DataFrame:
    """Temperature, salinity, pressure, oxygen volts and pitch."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        (F.lit(4) + F.col("l_quantity") / 4).alias("temp"),
        (F.lit(33) + F.col("l_discount") * 10).alias("sal"),
        (F.col("l_extendedprice") / 250).alias("pres"),
        (F.lit(0.5) + F.col("l_tax") * 20).alias("volts"),
        ((F.col("l_quantity") - 25) * 2).alias("pitch"),
    )


def eff(spark: SparkSession) -> DataFrame:
    """Effective-dated settings."""
    return prepare(spark).sql(
        "SELECT * FROM VALUES (1, TIMESTAMP '1995-01-01', 0.0016691D, 5.0119e13D), (2, TIMESTAMP '1997-01-01', 0.0016691D, 2.5119e13D), "
        "(3, TIMESTAMP '1999-01-01', 0.0047101D, 1.0e14D), (4, TIMESTAMP '2000-06-01', 0.0049859D, 3.8019e13D) "
        "AS t(period, valid_from, cal_factor, ratio_adinos)"
    )


def samples(spark: SparkSession, sf: str) -> DataFrame:
    """One row a second with an array of samples."""
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("sec"), "label", F.col("embedding").alias("samples")
    )


def syslog(spark: SparkSession, sf: str) -> DataFrame:
    """Text log lines: sampler starts and sample numbers."""
    stamp = F.concat(
        F.lit("2019-08-16T19:51:31.135Z,"), (F.lit(1565985091) + F.col("event_id")).cast("string"), F.lit(".135 [CANONSampler]")
    )
    start = F.concat(stamp, F.lit("(INFO): ELMO will go to position 1"))
    number = F.concat(
        stamp,
        F.lit("(IMPORTANT): Sample "),
        F.floor((F.col("event_id") + 1) / 2).cast("string"),
        F.lit(", (err_code=0)"),
    )
    return table(spark, sf, "events").select(
        F.col("event_id").alias("line_no"), F.when(F.col("event_id") % 2 == 0, start).otherwise(number).alias("line")
    )


def mep(spark: SparkSession, sf: str) -> DataFrame:
    """Particle fragments in arrival order; n = 1 starts a new particle."""
    raw = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("series"), "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"
    )
    ax = axis("series", ["l_orderkey", "l_linenumber", "l_partkey"], 20_000)
    return row_index(raw, ax).select(
        "series",
        "idx",
        F.when(F.col("l_linenumber") <= 2, 1).otherwise(0).alias("n"),
        (F.col("l_quantity") * 60).cast("int").alias("p"),
        (F.col("l_partkey") % 64).cast("int").alias("e"),
    )
