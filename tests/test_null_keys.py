"""NULL is a series key like any other: its rows come out like those of a named series with the same rows."""

import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators import arrays, clean, particles, resample, section, signal, stats, timejoin
from tidemark.operators.ordered import join_back, quantiles
from tidemark.plans import plankton, positions

N = 900
BY = ["series"]
ROWS = "idx bigint, us bigint, lat double, lon double, depth double, value double, var string, start double, counter bigint"


def rows():
    out = []
    for i in range(N):
        value = None if i % 97 == 5 else 1000.0 if i % 50 == 7 else math.sin(i / 9) * 3 + i % 4
        out.append((i, 1_700_000_000_000_000 + i * 1_000_000 * (1 + i // 300), 36.8 + i / 9000, 122.0 + i / 7000, 25 - 25 * math.cos(i / 30), value, "ab"[i % 2], 5.0, 10 + 2 * i))
    return out


@pytest.fixture(scope="module")
def df(spark):
    one = spark.createDataFrame(rows(), ROWS)
    return one.withColumn("series", F.lit("known")).unionByName(one.withColumn("series", F.lit(None).cast("string"))).repartition(4).cache()


def rules(spark):
    return spark.createDataFrame([("a", -100.0, 100.0), ("b", -100.0, 100.0)], "var string, lo double, hi double")


def fixes(d):
    return d.where("idx % 40 = 20").select("series", F.col("us").alias("us"), (F.col("lat") + 0.001).alias("lat"), (F.col("lon") - 0.001).alias("lon"))


def sun(d):
    every = d.where("idx % 20 = 0")
    return every.select("series", "us", (F.lit(10) - F.col("idx") % 200 / 8).alias("altitude"), (F.col("idx") % 100 == 60).alias("changes"), (F.col("idx") % 200 == 60).alias("is_sunset"))


def nights(d):
    return signal.night_windows(sun(d), d.groupBy("series").agg(F.min("us").alias("start"), F.max("us").alias("end")), BY, "us", 1_000_000)


def spans(d):
    return d.groupBy("series", F.floor(F.col("idx") / 100).cast("string").alias("label")).agg(F.min("us").alias("start"), F.max("us").alias("end"), F.min("idx").alias("position"))


def profiles(d):
    return d.withColumns({"profile": (F.floor(F.col("idx") / 90) + 1).cast("int"), "km": F.col("idx") / 50})


def proxies(d):
    wanted = {"fluo": F.col("value"), "bg": F.col("value") * 2 + F.col("idx") % 3, "adinos": F.abs("value") + 1, "diatoms": F.lit(2.0), "hdinos": F.lit(1.0)}
    return d.select("series", "us", *[v.alias(c) for c, v in wanted.items()])


def plankton_table(d):
    raw = d.select("series", "us", F.abs("value").alias("x"))
    flow, fluo = d.select("series", "us", F.lit(340.0).alias("flow")), d.select("series", "us", (F.col("depth") / 10).alias("fluo"))
    return plankton.plankton_proxies(raw, flow, fluo, d.select("series", "us", "lat", "lon"), BY, stride=50)[0]


CASES = {
    "night_windows": lambda d, s: nights(d),
    "select_nights": lambda d, s: signal.select_nights(d.select("series", "us", "idx"), nights(d), BY, "us"),
    "midnights": lambda d, s: section.midnights(profiles(d).withColumn("us", F.col("us") + F.col("idx") * 600_000_000), BY, "us", "lon", "km"),
    "log_ranges": lambda d, s: section.log_ranges(profiles(d), spans(d), BY, "us", "km"),
    "grid_section": lambda d, s: section.grid_section(profiles(d), BY, "km", "depth", "profile", "value", 2.0),
    "simplify": lambda d, s: section.simplify(d, BY, "idx", "lat", "depth", 0.5, 200),
    "peaks": lambda d, s: signal.peaks_above(d.withColumn("level", F.lit(1.0)), BY, "idx", "value", "level"),
    "latest_profile": lambda d, s: arrays.latest_profile(profiles(d), BY, "profile"),
    "contains_event": lambda d, s: timejoin.contains_event(spans(d), d.where("idx % 150 = 7"), BY, "start", "end", "us", "held"),
    "time_join": lambda d, s: timejoin.time_join(d.select("series", "idx", "us"), d.where("idx % 3 = 0").select("series", "us", "depth"), ["series", "us"]),
    "clock_sync": lambda d, s: clean.clock_sync(d, d.withColumn("us", F.col("us") + F.col("idx") % 3), BY, "idx", "us"),
    "rate_per_km": lambda d, s: section.rate_per_km(profiles(d), BY, "us", "km", "idx"),
    "axes_equal": lambda d, s: timejoin.axes_equal(d, d.withColumn("us", F.col("us") + 1), BY, "idx", "us"),
    "nudge_positions": lambda d, s: positions.nudge_positions(d.select("series", "us", "lat", "lon"), fixes(d), BY)[0],
    "nudge_summary": lambda d, s: positions.nudge_positions(d.select("series", "us", "lat", "lon"), fixes(d), BY)[1],
    "correct_proxies": lambda d, s: plankton.correct_proxies(
        proxies(d), profiles(d).select("series", "us", "depth", F.col("profile").alias("profile_number")), d.where("idx = 450").select("series", F.col("us").alias("at")), BY
    ),
    "plankton_proxies": lambda d, s: plankton_table(d),
    "intersect_indices": lambda d, s: clean.intersect_indices(d.withColumn("slot", F.floor(F.col("idx") / 2)).where("idx % 7 <> 0"), BY, "slot", "var"),
    "range_qc_drop": lambda d, s: clean.range_qc_drop(d, rules(s), [*BY, "us"], "var", "value"),
    "fix_lon_sign": lambda d, s: clean.fix_lon_sign(d, BY, "lon", ["idx"]),
    "relative": lambda d, s: clean.relative(d, BY, ["lat", "depth"], ["idx"]),
    "on_grid": lambda d, s: resample.on_grid(resample.resample_mean(d, BY, "us", ["depth"]), BY, "us"),
    "extent": lambda d, s: resample.extent(d, BY, "var", "us"),
    "track_distance": lambda d, s: section.track_distance(d, BY, "idx", "us", "lat", "lon"),
    "profile_bottom": lambda d, s: section.profile_bottom(d, BY, "idx", "depth", 0.05),
    "lowpass": lambda d, s: signal.lowpass(d, BY, "idx", "depth", "low"),
    "fill_coefficient": lambda d, s: signal.fill_coefficient(d, BY, "value"),
    "frame_times": lambda d, s: particles.frame_times(d, BY, "idx", "counter", "start"),
    "mean_ranks": lambda d, s: stats.mean_ranks(d, BY, "value", "rank"),
    "describe": lambda d, s: stats.describe(d, BY, "value"),
    "median_position": lambda d, s: stats.median_position(d, BY, "lat", "lon"),
    "activity_percentiles": lambda d, s: stats.activity_percentiles(d, BY, "us", "depth", {"p10": 0.1, "p90": 0.9}),
    "quantiles_in_ranges": lambda d, s: quantiles(d, BY, "depth", {"q": 0.3}, limit=100),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_null_series_like_a_named_one(spark, df, name):
    out = CASES[name](df, spark).withColumn("series", F.coalesce("series", F.lit("null")))
    held = out.select(sorted(out.columns)).toPandas().round(9)
    rest = [c for c in held.columns if c != "series"]
    known, null = (held[held.series == k][rest].astype(str).sort_values(rest).to_numpy().tolist() for k in ("known", "null"))
    assert known and null == known


def test_out_of_range_rows_of_a_null_series_go(spark, df):
    out = clean.range_qc_drop(df, rules(spark), [*BY, "us"], "var", "value")
    assert out.where("value > 100").count() == 0 and out.where("series is null").count() > 0


def test_join_back_kinds(spark):
    a = spark.createDataFrame([(1, None, "x"), (2, "k", "y"), (3, "m", "z")], "v int, k string, t string")
    b = spark.createDataFrame([(None, 7), ("k", 8)], "k string, w int")
    got = {how: sorted(map(tuple, join_back(a, b, ["k"], how).collect()), key=str) for how in ("inner", "left", "left_semi", "left_anti")}
    assert got["inner"] == [("k", 2, "y", 8), (None, 1, "x", 7)]
    assert got["left"] == [("k", 2, "y", 8), ("m", 3, "z", None), (None, 1, "x", 7)]
    assert got["left_semi"] == [("k", 2, "y"), (None, 1, "x")] and got["left_anti"] == [("m", 3, "z")]
