"""Queries for the time joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import timejoin as tj
from tidemark.registry import inputs as fx
from tidemark.registry.core import query
from tidemark.registry.inputs import DAY, table

NEIGHBOURS = """p AS (SELECT n.*, g.us AS t0, g.lat AS lat0, g.lon AS lon0, g.seq AS seq0 FROM nav n ASOF LEFT JOIN gps g ON n.series = g.series AND n.us >= g.us),
    b AS (SELECT p.*, g.us AS t1, g.lat AS lat1, g.lon AS lon1, g.seq AS seq1 FROM p ASOF LEFT JOIN gps g ON p.series = g.series AND p.us <= g.us)"""

LERP = "CASE WHEN t0 = t1 THEN {c}0 ELSE {c}0 + ({c}1 - {c}0)*((us - t0)/nullif(t1 - t0, 0)::DOUBLE) END"


def nav_us(spark, sf):
    return fx.nav(spark, sf).select("series", "seq", F.unix_micros("ts").alias("us"), F.col("lat").alias("nav_lat"))


def gps_us(spark, sf):
    return fx.gps(spark, sf).select("series", "seq", F.unix_micros("ts").alias("us"), "lat", "lon")


@query(
    "join1_interp_join",
    f"""WITH {NEIGHBOURS} SELECT series, seq, us, round(CASE WHEN t0 IS NULL OR t1 IS NULL THEN coalesce(lat0, lat1) ELSE {LERP.format(c='lat')} END, 9) AS lat,
    round(CASE WHEN t0 IS NULL OR t1 IS NULL THEN coalesce(lon0, lon1) ELSE {LERP.format(c='lon')} END, 9) AS lon FROM b""",
    ("nav", "gps"),
)
def join1(spark, sf):
    fixes = gps_us(spark, sf).drop("seq")
    out = tj.interp_join(nav_us(spark, sf).drop("nav_lat"), fixes, ["series"], "us", ["lat", "lon"], width=10 * DAY)
    return out.withColumns({"lat": F.round("lat", 9), "lon": F.round("lon", 9)})


@query(
    "join2_interp_join_inside",
    f"""WITH {NEIGHBOURS} SELECT series, seq, us, round(CASE WHEN t0 IS NULL OR t1 IS NULL THEN NULL ELSE {LERP.format(c='lat')} END, 9) AS lat FROM b""",
    ("nav", "gps"),
)
def join2(spark, sf):
    fixes = gps_us(spark, sf).drop("seq", "lon")
    out = tj.interp_join(nav_us(spark, sf).drop("nav_lat"), fixes, ["series"], "us", ["lat"], clamp=False, width=10 * DAY)
    return out.withColumn("lat", F.round("lat", 9))


@query(
    "join3_asof_nearest",
    f"""WITH {NEIGHBOURS} SELECT series, seq, us, CASE WHEN t0 IS NULL OR t1 - us < us - t0 THEN seq1 ELSE seq0 END AS fix FROM b""",
    ("nav", "gps"),
)
def join3(spark, sf):
    fixes = gps_us(spark, sf).select("series", "us", F.col("seq").alias("fix"))
    return tj.asof_nearest(nav_us(spark, sf).drop("nav_lat"), fixes, ["series"], "us", ["fix"], 10 * DAY)


@query(
    "join4_band_join",
    """SELECT g.seq AS event, n.seq AS seq, n.us AS us FROM gps g JOIN nav n ON g.series % 10 = n.series % 10 AND abs(g.us - n.us) <= 60000000""",
    ("nav", "gps"),
)
def join4(spark, sf):
    events = fx.gps(spark, sf).select((F.col("series") % 10).alias("fleet"), F.col("seq").alias("event"), "ts")
    grid = fx.nav(spark, sf).select((F.col("series") % 10).alias("fleet"), "seq", "ts")
    return tj.band_join(events, grid, ["fleet"], "ts", 60).select("event", "seq", F.unix_micros("ts").alias("us"))


@query(
    "join4_band_means",
    """SELECT g.seq AS event, count(*) AS n, round(avg(n.lat), 6) AS lat FROM gps g JOIN nav n ON g.series % 10 = n.series % 10 AND abs(g.us - n.us) <= 60000000 GROUP BY g.seq""",
    ("nav", "gps"),
)
def join4_means(spark, sf):
    events = fx.gps(spark, sf).select((F.col("series") % 10).alias("fleet"), F.col("seq").alias("event"), "ts")
    grid = fx.nav(spark, sf).select((F.col("series") % 10).alias("fleet"), "ts", "lat")
    near = tj.band_join(events, grid, ["fleet"], "ts", 60)
    return near.groupBy("event").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("lat"), 6).alias("lat"))


@query(
    "join5_nearest_row",
    """WITH p AS (SELECT g.seq AS event, g.series, g.us, n.us AS t0, n.lat AS lat0 FROM gps g ASOF LEFT JOIN nav n ON g.series = n.series AND g.us >= n.us),
    b AS (SELECT p.*, n.us AS t1, n.lat AS lat1 FROM p ASOF LEFT JOIN nav n ON p.series = n.series AND p.us <= n.us)
    SELECT event, series, us, round(CASE WHEN t0 IS NULL OR t1 - us < us - t0 THEN lat1 ELSE lat0 END, 9) AS lat, CASE WHEN t0 IS NULL OR t1 - us < us - t0 THEN t1 ELSE t0 END AS grid_time FROM b""",
    ("nav", "gps"),
)
def join5(spark, sf):
    events = gps_us(spark, sf).select(F.col("seq").alias("event"), "series", "us")
    grid = nav_us(spark, sf).select("series", "us", F.col("nav_lat").alias("lat"))
    return tj.nearest_row(events, grid, ["series"], "us", ["lat"], 10 * DAY).withColumn("lat", F.round("lat", 9))


@query(
    "join6_segment_join",
    f"""WITH {NEIGHBOURS} SELECT series, seq, us, t0 AS seg_start, t1 AS seg_end, lat1 AS fix_lat FROM b WHERE t0 IS NULL OR t1 IS NULL OR t0 <> t1""",
    ("nav", "gps"),
)
def join6(spark, sf):
    fixes = gps_us(spark, sf).drop("seq", "lon")
    return tj.segment_join(nav_us(spark, sf).drop("nav_lat"), fixes, ["series"], "us", ["lat"], 10 * DAY)


@query(
    "join7_time_join",
    """SELECT o.o_custkey AS series, epoch_us(o.o_orderdate) AS us, o.o_orderkey AS seq, c.n FROM orders o JOIN
    (SELECT o_custkey, o_orderdate, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL) c ON c.o_custkey = o.o_custkey AND c.o_orderdate = o.o_orderdate""",
)
def join7(spark, sf):
    o = table(spark, sf, "orders").withColumn("us", F.unix_micros(F.col("o_orderdate").cast("timestamp")))
    a = o.select(F.col("o_custkey").alias("series"), "us", F.col("o_orderkey").alias("seq"))
    b = o.where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("series"), "us").agg(F.count(F.lit(1)).alias("n"))
    return tj.time_join(a, b, ["series", "us"])


DAILY = """SELECT user_id AS series, epoch_us(date_trunc('day', ts)) AS day, sum(value) AS v FROM events WHERE event_type = '{t}' GROUP BY ALL"""


def daily(spark, sf, kind, name):
    e = table(spark, sf, "events").where(F.col("event_type") == kind)
    day = F.unix_micros(F.date_trunc("day", F.col("ts").cast("timestamp")))
    return e.groupBy(F.col("user_id").alias("series"), day.alias("day")).agg(F.sum("value").alias(name))


@query(
    "join8_aligned_op",
    f"""WITH a AS ({DAILY.format(t='click')}), b AS ({DAILY.format(t='view')})
    SELECT series, day, round(a.v / nullif(b.v, 0), 6) AS ratio, round(CASE WHEN a.v IS NULL OR b.v IS NULL THEN NULL ELSE least(a.v, b.v) END, 6) AS lower
    FROM a FULL JOIN b USING (series, day)""",
)
def join8(spark, sf):
    both = tj.aligned(daily(spark, sf, "click", "a"), daily(spark, sf, "view", "b"), ["series", "day"])
    lower = F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), F.least("a", "b"))
    ratio = F.col("a") / F.nullif(F.col("b"), F.lit(0.0))
    return both.select("series", "day", F.round(ratio, 6).alias("ratio"), F.round(lower, 6).alias("lower"))


@query(
    "join9_effective",
    """WITH d AS (SELECT *, row_number() OVER (ORDER BY valid_from) AS nth FROM eff WHERE valid_from >= TIMESTAMP '1996-01-01')
    SELECT o_orderkey, coalesce((SELECT max_by(period, valid_from) FROM d WHERE valid_from <= o_orderdate), (SELECT period FROM d WHERE nth = 1)) AS period FROM orders""",
    ("eff",),
)
def join9(spark, sf):
    dim = fx.eff(spark).where("valid_from >= TIMESTAMP '1996-01-01'")
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("at"))
    return tj.effective(o, dim, "at", "valid_from").select("o_orderkey", "period")


@query(
    "join9_effective_keyed",
    """WITH d AS (SELECT s_nationkey AS series, s_suppkey, TIMESTAMP '1995-01-01' + INTERVAL 1 DAY * (s_suppkey * 20) AS valid_from FROM supplier)
    SELECT o_orderkey, s_suppkey AS setting FROM (SELECT o_orderkey, o_custkey % 25 AS series, o_orderdate FROM orders) o ASOF LEFT JOIN d ON o.series = d.series AND o.o_orderdate >= d.valid_from""",
)
def join9_keyed(spark, sf):
    dim = table(spark, sf, "supplier").select(
        F.col("s_nationkey").cast("bigint").alias("series"),
        F.col("s_suppkey").alias("setting"),
        (F.lit("1995-01-01").cast("timestamp") + F.make_dt_interval((F.col("s_suppkey") * 20).cast("int"))).alias("valid_from"),
    )
    o = table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_custkey") % 25).alias("series"), F.col("o_orderdate").cast("timestamp").alias("at")
    )
    return tj.effective(o, dim, "at", "valid_from", ["series"], first_if_none=False).select("o_orderkey", "setting")


@query(
    "join10_contains_event",
    """WITH i AS (SELECT series, min(us) AS a, max(us) AS b, seq // 300 AS profile FROM nav GROUP BY ALL)
    SELECT series, profile, EXISTS (SELECT 1 FROM gps g WHERE g.series = i.series AND g.us BETWEEN i.a AND i.b) AS has_fix FROM i""",
    ("nav", "gps"),
)
def join10(spark, sf):
    spans = nav_us(spark, sf).groupBy("series", F.floor(F.col("seq") / 300).alias("profile")).agg(F.min("us").alias("a"), F.max("us").alias("b"))
    out = tj.contains_event(spans, gps_us(spark, sf), ["series"], "a", "b", "us", "has_fix")
    return out.select("series", "profile", "has_fix")


@query(
    "join11_resampled_join",
    """WITH m AS (SELECT series, (us + 1800000000) // 3600000000 * 3600000000 AS us, avg(lat) AS mean_lat FROM nav GROUP BY ALL),
    f AS (SELECT series, us // 3600000000 * 3600000000 AS us, max(lat) AS fix_lat FROM gps GROUP BY ALL)
    SELECT series, us, round(mean_lat, 6) AS mean_lat, round(fix_lat, 9) AS fix_lat FROM m JOIN f USING (series, us)""",
    ("nav", "gps"),
)
def join11(spark, sf):
    from tidemark.operators.resample import resample_mean

    means = resample_mean(nav_us(spark, sf), ["series"], "us", ["nav_lat"], 3600, centred=True)
    fixes = gps_us(spark, sf).withColumn("us", F.floor(F.col("us") / 3_600_000_000) * 3_600_000_000)
    top = fixes.groupBy("series", "us").agg(F.round(F.max("lat"), 9).alias("fix_lat"))
    return tj.time_join(means.select("series", "us", F.round("nav_lat", 6).alias("mean_lat")), top, ["series", "us"])


AXES = """SELECT DISTINCT user_id % 20 AS mission, concat(event_type, CASE WHEN value > 60 THEN '_time' ELSE '_raw_time_60hz' END) AS axis FROM events WHERE value > 40"""


@query(
    "join12_match_axis",
    f"""WITH a AS ({AXES}), v AS (SELECT DISTINCT user_id % 20 AS mission, concat(event_type, CASE event_id % 3 WHEN 0 THEN '_raw_counts' ELSE '_depth' END) AS var FROM events),
    h AS (SELECT v.mission, var, axis, regexp_replace(axis, '_time(_60hz)?$', '') AS p FROM v JOIN a ON v.mission = a.mission AND starts_with(var, concat(regexp_replace(axis, '_time(_60hz)?$', ''), '_')))
    SELECT mission, var, max_by(axis, length(p)) AS axis FROM h GROUP BY mission, var""",
)
def join12(spark, sf):
    e = table(spark, sf, "events").withColumn("mission", F.col("user_id") % 20)
    suffix = F.when(F.col("value") > 60, "_time").otherwise("_raw_time_60hz")
    axes = e.where("value > 40").select("mission", F.concat("event_type", suffix).alias("axis")).distinct()
    ending = F.when(F.col("event_id") % 3 == 0, "_raw_counts").otherwise("_depth")
    return tj.match_axis(e.select("mission", F.concat("event_type", ending).alias("var")).distinct(), axes, ["mission"])


@query(
    "join13_axes_equal",
    """WITH p AS (SELECT a.series, a.us/1000000.0 AS x, a.us/1000000.0 + CASE WHEN a.series % 3 = 0 THEN 1 ELSE 0 END AS y, a.series % 7 = 0 AND a.seq % 11 = 0 AS gone FROM signal a)
    SELECT series, round(max(CASE WHEN gone THEN NULL ELSE abs(x - y) END), 6) AS max_gap, bool_and(NOT gone AND abs(x - y) <= 1e-10 * abs(y)) AS equal FROM p GROUP BY series""",
    ("signal",),
)
def join13(spark, sf):
    a = fx.signal_us(spark, sf).select("series", "seq", (F.col("us") / 1000000.0).alias("t"))
    b = a.withColumn("t", F.col("t") + F.when(F.col("series") % 3 == 0, 1).otherwise(0)).where("NOT (series % 7 = 0 AND seq % 11 = 0)")
    return tj.axes_equal(a, b, ["series"], "seq", "t").withColumn("max_gap", F.round("max_gap", 6))


@query(
    "join14_pick_serial",
    """WITH s AS (SELECT s_nationkey, s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS nth, count(*) OVER (PARTITION BY s_nationkey) AS n FROM supplier)
    SELECT s_nationkey, s_suppkey, n <> 2 AS ambiguous, CASE WHEN n = 2 THEN CASE nth WHEN 1 THEN 'port' ELSE 'stbd' END END AS side FROM s""",
)
def join14(spark, sf):
    return tj.pick_serial(table(spark, sf, "supplier").select("s_nationkey", "s_suppkey"), ["s_nationkey"], "s_suppkey")


@query(
    "join15_compare",
    f"""WITH a AS ({DAILY.format(t='click')}), b AS ({DAILY.format(t='error')})
    SELECT series, day, round(a.v, 6) AS a, round(b.v, 6) AS b, round(a.v - b.v, 6) AS difference FROM a FULL JOIN b USING (series, day)""",
)
def join15(spark, sf):
    out = tj.compare(daily(spark, sf, "click", "v"), daily(spark, sf, "error", "v"), ["series", "day"], "v")
    return out.withColumns({c: F.round(c, 6) for c in ("a", "b", "difference")})
