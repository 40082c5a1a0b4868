"""Queries for the cleaning operators and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import clean
from tidemark.operators.ordered import axis
from tidemark.registry import inputs as fx
from tidemark.registry.core import query
from tidemark.registry.inputs import table


@query(
    "cln1_keep_monotonic",
    """WITH m AS (SELECT *, max(us) OVER (PARTITION BY series ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM clock)
    SELECT series, seq, us, value FROM m WHERE seen IS NULL OR us > seen""",
    ("clock",),
)
def cln1(spark, sf):
    kept = clean.keep_monotonic(fx.clock(spark, sf), axis("series", "seq", 50_000))
    return kept.select("series", "seq", F.unix_micros("ts").alias("us"), "value")


@query(
    "cln2_in_window",
    """SELECT series, seq, us FROM clock JOIN customer ON series = c_custkey
    WHERE ts BETWEEN TIMESTAMP '1996-01-01' + INTERVAL 1 DAY * (c_nationkey * 30) - INTERVAL 10 MINUTE
      AND TIMESTAMP '1996-01-01' + INTERVAL 1 DAY * (c_nationkey * 30 + 900) + INTERVAL 10 MINUTE""",
    ("clock",),
)
def cln2(spark, sf):
    kept = clean.in_window(fx.clock(spark, sf), log_spans(spark, sf), ["series"], "ts", "10 MINUTES")
    return kept.select("series", "seq", F.unix_micros("ts").alias("us"))


@query(
    "cln2_window_counts",
    """WITH w AS (SELECT c_custkey, epoch_us(TIMESTAMP '1996-01-01' + INTERVAL 1 DAY * (c_nationkey * 30))/1e6 - 600 AS a, epoch_us(TIMESTAMP '1996-01-01' + INTERVAL 1 DAY * (c_nationkey * 30 + 900))/1e6 + 600 AS b FROM customer),
    t AS (SELECT series, CASE WHEN seq % 19 = 0 THEN NULL ELSE us/1e6 END AS t FROM clock)
    SELECT series, count(*) AS rows, count(*) FILTER (WHERE t IS NULL) AS missing, count(*) FILTER (WHERE t < a OR t > b) AS outside FROM t JOIN w ON c_custkey = series GROUP BY series""",
    ("clock",),
)
def cln2_counts(spark, sf):
    t = F.when(F.col("seq") % 19 == 0, F.lit(float("nan"))).otherwise(F.unix_micros("ts") / 1e6)
    return clean.window_counts(fx.clock(spark, sf).withColumn("t", t), log_spans(spark, sf), ["series"], "t")


def log_spans(spark, sf):
    start = F.lit("1996-01-01").cast("timestamp") + F.make_dt_interval(F.col("c_nationkey") * 30)
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("series"), start.alias("start"), (start + F.expr("INTERVAL 900 DAYS")).alias("end")
    )


@query(
    "cln3_drop_time_spikes",
    """WITH s AS (SELECT *, us/86400000000.0 AS t, count(*) OVER (PARTITION BY series) AS n FROM clock),
    d AS (SELECT *, t - lag(t) OVER w AS a, lead(t) OVER w - t AS b FROM s WINDOW w AS (PARTITION BY series ORDER BY seq)),
    m AS (SELECT series, median(a) AS med FROM d WHERE a IS NOT NULL GROUP BY series),
    k AS (SELECT d.series, median(abs(a - med)) AS mad FROM d JOIN m USING (series) WHERE a IS NOT NULL GROUP BY d.series)
    SELECT d.series, seq, us FROM d LEFT JOIN m USING (series) LEFT JOIN k USING (series)
    WHERE NOT coalesce(n >= 3 AND mad <> 0 AND 0.6745*abs(a-med)/nullif(mad, 0) > 2.0 AND a*b < 0 AND 0.6745*abs(b-med)/nullif(mad, 0) > 1.0, false)""",
    ("clock",),
)
def cln3(spark, sf):
    days = fx.clock(spark, sf).select(
        "series", "seq", F.unix_micros("ts").alias("us"), (F.unix_micros("ts") / 86400000000.0).alias("t")
    )
    return clean.drop_time_spikes(days, axis("series", "seq", 50_000), "t", 2.0).select("series", "seq", "us")


READINGS = """SELECT event_id // 1000 AS series, event_id // 5 AS seq, event_type AS var, value FROM events"""


def readings(spark, sf):
    return table(spark, sf, "events").select(
        F.floor(F.col("event_id") / 1000).alias("series"),
        F.floor(F.col("event_id") / 5).alias("seq"),
        F.col("event_type").alias("var"),
        "value",
    )


@query(
    "cln4_intersect_indices",
    f"""WITH r AS ({READINGS}),
    p AS (SELECT series, count(DISTINCT var) AS v FROM r GROUP BY series),
    h AS (SELECT series, seq, count(DISTINCT var) AS v FROM r GROUP BY series, seq)
    SELECT r.series, r.seq, r.var, r.value FROM r JOIN p USING (series) JOIN h ON h.series = r.series AND h.seq = r.seq
    WHERE p.v < 2 OR h.v = p.v""",
)
def cln4(spark, sf):
    return clean.intersect_indices(readings(spark, sf), ["series"], "seq", "var")


@query(
    "cln5_align_indices",
    """SELECT n.series, n.seq, n.lat, n.lon FROM nav n WHERE seq % 3 <> 0 AND seq % 5 <> 1""",
    ("nav",),
)
def cln5(spark, sf):
    n = fx.nav(spark, sf)
    lat = n.where("seq % 3 <> 0").select("series", "seq", "lat")
    lon = n.where("seq % 5 <> 1").select("series", "seq", "lon")
    return clean.align_indices(lat, lon, ["series", "seq"])


@query(
    "cln6_drop_bad_time",
    """SELECT event_id, ts_us FROM (SELECT event_id, CASE WHEN event_id % 97 = 0 THEN -1e21 ELSE CAST(epoch_us(ts) AS DOUBLE) END AS ts_us FROM events) q
    WHERE ts_us >= -1e20""",
)
def cln6(spark, sf):
    t = F.when(F.col("event_id") % 97 == 0, F.lit(-1e21)).otherwise(F.unix_micros(F.col("ts").cast("timestamp")).cast("double"))
    return clean.drop_bad_time(table(spark, sf, "events").select("event_id", t.alias("ts_us")), "ts_us")


LONG_LINES = """SELECT l_orderkey, l_linenumber, l_partkey, var, value FROM (
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS quantity, l_extendedprice AS price, l_tax*100 AS tax FROM lineitem) q
    UNPIVOT (value FOR var IN (quantity, price, tax)) u"""


@query(
    "cln7_range_qc_drop",
    f"""WITH l AS MATERIALIZED ({LONG_LINES}),
    rules(var, lo, hi) AS (VALUES ('quantity', 5.0, 45.0), ('price', 2000.0, 80000.0)),
    bad AS MATERIALIZED (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM l JOIN rules ON rules.var = l.var WHERE value < lo OR value > hi)
    SELECT l_orderkey, l_linenumber, l_partkey, var, round(value, 6) AS value FROM l WHERE NOT EXISTS (
      SELECT 1 FROM bad WHERE bad.l_orderkey = l.l_orderkey AND bad.l_linenumber = l.l_linenumber AND bad.l_partkey = l.l_partkey)""",
)
def cln7(spark, sf):
    key = ["l_orderkey", "l_linenumber", "l_partkey"]
    wide = table(spark, sf, "lineitem").select(
        *key, F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"), (F.col("l_tax") * 100).alias("tax")
    )
    long = wide.unpivot(key, ["quantity", "price", "tax"], "var", "value")
    rules = spark.createDataFrame([("quantity", 5.0, 45.0), ("price", 2000.0, 80000.0)], "var string, lo double, hi double")
    return clean.range_qc_drop(long, rules, key, "var", "value").withColumn("value", F.round("value", 6))


@query(
    "cln8_range_qc_null",
    """SELECT l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_quantity BETWEEN 5 AND 45 THEN l_quantity END AS l_quantity,
    CASE WHEN l_quantity BETWEEN 5 AND 45 AND l_extendedprice BETWEEN 2000 AND 80000 THEN l_extendedprice END AS l_extendedprice,
    CASE WHEN l_quantity BETWEEN 5 AND 45 AND l_extendedprice BETWEEN 2000 AND 80000 AND l_tax BETWEEN 0.01 AND 0.07 THEN l_tax END AS l_tax
    FROM lineitem""",
)
def cln8(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_tax")
    return clean.range_qc_null(df, {"l_quantity": (5, 45), "l_extendedprice": (2000, 80000), "l_tax": (0.01, 0.07)})


@query(
    "cln9_apply_rules",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey AND s_nationkey < 20
    WHERE s_suppkey IS NULL OR (l_quantity BETWEEN s_nationkey AND s_nationkey + 25 AND l_extendedprice BETWEEN s_acctbal AND s_acctbal + 50000)""",
)
def cln9(spark, sf):
    rules = table(spark, sf, "supplier").where("s_nationkey < 20").select(
        F.col("s_suppkey").alias("l_suppkey"),
        F.col("s_nationkey").alias("q_lo"),
        (F.col("s_nationkey") + 25).alias("q_hi"),
        F.col("s_acctbal").alias("p_lo"),
        (F.col("s_acctbal") + 50000).alias("p_hi"),
    )
    kept = clean.apply_rules(
        table(spark, sf, "lineitem"), rules, "l_suppkey", {"l_quantity": ("q_lo", "q_hi"), "l_extendedprice": ("p_lo", "p_hi")}
    )
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query(
    "cln10_sentinels",
    """SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_discount, 0.0) AS temp_frequency,
    CASE WHEN l_quantity*20 - 500 > -273 THEN l_quantity*20 - 500 END AS temperature,
    CASE WHEN l_quantity - 25 >= 0 THEN l_quantity - 25 END AS fluorescence,
    CASE WHEN l_tax = 0 THEN 350.0 ELSE l_tax END AS flow, CASE WHEN l_tax = 0 THEN 0.35 ELSE l_tax END AS flow_litre FROM lineitem""",
)
def cln10(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        clean.zero_to_null(F.col("l_discount")).alias("temp_frequency"),
        clean.frozen_to_null(F.col("l_quantity") * 20 - 500).alias("temperature"),
        clean.negative_to_null(F.col("l_quantity") - 25).alias("fluorescence"),
        clean.default_flow(F.col("l_tax")).alias("flow"),
        clean.default_flow(F.col("l_tax"), 0.35).alias("flow_litre"),
    )


OPTICS = """SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, nullif(l_discount, 0.03) AS blue, l_discount + l_tax AS red, l_tax/2 AS fluo FROM lineitem"""


def optics(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_suppkey",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.nullif(F.col("l_discount"), F.lit(0.03)).alias("blue"),
        (F.col("l_discount") + F.col("l_tax")).alias("red"),
        (F.col("l_tax") / 2).alias("fluo"),
    )


@query(
    "cln11_backscatter_qc",
    f"""WITH o AS ({OPTICS}) SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, CASE WHEN blue <= 0.1 THEN blue END AS blue,
    CASE WHEN red <= 0.1 THEN red END AS red, fluo FROM o""",
)
def cln11(spark, sf):
    return clean.backscatter_qc(optics(spark, sf), ["l_suppkey"], "blue", "red", "fluo")


@query(
    "cln11_backscatter_qc_legacy",
    f"""WITH o AS ({OPTICS}), a AS (SELECT l_suppkey, bool_or(blue IS NULL OR blue > 0.1) AND bool_or(red > 0.1) AND bool_or(fluo > 0.02) AS armed FROM o GROUP BY 1)
    SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, CASE WHEN NOT (armed AND (blue IS NULL OR blue > 0.1)) THEN blue END AS blue,
    CASE WHEN NOT (armed AND fluo > 0.02) THEN red END AS red, fluo FROM o JOIN a USING (l_suppkey)""",
)
def cln11_legacy(spark, sf):
    return clean.backscatter_qc(optics(spark, sf), ["l_suppkey"], "blue", "red", "fluo", legacy=True)


@query(
    "cln12_tidy_series",
    """WITH g AS (SELECT series, seq, us, value, row_number() OVER (PARTITION BY series, us ORDER BY seq) AS rn FROM clock
    WHERE value > 60000 AND ts BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-01-01') SELECT series, seq, us, value FROM g WHERE rn = 1""",
    ("clock",),
)
def cln12(spark, sf):
    df = fx.clock(spark, sf).withColumn("value", F.when(F.col("value") > 60000, F.col("value")))
    lo, hi = (F.lit(d).cast("timestamp") for d in ("1996-01-01", "2000-01-01"))
    tidy = clean.tidy_series(df, ["series"], "ts", "seq", "value", lo, hi)
    return tidy.select("series", "seq", F.unix_micros("ts").alias("us"), "value")


HOLES = """SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, nullif(l_discount, 0.05) AS depth, nullif(l_tax, 0.02) AS lat, l_quantity AS lon FROM lineitem"""


def holes(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_suppkey",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.nullif(F.col("l_discount"), F.lit(0.05)).alias("depth"),
        F.nullif(F.col("l_tax"), F.lit(0.02)).alias("lat"),
        F.col("l_quantity").alias("lon"),
    )


@query("cln13_drop_incomplete", f"SELECT * FROM ({HOLES}) q WHERE depth IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL")
def cln13(spark, sf):
    return clean.drop_incomplete(holes(spark, sf), ["depth", "lat", "lon"])


@query(
    "cln13_incomplete_share",
    f"""SELECT l_suppkey, count(*) FILTER (WHERE depth IS NULL OR lat IS NULL OR lon IS NULL) AS removed,
    round(100.0 * count(*) FILTER (WHERE depth IS NULL OR lat IS NULL OR lon IS NULL) / count(*), 6) AS percent FROM ({HOLES}) q GROUP BY 1""",
)
def cln13_share(spark, sf):
    share = clean.incomplete_share(holes(spark, sf), ["l_suppkey"], ["depth", "lat", "lon"])
    return share.withColumn("percent", F.round("percent", 6))


@query(
    "cln14_shift_clock",
    """SELECT seq, epoch_us(ts + INTERVAL 619315200 SECOND) AS us, strftime(ts + INTERVAL 619315200 SECOND, '%Y.%j') AS mission FROM signal""",
    ("signal",),
)
def cln14(spark, sf):
    moved = clean.shift_clock(fx.signal(spark, sf), "ts", 1024 * 7 * 86400)
    return moved.select("seq", F.unix_micros("ts").alias("us"), "mission")


@query(
    "cln15_dedupe_names",
    """WITH f AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS pos, l_shipdate, concat(l_returnflag, l_linestatus) AS name FROM lineitem),
    r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, name ORDER BY pos) AS nth FROM f)
    SELECT l_orderkey, pos, name, CASE WHEN nth > 1 THEN concat(name, nth) ELSE name END AS unique_name FROM r""",
)
def cln15(spark, sf):
    from pyspark.sql import Window

    pos = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    fields = table(spark, sf, "lineitem").select("l_orderkey", pos.alias("pos"), F.concat("l_returnflag", "l_linestatus").alias("name"))
    return clean.dedupe_fields(fields, ["l_orderkey"], "pos", "name")


@query(
    "cln16_stride",
    """SELECT series, seq, value FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY seq) - 1 AS pos FROM signal) q WHERE pos % 10 = 0""",
    ("signal",),
)
def cln16(spark, sf):
    return clean.stride(fx.signal(spark, sf).select("series", "seq", "value"), axis("series", "seq", 10_000), 10)


@query(
    "cln17_clock_sync",
    """WITH p AS (SELECT series, us/1000000.0 AS a, us/1000000.0 + CASE WHEN seq % 7 = 0 THEN series % 90 ELSE 0 END AS b FROM signal),
    s AS (SELECT series, round(avg(CASE WHEN abs(a - b) > 0 THEN 1.0 ELSE 0.0 END) * 100, 6) AS percent_diff, round(max(abs(a - b)), 6) AS max_diff FROM p GROUP BY series)
    SELECT *, CASE WHEN percent_diff > 50 OR max_diff > 3600 THEN 'major' WHEN percent_diff > 5 OR max_diff > 60 THEN 'minor' ELSE 'ok' END AS grade FROM s""",
    ("signal",),
)
def cln17(spark, sf):
    a = fx.signal_us(spark, sf).select("series", "seq", (F.col("us") / 1000000.0).alias("t"))
    b = a.withColumn("t", F.col("t") + F.when(F.col("seq") % 7 == 0, F.col("series") % 90).otherwise(0))
    return clean.clock_sync(a, b, ["series"], "seq", "t").withColumns(
        {"percent_diff": F.round("percent_diff", 6), "max_diff": F.round("max_diff", 6)}
    )


@query(
    "cln18_counter_wraps",
    """WITH c AS (SELECT series, idx, CASE idx % 50 WHEN 48 THEN 65535 WHEN 49 THEN 1 + CAST(floor(value) AS BIGINT) % 8 ELSE (idx % 50)*10 END AS counter FROM rate60),
    d AS (SELECT *, counter - lag(counter) OVER (PARTITION BY series ORDER BY idx) AS step FROM c)
    SELECT series, idx, counter + 65537 * count(*) FILTER (WHERE step > -65540 AND step < -65530) OVER (PARTITION BY series ORDER BY idx) AS counter FROM d""",
    ("rate60",),
)
def cln18_wraps(spark, sf):
    place = F.col("idx") % 50
    counter = F.when(place == 48, 65535).when(place == 49, 1 + F.floor("value") % 8).otherwise(place * 10)
    return clean.correct_counter_wraps(
        fx.rate60(spark, sf).select("series", "idx", counter.alias("counter")), axis("series", "idx", 700), "counter"
    )


@query(
    "cln19_clip_null",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice FROM lineitem WHERE l_quantity BETWEEN 5 AND 45 AND l_extendedprice BETWEEN 2000 AND 80000""",
)
def cln19(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    return clean.clip_null(df, {"l_quantity": (5, 45), "l_extendedprice": (2000, 80000)})


@query(
    "cln20_drop_garbled",
    """SELECT sec, label FROM (SELECT sec, label, list_transform(range(128), lambda i: CAST(floor(abs(samples[(i % 64) + 1]) * 4200) AS INT)) AS c FROM samples) q
    WHERE len(list_filter(c[102:128], lambda x: x > 1000)) = 0 AND label IN (0, 1)""",
    ("samples",),
)
def cln20(spark, sf):
    wide = F.concat("samples", "samples")
    frames = fx.samples(spark, sf).select(
        "sec", "label", F.transform(wide, lambda x: F.floor(F.abs(x) * 4200)).alias("counts"), F.lit(100).alias("threshold")
    )
    return clean.drop_garbled(frames, "counts", "threshold", "label").select("sec", "label")


@query(
    "cln21_filter",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_suppkey BETWEEN 10 AND 60 AND l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-01-01'
    AND NOT (l_quantity < 5 AND l_discount > 0.04)""",
)
def cln21(spark, sf):
    df = table(spark, sf, "lineitem").where("l_suppkey BETWEEN 10 AND 60")
    df = df.where(F.col("l_shipdate").between(F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1998-01-01").cast("timestamp_ntz")))
    return df.where(~((F.col("l_quantity") < 5) & (F.col("l_discount") > 0.04))).select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "prj1_to_degrees",
    """SELECT l_orderkey, l_linenumber, l_partkey, round(degrees(l_discount), 6) AS roll, round(degrees(l_tax), 6) AS yaw FROM lineitem""",
)
def prj1(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_discount").alias("roll"), F.col("l_tax").alias("platform_orientation")
    )
    return clean.to_degrees(df, ["roll", "platform_orientation"]).withColumns({"roll": F.round("roll", 6), "yaw": F.round("yaw", 6)})


@query(
    "prj2_fix_lon_sign",
    """WITH l AS (SELECT series, seq, (CASE WHEN series % 2 = 0 THEN -1 ELSE 1 END) * lon AS lon FROM nav)
    SELECT series, seq, round(CASE WHEN first_value(lon) OVER (PARTITION BY series ORDER BY seq) > 0 THEN -lon ELSE lon END, 6) AS lon FROM l""",
    ("nav",),
)
def prj2(spark, sf):
    df = fx.nav(spark, sf).select("series", "seq", (F.when(F.col("series") % 2 == 0, -1).otherwise(1) * F.col("lon")).alias("lon"))
    return clean.fix_lon_sign(df, ["series"], "lon", ["seq"]).select("series", "seq", F.round("lon", 6).alias("lon"))


@query(
    "prj3_relative",
    """SELECT series, seq, round(value - first_value(value) OVER (PARTITION BY series ORDER BY seq), 6) AS value FROM signal""",
    ("signal",),
)
def prj3(spark, sf):
    df = fx.signal(spark, sf).select("series", "seq", "value")
    return clean.relative(df, ["series"], ["value"], ["seq"]).withColumn("value", F.round("value", 6))


@query(
    "prj4_apply_lag",
    """SELECT event_id, event_type, epoch_us(ts) - CASE event_type WHEN 'click' THEN 500000 WHEN 'view' THEN 6000000 ELSE 0 END AS us FROM events""",
)
def prj4(spark, sf):
    lags = spark.createDataFrame([("click", 0.5), ("view", 6.0)], "event_type string, lag_secs double")
    df = table(spark, sf, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    return clean.apply_lag(df, lags, "event_type", "ts").select("event_id", "event_type", F.unix_micros("ts").alias("us"))


@query(
    "prj5_resolve_names",
    """WITH c AS (SELECT DISTINCT user_id AS mission, event_type AS var FROM events WHERE value > 100),
    r(var, rank) AS (VALUES ('purchase', 1), ('signup', 2), ('error', 3)) SELECT mission, arg_min(var, rank) AS variable FROM c JOIN r USING (var) GROUP BY mission""",
)
def prj5(spark, sf):
    names = table(spark, sf, "events").where("value > 100").select(F.col("user_id").alias("mission"), F.col("event_type").alias("var")).distinct()
    return clean.resolve_names(names, ["mission"], "var", ["purchase", "signup", "error"])


@query(
    "prj5_plain_name",
    """SELECT event_id, regexp_replace(concat(event_type, CASE event_id % 3 WHEN 0 THEN '_bin_mean_' WHEN 1 THEN '_bin_median_' ELSE '_' END, 'raw'), '_bin_(mean|median)_', '_') AS name FROM events""",
)
def prj5_plain(spark, sf):
    infix = F.when(F.col("event_id") % 3 == 0, "_bin_mean_").when(F.col("event_id") % 3 == 1, "_bin_median_").otherwise("_")
    name = F.concat("event_type", infix, F.lit("raw"))
    return table(spark, sf, "events").select("event_id", clean.plain_name(name).alias("name"))


LOGNAMES = """SELECT o_orderkey, concat(strftime(o_orderdate + INTERVAL 1 MINUTE * (o_orderkey % 1440), '%Y%m%d%H%M'), '_',
    strftime(o_orderdate + INTERVAL 1 MINUTE * (o_orderkey % 1440 + o_custkey % 600), '%Y%m%d%H%M'), '.nc4') AS name FROM orders"""


def log_names(spark, sf):
    start = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
    end = start + F.make_dt_interval(mins=(F.col("o_custkey") % 600).cast("int"))
    name = F.concat(F.date_format(start, "yyyyMMddHHmm"), F.lit("_"), F.date_format(end, "yyyyMMddHHmm"), F.lit(".nc4"))
    return table(spark, sf, "orders").select("o_orderkey", name.alias("name"))


@query(
    "prj6_name_times",
    f"""WITH n AS ({LOGNAMES}), p AS (SELECT *, strptime(substr(name, 1, 12), '%Y%m%d%H%M') AS a, strptime(substr(name, 14, 12), '%Y%m%d%H%M') AS b FROM n)
    SELECT o_orderkey, epoch_us(a) AS start_us, epoch_us(b) AS end_us, round((epoch_us(b) - epoch_us(a))/60000000.0, 6) AS minutes FROM p""",
)
def prj6(spark, sf):
    return clean.name_times(log_names(spark, sf), "name").select(
        "o_orderkey",
        F.unix_micros("log_start").alias("start_us"),
        F.unix_micros("log_end").alias("end_us"),
        F.round("minutes", 6).alias("minutes"),
    )
