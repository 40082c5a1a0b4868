"""Queries for the composite jobs and the stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import geo
from tidemark.operators.clean import keep_monotonic
from tidemark.operators.ordered import axis, durable
from tidemark.operators.resample import interpolate, median3, on_grid, resample_mean
from tidemark.plans import calibrate, grid, plankton, positions, products
from tidemark.registry import formulas as fm
from tidemark.registry import inputs as fx
from tidemark.registry.aggregates import HOUR_S, HOUR_US, NUDGE
from tidemark.registry.core import query
from tidemark.registry.inputs import DAY, table
from tidemark.registry.joins import NEIGHBOURS
from tidemark.registry.particles import MEPS
from tidemark.registry.signals import ENVELOPE, FLEET, NIGHTS, PEAK_SQL, SECT, TAPS_SQL, TRACK_SQL, TURNS, lowpass_sql, utm_sql
from tidemark.session import shared_folder
from tidemark.streaming import means as streaming

# --- JOB1 -----------------------------------------------------------------------------------

NUDGE_SQL = f"""g AS (SELECT series, us, seq, lat + CASE WHEN series % 17 = 0 AND seq % 10 = 0 THEN 2 ELSE 0 END AS lat, lon FROM gps WHERE series % 13 <> 0),
    {NEIGHBOURS.replace('gps g', 'g')}, s AS (SELECT *, t0 IS NOT NULL AND t1 IS NOT NULL AS inner_ FROM b WHERE t0 IS NULL OR t1 IS NULL OR t0 <> t1),
    e AS (SELECT series, t0, min(us) AS f, max(us) AS l, max(t1) AS t1, max(lat1) - arg_max(lat, us) AS rlat, max(lon1) - arg_max(lon, us) AS rlon, count(*) AS n FROM s WHERE inner_ GROUP BY series, t0),
    d AS (SELECT *, CASE WHEN (t1 - l)/1e6 > 36000 THEN 0 ELSE rlat END AS dlat, CASE WHEN (t1 - l)/1e6 > 36000 THEN 0 ELSE rlon END AS dlon FROM e),
    st AS (SELECT DISTINCT n.series, CASE WHEN n.series NOT IN (SELECT series FROM g) THEN 'no_fix' WHEN n.series IN (SELECT series FROM e WHERE abs(rlat) > 1 OR abs(rlon) > 1) THEN 'failed' ELSE 'nudged' END AS status FROM nav n)"""


def fixes(spark, sf):
    shift = F.when((F.col("series") % 17 == 0) & (F.col("seq") % 10 == 0), 2).otherwise(0)
    g = fx.gps(spark, sf).where("series % 13 <> 0").withColumn("lat", F.col("lat") + shift)
    return g.select("series", F.unix_micros("ts").alias("us"), "lat", "lon")


def dead_reckoned(spark, sf):
    return fx.nav(spark, sf).select("series", "seq", F.unix_micros("ts").alias("us"), "lat", "lon")


@query(
    "job1_nudge_positions",
    f"""WITH {NUDGE_SQL}, m AS (SELECT s.*, f, l, dlat, dlon FROM s JOIN st ON st.series = s.series AND st.status = 'nudged' LEFT JOIN d ON d.series = s.series AND d.t0 = s.t0 AND s.inner_)
    SELECT series, seq, us, round(CASE WHEN inner_ THEN lat + CASE WHEN f = l THEN dlat ELSE dlat*((us - f)/nullif(l - f, 0)::DOUBLE) END ELSE lat END, 9) AS lat,
    round(CASE WHEN inner_ THEN lon + CASE WHEN f = l THEN dlon ELSE dlon*((us - f)/nullif(l - f, 0)::DOUBLE) END ELSE lon END, 9) AS lon, 'nudged' AS status FROM m
    UNION ALL SELECT n.series, seq, us, round(lat, 9), round(lon, 9), status FROM nav n JOIN st ON st.series = n.series AND status <> 'nudged'""",
    ("nav", "gps"),
)
def job1(spark, sf):
    out, _ = positions.nudge_positions(dead_reckoned(spark, sf), fixes(spark, sf), ["series"], max_gap_s=36000, width=10 * DAY)
    return out.withColumns({"lat": F.round("lat", 9), "lon": F.round("lon", 9)})


@query(
    "job1_nudge_summary",
    f"""WITH {NUDGE_SQL} SELECT series, count(*) FILTER (WHERE n > 10) AS segments, round(sum((l - f)/1e6/60), 3) AS minutes, bool_or(abs(rlat) > 1 OR abs(rlon) > 1) AS failed FROM d GROUP BY series""",
    ("nav", "gps"),
)
def job1_summary(spark, sf):
    _, out = positions.nudge_positions(dead_reckoned(spark, sf), fixes(spark, sf), ["series"], max_gap_s=36000, width=10 * DAY)
    return out.withColumn("minutes", F.round("minutes", 3))


@query(
    "fn21_segment_drift",
    f"""WITH {NUDGE_SQL} SELECT d.series, d.t0 AS seg_start, n AS points, round(dlat, 9) AS lat_diff, round(dlon, 9) AS lon_diff,
    round(CASE WHEN l = f THEN 0 ELSE rlon*cos(radians(lat1))*60*185300/nullif((l - f)/1e6, 0) END, 4) AS u_drift, round(CASE WHEN l = f THEN 0 ELSE rlat*60*185300/nullif((l - f)/1e6, 0) END, 4) AS v_drift
    FROM d JOIN (SELECT series, us, lat AS lat1 FROM g) g1 ON g1.series = d.series AND g1.us = d.t1""",
    ("nav", "gps"),
)
def fn21_segments(spark, sf):
    _, seg = positions.nudge_segments(dead_reckoned(spark, sf), fixes(spark, sf), ["series"], max_gap_s=36000, width=10 * DAY)
    return seg.select(
        "series", "seg_start", "points", F.round("lat_diff", 9).alias("lat_diff"), F.round("lon_diff", 9).alias("lon_diff"),
        F.round("u_drift", 4).alias("u_drift"), F.round("v_drift", 4).alias("v_drift"),
    )


# --- JOB2 to JOB5 ---------------------------------------------------------------------------

MONOTONIC = """m AS (SELECT * FROM (SELECT *, max(us) OVER (PARTITION BY series ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM {src}) q WHERE seen IS NULL OR us > seen)"""

CTD_SQL = f"""raw AS (SELECT user_id AS series, event_id AS seq, epoch_us(ts) AS us, nullif(3200 + value*2, 3200) AS tf, 5900 + value AS cf, 1 + value/200 AS volts FROM events WHERE event_type <> 'view'),
    {MONOTONIC.format(src='raw')}, v AS (SELECT user_id AS series, epoch_us(ts) AS us, value AS pres FROM events WHERE event_type = 'view'),
    w AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY us) AS rn FROM m),
    p0 AS (SELECT w.*, v.us AS t0, v.pres AS q0 FROM w ASOF LEFT JOIN v ON w.series = v.series AND w.us >= v.us),
    p1 AS (SELECT p0.*, v.us AS t1, v.pres AS q1 FROM p0 ASOF LEFT JOIN v ON p0.series = v.series AND p0.us <= v.us),
    pp AS (SELECT *, CASE WHEN t0 IS NULL OR t1 IS NULL THEN coalesce(q0, q1) WHEN t0 = t1 THEN q0 ELSE q0 + (q1 - q0)*((us - t0)/nullif(t1 - t0, 0)::DOUBLE) END AS pres, ln(2999.5/tf) AS L FROM p1),
    tt AS (SELECT *, 1.0/(3.68121e-3 + 6.0e-4*L + 1.6e-5*L*L + 2.1e-6*L*L*L) - 273.15 AS temp, cf/1000 AS f FROM pp),
    cc AS (SELECT *, (-10.2 + (1.4 + (-1.2e-3 + 1.7e-4*f)*f)*f*f)/(10*(1 + 3.25e-6*temp - 9.57e-8*pres)) AS cond, temp*1.00024 AS t, pres AS p FROM tt),
    rr AS (SELECT *, cond*10/42.914 AS r FROM cc),
    ww AS (SELECT *, sqrt(r/((1 + p*{fm.power_sql('p', (2.070e-5, -6.370e-10, 3.989e-15))}/(1 + 3.426e-2*t + 4.464e-4*t*t + (4.215e-1 - 3.107e-3*t)*r))*{fm.power_sql('t', (0.6766097, 2.00564e-2, 1.104259e-4, -6.9698e-7, 1.0031e-9))})) AS w FROM rr),
    ss AS (SELECT *, {fm.power_sql('w', (0.0080, -0.1692, 25.3851, 14.0941, -7.0261, 2.7081))} + (t - 15)/(1 + 0.0162*(t - 15))*{fm.power_sql('w', (0.0005, -0.0056, -0.0066, -0.0375, 0.0636, -0.0144))} AS s0 FROM ww),
    ctd AS (SELECT series, seq, temp, cond, pres, volts, rn, CASE WHEN s0 BETWEEN 30 AND 40 THEN s0 END AS sal FROM ss), {fm.DENSITY_SQL}"""


@query(
    "job2_calibrate_ctd",
    f"""WITH {CTD_SQL}, o AS (SELECT *, CASE WHEN rn > 1 THEN (0.4*(volts - 0.5) + 0.01*exp(-0.03*temp))*exp(0.0017*temp + 1.35e-4*pres)*{fm.OXSAT} END AS o2 FROM rho)
    SELECT series, seq, round(temp, 6) AS temperature, round(cond, 6) AS conductivity, round(sal, 6) AS salinity, round(o2, 6) AS oxygen_mll, round(o2*1.4276*1e6/(rho*32), 5) AS oxygen_umolkg FROM o""",
)
def job2(spark, sf):
    raw, pres = ctd_input(spark, sf)
    out = calibrate.calibrate_ctd(raw, pres, ["series"], "us", "seq", fm.TEMP, fm.COND_G, fm.OWENS, width=10 * DAY, seq_width=2_000)
    return out.select(
        "series", "seq", *[F.round(c, 6).alias(c) for c in ("temperature", "conductivity", "salinity", "oxygen_mll")], F.round("oxygen_umolkg", 5).alias("oxygen_umolkg")
    )


def ctd_input(spark, sf):
    e = table(spark, sf, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp"))).withColumnRenamed("user_id", "series")
    raw = e.where("event_type <> 'view'").select(
        "series", F.col("event_id").alias("seq"), "us", (F.lit(3200) + F.col("value") * 2).alias("temp_frequency"),
        (F.lit(5900) + F.col("value")).alias("cond_frequency"), (F.lit(1) + F.col("value") / 200).alias("volts"),
    )
    return raw, e.where("event_type = 'view'").select("series", "us", F.col("value").alias("filtpres"))


SBE43 = dict(soc=0.42, offset=-0.49, a=-3.1e-3, b=1.6e-4, c=-2.4e-6, e=0.036)


@query(
    "job2_second_oxygen_and_beam",
    f"""WITH {CTD_SQL}, o AS (SELECT *, 0.42*(volts + 0.1 - 0.49)*(1.0 - 3.1e-3*temp + 1.6e-4*temp*temp - 2.4e-6*temp*temp*temp)*{fm.OXSAT}*exp(0.036*pres/(273.15 + temp)) AS o2, (volts - 0.006)/(4.701 - 0.006) AS tr FROM rho)
    SELECT series, seq, round(o2, 6) AS oxygen2_mll, round(o2*1.4276*1e6/(rho*32), 5) AS oxygen2_umolkg, round(tr, 6) AS transmittance, round(CASE WHEN tr > 0 THEN -1/0.25*ln(tr) END, 6) AS attenuation FROM o""",
)
def job2_more(spark, sf):
    raw, pres = ctd_input(spark, sf)
    raw = raw.withColumn("volts2", F.col("volts") + 0.1)
    out = calibrate.calibrate_ctd(
        raw, pres, ["series"], "us", "seq", fm.TEMP, fm.COND_G, fm.OWENS, width=10 * DAY, seq_width=2_000, sbe43=SBE43, beam="volts"
    )
    return out.select(
        "series", "seq", F.round("oxygen2_mll", 6).alias("oxygen2_mll"), F.round("oxygen2_umolkg", 5).alias("oxygen2_umolkg"),
        F.round("transmittance", 6).alias("transmittance"), F.round("attenuation", 6).alias("attenuation"),
    )


@query(
    "job3_calibrate_puck",
    """WITH e AS (SELECT user_id AS series, event_id AS seq, epoch_us(ts) AS us, value, event_type FROM events), raw AS (SELECT * FROM e WHERE event_type NOT IN ('view', 'click')),
    m AS (SELECT * FROM (SELECT *, max(us) OVER (PARTITION BY series ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM raw) q WHERE seen IS NULL OR us > seen),
    d AS (SELECT series, us, value AS v FROM e WHERE event_type = 'view'), p AS (SELECT series, us, value/10 AS v FROM e WHERE event_type = 'click'),
    a AS (SELECT m.*, d.us AS t0, d.v AS v0 FROM m ASOF LEFT JOIN d ON m.series = d.series AND m.us >= d.us),
    b AS (SELECT a.*, d.us AS t1, d.v AS v1 FROM a ASOF LEFT JOIN d ON a.series = d.series AND a.us <= d.us),
    c AS (SELECT b.*, p.us AS p0, p.v AS w0 FROM b ASOF LEFT JOIN p ON b.series = p.series AND b.us >= p.us),
    f AS (SELECT c.*, p.us AS p1, p.v AS w1 FROM c ASOF LEFT JOIN p ON c.series = p.series AND c.us <= p.us),
    g AS (SELECT *, CASE WHEN t0 IS NULL OR t1 IS NULL THEN coalesce(v0, v1) WHEN t0 = t1 THEN v0 ELSE v0 + (v1 - v0)*((us - t0)/nullif(t1 - t0, 0)::DOUBLE) END AS z,
      CASE WHEN p0 IS NULL OR p1 IS NULL THEN coalesce(w0, w1) WHEN p0 = p1 THEN w0 ELSE w0 + (w1 - w0)*((us - p0)/nullif(p1 - p0, 0)::DOUBLE) END AS pitch, 3.2e-6*(value*9 - 48) AS vol, 33 + value/100 AS sal FROM f)
    SELECT series, seq, round(vol, 9) AS vol, round(0.0121*(value - 50), 6) AS chl, round(0.09*(value/2 - 40), 6) AS cdom,
      round(2*pi()*1.1*(vol - 1.38*pow(700/500.0, -4.32)*(1 + 0.3*sal/37)*1e-4*(1 + pow(cos(117.0/57.29578), 2)*(1 - 0.09)/(1 + 0.09))), 9) AS bbp,
      round(z - (0.1397*sin(radians(pitch)) - 0.2794*cos(radians(pitch))), 6) AS depth FROM g""",
)
def job3_puck(spark, sf):
    e = table(spark, sf, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp"))).withColumnRenamed("user_id", "series")
    v = F.col("value")
    raw = e.where("event_type NOT IN ('view', 'click')").select(
        "series", F.col("event_id").alias("seq"), "us", (v * 9).alias("vol_counts"), v.alias("chl_counts"), (v / 2).alias("cdom_counts"), (33 + v / 100).alias("salinity")
    )
    depths = e.where("event_type = 'view'").select("series", "us", v.alias("filtdepth"))
    pitches = e.where("event_type = 'click'").select("series", "us", (v / 10).alias("pitch"))
    scales = {"vol": (3.2e-6, 48), "chl": (0.0121, 50), "cdom": (0.09, 40)}
    out = calibrate.calibrate_puck(raw, ["series"], "us", "seq", scales, 700, depths, pitches, (0.1397, -0.2794), 10 * DAY, 2_000)
    digits = {"vol": 9, "chl": 6, "cdom": 6, "bbp": 9, "depth": 6}
    return out.select("series", "seq", *[F.round(c, n).alias(c) for c, n in digits.items()])


def channel_sql(n, wave, exponent):
    return f"""2*pi()*1.08*(exp({exponent}*({fm.absorption_sql(wave)} + 0.4*(2*pi()*1.08*(beta{n} - 2.18e-4*pow(525/{wave}.0, 4.32)))/0.015))*beta{n} - 2.18e-4*pow(525/{wave}.0, 4.32))"""


@query(
    "job3_calibrate_optics",
    f"""WITH {MONOTONIC.format(src='clock')}, r AS (SELECT series, seq, CAST(floor(value) AS BIGINT) % 400 AS s1, (CAST(floor(value) AS BIGINT) // 7) % 300 AS s2, CAST(floor(value) AS BIGINT) % 65536 AS s3, 2 + seq % 4 AS g, seq % 250 AS tr FROM m),
    k AS (SELECT *, 4871.0*(1 - 1.2e-3*((tr/5 - 10) - 19.0)) AS warm, CASE g WHEN 2 THEN 9.8 WHEN 3 THEN 97.5 WHEN 4 THEN 985.0 WHEN 5 THEN 10050.0 END AS gain FROM r),
    h AS (SELECT *, s1*4.3/(warm*gain) AS beta1, s2*4.3/(warm*gain) AS beta2, CASE WHEN s3 > 32767 THEN s3 - 65536 ELSE s3 END*50/(warm*gain) AS fl FROM k),
    b AS (SELECT series, seq, {channel_sql(1, 420, 0.1486)} AS b1, {channel_sql(2, 700, 0.1522)} AS b2, fl FROM h)
    SELECT series, seq, round(CASE WHEN b1 <= 0.1 THEN b1 END, 6) AS bbp_blue, round(CASE WHEN b2 <= 0.1 THEN b2 END, 6) AS bbp_red, round(fl, 6) AS fl FROM b""",
    ("clock",),
)
def job3(spark, sf):
    v = F.floor("value")
    raw = fx.clock(spark, sf).select(
        "series", "seq", F.unix_micros("ts").alias("us"), (v % 400).alias("snorm1"), (F.floor(v / 7) % 300).alias("snorm2"), (v % 65536).alias("snorm3"),
        *[(2 + F.col("seq") % 4).cast("int").alias(f"gain{i}") for i in (1, 2, 3)], (F.col("seq") % 250).alias("temp_raw"),
    )
    blue, red = dict(fm.HS2, wavelength=420, sigma_exp=0.1486), dict(fm.HS2, wavelength=700, sigma_exp=0.1522)
    fluo = dict(temp_coeff=-1.2e-3, cal_temp=19.0, gains=fm.GAINS, nominal=4871.0)
    out = calibrate.calibrate_optics(raw, ["series"], "us", "seq", blue, red, fluo, seq_width=50_000)
    return out.select("series", "seq", *[F.round(c, 6).alias(c) for c in ("bbp_blue", "bbp_red", "fl")])


@query(
    "job3_optics_at_depth",
    f"""WITH e AS (SELECT user_id AS series, event_id AS seq, epoch_us(ts) AS us, value, event_type FROM events), raw AS (SELECT * FROM e WHERE event_type NOT IN ('view', 'click')),
    m AS (SELECT * FROM (SELECT *, max(us) OVER (PARTITION BY series ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM raw) q WHERE seen IS NULL OR us > seen),
    d AS (SELECT series, us, value AS v FROM e WHERE event_type = 'view'), p AS (SELECT series, us, value/10 AS v FROM e WHERE event_type = 'click'),
    a AS (SELECT m.*, d.us AS t0, d.v AS v0 FROM m ASOF LEFT JOIN d ON m.series = d.series AND m.us >= d.us),
    b AS (SELECT a.*, d.us AS t1, d.v AS v1 FROM a ASOF LEFT JOIN d ON a.series = d.series AND a.us <= d.us),
    c AS (SELECT b.*, p.us AS p0, p.v AS w0 FROM b ASOF LEFT JOIN p ON b.series = p.series AND b.us >= p.us),
    f AS (SELECT c.*, p.us AS p1, p.v AS w1 FROM c ASOF LEFT JOIN p ON c.series = p.series AND c.us <= p.us),
    g AS (SELECT *, CASE WHEN t0 IS NULL OR t1 IS NULL THEN coalesce(v0, v1) WHEN t0 = t1 THEN v0 ELSE v0 + (v1 - v0)*((us - t0)/nullif(t1 - t0, 0)::DOUBLE) END AS z,
      CASE WHEN p0 IS NULL OR p1 IS NULL THEN coalesce(w0, w1) WHEN p0 = p1 THEN w0 ELSE w0 + (w1 - w0)*((us - p0)/nullif(p1 - p0, 0)::DOUBLE) END AS pitch FROM f),
    r AS (SELECT series, seq, z, pitch, CAST(floor(value) AS BIGINT) % 400 AS s1, (CAST(floor(value) AS BIGINT) // 7) % 300 AS s2, CAST(floor(value) AS BIGINT) % 65536 AS s3, 2 + seq % 4 AS g, seq % 250 AS tr FROM g),
    k AS (SELECT *, 4871.0*(1 - 1.2e-3*((tr/5 - 10) - 19.0)) AS warm, CASE g WHEN 2 THEN 9.8 WHEN 3 THEN 97.5 WHEN 4 THEN 985.0 WHEN 5 THEN 10050.0 END AS gain FROM r),
    h AS (SELECT *, s1*4.3/(warm*gain) AS beta1, s2*4.3/(warm*gain) AS beta2, CASE WHEN s3 > 32767 THEN s3 - 65536 ELSE s3 END*50/(warm*gain) AS fl FROM k),
    q AS (SELECT series, seq, z, pitch, {channel_sql(1, 420, 0.1486)} AS b1, {channel_sql(2, 700, 0.1522)} AS b2, fl FROM h)
    SELECT series, seq, round(CASE WHEN b1 <= 0.1 THEN b1 END, 6) AS bbp_blue, round(CASE WHEN b2 <= 0.1 THEN b2 END, 6) AS bbp_red, round(fl, 6) AS fl,
      round(z - (0.1397*sin(radians(pitch)) - 0.2794*cos(radians(pitch))), 6) AS depth FROM q""",
)
def job3_optics_at_depth(spark, sf):
    e = table(spark, sf, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp"))).withColumnRenamed("user_id", "series")
    v = F.floor("value")
    raw = e.where("event_type NOT IN ('view', 'click')").withColumnRenamed("event_id", "seq").select(
        "series", "seq", "us", (v % 400).alias("snorm1"), (F.floor(v / 7) % 300).alias("snorm2"), (v % 65536).alias("snorm3"),
        *[(2 + F.col("seq") % 4).cast("int").alias(f"gain{i}") for i in (1, 2, 3)], (F.col("seq") % 250).alias("temp_raw"),
    )
    depths = e.where("event_type = 'view'").select("series", "us", F.col("value").alias("filtdepth"))
    pitches = e.where("event_type = 'click'").select("series", "us", (F.col("value") / 10).alias("pitch"))
    blue, red = dict(fm.HS2, wavelength=420, sigma_exp=0.1486), dict(fm.HS2, wavelength=700, sigma_exp=0.1522)
    fluo = dict(temp_coeff=-1.2e-3, cal_temp=19.0, gains=fm.GAINS, nominal=4871.0)
    place = (depths, pitches, (0.1397, -0.2794))
    out = calibrate.calibrate_optics(raw, ["series"], "us", "seq", blue, red, fluo, seq_width=2_000, place=place, width=10 * DAY)
    return out.select("series", "seq", *[F.round(c, 6).alias(c) for c in ("bbp_blue", "bbp_red", "fl", "depth")])


@query(
    "job4_calibrate_navigation",
    f"""WITH {MONOTONIC.format(src='clock')}, d AS (SELECT series, seq, us, degrees(radians(36 + value % 1000/500)) AS lat, (CASE WHEN series % 2 = 0 THEN -1 ELSE 1 END)*degrees(radians(121 + value % 100/50)) AS lon, degrees(value % 7/10) AS yaw FROM m),
    g AS (SELECT *, CASE WHEN first_value(lon) OVER (PARTITION BY series ORDER BY us) > 0 THEN -lon ELSE lon END AS west FROM d)
    SELECT series, seq, round(lat, 6) AS lat, round(west, 6) AS lon, round(yaw, 6) AS yaw FROM g WHERE lat BETWEEN 36.2 AND 37.5 AND west BETWEEN -122.8 AND -121.3""",
    ("clock",),
)
def job4(spark, sf):
    v = F.col("value")
    side = F.when(F.col("series") % 2 == 0, -1).otherwise(1)
    raw = fx.clock(spark, sf).select(
        "series", "seq", F.unix_micros("ts").alias("us"), F.radians(36 + v % 1000 / 500).alias("lat"), (side * F.radians(121 + v % 100 / 50)).alias("lon"),
        F.lit(0.1).alias("roll"), F.lit(0.2).alias("pitch"), (v % 7 / 10).alias("platform_orientation"),
    )
    out = calibrate.calibrate_navigation(raw, ["series"], "us", "seq", {"lat": (36.2, 37.5), "lon": (-122.8, -121.3)}, 50_000)
    return out.select("series", "seq", *[F.round(c, 6).alias(c) for c in ("lat", "lon", "yaw")])


@query(
    "job4_navigation_metres",
    f"""WITH {MONOTONIC.format(src='clock')}, d AS (SELECT series, seq, us, 36 + value % 1000/500 AS lat, -121 - value % 100/50 AS lon, value % 1000 - first_value(value % 1000) OVER (PARTITION BY series ORDER BY us) AS x FROM m)
    SELECT series, seq, round(lat, 6) AS lat, round(lon, 6) AS lon, round(x, 6) AS x FROM d LEFT JOIN supplier ON s_suppkey = series
    WHERE lat BETWEEN 36.2 AND 37.5 AND lon BETWEEN -122.8 AND -121.3 AND (s_suppkey IS NULL OR lat BETWEEN 36 + s_nationkey/50.0 AND 37 + s_nationkey/50.0)""",
    ("clock",),
)
def job4_metres(spark, sf):
    v = F.col("value")
    east, north = geo.utm_forward(36 + v % 1000 / 500, -121 - v % 100 / 50, F.lit(10))
    raw = fx.clock(spark, sf).select(
        "series", "seq", F.unix_micros("ts").alias("us"), east.alias("east"), north.alias("north"), (v % 1000).alias("x"),
        *[F.lit(0.1).alias(c) for c in ("roll", "pitch", "platform_orientation")],
    )
    low = F.col("s_nationkey") / 50.0
    rules = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("series"), (36 + low).alias("low"), (37 + low).alias("high"))
    box = {"lat": (36.2, 37.5), "lon": (-122.8, -121.3)}
    out = calibrate.calibrate_navigation(
        raw, ["series"], "us", "seq", box, 50_000, ("east", "north", 10), ["x"], (rules, "series", {"lat": ("low", "high")})
    )
    return out.select("series", "seq", *[F.round(c, 6).alias(c) for c in ("lat", "lon", "x")])


_C = "(1 - (5.92e-3 + pow(sin(radians(36.0)), 2) * 5.25e-3))"


@query(
    "job4_calibrate_depth",
    f"""WITH {TAPS_SQL}, deep AS (SELECT series, idx, depth, ({_C} - sqrt({_C}*{_C} - 8.84e-6*depth))/4.42e-6 AS pressure FROM track),
    {lowpass_sql("fd", "deep", "depth")}, {lowpass_sql("fp", "deep", "pressure")}
    SELECT d.series, d.idx, round(pressure, 6) AS pressure, round(fd.v, 6) AS filtdepth, round(fp.v, 6) AS filtpres
    FROM deep d JOIN fd ON fd.series = d.series AND fd.idx = d.idx JOIN fp ON fp.series = d.series AND fp.idx = d.idx""",
    ("track",),
)
def job4_depth(spark, sf):
    raw = fx.track(spark, sf).withColumn("us", F.col("idx") * 100_000)
    out = calibrate.calibrate_depth(raw, ["series"], "us", "idx", size=5_000, seq_width=700)
    return out.select("series", "idx", *[F.round(c, 6).alias(c) for c in ("pressure", "filtdepth", "filtpres")])


@query(
    "job5_calibrate_flow",
    f"""WITH c2 AS (SELECT c.*, o_orderstatus AS instr FROM clock c JOIN orders ON o_orderkey = seq), {MONOTONIC.format(src='c2')}
    SELECT series, seq, us - CASE instr WHEN 'F' THEN 500000 WHEN 'O' THEN 6000000 ELSE 0 END AS us, instr, round(value/1000*CASE WHEN ts < TIMESTAMP '1998-06-29' THEN 0.45 ELSE 0.449 END, 9) AS flow FROM m""",
    ("clock",),
)
def job5(spark, sf):
    raw = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("series"), F.col("o_orderkey").alias("seq"), F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("us"),
        F.col("o_orderstatus").alias("instr"), (F.col("o_totalprice") / 1000).alias("rpm"), F.col("o_orderdate").cast("timestamp").alias("start"),
    )
    lags = spark.createDataFrame([("F", 0.5), ("O", 6.0)], "instr string, lag_secs double")
    conversions = spark.sql("SELECT * FROM VALUES (TIMESTAMP '1990-01-01', 0.45D), (TIMESTAMP '1998-06-29', 0.449D) AS t(valid_from, conversion)")
    out = calibrate.calibrate_flow(raw, ["series"], "us", "seq", lags, conversions, "start", 50_000)
    return out.select("series", "seq", "us", "instr", F.round("flow", 9).alias("flow"))


@query(
    "job7_padded_variables",
    """WITH e AS (SELECT user_id % 10 AS mission, event_type AS instr, epoch_us(ts) AS us, value, event_id FROM events),
    o AS (SELECT *, lag(value) OVER w AS p, lead(value) OVER w AS n FROM e WINDOW w AS (PARTITION BY mission, instr ORDER BY us)),
    f AS (SELECT mission, instr, us, CASE WHEN p IS NOT NULL AND n IS NOT NULL THEN greatest(least(p, value), least(greatest(p, value), n)) END AS v FROM o),
    i AS (SELECT mission, instr, max(us) AS last FROM e GROUP BY ALL), x AS (SELECT mission, min(us) // 3600000000 AS s, max(us) // 3600000000 AS t, max(us) AS last FROM e GROUP BY mission),
    g AS (SELECT i.mission, instr, unnest(range(s, t + 1)) AS h, x.last - i.last > 300000000 AS pad FROM i JOIN x USING (mission)),
    m AS (SELECT mission, instr, (us + 1800000000) // 3600000000 AS h, avg(v) AS value FROM f GROUP BY ALL)
    SELECT g.mission, g.instr, g.h * 3600000000 AS us, round(m.value + 2e-8, 6) AS value, pad FROM g LEFT JOIN m ON g.mission = m.mission AND g.instr = m.instr AND g.h = m.h""",
)
def job7_padded(spark, sf):
    readings = table(spark, sf, "events").select(
        (F.col("user_id") % 10).alias("mission"), F.col("event_type").alias("instr"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "value"
    )
    out = grid.resample_padded(readings, ["mission"], "instr", "us", "value", HOUR_S, 10 * DAY)
    return out.select("mission", "instr", "us", F.round(F.col("value") + NUDGE, 6).alias("value"), "pad")


# --- JOB6 and JOB7 --------------------------------------------------------------------------


def asof_lerp(left, right, cols, out):
    """Linear interpolation with held ends by two as-of joins; rows of ``left`` have series and us."""
    a = ", ".join(f"r.{c} AS {c}_0" for c in cols)
    b = ", ".join(f"r.{c} AS {c}_1" for c in cols)
    lerp = ", ".join(
        f"CASE WHEN t_0 IS NULL OR t_1 IS NULL THEN coalesce({c}_0, {c}_1) WHEN t_0 = t_1 THEN {c}_0 ELSE {c}_0 + ({c}_1 - {c}_0)*((us - t_0)/nullif(t_1 - t_0, 0)::DOUBLE) END AS {c}" for c in cols
    )
    drop = ", ".join(["t_0", "t_1", *[f"{c}_{i}" for c in cols for i in (0, 1)]])
    return f"""{out}_a AS (SELECT l.*, r.us AS t_0, {a} FROM {left} l ASOF LEFT JOIN {right} r ON l.series = r.series AND l.us >= r.us),
    {out}_b AS (SELECT l.*, r.us AS t_1, {b} FROM {out}_a l ASOF LEFT JOIN {right} r ON l.series = r.series AND l.us <= r.us),
    {out} AS (SELECT * EXCLUDE ({drop}), {lerp} FROM {out}_b)"""


ALIGN_IN = """rd AS (SELECT user_id AS series, event_type AS instr, event_id AS seq, epoch_us(ts) AS us, value FROM events WHERE event_type NOT IN ('view', 'signup')),
    dp AS (SELECT user_id AS series, epoch_us(ts) AS us, value AS depth FROM events WHERE event_type = 'view')"""


@query(
    "job6_align",
    f"""WITH {ALIGN_IN}, gp AS (SELECT series, us, lat, lon FROM gps), {asof_lerp('rd', 'dp', ['depth'], 'x1')}, {asof_lerp('x1', 'gp', ['lat', 'lon'], 'x2')}
    SELECT series, instr, seq, round(depth, 6) AS depth, round(lat, 9) AS lat, round(lon, 9) AS lon FROM x2""",
    ("gps",),
)
def job6(spark, sf):
    e = table(spark, sf, "events").select(
        F.col("user_id").alias("series"), F.col("event_type").alias("instr"), F.col("event_id").alias("seq"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "value"
    )
    depths = e.where("instr = 'view'").select("series", "us", F.col("value").alias("depth"))
    nav = fx.gps(spark, sf).select("series", F.unix_micros("ts").alias("us"), "lat", "lon")
    out = grid.align(e.where("instr NOT IN ('view', 'signup')"), depths, nav, ["series"], width=10 * DAY)
    return out.select("series", "instr", "seq", F.round("depth", 6).alias("depth"), F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"))


VARIABLES = ("ctd1_temperature", "ctd1_salinity", "hs2_bb", "navigation_pitch", "navigation_depth", "gps_latitude", "nudged_longitude", "biolume_raw")
VAR_SQL = "CASE event_id % 8 " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(VARIABLES)) + " END"


@query(
    "job6_align_variables",
    f"""WITH e AS (SELECT user_id AS u, event_type, event_id, epoch_us(ts) AS us, value AS depth FROM events),
    dv AS (SELECT u, CASE WHEN event_id % 2 = 1 THEN 'depth' WHEN u % 3 = 0 THEN 'hs2' ELSE 'ctd1' END AS instr, us, depth FROM e WHERE event_type = 'view'),
    av AS (SELECT u, {VAR_SQL} AS var, event_id AS seq, us FROM e WHERE event_type NOT IN ('view', 'signup') AND event_id % 8 NOT IN (4, 5, 6)),
    sv AS (SELECT av.*, split_part(var, '_', 1) AS instr FROM av),
    kv AS (SELECT sv.*, concat(sv.u, ':', coalesce(d.instr, 'depth')) AS series FROM sv LEFT JOIN (SELECT DISTINCT u, instr FROM dv WHERE instr <> 'depth') d ON d.u = sv.u AND d.instr = sv.instr),
    dp AS (SELECT concat(u, ':', instr) AS series, us, depth FROM dv), {asof_lerp('kv', 'dp', ['depth'], 'x1')},
    y1 AS (SELECT u AS series, var, instr, seq, us, depth FROM x1), gp AS (SELECT series, us, lat, lon FROM gps), {asof_lerp('y1', 'gp', ['lat', 'lon'], 'x2')}
    SELECT series, var, instr, seq, round(depth, 6) AS depth, round(lat, 9) AS lat, round(lon, 9) AS lon FROM x2""",
    ("gps",),
)
def job6_variables(spark, sf):
    """Coordinates are left out; a sensor's own depth, or else the filtered one."""
    e = table(spark, sf, "events").select(
        F.col("user_id").alias("series"), "event_type", F.col("event_id").alias("seq"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "value"
    )
    own = F.when(F.col("seq") % 2 == 1, "depth").when(F.col("series") % 3 == 0, "hs2").otherwise("ctd1")
    depths = e.where("event_type = 'view'").select("series", own.alias("instr"), "us", F.col("value").alias("depth"))
    var = F.array(*map(F.lit, VARIABLES))[(F.col("seq") % 8).cast("int")]
    readings = e.where("event_type NOT IN ('view', 'signup')").select("series", var.alias("var"), "seq", "us")
    nav = fx.gps(spark, sf).select("series", F.unix_micros("ts").alias("us"), "lat", "lon")
    out = grid.align_variables(readings, depths, nav, ["series"], width=10 * DAY)
    return out.select("series", "var", "instr", "seq", F.round("depth", 6).alias("depth"), F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"))


def coordinate_sql(cols, src, out):
    """Median of three with filled ends, centred hourly means, dense grid, gaps up to three filled."""
    med = ", ".join(f"CASE WHEN count({c}) OVER w = 3 THEN median({c}) OVER w END AS {c}" for c in cols)
    ends = ", ".join(
        f"coalesce(first_value({c} IGNORE NULLS) OVER (PARTITION BY series ORDER BY us ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), last_value({c} IGNORE NULLS) OVER (PARTITION BY series ORDER BY us)) AS {c}"
        for c in cols
    )
    avg = ", ".join(f"avg({c}) AS {c}" for c in cols)
    near = ", ".join(
        f"last_value({c} IGNORE NULLS) OVER p AS {c}_0, first_value({c} IGNORE NULLS) OVER f AS {c}_1, last_value(CASE WHEN {c} IS NOT NULL THEN h END IGNORE NULLS) OVER p AS {c}_h0, first_value(CASE WHEN {c} IS NOT NULL THEN h END IGNORE NULLS) OVER f AS {c}_h1"
        for c in cols
    )
    fill = ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN h - {c}_h0 <= 3 THEN CASE WHEN {c}_1 IS NULL THEN {c}_0 ELSE {c}_0 + ({c}_1 - {c}_0)*((h - {c}_h0)/({c}_h1 - {c}_h0)::DOUBLE) END END AS {c}" for c in cols
    )
    whole = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    return f"""{out}_m AS (SELECT series, us, {med} FROM {src} WINDOW w AS (PARTITION BY series ORDER BY us ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)),
    {out}_e AS (SELECT series, us, {ends} FROM {out}_m), {out}_a AS (SELECT series, (us + 1800000000)//3600000000 AS h, {avg} FROM {out}_e GROUP BY ALL),
    {out}_g AS (SELECT series, unnest(range(min(h), max(h) + 1)) AS h FROM {out}_a GROUP BY series),
    {out}_d AS (SELECT g.series, g.h, a.* EXCLUDE (series, h) FROM {out}_g g LEFT JOIN {out}_a a ON a.series = g.series AND a.h = g.h),
    {out}_n AS (SELECT *, {near} FROM {out}_d WINDOW p AS (PARTITION BY series ORDER BY h), f AS (PARTITION BY series ORDER BY h ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    {out} AS (SELECT series, h*3600000000 AS us, {fill} FROM {out}_n WHERE true), {out}_ok AS (SELECT * FROM {out} WHERE {whole})"""


@query(
    "job6_summary",
    f"""WITH {ALIGN_IN} SELECT series, instr, min(us) AS min_us, max(us) AS max_us, round((max(us) - min(us))/1e6, 6) AS duration, round((count(*) - 1)/nullif((max(us) - min(us))/3.6e9, 0), 2) AS per_hour FROM rd GROUP BY ALL""",
)
def job6_summary(spark, sf):
    e = table(spark, sf, "events").select(
        F.col("user_id").alias("series"), F.col("event_type").alias("instr"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us")
    )
    out = grid.summary(e.where("instr NOT IN ('view', 'signup')"), ["series", "instr"], "us", [], per_s=3600.0)
    return out.withColumnRenamed("rate", "per_hour").withColumn("duration", F.round("duration", 6))


@query(
    "job7_resample",
    f"""WITH {coordinate_sql(['value'], 'signal', 'c')} SELECT series, us, round(value + {NUDGE}, 6) AS value FROM c_ok""",
    ("signal",),
)
def job7(spark, sf):
    """Monotonic clock, median of three, centred hourly means, gaps of up to three hours filled."""
    ax = axis("series", "seq", 5_000)
    rising = keep_monotonic(fx.signal_us(spark, sf), ax, "us").select("series", "us", "value")
    smooth = median3(durable(rising), axis("series", "us", 10 * DAY), ["value"], fill_ends=True)
    means = resample_mean(smooth, ["series"], "us", ["value"], HOUR_S)
    dense = durable(on_grid(means, ["series"], "us", HOUR_S, 10 * DAY))
    filled = interpolate(dense, ["series"], "us", ["value"], HOUR_US, 3, 10 * DAY).dropna(subset=["value"])
    return filled.select("series", "us", F.round(F.col("value") + NUDGE, 6).alias("value"))


SCIENCE = f"""co AS (SELECT user_id % 10 AS series, epoch_us(ts) AS us, value AS depth, 36.8 + value/10000 AS lat, -122.0 - value/20000 AS lon FROM events),
    {coordinate_sql(['depth', 'lat', 'lon'], 'co', 'c')}, track AS (SELECT CAST(series AS VARCHAR) AS series, us, row_number() OVER (PARTITION BY series ORDER BY us) - 1 AS idx, depth FROM c_ok), {TURNS},
    e AS (SELECT series, max(idx) AS idx, arg_max(depth, idx) AS depth FROM track GROUP BY series),
    s AS (SELECT series, idx, abs(lead(depth) OVER (PARTITION BY series ORDER BY idx) - depth) > 10 AS flag FROM (SELECT series, idx, depth FROM turns UNION ALL SELECT * FROM e) q),
    pn AS (SELECT CAST(t.series AS BIGINT) AS series, t.us, CAST(1 + count(s.idx) AS INT) AS profile_number FROM track t LEFT JOIN s ON s.series = t.series AND s.idx < t.idx AND s.flag GROUP BY ALL),
    rd AS (SELECT user_id % 10 AS series, event_type AS var, epoch_us(ts) AS us, value FROM events WHERE event_type IN ('click', 'error')),
    mv AS (SELECT series, var, us, CASE WHEN count(value) OVER w = 3 THEN median(value) OVER w END AS value FROM rd WINDOW w AS (PARTITION BY series, var ORDER BY us ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)),
    wv AS (SELECT series, (us + 1800000000)//3600000000*3600000000 AS us, avg(CASE WHEN var = 'click' THEN value END) AS click, avg(CASE WHEN var = 'error' THEN value END) AS error FROM mv GROUP BY ALL)"""


@query(
    "job7_science_grid",
    f"""WITH {SCIENCE} SELECT c.series, c.us, round(depth + {NUDGE}, 6) AS depth, round(lat + 3e-9, 7) AS lat, round(lon + 3e-9, 7) AS lon, profile_number, round(click + {NUDGE}, 6) AS click, round(error + {NUDGE}, 6) AS error
    FROM c_ok c JOIN pn ON pn.series = c.series AND pn.us = c.us LEFT JOIN wv ON wv.series = c.series AND wv.us = c.us""",
)
def job7_grid(spark, sf):
    e = table(spark, sf, "events").select(
        (F.col("user_id") % 10).alias("series"), F.col("event_type").alias("var"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "value"
    )
    coordinates = e.select(
        "series", "us", F.col("value").alias("depth"), (F.lit(36.8) + F.col("value") / 10000).alias("lat"), (F.lit(-122.0) - F.col("value") / 20000).alias("lon")
    )
    out = grid.resample(coordinates, e.where("var IN ('click', 'error')"), ["series"], "us", ["click", "error"], seconds=HOUR_S, width=10 * DAY, size=200)
    return out.select(
        "series", "us", "profile_number", *[F.round(F.col(c) + NUDGE, 6).alias(c) for c in ("depth", "click", "error")], F.round(F.col("lat") + 3e-9, 7).alias("lat"), F.round(F.col("lon") + 3e-9, 7).alias("lon")
    )


# --- JOB8 and JOB9 --------------------------------------------------------------------------

START = 1_704_067_200_000_000
SLOW = f"SELECT series, idx, {START} + idx*600000000 AS us, value FROM rate60"
SLOW_FLEET = f"SELECT series, idx AS seq, us, 36.8 + value/10000 AS lat, -122.0 - value/20000 AS lon FROM ({SLOW}) z"

PLANKTON = f"""{ENVELOPE.replace('(idx*1000000)//60 AS us', f'{START} + idx*600000000 AS us')}, x AS (SELECT series, idx, x FROM raw), {PEAK_SQL},
    fl AS (SELECT env.*, CASE WHEN env.x >= max_bg AND env.x > med_bg + 1e11 THEN pk.x END AS hi, CASE WHEN env.x >= max_bg AND env.x <= med_bg + 1e11 THEN pk.x END AS lo2 FROM env LEFT JOIN pk ON env.series = pk.series AND env.idx = pk.idx),
    cn AS (SELECT series, us, min_bg, count(hi) OVER w AS high, count(lo2) OVER w AS low, max(x - med_bg) OVER w AS top FROM fl WINDOW w AS (PARTITION BY series ORDER BY idx ROWS BETWEEN 450 PRECEDING AND 449 FOLLOWING)),
    hr AS (SELECT series, us//3600000000*3600000000 AS us, avg(high) AS high, avg(low) AS low, avg(top) AS top, avg(min_bg) AS bg FROM cn GROUP BY ALL),
    fw AS (SELECT series, us//3600000000*3600000000 AS us, avg(CASE WHEN value > 100 THEN 0 ELSE value + 100 END) AS flow0 FROM ({SLOW}) s WHERE idx % 6 = 0 GROUP BY ALL),
    flw AS (SELECT series, us, CASE WHEN flow0 = 0 THEN 350 ELSE flow0 END AS flow FROM fw),
    {NIGHTS.replace(FLEET, SLOW_FLEET).replace('pos % 2 = 0', 'pos % 3 = 0')},
    nb AS (SELECT env.series, env.us//3600000000*3600000000 AS us, avg(min_bg) AS nbg FROM env JOIN nw ON env.series = nw.series AND (env.us > night_start OR (start_closed AND env.us = night_start)) AND (env.us < night_end OR (end_closed AND env.us = night_end)) GROUP BY ALL),
    wh AS (SELECT series, min(night_start) AS a, max(night_end) AS b FROM nw GROUP BY series),
    fq AS (SELECT s.series, us, value/100 - 0.2 AS fluo FROM ({SLOW}) s JOIN wh ON wh.series = s.series AND us > a AND us < b WHERE idx % 6 = 0),
    fg AS (SELECT series, us//3600000000*3600000000 AS us, CASE WHEN avg(fluo) >= 0 THEN avg(fluo) END AS fluo FROM fq GROUP BY ALL),
    al AS (SELECT hr.series, hr.us, high/15/flow*1000 AS nbflash_high, low/15/flow*1000 AS nbflash_low, top AS intflash, bg/flow*1000 AS bg_biolume, fluo, nbg/flow*1000/3.9811e11 AS pseudo
    FROM hr LEFT JOIN flw ON flw.series = hr.series AND flw.us = hr.us LEFT JOIN nb ON nb.series = hr.series AND nb.us = hr.us LEFT JOIN fg ON fg.series = hr.series AND fg.us = hr.us)"""


@query(
    "job8_plankton_proxies",
    f"""WITH {PLANKTON} SELECT series, us, round(nbflash_high, 6) AS nbflash_high, round(nbflash_low, 6) AS nbflash_low, round(intflash/1e6, 2) AS intflash, round(bg_biolume/1e6, 2) AS bg_biolume,
    round(CASE WHEN fluo < pseudo THEN fluo WHEN fluo IS NOT NULL THEN pseudo END/0.0047, 4) AS adinos, round((pseudo - CASE WHEN fluo < pseudo THEN fluo WHEN fluo IS NOT NULL THEN pseudo END)/0.0047, 4) AS hdinos,
    round(CASE WHEN fluo IS NULL OR pseudo IS NULL THEN NULL WHEN fluo < pseudo THEN 0.0 ELSE (fluo - pseudo)/0.0047 END, 4) AS diatoms FROM al""",
    ("rate60",),
)
def job8(spark, sf):
    s = fx.rate60(spark, sf).withColumn("us", F.lit(START) + F.col("idx") * 600_000_000)
    raw = s.select("series", "us", (F.col("value") * 1e9).alias("x"))
    sparse = s.where("idx % 6 = 0")
    flow = sparse.select("series", "us", F.when(F.col("value") > 100, 0.0).otherwise(F.col("value") + 100).alias("flow"))
    fluo = sparse.select("series", "us", (F.col("value") / 100 - 0.2).alias("fluo"))
    place = s.select("series", "us", (F.lit(36.8) + F.col("value") / 10000).alias("lat"), (F.lit(-122.0) - F.col("value") / 20000).alias("lon"))
    out, _ = plankton.plankton_proxies(raw, flow, fluo, place, ["series"], ratio=3.9811e11, stride=3, seconds=HOUR_S, width=10 * DAY, size=5_000)
    return out.select(
        "series", "us", F.round("nbflash_high", 6).alias("nbflash_high"), F.round("nbflash_low", 6).alias("nbflash_low"),
        *[F.round(F.col(c) / 1e6, 2).alias(c) for c in ("intflash", "bg_biolume")], *[F.round(c, 4).alias(c) for c in ("adinos", "hdinos", "diatoms")],
    )


CORRECT = """px AS (SELECT series, idx*60000000 AS us, idx, value/100 AS fluo, value/90 + idx % 7/10.0::DOUBLE AS bg, CASE WHEN (idx//120) % 11 = 3 THEN NULL WHEN (idx//120) % 7 = 2 THEN 0.05 ELSE value/200 END AS adinos, value/300 AS diatoms, value/400 AS hdinos FROM rate60),
    gd AS (SELECT series, idx*60000000 + 20000000 AS us, CASE WHEN (idx//120) % 13 = 5 THEN 1.0 ELSE depth END AS depth, 1 + idx//120 + CASE WHEN idx % 500 = 499 THEN 1000 ELSE 0 END AS profile_number FROM track),
    ev AS (SELECT series, idx*60000000 AS at FROM rate60 WHERE idx % 700 = 350),
    n0 AS (SELECT px.*, g.us AS t0, g.depth AS d0, g.profile_number AS p0 FROM px ASOF LEFT JOIN gd g ON px.series = g.series AND px.us >= g.us),
    n1 AS (SELECT n0.*, g.us AS t1, g.depth AS d1, g.profile_number AS p1 FROM n0 ASOF LEFT JOIN gd g ON n0.series = g.series AND n0.us <= g.us),
    pl AS (SELECT *, CASE WHEN t0 IS NULL OR t1 - us < us - t0 THEN d1 ELSE d0 END AS depth, CASE WHEN t0 IS NULL OR t1 - us < us - t0 THEN p1 ELSE p0 END AS profile_number FROM n1),
    sp AS (SELECT series, profile_number, min(us) AS a, max(us) AS b, min(CASE WHEN depth > 2 THEN us END) AS da, max(CASE WHEN depth > 2 THEN us END) AS db FROM pl GROUP BY ALL),
    se AS (SELECT sp.*, EXISTS (SELECT 1 FROM ev WHERE ev.series = sp.series AND ev.at BETWEEN a AND b) AS sun FROM sp),
    rw AS (SELECT pl.*, sun, coalesce(us > da - 300000000 AND us < db + 300000000, false) AS near FROM pl JOIN se USING (series, profile_number)),
    ct AS (SELECT series, profile_number, bool_or(sun) AS sun, count(*) FILTER (WHERE near) AS rows_, count(*) FILTER (WHERE near AND depth > 2 AND adinos > 0.1) AS rich, count(adinos) FILTER (WHERE near AND depth > 2) AS known, max(depth) FILTER (WHERE near AND depth > 2 AND adinos > 0.1) AS bottom FROM rw GROUP BY ALL),
    cr AS (SELECT series, profile_number, corr(fluo, bg) AS c FROM rw JOIN ct USING (series, profile_number) WHERE near AND depth > 2 AND depth <= bottom GROUP BY ALL),
    oc AS (SELECT ct.series, ct.profile_number, CASE WHEN sun THEN 'sun_event' WHEN rows_ = 0 THEN 'no_deep_rows' WHEN rows_ <= 3 THEN 'too_few_rows' WHEN rich < 3 AND known = 0 THEN 'no_values' WHEN rich < 3 THEN 'low_signal' ELSE 'corrected' END AS outcome, c FROM ct LEFT JOIN cr USING (series, profile_number)),
    fc AS (SELECT rw.*, outcome, CASE WHEN near THEN CASE outcome WHEN 'low_signal' THEN 1.0 WHEN 'corrected' THEN c END END AS r FROM rw JOIN oc USING (series, profile_number)),
    ff AS (SELECT *, CASE WHEN r IS NOT NULL THEN greatest(0, (r + 1)/2*0.8 + 0.2) END AS f FROM fc)"""


def corrected(spark, sf):
    v, i = F.col("value"), F.col("idx")
    block = F.floor(i / 120)
    adinos = F.when(block % 11 == 3, None).when(block % 7 == 2, 0.05).otherwise(v / 200)
    px = fx.rate60(spark, sf).select(
        "series", (i * 60_000_000).alias("us"), (v / 100).alias("fluo"), (v / 90 + i % 7 / 10.0).alias("bg"), adinos.alias("adinos"), (v / 300).alias("diatoms"), (v / 400).alias("hdinos")
    )
    depth = F.when(block % 13 == 5, 1.0).otherwise(F.col("depth"))
    gd = fx.track(spark, sf).select("series", (i * 60_000_000 + 20_000_000).alias("us"), depth.alias("depth"), (1 + block + F.when(i % 500 == 499, 1000).otherwise(0)).alias("profile_number"))
    ev = fx.rate60(spark, sf).where("idx % 700 = 350").select("series", (i * 60_000_000).alias("at"))
    return plankton.correct_proxies(px, gd, ev, ["series"], width=DAY // 4)


@query(
    "job9_correct_proxies",
    f"""WITH {CORRECT} SELECT series, us, profile_number, outcome, round(r, 6) AS r, round(adinos*f, 6) AS adinos, round(adinos + diatoms - adinos*f, 6) AS diatoms, round(adinos + hdinos - adinos*f, 6) AS hdinos FROM ff""",
    ("rate60", "track"),
)
def job9(spark, sf):
    return corrected(spark, sf).select("series", "us", "profile_number", "outcome", *[F.round(c, 6).alias(c) for c in ("r", "adinos", "diatoms", "hdinos")])


@query("agg21_correction_outcomes", f"WITH {CORRECT} SELECT outcome, count(DISTINCT (series, profile_number)) AS n FROM oc GROUP BY outcome", ("rate60", "track"))
def agg21(spark, sf):
    return corrected(spark, sf).groupBy("outcome").agg(F.count_distinct("series", "profile_number").alias("n"))


# --- JOB11 to JOB15 -------------------------------------------------------------------------


JOB11_SQL = """WITH t AS (SELECT series, name, us, v FROM (SELECT user_id % 10 AS series, event_type AS name, epoch_us(date_trunc('minute', ts)) AS us, CASE WHEN event_id % 9 > 0 THEN value END AS v, row_number() OVER (PARTITION BY user_id % 10, event_type, date_trunc('minute', ts) ORDER BY event_id) AS rn
    FROM events WHERE event_type IN ('click', 'view', 'error') AND event_id % 9 > 0 AND date_trunc('minute', ts) BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-28') q WHERE rn = 1),
    sp AS (SELECT series, min(us)//3600000000 AS a, CAST(ceil(max(us)/3600000000) AS BIGINT) AS b FROM t GROUP BY series),
    g AS (SELECT n.series, name, unnest(range(a, b + 1))*3600000000 AS us FROM (SELECT DISTINCT series, name FROM t) n JOIN sp USING (series)),
    p AS (SELECT g.*, t.us AS t0, t.v AS v0 FROM g ASOF LEFT JOIN t ON g.series = t.series AND g.name = t.name AND g.us >= t.us),
    q AS (SELECT p.*, t.us AS t1, t.v AS v1 FROM p ASOF LEFT JOIN t ON p.series = t.series AND p.name = t.name AND p.us <= t.us),
    f AS (SELECT series, name, us, CASE WHEN t0 IS NULL OR t1 IS NULL THEN NULL WHEN t0 = t1 THEN v0 ELSE v0 + (v1 - v0)*((us - t0)/nullif(t1 - t0, 0)::DOUBLE) END AS v FROM q)
    SELECT series, us, round(max(CASE WHEN name = 'click' THEN v END) + 2e-8, 6) AS click, round(max(CASE WHEN name = 'view' THEN v END) + 2e-8, 6) AS view, round(max(CASE WHEN name = 'error' THEN v END) + 2e-8, 6) AS error FROM f GROUP BY ALL"""


@query("job11_message_grid", JOB11_SQL)
def job11(spark, sf):
    names = ["click", "view", "error"]
    minute = F.unix_micros(F.date_trunc("minute", F.col("ts").cast("timestamp")))
    messages = table(spark, sf, "events").where(F.col("event_type").isin(names)).select(
        (F.col("user_id") % 10).alias("series"), F.col("event_type").alias("name"), minute.alias("us"), F.col("event_id").alias("seq"), F.when(F.col("event_id") % 9 > 0, F.col("value")).alias("value"),
    )
    start, end = F.lit(START + DAY), F.lit(START + 27 * DAY)
    out = grid.message_grid(messages, ["series"], "us", "seq", start, end, names, HOUR_S, 10 * DAY)
    return out.select("series", "us", *[F.round(F.col(n) + NUDGE, 6).alias(n) for n in names])


@query(
    "job11_message_profiles",
    f"""WITH wide AS ({JOB11_SQL}), track AS (SELECT series, row_number() OVER (PARTITION BY series ORDER BY us) - 1 AS idx, us, click AS depth FROM wide WHERE click IS NOT NULL),
    {TURNS}, e AS (SELECT CAST(series AS VARCHAR) AS series, max(idx) AS idx, arg_max(depth, idx) AS depth FROM track GROUP BY series),
    s AS (SELECT CAST(series AS BIGINT) AS series, idx, abs(lead(depth) OVER (PARTITION BY series ORDER BY idx) - depth) > 10 AS flag FROM (SELECT series, idx, depth FROM turns UNION ALL SELECT * FROM e) q),
    n AS (SELECT t.series, t.us, CAST(1 + count(s.idx) AS INT) AS profile_number FROM track t LEFT JOIN s ON s.series = t.series AND s.idx < t.idx AND s.flag GROUP BY ALL)
    SELECT w.series, w.us, w.click AS depth, w.view, w.error, n.profile_number FROM wide w LEFT JOIN n ON n.series = w.series AND n.us = w.us""",
)
def job11_profiles(spark, sf):
    wide = durable(job11(spark, sf)).withColumnRenamed("click", "depth")
    return grid.message_profiles(wide, ["series"], "us", width=10 * DAY, size=200)


WORDS = MEPS.replace("FROM mep", "FROM words").replace("g AS (SELECT *,", "words AS (SELECT l_suppkey AS series, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) AS idx, CASE WHEN l_linenumber <= 2 THEN 1 ELSE 0 END AS n, CAST(l_quantity*40 AS INT) AS p, CAST(l_partkey % 64 AS INT) AS e, l_orderkey//100 AS frame FROM lineitem), g AS (SELECT *,").replace("min(idx) AS idx,", "min(frame) AS frame,")


def spectra(spark, sf):
    n, p, e = F.when(F.col("l_linenumber") <= 2, 32768).otherwise(0), (F.col("l_quantity") * 40).cast("int"), (F.col("l_partkey") % 64).cast("int")
    words = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("series"), "l_orderkey", "l_linenumber", "l_partkey",
        (n + p * 8 + F.floor(e / 8).cast("int")).alias("a"), ((e % 8) * 2048 + 17).alias("b"), (F.col("l_orderkey") % 65536).cast("int").alias("c"),
    )
    ax = axis("series", ["l_orderkey", "l_linenumber", "l_partkey"], 5_000)
    return products.particle_spectra(words, ax, F.floor(F.col("l_orderkey") / 100))


@query(
    "job12_particle_statistics",
    f"""WITH {WORDS} SELECT series, frame//21 AS bin, count(*) AS n, round(avg(ai), 6) AS ai_mean, round(stddev_pop(ai), 6) AS ai_std, round(avg(esd), 4) AS esd_mean, round(max(esd), 4) AS esd_max,
    count(*) FILTER (WHERE ai > 0.6 AND esd > 1100 AND esd < 1700) AS large_copepods, count(*) FILTER (WHERE ai <= 0.4) AS transparent, count(*) FILTER (WHERE ai > 0.4) AS opaque FROM a GROUP BY ALL""",
)
def job12(spark, sf):
    stats, _ = spectra(spark, sf)
    return stats.select(
        "series", "bin", "n", F.round("ai_mean", 6).alias("ai_mean"), F.round("ai_std", 6).alias("ai_std"), F.round("esd_mean", 4).alias("esd_mean"), F.round("esd_max", 4).alias("esd_max"),
        "large_copepods", "transparent", "opaque",
    )


@query(
    "job12_particle_frames",
    """WITH f AS (SELECT series, idx, value, idx*2 + 500 AS counter, 5 + idx % 120 AS ft, 1 + idx % 3 AS fc FROM rate60 WHERE value <= 200),
    s AS (SELECT *, ft/fc::DOUBLE AS m, first_value(counter) OVER (PARTITION BY series ORDER BY idx) AS c0 FROM f)
    SELECT series, idx, round(1000.0 + 0.5*(counter - c0), 6) AS frame_time, round(CASE WHEN m < 7 OR m > 100 THEN NULL WHEN m <= 13 THEN 23.10410966*exp(-(-1.481499106*pow(m, 0.25) + 1.566460406*sqrt(m) + 0.196311142*m - 0.05*pow(sqrt(m), 3)))
    ELSE 0.198996019*exp(-(-2.603059062*pow(m, 0.25) + 0.892897609*sqrt(m) + 0.006191239*m - 0.0013*pow(sqrt(m), 3))) END, 6) AS speed FROM s""",
    ("rate60",),
)
def job12_frames(spark, sf):
    counts = F.array_repeat(F.floor(F.col("value") * 5 + 0.9).cast("int"), 128)
    df = fx.rate60(spark, sf).select(
        "series", "idx", counts.alias("counts"), F.lit(100).alias("threshold"), F.lit(0).alias("buffer"), (F.col("idx") * 2 + 500).alias("counter"),
        F.lit(1000.0).alias("start"), (5 + F.col("idx") % 120).alias("flow_time"), (1 + F.col("idx") % 3).alias("flow_count"),
    )
    out = products.particle_frames(df, axis("series", "idx", 700), size=700)
    return out.select("series", "idx", F.round("frame_time", 6).alias("frame_time"), F.round("speed", 6).alias("speed"))


@query(
    "job12_particle_spectra",
    f"""WITH {WORDS} SELECT series, frame//21 AS bin, CAST(greatest(0, least(993, ceil((esd - 108)/15.0::DOUBLE - 0.5))) AS INT) AS size_bin, count(*) AS n FROM a GROUP BY ALL""",
)
def job12_spectra(spark, sf):
    return spectra(spark, sf)[1]


@query(
    "job12_total_spectra",
    f"""WITH {WORDS}, s AS (SELECT CAST(label AS BIGINT) AS series, CAST(vec_id AS BIGINT) // 21 AS bin, unnest(range(64)) AS size_bin, unnest(embedding) AS v FROM embeddings),
    u AS (SELECT series, frame//21 AS bin, CAST(greatest(0, least(993, ceil((esd - 108)/15.0::DOUBLE - 0.5))) AS INT) AS size_bin, 1 AS n FROM a UNION ALL SELECT series, bin, CAST(size_bin AS INT), floor(abs(v)*100) FROM s)
    SELECT series, bin, size_bin, CAST(sum(n) AS BIGINT) AS n FROM u GROUP BY ALL""",
)
def job12_total(spark, sf):
    frames = fx.samples(spark, sf).select(
        F.col("label").cast("bigint").alias("series"), F.col("sec").cast("bigint").alias("sec"), F.transform("samples", lambda x: F.floor(F.abs(x) * 100)).alias("counts")
    )
    return products.total_spectra(spectra(spark, sf)[1], frames, ["series"], "sec", "counts")


DEPLOYED = f"""{TRACK_SQL}, {utm_sql('sl', 'so')}, pr AS (SELECT series % 10 AS series, us, 1 + seq // 70 % 9 AS p FROM nav),
    dr AS (SELECT *, lag(p) OVER (PARTITION BY series ORDER BY us) AS b FROM pr), cu AS (SELECT series, us, p + sum(CASE WHEN p < b THEN b ELSE 0 END) OVER (PARTITION BY series ORDER BY us) AS cumulative FROM dr)"""


@query(
    "job13_deployment",
    f"""WITH {DEPLOYED}
    SELECT t.series, t.us, round(distance/1000, 6) AS km, cumulative FROM track t JOIN cu ON cu.series = t.series AND cu.us = t.us""",
    ("nav",),
)
def job13(spark, sf):
    return deployed(spark, sf).select("series", "us", F.round("km", 6).alias("km"), "cumulative")


@query(
    "job10_cartridge_samples",
    """WITH s AS (SELECT CAST(regexp_extract(line, 'Z,(\\d+\\.\\d+) ', 1) AS DOUBLE) AS sec, row_number() OVER (ORDER BY line_no) AS nth FROM syslog WHERE contains(line, 'ELMO will go to position')),
    n AS (SELECT CAST(regexp_extract(line, 'Sample (\\d+)', 1) AS INT) AS sample, row_number() OVER (ORDER BY line_no) AS nth FROM syslog WHERE contains(line, 'err_code')),
    e AS (SELECT sample, CAST(round(arg_max(sec, s.nth)*1000000) AS BIGINT) AS us FROM s JOIN n USING (nth) GROUP BY sample),
    g AS (SELECT 1565985091500000 + event_id*1000000 AS us, CASE WHEN event_id % 5 > 2 THEN value END AS a, value*2 AS b FROM events)
    SELECT sample, count(*) AS rows, round(coalesce(avg(a), avg(b)) + 2e-8, 6) AS temperature, min(g.us) AS us FROM e JOIN g ON g.us BETWEEN e.us - 1000000 AND e.us + 1000000 GROUP BY sample""",
    ("syslog",),
)
def job10_cartridge(spark, sf):
    us = 1565985091500000 + F.col("event_id") * 1_000_000
    grid_rows = table(spark, sf, "events").select(
        F.lit(1).alias("mission"), F.timestamp_micros(us).alias("ts"), F.when(F.col("event_id") % 5 > 2, F.col("value")).alias("a"), (F.col("value") * 2).alias("b")
    )
    lines = fx.syslog(spark, sf).withColumn("mission", F.lit(1))
    out = products.cartridge_samples(lines, grid_rows, ["mission"], "line_no", "line", {"temperature": ("a", "b")}, size=2_000)
    return out.select("sample", "rows", F.round(F.col("temperature") + NUDGE, 6).alias("temperature"), F.unix_micros("ts").alias("us"))


def deployed(spark, sf):
    seq = F.col("seq")
    rows = fx.nav(spark, sf).select(
        (F.col("series") % 10).alias("series"), "seq", F.unix_micros("ts").alias("us"), "lat", "lon", (1 + F.floor(seq / 70) % 9).alias("profile_number"),
        (F.unix_micros("ts") / 1e12).alias("used"), (seq % 90).cast("double").alias("depth"), (seq % 7).cast("double").alias("v"),
    )
    logs = [rows.where("seq % 2 = 0"), rows.where("seq % 2 = 1")]
    return products.deployment(logs, ["series"], "us", "seq", 10 * DAY, 300)


def deployment_products(spark, sf):
    e = table(spark, sf, "events").where("event_type = 'signup'").select(
        (F.col("user_id") % 10).alias("series"), F.concat(F.lit("log"), F.floor(F.col("event_id") / 500).cast("string")).alias("label"), F.unix_micros(F.col("ts").cast("timestamp")).alias("us")
    )
    logs = e.groupBy("series", "label").agg(F.min("us").alias("start"), F.max("us").alias("end"), F.min("us").alias("position"))
    return products.deployment_products(durable(deployed(spark, sf)), logs, ["series"], "us", "depth", "v", "used", 10 * DAY, 300)


ALONG = f"""{TRACK_SQL}, {utm_sql('sl', 'so')}, t AS (SELECT series, us, distance/1000 AS km, us/1e12 AS used FROM track)"""


@query(
    "job13_deployment_rate",
    f"""WITH {ALONG}, sp AS (SELECT series, min(km) AS a, max(km) AS b FROM t GROUP BY series), g1 AS (SELECT series, a, unnest(range(CAST(ceil(b - a) AS BIGINT))) AS k FROM sp),
    gx AS (SELECT series, k, a + k AS x FROM g1), c1 AS (SELECT series, km, arg_max(used, us) AS used FROM t GROUP BY ALL),
    q0 AS (SELECT gx.*, c1.km AS x0, c1.used AS v0 FROM gx ASOF LEFT JOIN c1 ON gx.series = c1.series AND gx.x >= c1.km),
    q1 AS (SELECT q0.*, c1.km AS x1, c1.used AS v1 FROM q0 ASOF LEFT JOIN c1 ON q0.series = c1.series AND q0.x <= c1.km),
    v AS (SELECT series, k, CASE WHEN x0 = x1 THEN v0 ELSE v0 + (v1 - v0)*((x - x0)/nullif(x1 - x0, 0)) END AS v FROM q1),
    r1 AS (SELECT series, k, coalesce((lead(v) OVER w - lag(v) OVER w)/2, lead(v) OVER w - v, v - lag(v) OVER w) AS rate FROM v WINDOW w AS (PARTITION BY series ORDER BY k))
    SELECT series, round(avg(rate), 9) AS mean_rate, round(arg_max(rate, k), 9) AS last_rate FROM r1 WHERE rate IS NOT NULL GROUP BY series""",
    ("nav",),
)
def job13_rate(spark, sf):
    out = deployment_products(spark, sf)["rate"]
    return out.select("series", F.round("mean_rate", 9).alias("mean_rate"), F.round("last_rate", 9).alias("last_rate"))


@query(
    "job13_deployment_section",
    f"""WITH {DEPLOYED}, n AS (SELECT series % 10 AS series, us, seq FROM nav),
    d AS (SELECT t.series, distance/1000 AS x, CAST(seq % 90 AS DOUBLE) AS depth, cumulative AS profile, CAST(seq % 7 AS DOUBLE) AS v FROM track t JOIN cu ON cu.series = t.series AND cu.us = t.us JOIN n ON n.series = t.series AND n.us = t.us),
    {SECT} SELECT series, xi, depth, round(v + {NUDGE}, 6) AS v FROM (SELECT *, zi*0.5::DOUBLE AS depth FROM sect) z""",
    ("nav",),
)
def job13_section(spark, sf):
    """The variable along the kilometres of the deployment, three columns a profile."""
    out = deployment_products(spark, sf)["section"]
    return out.select("series", F.col("xi").cast("bigint").alias("xi"), "depth", F.round(F.col("v") + NUDGE, 6).alias("v"))


@query(
    "job13_deployment_ranges",
    f"""WITH {ALONG}, l1 AS (SELECT user_id % 10 AS series, concat('log', event_id // 500) AS label, min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS b FROM events WHERE event_type = 'signup' GROUP BY ALL)
    SELECT t.series, label, round(arg_min(km, us), 6) AS start_km, round(arg_max(km, us), 6) AS end_km FROM t JOIN l1 ON t.series = l1.series AND us >= a AND us < b GROUP BY ALL""",
    ("nav",),
)
def job13_ranges(spark, sf):
    out = deployment_products(spark, sf)["ranges"]
    return out.select("series", "label", F.round("start_km", 6).alias("start_km"), F.round("end_km", 6).alias("end_km"))


@query(
    "job13_deployment_bottom",
    """WITH n AS (SELECT series % 10 AS series, us, CAST(seq % 90 AS DOUBLE) AS depth, row_number() OVER o - 1 AS idx, greatest(1, CAST(floor(count(*) OVER (PARTITION BY series % 10)*0.01) AS BIGINT)) AS w FROM nav WINDOW o AS (PARTITION BY series % 10 ORDER BY us))
    SELECT series, us, depth, CASE WHEN idx >= w - 1 THEN max(depth) OVER (PARTITION BY series ORDER BY idx ROWS BETWEEN w - 1 PRECEDING AND CURRENT ROW) END AS bottom FROM n""",
    ("nav",),
)
def job13_bottom(spark, sf):
    return deployment_products(spark, sf)["bottom"].select("series", "us", "depth", "bottom")


@query(
    "job14_compare_instruments",
    """WITH a AS (SELECT series % 5 AS series, (us + 1800000000)//3600000000 AS h, avg(value) AS x FROM signal WHERE seq % 2 = 0 AND value BETWEEN 2 AND 200 GROUP BY ALL),
    b AS (SELECT series % 5 AS series, (us + 1800000000)//3600000000 AS h, avg(value*2) AS y FROM signal WHERE seq % 2 = 1 AND value*2 BETWEEN 5 AND 300 GROUP BY ALL)
    SELECT series, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept, round(regr_r2(y, x), 6) AS r2, count(*) AS n FROM a JOIN b USING (series, h) GROUP BY series""",
    ("signal",),
)
def job14(spark, sf):
    s = fx.signal_us(spark, sf).withColumn("series", F.col("series") % 5)
    a = s.where("seq % 2 = 0").select("series", "us", F.col("value").alias("x"))
    b = s.where("seq % 2 = 1").select("series", "us", (F.col("value") * 2).alias("y"))
    out = products.compare_instruments(a, b, ["series"], "us", "x", "y", {"x": (2, 200), "y": (5, 300)}, HOUR_S)
    return out.withColumns({c: F.round(c, 6) for c in ("slope", "intercept", "r2")})


@query(
    "job15_clean_times",
    """WITH r AS (SELECT o_custkey % 50 AS series, var, o_orderkey AS seq, o_orderdate + INTERVAL 1 DAY * (CAST(o_orderkey AS INT) % CASE var WHEN 'lat' THEN 1 WHEN 'lon' THEN 3 ELSE 5 END) AS ts FROM orders, (VALUES ('lat'), ('lon'), ('depth')) v(var)),
    i AS (SELECT *, epoch_us(ts)/1e6 AS t FROM r WHERE ts BETWEEN TIMESTAMP '1996-01-01' - INTERVAL 10 MINUTE AND TIMESTAMP '2000-01-01' + INTERVAL 10 MINUTE),
    d AS (SELECT *, t - lag(t) OVER w AS a, lead(t) OVER w - t AS b, count(*) OVER (PARTITION BY series, var) AS n FROM i WINDOW w AS (PARTITION BY series, var ORDER BY seq)),
    m AS (SELECT series, var, median(a) AS med FROM d WHERE a IS NOT NULL GROUP BY ALL), k AS (SELECT d.series, d.var, median(abs(a - med)) AS mad FROM d JOIN m ON m.series = d.series AND m.var = d.var WHERE a IS NOT NULL GROUP BY ALL),
    c AS (SELECT d.* FROM d LEFT JOIN m ON m.series = d.series AND m.var = d.var LEFT JOIN k ON k.series = d.series AND k.var = d.var
    WHERE NOT coalesce(n >= 3 AND mad <> 0 AND 0.6745*abs(a - med)/nullif(mad, 0) > 2.0 AND a*b < 0 AND 0.6745*abs(b - med)/nullif(mad, 0) > 1.0, false)),
    s AS (SELECT *, max(ts) OVER (PARTITION BY series, var ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM c), u AS (SELECT * FROM s WHERE seen IS NULL OR ts > seen),
    p AS (SELECT series, count(DISTINCT var) AS v FROM u GROUP BY series), h AS (SELECT series, seq, count(DISTINCT var) AS v FROM u GROUP BY ALL)
    SELECT u.series, u.var, u.seq, epoch_us(u.ts) AS us FROM u JOIN p ON p.series = u.series JOIN h ON h.series = u.series AND h.seq = u.seq WHERE p.v < 2 OR h.v = p.v""",
)
def job15(spark, sf):
    o = table(spark, sf, "orders").select((F.col("o_custkey") % 50).alias("series"), F.col("o_orderkey").alias("seq"), F.col("o_orderdate").cast("timestamp").alias("ts"))
    names = F.explode(F.array(*[F.struct(F.lit(n).alias("var"), F.lit(k).alias("k")) for n, k in (("lat", 1), ("lon", 3), ("depth", 5))]))
    long = o.withColumn("_v", names).select("series", "_v.var", "seq", (F.col("ts") + F.make_dt_interval((F.col("seq") % F.col("_v.k")).cast("int"))).alias("ts"))
    start, end = F.lit("1996-01-01").cast("timestamp"), F.lit("2000-01-01").cast("timestamp")
    windows = o.select("series").distinct().select("series", start.alias("start"), end.alias("end"))
    out = grid.clean_times(long, windows, ["series"], "seq", "ts", threshold=2.0, width=5_000)
    return out.select("series", "var", "seq", F.unix_micros("ts").alias("us"))


# --- STR1 -----------------------------------------------------------------------------------


@query(
    "str1_stream_means",
    """WITH h AS (SELECT event_type, epoch_us(ts)//3600000000 AS h, round(avg(value), 6) AS value, count(*) AS n FROM events GROUP BY ALL)
    SELECT event_type, h*3600000000 AS us, value, n FROM h WHERE (h + 1)*3600000000 <= (SELECT max(epoch_us(ts)) FROM events) - 600000000""",
)
def str1(spark, sf):
    import uuid

    folder = shared_folder(spark, f"stream-{uuid.uuid4().hex}")
    schema = table(spark, sf, "events").schema
    arriving = streaming.open_stream(spark, sf, schema, "events.parquet").select("event_type", F.col("ts").cast("timestamp").alias("ts"), "value")
    means = streaming.stream_means(arriving, ["event_type"], "ts", "value", "1 hour")
    streaming.write_means(means, f"{folder}/out", f"{folder}/checkpoint")
    out = spark.read.parquet(f"{folder}/out")
    return out.select("event_type", F.unix_micros("ts").alias("us"), F.round("value", 6).alias("value"), "n")

