"""Queries for peaks, profiles, nights, backgrounds, tracks and sections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import section as sec
from tidemark.operators import signal as sig
from tidemark.operators.ordered import axis, durable, row_index
from tidemark.operators.resample import median3
from tidemark.registry import inputs as fx
from tidemark.registry.core import query
from tidemark.registry.formulas import SUN_SQL
from tidemark.registry.inputs import DAY, table

PEAK_SQL = """r AS (SELECT series, idx, x, sum(CASE WHEN x IS DISTINCT FROM p THEN 1 ELSE 0 END) OVER (PARTITION BY series ORDER BY idx) AS run FROM
    (SELECT *, lag(x) OVER (PARTITION BY series ORDER BY idx) AS p FROM x) q),
    g AS (SELECT series, run, any_value(x) AS x, min(idx) AS a, max(idx) AS b FROM r GROUP BY series, run),
    pk AS (SELECT series, (a + b)//2 AS idx, x FROM (SELECT *, lag(x) OVER w AS l, lead(x) OVER w AS n FROM g WINDOW w AS (PARTITION BY series ORDER BY run)) q WHERE x > l AND x > n)"""


@query(
    "win5_peaks",
    f"WITH x AS (SELECT series, idx, floor(value/20) AS x FROM rate60), {PEAK_SQL} SELECT series, idx, x FROM pk",
    ("rate60",),
)
def win5(spark, sf):
    steps = fx.rate60(spark, sf).select("series", "idx", F.floor(F.col("value") / 20).cast("double").alias("x"))
    return sig.peaks(steps, ["series"], "idx", "x", 700)


@query(
    "win5_peaks_above",
    f"WITH x AS (SELECT series, idx, floor(value/20) AS x FROM rate60), {PEAK_SQL} SELECT series, idx, x FROM pk WHERE x >= (idx % 7)",
    ("rate60",),
)
def win5_above(spark, sf):
    steps = fx.rate60(spark, sf).select(
        "series", "idx", F.floor(F.col("value") / 20).cast("double").alias("x"), (F.col("idx") % 7).alias("h")
    )
    return sig.peaks_above(steps, ["series"], "idx", "x", "h", 700).select("series", "idx", "x")


TURNS = f"""x AS (SELECT concat(series, '|', kind) AS series, idx, kind*depth AS x FROM track, (VALUES (1), (-1)) k(kind)), {PEAK_SQL},
    hi AS (SELECT pk.series, pk.idx, pk.x, max(CASE WHEN x.idx < pk.idx AND x.x > pk.x THEN x.idx END) AS l, min(CASE WHEN x.idx > pk.idx AND x.x > pk.x THEN x.idx END) AS r FROM pk JOIN x ON pk.series = x.series GROUP BY ALL),
    bs AS (SELECT hi.series, hi.idx, hi.x, greatest(min(CASE WHEN x.idx < hi.idx THEN x.x END), min(CASE WHEN x.idx > hi.idx THEN x.x END)) AS base FROM hi JOIN x ON hi.series = x.series AND x.idx > coalesce(l, -1) AND x.idx < coalesce(r, 1000000000) GROUP BY ALL),
    lv AS (SELECT *, x - base AS prominence, x - 0.5*(x - base) AS level FROM bs WHERE x - base >= 10),
    cr AS (SELECT lv.series, lv.idx, lv.x, prominence, level, max(CASE WHEN x.idx < lv.idx AND x.x <= level THEN x.idx END) AS il, min(CASE WHEN x.idx > lv.idx AND x.x <= level THEN x.idx END) AS ir FROM lv JOIN x ON lv.series = x.series GROUP BY ALL),
    wd AS (SELECT cr.*, (ir - (level - d.x)/(c.x - d.x)) - (il + (level - a.x)/(b.x - a.x)) AS width FROM cr JOIN x a ON a.series = cr.series AND a.idx = il JOIN x b ON b.series = cr.series AND b.idx = il + 1
    JOIN x c ON c.series = cr.series AND c.idx = ir - 1 JOIN x d ON d.series = cr.series AND d.idx = ir),
    turns AS (SELECT split_part(series, '|', 1) AS series, idx, CAST(split_part(series, '|', 2) AS INT) AS kind, CAST(split_part(series, '|', 2) AS INT)*x AS depth, prominence, width FROM wd WHERE width >= 30)"""


@query(
    "win6_turning_points",
    f"WITH {TURNS} SELECT series, idx, kind, depth, round(prominence, 6) AS prominence, round(width, 6) AS width FROM turns",
    ("track",),
)
def win6(spark, sf):
    out = sig.turning_points(fx.track(spark, sf), ["series"], "idx", "depth", size=700)
    return out.withColumns({"prominence": F.round("prominence", 6), "width": F.round("width", 6)})


@query(
    "win7_profile_number",
    f"""WITH {TURNS}, e AS (SELECT series, max(idx) AS idx, arg_max(depth, idx) AS depth FROM track GROUP BY series),
    s AS (SELECT series, idx, abs(lead(depth) OVER (PARTITION BY series ORDER BY idx) - depth) > 10 AS flag FROM (SELECT series, idx, depth FROM turns UNION ALL SELECT * FROM e) q)
    SELECT t.series, t.idx, t.depth, CAST(1 + count(s.idx) AS INT) AS profile_number FROM track t LEFT JOIN s ON s.series = t.series AND s.idx < t.idx AND s.flag GROUP BY ALL""",
    ("track",),
)
def win7(spark, sf):
    return sig.profile_number(fx.track(spark, sf), ["series"], "idx", "depth", size=700)


FLEET = """SELECT series % 10 AS series, seq, us, lat, lon FROM nav"""


def fleet(spark, sf):
    return fx.nav(spark, sf).select((F.col("series") % 10).alias("series"), "seq", F.unix_micros("ts").alias("us"), "lat", "lon")


TRACK_SQL = f"""f AS (SELECT series, us, lat, lon, row_number() OVER (PARTITION BY series ORDER BY us) - 1 AS idx, count(*) OVER (PARTITION BY series) AS n,
    CAST(31 + floor(avg(lon) OVER (PARTITION BY series)/6) AS INT) AS zone FROM ({FLEET}) q),
    k AS (SELECT series, us, lat, lon FROM f WHERE idx % (CASE WHEN n > 400 THEN 200 ELSE 1 END) = 0),
    j0 AS (SELECT f.*, k.us AS t0, k.lat AS lat0, k.lon AS lon0 FROM f ASOF LEFT JOIN k ON f.series = k.series AND f.us >= k.us),
    j1 AS (SELECT j0.*, k.us AS t1, k.lat AS lat1, k.lon AS lon1 FROM j0 ASOF LEFT JOIN k ON j0.series = k.series AND j0.us <= k.us),
    s AS (SELECT series, idx, us, lat, lon, zone, CASE WHEN t1 IS NULL OR t0 = t1 THEN lat0 ELSE lat0 + (lat1 - lat0)*((us - t0)/nullif(t1 - t0, 0)::DOUBLE) END AS sl,
    CASE WHEN t1 IS NULL OR t0 = t1 THEN lon0 ELSE lon0 + (lon1 - lon0)*((us - t0)/nullif(t1 - t0, 0)::DOUBLE) END AS so FROM j1)"""


def utm_sql(lat, lon):
    from tidemark.functions import geo
    from tidemark.registry.formulas import krueger_sql

    east, north = krueger_sql()
    return f"""u1 AS (SELECT *, sinh(atanh(sin(radians({lat}))) - {geo._ECC!r}*atanh({geo._ECC!r}*sin(radians({lat})))) AS t, radians({lon} - (zone*6 - 183)) AS lam FROM s),
    u2 AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam)/sqrt(1 + t*t)) AS eta FROM u1),
    u3 AS (SELECT *, 0.9996::DOUBLE*{geo._RADIUS!r}*(eta + {east}) AS e, 0.9996::DOUBLE*{geo._RADIUS!r}*(xi + {north}) AS m FROM u2),
    u4 AS (SELECT *, coalesce(sqrt(pow(e - lag(e) OVER w, 2) + pow(m - lag(m) OVER w, 2)), 0) AS leg FROM u3 WINDOW w AS (PARTITION BY series ORDER BY idx)),
    track AS (SELECT series, idx, us, lat, lon, sum(leg) OVER (PARTITION BY series ORDER BY idx) AS distance FROM u4)"""


def fleet_track(spark, sf):
    rows = row_index(fleet(spark, sf).drop("seq"), axis("series", "us", 10 * DAY))
    return sec.track_distance(durable(rows), ["series"], "idx", "us", "lat", "lon", size=300)


@query("win8_track_distance", f"WITH {TRACK_SQL}, {utm_sql('sl', 'so')} SELECT series, idx, round(distance, 3) AS distance FROM track", ("nav",))
def win8(spark, sf):
    return fleet_track(spark, sf).select("series", "idx", F.round("distance", 3).alias("distance"))


@query(
    "win9_cumulative_profile",
    """WITH p AS (SELECT series, seq, CAST(floor(value) AS BIGINT) % 40 AS profile FROM signal), d AS (SELECT *, lag(profile) OVER (PARTITION BY series ORDER BY seq) AS b FROM p)
    SELECT series, seq, profile + sum(CASE WHEN profile < b THEN b ELSE 0 END) OVER (PARTITION BY series ORDER BY seq) AS cumulative FROM d""",
    ("signal",),
)
def win9(spark, sf):
    df = fx.signal(spark, sf).select("series", "seq", (F.floor("value") % 40).alias("profile"))
    return sig.cumulative_profile(df, ["series"], ["seq"], "profile", 2_000).select("series", "seq", "cumulative")


@query(
    "win10_profile_bottom",
    """WITH n AS (SELECT *, greatest(1, CAST(floor(count(*) OVER (PARTITION BY series)*0.01) AS BIGINT)) AS w FROM track)
    SELECT series, idx, depth, CASE WHEN idx >= w - 1 THEN max(depth) OVER (PARTITION BY series ORDER BY idx ROWS BETWEEN w - 1 PRECEDING AND CURRENT ROW) END AS bottom FROM n""",
    ("track",),
)
def win10(spark, sf):
    return sec.profile_bottom(fx.track(spark, sf), ["series"], "idx", "depth", size=7).select("series", "idx", "depth", "bottom")


MEDIAN_POS = "mp AS (SELECT series, median(lat) AS mlat, median(lon) AS mlon FROM f0 GROUP BY series)"
SUN_EVENTS = f"""f0 AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY us) - 1 AS pos FROM ({FLEET}) q), {MEDIAN_POS},
    st AS (SELECT f0.series, us, mlat, mlon FROM f0 JOIN mp USING (series) WHERE pos % 2 = 0), {SUN_SQL.format(src='st', lat='mlat', lon='mlon')},
    ev AS (SELECT series, us, altitude, lead(altitude) OVER (PARTITION BY series ORDER BY us) AS nxt FROM alt)"""


def fleet_sun(spark, sf):
    return sig.sun_events(fleet(spark, sf), ["series"], "us", "lat", "lon", 2, 10 * DAY)


@query(
    "win12_sun_events",
    f"WITH {SUN_EVENTS} SELECT series, us, round(altitude, 4) AS altitude, altitude > 0 AND nxt < 0 AS is_sunset FROM ev WHERE sign(altitude) <> sign(nxt)",
    ("nav",),
)
def win12(spark, sf):
    return fleet_sun(spark, sf).where("changes").select("series", "us", F.round("altitude", 4).alias("altitude"), "is_sunset")


NIGHTS = f"""{SUN_EVENTS}, e AS (SELECT series, us AS t, altitude > 0 AS is_set FROM ev WHERE sign(altitude) <> sign(nxt)),
    e2 AS (SELECT *, row_number() OVER w - 1 AS k, count(*) OVER (PARTITION BY series) AS n, lead(t) OVER w AS nat, first_value(is_set) OVER w AS fs FROM e WINDOW w AS (PARTITION BY series ORDER BY t)),
    sp AS (SELECT series, min(us) AS a, max(us) AS b FROM f0 GROUP BY series),
    nw AS (SELECT series, a AS night_start, t - 3600000000 AS night_end, true AS start_closed, false AS end_closed FROM e2 JOIN sp USING (series) WHERE k = 0 AND NOT fs
    UNION ALL SELECT series, t + 3600000000, nat - 3600000000, false, false FROM e2 WHERE is_set AND nat IS NOT NULL
    UNION ALL SELECT series, t + 3600000000, b, false, true FROM e2 JOIN sp USING (series) WHERE is_set AND nat IS NULL AND n % 2 = 1)"""


def fleet_nights(spark, sf):
    spans = fleet(spark, sf).groupBy("series").agg(F.min("us").alias("start"), F.max("us").alias("end"))
    return sig.night_windows(durable(fleet_sun(spark, sf)), spans, ["series"], "us")


@query("win13_night_windows", f"WITH {NIGHTS} SELECT * FROM nw", ("nav",))
def win13(spark, sf):
    return fleet_nights(spark, sf)


@query(
    "win13_select_nights",
    f"""WITH {NIGHTS} SELECT f0.series, seq, us FROM f0 JOIN nw ON f0.series = nw.series AND (us > night_start OR (start_closed AND us = night_start)) AND (us < night_end OR (end_closed AND us = night_end))""",
    ("nav",),
)
def win13_rows(spark, sf):
    return sig.select_nights(fleet(spark, sf), fleet_nights(spark, sf), ["series"], "us", 10 * DAY).select("series", "seq", "us")


@query(
    "win14_night_spans",
    f"""WITH f0 AS ({FLEET}), st AS (SELECT * FROM f0), {SUN_SQL.format(src='st', lat='lat', lon='lon')},
    d AS (SELECT series, us, seq AS km, altitude < 0 AS dark, row_number() OVER (PARTITION BY series ORDER BY us) - row_number() OVER (PARTITION BY series, altitude < 0 ORDER BY us) AS grp FROM alt)
    SELECT series, min(us) AS start, arg_min(km, us) AS start_km, arg_max(km, us) AS end_km FROM d WHERE dark GROUP BY series, grp""",
    ("nav",),
)
def win14(spark, sf):
    from tidemark.functions.geo import sun_altitude

    df = fleet(spark, sf).withColumn("altitude", sun_altitude(F.col("lat"), F.col("lon"), F.col("us")))
    return sig.night_spans(df, ["series"], "us", "altitude", "seq", 10 * DAY)


ENVELOPE = """raw AS (SELECT series, idx, (idx*1000000)//60 AS us, value*1e9 AS x FROM rate60),
    roll AS (SELECT *, min(x) OVER w AS lo, median(x) OVER w AS mid FROM raw WINDOW w AS (PARTITION BY series ORDER BY idx ROWS BETWEEN 150 PRECEDING AND 149 FOLLOWING)),
    bgr AS (SELECT *, avg(lo) OVER w AS min_bg, avg(mid) OVER w AS med_bg FROM roll WINDOW w AS (PARTITION BY series ORDER BY idx ROWS BETWEEN 150 PRECEDING AND 149 FOLLOWING)),
    env AS (SELECT *, greatest(2*med_bg - min_bg, med_bg + 1.5e10) AS max_bg FROM bgr)"""


def raw60(spark, sf):
    return fx.rate60(spark, sf).select("series", "idx", F.floor(F.col("idx") * 1_000_000 / 60).alias("us"), (F.col("value") * 1e9).alias("x"))


def envelope(spark, sf):
    return sig.background_envelope(raw60(spark, sf), ["series"], "idx", "x", size=5_000)


@query(
    "win15_background_envelope",
    f"WITH {ENVELOPE} SELECT series, idx, round(min_bg/1e6, 2) AS min_bg, round(med_bg/1e6, 2) AS med_bg, round(max_bg/1e6, 2) AS max_bg FROM env",
    ("rate60",),
)
def win15(spark, sf):
    return envelope(spark, sf).select("series", "idx", *[F.round(F.col(c) / 1e6, 2).alias(c) for c in ("min_bg", "med_bg", "max_bg")])


FLASHES = f"""{ENVELOPE}, x AS (SELECT series, idx, x FROM raw), {PEAK_SQL},
    fl AS (SELECT env.series, env.idx, env.us, env.x, med_bg, CASE WHEN env.x >= max_bg AND env.x > med_bg + 1e11 THEN pk.x END AS hi, CASE WHEN env.x >= max_bg AND env.x <= med_bg + 1e11 THEN pk.x END AS lo2 FROM env LEFT JOIN pk ON env.series = pk.series AND env.idx = pk.idx),
    cn AS (SELECT series, idx, us, count(hi) OVER w AS high, count(lo2) OVER w AS low, max(x - med_bg) OVER w AS top FROM fl WINDOW w AS (PARTITION BY series ORDER BY idx ROWS BETWEEN 450 PRECEDING AND 449 FOLLOWING)),
    sec1 AS (SELECT series, us//1000000*1000000 AS us, avg(high) AS high, avg(low) AS low, avg(top) AS top FROM cn GROUP BY ALL)"""


def flow(spark, sf):
    seconds = fx.rate60(spark, sf).groupBy("series", (F.floor(F.col("idx") / 60) * 1_000_000).alias("us")).agg(F.max("value").alias("flow"))
    return seconds.withColumn("flow", F.when(F.col("flow") > 200, 350.0).otherwise(F.col("flow") + 100))


@query(
    "win16_flash_rates",
    f"""WITH {FLASHES}, fw AS (SELECT series, us//1000000*1000000 AS us, CASE WHEN max(x)/1e9 > 200 THEN 350.0 ELSE max(x)/1e9 + 100 END AS flow FROM raw GROUP BY ALL)
    SELECT s.series, s.us, round(high/15/flow*1000, 6) AS nbflash_high, round(low/15/flow*1000, 6) AS nbflash_low FROM sec1 s LEFT JOIN fw ON s.series = fw.series AND s.us = fw.us""",
    ("rate60",),
)
def win16(spark, sf):
    counts = sig.flash_counts(durable(envelope(spark, sf)), ["series"], "idx", "x", size=5_000)
    out = sig.flash_rates(counts, flow(spark, sf), ["series"])
    return out.select("series", "us", *[F.round(c, 6).alias(c) for c in ("nbflash_high", "nbflash_low")])


@query("win17_flash_intensity", f"WITH {FLASHES} SELECT series, us, round(top/1e6, 2) AS intflash FROM sec1", ("rate60",))
def win17(spark, sf):
    out = sig.flash_intensity(envelope(spark, sf), ["series"], "idx", "x", size=5_000)
    return out.select("series", "us", F.round(F.col("intflash") / 1e6, 2).alias("intflash"))


_TAPS = sig.fading_response(8, 0.2, 1e-12).tolist()


def _filter_sql(name, source):
    """Each row with the rows before it, weighted by the response; before its start the signal rests."""
    return f"""{name} AS (SELECT l.series, l.n, l.m, sum(t.h * coalesce(b.v, f.v)) AS v FROM {source} l CROSS JOIN taps t
    JOIN {source} f ON f.series = l.series AND f.n = 0 LEFT JOIN {source} b ON b.series = l.series AND b.n = l.n - t.k GROUP BY l.series, l.n, l.m)"""


TAPS_SQL = f"taps AS (SELECT unnest(range({len(_TAPS)})) AS k, unnest({_TAPS!r}::DOUBLE[]) AS h)"


def lowpass_sql(out, source, value):
    """``out`` with ``series, idx, v``: both ways through the filter, 27 rows reflected at the ends."""
    return f"""{out}_s AS (SELECT series, idx, {value} AS x, count(*) OVER (PARTITION BY series) AS c, first_value({value}) OVER (PARTITION BY series ORDER BY idx) AS v0,
      first_value({value}) OVER (PARTITION BY series ORDER BY idx DESC) AS v1 FROM {source}),
    {out}_l AS (SELECT series, idx + 27 AS n, c + 54 AS m, x AS v FROM {out}_s WHERE c > 27
      UNION ALL SELECT series, 27 - idx, c + 54, 2*v0 - x FROM {out}_s WHERE c > 27 AND idx BETWEEN 1 AND 27
      UNION ALL SELECT series, c + 27 + (c - 2 - idx), c + 54, 2*v1 - x FROM {out}_s WHERE c > 27 AND idx BETWEEN c - 28 AND c - 2),
    {_filter_sql(f"{out}_f", f"{out}_l")}, {out}_t AS (SELECT series, m - 1 - n AS n, m, v FROM {out}_f), {_filter_sql(f"{out}_b", f"{out}_t")},
    {out} AS (SELECT s.series, s.idx, b.v FROM {out}_s s LEFT JOIN {out}_b b ON b.series = s.series AND b.m - 1 - b.n = s.idx + 27)"""


@query("win18_lowpass", f"WITH {TAPS_SQL}, {lowpass_sql('flat', 'track', 'depth')} SELECT series, idx, round(v, 6) AS smooth FROM flat", ("track",))
def win18(spark, sf):
    out = sig.lowpass(fx.track(spark, sf), ["series"], "idx", "depth", "smooth", size=5_000)
    return out.select("series", "idx", F.round("smooth", 6).alias("smooth"))


@query(
    "win19_fill_coefficient",
    """WITH v AS (SELECT series, seq, CASE WHEN series % 10 = 0 THEN NULL WHEN value > 20 THEN value END AS c FROM signal),
    m AS (SELECT series, seq, CASE WHEN count(c) OVER w = 3 THEN median(c) OVER w END AS c FROM v WINDOW w AS (PARTITION BY series ORDER BY seq ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING))
    SELECT series, seq, round(coalesce(c, avg(c) OVER (PARTITION BY series), 14700000.0), 6) AS c FROM m""",
    ("signal",),
)
def win19(spark, sf):
    c = F.when((F.col("series") % 10 != 0) & (F.col("value") > 20), F.col("value"))
    clean = median3(fx.signal(spark, sf).select("series", "seq", c.alias("c")), axis("series", "seq", 2_000), ["c"])
    return sig.fill_coefficient(clean, ["series"], "c").select("series", "seq", F.round("c", 6).alias("c"))


@query("win21_simplify")
def win21(spark, sf):
    return sec.simplify(fx.track(spark, sf).withColumn("x", F.col("idx") * 0.1), ["series"], "idx", "x", "depth", 1.0)


@query(
    "win22_midnights",
    f"""WITH f AS ({FLEET}), sp AS (SELECT series, min(us) AS a, max(us) AS b, CAST(round(median(lon)/15) AS BIGINT)*3600000000 AS off FROM f GROUP BY series),
    d AS (SELECT series, a, b, off, unnest(range((a + off)//86400000000, (b + off)//86400000000 + 1)) AS day FROM sp),
    m AS (SELECT series, day*86400000000 - off AS us FROM d WHERE day*86400000000 - off BETWEEN a AND b),
    p AS (SELECT m.series, m.us, f.us AS t0, f.seq AS v0 FROM m ASOF LEFT JOIN f ON m.series = f.series AND m.us >= f.us),
    q AS (SELECT p.*, f.us AS t1, f.seq AS v1 FROM p ASOF LEFT JOIN f ON p.series = f.series AND p.us <= f.us)
    SELECT series, us, round(CASE WHEN t0 = t1 THEN v0 ELSE v0 + (v1 - v0)*((us - t0)/nullif(t1 - t0, 0)::DOUBLE) END, 6) AS km FROM q""",
    ("nav",),
)
def win22(spark, sf):
    track = fleet(spark, sf).withColumn("km", F.col("seq").cast("double"))
    return sec.midnights(track, ["series"], "us", "lon", "km", 10 * DAY).select("series", "us", F.round("km", 6).alias("km"))


KM = f"""f AS ({FLEET}), t AS (SELECT series, us, seq, seq/100.0::DOUBLE AS km, us/1e12 AS used FROM f)"""


def km_track(spark, sf):
    return fleet(spark, sf).select("series", "us", "seq", (F.col("seq") / 100.0).alias("km"), (F.col("us") / 1e12).alias("used"))


@query(
    "agg22_rate_per_km",
    f"""WITH {KM}, sp AS (SELECT series, min(km) AS a, max(km) AS b FROM t GROUP BY series), g AS (SELECT series, a, unnest(range(CAST(ceil(b - a) AS BIGINT))) AS k FROM sp),
    gx AS (SELECT series, k, a + k AS x FROM g), p AS (SELECT gx.*, t.km AS x0, t.used AS v0 FROM gx ASOF LEFT JOIN t ON gx.series = t.series AND gx.x >= t.km),
    q AS (SELECT p.*, t.km AS x1, t.used AS v1 FROM p ASOF LEFT JOIN t ON p.series = t.series AND p.x <= t.km),
    v AS (SELECT series, k, CASE WHEN x0 = x1 THEN v0 ELSE v0 + (v1 - v0)*((x - x0)/nullif(x1 - x0, 0)) END AS v FROM q),
    r AS (SELECT series, k, coalesce((lead(v) OVER w - lag(v) OVER w)/2, lead(v) OVER w - v, v - lag(v) OVER w) AS rate FROM v WINDOW w AS (PARTITION BY series ORDER BY k))
    SELECT series, round(avg(rate), 6) AS mean_rate, round(arg_max(rate, k), 6) AS last_rate FROM r GROUP BY series""",
    ("nav",),
)
def agg22(spark, sf):
    out = sec.rate_per_km(km_track(spark, sf), ["series"], "us", "km", "used", 20)
    return out.select("series", F.round("mean_rate", 6).alias("mean_rate"), F.round("last_rate", 6).alias("last_rate"))


@query(
    "agg23_log_ranges",
    f"""WITH {KM}, l AS (SELECT user_id % 10 AS series, concat('log', event_id // 500) AS label, min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS b FROM events WHERE event_type = 'signup' GROUP BY ALL)
    SELECT t.series, label, arg_min(km, us) AS start_km, arg_max(km, us) AS end_km FROM t JOIN l ON t.series = l.series AND us >= a AND us < b GROUP BY ALL""",
    ("nav",),
)
def agg23(spark, sf):
    e = table(spark, sf, "events").where("event_type = 'signup'").select(
        (F.col("user_id") % 10).alias("series"),
        F.concat(F.lit("log"), F.floor(F.col("event_id") / 500).cast("string")).alias("label"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
    )
    logs = e.groupBy("series", "label").agg(F.min("us").alias("start"), F.max("us").alias("end"), F.min("us").alias("position"))
    return sec.log_ranges(km_track(spark, sf), logs, ["series"], "us", "km")


#: Cells of the rows ``d``, filled along depth.
SECT = """sh AS (SELECT series, min(x) AS x0, max(x) AS x1, greatest(2, 3*max(profile)) AS nx, greatest(10.0, floor(max(CASE WHEN v IS NOT NULL THEN depth END)/10)*10) AS bottom FROM d GROUP BY series),
    c AS (SELECT d.series, CAST(floor((x - x0)/((x1 - x0)/(nx - 1)) + 0.5) AS BIGINT) AS xi, CAST(floor(depth/0.5 + 0.5) AS BIGINT) AS zi, avg(v) AS v FROM d JOIN sh USING (series) WHERE v IS NOT NULL GROUP BY ALL),
    g AS (SELECT series, xi, unnest(range(CAST(floor(bottom/0.5) AS BIGINT) + 1)) AS zi FROM (SELECT DISTINCT c.series, xi, bottom FROM c JOIN sh USING (series)) q),
    p AS (SELECT g.*, c.zi AS z0, c.v AS v0 FROM g ASOF LEFT JOIN c ON g.series = c.series AND g.xi = c.xi AND g.zi >= c.zi),
    q AS (SELECT p.*, c.zi AS z1, c.v AS v1 FROM p ASOF LEFT JOIN c ON p.series = c.series AND p.xi = c.xi AND p.zi <= c.zi),
    sect AS (SELECT series, xi, zi, CASE WHEN v0 IS NULL OR v1 IS NULL THEN NULL WHEN z0 = z1 THEN v0 ELSE v0 + (v1 - v0)*((zi - z0)/nullif(z1 - z0, 0)::DOUBLE) END AS v FROM q)"""
SECTION = f"""d AS (SELECT user_id % 5 AS series, event_id AS x, value % 90 AS depth, CAST(event_id // 2000 AS INT) + 1 AS profile, CASE WHEN event_id % 4 > 0 THEN value END AS v FROM events),
    {SECT}"""


def section(spark, sf):
    d = table(spark, sf, "events").select(
        (F.col("user_id") % 5).alias("series"),
        F.col("event_id").cast("double").alias("x"),
        (F.col("value") % 90).alias("z"),
        (F.floor(F.col("event_id") / 2000) + 1).alias("profile"),
        F.when(F.col("event_id") % 4 > 0, F.col("value")).alias("v"),
    )
    return sec.grid_section(d, ["series"], "x", "z", "profile", "v", size=40)


@query("agg24_grid_section", f"WITH {SECTION} SELECT series, xi, zi, zi*0.5::DOUBLE AS depth, round(v, 6) AS v FROM sect")
def agg24(spark, sf):
    return section(spark, sf).select("series", "xi", "zi", "depth", F.round("v", 6).alias("v"))


@query(
    "agg25_cross_calibrate",
    f"""WITH {SECTION}, a AS (SELECT series AS pair, xi, zi, log10(v) AS x FROM sect WHERE v > 0), b AS (SELECT series - 1 AS pair, xi, zi, log10(v) AS y FROM sect WHERE v > 0)
    SELECT pair, xi, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept, round(regr_r2(y, x), 6) AS r2, count(*) AS n FROM a JOIN b USING (pair, xi, zi) GROUP BY pair, xi""",
)
def agg25(spark, sf):
    field = durable(section(spark, sf))
    left, right = (field.withColumn("pair", F.col("series") - k).drop("series") for k in (0, 1))
    out = sec.cross_calibrate(left, right, ["pair", "xi", "zi"], ["pair", "xi"], "v", "v", log=True)
    return out.withColumns({c: F.round(c, 6) for c in ("slope", "intercept", "r2")})

