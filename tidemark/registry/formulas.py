"""Queries for the column expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import biology as bio
from tidemark.functions import geo, optics
from tidemark.functions import seawater as sw
from tidemark.operators import timejoin as tj
from tidemark.operators.ordered import axis
from tidemark.registry import inputs as fx
from tidemark.registry.core import query
from tidemark.registry.inputs import DAY, table

LINE = ["l_orderkey", "l_linenumber", "l_partkey"]
KEY = ", ".join(LINE)


def power_sql(x, coefficients):
    """Polynomial as a sum of powers."""
    return "(" + " + ".join(f"({c!r})" if i == 0 else f"({c!r})*pow({x}, {i})" for i, c in enumerate(coefficients)) + ")"


def lines(spark, sf):
    return table(spark, sf, "lineitem")


# One published thermistor and conductivity calibration of each form.
TEMP = dict(f0=2999.5, a=3.68121e-3, b=6.0e-4, c=1.6e-5, d=2.1e-6)
COND_A = dict(a=2.0e-5, b=4.5e-1, c=-4.0, d=-9.5e-5, m=4.0)
COND_G = dict(g=-10.2, h=1.4, i=-1.2e-3, j=1.7e-4, tcor=3.25e-6, pcor=-9.57e-8)


@query(
    "fn1_temperature",
    f"""SELECT {KEY}, round(1.0/(3.68121e-3 + 6.0e-4*L + 1.6e-5*L*L + 2.1e-6*L*L*L) - 273.15, 6) AS temperature
    FROM (SELECT {KEY}, ln(2999.5/(2000 + l_quantity*10)) AS L FROM lineitem) q""",
)
def fn1(spark, sf):
    c = {k: F.lit(v) for k, v in TEMP.items()}
    t = sw.temperature_from_frequency(F.lit(2000) + F.col("l_quantity") * 10, c["f0"], c["a"], c["b"], c["c"], c["d"])
    return lines(spark, sf).select(*LINE, F.round(t, 6).alias("temperature"))


@query(
    "fn2_conductivity",
    f"""SELECT {KEY}, round((2.0e-5*pow(f, 4.0) + 4.5e-1*f*f - 4.0 - 9.5e-5*temp)/(10*(1 + pow(2.0, -52)*pres)), 6) AS cond_a,
    round((-10.2 + (1.4 + (-1.2e-3 + 1.7e-4*f)*f)*f*f)/(10*(1 + 3.25e-6*temp - 9.57e-8*pres)), 6) AS cond_g FROM (SELECT *, 4 + sal/33 AS f FROM ctd) q""",
    ("ctd",),
)
def fn2(spark, sf):
    df = fx.ctd(spark, sf).withColumn("f", F.lit(4) + F.col("sal") / 33)
    a = sw.conductivity_set_a(F.col("f"), F.col("temp"), F.col("pres"), **COND_A)
    g = sw.conductivity_set_g(F.col("f"), F.col("temp"), F.col("pres"), **COND_G)
    return df.select(*LINE, F.round(a, 6).alias("cond_a"), F.round(g, 6).alias("cond_g"))


SAL_SQL = f"""WITH r AS (SELECT {KEY}, 0.6 + l_quantity/100 AS r, (4 + l_discount*100)*1.00024 AS t, l_tax*10000 AS p FROM lineitem),
    x AS (SELECT *, sqrt(r/((1 + p*{power_sql('p', (2.070e-5, -6.370e-10, 3.989e-15))}/(1 + 3.426e-2*t + 4.464e-4*t*t + (4.215e-1 - 3.107e-3*t)*r))*{power_sql('t', (0.6766097, 2.00564e-2, 1.104259e-4, -6.9698e-7, 1.0031e-9))})) AS w FROM r)
    SELECT {KEY}, round({power_sql('w', (0.0080, -0.1692, 25.3851, 14.0941, -7.0261, 2.7081))} + (t - 15)/(1 + 0.0162*(t - 15))*{power_sql('w', (0.0005, -0.0056, -0.0066, -0.0375, 0.0636, -0.0144))}, 6) AS salinity FROM x"""


@query("fn3_salinity", SAL_SQL)
def fn3(spark, sf):
    s = sw.salinity(F.lit(0.6) + F.col("l_quantity") / 100, F.lit(4) + F.col("l_discount") * 100, F.col("l_tax") * 10000)
    return lines(spark, sf).select(*LINE, F.round(s, 6).alias("salinity"))


SURFACE_SQL = (
    power_sql("t", (999.842594, 6.793952e-2, -9.095290e-3, 1.001685e-4, -1.120083e-6, 6.536332e-9))
    + " + ("
    + power_sql("t", (8.24493e-1, -4.0899e-3, 7.6438e-5, -8.2467e-7, 5.3875e-9))
    + " + "
    + power_sql("t", (-5.72466e-3, 1.0227e-4, -1.6546e-6))
    + "*sqrt(sal) + 4.8314e-4*sal)*sal"
)
DENSITY_SQL = f"""d AS (SELECT *, temp*1.00024 AS t, pres/10 AS bar FROM ctd), k AS (SELECT *, {SURFACE_SQL} AS rho0,
    {power_sql('t', (19652.21, 148.4206, -2.327105, 1.360477e-2, -5.155288e-5))} + ({power_sql('t', (54.6746, -0.603459, 1.09987e-2, -6.1670e-5))} + {power_sql('t', (7.944e-2, 1.6483e-2, -5.3009e-4))}*sqrt(sal))*sal AS k0,
    {power_sql('t', (3.239908, 1.43713e-3, 1.16092e-4, -5.77905e-7))} + ({power_sql('t', (2.2838e-3, -1.0981e-5, -1.6078e-6))} + 1.91075e-4*sqrt(sal))*sal AS a,
    {power_sql('t', (8.50935e-5, -6.12293e-6, 5.2787e-8))} + {power_sql('t', (-9.9348e-7, 2.0816e-8, 9.1697e-10))}*sal AS b FROM d),
    rho AS (SELECT *, rho0/(1 - bar/(k0 + a*bar + b*bar*bar)) AS rho FROM k)"""


@query(
    "fn4_density_pressure",
    f"""WITH {DENSITY_SQL} SELECT {KEY}, round(rho, 5) AS rho, round((1 - c - sqrt((1 - c)*(1 - c) - 8.84e-6*pres))/4.42e-6, 5) AS dbar
    FROM (SELECT *, 5.92e-3 + pow(sin(radians(36.8)), 2)*5.25e-3 AS c FROM rho) q""",
    ("ctd",),
)
def fn4(spark, sf):
    rho = sw.density(F.col("sal"), F.col("temp"), F.col("pres"))
    return fx.ctd(spark, sf).select(
        *LINE, F.round(rho, 5).alias("rho"), F.round(sw.pressure(F.col("pres"), 36.8), 5).alias("dbar")
    )


@query("fn5_sigma0", f"WITH {DENSITY_SQL} SELECT {KEY}, round(rho0 - 1000, 6) AS sigma0 FROM k", ("ctd",))
def fn5(spark, sf):
    return fx.ctd(spark, sf).select(*LINE, F.round(sw.sigma0(F.col("sal"), F.col("temp")), 6).alias("sigma0"))


def sound_sql():
    rows = [f"{power_sql('t', r)}*pow(bar, {i})" for i, r in enumerate(sw.SOUND_C)]
    arow = [f"{power_sql('t', r)}*pow(bar, {i})" for i, r in enumerate(sw.SOUND_A)]
    brow = [f"{power_sql('t', r)}*pow(bar, {i})" for i, r in enumerate(sw.SOUND_B)]
    return f"{' + '.join(rows)} + ({' + '.join(arow)})*sal + ({' + '.join(brow)})*pow(sal, 1.5) + {power_sql('bar', sw.SOUND_D)}*sal*sal"


@query(
    "fn6_sound_speed",
    f"""SELECT {KEY}, round({sound_sql()}, 5) AS sound_speed FROM (SELECT *, temp*1.00024 AS t, pres/10 AS bar FROM ctd) q""",
    ("ctd",),
)
def fn6(spark, sf):
    c = sw.sound_speed(F.col("sal"), F.col("temp"), F.col("pres"))
    return fx.ctd(spark, sf).select(*LINE, F.round(c, 5).alias("sound_speed"))


OXSAT = "exp(-173.4292 + 249.6339*100/(273.15 + temp) + 143.3483*ln((273.15 + temp)/100) - 21.8492*(273.15 + temp)/100 + sal*(-0.033096 + 0.014259*(273.15 + temp)/100 - 0.00170*pow((273.15 + temp)/100, 2)))"


@query("fn7_oxygen_saturation", f"SELECT {KEY}, round({OXSAT}, 6) AS oxsat FROM ctd", ("ctd",))
def fn7(spark, sf):
    return fx.ctd(spark, sf).select(*LINE, F.round(sw.oxygen_saturation(F.col("temp"), F.col("sal")), 6).alias("oxsat"))


OWENS = dict(soc=0.4, voff=-0.5, boc=0.01, tcor=0.0017, pcor=1.35e-4)


@query(
    "fn8_oxygen_owens_millard",
    f"""WITH s AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY {KEY}) AS rn FROM ctd)
    SELECT {KEY}, round(CASE WHEN rn > 1 THEN (0.4*(volts - 0.5) + 0.01*exp(-0.03*temp))*exp(0.0017*temp + 1.35e-4*pres)*{OXSAT} END, 6) AS o2 FROM s""",
    ("ctd",),
)
def fn8(spark, sf):
    from tidemark.operators.ordered import previous, scan

    df = scan(fx.ctd(spark, sf), axis("l_suppkey", LINE, 20_000), before=previous(F.col("volts")))
    o2 = sw.oxygen_owens_millard(F.col("volts"), F.col("temp"), F.col("sal"), F.col("pres"), F.col("before"), **OWENS)
    return df.select(*LINE, F.round(o2, 6).alias("o2"))


@query(
    "fn9_oxygen_sbe43",
    f"""SELECT {KEY}, round(0.42*(volts - 0.49)*(1.0 - 3.1e-3*temp + 1.6e-4*temp*temp - 2.4e-6*temp*temp*temp)*{OXSAT}*exp(0.036*pres/(273.15 + temp)), 6) AS o2 FROM ctd""",
    ("ctd",),
)
def fn9(spark, sf):
    o2 = sw.oxygen_sbe43(
        F.col("volts"), F.col("temp"), F.col("sal"), F.col("pres"), soc=0.42, offset=-0.49, a=-3.1e-3, b=1.6e-4, c=-2.4e-6, e=0.036
    )
    return fx.ctd(spark, sf).select(*LINE, F.round(o2, 6).alias("o2"))


@query("fn10_oxygen_umol", f"WITH {DENSITY_SQL} SELECT {KEY}, round(volts*1.4276*1e6/(rho*32), 6) AS umol FROM rho", ("ctd",))
def fn10(spark, sf):
    rho = sw.density(F.col("sal"), F.col("temp"), F.col("pres"))
    return fx.ctd(spark, sf).select(*LINE, F.round(sw.oxygen_umol_per_kg(F.col("volts"), rho), 6).alias("umol"))


@query(
    "fn11_beam",
    f"""WITH t AS (SELECT {KEY}, (volts - 0.7 - 0.006)/(4.701 - 0.006) AS tr FROM ctd)
    SELECT {KEY}, round(tr, 6) AS tr, round(CASE WHEN tr > 0 THEN -1/0.25*ln(tr) END, 6) AS c FROM t""",
    ("ctd",),
)
def fn11(spark, sf):
    tr = optics.transmittance(F.col("volts") - 0.7)
    return fx.ctd(spark, sf).select(*LINE, F.round(tr, 6).alias("tr"), F.round(optics.attenuation(tr), 6).alias("c"))


GAINS = (1.0, 9.8, 97.5, 985.0, 10050.0)
HS2 = dict(mu=4.3, temp_coeff=-1.2e-3, cal_temp=19.0, gains=GAINS, nominal=4871.0)


def absorption_sql(w):
    cell = min((w - 400) // 10, len(optics.ABSORPTION) - 2)
    a, b = optics.ABSORPTION[cell], optics.ABSORPTION[cell + 1]
    star = f"({a!r} + ({b!r} - {a!r})*{(w - 400 - cell * 10) / 10!r})"
    return f"(0.06*{star}*pow(0.1, 0.65)*(1 + 0.2*exp(-0.014*{w - 440})) + 0.01*exp(-0.011*{w - 400}))"


BEAM_SQL = f"""h AS (SELECT {KEY}, CAST(l_extendedprice AS BIGINT) % 65536 AS raw, l_linenumber AS status, l_quantity*5 AS tr FROM lineitem),
    g AS (SELECT *, (CASE WHEN raw > 32767 THEN raw - 65536 ELSE raw END) AS sraw, 1 - 1.2e-3*((tr/5 - 10) - 19.0) AS warm,
    CASE status WHEN 1 THEN 1.0 WHEN 2 THEN 9.8 WHEN 3 THEN 97.5 WHEN 4 THEN 985.0 WHEN 5 THEN 10050.0 ELSE status END AS gain FROM h)"""


#: Counts that keep the formula finite: small where the gain is.
WEAK = "CAST(floor(l_extendedprice) AS BIGINT) % (CASE WHEN l_linenumber BETWEEN 3 AND 5 THEN 65536 ELSE 60 END)"


def hs2_rows(spark, sf):
    return lines(spark, sf).select(
        *LINE, "l_extendedprice", (F.col("l_extendedprice").cast("bigint") % 65536).alias("raw"), F.col("l_linenumber").alias("status"), (F.col("l_quantity") * 5).alias("tr")
    )


@query(
    "fn12_backscatter",
    f"""WITH {BEAM_SQL.replace('CAST(l_extendedprice AS BIGINT) % 65536', WEAK)}, b AS (SELECT *, sraw*4.3/(warm*(gain*4871.0)) AS beta FROM g),
    p AS (SELECT *, 2*pi()*1.08*(beta - 2.18e-4*pow(525/420.0, 4.32)) AS particles FROM b)
    SELECT {KEY}, round(2*pi()*1.08*(exp(0.1486*({absorption_sql(420)} + 0.4*particles/0.015))*beta - 2.18e-4*pow(525/420.0, 4.32)), 6) AS bbp, round(sraw*50/(warm*gain*4871.0), 6) AS fl FROM p""",
)
def fn12(spark, sf):
    df = hs2_rows(spark, sf).withColumns({"status": F.col("status").cast("int"), "raw": F.expr(WEAK)})
    args = (F.col("raw"), F.col("status"), F.col("tr"))
    _, bbp = optics.backscatter(*args, 420, sigma_exp=0.1486, **HS2)
    fl = optics.fluorescence(*args, temp_coeff=-1.2e-3, cal_temp=19.0, gains=GAINS, nominal=4871.0)
    return df.select(*LINE, F.round(bbp, 6).alias("bbp"), F.round(fl, 6).alias("fl"))


@query(
    "fn13_water_optics",
    f"""WITH w AS (SELECT {KEY}, 400 + CAST(l_quantity AS INT)*6 AS w FROM lineitem),
    tab(i, a) AS (SELECT unnest(range(31)), unnest([{', '.join(map(str, optics.ABSORPTION))}]::DOUBLE[])),
    v AS (SELECT w.*, lo.a + (hi.a - lo.a)*((w - 400)/10.0 - lo.i) AS star FROM w JOIN tab lo ON lo.i = least((w - 400)//10, 29) JOIN tab hi ON hi.i = lo.i + 1)
    SELECT {KEY}, round(2.18e-4*pow(525.0/w, 4.32), 9) AS beta, round(1.17e-3*pow(525.0/w, 4.32), 9) AS bb,
    round(0.06*star*pow(0.1, 0.65)*(1 + 0.2*exp(-0.014*(w - 440))) + 0.01*exp(-0.011*(w - 400)), 9) AS absorption FROM v""",
)
def fn13(spark, sf):
    w = F.lit(400.0) + F.col("l_quantity").cast("int") * 6
    beta, bb = optics.water_scatter(w)
    return lines(spark, sf).select(
        *LINE, F.round(beta, 9).alias("beta"), F.round(bb, 9).alias("bb"), F.round(optics.typical_absorption(w), 9).alias("absorption")
    )


@query(
    "fn14_puck",
    f"""WITH c AS (SELECT {KEY}, 3.2e-6*(l_quantity*20 - 48) AS vol, 0.0121*(l_quantity - 50) AS chl, 33 + l_discount*30 AS sal FROM lineitem)
    SELECT {KEY}, round(vol, 9) AS vol, round(chl, 6) AS chl, round(2*pi()*1.1*(vol - 1.38*pow(700/500.0, -4.32)*(1 + 0.3*sal/37)*1e-4*(1 + pow(cos(117.0/57.29578), 2)*(1 - 0.09)/(1 + 0.09))), 9) AS bbp,
    round(CASE WHEN sal < 35 THEN 0.0022533*pow(700/500.0, -4.23)*1e-4 ELSE 0.0029308*pow(700/500.0, -4.24)*1e-4 END/2, 12) AS bbw FROM c""",
)
def fn14(spark, sf):
    vol = optics.scaled_counts(F.col("l_quantity") * 20, 3.2e-6, 48)
    bbw, bbp = optics.puck_backscatter(vol, F.lit(33) + F.col("l_discount") * 30, 700)
    return lines(spark, sf).select(
        *LINE, F.round(vol, 9).alias("vol"), F.round(optics.scaled_counts(F.col("l_quantity"), 0.0121, 50), 6).alias("chl"),
        F.round(bbp, 9).alias("bbp"), F.round(bbw, 12).alias("bbw"),
    )


@query(
    "fn15_pitch_depth",
    f"SELECT {KEY}, round(pres - (0.1397*sin(radians(pitch)) - 0.2794*cos(radians(pitch))), 6) AS depth FROM ctd",
    ("ctd",),
)
def fn15(spark, sf):
    depth = geo.pitch_corrected_depth(F.col("pres"), 0.1397, -0.2794, F.col("pitch"))
    return fx.ctd(spark, sf).select(*LINE, F.round(depth, 6).alias("depth"))


def krueger_sql():
    e = [f"{a!r}*cos({2 * (j + 1)}*xi)*sinh({2 * (j + 1)}*eta)" for j, a in enumerate(geo._FORWARD)]
    n = [f"{a!r}*sin({2 * (j + 1)}*xi)*cosh({2 * (j + 1)}*eta)" for j, a in enumerate(geo._FORWARD)]
    return " + ".join(e), " + ".join(n)


@query(
    "fn16_utm",
    f"""WITH z AS (SELECT *, CAST(31 + floor(lon/6) AS INT) AS zone FROM nav), a AS (SELECT *, sinh(atanh(sin(radians(lat))) - {geo._ECC!r}*atanh({geo._ECC!r}*sin(radians(lat)))) AS t, radians(lon - (zone*6 - 183)) AS lam FROM z),
    b AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam)/sqrt(1 + t*t)) AS eta FROM a)
    SELECT series, seq, zone, round(500000 + 0.9996::DOUBLE*{geo._RADIUS!r}*(eta + {krueger_sql()[0]}), 3) AS easting, round(0.9996::DOUBLE*{geo._RADIUS!r}*(xi + {krueger_sql()[1]}), 3) AS northing,
    round(lat, 7) AS lat_back, round(lon, 7) AS lon_back FROM b""",
    ("nav",),
)
def fn16(spark, sf):
    df = fx.nav(spark, sf).withColumn("zone", geo.utm_zone(F.col("lon")))
    east, north = geo.utm_forward(F.col("lat"), F.col("lon"), F.col("zone"))
    df = df.withColumns({"e": east, "n": north})
    lat, lon = geo.utm_inverse(F.col("e"), F.col("n"), F.col("zone"))
    return df.select(
        "series", "seq", "zone", F.round("e", 3).alias("easting"), F.round("n", 3).alias("northing"),
        F.round(lat, 7).alias("lat_back"), F.round(lon, 7).alias("lon_back"),
    )


SUN_SQL = """sun AS (SELECT *, us/86400000000.0 - 10957.5 AS d FROM {src}),
    sun2 AS (SELECT *, radians(280.459 + 0.98564736*d + 1.915*sin(radians(357.529 + 0.98560028*d)) + 0.020*sin(2*radians(357.529 + 0.98560028*d))) AS ecl, radians(23.439 - 0.00000036*d) AS tilt FROM sun),
    sun3 AS (SELECT *, asin(sin(tilt)*sin(ecl)) AS dec, radians((18.697374558 + 24.06570982441908*d)*15 + {lon}) - atan2(cos(tilt)*sin(ecl), cos(ecl)) AS ha FROM sun2),
    alt AS (SELECT *, degrees(asin(sin(radians({lat}))*sin(dec) + cos(radians({lat}))*cos(dec)*cos(ha))) AS altitude FROM sun3)"""


@query("fn17_sun_altitude", f"WITH {SUN_SQL.format(src='nav', lat='lat', lon='lon')} SELECT series, seq, round(altitude, 4) AS altitude FROM alt", ("nav",))
def fn17(spark, sf):
    alt = geo.sun_altitude(F.col("lat"), F.col("lon"), F.unix_micros("ts"))
    return fx.nav(spark, sf).select("series", "seq", F.round(alt, 4).alias("altitude"))


@query(
    "fn18_flow_speed",
    f"""WITH f AS (SELECT {KEY}, l_extendedprice/100/nullif(l_linenumber*l_quantity - 7, 0) AS fc FROM lineitem)
    SELECT {KEY}, round(CASE WHEN fc < 7 OR fc > 100 THEN NULL WHEN fc <= 13 THEN 23.10410966*exp(-(-1.481499106*pow(fc, 0.25) + 1.566460406*sqrt(fc) + 0.196311142*fc - 0.05*pow(sqrt(fc), 3)))
    ELSE 0.198996019*exp(-(-2.603059062*pow(fc, 0.25) + 0.892897609*sqrt(fc) + 0.006191239*fc - 0.0013*pow(sqrt(fc), 3))) END, 6) AS speed FROM f""",
)
def fn18(spark, sf):
    speed = bio.flow_speed(F.col("l_extendedprice") / 100, F.col("l_linenumber") * F.col("l_quantity") - 7)
    return lines(spark, sf).select(*LINE, F.round(speed, 6).alias("speed"))


@query(
    "fn19_unpack_words",
    f"""WITH w AS (SELECT {KEY}, CAST((l_orderkey*7919 + l_linenumber) % 65536 AS INT) AS a, CAST((l_partkey*104729) % 65536 AS INT) AS b, CAST((l_suppkey*31 + l_orderkey) % 131072 AS INT) AS c FROM lineitem)
    SELECT {KEY}, a // 32768 AS n, (a // 8) % 2048 AS p, (a % 8)*8 + (b // 2048) % 8 AS e, b % 2048 AS l, c % 65536 AS s FROM w""",
)
def fn19(spark, sf):
    w = lines(spark, sf).select(
        *LINE,
        ((F.col("l_orderkey") * 7919 + F.col("l_linenumber")) % 65536).cast("int").alias("a"),
        ((F.col("l_partkey") * 104729) % 65536).cast("int").alias("b"),
        ((F.col("l_suppkey") * 31 + F.col("l_orderkey")) % 131072).cast("int").alias("c"),
    )
    return w.select(*LINE, *[v.alias(k) for k, v in bio.unpack_words(F.col("a"), F.col("b"), F.col("c")).items()])


@query(
    "fn20_rpm_to_flow",
    """SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity*20*CASE WHEN l_shipdate < TIMESTAMP '1998-06-29' THEN 0.45 ELSE 0.449 END, 6) AS flow FROM lineitem""",
)
def fn20(spark, sf):
    dim = spark.sql("SELECT * FROM VALUES (TIMESTAMP '1990-01-01', 0.45D), (TIMESTAMP '1998-06-29', 0.449D) AS t(valid_from, conversion)")
    df = lines(spark, sf).select(*LINE, "l_quantity", F.col("l_shipdate").cast("timestamp").alias("at"))
    flow = bio.rpm_to_flow(F.col("l_quantity") * 20, F.col("conversion"))
    return tj.effective(df, dim, "at", "valid_from").select(*LINE, F.round(flow, 6).alias("flow"))


@query(
    "fn21_drift",
    """WITH d AS (SELECT *, lag(lat) OVER w AS lat0, lag(lon) OVER w AS lon0, (us - lag(us) OVER w)/1e6 AS sec FROM gps WINDOW w AS (PARTITION BY series ORDER BY us))
    SELECT series, seq, round((lon - lon0)*cos(radians(lat))*60*185300/sec, 6) AS u_drift, round((lat - lat0)*60*185300/sec, 6) AS v_drift FROM d""",
    ("gps",),
)
def fn21(spark, sf):
    from tidemark.operators.ordered import previous, scan

    g = fx.gps(spark, sf).withColumn("us", F.unix_micros("ts"))
    d = scan(g, axis("series", "us", 10 * DAY), lat0=previous(F.col("lat")), lon0=previous(F.col("lon")), us0=previous(F.col("us")))
    sec = (F.col("us") - F.col("us0")) / 1e6
    u = bio.drift_cm_per_s(F.col("lon") - F.col("lon0"), sec, F.col("lat"))
    v = bio.drift_cm_per_s(F.col("lat") - F.col("lat0"), sec)
    return d.select("series", "seq", F.round(u, 6).alias("u_drift"), F.round(v, 6).alias("v_drift"))


PROXY_IN = f"""SELECT {KEY}, nullif(l_discount, 0.04) AS fluo, nullif(l_tax, 0.02)*1e14 AS bg, nullif(l_quantity, 7)/25 - 1 AS r FROM lineitem"""
PROXY_SQL = f"""p AS (SELECT {KEY}, r, fluo, bg/3.9811e13 AS pseudo FROM ({PROXY_IN}) q),
    x AS (SELECT {KEY}, r, CASE WHEN fluo < pseudo THEN fluo WHEN fluo IS NOT NULL THEN pseudo END/0.0047 AS adinos, (pseudo - CASE WHEN fluo < pseudo THEN fluo WHEN fluo IS NOT NULL THEN pseudo END)/0.0047 AS hdinos,
    CASE WHEN fluo IS NULL OR pseudo IS NULL THEN NULL WHEN fluo < pseudo THEN 0.0 ELSE (fluo - pseudo)/0.0047 END AS diatoms FROM p)"""


def proxy_rows(spark, sf):
    df = lines(spark, sf).select(
        *LINE,
        F.nullif(F.col("l_discount"), F.lit(0.04)).alias("fluo"),
        (F.nullif(F.col("l_tax"), F.lit(0.02)) * 1e14).alias("bg"),
        (F.nullif(F.col("l_quantity"), F.lit(7.0)) / 25 - 1).alias("r"),
    )
    return df.select(*LINE, "r", *[v.alias(k) for k, v in bio.proxies(F.col("fluo"), F.col("bg"), 3.9811e13, 0.0047).items()])


@query("fn22_proxies", f"WITH {PROXY_SQL} SELECT {KEY}, round(adinos, 6) AS adinos, round(hdinos, 6) AS hdinos, round(diatoms, 6) AS diatoms FROM x")
def fn22(spark, sf):
    return proxy_rows(spark, sf).select(*LINE, *[F.round(c, 6).alias(c) for c in ("adinos", "hdinos", "diatoms")])


@query(
    "fn23_corrected_proxies",
    f"""WITH {PROXY_SQL}, f AS (SELECT *, CASE WHEN r IS NULL THEN NULL WHEN (r + 1)/2*0.8 + 0.2 < 0 THEN 0 ELSE (r + 1)/2*0.8 + 0.2 END AS f FROM x)
    SELECT {KEY}, round(adinos*f, 6) AS adinos, round(adinos + hdinos - adinos*f, 6) AS hdinos, round(adinos + diatoms - adinos*f, 6) AS diatoms FROM f""",
)
def fn23(spark, sf):
    df = proxy_rows(spark, sf)
    fixed = bio.corrected(F.col("adinos"), F.col("diatoms"), F.col("hdinos"), F.col("r"))
    return df.select(*LINE, *[F.round(fixed[c], 6).alias(c) for c in ("adinos", "hdinos", "diatoms")])


@query(
    "fn24_sample_text",
    """SELECT seq, strftime(ts, '%m/%d/%Y') AS day, strftime(ts, '%H:%M') AS clock, dayofyear(ts) AS yd, round(dayofyear(ts) + (epoch_us(ts) - epoch_us(date_trunc('day', ts)))/86400000000.0, 6) AS year_day,
    printf('%09.3f', -122.125 + seq % 8 * 0.125 + 360.0) AS lon FROM signal""",
    ("signal",),
)
def fn24(spark, sf):
    from tidemark.operators.samples import year_day

    lon = F.lit(-122.125) + F.col("seq") % 8 * 0.125 + 360.0
    return fx.signal(spark, sf).select(
        "seq",
        F.date_format("ts", "MM/dd/yyyy").alias("day"),
        F.date_format("ts", "HH:mm").alias("clock"),
        F.dayofyear("ts").alias("yd"),
        F.round(year_day(F.col("ts")), 6).alias("year_day"),
        F.format_string("%09.3f", lon).alias("lon"),
    )


@query(
    "fn25_best_ctd",
    """WITH c AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN concat('Best CTD is ctd', event_id % 3) WHEN 1 THEN concat('x; ctdToUse = ', event_type, ' y') ELSE event_type END AS comment FROM events)
    SELECT event_id, coalesce(nullif(regexp_extract(comment, 'Best CTD is (ctd1|ctd2)', 1), ''), nullif(regexp_extract(comment, 'ctdToUse = (\\S+)', 1), ''), 'ctd1') AS ctd FROM c""",
)
def fn25(spark, sf):
    n = F.col("event_id") % 4
    comment = (
        F.when(n == 0, F.concat(F.lit("Best CTD is ctd"), (F.col("event_id") % 3).cast("string")))
        .when(n == 1, F.concat(F.lit("x; ctdToUse = "), F.col("event_type"), F.lit(" y")))
        .otherwise(F.col("event_type"))
    )
    return table(spark, sf, "events").select("event_id", bio.best_ctd(comment).alias("ctd"))


@query("fn26_log10_positive", f"SELECT {KEY}, round(CASE WHEN l_quantity > 20 THEN log10(l_quantity - 20) END, 6) AS lg FROM lineitem")
def fn26(spark, sf):
    return lines(spark, sf).select(*LINE, F.round(bio.log10_positive(F.col("l_quantity") - 20), 6).alias("lg"))


@query(
    "arr1_expand_60hz",
    """SELECT sec, label, j, sec*1000000 - 500000 + (j*1000000)//64 AS us, round(v*1.5, 6) AS value FROM (SELECT sec, label, unnest(range(64)) AS j, unnest(samples)::DOUBLE AS v FROM samples) q""",
    ("samples",),
)
def arr1(spark, sf):
    from tidemark.operators.arrays import expand

    coeff = fx.samples(spark, sf).select("sec", F.lit(1.5).alias("coeff"))
    rows = tj.time_join(fx.samples(spark, sf), coeff, ["sec"]).withColumn("us", F.col("sec") * 1_000_000)
    out = expand(rows, "us", "samples", 64, F.col("coeff"), offset_us=-500_000)
    return out.select("sec", "label", "j", "us", F.round("value", 6).alias("value"))


@query(
    "arr1_expand_from_start",
    """SELECT sec, j, sec*1000000 + (j*1000000)//64 AS us, round(v, 6) AS value FROM (SELECT sec, unnest(range(64)) AS j, unnest(samples)::DOUBLE AS v FROM samples) q""",
    ("samples",),
)
def arr1_start(spark, sf):
    from tidemark.operators.arrays import expand

    rows = fx.samples(spark, sf).withColumn("us", F.col("sec") * 1_000_000)
    return expand(rows, "us", "samples", 64).select("sec", "j", "us", F.round("value", 6).alias("value"))


@query(
    "arr2_pivot",
    """SELECT user_id, event_id // 50 AS slot, round(avg(value) FILTER (WHERE event_type = 'click'), 6) AS click, round(avg(value) FILTER (WHERE event_type = 'view'), 6) AS view, round(avg(value) FILTER (WHERE event_type = 'error'), 6) AS error FROM events GROUP BY ALL""",
)
def arr2(spark, sf):
    from tidemark.operators.arrays import to_wide

    e = table(spark, sf, "events").withColumn("slot", F.floor(F.col("event_id") / 50))
    wide = to_wide(e, ["user_id", "slot"], "event_type", "value", ["click", "view", "error"])
    return wide.withColumns({c: F.round(c, 6) for c in ("click", "view", "error")})


@query(
    "arr2_unpivot",
    f"""SELECT {KEY}, var, value FROM (SELECT {KEY}, l_quantity AS quantity, l_discount AS discount, l_tax AS tax FROM lineitem) q UNPIVOT (value FOR var IN (quantity, discount, tax)) u""",
)
def arr2_long(spark, sf):
    from tidemark.operators.arrays import to_long

    df = lines(spark, sf).select(*LINE, F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"))
    return to_long(df, LINE, ["quantity", "discount", "tax"])


@query(
    "set1_concat_logs",
    """WITH u AS (SELECT user_id AS series, epoch_us(date_trunc('minute', ts)) AS us, event_id AS seq, value AS a, NULL::DOUBLE AS b FROM events WHERE event_id % 2 = 0
    UNION ALL SELECT user_id, epoch_us(date_trunc('minute', ts)), event_id, NULL, value FROM events WHERE event_id % 2 = 1 OR event_id % 3 = 0)
    SELECT series, us, seq, a, b FROM (SELECT *, row_number() OVER (PARTITION BY series, us ORDER BY seq, b IS NOT NULL) AS rn FROM u) q WHERE rn = 1""",
)
def set1(spark, sf):
    from tidemark.operators.arrays import concat_logs

    e = table(spark, sf, "events").select(
        F.col("user_id").alias("series"), F.unix_micros(F.date_trunc("minute", F.col("ts").cast("timestamp"))).alias("us"), F.col("event_id").alias("seq"), "value"
    )
    first = e.where("seq % 2 = 0").withColumnRenamed("value", "a")
    second = e.where("seq % 2 = 1 OR seq % 3 = 0").withColumnRenamed("value", "b")
    return concat_logs([first, second], ["series"], "us", "seq", unique=True).select("series", "us", "seq", "a", "b")


@query(
    "set1_concat_logs_all",
    """SELECT user_id AS series, event_id AS seq, value AS a, NULL::DOUBLE AS b FROM events WHERE event_id % 2 = 0 UNION ALL SELECT user_id, event_id, NULL, value FROM events WHERE event_id % 2 = 1 OR event_id % 3 = 0""",
)
def set1_all(spark, sf):
    from tidemark.operators.arrays import concat_logs

    e = table(spark, sf, "events").select(F.col("user_id").alias("series"), F.col("event_id").alias("seq"), "value")
    parts = [e.where("seq % 2 = 0").withColumnRenamed("value", "a"), e.where("seq % 2 = 1 OR seq % 3 = 0").withColumnRenamed("value", "b")]
    return concat_logs(parts, ["series"], "seq", "seq", unique=False).select("series", "seq", "a", "b")


@query(
    "set2_index_sets",
    """WITH a AS (SELECT event_id FROM events WHERE value > 60), b AS (SELECT event_id FROM events WHERE event_type = 'click')
    SELECT event_id, 'any' AS kind FROM (SELECT * FROM a UNION SELECT * FROM b) q UNION ALL SELECT event_id, 'both' FROM (SELECT * FROM a INTERSECT SELECT * FROM b) r""",
)
def set2(spark, sf):
    e = table(spark, sf, "events")
    a, b = e.where("value > 60").select("event_id"), e.where("event_type = 'click'").select("event_id")
    return a.union(b).distinct().withColumn("kind", F.lit("any")).union(a.intersect(b).withColumn("kind", F.lit("both")))


@query(
    "srt1_latest_profile",
    """SELECT s.series, seq, us FROM signal s JOIN (SELECT series, max(seq // 500) AS p FROM signal GROUP BY series) m ON m.series = s.series AND s.seq // 500 = m.p""",
    ("signal",),
)
def srt1(spark, sf):
    from tidemark.operators.arrays import latest_profile

    df = fx.signal_us(spark, sf).withColumn("profile", F.floor(F.col("seq") / 500))
    return latest_profile(df, ["series"], "profile").select("series", "seq", "us").orderBy("us")


@query(
    "srt2_last_pick",
    """SELECT series, arg_max(seq, us) AS last_seq, arg_min(seq, abs(value - 50)) AS nearest FROM signal GROUP BY series""",
    ("signal",),
)
def srt2(spark, sf):
    return fx.signal_us(spark, sf).groupBy("series").agg(
        F.max_by("seq", "us").alias("last_seq"), F.min_by("seq", F.struct(F.abs(F.col("value") - 50), "us")).alias("nearest")
    )
