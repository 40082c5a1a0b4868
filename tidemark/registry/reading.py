"""Queries for selections, log parsers and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.samples import sample_means
from tidemark.registry import inputs as fx
from tidemark.registry.core import query
from tidemark.registry.inputs import table
from tidemark.session import shared_folder
from tidemark.sources import logs, selection, sinks


def orders(spark, sf):
    return table(spark, sf, "orders").withColumn("day", F.col("o_orderdate").cast("timestamp"))


def at(text):
    return F.lit(text).cast("timestamp")


@query(
    "src1_select_missions",
    """SELECT o_orderkey, 'one year' AS kind FROM orders WHERE year(o_orderdate) = 1997 AND dayofyear(o_orderdate) BETWEEN 30 AND 200
    UNION ALL SELECT o_orderkey, 'two years' FROM orders WHERE year(o_orderdate) BETWEEN 1997 AND 1998""",
)
def src1(spark, sf):
    o = orders(spark, sf)
    one = selection.select_missions(o, "day", (1997, 1997), (30, 200)).select("o_orderkey", F.lit("one year").alias("kind"))
    return one.union(selection.select_missions(o, "day", (1997, 1998), (30, 200)).select("o_orderkey", F.lit("two years")))


MANIFEST = """SELECT o_orderkey, o_orderstatus AS platform, substr(strftime(o_orderdate + INTERVAL 1 MINUTE * (o_orderkey % 1440), '%Y%m%dT%H%M%S'), 1, CASE o_orderkey % 3 WHEN 0 THEN 15 WHEN 1 THEN 13 ELSE 11 END) AS dir,
    concat(strftime(o_orderdate, '%Y%m%d%H%M'), '_', strftime(o_orderdate + INTERVAL 1 HOUR, '%Y%m%d%H%M'), CASE WHEN o_orderkey % 5 = 0 THEN '_combined.nc4' ELSE '.nc4' END) AS name FROM orders"""


def manifest(spark, sf):
    start = F.col("day") + F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))
    k = F.col("o_orderkey") % 3
    stamp = F.date_format(start, "yyyyMMdd'T'HHmmss")
    end = F.when(F.col("o_orderkey") % 5 == 0, "_combined.nc4").otherwise(".nc4")
    name = F.concat(F.date_format("day", "yyyyMMddHHmm"), F.lit("_"), F.date_format(F.col("day") + F.expr("INTERVAL 1 HOUR"), "yyyyMMddHHmm"), end)
    return orders(spark, sf).select(
        "o_orderkey", F.col("o_orderstatus").alias("platform"), F.substr(stamp, F.lit(1), F.when(k == 0, 15).when(k == 1, 13).otherwise(11)).alias("dir"), name.alias("name")
    )


@query(
    "src2_select_logs",
    f"""WITH m AS ({MANIFEST}), p AS (SELECT *, strptime(rpad(dir, 15, '0'), '%Y%m%dT%H%M%S') AS t FROM m)
    SELECT o_orderkey, name, epoch_us(t) AS us FROM p WHERE o_orderkey % 5 <> 0 AND platform = 'F' AND t BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1999-06-01 10:00:00'""",
)
def src2(spark, sf):
    chosen = selection.select_logs(manifest(spark, sf), "dir", "name", at("1996-03-01"), at("1999-06-01 10:00:00"), "f")
    return chosen.select("o_orderkey", "name", F.unix_micros("directory_time").alias("us")).orderBy("name")


@query("src3_last_days", "SELECT o_orderkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '2001-01-01' - INTERVAL 45 DAY AND TIMESTAMP '2001-01-01'")
def src3(spark, sf):
    return selection.last_days(orders(spark, sf), "day", 45, at("2001-01-01")).select("o_orderkey")


@query(
    "src4_stale",
    """SELECT o.o_orderkey FROM orders o LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS m FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey WHERE m IS NULL OR o_orderdate > m""",
)
def src4(spark, sf):
    outputs = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("mtime"))
    sources = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("mtime"))
    return selection.stale(sources, outputs, ["o_orderkey"]).select("o_orderkey")


DLIST = """SELECT o_custkey AS deployment, o_orderkey AS line_no, CASE o_orderkey % 6 WHEN 0 THEN concat('# skipped ', o_orderkey) WHEN 1 THEN '   ' WHEN 2 THEN concat(' ', o_orderkey, 'T00 ') ELSE concat(o_orderkey, 'T00') END AS line FROM orders"""


def dlist(spark, sf):
    key = F.col("o_orderkey").cast("string")
    k = F.col("o_orderkey") % 6
    line = (
        F.when(k == 0, F.concat(F.lit("# skipped "), key)).when(k == 1, "   ").when(k == 2, F.concat(F.lit(" "), key, F.lit("T00 "))).otherwise(F.concat(key, F.lit("T00")))
    )
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("deployment"), F.col("o_orderkey").alias("line_no"), line.alias("line"))


@query(
    "src5_pending",
    f"""WITH d AS ({DLIST}), n AS (SELECT deployment, trim(line) AS directory FROM d WHERE trim(line) <> '' AND NOT starts_with(trim(line), '#'))
    SELECT n.deployment, directory FROM n WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = n.deployment AND o_orderstatus = 'F' AND concat(o_orderkey, 'T00') = directory)""",
)
def src5(spark, sf):
    outputs = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("deployment"), F.concat(F.col("o_orderkey").cast("string"), F.lit("T00")).alias("directory")
    )
    return selection.pending(dlist(spark, sf), outputs, ["deployment"]).select("deployment", "directory")


@query(
    "src6_deployment_name",
    """WITH l AS (SELECT o_custkey AS deployment, arg_min(CASE WHEN o_orderkey % 4 < 2 THEN concat('# Deployment NAME:  Tour ', o_orderkey, ' ') ELSE concat('T', o_orderkey) END, o_orderkey) AS f FROM orders GROUP BY 1)
    SELECT deployment, CASE WHEN starts_with(lower(f), '# deployment name:') THEN trim(substr(f, 19)) END AS name FROM l""",
)
def src6(spark, sf):
    key = F.col("o_orderkey").cast("string")
    named = F.concat(F.lit("# Deployment NAME:  Tour "), key, F.lit(" "))
    lines = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("deployment"), F.col("o_orderkey").alias("line_no"), F.when(F.col("o_orderkey") % 4 < 2, named).otherwise(F.concat(F.lit("T"), key)).alias("line")
    )
    return selection.deployment_name(lines, ["deployment"])


HEADER = "# log\n# integer key %d ,Key ,count\n# short line %d ,Line ,count\n# begin\n"


@query(
    "src7_read_logs",
    """WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, unnest(range(3)) AS seq FROM lineitem)
    SELECT concat(l_orderkey, '/', l_linenumber, '/', l_partkey) AS path, seq, 'key' AS var, CAST(l_orderkey + seq AS DOUBLE) AS value FROM r
    UNION ALL SELECT concat(l_orderkey, '/', l_linenumber, '/', l_partkey), seq, 'line', CAST(l_linenumber AS DOUBLE) FROM r""",
)
def src7(spark, sf):
    def little_endian(col, size):
        text = F.lpad(F.hex(col), 2 * size, "0")
        return F.concat(*[F.substring(text, 2 * i - 1, 2) for i in range(size, 0, -1)])

    records = [F.concat(little_endian(F.col("l_orderkey") + i, 4), little_endian(F.col("l_linenumber"), 2)) for i in range(3)]
    cut_off = F.lit("0102")
    content = F.concat(F.encode(F.lit(HEADER), "UTF-8"), F.unhex(F.concat(*records, cut_off)))
    path = F.concat_ws("/", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey")])
    return logs.decode_logs(table(spark, sf, "lineitem").select(path.alias("path"), content.alias("content")))


GROUPS = """SELECT event_id, value, CASE event_id % 4 WHEN 0 THEN '/' WHEN 1 THEN '_' WHEN 2 THEN 'CTD_Seabird' ELSE 'CBIT' END AS grp,
    CASE event_id % 12 WHEN 0 THEN 'depth' WHEN 4 THEN 'platform_battery_charge' WHEN 8 THEN 'platform_orientation' WHEN 1 THEN 'planktivore_HM_AvgRois' WHEN 5 THEN 'planktivore_diatoms'
    WHEN 2 THEN 'bin_median_sea_water_salinity' WHEN 6 THEN 'sea_water_salinity' WHEN 3 THEN 'ampHoursUsed' ELSE 'other' END AS v FROM events"""


def grouped(spark, sf):
    pick = lambda n, d: F.element_at(F.create_map(*[F.lit(x) for p in d.items() for x in p]), F.col("event_id") % n)
    groups = {0: "/", 1: "_", 2: "CTD_Seabird", 3: "CBIT"}
    names = {
        0: "depth", 4: "platform_battery_charge", 8: "platform_orientation", 1: "planktivore_HM_AvgRois", 5: "planktivore_diatoms",
        2: "bin_median_sea_water_salinity", 6: "sea_water_salinity", 3: "ampHoursUsed",
    }
    return table(spark, sf, "events").select(
        "event_id", "value", pick(4, groups).alias("group"), F.coalesce(pick(12, names), F.lit("other")).alias("var")
    )


@query(
    "src8_select_groups",
    f"""WITH g AS ({GROUPS}) SELECT event_id, value, concat(CASE grp WHEN '/' THEN 'universals' WHEN '_' THEN 'backseat' ELSE lower(replace(grp, '_', '')) END, '_', CASE v WHEN 'platform_orientation' THEN 'platform_yaw_angle' ELSE lower(v) END) AS name FROM g
    WHERE (grp = '/' AND v IN ('depth', 'platform_orientation')) OR (grp = '_' AND v IN ('planktivore_HM_AvgRois', 'planktivore_diatoms')) OR (grp = 'CTD_Seabird' AND v = 'sea_water_salinity')""",
)
def src8(spark, sf):
    allowed = selection.whitelist(spark, selection.GROUP_VARIABLES)
    return selection.select_groups(grouped(spark, sf), allowed).select("event_id", "value", "name")


@query(
    "src9_read_messages",
    f"""WITH g AS ({GROUPS}) SELECT event_id, value, CASE WHEN v = 'depth' THEN v WHEN grp = '/' THEN concat('bpc1_', v) WHEN grp = '_' THEN lower(concat('backseat_', v)) ELSE lower(concat(replace(grp, '_', ''), '_', v)) END AS name FROM g
    WHERE (grp = '/' AND v IN ('depth', 'platform_battery_charge')) OR (grp = '_' AND v = 'planktivore_HM_AvgRois') OR (grp = 'CTD_Seabird' AND v = 'bin_median_sea_water_salinity') OR (grp = 'CBIT' AND v = 'ampHoursUsed')""",
)
def src9(spark, sf):
    return selection.read_messages(grouped(spark, sf)).select("event_id", "value", "name")


@query(
    "src10_parse_positions",
    """SELECT event_id, epoch_us(date_trunc('second', ts)) - 18000000000 AS us, round(CASE WHEN event_id % 5 = 0 THEN -1 ELSE 1 END*(36 + (CAST(floor(value) AS BIGINT) % 60)/60.0::DOUBLE), 9) AS lat, round(-(121 + (event_id % 60)/60.0::DOUBLE), 9) AS lon FROM events""",
)
def src10(spark, sf):
    ts = F.col("ts").cast("timestamp")
    filler = F.array_join(F.array_repeat(F.lit("x"), 20), ",")
    lat = F.concat(F.when(F.col("event_id") % 5 == 0, "S").otherwise("N"), F.lit("36 "), (F.floor("value") % 60).cast("string"))
    lon = F.concat(F.lit("W121 "), (F.col("event_id") % 60).cast("string"))
    line = F.concat_ws(",", F.lit("a"), F.concat(F.date_format(ts, "M-d-yy H:m:s"), F.lit(".1")), filler, lat, lon)
    out = logs.parse_positions(table(spark, sf, "events").select("event_id", line.alias("line")))
    return out.select("event_id", F.unix_micros("ts").alias("us"), F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"))


BOTTLE_LINES = """SELECT user_id % 10 AS mission, event_id AS line_no, CASE event_id % 9 WHEN 0 THEN concat('log (t = ', event_id, '.5) -- Behavior FireTheGulper:3 running') WHEN 1 THEN concat('GulperServer - firing gulper ', user_id % 13)
    WHEN 2 THEN concat('log (t = ', event_id, '.25) Behavior FireTheGulper:-1 has changed to state Finished') WHEN 3 THEN concat('12:00: Gulper::fireGulper - cmd is $0', user_id % 9, '1Fff')
    WHEN 4 THEN concat('Adaptive Sampler has fired gulper ', user_id % 11, ' at t =   ', event_id, '.75') WHEN 5 THEN concat('x: ', 1700000000 + event_id, ' Gulper::fireGulper - cmd is $0', user_id % 7, '1Fff') ELSE 'other' END AS line FROM events"""


def bottle_lines(spark, sf):
    e = F.col("event_id").cast("string")
    num = lambda m: (F.col("user_id") % m).cast("string")
    k = F.col("event_id") % 9
    line = (
        F.when(k == 0, F.concat(F.lit("log (t = "), e, F.lit(".5) -- Behavior FireTheGulper:3 running")))
        .when(k == 1, F.concat(F.lit("GulperServer - firing gulper "), num(13)))
        .when(k == 2, F.concat(F.lit("log (t = "), e, F.lit(".25) Behavior FireTheGulper:-1 has changed to state Finished")))
        .when(k == 3, F.concat(F.lit("12:00: Gulper::fireGulper - cmd is $0"), num(9), F.lit("1Fff")))
        .when(k == 4, F.concat(F.lit("Adaptive Sampler has fired gulper "), num(11), F.lit(" at t =   "), e, F.lit(".75")))
        .when(k == 5, F.concat(F.lit("x: "), (F.col("event_id") + 1700000000).cast("string"), F.lit(" Gulper::fireGulper - cmd is $0"), num(7), F.lit("1Fff")))
        .otherwise("other")
    )
    return table(spark, sf, "events").select((F.col("user_id") % 10).alias("mission"), F.col("event_id").alias("line_no"), line.alias("line"))


def bottles(spark, sf):
    lines = bottle_lines(spark, sf)
    start = lines.select("mission").distinct().withColumn("t0", F.lit(1600000000.0) + F.col("mission"))
    return logs.bottle_events(lines, start, ["mission"], "line_no", "line", 2_000)


BOTTLES = f"""l AS ({BOTTLE_LINES}), k AS (SELECT mission, line_no, line_no % 9 AS k, CASE line_no % 9 WHEN 0 THEN line_no + 0.5 WHEN 2 THEN line_no + 0.25 END::DOUBLE AS el,
    CASE WHEN line_no % 9 IN (1, 4) THEN CAST(regexp_extract(line, 'gulper (\\d+)', 1) AS INT) WHEN line_no % 9 IN (3, 5) THEN CAST(regexp_extract(line, '\\$(\\d\\d)1Fff', 1) AS INT) END AS num FROM l),
    c AS (SELECT *, last_value(num IGNORE NULLS) OVER w AS cur FROM k WINDOW w AS (PARTITION BY mission ORDER BY line_no)),
    m AS (SELECT *, CASE WHEN k IN (3, 5) OR (k = 2 AND cur IS NOT NULL) THEN -1 ELSE el END AS mark FROM c),
    z AS (SELECT *, last_value(mark IGNORE NULLS) OVER (PARTITION BY mission ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM m),
    wr AS (SELECT mission, line_no, cur AS bottle, CASE k WHEN 4 THEN line_no + 0.75 WHEN 5 THEN 1700000000.0 + line_no WHEN 2 THEN el + 1600000000.0 + mission WHEN 3 THEN CASE WHEN prev > 0 THEN prev + 1600000000.0 + mission END END::DOUBLE AS t FROM z WHERE k IN (2, 3, 4, 5) AND cur IS NOT NULL),
    bt AS (SELECT mission, bottle, arg_max(t, line_no) - 1 AS seconds FROM wr WHERE t IS NOT NULL GROUP BY ALL)"""


@query("src11_bottle_events", f"WITH {BOTTLES} SELECT mission, bottle, round(seconds, 3) AS seconds FROM bt")
def src11(spark, sf):
    return bottles(spark, sf).withColumn("seconds", F.round("seconds", 3))


@query(
    "src12_cartridge_events",
    """WITH p AS (SELECT line_no, line FROM syslog), s AS (SELECT line_no, CAST(regexp_extract(line, 'Z,(\\d+\\.\\d+) ', 1) AS DOUBLE) AS sec, row_number() OVER (ORDER BY line_no) AS nth FROM p WHERE contains(line, 'ELMO will go to position')),
    n AS (SELECT line_no, CAST(regexp_extract(line, 'Sample (\\d+)', 1) AS INT) AS sample, row_number() OVER (ORDER BY line_no) AS nth FROM p WHERE contains(line, 'err_code'))
    SELECT 1 AS mission, sample, round(arg_max(sec, s.nth), 3) AS seconds FROM s JOIN n USING (nth) GROUP BY sample""",
    ("syslog",),
)
def src12(spark, sf):
    lines = fx.syslog(spark, sf).withColumn("mission", F.lit(1))
    return logs.cartridge_events(lines, ["mission"], "line_no", "line", 2_000).withColumn("seconds", F.round("seconds", 3))


CFG = """SELECT p_size AS file, p_partkey AS line_no, CASE p_partkey % 6 WHEN 0 THEN concat('// t_a = ', p_partkey) WHEN 1 THEN concat('t_a = ', p_partkey, '.5; // x') WHEN 2 THEN concat('SOc=', p_partkey, '.25') WHEN 3 THEN concat('zz = ', p_partkey)
    WHEN 4 THEN CASE WHEN p_partkey % 4 = 0 THEN 't_coefs = G; y' ELSE 'c_a = n/a' END ELSE '' END AS line FROM part"""


def cfg(spark, sf):
    k, key = F.col("p_partkey") % 6, F.col("p_partkey").cast("string")
    line = (
        F.when(k == 0, F.concat(F.lit("// t_a = "), key))
        .when(k == 1, F.concat(F.lit("t_a = "), key, F.lit(".5; // x")))
        .when(k == 2, F.concat(F.lit("SOc="), key, F.lit(".25")))
        .when(k == 3, F.concat(F.lit("zz = "), key))
        .when(k == 4, F.when(F.col("p_partkey") % 4 == 0, "t_coefs = G; y").otherwise("c_a = n/a"))
        .otherwise("")
    )
    return table(spark, sf, "part").select(F.col("p_size").alias("file"), F.col("p_partkey").alias("line_no"), line.alias("line"))


@query(
    "src13_read_coefficients",
    """SELECT p_size AS file, 't_a' AS name, CAST(max(p_partkey) + 0.5 AS DOUBLE) AS value, concat(max(p_partkey), '.5') AS text FROM part WHERE p_partkey % 6 = 1 GROUP BY 1
    UNION ALL SELECT p_size, 'SOc', CAST(max(p_partkey) + 0.25 AS DOUBLE), concat(max(p_partkey), '.25') FROM part WHERE p_partkey % 6 = 2 GROUP BY 1
    UNION ALL SELECT p_size, 'c_coefs', NULL, 'A' FROM part GROUP BY 1
    UNION ALL SELECT p_size, 't_coefs', NULL, CASE WHEN bool_or(p_partkey % 6 = 4 AND p_partkey % 4 = 0) THEN 'G' ELSE 'A' END FROM part GROUP BY 1""",
)
def src13(spark, sf):
    return logs.read_coefficients(cfg(spark, sf), ["file"], "line_no").select("file", "name", "value", "text")


@query(
    "src13_read_sections",
    """WITH l AS (SELECT p_size AS file, p_partkey AS k, p_partkey % 7 AS m FROM part),
    h AS (SELECT *, last_value(CASE m WHEN 0 THEN 'General' WHEN 2 THEN 'Ch1' WHEN 4 THEN 'Ch2' END IGNORE NULLS) OVER (PARTITION BY file ORDER BY k) AS section FROM l),
    v AS (SELECT file, section, CASE m WHEN 1 THEN 'Serial' WHEN 3 THEN 'Gain1' WHEN 5 THEN CASE WHEN file % 3 = 0 THEN 'SigmaExp' ELSE 'Mu' END ELSE 'Gain2' END AS name, CASE WHEN m = 1 THEN CASE WHEN file % 2 = 0 THEN 'H2000325' ELSE 'S1' END ELSE concat(k, '.5') END AS text, k FROM h WHERE m IN (1, 3, 5, 6)),
    g AS (SELECT file, section, name, arg_max(text, k) AS text FROM v GROUP BY ALL),
    d AS (SELECT file, max(CASE WHEN section = 'General' AND name = 'Serial' THEN text END) AS serial FROM g GROUP BY file HAVING NOT bool_or(name = 'SigmaExp' AND section IS NOT NULL AND section IN ('Ch1', 'Ch2')))
    SELECT * FROM g UNION ALL SELECT file, 'Ch1', 'SigmaExp', CASE WHEN serial = 'H2000325' THEN '0.1460' ELSE '0.1486' END FROM d
    UNION ALL SELECT file, 'Ch2', 'SigmaExp', CASE WHEN serial = 'H2000325' THEN '0.1600' ELSE '0.1522' END FROM d""",
)
def src13_sections(spark, sf):
    m, key = F.col("p_partkey") % 7, F.concat(F.col("p_partkey").cast("string"), F.lit(".5"))
    line = (
        F.when(m == 0, "[General]")
        .when(m == 1, F.concat(F.lit("Serial = "), F.when(F.col("p_size") % 2 == 0, "H2000325").otherwise("S1")))
        .when(m == 2, "[Channel 1]")
        .when(m == 3, F.concat(F.lit("Gain1="), key))
        .when(m == 4, "[Channel2]")
        .when(m == 5, F.concat(F.when(F.col("p_size") % 3 == 0, "SigmaExp = ").otherwise("Mu = "), key))
        .otherwise(F.concat(F.lit("Gain2 = "), key))
    )
    lines = table(spark, sf, "part").select(F.col("p_size").alias("file"), F.col("p_partkey").alias("line_no"), line.alias("line"))
    return logs.read_sections(lines, ["file"], "line_no", 500)


@query(
    "src13_read_xml",
    "SELECT p_partkey, CAST(p_size AS VARCHAR) AS serial, CAST(p_retailprice AS DOUBLE) AS Soc, -0.5::DOUBLE AS \"offset\", NULL::DOUBLE AS E FROM part",
)
def src13_xml(spark, sf):
    xml = F.concat(
        F.lit("<OxygenSensor><SerialNumber>"), F.col("p_size").cast("string"), F.lit('</SerialNumber><CalibrationCoefficients equation="0"><Soc>9</Soc></CalibrationCoefficients><CalibrationCoefficients equation="1"><Soc>'),
        F.col("p_retailprice").cast("string"), F.lit("</Soc><offset>-0.5</offset><E>none</E></CalibrationCoefficients></OxygenSensor>"),
    )
    return logs.read_xml_coefficients(table(spark, sf, "part").select("p_partkey", xml.alias("xml")), ["p_partkey"], "xml", ["Soc", "offset", "E"])


@query(
    "src14_read_measurements",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-06-01' AND l_quantity BETWEEN 5 AND 30 AND l_suppkey IN (3, 5, 8, 13, 21, 34)""",
)
def src14(spark, sf):
    from datetime import datetime

    return logs.read_measurements(
        spark,
        f"{sf}/lineitem.parquet",
        ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"],
        {"l_shipdate": (datetime(1996, 1, 1), datetime(1997, 6, 1)), "l_quantity": (5.0, 30.0)},
        {"l_suppkey": [3, 5, 8, 13, 21, 34]},
    )


@query(
    "src15_overlapping",
    """SELECT o_orderkey FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderdate <= TIMESTAMP '1998-03-10' AND o_orderdate + INTERVAL 1 DAY * (o_custkey % 40) >= TIMESTAMP '1998-02-01'""",
)
def src15(spark, sf):
    end = F.col("day") + F.make_dt_interval((F.col("o_custkey") % 40).cast("int"))
    name = F.concat(F.date_format("day", "yyyyMMdd"), F.lit("_"), F.date_format(end, "yyyyMMdd"))
    odd = F.when(F.col("o_orderkey") % 7 == 0, F.concat(name, F.lit("x"))).otherwise(name)
    return selection.overlapping(orders(spark, sf).withColumn("name", odd), "name", at("1998-02-01"), at("1998-03-10")).select("o_orderkey")


@query(
    "src16_date_ranges",
    """SELECT o_orderkey, 'current' AS mode FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1999-05-01' AND TIMESTAMP '1999-05-17 08:00:00'
    UNION ALL SELECT o_orderkey, 'previous' FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1999-04-01' AND TIMESTAMP '1999-04-30 23:59:59'
    UNION ALL SELECT o_orderkey, 'last' FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1999-05-07' AND TIMESTAMP '1999-05-17 08:00:00'""",
)
def src16(spark, sf):
    now = at("1999-05-17 08:00:00")
    parts = [("current_month", "current", 0), ("previous_month", "previous", 0), ("last_days", "last", 10)]
    picked = [
        orders(spark, sf).where(F.col("day").between(*selection.date_range(mode, now, days))).select("o_orderkey", F.lit(label).alias("mode"))
        for mode, label, days in parts
    ]
    return picked[0].union(picked[1]).union(picked[2])


@query(
    "snk1_write_stage",
    """SELECT o_orderkey, o_orderstatus AS platform, CAST(year(o_orderdate) AS INT) AS mission, CASE WHEN year(o_orderdate) = 1998 THEN 2 ELSE 1 END AS version FROM orders""",
)
def snk1(spark, sf):
    df = orders(spark, sf).select("o_orderkey", F.col("o_orderstatus").alias("platform"), F.year("day").alias("mission"), F.lit(1).alias("version"))
    path = shared_folder(spark, "stage")
    sinks.write_stage(df, path)
    sinks.write_stage(df.where("mission = 1998").withColumn("version", F.lit(2)), path)
    return sinks.read_stage(spark, path)


def water_samples(spark, sf):
    events = bottles(spark, sf).select("mission", "bottle", F.timestamp_seconds(F.lit(1704067200) + F.floor(F.col("seconds") % 2592000)).alias("ts"))
    e = table(spark, sf, "events").select(
        (F.col("user_id") % 10).alias("mission"),
        F.col("ts").cast("timestamp").alias("ts"),
        (F.lit(36.8) + F.col("value") / 10000).alias("lat"),
        (F.lit(-122.0) - F.col("value") / 20000).alias("lon"),
        F.col("value").alias("depth"),
        F.when(F.col("event_type") == "click", F.col("value")).alias("ctd1"),
        F.when(F.col("event_type") != "error", F.col("value") + 1).alias("ctd2"),
        (F.col("event_id") % 9).cast("double").alias("profile"),
    )
    wanted = {
        "lat": ["lat"], "lon": ["lon"], "depth": ["depth"], "temperature": ["ctd1", "ctd2"], "salinity": ["ctd2"], "station": ["profile"],
    }
    return sample_means(events, e, ["mission"], "bottle", wanted, seconds=1800)


SAMPLES = f"""{BOTTLES}, ev AS (SELECT mission, bottle, 1704067200000000 + CAST(floor(seconds % 2592000) AS BIGINT)*1000000 AS t FROM bt),
    wm AS (SELECT ev.mission, bottle, min(epoch_us(ts)) AS us, count(*) AS n, avg(36.8 + value/10000) AS lat, avg(-122.0 - value/20000) AS lon, avg(value) AS depth,
    coalesce(avg(CASE WHEN event_type = 'click' THEN value END), avg(CASE WHEN event_type <> 'error' THEN value + 1 END)) AS temperature, avg(CASE WHEN event_type <> 'error' THEN value + 1 END) AS salinity, avg(event_id % 9) AS station
    FROM ev JOIN events e ON e.user_id % 10 = ev.mission AND abs(epoch_us(ts) - t) <= 1800000000 GROUP BY ALL)"""


@query(
    "job10_bottle_samples",
    f"WITH {SAMPLES} SELECT mission, bottle, us, n AS rows, round(lat, 6) AS lat, round(lon, 6) AS lon, round(depth, 6) AS depth, round(temperature, 6) AS temperature, round(salinity, 6) AS salinity FROM wm",
)
def job10(spark, sf):
    out = water_samples(spark, sf)
    return out.select("mission", "bottle", F.unix_micros("ts").alias("us"), "rows", *[F.round(c, 6).alias(c) for c in ("lat", "lon", "depth", "temperature", "salinity")])


@query(
    "snk2_sample_table",
    f"""WITH {SAMPLES}, s AS (SELECT *, make_timestamp(us) AS ts FROM wm)
    SELECT concat('m', mission) AS cruise, bottle, concat_ws(chr(9), concat('m', mission), CAST(CAST(floor(station) AS BIGINT) AS VARCHAR), 'B', strftime(ts, '%m/%d/%Y'), strftime(ts, '%H:%M'), printf('%9.5f', lon + 1e-7 + 360.0), printf('%8.5f', lat + 1e-7), printf('%8.1f', 1000.0::DOUBLE), CAST(bottle AS VARCHAR), '0',
    printf('%6.2f', depth + 1e-5), '0', coalesce(printf('%5.2f', temperature + 1e-5), 'NaN'), '0', coalesce(printf('%6.3f', salinity + 1e-5), 'NaN'), '0', 'NaN', '0', 'NaN', '0', 'NaN', '0', 'NaN', '0', 'NaN', '0', 'NaN', '0',
    printf('%9.5f', dayofyear(ts) + (us - epoch_us(date_trunc('day', ts)))/86400000000.0::DOUBLE), '0') AS line FROM s""",
)
def snk2(spark, sf):
    empty = {c: F.lit(None).cast("double") for c in ("oxygen", "nitrate", "fluorescence", "bbp420", "bbp700", "par", "bottom_depth")}
    # Means of two-decimal values often end on a rounding tie; both sides move off it.
    off = {"lat": F.col("lat") + 1e-7, "lon": F.col("lon") + 1e-7} | {c: F.col(c) + 1e-5 for c in ("depth", "temperature", "salinity")}
    out = water_samples(spark, sf).withColumns({"cruise": F.concat(F.lit("m"), F.col("mission").cast("string")), **empty, **off})
    return sinks.sample_lines(out)

