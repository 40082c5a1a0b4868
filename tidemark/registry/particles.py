"""Queries for the particle counter."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import particles as pt
from tidemark.operators.ordered import axis
from tidemark.registry import inputs as fx
from tidemark.registry.core import query

MEPS = """g AS (SELECT *, sum(n) OVER (PARTITION BY series ORDER BY idx) AS particle FROM mep),
    a AS (SELECT series, particle, avg(p)/3800 AS ai, count(DISTINCT e) AS od, count(*) AS fragments, min(idx) AS idx,
    1000*(0.1806059 + 0.00025459*sum(p)::DOUBLE - 1.0988e-9*pow(sum(p), 2) + 9.54e-15*pow(sum(p), 3)) AS esd FROM g WHERE particle > 0 GROUP BY series, particle)"""


def fragments(spark, sf):
    return pt.build_particles(fx.mep(spark, sf), axis("series", "idx", 100))


def attributes(spark, sf):
    return pt.particle_attributes(fragments(spark, sf), ["series", "particle"])


@query("agg16_build_particles", f"WITH {MEPS} SELECT series, idx, CAST(particle AS BIGINT) AS particle FROM g WHERE particle > 0", ("mep",))
def agg16(spark, sf):
    return fragments(spark, sf).select("series", "idx", "particle")


@query("agg17_particle_attributes", f"WITH {MEPS} SELECT series, CAST(particle AS BIGINT) AS particle, round(ai, 6) AS ai, od, round(esd, 4) AS esd, fragments FROM a", ("mep",))
def agg17(spark, sf):
    return attributes(spark, sf).withColumns({"ai": F.round("ai", 6), "esd": F.round("esd", 4)})


@query(
    "agg18_size_histogram",
    f"""WITH {MEPS}, b AS (SELECT unnest(range(994)) AS k), c AS (SELECT k, 108 + 15*k AS um FROM b),
    d AS (SELECT a.series, a.particle, a.esd, CAST(least(993, greatest(0, floor((esd - 108)/15))) AS BIGINT) AS k FROM a),
    n AS (SELECT d.series, d.particle, arg_min(c.k, abs(c.um - d.esd) + c.k*1e-9) AS size_bin FROM d JOIN c ON c.k BETWEEN d.k - 1 AND d.k + 1 GROUP BY ALL)
    SELECT series, CAST(size_bin AS INT) AS size_bin, count(*) AS n FROM n GROUP BY ALL""",
    ("mep",),
)
def agg18(spark, sf):
    return pt.size_histogram(attributes(spark, sf), ["series"])


@query(
    "agg19_particle_classes",
    f"""WITH {MEPS} SELECT series, count(*) FILTER (WHERE ai > 0.6 AND esd > 1100 AND esd < 1700) AS large_copepods, count(*) FILTER (WHERE ai <= 0.4) AS transparent, count(*) FILTER (WHERE ai > 0.4) AS opaque FROM a GROUP BY series""",
    ("mep",),
)
def agg19(spark, sf):
    return pt.particle_classes(attributes(spark, sf), ["series"])


@query(
    "agg20_bin_particles",
    f"""WITH {MEPS} SELECT series, (particle // 3) // 21 AS bin, count(*) AS n, round(avg(ai), 6) AS ai_mean, round(min(ai), 6) AS ai_min, round(max(ai), 6) AS ai_max, round(stddev_pop(ai), 6) AS ai_std,
    round(avg(esd), 4) AS esd_mean, round(min(esd), 4) AS esd_min, round(max(esd), 4) AS esd_max, round(stddev_pop(esd), 4) AS esd_std FROM (SELECT series, CAST(particle AS BIGINT) AS particle, ai, esd FROM a) q GROUP BY ALL""",
    ("mep",),
)
def agg20(spark, sf):
    df = attributes(spark, sf).withColumn("frame", F.floor(F.col("particle") / 3))
    out = pt.bin_particles(df, ["series"], "frame")
    return out.withColumns({c: F.round(c, 6 if c.startswith("ai") else 4) for c in out.columns if "_" in c})


@query(
    "agg20_bin_counts",
    """SELECT label, sec // 21 AS bin, CAST(j AS INT) AS size_bin, CAST(sum(floor(abs(v)*100)) AS BIGINT) AS n FROM (SELECT sec, label, unnest(range(64)) AS j, unnest(samples) AS v FROM samples) q GROUP BY ALL""",
    ("samples",),
)
def agg20_counts(spark, sf):
    df = fx.samples(spark, sf).withColumn("counts", F.transform("samples", lambda x: F.floor(F.abs(x) * 100)))
    return pt.bin_counts(df, ["label"], "sec", "counts")


@query(
    "agg20_add_counts",
    f"""WITH {MEPS}, m AS (SELECT series % 10 AS label, CAST(greatest(0, least(993, ceil((esd - 108)/15.0::DOUBLE - 0.5))) AS INT) AS size_bin, 1 AS n FROM a),
    s AS (SELECT CAST(label AS BIGINT) AS label, CAST(j AS INT) AS size_bin, floor(abs(v)*100) AS n FROM (SELECT label, unnest(range(64)) AS j, unnest(samples) AS v FROM samples) q)
    SELECT label, size_bin, CAST(sum(n) AS BIGINT) AS n FROM (SELECT * FROM m UNION ALL SELECT * FROM s) u GROUP BY ALL""",
    ("mep", "samples"),
)
def agg20_total(spark, sf):
    multi = pt.size_histogram(attributes(spark, sf).withColumn("label", F.col("series") % 10), ["label"])
    single = agg20_counts(spark, sf).withColumn("label", F.col("label").cast("bigint"))
    return pt.add_counts([multi, single], ["label"])


@query(
    "agg27_frame_times",
    """WITH c AS (SELECT series, idx, idx*2 + CAST(floor(value) AS BIGINT) % 3 AS counter FROM rate60)
    SELECT series, idx, round(1000.0 + 0.5*(counter - first_value(counter) OVER (PARTITION BY series ORDER BY idx)), 6) AS frame_time FROM c""",
    ("rate60",),
)
def agg27(spark, sf):
    counter = F.col("idx") * 2 + F.floor("value") % 3
    df = fx.rate60(spark, sf).select("series", "idx", counter.alias("counter"), F.lit(1000.0).alias("start"))
    return pt.frame_times(df, ["series"], "idx", "counter", "start").select("series", "idx", F.round("frame_time", 6).alias("frame_time"))


@query(
    "agg27_frame_clock",
    """WITH c AS (SELECT series, idx, idx*0.5 + value/1000 AS sec FROM rate60 WHERE idx % 10 = 3), f AS (SELECT series, idx FROM rate60 WHERE idx % 3 = 0),
    p AS (SELECT f.*, c.idx AS i0, c.sec AS s0 FROM f ASOF LEFT JOIN c ON f.series = c.series AND f.idx >= c.idx),
    q AS (SELECT p.*, c.idx AS i1, c.sec AS s1 FROM p ASOF LEFT JOIN c ON p.series = c.series AND p.idx <= c.idx)
    SELECT series, idx, round(CASE WHEN i0 IS NULL OR i1 IS NULL THEN coalesce(s0, s1) WHEN i0 = i1 THEN s0 ELSE s0 + (s1 - s0)*((idx - i0)/nullif(i1 - i0, 0)::DOUBLE) END, 6) AS sec FROM q""",
    ("rate60",),
)
def agg27_clock(spark, sf):
    r = fx.rate60(spark, sf)
    clock = r.where("idx % 10 = 3").select("series", "idx", (F.col("idx") * 0.5 + F.col("value") / 1000).alias("sec"))
    return pt.frame_clock(r.where("idx % 3 = 0").select("series", "idx"), clock, ["series"], "idx", "sec", 700).withColumn("sec", F.round("sec", 6))


#: Zeros, single and long spikes, lasting steps and stuck values, with no regard to chunk borders.
FAULTY = """CASE WHEN idx % 97 BETWEEN 40 AND 42 THEN 0 WHEN value > 150 THEN idx*2 + 5100 WHEN idx % 1500 BETWEEN 700 AND 711 THEN idx*2 - 4000
    WHEN idx % 400 BETWEEN 90 AND 280 THEN (idx - (idx % 400 - 90))*2 + 100 ELSE idx*2 + 100 END"""


@query(
    "cln18_repair_counter",
    f"""WITH u AS (SELECT series, idx, CAST({FAULTY} AS BIGINT) AS c FROM rate60),
    w AS (SELECT series, idx, c + 65537 * count(*) FILTER (WHERE d > -65540 AND d < -65530) OVER (PARTITION BY series ORDER BY idx) AS c
      FROM (SELECT *, c - lag(c) OVER (PARTITION BY series ORDER BY idx) AS d FROM u)),
    n AS (SELECT *, max(CASE WHEN c <> 0 THEN idx END) OVER (PARTITION BY series ORDER BY idx) AS i0,
      min(CASE WHEN c <> 0 THEN idx END) OVER (PARTITION BY series ORDER BY idx DESC) AS i1 FROM w),
    z AS (SELECT n.series, n.idx, CASE WHEN n.c = 0 AND n.idx - i0 < 5 AND i1 - n.idx < 5
      THEN a.c + CAST(floor((n.idx - i0) * (b.c - a.c) / (i1 - i0)) AS BIGINT) ELSE n.c END AS c
      FROM n LEFT JOIN w a ON a.series = n.series AND a.idx = i0 LEFT JOIN w b ON b.series = n.series AND b.idx = i1),
    r AS (SELECT *, max(CASE WHEN p IS NULL OR p <> c THEN idx END) OVER (PARTITION BY series ORDER BY idx) AS i0
      FROM (SELECT *, lag(c) OVER (PARTITION BY series ORDER BY idx) AS p FROM z)),
    s AS (SELECT series, idx, c + idx - i0 AS c FROM r),
    j AS (SELECT * FROM (SELECT series, idx, c, lag(c) OVER (PARTITION BY series ORDER BY idx) AS p FROM s) WHERE abs(c - p) > 300),
    k AS (SELECT *, lead(idx) OVER o AS until, lead(c) OVER o AS c1, lead(c - p) OVER o AS back, idx - lag(idx) OVER o AS gap, row_number() OVER o AS n
      FROM j WINDOW o AS (PARTITION BY series ORDER BY idx)),
    m AS (SELECT *, max(CASE WHEN gap IS NULL OR gap > 20 THEN n END) OVER (PARTITION BY series ORDER BY idx) AS first FROM k),
    x AS (SELECT series, idx, until, p, c1 FROM m WHERE (n - first) % 2 = 0 AND until - idx <= 20 AND sign(c - p) = -sign(back))
    SELECT s.series, s.idx, CASE WHEN x.idx IS NULL THEN s.c ELSE p + CAST(floor((s.idx - x.idx + 1) * (c1 - p) / (until - x.idx + 1)) AS BIGINT) END AS counter
    FROM s LEFT JOIN x ON s.series = x.series AND s.idx >= x.idx AND s.idx < until""",
    ("rate60",),
)
def cln18(spark, sf):
    df = fx.rate60(spark, sf).select("series", "idx", F.expr(FAULTY).cast("bigint").alias("counter"))
    return pt.repair_counter(df, axis("series", "idx", 700), "counter")
