"""The chunked kernel against pandas, with one hot series and chunk borders everywhere."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import ordered as o
from tidemark.operators import timejoin
from tidemark.operators.resample import rolling
from tidemark.operators.timejoin import asof_nearest, interp_join


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(7)
    sizes = {1: 400, 2: 90, 3: 1, 4: 110}
    frames = []
    for s, n in sizes.items():
        t = np.sort(rng.choice(5000, n, replace=False)).astype("int64")
        x = rng.normal(size=n).round(3)
        x[rng.random(n) < 0.3] = np.nan
        frames.append(pd.DataFrame({"s": s, "t": t, "x": x}))
    return pd.concat(frames, ignore_index=True)


def to_spark(spark, pdf):
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "s int, t long, x double")


def same(got, want):
    got = got.sort_values(["s", "t"]).reset_index(drop=True)
    want = want.sort_values(["s", "t"]).reset_index(drop=True)[list(got.columns)]
    pd.testing.assert_frame_equal(got.astype(float), want.astype(float), atol=1e-9)


@pytest.mark.parametrize("width", [1, 37, 500, 10_000])
def test_scan(spark, rows, width):
    x = F.col("x")
    got = o.scan(
        to_spark(spark, rows).repartition(5),
        o.axis("s", "t", width),
        total=o.running("sum", x),
        top=o.running("max", x, inclusive=False),
        low=o.running("min", x, forward=False),
        last=o.latest(x, inclusive=False),
        next=o.upcoming(x),
        before=o.previous(x),
        after=o.following(x),
    ).toPandas()
    g = rows.sort_values(["s", "t"]).groupby("s")["x"]
    want = rows.sort_values(["s", "t"]).copy()
    want["total"] = g.transform(lambda v: v.fillna(0).cumsum().where(v.notna().cummax()))
    want["top"] = g.transform(lambda v: v.cummax().ffill().shift())
    want["low"] = g.transform(lambda v: v[::-1].cummin().ffill()[::-1])
    want["last"] = g.transform(lambda v: v.ffill().shift())
    want["next"] = g.transform(lambda v: v.bfill())
    want["before"] = g.transform(lambda v: v.shift())
    want["after"] = g.transform(lambda v: v.shift(-1))
    same(got, want)


def test_row_index_and_fit_width(spark, rows):
    df = to_spark(spark, rows)
    got = o.row_index(df, o.axis("s", "t", 100)).toPandas()
    want = rows.sort_values(["s", "t"]).copy()
    want["idx"] = want.groupby("s").cumcount()
    same(got, want)
    ax = o.fit_width(df, o.axis("s", "t", 100_000), rows=50)
    assert ax.cut(df).groupBy(*ax.keys).count().agg(F.max("count")).first()[0] <= 50


@pytest.mark.parametrize("fn,width", [("min", 7), ("max", 40), ("mean", 40), ("median", 41), ("count", 30), ("sum", 5)])
def test_rolling_blocks(spark, rows, fn, width):
    df = o.row_index(to_spark(spark, rows), o.axis("s", "t", 100))
    got = rolling(df, ["s"], "idx", "x", fn, width, "r", size=64).drop("idx").toPandas()
    want = rows.sort_values(["s", "t"]).copy()
    before, after = width // 2, (width - 1) // 2

    def frame(v):
        cut = [v.iloc[max(0, i - before) : i + after + 1].dropna() for i in range(len(v))]
        return pd.Series([len(c) if fn == "count" else (getattr(c, fn)() if len(c) else np.nan) for c in cut], v.index)

    want["r"] = want.groupby("s")["x"].transform(frame)
    same(got, want)


@pytest.mark.parametrize("limit", [20, 1_000_000])
def test_quantiles(spark, rows, limit):
    df = to_spark(spark, rows)
    probs = {"a": 0.0, "b": 0.333, "c": 0.5, "d": 1.0}
    got = o.quantiles(df, ["s"], "x", probs, splits=8, limit=limit).toPandas().set_index("s").sort_index()
    for name, p in probs.items():
        want = rows.groupby("s")["x"].quantile(p).dropna()
        np.testing.assert_allclose(got.loc[want.index, name].astype(float), want, atol=1e-12)
    ranks = o.value_counts(df, ["s"], "x", splits=8, limit=limit).toPandas()
    for s, part in ranks.groupby("s"):
        v = rows.loc[rows.s == s, "x"].dropna()
        assert all((v < r.value).sum() == r.below and len(v) == r.total for r in part.itertuples())


def test_interp_join_matches_numpy(spark, rows):
    a = rows[rows.index % 3 == 0]
    b = rows[(rows.index % 3 != 0) & rows.x.notna()]
    got = interp_join(to_spark(spark, a).drop("x"), to_spark(spark, b).withColumnRenamed("x", "v"), ["s"], "t", ["v"], width=250).toPandas()
    for s, part in got.groupby("s"):
        known = b[b.s == s].sort_values("t")
        if len(known):
            np.testing.assert_allclose(part["v"].astype(float), np.interp(part["t"], known["t"], known["x"]), atol=1e-12)
        else:
            assert part["v"].isna().all()


def test_nearest_tie_is_earlier(spark):
    a = spark.createDataFrame([(1, 10), (1, 14), (1, 11), (1, 0), (1, 99)], "s int, t long")
    b = spark.createDataFrame([(1, 8, 8), (1, 12, 12), (1, 16, 16)], "s int, t long, v int")
    got = {r.t: r.v for r in asof_nearest(a, b, ["s"], "t", ["v"], 3).collect()}
    assert got == {10: 8, 14: 12, 11: 12, 0: 8, 99: 16}


def test_order_of_input_does_not_matter(spark, rows):
    df = to_spark(spark, rows)
    ax = o.axis("s", "t", 200)
    one = o.scan(df.repartition(1), ax, a=o.latest(F.col("x"))).toPandas()
    many = o.scan(df.orderBy(F.rand(3)).repartition(16), ax, a=o.latest(F.col("x"))).toPandas()
    same(one, many)
    alone = pd.concat([o.scan(df.where(F.col("s") == s), ax, a=o.latest(F.col("x"))).toPandas() for s in (1, 2, 3, 4)])
    same(one, alone)


def test_hot_series_is_spread(spark):
    hot = spark.range(30_000).select(F.lit(1).alias("s"), F.col("id").alias("t"), (F.col("id") % 7).cast("double").alias("x"))
    rest = spark.range(60_000).select((F.col("id") % 500 + 2).cast("int").alias("s"), F.col("id").alias("t"), F.lit(1.0).alias("x"))
    out = o.scan(hot.union(rest), o.axis("s", "t", 1_000), last=o.running("sum", F.col("x")))
    per_chunk = o.axis("s", "t", 1_000).cut(out).groupBy("s", o.CHUNK).count().agg(F.max("count")).first()[0]
    assert per_chunk <= 1_000
    assert out.where("s = 1").agg(F.max("last")).first()[0] == sum(i % 7 for i in range(30_000))


@pytest.mark.parametrize("first_if_none", [True, False])
@pytest.mark.parametrize("by", [[], ["s"]])
def test_effective_in_any_chunks(spark, by, first_if_none):
    dim = spark.createDataFrame([(s, t, s * 100 + t) for s in (1, 2) for t in (10 + s, 20 + s, 30 + s)], "s int, t long, v long")
    facts = spark.createDataFrame([(s, t) for s in (1, 2, 3) for t in range(0, 50, 3)], "s int, at long")
    dim = dim if by else dim.drop("s")
    short = timejoin.effective(facts, dim, "at", "t", by, first_if_none)
    long = timejoin.effective(facts, dim, "at", "t", by, first_if_none, width=7)
    rows = lambda df: sorted(map(str, df.select("s", "at", "v").collect()))
    assert rows(short) == rows(long)


def test_backward_frames_run_from_the_start(spark):
    """A frame with an unbounded end is evaluated anew for every row; ties and gaps keep their order."""
    rows = [(s, i // 3, i, v) for s in ("a", None) for i, v in enumerate([None, 5.0, None, 2.0, None, None, 7.0, 1.0, None, None])]
    df = spark.createDataFrame(rows, "series string, t long, seq long, v double")
    steps = {
        "next": o.upcoming(F.col("v")),
        "after": o.upcoming(F.col("v"), inclusive=False),
        "least": o.running("min", F.col("v"), forward=False),
        "rest": o.running("sum", F.col("v"), inclusive=False, forward=False),
    }
    for width in (1, 2, 100):
        out = o.scan(df, o.axis("series", ["t", "seq"], width), **steps)
        tied = o.scan(df, o.axis("series", "t", width), peer=o.upcoming(F.col("v"), peers=True))
        for plan in (out, tied):
            assert "unboundedfollowing" not in plan._jdf.queryExecution().analyzed().toString().lower()
        for series in ("a", None):
            own = [r for r in rows if r[0] == series]
            mine = F.col("series").eqNullSafe(F.lit(series))
            for r in out.where(mine).collect():
                later = [x[3] for x in own[r.seq :] if x[3] is not None]
                beyond = [x[3] for x in own[r.seq + 1 :] if x[3] is not None]
                first = later[0] if later else None
                assert (r.next, r.after, r.least, r.rest) == (first, beyond[0] if beyond else None, min(later, default=None), sum(beyond) if beyond else None)
            for r in tied.where(mine).collect():
                later = [x[3] for x in own if x[1] >= r.t and x[3] is not None]
                at = {x[3] for x in own if x[1] == r.t and x[3] is not None}
                assert r.peer in at if at else r.peer == (later[0] if later else None)
