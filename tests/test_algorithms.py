"""Operators without SQL against plain loops written independently."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import section, signal
from tidemark.operators.ordered import axis
from tidemark.operators.particles import repair_counter
from tidemark.plans import grid
from tidemark.plans.calibrate import calibrate_depth
from tidemark.streaming import means


def series(spark, groups, name, kind="double"):
    rows = [(s, i, v) for s, vals in groups.items() for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, f"s int, idx long, {name} {kind}")


def filtfilt(x, b, a):
    """Forward and backward recursion with odd extension and a resting start."""
    pad = 3 * len(a)
    ext = np.r_[2 * x[0] - x[pad:0:-1], x, 2 * x[-1] - x[-2 : -pad - 2 : -1]]

    def once(v):
        y = np.zeros(len(v))
        past = lambda seq, k, first: seq[k] if k >= 0 else first
        for n in range(len(v)):
            acc = sum(b[j] * past(v, n - j, v[0]) for j in range(len(b)))
            acc -= sum(a[j] * past(y, n - j, v[0]) for j in range(1, len(a)))
            y[n] = acc
        return y

    return once(once(ext)[::-1])[::-1][pad : pad + len(x)]


def test_butterworth_is_a_lowpass():
    b, a = signal.butterworth(8, 0.2)
    response = lambda w: abs(np.polyval(b, np.exp(1j * w)) / np.polyval(a, np.exp(1j * w)))
    assert response(0) == pytest.approx(1)
    assert response(math.pi * 0.2) == pytest.approx(1 / math.sqrt(2), abs=1e-6)
    assert response(math.pi * 0.6) < 1e-5


def test_lowpass(spark):
    rng = np.random.default_rng(1)
    groups = {1: (np.sin(np.arange(700) / 30) * 20 + rng.normal(size=700)).tolist(), 2: [float(i) for i in range(20)]}
    out = signal.lowpass(series(spark, groups, "x"), ["s"], "idx", "x", "y", size=128).toPandas().sort_values("idx")
    b, a = signal.butterworth(8, 0.2)
    np.testing.assert_allclose(out[out.s == 1]["y"].astype(float), filtfilt(np.array(groups[1]), b, a), atol=1e-7)
    assert out[out.s == 2]["y"].isna().all()


def test_calibrate_depth(spark):
    raw = series(spark, {1: [10 + 0.01 * i for i in range(300)]}, "depth").withColumn("us", F.col("idx") * 100_000)
    out = calibrate_depth(raw, ["s"], "us", "idx", size=100).toPandas()
    assert np.allclose(out["filtdepth"].astype(float), out["depth"], atol=1e-3)
    assert out["pressure"].between(10, 14).all()


def recursive_lines(p, tol):
    """Textbook recursion over points; returns kept positions."""
    def gap(i, a, b):
        (x, y), (ax, ay), (bx, by) = p[i], p[a], p[b]
        n = math.hypot(bx - ax, by - ay)
        ux, uy = ((bx - ax) / n, (by - ay) / n) if n else (0, 0)
        if (x - ax) * ux + (y - ay) * uy < 0:
            return 0
        proj = -(x - bx) * ux - (y - by) * uy
        d = math.hypot(x - bx, y - by)
        return d if proj < 0 else math.sqrt(abs(d * d - proj * proj))

    def split(a, b):
        inner = range(a + 1, b)
        best = max(inner, key=lambda i: gap(i, a, b), default=None)
        if best is None or gap(best, a, b) <= tol:
            return {a, b}
        return split(a, best) | split(best, b)

    return split(0, len(p) - 1)


@pytest.mark.parametrize("size", [25, 1000])
def test_simplify(spark, size):
    rng = np.random.default_rng(4)
    tracks = {s: np.c_[np.arange(n) * 0.5, rng.normal(size=n).cumsum()] for s, n in ((1, 160), (2, 31), (3, 2))}
    rows = [(s, i, float(x), float(y)) for s, p in tracks.items() for i, (x, y) in enumerate(p)]
    df = spark.createDataFrame(rows, "s int, idx long, x double, y double")
    out = section.simplify(df, ["s"], "idx", "x", "y", 1.0, size).toPandas()
    for s, p in tracks.items():
        assert set(out[out.s == s]["idx"]) == recursive_lines(p.tolist(), 1.0)


def test_simplify_rounds(spark, monkeypatch):
    """A long track that is split cycle by cycle from its ends takes few rounds, and equal points and gaps stay exact."""
    n = np.arange(6000)
    steps = np.c_[n * 0.1, np.round(25 - 25 * np.cos(2 * np.pi * n / 20) + n * 0.005, 6)]
    tracks = {1: steps, 2: np.c_[np.repeat(n[:500], 2) * 1.0, np.tile([0.0, 5.0, 5.0, 0.0], 250)], 3: np.c_[n[:1800] * 0.1, np.zeros(1800)]}
    rows = [(s, i * 7, float(x), float(y)) for s, p in tracks.items() for i, (x, y) in enumerate(p)]
    written, plain = [], section.durable
    monkeypatch.setattr(section, "durable", lambda df: written.append(1) or plain(df))
    df = spark.createDataFrame(rows, "s int, idx long, x double, y double")
    out = section.simplify(df, ["s"], "idx", "x", "y", 1.0, 1500).toPandas()
    for s, p in tracks.items():
        keep = section._split_points(p[:, 0], p[:, 1], 1.0)
        assert sorted(out[out.s == s]["idx"] // 7) == keep.tolist()
    assert len(written) < 50


def test_outer_rows_hold_the_farthest():
    rng = np.random.default_rng(8)
    for k in range(200):
        p = rng.normal(size=(60, 2)) if k % 2 else rng.integers(0, 6, (60, 2)).astype(float)
        outer = np.flatnonzero(section._outer(p[:, 0], p[:, 1]))
        turn = rng.uniform(0, 2 * np.pi)
        far = p @ np.array([np.cos(turn), np.sin(turn)])
        assert far.argmax() in outer and far.argmin() in outer


def test_repair_counter(spark):
    good = [100 + 2 * i for i in range(400)]
    bad = list(good)
    bad[50] = 0
    bad[90] += 5000
    bad[120] = bad[119]
    bad[200] += 4000
    bad[201] += 4000
    bad[202] += 4000
    out = repair_counter(series(spark, {1: bad}, "c", "long"), axis("s", "idx", 64), "c").toPandas().sort_values("idx")
    got = out["c"].tolist()
    assert got[:120] == good[:120]
    assert got[120] == good[119] + 1
    assert [got[i] for i in (200, 201, 202)] == [good[i] for i in (200, 201, 202)]
    assert got[203:] == good[203:]


def test_counter_wraps_over_chunks(spark):
    true = list(range(65_400, 65_400 + 300))
    seen = [v % 65_537 for v in true]
    out = repair_counter(series(spark, {1: seen}, "c", "long"), axis("s", "idx", 50), "c").toPandas().sort_values("idx")
    assert abs(np.array(out["c"]) - np.array(true)).max() <= 1


def brute_peaks(x):
    out, i = [], 1
    while i < len(x) - 1:
        j = i
        while j < len(x) - 1 and x[j + 1] == x[i]:
            j += 1
        if x[i - 1] < x[i] and j < len(x) - 1 and x[j + 1] < x[i]:
            out.append((i + j) // 2)
        i = j + 1
    return out


def test_peaks_with_plateaus(spark):
    rng = np.random.default_rng(9)
    groups = {s: rng.integers(0, 4, 300).astype(float).repeat(rng.integers(1, 4, 300)).tolist() for s in (1, 2)}
    out = signal.peaks(series(spark, groups, "x"), ["s"], "idx", "x", 16).toPandas()
    for s, x in groups.items():
        assert sorted(out[out.s == s]["idx"]) == brute_peaks(x)


def brute_turns(x, prominence, width):
    out = []
    for kind in (1, -1):
        v = kind * np.asarray(x)
        for p in brute_peaks(v):
            bases = []
            for side in (-1, 1):
                k, low = p, v[p]
                while 0 <= k < len(v) and v[k] <= v[p]:
                    low, k = min(low, v[k]), k + side
                bases.append(low)
            prom = v[p] - max(bases)
            if prom < prominence:
                continue
            level, ends = v[p] - prom / 2, []
            for side in (-1, 1):
                k = p
                while v[k] > level:
                    k += side
                ends.append(k - side * ((level - v[k]) / (v[k - side] - v[k]) if v[k] < level else 0))
            if ends[1] - ends[0] >= width:
                out.append((p, kind, round(float(prom), 6), round(float(ends[1] - ends[0]), 6)))
    return sorted(out)


@pytest.mark.parametrize("size", [40, 5_000])
def test_turning_points(spark, size):
    rng = np.random.default_rng(11)
    walk = rng.normal(size=1_500).cumsum().round(1)
    yo = (25 - 25 * np.cos(np.arange(1_200) / 30) + rng.normal(size=1_200)).round(1)
    groups = {1: walk.tolist(), 2: yo.tolist(), 3: [1.0, 2.0]}
    out = signal.turning_points(series(spark, groups, "x"), ["s"], "idx", "x", 4.0, 8.0, size).toPandas()
    for s, x in groups.items():
        got = sorted((int(r.idx), int(r.kind), round(r.prominence, 6), round(r.width, 6)) for r in out[out.s == s].itertuples())
        assert got == brute_turns(x, 4.0, 8.0)


@pytest.mark.parametrize("size, fan", [(16, 4), (100, 8), (5_000, 256)])
def test_turning_points_beyond_their_block(spark, size, fan):
    """Swings that all pass the prominence, bases far away, and plateaus over several blocks."""
    k = np.arange(320)
    wave = np.abs((k % 16) - 8.0) * 3
    plateau = np.repeat([0.0, 30.0, 5.0, 30.0, 2.0, 40.0, 0.0], 46)
    # The widest swing holds all others.
    nested = np.interp(k, [0, 8, 312, 319], [0, 90, 100, 0]) - wave
    groups = {1: (wave + k / 20), 2: (wave - k / 20), 3: wave, 4: plateau, 5: (wave * k / 40), 6: nested, 7: np.full(50, 3.0)}
    groups = {s: np.round(x, 6).tolist() for s, x in groups.items()}
    df = series(spark, groups, "x").withColumn("s", F.when(F.col("s") != 3, F.col("s")))
    out = signal.turning_points(df, ["s"], "idx", "x", 4.0, 6.0, size, fan).toPandas()
    for s, x in groups.items():
        mine = out[out.s.isna()] if s == 3 else out[out.s == s]
        got = sorted((int(r.idx), int(r.kind), round(r.prominence, 6), round(r.width, 6)) for r in mine.itertuples())
        assert got == brute_turns(x, 4.0, 6.0), s


def test_turning_points_of_rows_with_gaps(spark):
    x = np.random.default_rng(2).normal(size=400).cumsum().tolist()
    df = series(spark, {1: x}, "x").withColumn("idx", F.col("idx") * 3)
    nulls = df.withColumns({"idx": F.col("idx") + 1, "x": F.lit(None).cast("double")})
    out = signal.turning_points(df.union(nulls), ["s"], "idx", "x", 4.0, 6.0, 50, 8).toPandas()
    got = sorted((int(r.idx), int(r.kind), round(r.prominence, 6), round(r.width / 3, 6)) for r in out.itertuples())
    assert got == [(3 * p, *rest) for p, *rest in brute_turns(x, 4.0, 2.0)]


def test_profile_number(spark):
    x = (25 - 25 * np.cos(2 * np.pi * np.arange(1_000) / 200)).tolist()
    df = series(spark, {1: x}, "depth")
    out = signal.profile_number(df, ["s"], "idx", "depth", size=90).toPandas().sort_values("idx")
    n = out["profile_number"].tolist()
    assert n[0] == 1 and n[100] == 1 and n[101] == 2 and n[201] == 3 and max(n) == 10
    assert all(b - a in (0, 1) for a, b in zip(n, n[1:]))


def test_late_rows_are_dropped(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    base = pd.Timestamp("2024-01-01")

    def arrive(i, rows):
        pdf = pd.DataFrame([(base + pd.Timedelta(seconds=s), v) for s, v in rows], columns=["ts", "v"])
        spark.createDataFrame(pdf).withColumn("k", F.lit(1)).coalesce(1).write.parquet(str(source / f"b{i}"))

    arrive(1, [(0.2, 1.0), (0.7, 3.0), (1.1, 5.0), (2000, 7.0)])
    schema = spark.read.parquet(str(source / "b1")).schema

    def pump():
        stream = means.open_stream(spark, f"{source}/*", schema)
        means.write_means(means.stream_means(stream, ["k"], "ts", "v"), str(tmp_path / "out"), str(tmp_path / "check"))

    pump()
    arrive(2, [(0.5, 100.0), (1990, 1.0), (9000, 1.0)])
    pump()
    out = spark.read.parquet(str(tmp_path / "out")).orderBy("ts").toPandas()
    seconds = ((out["ts"] - base).dt.total_seconds()).tolist()
    assert seconds == [0, 1, 1990, 2000]
    assert out["v"].tolist() == [2.0, 5.0, 1.0, 7.0]


def test_depth_of_each_variable(spark):
    """Coordinates go; depth is the sensor's own, else the filtered one of the series, else unknown."""
    names = ["ctd1_salinity", "navigation_roll", "navigation_depth", "navigation", "gps_latitude", "nudged_longitude", "depth_filtdepth", None, "hs2_bb"]
    readings = spark.createDataFrame([(s, v, 50 * i) for s in (1, 2, None) for i, v in enumerate(names)], "s int, var string, us long")
    depths = [(1, "ctd1", 0, 10.0), (1, "ctd1", 400, 50.0), (1, "hs2", 0, None), (1, "depth", 0, 100.0), (1, "depth", 400, 500.0), (None, "depth", 0, 7.0)]
    nav = spark.createDataFrame([(s, 0, 36.0, -122.0) for s in (1, 2, None)], "s int, us long, lat double, lon double")
    out = grid.align_variables(readings, spark.createDataFrame(depths, "s int, instr string, us long, depth double"), nav, ["s"], width=100)
    got = {(r.s, r["var"]): (r.depth, r.lat) for r in out.collect()}
    kept = ("ctd1_salinity", "navigation_roll", "hs2_bb")
    want = {(1, v): d for v, d in zip(kept, (10.0, 150.0, 500.0))} | {(2, v): None for v in kept} | {(None, v): 7.0 for v in kept}
    assert got == {k: (d, 36.0) for k, d in want.items()}
