"""Results that must not depend on chunks, row counts or lengths."""

import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import ordered as o
from tidemark.operators import particles, resample, section, signal, timejoin
from tidemark.operators.clean import keep_monotonic


def counters(spark, groups):
    rows = [(s, i, v) for s, vs in groups.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "s int, idx long, c long")


def plain_repair(values):
    """The rule of each step, row by row."""
    v = list(values)
    known = [(i, x) for i, x in enumerate(v)]
    for i, x in enumerate(values):
        if x == 0:
            before = max(((k, y) for k, y in known[:i] if y not in (0, None)), default=None)
            after = min(((k, y) for k, y in known[i:] if y not in (0, None)), default=None)
            if before and after and i - before[0] < 5 and after[0] - i < 5:
                v[i] = before[1] + math.floor((i - before[0]) * (after[1] - before[1]) / (after[0] - before[0]))
    w, begin = list(v), 0
    for i in range(len(v)):
        if i == 0 or v[i] is None or v[i - 1] is None or v[i] != v[i - 1]:
            begin = i
        w[i] = None if v[i] is None else v[i] + i - begin
    jumps = [i for i in range(1, len(w)) if w[i] is not None and w[i - 1] is not None and abs(w[i] - w[i - 1]) > 300]
    out, k = list(w), 0
    while k < len(jumps):
        cluster = [jumps[k]]
        while k + 1 < len(jumps) and jumps[k + 1] - jumps[k] <= 20:
            k += 1
            cluster.append(jumps[k])
        for a, b in zip(cluster[::2], cluster[1::2]):
            if np.sign(w[a] - w[a - 1]) == -np.sign(w[b] - w[b - 1]):
                for i in range(a, b):
                    out[i] = w[a - 1] + math.floor((i - a + 1) * (w[b] - w[a - 1]) / (b - a + 1))
        k += 1
    return out


@pytest.mark.parametrize("width", [7, 64, 100_000])
def test_counter_repair_in_any_chunks(spark, width):
    draw = random.Random(5)
    long = [100 + 2 * i for i in range(1500)]
    for i in range(200, 900):  # stuck for longer than any chunk
        long[i] = long[200]
    for at in (30, 31, 60, 127, 128, 1000, 1200):
        long[at] = 0
    for at, n, jump in ((62, 3, 5000), (126, 1, -4000), (1100, 20, 900), (1300, 21, 900), (1400, 1, 700), (1410, 4, -700)):
        for i in range(at, at + n):
            long[i] += jump
    for i in range(1450, 1500):
        long[i] += 1000  # a lasting step
    gaps = [None, 5, 5, None, 5, 6, None, None, 9, 2000, 11, 0, None, 0, 30]
    noise = [100 + 2 * i + (draw.choice([0, 0, 0, 0, 0, 800, -800]) if i % 9 == 0 else 0) for i in range(300)]
    groups = {1: long, 2: gaps, 3: noise, 4: [7], 5: [None], None: long[:300]}
    got = particles.repair_counter(counters(spark, groups), o.axis("s", "idx", width), "c").collect()
    found = {s: [None] * len(vs) for s, vs in groups.items()}
    for r in got:
        found[r.s][r.idx] = r.c
    for s, values in groups.items():
        assert found[s] == plain_repair(values), s


def test_missing_keys_keep_their_carry(spark):
    rows = [(None, i, t) for i, t in enumerate([5, 9, 7, 8, 12])] + [(1, i, t) for i, t in enumerate([1, 3, 2])]
    df = spark.createDataFrame(rows, "s int, seq long, us long")
    for width in (1, 2, 100):
        kept = keep_monotonic(df, o.axis("s", "seq", width), "us")
        assert sorted((r.s or 0, r.us) for r in kept.collect()) == [(0, 5), (0, 9), (0, 12), (1, 1), (1, 3)]


@pytest.mark.parametrize("rows", [1, 2000, 2001])
def test_effective_for_any_number_of_rows(spark, rows):
    dim = spark.range(rows).select((F.col("id") * 10).alias("valid"), F.col("id").alias("v"))
    dim = dim.unionByName(spark.createDataFrame([(None, -1)], "valid long, v long"))
    facts = spark.createDataFrame([(-5,), (0,), (9,), (10,), (10 * rows + 50,), (None,)], "at long")
    for first, before in ((True, 0), (False, None)):
        got = {r.at: r.v for r in timejoin.effective(facts, dim, "at", "valid", first_if_none=first, width=100).collect()}
        assert got == {-5: before, 0: 0, 9: 0, 10: min(1, rows - 1), 10 * rows + 50: rows - 1, None: before}
    plan = timejoin.effective(facts, dim, "at", "valid")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("cutoff", [0.05, 0.2, 1.0])
def test_lowpass_at_any_cutoff(spark, cutoff):
    h = signal.fading_response(8, cutoff / 5, 1e-10)
    assert abs(h.sum() - 1) < 1e-6
    n = 400
    rows = [(1, i, 20.0) for i in range(n)] + [(2, i, math.sin(i / 40) + 3) for i in range(n)]
    df = spark.createDataFrame(rows, "s int, idx long, x double")
    parts = [signal.lowpass(df, ["s"], "idx", "x", "y", cutoff_hz=cutoff, size=z, tolerance=1e-10).toPandas() for z in (37, 10_000)]
    one, whole = (p.sort_values(["s", "idx"])["y"].to_numpy(float) for p in parts)
    np.testing.assert_allclose(one, whole, atol=1e-6)
    np.testing.assert_allclose(whole[:n], 20.0, atol=1e-4)


def test_lowpass_refuses_what_never_fades():
    with pytest.raises(ValueError):
        signal.fading_response(8, 1e-6, 1e-12)


def test_rolling_has_one_type(spark):
    df = spark.createDataFrame([(1, i, [3, None, 5, 4, 9][i % 5], [1.0, float("nan"), None, 4.0, 2.0][i % 5]) for i in range(60)], "s int, idx long, n int, x double")
    for fn in ("min", "max", "mean", "sum", "count"):
        for col in ("n", "x"):
            narrow, wide = (resample.rolling(df, ["s"], "idx", col, fn, w, "out", 20) for w in (16, 17))
            assert narrow.schema["out"].dataType == wide.schema["out"].dataType
            got = {r.idx: r.out for r in narrow.collect()}
            want = {r.idx: r.out for r in resample.map_blocks(df, ["s"], "idx", 8, 8, slide(col, fn), wide.schema).collect()}
            assert got == pytest.approx(want, nan_ok=True)


def slide(col, fn):
    def run(block):
        window = block[col].rolling(16, min_periods=0 if fn == "count" else 1, center=True)
        block["out"] = getattr(window, fn)()
        return block

    return run


def plain_prominent(v, least):
    out = []
    for p in range(1, len(v) - 1):
        if not v[p - 1] < v[p] > v[p + 1]:
            continue
        left = next((k for k in range(p - 1, -1, -1) if v[k] > v[p]), -1)
        right = next((k for k in range(p + 1, len(v)) if v[k] > v[p]), len(v))
        prominence = v[p] - max(min(v[left + 1 : p + 1]), min(v[p:right]))
        if prominence >= least:
            level = v[p] - 0.5 * prominence
            a = next(k for k in range(p, -1, -1) if v[k] <= level)
            b = next(k for k in range(p, len(v)) if v[k] <= level)
            out.append((p, prominence, a + 1, b - 1))
    return out


def summits(v, least):
    """Peaks of one block that is a whole series: what is open at its ends is known."""
    at = np.arange(len(v))
    lo, _, w = signal._collapse(at, at, np.array(v, dtype=float))
    found = signal._summits(lo, lo, w, least) if len(w) else []
    return [(row[0], row[2] - max(row[3], row[4])) for row in found if row[2] - max(row[3], row[4]) >= least]


def test_prominence_equals_plain_search():
    draw = random.Random(3)
    for _ in range(300):
        v = [float(x) for x in draw.sample(range(90), draw.randint(1, 40))]
        assert summits(v, 2.0) == [row[:2] for row in plain_prominent(v, 2.0)]


def test_prominence_grows_in_proportion():
    def seconds(n):
        rising = np.empty(2 * n)
        rising[::2], rising[1::2] = np.arange(n), np.arange(n) + 20.0
        began = time.process_time()
        assert len(summits(rising, 5.0)) >= n - 1
        return time.process_time() - began

    seconds(500)
    assert seconds(40_000) < 40 * max(seconds(4_000), 0.01)


def test_few_bases_stay_open():
    """Peaks that rise, fall or repeat within a block are settled there, but for its records."""
    k = np.arange(2_000)
    for v in (20.0 * (k % 2) + k / 10, 20.0 * (k % 2) - k / 10, np.random.default_rng(5).normal(size=2_000) * 20):
        found = signal._summits(k, k, v, 5.0)
        assert sum(row[5] or row[6] for row in found) < 60


def test_stacked_scans_read_once(spark, tmp_path):
    spark.range(1000).select(F.lit(1).alias("s"), "id", (F.col("id") % 7).alias("x")).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    ax = o.axis("s", "id", 100)
    for _ in range(4):
        df = resample.fill(df, ax, ["x"])
        assert o.leaves(df) == 2  # rows and totals of one table


def test_trailing_envelope(spark):
    rows = [(1, i, float((i * 37) % 101)) for i in range(400)]
    df = spark.createDataFrame(rows, "s int, idx long, x double")
    got = signal.background_envelope(df, ["s"], "idx", "x", window=30, least=5.0, size=64, trailing=True).toPandas().sort_values("idx")
    roll = got["x"].rolling(30, min_periods=1)
    low = roll.min().rolling(30, min_periods=1).mean()
    np.testing.assert_allclose(got["min_bg"], low, atol=1e-9)


@pytest.mark.parametrize("step", [1, 7, 1000])
def test_count_up_at_any_step(spark, step):
    rows = spark.createDataFrame([(i, n) for i, n in enumerate([0, 1, 6, 7, 8, 999, 1000, 1001, -3, None])], "i int, n bigint")
    found = section.count_up(rows, F.col("n"), "k", step).groupBy("i").agg(F.count("k").alias("c"), F.min("k").alias("a"), F.max("k").alias("b")).collect()
    assert {r.i: (r.c, r.a, r.b) for r in found} == {i: (n, 0, n - 1) for i, n in enumerate([0, 1, 6, 7, 8, 999, 1000, 1001]) if n}
