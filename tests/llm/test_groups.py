"""Near duplicates, mixing and fingerprints against plain versions."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import components, fingerprints, mixing, neardup


def near_rows(seed=2):
    """Copies, near copies around an original, chains, passages that documents share, odd texts."""
    draw = random.Random(seed)
    fresh = lambda n: [f"v{draw.randrange(10**6)}" for _ in range(n)]
    texts = [None, "", " \n ", "one", "One", "two words", "a b c d", "a b c d e", "A b C d e"]
    for size in (30, 120):
        origin = fresh(size)
        texts += [" ".join(origin)] * 4 + [" ".join(origin).upper()]
        for edits in (1, 1, 1, 2, 2, 3, 4, 5) * 4:
            copy = list(origin)
            for _ in range(edits * size // 60 + 1):
                copy[draw.randrange(size)] = fresh(1)[0]
            texts.append(" ".join(copy))
    base = fresh(100)
    for k in range(0, 30):  # each like the one before, the ends unlike
        texts.append(" ".join(base[k:] + [f"c{i}" for i in range(k)]))
    passage = fresh(60)
    texts += [" ".join(fresh(20) + passage + fresh(20)) for _ in range(40)]
    deleted = [w for i, w in enumerate(passage + base) if i % 11]
    texts += [" ".join(passage + base)] + [" ".join(deleted + fresh(k)) for k in range(6)]
    texts += [" ".join(fresh(draw.randint(1, 40))) for _ in range(60)] + [" ".join(fresh(20_000))]
    order = list(range(len(texts)))
    draw.shuffle(order)
    return [(3 * i + 1, texts[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize("percent", [85, 80, 60])
def test_components_equal_brute_force(spark, percent):
    rows = near_rows()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, cls string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.components_of(df, percent=percent).collect()}
    want = {i: (n, c if n else i, (c if n else i) == i) for i, n, c in brute.components(rows, percent)}
    assert got == want


def test_large_buckets_lose_no_link(spark, monkeypatch):
    """Every bucket goes the way of the large ones, and equals the plain version."""
    monkeypatch.setattr(neardup, "FEW", 1)
    rows = near_rows(7)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in neardup.components_of(df, percent=85).collect()}
    assert got == {i: (c if n else i) for i, n, c in brute.components(rows, 85)}


def test_repeated_rows_and_missing_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(7, text), (7, text), (7, "something else in here now"), (None, text), (9, text), (3, None), (3, None), (None, "")]
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.components_of(spark.createDataFrame(rows, "doc_id int, text string")).collect())
    assert got == Counter(
        {(7, 36, 7, True): 2, (7, 1, 7, True): 1, (None, 36, 7, False): 1, (9, 36, 7, False): 1, (3, 0, 3, True): 2, (None, 0, None, True): 1}
    )
    assert neardup.components_of(spark.createDataFrame([], "doc_id int, text string")).count() == 0


def test_bands_and_decisions_keep_their_miss_probability():
    for percent in (60, 80, 85, 95):
        split = neardup.banding(percent)
        assert (1 - (percent / 100) ** split.rows) ** split.bands <= neardup.MISS
        draw = np.random.default_rng(1)
        matches = draw.random((20_000, neardup.HASHES)) < percent / 100
        lost = np.zeros(len(matches), bool)
        for k, most in enumerate(neardup.needed(percent)):
            lost |= matches[:, : (k + 1) * neardup.BATCH].sum(1) < most
        assert lost.mean() < 0.002


def test_signatures_estimate_similarity():
    keys = np.random.default_rng(3).integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = keys[:2000], keys[500:2500]
    x, y = (neardup.minhash(np.sort(k), np.array([0])) for k in (a, b))
    assert abs((x == y).mean() - 1500 / 2500) < 0.12


def test_components_of_paths_and_stars(spark):
    links = [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(60)] + [("hub", f"s{i:03d}") for i in range(200)] + [("x", "y"), ("y", "x"), ("z", "z")]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a string, b string")).collect()}
    want = {f"p{i:03d}": "p000" for i in range(61)} | {f"s{i:03d}": "hub" for i in range(200)} | {"hub": "hub", "x": "x", "y": "x"}
    assert got == want
    assert components.components(spark.createDataFrame([], "a string, b string")).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_quotas_are_the_highest_quotients(spark, seed):
    draw = random.Random(seed)
    groups = {}
    for g in range(12):
        n = draw.choice([1, 2, 5, 40, 150])
        groups[g] = ([draw.choice([0, 1, 3, draw.randint(1, 10**6)]) for _ in range(n)], draw.choice([0, 1, 7, n, 5 * n, 1000]))
    rows = [(g, i, w, seats) for g, (ws, seats) in groups.items() for i, w in enumerate(ws)]
    claims = spark.createDataFrame(rows, "g int, i int, w bigint, seats bigint")
    got = {(r.g, r.i): r.quota for r in mixing.apportion(claims, ["g"], "seats", "w", ["i"]).collect()}
    want = {}
    for g, (ws, seats) in groups.items():
        dealt = brute.apportion(ws, seats) if any(ws) else [0] * len(ws)
        want |= {(g, i): q for i, q in enumerate(dealt)}
    assert got == want


def test_targets_reshare_the_excess(spark):
    draw = random.Random(1)
    for sizes in ([10, 10, 10], [1, 1000, 1, 5], [0, 7, 0], [draw.randint(0, 500) for _ in range(23)], [5]):
        names = [f"s{i:02d}" for i in range(len(sizes) - 1)] + [None]
        df = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size bigint")
        got = {r.source: r.target for r in mixing.targets(df).collect()}
        want = brute.targets(sizes, [(1, 2, 3)[i % 3] for i in range(len(sizes))])
        assert [got[n] for n in names] == pytest.approx(want)


def mix_rows():
    draw = random.Random(6)
    sources = ["a", "B", "é", "z", None]
    rows = [(i, sources[min(4, draw.randrange(9))], " ".join("w" * draw.choice([0, 5, 30, 200]))) for i in range(600)]
    return rows + [(1000, "tiny", "one two"), (1001, "none", None), (1001, "none", ""), (None, "a", "x y z"), (5, "a", "x y z"), (5, "a", "x y z")]


def test_mix_comes_near_its_targets(spark):
    rows = mix_rows()
    df = spark.createDataFrame([(i, s, t, 1) for i, s, t in rows], "doc_id int, source string, text string, taken int")
    got = mixing.mix(df).collect()
    again = mixing.mix(df.repartition(7)).collect()
    assert Counter(got) == Counter(again) and len(got) == len(rows)
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((i, s, len(brute.words(t))) for i, s, t in rows)
    taken, target = Counter(), {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and r.target <= 3 * r.source_size + 1e-9
        taken[r.source] += r.taken
        target[r.source] = r.target
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.02 * t + 10, (s, taken[s], t)
    assert mixing.mix(spark.createDataFrame([], df.schema)).count() == 0


@pytest.mark.parametrize("size", [1, 150, 300, 500, 1600, 2600])
def test_a_tiny_source_reaches_its_target_beside_large_ones(spark, size):
    large = spark.range(7 * 500).select("id", F.concat(F.lit("s"), F.col("id") % 7).alias("source"), F.repeat(F.lit("w "), 10_000).alias("text"))
    tiny = spark.createDataFrame([(10**6 + i, "tiny", "w " * min(50, size - i)) for i in range(0, size, 50)], "id bigint, source string, text string")
    mixed = mixing.mix(large.union(tiny), doc="id")
    per_source = {r.source: r for r in mixed.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()}
    assert len(per_source) == 8 and per_source["tiny"].target == 3 * size
    for r in per_source.values():
        assert abs(r.taken - r.target) <= 0.005 * r.target + 1, r


def sketch_of(text, k=fingerprints.K):
    w = [xxhash.xxh64_intdigest(x.encode(), 42) for x in brute.words(text)]
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    out = set()
    for i in range(max(1, len(w) - 4) if w else 0):
        seed = 42
        for h in w[i : i + 5]:
            seed = xxhash.xxh64_intdigest(h.to_bytes(8, "little"), seed)
        out.add(signed(seed))
    return sorted(out)[:k]


def test_sketches_and_estimates(spark):
    draw = random.Random(9)
    words = [f"w{i}" for i in range(5000)]
    long = " ".join(words)
    texts = [None, "", "  ", "a", "a b", "a b c d e", long, " ".join(words[1250:] + words[:0]), " ".join(draw.choice(words[:50]) for _ in range(400))]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").withColumn("s", fingerprints.sketch(F.col("text")))
    got = {r.i: r.s for r in df.collect()}
    assert got == {i: sketch_of(t or "") for i, t in enumerate(texts)}
    pairs = df.crossJoin(df.toDF("j", "other", "o"))
    found = {
        (r.i, r.j): r
        for r in pairs.select(
            "i", "j", fingerprints.resemblance(F.col("s"), F.col("o")).alias("r"), fingerprints.containment(F.col("s"), F.col("o")).alias("c"),
            fingerprints.distinct_shingles(F.col("s")).alias("n"), (fingerprints.merge(F.col("s"), F.col("o")) == fingerprints.merge(F.col("o"), F.col("s"))).alias("m"),
        ).collect()
    }
    assert all(r.m for r in found.values()) and found[0, 1].r == 1.0 and found[1, 3].r == 0.0 and found[6, 6].r == 1.0
    a, b = brute.shingles(texts[6]), brute.shingles(texts[7])
    assert abs(found[6, 7].r - len(a & b) / len(a | b)) < 0.15 and abs(found[7, 6].c - len(a & b) / len(b)) < 0.15
    assert abs(found[6, 6].n / len(a) - 1) < 0.3 and found[5, 5].n == 1


def test_parts_merge_to_the_whole(spark):
    words = [f"w{i}" for i in range(3000)]
    parts = [" ".join(words[k : k + 304]) for k in range(0, 2700, 300)]
    df = spark.createDataFrame([("g", p) for p in parts] + [("h", "a b"), ("h", "a b")], "g string, text string")
    merged = fingerprints.merge_parts(df.select("g", fingerprints.sketch(F.col("text")).alias("sketch")), ["g"])
    assert {r.g: r.sketch for r in merged.collect()} == {"g": sketch_of(" ".join(words[:2704])), "h": sketch_of("a b")}


def test_near_copies_are_made_one_before_they_are_ranked(spark):
    parts = spark.range(2000).select(F.lit("g").alias("g"), F.sequence(F.lit(0), F.lit(199)).cast("array<bigint>").alias("sketch"))
    merged = fingerprints.merge_parts(parts.unionByName(parts.limit(3).withColumn("g", F.lit(None).cast("string"))), ["g"])
    assert {r.g: r.sketch for r in merged.collect()} == dict.fromkeys(["g", None], list(range(fingerprints.K)))
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [" in plan and plan.rindex("Aggregate [") > plan.rindex("Window [")


def test_next_rows(spark):
    def of(rows):
        df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id int, text string, next_x int").repartition(3)
        return fingerprints.with_next(df, "doc_id", ["text"]).collect()

    rows = [(i * i, f"t{i}") for i in range(300)]
    random.Random(1).shuffle(rows)
    after = {r.text: r.next_text for r in of(rows)}
    assert after == {f"t{i}": f"t{(i + 1) % 300}" for i in range(300)}
    odd = [(5, "a"), (5, "a"), (5, "b"), (None, "n"), (9, None)]
    assert Counter(r.next_text for r in of(odd)) == Counter(t for _, t in odd)
    assert [r.next_text for r in of([(4, "alone")])] == ["alone"] and of([]) == []


def around(spark, sets, percent=80):
    """Pairs of ``around_pivots`` for one pivot, set 0, and all others apart."""
    keys = [np.array(sorted(s), dtype=np.uint64) for s in sets]
    own = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    bits = neardup.parities(np.concatenate(keys), own, len(keys))
    held = [(bytes([i]), k.astype(np.int64).tolist(), b.tolist()) for i, (k, b) in enumerate(zip(keys, bits))]
    full = spark.createDataFrame(held, "cls binary, keys array<bigint>, parity array<bigint>")
    star = spark.createDataFrame([(b"\0", bytes([i]), bytes([i])) for i in range(1, len(sets))], "pivot binary, cls binary, root binary")
    return {(r.a[0], r.b[0]) for r in neardup.around_pivots(star, full, percent).collect()}


def test_members_apart_make_few_rows(spark):
    """Members that lack much the same of their pivot, but are not linked, make no rows by the square; no link is lost."""
    draw = np.random.default_rng(3)
    names = [int(k) for k in draw.integers(1, 2**62, 160)]
    lack = [set(draw.choice(72, 36, replace=False)) for _ in range(40)]
    lack += [(x - {min(x)}) | {71} for x in lack[:10]]
    sets = [set(names)] + [{k for i, k in enumerate(names) if i not in x} for x in lack]
    linked = {(i, j) for i in range(1, 51) for j in range(i + 1, 51) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    got = around(spark, sets)
    assert len(linked) >= 10 and linked <= got
    assert len(got) < 5 * len(linked)


def test_parities_differ_no_more_than_sets():
    draw = np.random.default_rng(5)
    for n in (1, 40, 2000):
        x, y = (np.unique(draw.integers(0, 3 * n, n).astype(np.uint64)) for _ in range(2))
        a, b = neardup.parities(np.r_[x, y], np.repeat([0, 1], [len(x), len(y)]), 2)
        assert sum(int(v).bit_count() for v in (a ^ b).view(np.uint64)) <= len(set(x.tolist()) ^ set(y.tolist()))
