"""The filter audit against filters that are applied one after the other."""

import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import audit, queries

DOCS, LABELS = "doc_id bigint, source string, text string, doc string, n int", "doc_id bigint, quality int, toxic int, part string"


def fails(text):
    w = brute.words(text)
    return {
        "A": len(w) < 50,
        "B": 100 * len(set(w)) < 65 * len(w),
        "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
    }


def plain(rows, labels):
    """All rows of the audit, each order walked through its filters."""
    docs = []
    for i, source, text in rows:
        text = text or ""
        known = [x for x in labels if i is not None and x[0] == i]
        copy = any(j is not None and i is not None and j < i and (t or "") == text for j, _, t in rows)
        docs.append((source or "", {**fails(text), "E": copy}, any(x[1] == 1 for x in known), any(x[2] == 1 for x in known)))
    out, shapley = [], {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[1][f]]
                left = [d for d in left if not d[1][f]]
                failing = [d for d in own if d[1][f]]
                alone = [d for d in failing if sum(d[1].values()) == 1]
                out.append([part, order, step, len(left), len(gone), len(failing) - len(gone), len(alone), sum(d[2] for d in gone), sum(d[3] for d in gone)])
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
    return {tuple([*r, shapley[r[0], r[1][r[2] - 1]]]) for r in out}


def some(seed, n=150):
    draw = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)] + ["Upper", "ALLUPPER", "a#b", "50%", "é", "日本"]
    texts = [None, "", " \t\r\n\x0b\x0c", "one", "A" * 30, "x y " * 40, "|"]
    for _ in range(n):
        k = draw.choice([3, 48, 49, 50, 51, 120])
        held = vocab[: draw.choice([20, 80, 400, 406])]
        texts.append(draw.choice([" ", "\n", " \x0b"]).join(draw.choice(held) for _ in range(k)))
    picked = [draw.choice(texts) for _ in range(n)] + ["hot copy " * 30] * 60
    return [(draw.choice([None, *range(n)]), draw.choice([None, "", "s1", "s2", "ü"]), t) for t in picked]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_filters_in_turn(spark, seed):
    rows = some(seed)
    rows += [(5, "s1", "same"), (5, "s1", "same"), (5, "s2", "same"), (6, "s2", "same"), (None, "s2", "same")]
    labels = [(i, random.Random(i).choice([0, 1, None]), i % 2, "x") for i in range(0, 150, 2)] + [(4, 1, 0, "x"), (4, 0, 1, "x"), (None, 1, 1, "x")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], DOCS).repartition(4)
    got = [tuple(r) for r in audit.audit(df, spark.createDataFrame(labels, LABELS)).collect()]
    assert len(got) == 600 * len({s or "" for _, s, _ in rows})
    assert set(got) == plain(rows, labels)


def test_empty_tables(spark):
    none, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert audit.audit(none, labels).count() == 0
    one = audit.audit(spark.createDataFrame([(1, None, None, "", 0)], DOCS), labels)
    assert {(r.part, r.kept, r.removed) for r in one.where("step = 1 and filter_order like 'A%'").collect()} == {("", 0, 1)}


def test_words_in_windows():
    text = ("ab cd\t" * 50 + "x" * 90 + " \n é ").encode()
    whole = text.split()
    for window in (1, 2, 7, 64, 1000):
        assert audit.count_words(text, window) == (len(whole), len(set(whole)))


def test_very_long_text():
    text = b"word" + b" some more words" * 2_000_000
    assert audit.count_words(text) == (6_000_001, 4)
    assert audit.failed(text) == 4


def test_query_counts_every_document(spark, sf):
    out = queries.op11(spark, sf)
    last = out.where("step = 5").select("part", "filter_order", "kept").toPandas()
    assert (last.groupby("part").kept.nunique() == 1).all()
    first = out.where("step = 1").groupBy("part", "filter_order").agg(F.sum(F.col("kept") + F.col("removed")).alias("n"))
    docs = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert first.groupBy("filter_order").agg(F.sum("n").alias("n")).select("n").distinct().collect()[0].n == docs
