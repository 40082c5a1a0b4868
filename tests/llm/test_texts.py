"""Words, quality rules, line dedup: plain versions and edge cases."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import lines, quality
from tidemark.llm import words as W

ODD = [
    None,
    "",
    " \t\n\r\n ",
    "one",
    "a b c d e f g h i j\na b c d e f g h i j",
    "Ünïcödé 日本語 テスト " * 40,
    "x" * 200_000,
    "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 " * 3000,
    "# * $ % & | < > " * 5,
    "line one\nline two\n\nline one\n  \nLINE one",
    "end with newline\n",
    "\x0b\x0c vertical\x0btab",
]


def some_texts(n=60, seed=3):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["é", "日本", "#", "<b>"]
    out = []
    for _ in range(n):
        line = lambda: " ".join(draw.choice(vocabulary) for _ in range(draw.randint(0, 12)))
        out.append("\n".join(line() for _ in range(draw.randint(1, 8))))
    return out


def test_spans_and_hashes_follow_python():
    texts = [t or "" for t in ODD] + some_texts()
    for first, last, data, offsets in W.slices(pa.array(texts), 5000):
        starts, ends, text = W.spans(~W.SPACE[data], offsets)
        found = [[] for _ in range(first, last)]
        for a, b, t in zip(starts, ends, text):
            found[t].append(bytes(data[a:b]).decode())
        assert found == [brute.words(t) for t in texts[first:last]]
        own = W.hashes(data, starts, ends)
        plain = [bytes(data[a:b]) for a, b in zip(starts, ends)]
        assert len(set(own.tolist())) == len(set(plain)) == len(set(zip(own.tolist(), plain)))


def test_window_hashes_tell_order():
    data = np.frombuffer(b"a b c a b c b a", np.uint8)
    starts, ends, text = W.spans(~W.SPACE[data], np.array([0, len(data)]))
    keys, at = W.windows(W.hashes(data, starts, ends), text, 2)
    assert keys[0] == keys[3] and keys[0] != keys[6] and list(at) == list(range(7))


def test_quality_equals_brute_force(spark):
    texts = ODD + some_texts()
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(0, None, "clash"), (4, ODD[4], "clash")]
    df = spark.createDataFrame(rows, "doc_id int, text string, n_words string").repartition(3)
    got = quality.judge(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[c] for c in (*quality.COUNTS, "repeat_chars_5", "repeat_chars_10", "repeat_chars_20")) == brute.quality(r.text)
        assert r.kept == brute.kept(r.text)


def test_quality_of_no_rows(spark):
    out = quality.judge(spark.createDataFrame([], "doc_id int, text string"))
    assert out.count() == 0 and "kept" in out.columns


def line_rows():
    shared = ["Share this page", "  share THIS page\t", "cookie notice é", "É unlike", ""]
    draw = random.Random(8)
    rows = [(i, "\n".join([f"own {i}", *draw.sample(shared, 4), "x" * (i % 3)])) for i in range(40)]
    return rows + [(100, None), (101, ""), (102, "Share this page"), (103, "\n".join(["Share this page"] * 3000 + ["end"])), (104, "last\n")]


@pytest.mark.parametrize("documents", [2, 10])
def test_lines_equal_brute_force(spark, documents):
    rows = line_rows()
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id int, text string, n_lines int").repartition(4)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in lines.drop_lines(df, documents=documents).collect()}
    assert got == {i: rest for i, *rest in ((i, (n, d, t)) for i, n, d, t in brute.drop_lines(rows, documents)) for rest in rest}


def test_repeated_rows_are_one_document(spark):
    rows = [(1, "same line\nown")] * 30 + [(1, "same line\nother"), (None, "same line")] + [(i, "same line\nz") for i in range(2, 9)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    out = lines.drop_lines(df, documents=10).agg(F.count("*").alias("n"), F.sum("n_dropped").alias("dropped")).first()
    assert (out.n, out.dropped) == (len(rows), 0)  # nine documents hold the line
    more = df.unionByName(spark.createDataFrame([(50, "SAME line")], df.schema))
    assert lines.drop_lines(more, documents=10).agg(F.sum("n_dropped")).first()[0] == len(rows) + 1


def test_texts_without_an_id_are_documents_of_their_own(spark):
    rows = [(None, f"same line\nown {i}") for i in range(9)] + [(None, "same line\nown 0"), (None, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    assert lines.drop_lines(df, documents=10).agg(F.sum("n_dropped")).first()[0] == 0  # nine texts hold the line
    more = lines.drop_lines(df.unionByName(spark.createDataFrame([(1, "SAME line")], df.schema)), documents=10).collect()
    assert sorted(r.kept_text for r in more) == sorted(["", "", "", "own 0", *(f"own {i}" for i in range(9))])


def test_lines_of_no_rows(spark):
    assert lines.drop_lines(spark.createDataFrame([], "doc_id int, text string")).count() == 0


def test_columns_that_clash_with_the_line_operator(spark):
    rows = [(i, "shared\nown %d" % i, 1, 2, 3, 4, 5, 6) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id int, text string, _doc int, _gone int, _sum int, _mark int, _text int, n_lines int")
    out = lines.drop_lines(df)
    assert out.columns == ["doc_id", "text", "_doc", "_gone", "_sum", "_mark", "_text", "n_lines", "n_dropped", "kept_text"]
    assert sorted((r.doc_id, r["_doc"], r["_gone"], r.n_lines, r.kept_text) for r in out.collect()) == [(i, 1, 2, 2, "own %d" % i) for i in range(12)]
