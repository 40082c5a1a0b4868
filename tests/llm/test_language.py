"""Language identification: held-out accuracy, exact counts, odd rows."""

import zlib

import numpy as np
import pytest

from tidemark.llm import language as L
from tidemark.llm import queries


@pytest.fixture(scope="module")
def judged(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = queries.op13(spark, "/root/testdata/sf0.01")
    return [r.asDict() for r in out.join(docs.select("doc_id", "lang", "text"), "doc_id").collect()]


def test_accuracy_on_held_out_rows(judged):
    held = [r for r in judged if r["held_out"] and r["lang"] is not None and r["lang_pred"] != "und"]
    for name in {r["lang"] for r in held}:
        own = [r for r in held if r["lang"] == name]
        assert sum(r["lang_pred"] == name for r in own) >= 0.95 * len(own)
    assert len({r["lang"] for r in held}) >= 4


def test_folds_and_scores(judged):
    for r in judged:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1


def test_families():
    assert L.family_of("de") == L.family_of("EN-gb") == "germanic" and L.family_of("pt_BR") == "romance" and L.family_of("xx") == "xx"


WORDS = {"de": "der und nicht ist das mit auf ein für zwischen", "en": "the and not is that with from this for between", "fr": "le et ne pas est que avec pour dans entre", "es": "el y no es que con para los del entre", "xx": "kwa zuma ndoto pili hakuna watu sana moja"}
DOCS = "doc_id bigint, text string, lang string, _t string, score string, note string"


def labelled(n=60):
    draw = np.random.default_rng(3)
    return [(i, " ".join(draw.choice(WORDS[l].split(), 12)), l, "clash", "clash", "other") for i in range(n) for l in WORDS]


def test_odd_rows(spark):
    odd = [(None, None, None), (7, "", "en"), (8, "123 !?", "de"), (None, "the and not that this", None), (9, "der und nicht ein", "en"), (9, "der und nicht ein", "en"), (10, "éè", None), (11, "日本語", None)]
    df = spark.createDataFrame([(i, t, l, "clash", "clash", "other") for i, t, l in odd], DOCS).repartition(3)
    model = L.fit(spark.createDataFrame(labelled(), DOCS))
    out = L.predict(df, model)
    assert out.columns == ["doc_id", "text", "lang", "_t", "note", "lang_pred", "score"]
    got = [(r.text, r.lang_pred, r.score) for r in out.collect()]
    assert len(got) == 8 and all(p == "und" and s == 0 for t, p, s in got if t in (None, "", "123 !?"))
    assert {p for t, p, _ in got if t and t.startswith("der")} == {"de"} and {p for t, p, _ in got if t and t.startswith("the")} == {"en"}
    assert all(p in WORDS and 0 < s <= 1 for t, p, s in got if t and t.strip("123 !?"))


def test_without_labels_or_rows(spark):
    df = spark.createDataFrame([(1, "text", None, "", "", "")], DOCS)
    assert L.fit(df) is None and L.fit(df.where("false")) is None
    assert [(r.lang_pred, r.score) for r in L.predict(df, None).collect()] == [("und", 0.0)]
    one = L.fit(spark.createDataFrame([(1, "text", "en", "", "", "")], DOCS))
    assert [(r.lang_pred, r.score) for r in L.predict(df, one).collect()] == [("en", 1.0)]
    assert L.predict(df.where("false"), one).count() == 0


def test_hierarchy_on_own_families(spark):
    model = L.fit(spark.createDataFrame(labelled(), DOCS))
    assert model.families == ("germanic", "romance", "xx") and [len(model.pairs[f][1]) for f in model.families] == [1, 1, 0]
    got = L.predict(spark.createDataFrame(labelled(20), DOCS), model).select("lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)


def test_training_rows_are_bounded(spark):
    copies = spark.createDataFrame(labelled(200) + [(1, "der und nicht", "de", "", "", "")] * 3000, DOCS)
    x, names = L.sample(copies, "text", "lang", "doc_id", rows=100)
    assert len(names) == len(x) <= 100 and {n: names.count(n) <= 20 for n in WORDS} == dict.fromkeys(WORDS, True)


def plain_counts(text):
    data = [b if b >= 0x80 or chr(b).isalpha() else 32 for b in text]
    data = [b for i, b in enumerate(data) if not (b == 32 and i and data[i - 1] == 32)]
    out = np.zeros(1 << L.BITS, np.int64)
    data = np.array(data, np.uint8)
    for n in L.GRAMS:
        for i in range(len(data) - n + 1):
            out[L.hashed(data[i : i + n], n, 1)[0]] += 1
    return out


def test_counts_do_not_depend_on_windows(monkeypatch):
    texts = [b" ab  cd ", b"", b" ", b" x1234y ", " äö über ".encode(), b" " + b"ab, " * 100, b"z"] * 12
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    want = np.array([plain_counts(t) for t in texts[:7]] * 12)
    for size in (1, 2, 3, 5, 64, 1 << 18):
        monkeypatch.setattr(L, "BYTES", size)
        got = np.concatenate([x for _, _, x in L.counts(data, offsets)])
        assert (got == want).all()


def test_very_long_text(spark):
    long = "der und nicht ist " * 400_000
    model = L.fit(spark.createDataFrame(labelled(), DOCS))
    got = L.predict(spark.createDataFrame([(1, long, None, "", "", ""), (2, "the and that", None, "", "", "")], DOCS), model).collect()
    assert [r.lang_pred for r in got] == ["de", "en"]
