"""The pipeline against plain versions of its stages."""

import hashlib
import struct
from collections import Counter, defaultdict

import duckdb
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import brute
from tidemark.llm import queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def documents(sf):
    return pq.read_table(f"{sf}/documents.parquet").to_pylist()


@pytest.fixture(scope="module")
def staged(spark, sf, tmp_path_factory):
    """What each stage returns, as the next one reads it."""
    out, docs = [], spark.read.parquet(f"{sf}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append([r.asDict() for r in docs.collect()])
    return out


def counted(rows, columns=COLUMNS):
    return Counter(tuple(r[c] for c in columns) for r in rows)


def test_quality_stage(documents, staged):
    assert counted(staged[0]) == counted(r for r in documents if brute.kept(r["text"]))
    assert 0 < len(staged[0]) < len(documents)


def test_line_stage(staged):
    texts = {i: t for i, _, _, t in brute.drop_lines([(r["doc_id"], r["text"]) for r in staged[0]])}
    assert counted(staged[1]) == counted({**r, "text": texts[r["doc_id"]], "n_chars": len(texts[r["doc_id"]])} for r in staged[0])
    assert any(texts[r["doc_id"]] != r["text"] for r in staged[0])


def test_line_stage_counts_rows_that_share_an_id(spark):
    for doc_id in (None, 7):
        rows = [(doc_id, f"same line\nown {i}", "s") for i in range(10)]
        out = corpus_pipeline.drop_common_lines(spark, spark.createDataFrame(rows, "doc_id int, text string, source string"), "")
        assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter((doc_id, f"own {i}") for i in range(10))


def test_near_stage(staged):
    component = {i: c if n else i for i, n, c in brute.components([(r["doc_id"], r["text"]) for r in staged[1]], 80)}
    assert counted(staged[2]) == counted(r for r in staged[1] if component[r["doc_id"]] == r["doc_id"])
    assert len(staged[2]) < len(staged[1])


def test_mixing_stage(staged):
    times, size = Counter(r["doc_id"] for r in staged[3]), {r["doc_id"]: len(brute.words(r["text"])) for r in staged[2]}
    assert set(times) <= set(size) and max(times.values()) <= 3
    names = sorted({r["source"] for r in staged[2]}, key=lambda s: (s is None, s))
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in staged[2]:
        sizes[r["source"]] += size[r["doc_id"]]
        taken[r["source"]] += times[r["doc_id"]] * size[r["doc_id"]]
    for name, target in zip(names, brute.targets([sizes[n] for n in names], [(1, 2, 3)[i % 3] for i in range(len(names))])):
        longest = max(size[r["doc_id"]] for r in staged[2] if r["source"] == name)
        assert abs(taken[name] - target) <= 0.03 * target + longest
    assert counted(staged[3]) == Counter({k: n * times[k[0]] for k, n in counted(staged[2]).items() if times[k[0]]})


def test_mixing_stage_keeps_a_tiny_source(spark):
    large = spark.range(7 * 500).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 7).alias("source"), F.repeat(F.lit("w "), 10_000).alias("text"))
    tiny = spark.createDataFrame([(10**6 + i, "tiny", "w " * 50) for i in range(3)], "doc_id bigint, source string, text string")
    out = corpus_pipeline.mix_sources(spark, large.union(tiny), "").where("source = 'tiny'")
    assert Counter(r.doc_id for r in out.collect()) == {10**6 + i: 3 for i in range(3)}


def test_codec_stage(staged):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for r in staged[3]:
        ids = library.encode(r["text"], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        sha = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        want[r["doc_id"], r["source"], len(ids), tuple(ids), sha, hashlib.sha256(decoded.encode()).hexdigest()] += 1
    got = Counter((r["doc_id"], r["source"], r["n_tokens"], tuple(r["ids"]), r["ids_sha256"], r["decoded_sha256"]) for r in staged[4])
    assert got == want


def test_run_equals_the_stages(spark, sf, staged):
    names = ("doc_id", "source", "n_tokens", "ids_sha256")
    assert counted((r.asDict() for r in corpus_pipeline.run(spark, sf).collect()), names) == counted(staged[4], names)


ODD = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, n_lines int, _key int, taken string, cls string"


def test_odd_tables(spark, tmp_path):
    """Nulls, repeated rows and ids, clashing columns, very long texts, no rows."""
    prose = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(i, prose(i), "en", "s" if i % 3 else None, 1, "k", 7, 8, "t", "c") for i in range(30)]
    rows += [(1, prose(1), "en", "s", 1, "k", 7, 8, "t", "c")] * 2  # repeats of a row
    rows += [(1, prose(40), "en", "s", 1, None, None, None, None, None)]  # an id with another text
    rows += [(None, prose(50), None, None, None, None, None, None, None, None), (60, None, "en", "s", 0, "k", 7, 8, "t", "c"), (61, "", "en", "s", 0, "k", 7, 8, "t", "c")]
    rows += [(70, " ".join(f"z{i}" for i in range(50_000)), "en", "long", 1, "k", 7, 8, "t", "c")]
    columns = [f.split()[0] for f in ODD.split(", ")]
    for docs, n in ((spark.createDataFrame(rows, ODD), 33), (spark.createDataFrame([], ODD), 0)):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, "").write.parquet(f"{tmp_path}/{n}-{k}")
            docs = spark.read.parquet(f"{tmp_path}/{n}-{k}")
            if k < 4:
                assert docs.columns == columns, name
            if k == 2:
                assert docs.count() == n
                assert all(r.kept in ("k", None) and r._key in (8, None) for r in docs.collect())
        assert (docs.count() > 0) == (n > 0)


def test_near_stage_takes_rows_that_no_stage_before_would_give(spark):
    rows = [(3, None, "s"), (3, None, "s"), (4, "", "s"), (5, "a b c", "s"), (5, "a b c", "s"), (6, "A B C", "s"), (None, "a b c", "s")]
    out = corpus_pipeline.keep_first_of_near(spark, spark.createDataFrame(rows, "doc_id int, text string, source string"), "")
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter({(3, None): 2, (4, ""): 1, (5, "a b c"): 1})


def test_sql_of_the_queries_names_their_columns(sf, spark):
    con = duckdb.connect()
    for table in ("documents", "pages", "labels", "embeddings"):
        con.register(table, pa.table(pq.read_table(f"{sf}/{table}.parquet")))
    for name, sql in queries.ORACLE.items():
        assert sorted(d[0] for d in con.execute(sql).description) == sorted(queries.QUERIES[name](spark, sf).columns)
