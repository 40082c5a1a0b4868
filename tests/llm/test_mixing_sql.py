"""The mix and its SQL on tables whose smallest target has few and many blocks."""

import random

import pytest
from pyspark.sql import functions as F

from tests import oracle
from tidemark.llm import mixing, queries

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def table(spark, folder, sizes, seed=1):
    """Documents of the given words a source, in texts of 1 to 400 words."""
    draw, rows = random.Random(seed), []
    for source, left in sizes.items():
        while left > 0:
            n = min(left, draw.choice([1, 3, 20, 100, 400]))
            rows.append((len(rows), " ".join(["w"] * n), "en", source, 0))
            left -= n
    rows += [(len(rows), None, "en", None, 0), (len(rows) + 1, " \n", "en", "empty", 0)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def duck(folder):
    con = oracle.duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    return con


@pytest.mark.parametrize("blocks", [1, 99, 101, 10_000])
def test_query_equals_sql(spark, tmp_path, blocks):
    small = -(-blocks * mixing.FINE // 3)
    folder = table(spark, tmp_path, {"a": 120_000, "b": 90_000, "c": small, None: 4_000 if small > 100 else 0})
    assert oracle.compare(spark, duck(folder), queries.op3, queries.OP3_SQL, folder) is None


@pytest.mark.parametrize("small", [50, 3_600, 3_800, 11_000, 11_400])
def test_every_source_near_its_target(spark, tmp_path, small):
    folder = table(spark, tmp_path, {"a": 200_000, "b": 200_000, "c": small, "d": 0})
    found = queries.op3(spark, folder).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"))
    for row in found.collect():
        assert abs(row.taken - row.target) <= 0.01 * row.target + 3


def test_only_empty_texts(spark, tmp_path):
    folder = table(spark, tmp_path, {})
    assert oracle.compare(spark, duck(folder), queries.op3, queries.OP3_SQL, folder) is None
    assert {r.taken for r in queries.op3(spark, folder).collect()} == {0}
