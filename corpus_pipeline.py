"""A training corpus from documents: quality rules, line dedup, near-dedup, source mixing, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written and read again as
the next one's ``docs``. All but the last return the columns they were given, whatever their names. Rows
are known by id and content, so rows that share an id are separate documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import bpe, lines, mixing, neardup, quality
from tidemark.session import shared_folder

VOCABULARY = "word_bpe_49k.json"
#: Similarity, in percent, from which documents are near duplicates.
NEAR = 80
#: One stage can't be told in SQL (the last one); a brute-force version checks all of them.
ORACLE_SQL = None


def _apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The columns under names that no operator uses, and these by the given name."""
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _back(df: DataFrame, names: dict[str, str], **replaced) -> DataFrame:
    return df.select(*[replaced.get(c, F.col(own)).alias(c) for c, own in names.items()])


def _keyed(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rows by id and content; a missing id is larger than any other."""
    own = F.col(names["doc_id"])
    return docs.withColumn("_key", F.struct(own.isNull().alias("missing"), own.alias("id"), F.xxhash64(*names.values()).alias("content")))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    own, names = _apart(docs)
    return _back(quality.judge(own, names["text"]).where("kept"), names)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of ten documents or more go from all texts; a null text stays null."""
    own, names = _apart(docs)
    out = lines.drop_lines(_keyed(own, names), names["text"], "_key")
    text = F.when(F.col(names["text"]).isNotNull(), F.col("kept_text"))
    replaced = {"text": text}
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        replaced["n_chars"] = F.when(F.col("n_dropped") > 0, F.char_length(text).cast(kind)).otherwise(F.col(names["n_chars"]))
    return _back(out, names, **replaced)


def keep_first_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the one with the smallest id stays; empty texts are linked with nothing."""
    own, names = _apart(docs)
    own = _keyed(own, names)
    found = neardup.components_of(own, names["text"], "_key", NEAR).where("kept")
    kept = found.groupBy(F.col("doc_id.id").alias("_id"), F.col("doc_id.content").alias("_content")).agg(F.max("n_shingles").alias("_n"))
    same = F.col("_key.id").eqNullSafe(F.col("_id")) & (F.col("_key.content") == F.col("_content"))
    joined = own.join(kept, same)
    # Whole rows that repeat are copies of one another as well.
    nth = F.row_number().over(Window.partitionBy("_id", "_content").orderBy(F.lit(0)))
    return _back(joined.withColumn("_nth", nth).where((F.col("_nth") == 1) | (F.col("_n") == 0)), names)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes their words, a part to the nearer whole number."""
    own, names = _apart(docs)
    own = _keyed(own, names)
    mixed = mixing.mix(own, names["text"], "_key", names["source"]).where("taken > 0")
    times = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    # Whole rows that repeat share what they take.
    taken = mixed.select(F.col("doc_id.id").alias("_id"), F.col("doc_id.content").alias("_content"), times.alias("_times"))
    taken = taken.groupBy("_id", "_content").agg(F.sum("_times").cast("int").alias("_times")).where("_times > 0")
    same = F.col("_key.id").eqNullSafe(F.col("_id")) & (F.col("_key.content") == F.col("_content"))
    joined = own.join(taken, same)
    nth = F.row_number().over(Window.partitionBy("_id", "_content").orderBy(F.lit(0)))
    once = joined.withColumn("_nth", nth).where("_nth = 1")
    return _back(once.withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times")))), names)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and digests of the ids and of the text that they decode to."""
    slim = docs.select("doc_id", "source", "text")
    outputs = ("ids", "n_tokens", "ids_sha256", "decoded_sha256")
    return bpe.tokenize(slim, public_tokenizers.path(VOCABULARY), outputs=outputs).drop("text")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_quality),
    ("line_dedup", drop_common_lines),
    ("near_dedup", keep_first_of_near),
    ("source_mixing", mix_sources),
    ("bpe_codec", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_folder(spark, f"corpus-{uuid.uuid4().hex}")
    for k, (name, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.schema(made.schema).parquet(f"{folder}/{k}-{name}")
    return docs
