"""Line dedup: lines that stand in many documents go from all of them.

Lines are exploded once, as a 128-bit hash of their key with document and position, and written; no
text is shuffled for the counts. A document counts once for a key: (key, document) is made distinct
first, which deals a hot key by document, and the counts are combined on the map side. The frequent
keys meet the exploded positions in a semi-join, which adaptive execution splits where a key is hot.
Only the positions to drop go back to their document, where the other lines are joined in order.

Defined results: a null or empty text is one empty line, and its kept text is empty. An empty key is
shorter than ``least`` and stays. Rows with one id are one document: their keys count once, each
keeps its own lines. Rows without an id are one document for each text. Other columns pass through; those named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import durable

WHITE = " \t\n\x0b\x0c\r"
UPPER, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RESULT = ("n_lines", "n_dropped", "kept_text")


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(WHITE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOW))


def places(df: DataFrame, text: str, doc: str, least: int) -> DataFrame:
    """``_doc, _sum, _pos, a, b`` for every line whose key is long enough.

    Rows are known by id and content, which also holds apart rows that share an id; the key by two
    64-bit hashes.
    """
    keys = F.transform(lines_of(F.col(text)), key)
    lines = df.select(F.col(doc).alias("_doc"), _sum(text).alias("_sum"), F.posexplode(keys).alias("_pos", "_key"))
    k = F.col("_key")
    return lines.where(F.char_length(k) >= least).select(
        "_doc", "_sum", "_pos", F.xxhash64(k).alias("a"), F.xxhash64(F.lit(1), k, F.lit(2)).alias("b")
    )


def _sum(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def frequent(held: DataFrame, documents: int) -> DataFrame:
    """Hashes ``a, b`` of the keys that at least ``documents`` documents hold."""
    own = F.when(F.col("_doc").isNull(), F.col("_sum")).alias("_own")
    once = held.select("a", "b", "_doc", own).distinct()
    return once.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= documents).select("a", "b")


def drop_lines(df: DataFrame, text: str = "text", doc: str = "doc_id", least: int = 1, documents: int = 10) -> DataFrame:
    """Add ``n_lines``, ``n_dropped`` and ``kept_text``; one row for each input row."""
    given = df.drop(*RESULT)
    # Under names of its own no input column can clash with what is made here.
    names = {c: f"_c{i}" for i, c in enumerate(given.columns)}
    rows, text, doc = given.toDF(*names.values()), names[text], names[doc]
    held = durable(places(rows, text, doc, least))
    gone = held.join(frequent(held, documents), ["a", "b"], "left_semi")
    per_row = gone.groupBy("_doc", "_sum").agg(F.sort_array(F.collect_set("_pos")).alias("_gone"))
    marked = rows.withColumns({"_mark": F.col(doc), "_check": _sum(text), "_text": F.col(text)})
    same = F.col("_mark").eqNullSafe(F.col("_doc")) & (F.col("_check") == F.col("_sum"))
    made = marked.join(per_row, same, "left").withColumns(_rebuilt(lines_of(F.col("_text"))))
    return made.select(*[F.col(own).alias(c) for c, own in names.items()], *RESULT)


def _rebuilt(lines: Column) -> dict[str, Column]:
    gone = F.coalesce(F.col("_gone"), F.array().cast("array<int>"))
    # One flag for each line up to the last dropped one, built from the gaps between dropped lines.
    before = F.concat(F.array(F.lit(-1)), gone)
    gaps = F.transform(gone, lambda p, i: F.array_repeat(F.lit(True), p - F.get(before, i) - 1))
    flags = F.flatten(F.transform(gaps, lambda g: F.concat(g, F.array(F.lit(False)))))
    # Lines and flags stand in a struct, so that they are made once for a row, not once for a line.
    made = F.array(F.struct(lines.alias("lines"), flags.alias("flags")))
    kept = F.transform(
        made,
        lambda m: F.array_join(F.filter(m["lines"], lambda x, i: F.coalesce(F.get(m["flags"], i), F.lit(True))), "\n"),
    )
    return {
        "n_lines": F.size(lines).cast("bigint"),
        "n_dropped": F.size(gone).cast("bigint"),
        "kept_text": F.when(F.size(gone) == 0, F.coalesce(F.col("_text"), F.lit(""))).otherwise(kept[0]),
    }
