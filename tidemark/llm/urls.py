"""URL filter: rules by host and path, and a weighted vocabulary found with an Aho-Corasick automaton.

A rule fits its host and all subdomains where the path starts as the rule's does; the longest wins.
Other URLs are judged by their words: the automaton finds every term in one pass over the URL, and a
hit counts where no letter or digit touches it. Each distinct term counts once by its weight: a strict
term rejects alone, soft terms when several distinct ones are there.

Rules are expressions without a join, as there are few; they are literals of the plan, so their size
is the caller's. Defined results: a null URL or one without ``://`` has an empty host and path, so no
rule fits; a null URL has no terms. Equal URLs are judged alike. Other columns pass through; those
named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import vocab as V
from tidemark.llm import words as W

#: Terms that reject alone, and terms of which ``SOFT_LIMIT`` distinct ones reject.
STRICT = ("casino", "porn", "xxx", "viagra", "cialis", "sex", "escort", "malware", "phishing", "warez", "spam", "pills")
SOFT = (
    "free", "win", "bet", "bets", "cheap", "farm", "ads", "track", "promo", "bonus", "poker", "slots", "loan", "loans",
    "adult", "cams", "dating", "torrent", "crack", "keygen", "replica", "discount", "offer", "deal", "click", "popup",
)
SOFT_LIMIT = 2
ALLOW, BLOCK = "allow", "block"
UPPER, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> dict[str, Column]:
    """Host, A-Z in lower case, and path of the text behind the first ``://``."""
    known = F.coalesce(url, F.lit(""))
    at = F.instr(known, "://")
    rest = F.when(at > 0, F.substring(known, at + 3, F.char_length(known))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.char_length(host) + 1, F.char_length(rest)), r"(?s)^[^?#]*", 0)
    return {"host": F.translate(host, UPPER, LOW), "path": path}


def longest_rule(rules: Sequence[tuple[str, str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest of ``(verdict, host, path)`` that fits, null without one."""
    name = verdict = F.lit(None).cast("string")
    # Later conditions of the chain are tried only where the earlier don't hold, so the longest come last here.
    for kind, own, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        name, verdict = F.when(fits, F.lit(own + start)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def finder(weights: Mapping[str, int]) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for term, weight in weights.items():
        machine.add_word(term, (term, weight))
    machine.make_automaton()
    return machine


def weigh(url: str, machine: ahocorasick.Automaton) -> tuple[int, list[str]]:
    """Summed weight of the distinct terms that stand alone, and the terms."""
    url = url.lower()
    found = {}
    for end, (term, weight) in machine.iter(url):
        first = end - len(term) + 1
        if (first and url[first - 1].isalnum()) or (end + 1 < len(url) and url[end + 1].isalnum()):
            continue
        found[term] = weight
    return sum(found.values()), sorted(found)


def judge(
    df: DataFrame,
    rules: Sequence[tuple[str, str, str]] = (),
    url: str = "url",
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """Add ``host, path, rule, terms, weight, verdict``."""
    kept = df.drop("host", "path", "rule", "terms", "weight", "verdict")
    weights = {**dict.fromkeys(soft, 1), **dict.fromkeys(strict, soft_limit)}
    added = [T.StructField("weight", T.IntegerType()), T.StructField("terms", T.ArrayType(T.StringType()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = finder(weights) if weights else None
        for batch in batches:
            found = [weigh(u, machine) if machine else (0, []) for u in V.texts(batch.column(url))]
            made = [pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, "weight", "terms"])

    W.narrow(df.sparkSession, 4096)
    weighed = kept.mapInArrow(run, T.StructType([*kept.schema.fields, *added])).withColumns(parts(F.col(url)))
    name, verdict = longest_rule(rules, F.col("host"), F.col("path"))
    by_words = F.when(F.col("weight") >= soft_limit, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return weighed.withColumns({"rule": name, "verdict": F.coalesce(verdict, by_words)})
