"""Token counts with whole tokens found by look-up.

Before the job, the driver merges every vocabulary string alone and keeps those that come out as one
token. In the tasks a pre-token in that table counts one without any merging; the others are merged
once and kept in a table of bounded size. Proof and merges are broadcast; the vocabulary bounds them.

Defined results: a null or empty text has no bytes and no tokens. A special string of the model's file
is one token wherever it stands. Texts and pre-tokens of any length are counted whole. Other columns
pass through; those named like a result are replaced.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import vocab as V
from tidemark.llm import words as W

#: The pattern of byte-level models.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPLIT = regex.compile(PATTERN)
_PLAIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
#: Pre-tokens kept with their count (as many again from before the table was last full), and the longest kept.
KEPT, LONGEST = 400_000, 64


def pieces(text: str) -> list[str]:
    return (_PLAIN if text.isascii() else _SPLIT).findall(text)


class Merges:
    """Ranks of pairs of ids, and the ids of single bytes."""

    def __init__(self, vocab: V.Vocab):
        self.pairs = {(a, b): (rank, made) for rank, (a, b, made) in enumerate(vocab.merges)}
        self.bytes = [vocab.ids[c] for c in V.byte_letters()]

    def merge(self, piece: bytes) -> list[int]:
        """Tokens by the lowest rank first, the leftmost of equals first."""
        ids, pairs = [self.bytes[b] for b in piece], self.pairs
        n = len(ids)
        if n <= LONGEST:
            return self._short(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(pairs[p][0], i, p) for i in range(n - 1) if (p := (ids[i], ids[i + 1])) in pairs]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if j >= n or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j] = pairs[pair][1], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for left, right in ((before[i], i), (i, k)):
                if left >= 0 and right < n and (p := (ids[left], ids[right])) in pairs:
                    heapq.heappush(heap, (pairs[p][0], left, p))
        return [t for t in ids if t >= 0]


    def _short(self, ids: list[int]) -> list[int]:
        get, none = self.pairs.get, (1 << 60, -1)
        ranks = [get(p, none) for p in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best is none:
                break
            i = ranks.index(best)
            ids[i : i + 2] = [best[1]]
            del ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), none)
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), none)
        return ids


def whole_tokens(vocab: V.Vocab, merges: Merges) -> set[str]:
    """Vocabulary strings that the merges turn into one token when they stand alone."""
    number = {c: b for b, c in enumerate(V.byte_letters())}
    out = set()
    for label in vocab.ids:
        piece = bytes(number[c] for c in label)
        if len(merges.merge(piece)) == 1:
            try:
                out.add(piece.decode())
            except UnicodeDecodeError:
                continue  # part of a letter, so never a pre-token
    return out


class Counts(dict):
    """Tokens of pre-tokens; the proven ones are there from the start."""

    def __init__(self, merges: Merges, whole: set[str]):
        super().__init__(dict.fromkeys(whole, 1))
        self.merges, self.whole, self.older = merges, whole, {}

    def __missing__(self, piece: str) -> int:
        n = self.older.get(piece) or len(self.merges.merge(piece.encode()))
        if len(piece) <= LONGEST:
            if len(self) >= KEPT + len(self.whole):
                self.older = dict(self)
                self.clear()
                self.update(dict.fromkeys(self.whole, 1))
            self[piece] = n
        return n


@lru_cache(maxsize=4)
def proven(path: str) -> tuple[Merges, set[str], list[str]]:
    vocab = V.load(path)
    if vocab.suffix:
        raise ValueError(f"{path}: not a byte-level model without word ends")
    merges = Merges(vocab)
    return merges, whole_tokens(vocab, merges), sorted(vocab.special, key=len, reverse=True)


_counters: dict[int, tuple[Counts, re.Pattern | None]] = {}


def counter(model: tuple[Merges, set[str], list[str]]) -> tuple[Counts, re.Pattern | None]:
    if id(model) not in _counters:
        merges, whole, special = model
        _counters.clear()
        _counters[id(model)] = Counts(merges, whole), re.compile("|".join(map(re.escape, special))) if special else None
    return _counters[id(model)]


def count(text: str, counts: Counts, special: re.Pattern | None) -> int:
    if special is None or not special.search(text):
        return sum(map(counts.__getitem__, pieces(text)))
    parts = special.split(text)
    return len(parts) - 1 + sum(counts[p] for part in parts for p in pieces(part))


def count_tokens(df: DataFrame, path: str, text: str = "text", limit: int = 512) -> DataFrame:
    """Add ``n_bytes``, ``n_tokens`` and ``over_limit``."""
    kept = df.drop("n_bytes", "n_tokens", "over_limit")
    schema = T.StructType([*kept.schema.fields, T.StructField("n_tokens", T.LongType())])
    model = df.sparkSession.sparkContext.broadcast(proven(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, special = counter(model.value)
        for batch in batches:
            found = pa.array([count(t, counts, special) for t in V.texts(batch.column(text))], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "n_tokens"])

    W.narrow(df.sparkSession)
    n_bytes = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("bigint")
    return kept.mapInArrow(run, schema).withColumns({"n_bytes": n_bytes, "over_limit": F.col("n_tokens") > limit})
