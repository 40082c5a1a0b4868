"""BPE encoding and decoding of whole texts with a compiled automaton.

The driver compiles the merges once and broadcasts the automaton; its size is bounded by the
vocabulary. Texts are split into words as the model's file says (its special strings first, then NFC
and lower case letter by letter) and every word is read by the automaton's transitions. Words recur, so
each task keeps the tokens of words it has read in a table of bounded size.

Defined results: a null or empty text has no tokens and decodes to the empty text. Texts and words of
any length are read whole. Other columns pass through; those named like a result are replaced.
"""

from __future__ import annotations

import hashlib
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.llm import vocab as V
from tidemark.llm import words as W
from tidemark.llm.automaton import Automaton

#: The pattern by which the model's file splits a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPLIT = regex.compile(PATTERN)
_PLAIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)
#: Words kept with their tokens (as many again from before the table was last full), and the longest kept.
KEPT, LONGEST = 400_000, 64

OUTPUTS = {
    "ids": T.ArrayType(T.IntegerType()),
    "n_tokens": T.LongType(),
    "ids_sha256": T.StringType(),
    "decoded": T.StringType(),
    "decoded_sha256": T.StringType(),
}


#: Capitals that this Python's tables lack, first and last, with the first's small letter.
_NEWER = ((0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x19B), (0x10D50, 0x10D65, 0x10D70), (0xA7CE, 0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2, 0xA7D3), (0xA7D4, 0xA7D4, 0xA7D5), (0x16EA0, 0x16EB8, 0x16EBB))
_CAPITALS = {c: small + c - first for first, last, small in _NEWER for c in range(first, last + 1)}
#: A capital sigma at a word's end is lowered as any other.
_SINGLY = re.compile("[Σ" + "".join(map(chr, _CAPITALS)) + "]")


def lowered(text: str) -> str:
    """Lower case letter by letter."""
    if _SINGLY.search(text):
        text = text.replace("Σ", "σ").translate(_CAPITALS)
    return text.lower()


#: Letters and digits of Unicode 16, which the model's pattern has and this Python may lack.
_SIXTEEN = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x116D0, 0x116E3), (0x11BC0, 0x11BE0), (0x11BF0, 0x11BF9), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16130, 0x16139), (0x16D40, 0x16D6C),
    (0x16D70, 0x16D79), (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5FA),
)


@lru_cache(maxsize=1)
def newer_letters() -> str:
    """A class of the code points that are letters or digits in the regex module only, as its tables are newer."""
    sixteen = {c for a, b in _SIXTEEN for c in range(a, b + 1)}
    known = regex.compile(r"[\p{L}\p{N}]")
    newer = [c for c in range(0x80, 0x110000) if unicodedata.category(chr(c)) == "Cn" and c not in sixteen and known.match(chr(c))]
    runs = _runs(newer)
    return "[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in runs) + "]" if runs else r"(?!)"


def _runs(points: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for c in points:
        if out and out[-1][1] == c - 1:
            out[-1] = (out[-1][0], c)
        else:
            out.append((c, c))
    return out


def split(text: str, newer: re.Pattern) -> list[str]:
    if text.isascii():
        return _PLAIN.findall(text.lower())
    text = lowered(unicodedata.normalize("NFC", text))
    if not newer.search(text):
        return _SPLIT.findall(text)
    # Such a point is neither letter nor digit to the model, so it is split like the unassigned U+0378.
    return [text[m.start() : m.end()] for m in _SPLIT.finditer(newer.sub("\u0378", text))]


class Words(dict):
    """Packed tokens of words, made when first asked for."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton, self.older = automaton, {}

    def __missing__(self, word: str) -> bytes:
        made = self.older.get(word)
        if made is None:
            ids = self.automaton.encode(word.encode())
            made = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= LONGEST:
            if len(self) >= KEPT:
                self.older = dict(self)
                self.clear()
            self[word] = made
        return made


class Codec:
    """Encodes and decodes texts with one automaton."""

    def __init__(self, automaton: Automaton, special: dict[str, int], newer: str):
        self.automaton, self.words, self.newer = automaton, Words(automaton), re.compile(newer)
        self.special = {s: np.array([i], "<u4").tobytes() for s, i in special.items()}
        self.names = {i: s for s, i in special.items()}
        by_length = sorted(special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, by_length)) + ")") if special else None

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.cut is None or not self.cut.search(text):
            return self._plain(text)
        return b"".join([self.special.get(part) or self._plain(part) for part in self.cut.split(text)])

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, split(text, self.newer)))

    def decode(self, packed: bytes) -> str:
        """Labels joined by a space, as the model's file names no other decoder."""
        ids = np.frombuffer(packed, "<u4").tolist()
        special = self.names if self.names and any(i in self.names for i in ids) else {}
        return " ".join(self.automaton.decode(ids, special))


@lru_cache(maxsize=4)
def compiled(path: str) -> tuple[Automaton, dict[str, int], str]:
    read = V.load(path)
    return Automaton(read), read.special, newer_letters()


_codecs: dict[int, Codec] = {}


def codec(model: Broadcast) -> Codec:
    """The task's codec; a worker process makes it once for each broadcast."""
    if id(model.value) not in _codecs:
        _codecs.clear()
        _codecs[id(model.value)] = Codec(*model.value)
    return _codecs[id(model.value)]


def share(spark: SparkSession, path: str) -> Broadcast:
    return spark.sparkContext.broadcast(compiled(path))


def _column(name: str, packed: list[bytes], own: Codec) -> pa.Array:
    if name == "ids":
        offsets = np.zeros(len(packed) + 1, np.int32)
        np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
        values = pa.array(np.frombuffer(b"".join(packed), "<u4").astype(np.int32))
        return pa.ListArray.from_arrays(pa.array(offsets), values)
    if name == "n_tokens":
        return pa.array([len(p) // 4 for p in packed], pa.int64())
    if name == "ids_sha256":
        return pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string())
    if name == "decoded":
        return pa.array([own.decode(p) for p in packed], pa.string())
    return pa.array([hashlib.sha256(own.decode(p).encode()).hexdigest() for p in packed], pa.string())


def tokenize(df: DataFrame, path: str, text: str = "text", outputs: tuple[str, ...] = ("ids", "n_tokens")) -> DataFrame:
    """Encode ``text`` and add the chosen ``OUTPUTS``; ``decoded`` is what the ids decode to."""
    kept = df.drop(*[c for c in outputs if c != text])
    schema = T.StructType([*kept.schema.fields, *[T.StructField(c, OUTPUTS[c]) for c in outputs]])
    model = share(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            packed = [own.encode(t) for t in V.texts(batch.column(text))]
            made = [_column(c, packed, own) for c in outputs]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *outputs])

    W.narrow(df.sparkSession)
    return kept.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text that an array of ids decodes to; a null array decodes to the empty text."""
    kept = df.drop(text)
    schema = T.StructType([*kept.schema.fields, T.StructField(text, T.StringType())])
    model = share(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            rows = (np.array(row or [], "<u4").tobytes() for row in batch.column(ids).to_pylist())
            made = pa.array([own.decode(p) for p in rows], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, text])

    W.narrow(df.sparkSession)
    return kept.mapInArrow(run, schema)
