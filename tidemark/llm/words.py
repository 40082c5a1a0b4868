"""Words and rolling hashes of many texts at once, in numpy inside tasks.

A batch of texts is one byte array with offsets, as Arrow holds it. Words are runs of bytes other
than ``[\\x20\\x09-\\x0D]``; UTF-8 never uses these bytes inside a longer character. All hashes are
64 bits, modulo 2**64, from a fixed table of random numbers, so every task and rerun agrees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_RANDOM = np.random.Generator(np.random.PCG64(20))
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 2**64))
_STEP = np.uint64(0xD1342543DE82EF95)
#: Bytes of text that are worked on at once; a longer text is a slice of its own.
SLICE = 1 << 20

_powers: dict[str, np.ndarray] = {}


def narrow(spark: SparkSession, rows: int = 512) -> None:
    """Send at most ``rows`` texts to Python at once, so that very long texts don't meet in one batch."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the base and of its inverse."""
    if len(_powers.get("up", ())) < n:
        n = max(n, SLICE + 1)
        for name, base in (("up", _BASE), ("down", _BACK)):
            one = np.full(n, base, np.uint64)
            one[0] = 1
            _powers[name] = np.multiply.accumulate(one)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(column: pa.Array, most: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``first`` to ``last`` with their bytes and offsets; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every run of ``inside`` bytes; a run ends with its text."""
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    borders = offsets[(offsets > 0) & (offsets < len(inside))]
    begin[borders] = inside[borders]
    end[borders - 1] = inside[borders - 1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(offsets, starts, "right") - 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each byte range; equal ranges have equal hashes wherever they stand."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def windows(words: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of ``n`` words that lies in one text, and the window's first word."""
    if len(words) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    count = len(words) - n + 1
    rolled = words[:count].copy()
    for k in range(1, n):
        rolled *= _STEP
        rolled += words[k : k + count]
    at = np.flatnonzero(text[:count] == text[n - 1 :])
    return mix(rolled[at] + np.uint64(n)), at


def twice(keys: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Whether a key stands in the same text more than once."""
    if not len(keys):
        return np.zeros(0, bool)
    own = mix(keys + text.astype(np.uint64) * _BASE)
    order = np.argsort(own, kind="stable")
    ordered = own[order]
    same = ordered[1:] == ordered[:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def later(keys: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Whether a key equals an earlier one of the same text."""
    own = mix(keys + text.astype(np.uint64) * _BASE)
    order = np.argsort(own, kind="stable")
    out = np.zeros(len(keys), bool)
    out[order[1:]] = own[order][1:] == own[order][:-1]
    return out
