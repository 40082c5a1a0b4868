"""Quality rules from repetition: how much of a text stands in n-grams and lines that recur.

Rolling hashes of several n-gram lengths mark every window of words that is found twice or more in
its text. Windows overlap, so each word counts once however many marked windows hold it, and its
characters are summed into the coverage of that length.

Defined results: a null or empty text has no words, all measures 0, and fails the base rule. Equal
rows are judged alike, whatever stands beside them; input columns of the same name as a measure are
replaced. Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import words as W

#: Share of a text's word characters that may stand in repeated n-grams of each length.
COVERAGE = {5: 0.25, 10: 0.20, 20: 0.15}
#: Share of a text's word characters that may stand in lines equal to an earlier line.
LINES = 0.30
BASE_LENGTH = 5
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars")


def _sums(text: np.ndarray, values: np.ndarray | None, n: int) -> np.ndarray:
    if values is None:
        return np.bincount(text, minlength=n)
    up = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=up[1:])
    edges = np.searchsorted(text, np.arange(n + 1))
    return up[edges[1:]] - up[edges[:-1]]


def measure(data: np.ndarray, offsets: np.ndarray, lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    """The measures of the texts of one slice."""
    n = len(offsets) - 1
    starts, ends, text = W.spans(~W.SPACE[data], offsets)
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
    size = chars[ends] - chars[starts]
    symbol = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_SYMBOL[data], out=symbol[1:])
    out = {"n_words": _sums(text, None, n), "word_chars": _sums(text, size, n)}
    out["n_symbols"] = symbol[offsets[1:]] - symbol[offsets[:-1]]

    line_start, line_end, line_text = W.spans(data != 10, offsets)
    first, last = np.searchsorted(starts, line_start), np.searchsorted(starts, line_end)
    worded = last > first
    line_start, line_end, line_text, first, last = (x[worded] for x in (line_start, line_end, line_text, first, last))
    again = W.later(W.hashes(data, line_start, line_end), line_text)
    total = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=total[1:])
    out["n_dup_lines"] = _sums(line_text, again, n)
    out["dup_line_chars"] = _sums(line_text, np.where(again, total[last] - total[first], 0), n)

    hashed = W.hashes(data, starts, ends)
    for k in lengths:
        keys, at = W.windows(hashed, text, k)
        at = at[W.twice(keys, text[at])]
        edges = np.zeros(len(hashed) + 1, np.int64)
        np.add.at(edges, at, 1)
        np.add.at(edges, at + k, -1)
        covered = np.cumsum(edges)[:-1] > 0
        if k == BASE_LENGTH:
            out["n_repeat_words"] = _sums(text, covered, n)
        out[f"repeat_chars_{k}"] = _sums(text, np.where(covered, size, 0), n)
    return out


def repetition(df: DataFrame, text: str = "text", coverage: Mapping[int, float] = COVERAGE) -> DataFrame:
    """Add the counts and, for each n-gram length, the characters inside repeated n-grams."""
    lengths = tuple(sorted({BASE_LENGTH, *coverage}))
    names = [*COUNTS, *[f"repeat_chars_{k}" for k in lengths]]
    kept = df.drop(*names)
    schema = T.StructType([*kept.schema.fields, *[T.StructField(c, T.LongType()) for c in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [measure(d, o, lengths) for _, _, d, o in W.slices(batch.column(text))]
            if parts:
                found = [pa.array(np.concatenate([p[c] for p in parts]), pa.int64()) for c in names]
                yield pa.RecordBatch.from_arrays([*batch.columns, *found], [*batch.schema.names, *names])

    W.narrow(df.sparkSession)
    return kept.mapInArrow(run, schema)


def base_failed() -> Column:
    """Fewer than ten words, or over a fifth of them in repeated windows of five."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def passes(coverage: Mapping[int, float] = COVERAGE, lines: float = LINES) -> Column:
    """The verdict of the method: no length covers more than its share, nor do repeated lines."""
    ok = F.col("dup_line_chars") <= lines * F.col("word_chars")
    for k, share in coverage.items():
        ok = ok & (F.col(f"repeat_chars_{k}") <= share * F.col("word_chars"))
    return ok


def judge(df: DataFrame, text: str = "text", coverage: Mapping[int, float] = COVERAGE, lines: float = LINES) -> DataFrame:
    """All measures with ``base_failed`` and ``kept``."""
    return repetition(df, text, coverage).withColumns({"base_failed": base_failed(), "kept": ~base_failed() & passes(coverage, lines)})
