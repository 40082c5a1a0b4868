"""Filter interaction audit: what each filter removes, in every order, from one table of counts.

Every document is reduced to the set of filters it fails, and the documents of a part to a 2x2x2x2x2
tensor of counts, one axis a filter. Whatever an order of the filters does at a step is a contraction
of that tensor which takes pass, fail or both along each axis, so all orders need one pass over the
texts. Two more tensors count the documents labelled good and toxic.

Filters (words are runs of bytes other than ``[\\x20\\x09-\\x0D]``): A fewer than 50 words; B fewer than
65 % of the words distinct; C more than 5 % of the code points in A-Z; D one of ``#$%&*|``; E the text
of a smaller id.

Defined results: a null text is the empty text, a null part the empty string. Labels of one id are
joined: it is good or toxic if one of its rows says so; ids without a row are neither. Rows that share
an id are separate documents, none of which is smaller than another; a null id is neither smaller nor
larger than any id and has no labels. Texts of any length are read whole, in windows. An empty table
has no parts. Columns are chosen by name, so others don't matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.session import durable

FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT_SHARE, UPPER_SHARE = 50, 65, 5
#: Bytes of one text whose words are split at once.
WINDOW = 1 << 20
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_MARKS = b"#$%&*|"
_LATER = bytes(range(0x80, 0xC0))
_GAP = re.compile(rb"[\x20\x09-\x0d]")
ORDERS = ["".join(p) for p in permutations(FILTERS)]
OUT = "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"


def count_words(text: bytes, window: int = WINDOW) -> tuple[int, int]:
    """Words and distinct words."""
    n, seen, at = 0, set(), 0
    while at < len(text):
        gap = _GAP.search(text, at + window) if at + window < len(text) else None
        end = gap.start() if gap else len(text)
        found = text[at:end].split()
        n += len(found)
        seen.update(found)
        at = end
    return n, len(seen)


def failed(text: bytes) -> int:
    """The filters A to D that a text fails; A is the highest of four bits."""
    n, distinct = count_words(text)
    points = len(text.translate(None, _LATER))
    upper = len(text) - len(text.translate(None, _UPPER))
    marked = len(text.translate(None, _MARKS)) < len(text)
    return 8 * (n < LEAST_WORDS) + 4 * (100 * distinct < DISTINCT_SHARE * n) + 2 * (100 * upper > UPPER_SHARE * points) + marked


def marks(df: DataFrame, doc: str, text: str, part: str) -> DataFrame:
    """``doc, part, failed, cls`` of every row; ``cls`` is a 128-bit digest of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, digests = [], []
            for _, _, data, offsets in W.slices(batch.column("t")):
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    own = data[a:b].tobytes()
                    bits.append(failed(own))
                    digests.append(hashlib.blake2b(own, digest_size=16).digest())
            found = [pa.array(bits, pa.int32()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("part"), *found], ["doc", "part", "failed", "cls"])

    W.narrow(df.sparkSession)
    kind = df.schema[doc].dataType.simpleString()
    named = df.select(F.col(doc).alias("doc"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("t"))
    return named.mapInArrow(run, f"doc {kind}, part string, failed int, cls binary")


def cells(df: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``part, cell, n, good, toxic``: documents of a part by the filters they fail (A is the highest of five bits).

    Rows are counted before every shuffle. Only the least id of a text is looked up again, so copies
    are a row for each part and label, however many there are.
    """
    alike = marks(df, doc, text, part).groupBy("doc", "part", "failed", "cls").agg(F.count(F.lit(1)).alias("n"))
    known = labels.where(F.col(doc).isNotNull()).groupBy(F.col(doc).alias("doc"))
    said = lambda name: F.max(F.coalesce(F.col(name) == 1, F.lit(False))).alias(name)
    labelled = alike.join(known.agg(said("quality"), said("toxic")), "doc", "left").na.fill(False, ["quality", "toxic"])
    # Of a group, the documents of its least id, all documents, and those without an id.
    groups = durable(
        labelled.groupBy("cls", "part", "failed", "quality", "toxic").agg(
            F.min(F.when(F.col("doc").isNotNull(), F.struct("doc", "n"))).alias("least"),
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("doc").isNull(), F.col("n")).otherwise(0)).alias("without"),
        )
    )
    several = groups.groupBy("cls").agg(F.min("least.doc").alias("first"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    first = F.coalesce(F.col("first") == F.col("least.doc"), F.col("first").isNull())
    passing = F.col("without") + F.when(F.col("least").isNotNull() & first, F.col("least.n")).otherwise(0)
    split = groups.join(several, "cls", "left").select(
        "part", "quality", "toxic", F.inline(F.array(F.struct((2 * F.col("failed")).alias("cell"), passing.alias("m")), F.struct((2 * F.col("failed") + 1).alias("cell"), (F.col("n") - passing).alias("m"))))
    )
    total = lambda on: F.sum(F.when(F.col(on), F.col("m")).otherwise(0))
    return split.where("m > 0").groupBy("part", "cell").agg(F.sum("m").alias("n"), total("quality").alias("good"), total("toxic").alias("toxic"))


@lru_cache(maxsize=1)
def selections() -> tuple[np.ndarray, dict[str, int], dict[tuple[str, int], tuple[int, int, int]]]:
    """Weights of pass and fail along each axis for every contraction, where the named ones stand, and the steps.

    A step of an order is its (kept, removed, filter); orders that agree up to a step share contractions.
    """
    take, rows, at = {"pass": (1, 0), "fail": (0, 1), "all": (1, 1)}, [], {}

    def number(choice: dict[str, str]) -> int:
        name = " ".join(choice.get(f, "all") for f in FILTERS)
        if name not in at:
            at[name] = len(rows)
            rows.append([take[c] for c in name.split()])
        return at[name]

    steps = {}
    for order in ORDERS:
        for k, f in enumerate(order):
            before = dict.fromkeys(order[:k], "pass")
            steps[order, k + 1] = (number({**before, f: "pass"}), number({**before, f: "fail"}), FILTERS.index(f))
    named = {f"fails {f}": number({f: "fail"}) for f in FILTERS}
    named |= {f"only {f}": number(dict.fromkeys(FILTERS, "pass") | {f: "fail"}) for f in FILTERS}
    return np.array(rows, np.int64), named, steps


def contract(tensors: np.ndarray) -> dict[str, np.ndarray]:
    """All measures of parts by step of ``ORDERS``, from ``(3, parts, 2, 2, 2, 2, 2)`` counts of all, good and toxic."""
    chosen, named, steps = selections()
    axes = [chosen[:, k] for k in range(len(FILTERS))]
    n, good, toxic = np.einsum("mpabcde,ka,kb,kc,kd,ke->mpk", tensors, *axes, optimize=True)
    kept, removed, own = (np.array(x) for x in zip(*steps.values()))
    fails = n[:, [named[f"fails {f}"] for f in FILTERS]]
    only = n[:, [named[f"only {f}"] for f in FILTERS]]
    shapley = np.stack([n[:, removed[own == f]].sum(1) for f in range(len(FILTERS))], 1)
    return {
        "kept": n[:, kept],
        "removed": n[:, removed],
        "redundant": fails[:, own] - n[:, removed],
        "unique_fails": only[:, own],
        "good_lost": good[:, removed],
        "toxic_lost": toxic[:, removed],
        "shapley": shapley[:, own],
    }


def audit(df: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """A row for every part, order and step; see ``OUT``."""
    names = [c.split()[0] for c in OUT.split(", ")]
    steps = selections()[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, size = batch.num_rows, 1 << len(FILTERS)
            if not p:
                continue
            held = batch.column("held")
            flat = held.flatten()
            row = np.repeat(np.arange(p), held.value_lengths().to_numpy(zero_copy_only=False))
            cell = flat.field("cell").to_numpy(zero_copy_only=False)
            tensors = np.zeros((3, p, size), np.int64)
            for m, name in enumerate(("n", "good", "toxic")):
                tensors[m, row, cell] = flat.field(name).to_numpy(zero_copy_only=False)
            found = contract(tensors.reshape(3, p, *[2] * len(FILTERS)))
            parts = batch.column("part").take(pa.array(np.repeat(np.arange(p), len(steps))))
            orders = pa.array([o for o, _ in steps] * p, pa.string())
            places = pa.array([k for _, k in steps] * p, pa.int32())
            yield pa.RecordBatch.from_arrays([parts, orders, places, *[pa.array(found[c].ravel(), pa.int64()) for c in names[3:]]], names)

    counted = cells(df, labels, doc, text, part)
    held = counted.groupBy("part").agg(F.collect_list(F.struct("cell", "n", "good", "toxic")).alias("held"))
    return held.mapInArrow(run, OUT)
