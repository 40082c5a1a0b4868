"""MinHash near-dedup with sequential Bayesian verification.

Documents are sets of word shingles. One pass over the texts gives each its set's size, a 128-bit
digest and a MinHash signature. Equal sets become one class, so copies cost a row each and no pairs.
Classes that agree in a band of the signature are candidates. Their signatures are compared batch by
batch: after each, the posterior of the similarity given the matches so far decides, and a pair goes
once the probability that it reaches the threshold is below the miss probability. Survivors are
confirmed on their full sets.

A large bucket never emits all its pairs. First every member meets the bucket's pivot, the member with
the most neighbours, which joins most of a group of copies. Members still apart meet in a bucket of at
most ``FEW``; in a larger one only those that share enough of what sets them apart from the center of a
component, by a bound that loses no link (``around_pivots``).

Defined results: null texts and texts without words have the empty set, size 0, and are linked with
nothing. A text with fewer words than a shingle is one shingle. Rows that share an id are separate
documents. Components carry the smallest id; a null id never is one unless all are null. Columns are
chosen by name, so others don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.components import components
from tidemark.session import durable

WORDS = 5
#: Length of a signature, hashes of a batch, and the miss probability of bands and of each decision.
HASHES, BATCH, MISS = 252, 28, 1e-5
#: Bits of a parity: how often a set falls on each, modulo two.
BITS = 512
#: Members of a bucket whose pairs are compared as they are, which is linear in the bucket rows.
FEW = 8
_FACTORS = np.random.Generator(np.random.PCG64(4)).integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass(frozen=True)
class Banding:
    rows: int
    bands: int


def banding(percent: int, hashes: int = HASHES, miss: float = MISS) -> Banding:
    """The longest bands by which a pair at the threshold is missed with at most ``miss``."""
    s = percent / 100
    fit = [r for r in range(1, hashes + 1) if (1 - s**r) ** (hashes // r) <= miss]
    rows = max(fit, default=1)
    return Banding(rows, hashes // rows)


@lru_cache(maxsize=16)
def needed(percent: int, hashes: int = HASHES, batch: int = BATCH, miss: float = MISS) -> tuple[int, ...]:
    """Matches needed after each batch to go on.

    With a uniform prior the posterior after m matches in n is Beta(m + 1, n - m + 1); its mass from
    the threshold on is the chance of at most m successes in n + 1 draws at the threshold.
    """
    s, out = percent / 100, []
    for n in range(batch, hashes + 1, batch):
        mass, m = 0.0, -1
        while mass < miss:
            m += 1
            mass += comb(n + 1, m) * s**m * (1 - s) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def shingles(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, with the number of their text."""
    low = W.LOWER[data]
    starts, ends, text = W.spans(~W.SPACE[low], offsets)
    hashed = W.hashes(low, starts, ends)
    keys, at = W.windows(hashed, text, words)
    all_keys, all_text = [keys], [text[at]]
    count = np.bincount(text, minlength=len(offsets) - 1)
    for n in range(1, words):
        if (count == n).any():
            keys, at = W.windows(hashed, text, n)
            whole = count[text[at]] == n
            all_keys.append(keys[whole])
            all_text.append(text[at][whole])
    keys, text = np.concatenate(all_keys), np.concatenate(all_text)
    order = np.lexsort((keys, text))
    keys, text = keys[order], text[order]
    first = np.ones(len(keys), bool)
    first[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
    return keys[first], text[first]


def minhash(keys: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Signatures of the sets that begin at ``edges``; none is empty."""
    out = np.empty((len(edges), HASHES), "<u4")
    room = np.empty(len(keys), np.uint64)
    for j, factor in enumerate(_FACTORS):
        shuffled = np.multiply(keys, factor, out=room)
        shuffled >>= np.uint64(32)
        out[:, j] = np.minimum.reduceat(shuffled, edges)
    return out


def parities(keys: np.ndarray, own: np.ndarray, n: int) -> np.ndarray:
    """``BITS`` parities of each of ``n`` sets, as longs.

    The parities of two sets differ in no more bits than the sets differ in elements.
    """
    place = (keys * _FACTORS[0] >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64)
    odd = np.bincount(own * BITS + place, minlength=n * BITS).reshape(n, BITS) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view("<i8")


def marks(df: DataFrame, text: str, doc: str) -> DataFrame:
    """``doc_id, n, cls, sig`` of every row; digest and signature are null for the empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in W.slices(batch.column("t"), 1 << 19):
                keys, own = shingles(data, offsets)
                n = np.bincount(own, minlength=last - first)
                held = np.flatnonzero(n)
                edges = np.concatenate([[0], np.cumsum(n[held])])[: len(held)].astype(np.int64)
                digests, sigs = [None] * (last - first), [None] * (last - first)
                if len(held):
                    signed = minhash(keys, edges)
                    for k, i in enumerate(held):
                        part = keys[edges[k] : edges[k] + n[i]]
                        digests[i] = hashlib.blake2b(part.tobytes(), digest_size=16).digest()
                        sigs[i] = signed[k].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, last - first), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary())],
                    ["doc_id", "n", "cls", "sig"],
                )

    W.narrow(df.sparkSession)
    kind = df.schema[doc].dataType.simpleString()
    return df.select(F.col(doc).alias("doc_id"), F.col(text).alias("t")).mapInArrow(run, f"doc_id {kind}, n bigint, cls binary, sig binary")


def sets(df: DataFrame, text: str) -> DataFrame:
    """``cls, keys, parity`` of every row with words: the digest, the whole set and its parities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in W.slices(batch.column("t")):
                keys, own = shingles(data, offsets)
                n = np.bincount(own, minlength=last - first)
                edges = np.concatenate([[0], np.cumsum(n[n > 0])]).astype(np.int32)
                digests = [hashlib.blake2b(keys[a:b].tobytes(), digest_size=16).digest() for a, b in zip(edges[:-1], edges[1:])]
                held = pa.ListArray.from_arrays(pa.array(edges), pa.array(keys.view(np.int64)))
                bits = pa.array(list(parities(keys, own, len(n))[n > 0]), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), held, bits], ["cls", "keys", "parity"])

    return df.select(F.col(text).alias("t")).mapInArrow(run, "cls binary, keys array<bigint>, parity array<bigint>")


def bands(classes: DataFrame, split: Banding) -> DataFrame:
    """``key, cls``: one row for each band of a class."""
    width = 4 * split.rows
    part = lambda i: F.xxhash64(i, F.col("sig").substr(i * width + 1, F.lit(width)))
    keys = F.transform(F.sequence(F.lit(0), F.lit(split.bands - 1)), part)
    return classes.select("cls", F.explode(keys).alias("key"))


def likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` that the sequence of signature batches doesn't prune."""
    least = needed(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(-1, HASHES) for c in ("x", "y"))
            alive, matches = np.arange(len(x)), np.zeros(len(x), np.int64)
            for k, most in enumerate(least):
                cut = slice(k * BATCH, (k + 1) * BATCH)
                matches = matches + (x[alive, cut] == y[alive, cut]).sum(1)
                go = matches >= most
                alive, matches = alive[go], matches[go]
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(alive)) for c in ("a", "b")], ["a", "b"])

    signed = classes.select(F.col("cls"), "sig")
    both = pairs.join(signed.toDF("a", "x"), "a").join(signed.toDF("b", "y"), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


def full_sets(cls: DataFrame, classes: DataFrame, df: DataFrame, text: str, doc: str) -> DataFrame:
    """``cls, keys, parity`` of the wanted classes, from the whole texts of their first documents."""
    ids = classes.join(cls, "cls", "left_semi").select("doc").distinct()
    texts = df.join(ids, F.col(doc).eqNullSafe(F.col("doc")), "left_semi")
    return sets(texts, text).join(cls, "cls", "left_semi").dropDuplicates(["cls"])


def linked(i: Column, sizes: Column, percent: int) -> Column:
    """Whether ``i`` shared elements of sets with ``sizes`` elements together reach the threshold."""
    return 100 * i >= percent * (sizes - i)


def confirm(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    held = full.select("cls", "keys")
    both = pairs.join(held.toDF("a", "x"), "a").join(held.toDF("b", "y"), "b")
    sized = both.select("a", "b", F.size(F.array_intersect("x", "y")).alias("i"), (F.size("x") + F.size("y")).alias("s"))
    return sized.where(linked(F.col("i"), F.col("s"), percent)).select("a", "b")


def centers_of(buckets: DataFrame) -> DataFrame:
    """``key, pivot``: of the components in a bucket, the center of the one with the most neighbours.

    A component has one center, wherever its members are, so a member is told from few pivots.
    """
    known = buckets.groupBy("cls", "root").agg(F.sum("size").alias("near"))
    centers = known.groupBy("root").agg(F.max(F.struct("near", "cls")).alias("top"))
    held = buckets.select("key", "root").distinct().join(centers, "root")
    return held.groupBy("key").agg(F.max("top").alias("top")).select("key", F.col("top.cls").alias("pivot"))


def around_pivots(star: DataFrame, sets_: DataFrame, percent: int) -> DataFrame:
    """Pairs of members that can be linked though one of them isn't linked with their pivot.

    ``star`` has ``pivot, cls, root``. Let d be a member's difference from its pivot o, in both
    directions. x and y are linked only if their difference, ``|dx| + |dy| - 2 |dx & dy|``, is at most
    ``c (|x| + |y|)`` with ``c = (100 - percent) / (100 + percent)``. As ``|y| <= |o| + |dy|``, they then share
    ``t >= (r + (1 - c) |dy|) / 2`` elements of their differences, with ``r = |dx| - c (|x| + |o|)``. If x isn't
    linked with o, r is above 0. So a member that is far from o shares ``r / (1 + c)`` with any other (as
    ``|dy| >= t``), and one that is near shares ``(1 - c) |dy| / 2`` with one that is far. With the elements in
    one order, the first ones of both must meet, up to these bounds, and no others become rows. What a member
    adds to its pivot, often its own edits alone, is first, what it lacks comes after. The join is on those
    elements, never on the pivot. A pair becomes a row if what follows a shared element in both is long
    enough for the pair's own bound (the first element they share always passes) and their parities differ
    in no more bits than linked sets may. The work of that comparison, not its rows, can grow with the
    square of the members that are far from their pivot, apart from each other, and lack or add the same.
    """
    c = (100 - percent) / (100 + percent)
    held = sets_.select("cls", "keys", "parity")
    # The join by member comes last, so that the members of one pivot are spread when they are exploded.
    both = star.join(held.select(F.col("cls").alias("pivot"), F.col("keys").alias("o")), "pivot").join(held.withColumnRenamed("keys", "x"), "cls")
    apart = F.concat(F.array_sort(F.array_except("x", "o")), F.array_sort(F.array_except("o", "x")))
    sized = both.select("pivot", "cls", "root", apart.alias("d"), F.size("x").alias("nx"), F.size("o").alias("no"), "parity")
    n = F.size("d")
    far = (100 + percent) * n > (100 - percent) * (F.col("nx") + F.col("no"))
    shared = F.when(far, (n - c * (F.col("nx") + F.col("no"))) / (1 + c)).otherwise((1 - c) * n / 2)
    # The small amount keeps rounding from raising a bound.
    first = n - F.greatest(F.lit(1), F.ceil(shared - 1e-6)) + 1
    prefix = F.posexplode(F.slice("d", F.lit(1), first.cast("int"))).alias("nth", "e")
    rows = durable(sized.where(n > 0).select("pivot", "cls", "root", far.alias("far"), "nx", n.alias("n"), "parity", prefix))
    side = lambda k, name: [F.col(c).alias(f"{c}_{k}") for c in ("root", "n", "nx", "nth", "parity")] + [F.col("cls").alias(name)]
    x, y = rows.where("far").select("pivot", "e", *side("x", "a")), rows.select("pivot", "e", *side("y", "b"))
    most = F.least(F.col("n_x") - F.col("nth_x"), F.col("n_y") - F.col("nth_y"))
    sizes = F.col("nx_x") + F.col("nx_y")
    least = F.col("n_x") + F.col("n_y") - c * sizes
    differ = reduce(Column.__add__, [F.bit_count(F.col("parity_x")[i].bitwiseXOR(F.col("parity_y")[i])) for i in range(BITS // 64)])
    near = (2 * most >= least - 1e-6) & ((100 + percent) * differ <= (100 - percent) * sizes)
    met = x.join(y, ["pivot", "e"]).where((F.col("a") != F.col("b")) & (F.col("root_x") != F.col("root_y")) & near)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def links(classes: DataFrame, df: DataFrame, text: str, doc: str, percent: int) -> DataFrame:
    """Links ``a, b`` between classes that together give their components."""
    rows = bands(classes, banding(percent))
    several = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    buckets = durable(rows.join(several, "key"))
    # Signatures and sets of all that can be compared; the rest are not shuffled again.
    wanted = buckets.select("cls").distinct()
    classes = durable(classes.join(wanted, "cls", "left_semi"))
    full = durable(full_sets(wanted, classes, df, text, doc))
    # The pivot is the member with the most neighbours over all its buckets: a group's origin.
    central = buckets.groupBy("cls").agg(F.sum("size").alias("near"))
    pivots = buckets.join(central, "cls").groupBy("key").agg(F.max(F.struct("near", "cls")).alias("top")).select("key", F.col("top.cls").alias("pivot"))
    members = buckets.join(pivots, "key").where(F.col("cls") != F.col("pivot"))
    star = members.select(F.col("pivot").alias("a"), F.col("cls").alias("b")).distinct()
    first = durable(confirm(likely(star, classes, percent), full, percent))

    roots = components(first)
    rooted = durable(buckets.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls")))
    open_ = rooted.groupBy("key").agg((F.min("root") != F.max("root")).alias("open")).where("open").select("key")
    apart = durable(rooted.join(open_, "key", "left_semi"))
    small = apart.where(F.col("size") <= FEW)
    left, right = small.select("key", F.col("cls").alias("a"), F.col("root").alias("ra")), small.select("key", F.col("cls").alias("b"), F.col("root").alias("rb"))
    pairs = left.join(right, "key").where((F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb"))).select("a", "b")

    large = apart.where(F.col("size") > FEW)
    spokes = large.join(centers_of(large), "key").where(F.col("cls") != F.col("pivot")).select("pivot", "cls", "root").distinct()
    # A pivot may stand outside of a bucket; its own set is there, as it has a bucket.
    pairs = durable(pairs.unionByName(around_pivots(durable(spokes), full, percent)).distinct())
    second = confirm(likely(pairs, classes, percent), full, percent)
    return first.unionByName(second)


def components_of(df: DataFrame, text: str = "text", doc: str = "doc_id", percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``df``."""
    if not 0 < percent <= 100:
        raise ValueError("percent must be over 0 and at most 100")
    marked = durable(marks(df, text, doc))
    held = marked.where(F.col("n") > 0)
    classes = durable(held.groupBy("cls").agg(F.min("doc_id").alias("doc"), F.max("n").alias("n"), F.max("sig").alias("sig")))
    found = durable(components(links(classes, df, text, doc, percent)))
    rooted = classes.select("cls", "doc").join(found.withColumnRenamed("node", "cls"), "cls", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "cls"))
    least = rooted.groupBy("root").agg(F.min("doc").alias("component_id"))
    named = durable(rooted.join(least, "root").select("cls", "component_id"))
    out = marked.select("doc_id", "n", "cls").join(named, "cls", "left")
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        own.alias("component_id"),
        F.col("doc_id").eqNullSafe(own).alias("kept"),
    )
