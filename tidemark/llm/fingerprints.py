"""Document fingerprints: bottom-k sketches of word shingles, in DataFrame functions only.

A sketch is the sorted array of the k smallest distinct hashes of a text's shingles of five words (a
shorter text is one shingle). The k smallest of a union are found from the k smallest of its parts,
so sketches merge; from two of them come resemblance, containment and the number of shingles.

Defined results: a null text counts as empty; an empty text has the empty sketch, which resembles
another empty one by 1 and any other by 0. Equal texts have equal sketches. Fewer than k shingles
make the sketch exact. Texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, WORDS = 128, 5
#: Shares of a group that are merged apart.
SALTS = 64
WHITE = r"[\x20\x09-\x0D]+"


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """Hash of every window of ``words`` words, in order; empty for a text without words."""
    split = F.filter(F.split(F.coalesce(text, F.lit("")), WHITE), lambda w: w != "")
    made = F.array(F.transform(split, lambda w: F.xxhash64(w)))

    def of(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - words, F.lit(0)))
        # Places beyond a short text's end are null, which the hash skips.
        windows = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(words)]))
        return F.when(F.size(w) > 0, windows).otherwise(F.array().cast("array<bigint>"))

    return F.transform(made, of)[0]


def sketch(text: Column, k: int = K, words: int = WORDS) -> Column:
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text, words))), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of both texts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_parts(df: DataFrame, by: list[str], sketches: str = "sketch", k: int = K) -> DataFrame:
    """One sketch for each group of parts.

    A hash that parts share is made one before it is shuffled by its value, so a group of near copies
    meets nowhere as a whole. The k smallest of each of ``SALTS`` shares of a group, dealt by hash, are
    found first, then the k smallest of those.
    """
    once = df.select(*by, F.explode(sketches).alias("_h")).distinct().withColumn("_salt", F.pmod(F.xxhash64("_h"), F.lit(SALTS)))
    for part in ([*by, "_salt"], by):
        nth = F.row_number().over(Window.partitionBy(*part).orderBy("_h"))
        once = once.withColumn("_n", nth).where(F.col("_n") <= k).drop("_n")
    return once.groupBy(*by).agg(F.sort_array(F.collect_list("_h")).alias(sketches))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated size of the intersection over that of the union."""
    both = F.array(F.struct(a.alias("a"), b.alias("b"), merge(a, b, k).alias("u")))
    likeness = F.transform(
        both,
        lambda s: F.when(F.size(s["u"]) == 0, F.lit(1.0)).otherwise(
            F.size(F.array_intersect(F.array_intersect(s["a"], s["b"]), s["u"])) / F.size(s["u"])
        ),
    )
    return likeness[0]


def distinct_shingles(s: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = (F.element_at(s, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has, from resemblance and the two counts; 1 if a is empty."""
    j = resemblance(a, b, k)
    shared = j * (distinct_shingles(a, k) + distinct_shingles(b, k)) / (1 + j)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def as_text(s: Column) -> Column:
    """The sketch as 16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(s, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def with_next(df: DataFrame, key: str, carry: list[str]) -> DataFrame:
    """Add ``next_<c>`` for each of ``carry``: the value of the row with the next larger key, after the last the first.

    Rows are dealt by ranges of a numeric key, cut at sketched quantiles (they only balance the ranges),
    and ordered inside a range, so no task sees all rows and what is carried is shuffled once. Only the
    last row of a range looks outside it: it meets the first row of the next range in a join by range,
    for which the rows are already dealt. What is broadcast is one key a range, never what it carries.
    Rows of one key are ordered by the hash of what they carry; a null key comes first.
    """
    cuts = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = F.array(*[F.lit(i / cuts) for i in range(1, cuts)])
    bounds = sorted(set(df.agg(F.percentile_approx(key, shares, F.lit(10 * cuts))).first()[0] or []))
    below = F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col(key)) if bounds else F.array()
    part = F.when(F.col(key).isNull(), F.lit(0)).otherwise(F.size(below))
    dealt = df.withColumns({"_tie": F.xxhash64(*carry), "_part": part})
    place = F.struct(F.col(key).alias("k"), F.col("_tie").alias("t"))
    # One row a range: its first place, and which range comes before it.
    order = Window.orderBy("_part")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = dealt.groupBy("_part").agg(F.min(place).alias("_first"))
    first = first.withColumn("_before", F.coalesce(F.lag("_part").over(order), F.last("_part").over(whole)))
    first = F.broadcast(first.select(F.col("_part").alias("_own"), "_first", "_before"))
    at_start = (F.col("_part") == F.col("_own")) & place.eqNullSafe(F.col("_first"))
    heads = dealt.join(first, at_start).select("_before", *[F.col(c).alias(f"_head_{c}") for c in carry]).dropDuplicates(["_before"])

    along = Window.partitionBy("_part").orderBy(F.col(key).asc_nulls_first(), "_tie")
    leads = {f"_next_{c}": F.lead(c).over(along) for c in carry}
    placed = dealt.withColumns({**leads, "_inside": F.lead(F.lit(True)).over(along)})
    joined = placed.join(heads, (F.col("_part") == F.col("_before")) & F.col("_inside").isNull(), "left")
    following = [F.when(F.col("_inside"), F.col(f"_next_{c}")).otherwise(F.col(f"_head_{c}")).alias(f"next_{c}") for c in carry]
    return joined.select(*df.columns, *following)
