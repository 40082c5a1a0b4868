"""Ordered operations on long series, split into chunks.

A plain ``Window.partitionBy(series)`` puts a whole series into one task; one series may hold a
third of the archive. Everything ordered in this package therefore runs on *chunks* of a series:

* ``scan``   unbounded frames (running sum, last known value, previous row ...): the frame is
  evaluated inside each chunk, every chunk is reduced to one row of totals (map-side combined),
  the totals are accumulated along the chunks, and the carry is joined back.
* ``frames`` bounded row frames: rows near a chunk border are copied into the neighbour chunk.

Both are exact. Chunks are cut on the ordering column, so finding the chunk of a row needs no
shuffle, and the only wide exchange is on (series, chunk).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import durable

HOUR = 3_600_000_000
CHUNK = "_chunk"


def number(df: DataFrame, name: str) -> Column:
    """The ordering column as a number; timestamps become epoch microseconds."""
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return F.unix_micros(F.col(name))
    return F.col(name)


@dataclass(frozen=True)
class Axis:
    """Series key, ordering columns and the chunk width in units of the first ordering column.

    The width is in microseconds for a timestamp. A chunk should hold some 100,000 rows: an hour
    of a 60 Hz sensor is 216,000. ``fit_width`` measures a table and picks the width.
    """

    by: tuple[str, ...]
    order: tuple[str, ...]
    width: float = HOUR

    @property
    def keys(self) -> list[str]:
        return [*self.by, CHUNK]

    def cut(self, df: DataFrame) -> DataFrame:
        return df.withColumn(CHUNK, F.floor(number(df, self.order[0]) / F.lit(self.width)))

    def position(self) -> Column:
        return order_value(self.order)


def order_value(order: Sequence[str]) -> Column:
    """One value that orders the rows; a single column keeps ``min_by`` in hash aggregation."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def axis(by: str | Sequence[str], order: str | Sequence[str], width: float = HOUR) -> Axis:
    return Axis(
        (by,) if isinstance(by, str) else tuple(by),
        (order,) if isinstance(order, str) else tuple(order),
        width,
    )


def fit_width(df: DataFrame, ax: Axis, rows: int = 200_000) -> Axis:
    """Halve the chunk width until no chunk holds more than ``rows`` rows (one count a step)."""
    width = ax.width
    while width > 1:
        trial = Axis(ax.by, ax.order, width)
        fullest = trial.cut(df).groupBy(*trial.keys).count().agg(F.max("count")).first()[0] or 0
        if fullest <= rows:
            break
        width = max(1, width // max(2, int(fullest // rows)))
    return Axis(ax.by, ax.order, width)


@dataclass(frozen=True)
class Step:
    """One running quantity: what, over which expression, in which direction."""

    kind: str
    expr: Column
    forward: bool = True
    inclusive: bool = True
    peers: bool = False


def running(kind: str, expr: Column, *, inclusive: bool = True, forward: bool = True) -> Step:
    """Running ``sum``, ``max`` or ``min``; ``inclusive`` counts the current row."""
    return Step(kind, expr, forward, inclusive)


def latest(expr: Column, *, inclusive: bool = True, peers: bool = False) -> Step:
    """Last non-null value at or before the row; ``peers`` includes rows of the same order value."""
    return Step("near", expr, True, inclusive, peers)


def upcoming(expr: Column, *, inclusive: bool = True, peers: bool = False) -> Step:
    """First non-null value at or after the row."""
    return Step("near", expr, False, inclusive, peers)


def previous(expr: Column) -> Step:
    """Value of the row before, null or not."""
    return Step("step", expr, True)


def following(expr: Column) -> Step:
    """Value of the row after, null or not."""
    return Step("step", expr, False)


def _local(step: Step, ax: Axis) -> Column:
    base = Window.partitionBy(*ax.keys).orderBy(*ax.order)
    if step.kind == "step":
        return (F.lag if step.forward else F.lead)(step.expr).over(base)
    if not step.forward:
        return _onward(step, ax)
    edge = 0 if step.inclusive else -1
    between = base.rangeBetween if step.peers else base.rowsBetween
    frame = between(Window.unboundedPreceding, Window.currentRow if step.peers else edge)
    if step.kind == "near":
        return F.last(step.expr, ignorenulls=True).over(frame)
    return getattr(F, step.kind)(step.expr).over(frame)


def _onward(step: Step, ax: Axis) -> Column:
    """A frame up to the end of the chunk, as a frame from the start over the rows in reverse.

    Spark evaluates a frame with an unbounded end anew for every row, which is quadratic in the rows
    of a chunk. ``_rn`` and ``_rank`` number the rows in order, so tied rows are reversed as well.
    """
    back = Window.partitionBy(*ax.keys)
    if step.peers:
        frame = back.orderBy(F.desc("_rank")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    else:
        frame = back.orderBy(F.desc("_rn")).rowsBetween(Window.unboundedPreceding, 0 if step.inclusive else -1)
    if step.kind == "near":
        return F.min_by(step.expr, F.when(step.expr.isNotNull(), F.col("_rn"))).over(frame)
    return getattr(F, step.kind)(step.expr).over(frame)


def _total(step: Step, ax: Axis) -> Column:
    pick = F.max_by if step.forward else F.min_by
    if step.kind == "near":
        return pick(step.expr, F.when(step.expr.isNotNull(), ax.position()))
    if step.kind == "step":
        return pick(step.expr, ax.position())
    return getattr(F, step.kind)(step.expr)


def _carry(step: Step, name: str, ax: Axis) -> Column:
    base = Window.partitionBy(*ax.by).orderBy(CHUNK)
    if step.kind == "step":
        return (F.lag if step.forward else F.lead)(name).over(base)
    # A chunk has one row of totals, so the reverse order is exact; see ``_onward``.
    order = base if step.forward else Window.partitionBy(*ax.by).orderBy(F.desc(CHUNK))
    frame = order.rowsBetween(Window.unboundedPreceding, -1)
    if step.kind == "near":
        return F.last(name, ignorenulls=True).over(frame)
    return getattr(F, step.kind)(name).over(frame)


def _join(step: Step, local: Column, carry: Column, edge: Column) -> Column:
    if step.kind == "step":
        return F.when(edge, carry).otherwise(local)
    if step.kind == "near":
        return F.coalesce(local, carry)
    if step.kind == "sum":
        return F.coalesce(local + carry, local, carry)
    return {"max": F.greatest, "min": F.least}[step.kind](local, carry)


def join_back(df: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """``df`` with what ``other`` holds for its keys; NULL is a key like any other. Keys come first."""
    own = {k: f"_on_{i}" for i, k in enumerate(on)}
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(o)) for k, o in own.items()))
    joined = df.join(other.withColumnsRenamed(own), same, how)
    more = [] if how in ("left_semi", "left_anti") else [c for c in other.columns if c not in own]
    # In a full join a key is on one side or equal on both.
    keys = [F.coalesce(k, o).alias(k) if how == "full" else F.col(k) for k, o in own.items()]
    return joined.select(*keys, *[c for c in df.columns if c not in own], *more)


def scan(df: DataFrame, ax: Axis, **steps: Step) -> DataFrame:
    """Add one column per step, exact over the whole series.

    Rows and totals both read ``df``. An input that reads several tables, such as the result of another
    scan, is written down first, so stacked scans read each input once instead of 2**k times. NULL is
    a key like any other.
    """
    cut = ax.cut(df if leaves(df) < 2 else durable(df))
    base = Window.partitionBy(*ax.keys).orderBy(*ax.order)
    marks = {}
    if any(s.kind == "step" and s.forward for s in steps.values()):
        marks["_head"] = F.lag(F.lit(1)).over(base).isNull()
    if any(s.kind == "step" and not s.forward for s in steps.values()):
        marks["_tail"] = F.lead(F.lit(1)).over(base).isNull()
    onward = any(s.kind != "step" and not s.forward for s in steps.values())
    numbered = cut.withColumns({"_rn": F.row_number().over(base), "_rank": F.rank().over(base)}) if onward else cut
    rows = numbered.withColumns({**{f"_l_{n}": _local(s, ax) for n, s in steps.items()}, **marks})
    totals = cut.groupBy(*ax.keys).agg(*[_total(s, ax).alias(f"_c_{n}") for n, s in steps.items()])
    carry = totals.select(*ax.keys, *[_carry(s, f"_c_{n}", ax).alias(f"_c_{n}") for n, s in steps.items()])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in ax.keys])
    joined = rows.join(carry.withColumnsRenamed({k: f"_k_{k}" for k in ax.keys}), same, "left")
    out = {
        n: _join(s, F.col(f"_l_{n}"), F.col(f"_c_{n}"), F.col("_head" if s.forward else "_tail") if s.kind == "step" else None)
        for n, s in steps.items()
    }
    kept = [F.col(c) for c in df.columns if c not in out]
    return joined.select(*kept, *[c.alias(n) for n, c in out.items()])


def leaves(df: DataFrame) -> int:
    """Number of tables that the plan of ``df`` reads, the same table twice counting twice."""
    return df._jdf.queryExecution().analyzed().collectLeaves().size()


def row_index(df: DataFrame, ax: Axis, name: str = "idx") -> DataFrame:
    """Dense position 0, 1, 2 ... of every row in its series."""
    return scan(df, ax, **{name: running("sum", F.lit(1).cast("bigint"))}).withColumn(
        name, F.col(name) - 1
    )


def halo(df: DataFrame, by: Iterable[str], idx: str, size: int, before: int, after: int) -> DataFrame:
    """Copy each row into every block whose bounded frames need it.

    ``_block`` is the block, ``_core`` tells the one copy to keep afterwards. At most
    ``(before + after) / size`` of the rows are copied.
    """
    first = F.floor((F.col(idx) - after) / F.lit(size))
    last = F.floor((F.col(idx) + before) / F.lit(size))
    return df.withColumn("_block", F.explode(F.sequence(first, last))).withColumn(
        "_core", F.floor(F.col(idx) / F.lit(size)) == F.col("_block")
    )


def frames(
    df: DataFrame,
    by: Sequence[str],
    idx: str,
    before: int,
    after: int,
    exprs: dict[str, Callable[[Window], Column]],
    size: int = 100_000,
) -> DataFrame:
    """Row frames ``-before .. after`` over a dense index, block by block."""
    w = Window.partitionBy(*by, "_block").orderBy(idx).rowsBetween(-before, after)
    blocks = halo(df, by, idx, size, before, after)
    done = blocks.withColumns({name: make(w) for name, make in exprs.items()})
    return done.where("_core").drop("_block", "_core")


def map_blocks(
    df: DataFrame,
    by: Sequence[str],
    idx: str,
    before: int,
    after: int,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType,
    size: int = 50_000,
) -> DataFrame:
    """Apply ``fn`` to the rows of each block, sorted, with its halo; halo rows are dropped after."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(idx, kind="stable", ignore_index=True)
        return fn(block)[block["_core"].to_numpy()][names]

    names = schema.fieldNames()
    return halo(df, by, idx, size, before, after).groupBy(*by, "_block").applyInPandas(run, schema)


def _value_ranges(df: DataFrame, by: Sequence[str], col: str, splits: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Distinct values with their count in value ranges, and the ranges with the rows ``_c`` before.

    Groups of more than ``limit`` rows are cut into ranges at sketched quantiles, all others are
    one range. The sketch only balances the ranges and does not touch the results; it is written
    down, because two evaluations could cut differently.
    """
    known = df.where(F.col(col).isNotNull())
    counted = known.groupBy(*by, F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    long = durable(known.groupBy(*by).count().where(F.col("count") > limit).select(*by))
    if long.isEmpty():
        ranged = counted.withColumn(CHUNK, F.lit(0))
    else:
        marks = F.array(*[F.lit(i / splits) for i in range(1, splits)])
        sketch = F.percentile_approx(col, marks, F.lit(4 * splits))
        cuts = join_back(known, long, by, "left_semi").groupBy(*by).agg(F.array_distinct(sketch).alias("_cuts"))
        smaller = F.size(F.filter("_cuts", lambda c: c < F.col("value")))
        joined = join_back(counted, durable(cuts), by, "left")
        ranged = joined.withColumn(CHUNK, F.when(F.col("_cuts").isNull(), 0).otherwise(smaller)).drop("_cuts")
    sizes = ranged.groupBy(*by, CHUNK).agg(F.sum("n").alias("_n"))
    order = Window.partitionBy(*by).orderBy(CHUNK)
    before = F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    ranges = sizes.withColumns(
        {"_c": F.coalesce(before, F.lit(0)), "total": F.sum("_n").over(Window.partitionBy(*by))}
    )
    return ranged, ranges


def _place(ranged: DataFrame, ranges: DataFrame, by: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*by, CHUNK).orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.withColumn("_below", F.coalesce(F.sum("n").over(w), F.lit(0)))
    return join_back(rows, ranges, [*by, CHUNK]).select(
        *by, "value", "n", (F.col("_below") + F.col("_c")).alias("below"), "total"
    )


def value_counts(df: DataFrame, by: Sequence[str], col: str, splits: int = 256, limit: int = 1_000_000) -> DataFrame:
    """Distinct values of a group with ``n``, the number of smaller rows ``below`` and ``total``.

    Ranks without sorting a group in one task: values are counted first (map-side combined), then
    accumulated inside value ranges.
    """
    ranged, ranges = _value_ranges(df, by, col, splits, limit)
    return _place(ranged, ranges, by)


def quantiles(
    df: DataFrame, by: Sequence[str], col: str, probs: dict[str, float], splits: int = 256, limit: int = 1_000_000
) -> DataFrame:
    """Exact quantiles with linear interpolation between the two neighbouring ranks.

    Only the value ranges that hold a wanted rank are sorted.
    """
    if not by:
        return quantiles(df.withColumn("_all", F.lit(1)), ["_all"], col, probs, splits, limit).drop("_all")
    ranged, ranges = _value_ranges(df, by, col, splits, limit)

    def spot(p: float) -> Column:
        return F.lit(float(p)) * (F.col("total") - 1)

    def holds(rank: Column, first: str, size: str) -> Column:
        return (F.col(first) <= rank) & (rank < F.col(first) + F.col(size))

    ranks = [f(spot(p)) for p in probs.values() for f in (F.floor, F.ceil)]
    wanted = ranges.where(reduce(Column.__or__, [holds(r, "_c", "_n") for r in ranks]))
    placed = _place(join_back(ranged, wanted.select(*by, CHUNK), [*by, CHUNK], "left_semi"), wanted, by)
    aggs = []
    for name, p in probs.items():
        at = spot(p)
        for suffix, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            aggs.append(F.max(F.when(holds(rank, "below", "n"), F.col("value"))).alias(f"_{name}_{suffix}"))
        aggs.append(F.max(at - F.floor(at)).alias(f"_{name}_f"))
    found = placed.groupBy(*by).agg(*aggs)
    return found.select(
        *by,
        *[
            (F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_f")).alias(n)
            for n in probs
        ],
    )


def fits(df: DataFrame, rows: int) -> bool:
    """Whether a table has at most ``rows`` rows; reads no more than it needs to tell."""
    return df.limit(rows + 1).count() <= rows


def small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """Broadcast hint for a dimension, given only after checking its size."""
    return F.broadcast(df) if fits(df, rows) else df
