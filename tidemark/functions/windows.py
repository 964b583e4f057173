"""Windows over series, cut into time slices so that one busy series fills many tasks.

A trailing window never looks back further than its width.  Series are cut into
slices at least as long; a slice is computed with the slice before it as
context, so (key, slice) and not key alone is what a task gets.  Sums and moments
over such windows are merged from two parts, the end of one block of the window's
length and the beginning of the next, so their cost doesn't grow with the width
and nothing outside the window leaves a trace.  Windows over counts of rows are cut in blocks of numbered rows, with the
rows of the neighbours that they reach as context.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.exprs import micros

SLICE_SECONDS = 86_400


#: Rows of a block; a longer reach makes longer blocks.
BLOCK_ROWS = 1 << 14
#: Windows of at most so many seconds hold few rows: they are gone through, which needs no further sorts.
SHORT_SECONDS = 900
#: Of rows without a time.
_NEVER = -(1 << 40)


def _sliced(df: DataFrame, ts: str, seconds: int) -> DataFrame:
    """Rows with their time in microseconds, in their own slice and as context in the next one."""
    width = max(seconds + 1, SLICE_SECONDS) * 1_000_000
    tagged = df.withColumn("__us", micros(F.col(ts)))
    tagged = tagged.withColumn("__own", F.coalesce(F.floor(F.col("__us") / width), F.lit(_NEVER)))
    return tagged.withColumn("__slice", F.explode(F.when(F.col("__us").isNull(), F.array("__own")).otherwise(F.array(F.col("__own"), F.col("__own") + 1))))


def _own(df: DataFrame) -> DataFrame:
    return df.where("__slice = __own").drop("__us", "__own", "__slice")


def trailing(
    df: DataFrame,
    keys: list[str],
    ts: str,
    seconds: int,
    aggregates: dict[str, Callable[[WindowSpec], Column]],
    closed: bool = False,
) -> DataFrame:
    """Add aggregates over (t - seconds, t], or over [t - seconds, t] if ``closed``; rows without a time are each other's window.

    For windows of a few rows, and aggregates that aren't sums: each row's window is gone through anew.
    """
    w = Window.partitionBy(*keys, "__slice").orderBy("__us").rangeBetween(-(seconds * 1_000_000 - (0 if closed else 1)), 0)
    return _own(_sliced(df, ts, seconds).withColumns({name: make(w) for name, make in aggregates.items()}))


def _partial(x: Column, w: WindowSpec, moments: bool) -> list[Column]:
    """What is kept of a part of a window: parts merge without loss of digits."""
    fields = [F.count(x).over(w).alias("n"), F.sum(x).over(w).alias("total")]
    return fields + ([F.var_pop(x).over(w).alias("var"), F.min(x).over(w).alias("low"), F.max(x).over(w).alias("high")] if moments else [])


def _merged(a: Column, b: Column, moments: bool) -> Column:
    """n, total, mean, std of two parts together; ``a`` may be null, where there is none."""
    count = lambda p: F.coalesce(p["n"], F.lit(0))
    n = count(a) + count(b)
    total = F.coalesce(a["total"] + b["total"], a["total"], b["total"])
    if not moments:
        return F.struct(n.alias("n"), total.alias("total"))
    low = F.least(a["low"], b["low"])
    same = low == F.greatest(a["high"], b["high"])
    apart = F.coalesce(a["total"] / F.nullif(a["n"], F.lit(0)) - b["total"] / F.nullif(b["n"], F.lit(0)), F.lit(0.0))
    squares = F.coalesce(a["var"] * a["n"], F.lit(0.0)) + F.coalesce(b["var"] * b["n"], F.lit(0.0)) + apart * apart * (count(a) * count(b) / F.greatest(n, F.lit(1)))
    return F.struct(
        n.alias("n"), F.when(same, n * low).otherwise(total).alias("total"), F.when(same, low).otherwise(total / F.nullif(n, F.lit(0))).alias("mean"),
        F.when(n > 1, F.when(same, 0.0).otherwise(F.sqrt(squares / (n - 1)))).alias("std"))


def rolling(
    df: DataFrame, keys: list[str], ts: str, values: dict[str, Column], spans: dict[str, int], moments: bool | set[str] = True, only: dict[str, set[str]] | None = None,
) -> DataFrame:
    """Add ``{value}_{span}``: a struct of n, total, mean, std of each value over each (t - seconds, t], all in one exchange.

    Time is cut in blocks as long as the window, so a window is the end of one block and the beginning of the next.  Running
    moments forwards give each row the beginning of its block, backwards the end of its block; the first row after t - seconds
    is the one after the last row up to then.  The two parts are merged by count, mean and sum of squared deviations, so a value
    counts only where its window has it, and no large sums are subtracted.  A window in which the value never changes
    gives exact results; windows of up to ``SHORT_SECONDS`` are gone through instead.  Without ``moments`` (or for values that aren't in
    it) only n and total; ``only``: the spans of a value that doesn't need all.  Rows without a time are each other's window.
    """
    full = {v: moments if isinstance(moments, bool) else v in moments for v in values}
    of_span = {name: [v for v in values if name in (only or {}).get(v, spans)] for name in spans}
    rows = _sliced(df.withColumns({f"__x_{v}": x.cast("double") for v, x in values.items()}), ts, max(spans.values()))
    order = Window.partitionBy(*keys, "__slice").orderBy("__us")
    so_far = lambda w: w.rangeBetween(Window.unboundedPreceding, 0)
    made, out = [f"__x_{v}" for v in values], {}
    wide = {name: seconds * 1_000_000 for name, seconds in spans.items() if seconds > SHORT_SECONDS}
    for name, seconds in spans.items():
        if name not in wide:
            w = order.rangeBetween(1 - seconds * 1_000_000, 0)
            for v in of_span[name]:
                x = F.col(f"__x_{v}")
                fields = [F.count(x).over(w).alias("n"), F.sum(x).over(w).alias("total")]
                fields += [F.avg(x).over(w).alias("mean"), F.stddev_samp(x).over(w).alias("std")] if full[v] else []
                out[f"{v}_{name}"] = F.struct(*fields)
    for name, us in wide.items():
        rows = rows.withColumn(f"__block_{name}", F.floor(F.col("__us") / us))
        block = Window.partitionBy(*keys, "__slice", f"__block_{name}")
        ways = {"begin": so_far(block.orderBy("__us")), "end": so_far(block.orderBy(F.col("__us").desc()))}
        for way, w in ways.items():
            rows = rows.withColumn(f"__{way}_{name}", F.struct(F.col(f"__block_{name}").alias("block"), *[
                F.struct(*_partial(F.col(f"__x_{v}"), w, full[v])).alias(v) for v in of_span[name]]))
        made += [f"__block_{name}", f"__begin_{name}", f"__end_{name}", f"__next_{name}", f"__edge_{name}"]
    rows = rows.withColumns({f"__next_{name}": F.lead(f"__end_{name}").over(order) for name in wide})
    rows = rows.withColumns({f"__edge_{name}": F.coalesce(
        F.last(f"__next_{name}", True).over(order.rangeBetween(Window.unboundedPreceding, -us)), F.first(f"__end_{name}").over(so_far(order)))
        for name, us in wide.items()})
    for name in wide:
        edge = F.when(F.col(f"__edge_{name}.block") == F.col(f"__block_{name}") - 1, F.col(f"__edge_{name}"))
        for v in of_span[name]:
            out[f"{v}_{name}"] = _merged(edge[v], F.col(f"__begin_{name}.{v}"), full[v])
    return _own(rows.withColumns(out)).drop(*made)


def running(df: DataFrame, keys: list[str], ts: str, value: Column, name: str, *order: str) -> DataFrame:
    """Add the running sum of ``value`` in a series, this row's included: sums within slices of time, and those of the slices before."""
    at = F.coalesce(F.floor(micros(F.col(ts)) / (SLICE_SECONDS * 1_000_000)), F.lit(_NEVER))
    rows = df.withColumn("__slice", at).withColumn("__value", value)
    place = F.struct(*keys, "__slice")
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy(*keys, "__slice").agg(F.sum("__value").alias("c")).select(  # a row for each slice
        place.alias("__place"), F.coalesce(F.sum("c").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy(*keys, "__slice").orderBy(ts, *order).rowsBetween(Window.unboundedPreceding, 0)
    own = rows.withColumn("__i", F.coalesce(F.sum("__value").over(inside), F.lit(0))).withColumn("__place", place)
    return own.join(base, "__place").withColumn(name, F.col("__base") + F.col("__i")).drop("__place", "__base", "__i", "__slice", "__value")


def numbered(df: DataFrame, keys: list[str], ts: str, *order: str) -> DataFrame:
    """Add ``__n``, the number of each row in its series, from 0."""
    return running(df, keys, ts, F.lit(1).cast("long"), "__n", *order).withColumn("__n", F.col("__n") - 1)


def blocks(
    df: DataFrame, keys: list[str], ts: str, *order: str, back: int = 0, ahead: int = 0, step: int | None = None, long: int = BLOCK_ROWS
) -> tuple[DataFrame, WindowSpec]:
    """``df`` dealt out in blocks of a series' rows, and the window in which to look so many rows back and ahead.

    ``step``: the rows are a grid without gaps, of so many seconds; their numbers then follow from their times, and
    nothing has to be counted.  ``whole`` takes the context away again.
    """
    long = max(back, ahead, long)
    rows = df.withColumn("__n", F.floor(micros(F.col(ts)) / (step * 1_000_000))) if step else numbered(df, keys, ts, *order)
    rows = rows.withColumn("__own", F.floor(F.col("__n") / long))
    n = F.pmod(F.col("__n"), F.lit(long))
    places = [F.col("__own"), F.when(n >= long - back, F.col("__own") + 1), F.when(n < ahead, F.col("__own") - 1)]
    rows = rows.withColumn("__block", F.explode(F.array_compact(F.array(*places))))
    return rows, Window.partitionBy(*keys, "__block").orderBy("__n")


def whole(rows: DataFrame) -> DataFrame:
    return rows.where("__block = __own").drop("__n", "__own", "__block")


def over_rows(
    df: DataFrame, keys: list[str], ts: str, make: Callable[[WindowSpec], dict[str, Column]], back: int = 0, ahead: int = 0, step: int | None = None
) -> DataFrame:
    """Add columns that look ``back`` and ``ahead`` so many rows of a series; ``step`` as in ``blocks``."""
    rows, w = blocks(df, keys, ts, back=back, ahead=ahead, step=step)
    return whole(rows.withColumns(make(w)))


def last_known(
    df: DataFrame, keys: list[str], ts: str, order: list[str], value: Column, name: str,
    inclusive: bool = True, slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Add the last non-null ``value`` up to each row (or before it), in the order (ts, *order).

    Each slice finds its own; what a slice starts with comes from a table with a row for each slice.
    """
    at = F.floor(micros(F.col(ts)) / (slice_seconds * 1_000_000))
    rows = df.withColumn("__slice", at).withColumn("__value", value)
    place = F.struct(ts, *order)
    filled = rows.groupBy(*keys, "__slice").agg(F.max_by("__value", F.when(F.col("__value").isNotNull(), place)).alias("__end"))
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = filled.select(*keys, "__slice", F.last("__end", True).over(before).alias("__carried"))
    inside = Window.partitionBy(*keys, "__slice").orderBy(ts, *order).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1
    )
    return (
        rows.withColumn("__inside", F.last("__value", True).over(inside))
        .join(carried, [*keys, "__slice"], "left")
        .withColumn(name, F.coalesce("__inside", "__carried"))
        .drop("__slice", "__value", "__inside", "__carried")
    )


def max2(x: Column) -> Callable[[WindowSpec], Column]:
    return lambda w: F.when(F.count(x).over(w) >= 2, F.max(x).over(w))


def zscore(x: Column, window: str) -> Column:
    """(x - mean) / std of a window of ``rolling``, null unless std > 0."""
    return F.when(F.col(f"{window}.std") > 0, (x - F.col(f"{window}.mean")) / F.col(f"{window}.std"))


class Ranks:
    """How much weight a range of positions has in values up to a bound: a wavelet matrix over the ranks of the values.

    One level a bit of the ranks, n log n to make; questions go through the levels as whole arrays, log n operations each.
    """

    def __init__(self, values: np.ndarray, weights: np.ndarray):
        self.known, ranks = np.unique(values, return_inverse=True)
        self.bits = int(len(self.known)).bit_length()  # one more than the greatest rank has a code too
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        for bit in range(self.bits - 1, -1, -1):
            low = (ranks >> bit & 1) == 0
            before = lambda x: np.concatenate([[0], np.cumsum(x)])
            self.levels.append((before(low), before(np.where(low, weights, 0))))
            order = np.concatenate([np.flatnonzero(low), np.flatnonzero(~low)])
            ranks, weights = ranks[order], weights[order]

    def at_most(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Weight of the positions low to high - 1 whose value is at most ``bound``, one of the values."""
        code, total = np.searchsorted(self.known, bound) + 1, np.zeros(len(low), np.int64)
        for bit, (zeros, weight) in zip(range(self.bits - 1, -1, -1), self.levels):
            one = (code >> bit & 1) == 1
            total += np.where(one, weight[high] - weight[low], 0)
            low, high = (np.where(one, zeros[-1] + x - zeros[x], zeros[x]) for x in (low, high))
        return total


def percentile_rank(df: DataFrame, keys: list[str], ts: str, value: str, seconds: int, name: str) -> DataFrame:
    """Add the share of the values in the closed [t - seconds, t] that are at most the current one; null for a null.

    Counting orders has no built-in form that is linear in the width: each slice is ranked in Arrow batches, by array operations in
    n log n, whatever the width.
    """
    slim = [*keys, ts, value]
    distinct = df.select(*slim).where(F.col(value).isNotNull() & F.col(ts).isNotNull()).groupBy(*slim).agg(F.count(F.lit(1)).alias("__times"))
    rows = _sliced(distinct, ts, seconds)
    reach = seconds * 1_000_000
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in distinct.schema.fields if f.name != "__times") + ", __rank double"

    def ranked(table: pa.Table) -> pa.Table:
        us, x, times = (table.column(c).to_numpy(zero_copy_only=False) for c in ("__us", value, "__times"))
        order = np.argsort(us, kind="stable")
        us, x, times = us[order], x[order], times[order]
        # Rows of one instant see each other.
        first, end = np.searchsorted(us, us - reach), np.searchsorted(us, us, "right")
        all_of = np.concatenate([[0], np.cumsum(times)])
        share = Ranks(x, times).at_most(first, end, x) / (all_of[end] - all_of[first])
        out = np.empty(len(us))
        out[order] = share
        own = pc.equal(table.column("__slice"), table.column("__own"))
        return table.select(slim).append_column("__rank", pa.array(out)).filter(own)

    ranks = rows.groupBy(*keys, "__slice").applyInArrow(ranked, schema)
    place = lambda d: d.withColumn("__place", F.struct(*slim))
    return place(df).join(place(ranks).select("__place", F.col("__rank").alias(name)), "__place", "left").drop("__place")
