"""Gaps: missing ranges, completeness classes, fetch windows, invalidated months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import from_micros, micros
from tidemark.functions.windows import over_rows, running


def missing_ranges(df: DataFrame, keys: list[str], ts: str, seconds: int) -> DataFrame:
    """start, end of each run of missing steps between consecutive known times."""
    step = seconds * 1_000_000
    known = df.select(*keys, (F.floor(micros(F.col(ts)) / step) * step).alias("us")).distinct()
    known = known.withColumn("at", from_micros(F.col("us")))
    gaps = over_rows(known, keys, "at", lambda w: {"next": F.lead("us").over(w)}, ahead=1).where(F.col("next") - F.col("us") > step)
    return gaps.select(
        *keys, from_micros(F.col("us") + step).alias("gap_start"), from_micros(F.col("next") - step).alias("gap_end"),
        ((F.col("next") - F.col("us")) / step - 1).cast("long").alias("missing_steps"),
    )


def islands(df: DataFrame, keys: list[str], ts: str, label: str, seconds: int) -> DataFrame:
    """start, end, steps of runs of equal labels over consecutive steps."""
    def start(w):
        before = F.lag(label).over(w)
        apart = micros(F.col(ts)) - micros(F.lag(ts).over(w)) > seconds * 1_000_000
        return {"__start": before.isNull() | (before != F.col(label)) | apart}

    marked = over_rows(df, keys, ts, start, back=1)
    runs = running(marked, keys, ts, F.col("__start").cast("int"), "__run")
    return runs.groupBy(*keys, "__run").agg(
        F.min(ts).alias("interval_start"), F.max(ts).alias("interval_end"), F.first(label).alias(label), F.count(F.lit(1)).alias("steps")
    ).drop("__run")


#: Classes in order of precedence, with the status that they give a range.
STATUS = {"observed": "PASS", "confirmed_empty": "PASS", "expected_provider_gap": "PASS", "unverified": "RECONCILE_REQUIRED"}


def classify(observed: Column, confirmed_empty: Column, provider_gap: Column) -> Column:
    """The class of a step: observed, else confirmed empty, else an expected gap, else unverified (fail closed)."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(yes(observed), "observed").when(yes(confirmed_empty), "confirmed_empty")
        .when(yes(provider_gap), "expected_provider_gap").otherwise("unverified")
    )


def status_of(label: Column) -> Column:
    return F.when(label == "unverified", "RECONCILE_REQUIRED").otherwise("PASS")


def day_windows(ranges: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Ranges cut at UTC midnights: window_start, window_end (inclusive)."""
    day = 86_400_000_000
    a, b = micros(F.col(start)), micros(F.col(end))
    return ranges.select(
        *keys, a.alias("a"), b.alias("b"), F.explode(F.sequence(F.floor(a / day), F.floor(b / day))).alias("d")
    ).select(
        *keys, from_micros(F.greatest(F.col("a"), F.col("d") * day)).alias("window_start"),
        from_micros(F.least(F.col("b"), (F.col("d") + 1) * day - 1)).alias("window_end"),
    )


def fetch_windows(ranges: DataFrame, keys: list[str], start: str, end: str, seconds: int) -> DataFrame:
    """Ranges cut into requests of at most ``seconds`` from their start."""
    us = seconds * 1_000_000
    a, b = micros(F.col(start)), micros(F.col(end))
    return ranges.select(
        *keys, a.alias("a"), b.alias("b"), F.explode(F.sequence(F.lit(0).cast("long"), F.floor((b - a) / us))).alias("i")
    ).select(
        *keys, from_micros(F.col("a") + F.col("i") * us).alias("window_start"),
        from_micros(F.least(F.col("b"), F.col("a") + (F.col("i") + 1) * us - 1)).alias("window_end"),
    )


def invalidated_months(changed: DataFrame, keys: list[str], month: str, lookback_days: int) -> DataFrame:
    """Months to be rebuilt: the changed ones, and later ones whose lookback reaches into them."""
    last = F.date_trunc("month", F.date_add(F.last_day(month), lookback_days)).cast("date")
    months = F.sequence(F.date_trunc("month", month).cast("date"), last, F.expr("INTERVAL 1 MONTH"))
    return changed.select(*keys, F.explode(months).alias("rebuild_month")).distinct()
