"""Windows of work that fail apart: each one's outcome is a row of a ledger, and the next run takes what is still open."""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import records
from tidemark.sources.scratch import scratch

SPAN = ["window_start", "window_end"]


def _ddl(windows: DataFrame, keys: list[str]) -> str:
    named = ", ".join(f"`{c}` {windows.schema[c].dataType.simpleString()}" for c in [*keys, *SPAN])
    return f"{named}, run long, attempt long, status string, error string"


def attempts(spark: SparkSession, ledger: str, windows: DataFrame, keys: list[str]) -> DataFrame:
    """The last entry of each window."""
    found = records.read(spark, ledger, _ddl(windows, keys))
    place = [*keys, *SPAN]
    return found.groupBy(*place).agg(F.max_by(F.struct("run", "attempt", "status", "error"), "run").alias("e")).select(*place, "e.*")


def open_windows(spark: SparkSession, windows: DataFrame, ledger: str, keys: list[str]) -> DataFrame:
    """The windows that aren't done, with the number of the attempt that comes next."""
    place = [*keys, *SPAN]
    known = attempts(spark, ledger, windows, keys).select(*place, "attempt", "status")
    return windows.select(*place).distinct().join(known, place, "left").where("status IS NULL OR status <> 'done'").select(
        *place, (F.coalesce("attempt", F.lit(0)) + 1).alias("attempt"))


def run_windows(
    spark: SparkSession, windows: DataFrame, rows: DataFrame, work: Callable[[dict, pd.DataFrame], pd.DataFrame], schema: str, ledger: str, out: str,
    keys: list[str],
) -> DataFrame:
    """Work through the open windows and give the ledger's entries of this run.

    ``rows`` (keys, window_start and more) are dealt to their windows; ``work`` gets a window (keys, bounds, attempt) and its rows and
    gives rows of ``schema``.  An error makes a row of the ledger and nothing else.  Results go to a folder of the run, which readers see once the ledger
    says so.  A series of which every window failed is an error, after the ledger is written.
    """
    run, place = time.time_ns(), [*keys, *SPAN]
    planned, at = scratch(spark, "open-windows"), scratch(spark, "windows")
    open_windows(spark, windows, ledger, keys).write.parquet(planned)
    todo = spark.read.parquet(planned)
    outcome = f"{_ddl(windows, keys)}, result array<struct<{schema}>>"
    names = [c.strip().split()[0].strip("`:") for c in schema.split(",")]

    def one(window: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        made = []
        for w in window.to_dict("records"):
            entry = {c: w[c] for c in place} | {"run": run, "attempt": w["attempt"], "status": "done", "error": None, "result": []}
            try:
                got = work(w, own)
                entry["result"] = got[names].to_dict("records")
            except Exception as error:
                entry |= {"status": "failed", "error": f"{type(error).__name__}: {error}"[:500]}
            made.append(entry)
        return pd.DataFrame(made, columns=[*place, "run", "attempt", "status", "error", "result"])

    by = [*keys, "window_start"]
    todo.groupBy(*by).cogroup(rows.join(todo.select(*by).distinct(), by, "left_semi").groupBy(*by)).applyInPandas(one, outcome).write.parquet(at)
    results = spark.read.parquet(at)
    results.where("status = 'done'").select(*keys, "window_start", F.explode("result").alias("r")).select(*keys, "window_start", "r.*").write.parquet(f"{out.rstrip('/')}/run={run}")
    entries = results.drop("result")
    records.append(spark, ledger, "", entries)
    lost = entries.groupBy(*(keys or [F.lit(1)])).agg(F.count_if(F.col("status") == "done").alias("n")).where("n = 0")
    if not lost.isEmpty():
        raise RuntimeError(f"all windows failed of {[tuple(r)[:-1] for r in lost.limit(5).collect()]}")
    return entries


def results(spark: SparkSession, ledger: str, out: str, windows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of windows that are done, each from the run that did it."""
    done = attempts(spark, ledger, windows, keys).where("status = 'done'").select(*keys, "window_start", "run")
    rows = spark.read.parquet(out).withColumn("run", F.col("run").cast("long"))
    return rows.join(done, [*keys, "window_start", "run"], "left_semi").drop("run")
