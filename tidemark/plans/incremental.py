"""Builds of partitions that do only what changed inputs ask for.

A partition's input fingerprint is made of path, size and time of its own files
and of those of the partitions that it looks back on, and of the builder's
contract.  Every build appends manifests; a partition whose newest manifest has
the same fingerprint, and whose output is still as it was written, is left alone.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import records
from tidemark.sources.files import fingerprints, listed

MANIFEST = "build long, month string, fingerprint string, contract string, output string, n_files long"


def months_back(month, days: int):
    """The months that the look-back of a month ('yyyy-MM') reaches, its own included."""
    first = F.to_date(F.concat(month, F.lit("-01")))
    months = F.sequence(F.trunc(F.date_sub(first, days), "month"), first, F.expr("INTERVAL 1 MONTH"))
    return F.transform(months, lambda m: F.date_format(m, "yyyy-MM"))


def input_fingerprints(spark: SparkSession, source: str, contract: str, lookback_days: int) -> DataFrame:
    """month, fingerprint of each month of a table in folders by ``month``."""
    files = listed(spark, source).withColumn("month", F.col("month").cast("string"))
    own = files.select("month").distinct()
    reach = own.select("month", F.explode(months_back(F.col("month"), lookback_days)).alias("input"))
    rows = reach.join(files.withColumnRenamed("month", "input"), "input").select("month", "path", "length", "modificationTime")
    return fingerprints(rows, ["month"], contract).drop("n_files")


def manifests(spark: SparkSession, target: str) -> DataFrame:
    """The newest manifest of each month."""
    found = records.read(spark, f"{target.rstrip('/')}/manifests", MANIFEST)
    return found.groupBy("month").agg(F.max_by(F.struct(*found.columns), "build").alias("m")).select("m.*")


def outputs(spark: SparkSession, target: str) -> DataFrame:
    """build, month, output, n_files: fingerprints of the files that builds have written, as they are now."""
    at = f"{target.rstrip('/')}/data"
    if not records.exists(spark, at):
        return spark.createDataFrame([], "build long, month string, output string, n_files long")
    files = listed(spark, at).select(F.col("build").cast("long").alias("build"), F.col("month").cast("string").alias("month"), "path", "length", "modificationTime")
    return fingerprints(files, ["build", "month"], "").withColumnRenamed("fingerprint", "output")


def stale_months(spark: SparkSession, source: str, target: str, contract: str, lookback_days: int) -> DataFrame:
    """month, fingerprint of what must be built: inputs, contract or output differ from the newest manifest."""
    wanted = input_fingerprints(spark, source, contract, lookback_days)
    known = manifests(spark, target).where(F.col("contract") == contract)
    there = outputs(spark, target)
    sound = known.where("n_files > 0").join(there, ["build", "month", "output", "n_files"], "left_semi").unionByName(
        known.where("n_files = 0").join(there, ["build", "month"], "left_anti"))
    return wanted.join(sound.select("month", "fingerprint"), ["month", "fingerprint"], "left_anti")


def build_months(
    spark: SparkSession, source: str, target: str, build: Callable[[DataFrame], DataFrame], ts: str, contract: str, lookback_days: int = 0,
) -> list[str]:
    """Build the stale months of ``target`` from ``source`` (folders by month=yyyy-MM) and say which these were.

    ``build`` gets the rows of a run of months with the look-back before them, and gives rows with the time ``ts``.  Months are read by
    folder, so what isn't stale, nor looked back on, isn't read.  The data is written first and the manifests last: a build that
    fails leaves the months as they were.
    """
    stale = {r.month: r.fingerprint for r in stale_months(spark, source, target, contract, lookback_days).collect()}  # a row a month
    if not stale:
        return []
    serial = time.time_ns()
    at = f"{target.rstrip('/')}/data"
    months = spark.createDataFrame(sorted(stale.items()), "month string, fingerprint string")
    inputs = sorted({m for r in months.select(months_back(F.col("month"), lookback_days).alias("x")).collect() for m in r.x})
    rows = build(spark.read.parquet(source).where(F.col("month").cast("string").isin(inputs)).drop("month"))
    month = F.date_format(ts, "yyyy-MM")
    own = rows.where(month.isin(sorted(stale))).withColumns({"build": F.lit(serial), "month": month})
    own.repartition("month").write.mode("append").partitionBy("build", "month").parquet(at)
    made = outputs(spark, target).where(F.col("build") == serial).drop("build")
    told = months.join(made, "month", "left").select(
        F.lit(serial).alias("build"), "month", "fingerprint", F.lit(contract).alias("contract"), "output", F.coalesce("n_files", F.lit(0)).alias("n_files"))
    records.append(spark, f"{target.rstrip('/')}/manifests", MANIFEST, told)
    return sorted(stale)


def built(spark: SparkSession, target: str) -> DataFrame:
    """The current rows of all months, by manifest: other builds' folders are pruned."""
    current = [f"{r.build}/{r.month}" for r in manifests(spark, target).where("n_files > 0").collect()]  # a row a month
    rows = spark.read.parquet(f"{target.rstrip('/')}/data")
    return rows.where(F.concat_ws("/", F.col("build").cast("string"), F.col("month").cast("string")).isin(current)).drop("build", "month")
