"""Reconciliation of a partitioned table: targets are reloaded, everything else is shown to have stayed, and only checks that ran can pass."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import content_digests
from tidemark.sources.scratch import scratch


@dataclass
class Report:
    """``partitions``: partition, action (kept or reloaded), n_rows, changed.  Status PASS needs every check to have passed and no blocker."""

    mode: str
    targets: list[str]
    checks: dict[str, str]
    blockers: list[str] = field(default_factory=list)
    partitions: DataFrame | None = None

    @property
    def status(self) -> str:
        return "PASS" if not self.blockers and all(s == "PASS" for s in self.checks.values()) else "FAIL"


def digests(spark: SparkSession, table: str, partition: str) -> DataFrame:
    """partition, n_rows, digest, saved so that they are those of now."""
    rows = spark.read.parquet(table)
    at = scratch(spark, "digests")
    content_digests(rows.withColumn(partition, F.col(partition).cast("string")), [partition]).write.parquet(at)
    return spark.read.parquet(at)


def _differ(a: DataFrame, b: DataFrame, partition: str) -> bool:
    """Whether two tables of digests differ in any partition."""
    side = lambda d, n: d.select(partition, F.struct("n_rows", "digest").alias(n))
    both = side(a, "a").join(side(b, "b"), partition, "full_outer")
    return not both.where(~F.col("a").eqNullSafe(F.col("b"))).isEmpty()


def reconcile(
    spark: SparkSession, table: str, partition: str, targets: list[str], reload: Callable[[list[str]], DataFrame], backup: str,
    checks: dict[str, Callable[[], bool]], rebuild: Callable[[list[str]], bool] | None = None,
) -> Report:
    """Reload the target partitions of ``table`` from ``reload`` and prove the rest untouched.

    In turn: digests of all partitions; a backup of the targets, read back and compared; the new rows, which must lie in the targets,
    replace them; digests again: targets must be what was reloaded, all others what they were.  ``rebuild`` brings what depends on the
    targets up to date, and says whether it reached everything that looks back on them.  Then the checks run.  A step that fails
    stops the rest, whose checks stay NOT_RUN; without targets nothing is written, and the checks alone decide.
    """
    targets = sorted({str(t) for t in targets})
    report = Report("targeted_reload" if targets else "no_op_certification", targets, dict.fromkeys(checks, "NOT_RUN"))
    try:
        before = digests(spark, table, partition)
        if targets:
            aimed = F.col(partition).cast("string").isin(targets)
            spark.read.parquet(table).where(aimed).write.partitionBy(partition).parquet(backup)
            if not before.where(aimed).isEmpty() and _differ(before.where(aimed), digests(spark, backup, partition), partition):
                raise RuntimeError("backup_differs")
            staged = scratch(spark, "reload")
            columns = spark.read.parquet(table).schema
            fresh = reload(targets).select(*[F.col(f.name).cast(f.dataType) for f in columns.fields])
            fresh.write.parquet(staged)
            fresh = spark.read.parquet(staged)
            if not fresh.where(~F.coalesce(aimed, F.lit(False))).isEmpty():
                raise RuntimeError("reload_outside_targets")
            reloaded = content_digests(fresh.withColumn(partition, F.col(partition).cast("string")), [partition])
            fresh.repartition(partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(table)
            spark.catalog.refreshByPath(table)
            after = digests(spark, table, partition)
            if _differ(before.where(~aimed), after.where(~aimed), partition):
                report.blockers.append("unaffected_partitions_changed")
            if _differ(reloaded, after.join(reloaded.select(partition), partition, "left_semi"), partition):
                report.blockers.append("reload_unverified")
        else:
            after = before
        was = before.select(partition, F.col("digest").alias("__was"))
        action = F.when(F.col(partition).isin(targets), "reloaded").otherwise("kept") if targets else F.lit("kept")
        report.partitions = after.join(was, partition, "left").select(
            partition, action.alias("action"), "n_rows", (~F.col("digest").eqNullSafe(F.col("__was"))).alias("changed"))
        if targets and rebuild is not None and not rebuild(targets):
            report.blockers.append("lookback_unverified")
        for name, check in checks.items():
            report.checks[name] = "PASS" if check() else "FAIL"
        report.blockers += [name for name, s in report.checks.items() if s != "PASS"]
    except Exception as error:
        report.blockers.append(str(error) if isinstance(error, RuntimeError) else "reconciliation_operation_failed")
    return report
