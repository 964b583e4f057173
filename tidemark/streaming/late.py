"""Late rows: merged into monthly folders by micro-batches that can be replayed, touching only the months that they change."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.dedup import keep_last
from tidemark.sources import records
from tidemark.sources.scratch import scratch

LEDGER = "batch long, state string, month string, n_rows long"


def merge_batch(batch: DataFrame, number: int, table: str, ledger: str, keys: list[str], ts: str, order: list[str]) -> list[str]:
    """Merge a micro-batch into ``table`` (folders by month=yyyy-MM) and say which months changed.

    Of one key the row with the greatest ``order`` stays; ``keys`` include ``ts``, so a key keeps its month.  The months are planned in
    the ledger before they are rewritten and done afterwards: a batch that is replayed after a failure rewrites the same months with
    the same rows, and one that was done changes nothing.  A row that is there already, or older than what is there, changes nothing either.
    """
    if ts not in keys:
        raise ValueError("the time must be part of the key")
    spark = batch.sparkSession
    told = [r for r in records.read(spark, ledger, LEDGER).where(F.col("batch") == number).collect()]  # a row a month and state
    if any(r.state == "done" for r in told):
        return sorted(r.month for r in told if r.state == "planned")
    order_by = [F.col(c) for c in order]
    new = keep_last(batch, keys, *order_by).withColumn("month", F.date_format(ts, "yyyy-MM"))
    at = scratch(spark, "late-batch")
    new.write.parquet(at)
    new = spark.read.parquet(at)
    planned = sorted(r.month for r in told if r.state == "planned")
    there = records.exists(spark, table)
    old = (spark.read.parquet(table).withColumn("month", F.col("month").cast("string")).select(*new.columns) if there else new.limit(0))
    if not planned:
        months = [r.month for r in new.select("month").distinct().collect()]
        # Only months that the batch has rows of are read: the filter prunes folders.
        before = old.where(F.col("month").isin(months)).select(*keys, F.struct(*new.columns).alias("__old"), F.struct(*order).alias("__old_order"))
        row, place = F.struct(*new.columns), F.struct(*order)
        wins = new.select(*keys, "month", row.alias("__new"), place.alias("__order")).join(before, keys, "left").where(
            F.col("__old").isNull() | ((F.col("__order") > F.col("__old_order")) & ~F.col("__new").eqNullSafe(F.col("__old"))))
        changed = wins.groupBy("month").agg(F.count(F.lit(1)).alias("n_rows")).collect()  # a row a month
        records.append(spark, ledger, LEDGER, [(number, "planned", r.month, r.n_rows) for r in changed] or [(number, "done", None, 0)])
        planned = sorted(r.month for r in changed)
        if not planned:
            return []
    touched = F.col("month").isin(planned)
    merged = keep_last(old.where(touched).unionByName(new.where(touched)), keys, *order_by)
    staged = scratch(spark, "late-merged")
    merged.write.parquet(staged)  # a table can't be overwritten while it is read
    spark.read.parquet(staged).repartition("month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(table)
    records.append(spark, ledger, LEDGER, [(number, "done", None, 0)])
    return planned


def follow_late(spark: SparkSession, source: str, table: str, checkpoint: str, keys: list[str], ts: str, order: list[str], files_a_batch: int = 1000) -> None:
    """Merge the files that have come to ``source`` since the last run into ``table``.  The ledger lives and dies with the checkpoint."""
    rows = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", files_a_batch).parquet(source)
    ledger = f"{checkpoint.rstrip('/')}/ledger"

    def merge(batch: DataFrame, number: int) -> None:
        merge_batch(batch, number, table, ledger, keys, ts, order)

    run = rows.writeStream.foreachBatch(merge).option("checkpointLocation", f"{checkpoint.rstrip('/')}/stream").trigger(availableNow=True).start()
    run.awaitTermination()
