"""Streams: tumbling bars with a watermark, and last-wins state for late corrections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import micros
from tidemark.sources import records
from tidemark.sources.scratch import scratch
from tidemark.streaming.checkpoints import bound_checkpoint


def source(spark: SparkSession, path: str) -> DataFrame:
    """A file stream of events; the schema is that of the table, which must be known before it starts.

    The table may be a folder or one file: as a pattern, the path stands for either.
    """
    pattern = f"{path[:-1]}[{path[-1]}]"
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxBytesPerTrigger", 4 << 30).parquet(pattern)


def minute_bars(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Counts, extremes and sums of closed minutes; state of a minute goes when the watermark has passed it."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", delay)
    return timed.groupBy("event_type", F.window("at", "1 minute")).agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("high"), F.min("value").alias("low"), F.sum("value").alias("total")
    ).select("event_type", F.col("window.start").cast("timestamp_ntz").alias("timestamp_m1"), "n", "high", "low", "total")


def last_wins(events: DataFrame) -> DataFrame:
    """The newest row of each key and how many there were: a correction that comes late replaces what it corrects."""
    newest = F.max(F.struct("ts", "event_id", "value")).alias("newest")
    return events.groupBy("user_id").agg(newest, F.count(F.lit(1)).alias("n")).select(
        "user_id", F.col("newest.ts").alias("ts"), F.col("newest.value").alias("value"), "n"
    )


def _run(df: DataFrame, name: str) -> DataFrame:
    """Run a stream of updates to its end; the last update of each key is its state."""
    spark = df.sparkSession
    out, at = scratch(spark, name), scratch(spark, f"{name}-state")

    def write(batch: DataFrame, n: int) -> None:
        batch.withColumn("__batch", F.lit(n)).write.mode("append").parquet(out)

    run = df.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", at).trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.parquet(out)


PROGRESS = "batch long, newest long"


def partial_bars(spark: SparkSession, path: str, out: str, checkpoint: str, delay_seconds: int = 86_400, files_a_batch: int = 1000) -> None:
    """Follow the files that come to ``path`` and write each micro-batch's share of the bars, which no lateness can lose.

    A share has count, extremes, sum and whether it is late: its minute had closed before the batch, ``delay_seconds`` behind the newest row of
    all batches before.  A batch that is replayed writes its folder again.
    """
    progress = f"{checkpoint.rstrip('/')}/progress"

    def write(batch: DataFrame, n: int) -> None:
        before = records.read(spark, progress, PROGRESS).where(F.col("batch") < n).agg(F.max("newest")).first()[0]
        start = F.date_trunc("minute", "ts").cast("timestamp_ntz")
        late = F.lit(False) if before is None else micros(F.col("timestamp_m1")) + 60_000_000 <= before - delay_seconds * 1_000_000
        share = batch.groupBy("event_type", start.alias("timestamp_m1")).agg(
            F.count(F.lit(1)).alias("n"), F.max("value").alias("high"), F.min("value").alias("low"), F.sum("value").alias("total"), F.max(micros(F.col("ts"))).alias("newest"))
        at = f"{out.rstrip('/')}/batch={n}"
        share.withColumn("late", late).write.mode("overwrite").parquet(at)
        newest = spark.read.parquet(at).agg(F.max("newest")).first()[0]
        records.append(spark, progress, PROGRESS, [(n, newest)])

    rows = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_a_batch)
    run = rows.parquet(f"{path[:-1]}[{path[-1]}]").writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint.rstrip('/')}/stream").trigger(availableNow=True).start()
    run.awaitTermination()


def whole_bars(spark: SparkSession, out: str) -> DataFrame:
    """The bars of all shares so far; ``revised`` if a share came after its minute had closed."""
    shares = spark.read.parquet(out)
    return shares.groupBy("event_type", "timestamp_m1").agg(
        F.sum("n").alias("n"), F.max("high").alias("high"), F.min("low").alias("low"), F.sum("total").alias("total"), F.bool_or("late").alias("revised"))


def late_months(spark: SparkSession, out: str) -> DataFrame:
    """event_type, month, n: closed months that late rows have changed, for whatever was built of them."""
    late = spark.read.parquet(out).where("late")
    return late.groupBy("event_type", F.date_format("timestamp_m1", "yyyy-MM").alias("month")).agg(F.sum("n").alias("n"))


def run_minute_bars(spark: SparkSession, path: str, delay_seconds: int = 86_400) -> DataFrame:
    """The table's minutes, from a stream that is run to its end: all of its rows, in whatever order and batches they come."""
    out = scratch(spark, "stream-bars")
    partial_bars(spark, path, out, scratch(spark, "stream-bars-state"), delay_seconds)
    return whole_bars(spark, out).drop("revised")


def follow_minute_bars(spark: SparkSession, path: str, out: str, checkpoint: str, delay: str = "10 minutes") -> None:
    """Append the minutes that have closed since the last run to ``out``: each once, whatever fails between.

    ``path``: a folder that gets files.  ``checkpoint`` keeps what was read and the open minutes from run to run, so a run
    reads the new files alone; a minute is written when the watermark, ``delay`` behind the newest row, has passed it.  The checkpoint belongs
    to its plan, input and output: another one is refused.
    """
    bars = minute_bars(source(spark, path), delay)
    own = bound_checkpoint(spark, checkpoint, bars, {"path": path, "out": out, "delay": delay})
    run = bars.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", own).trigger(availableNow=True).start()
    run.awaitTermination()


def run_last_wins(spark: SparkSession, path: str) -> DataFrame:
    from tidemark.operators.dedup import keep_last

    return keep_last(_run(last_wins(source(spark, path)), "stream-last"), ["user_id"], F.col("__batch")).drop("__batch")
