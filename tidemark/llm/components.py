"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import remove, shared_dir


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step.  Least neighbours are pre-aggregated before the shuffle, so hubs don't meet in a task."""
    if large:
        arms = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        arms = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = arms.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = arms.join(least, "a")
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # A node without greater neighbours keeps its link to the least one.
        return moved.where("a <> b").distinct()
    own = least.select("a", F.col("m").alias("b"))
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own).where("a <> b").distinct()


def components(links: DataFrame, most_rounds: int = 64) -> DataFrame:
    """id, root (the least id of its component) for every id in ``links`` (a, b)."""
    spark = links.sparkSession

    def written(df: DataFrame, before: str | None = None) -> tuple[DataFrame, str]:
        """The frame, saved; the round before isn't needed then."""
        path = shared_dir(spark, "stars")
        df.write.parquet(path)
        if before:
            remove(spark, before)
        return spark.read.schema(df.schema).parquet(path), path

    links, path = written(links.where("a <> b").distinct())
    mark = None
    for _ in range(most_rounds):
        links, path = written(_star(_star(links, True), False), path)
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("the components have not settled")
    roots = links.select(F.col("b").alias("id")).distinct()
    return links.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(
        roots.select("id", F.col("id").alias("root"))
    )
