"""Gold tables from sources that lie in buckets: the whole chain of joins shuffles nothing.

Prepared sources and the grid are written in buckets by (exchange, symbol, block
of time).  Rows that join lie in equal buckets then, so Spark joins bucket by
bucket as it reads them; one busy series is spread over the buckets by its blocks.
A source is shuffled once, when it is written, not once for every table that it is part of.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import micros
from tidemark.plans import gold

BLOCK_SECONDS = 86_400
PLACE = ["exchange", "symbol", "block"]
#: Rows of the largest source that a bucket holds on average, and the least number of buckets.
BUCKET_ROWS, LEAST_BUCKETS = 100_000, 16


def buckets_for(rows: int) -> int:
    """So many buckets that one, which is a task of the joins, doesn't grow with the number of rows."""
    return max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))


def store(df: DataFrame, table: str, path: str, buckets: int, block_seconds: int = BLOCK_SECONDS) -> None:
    """Write rows with ``timestamp_m1`` as a table of so many buckets, one file each.  Tables that are joined need equal numbers."""
    rows = df.withColumn("block", F.floor(micros(F.col(gold.KEYS[2])) / (block_seconds * 1_000_000)))
    rows.repartition(buckets, *PLACE).write.bucketBy(buckets, *PLACE).sortBy(*PLACE, gold.KEYS[2]).option("path", path).format("parquet").saveAsTable(table)


def store_sources(dataset: str, sources: dict[str, DataFrame], prefix: str, root: str, buckets: int) -> dict[str, str]:
    """Write the prepared sources of a Gold table, and its grid; name -> table, the grid's name is ``grid``."""
    spark, tables = next(iter(sources.values())).sparkSession, {}
    for name, df in sources.items():
        tables[name] = f"{prefix}_{name}"
        store(gold.prepared(name, df), tables[name], f"{root}/{name}", buckets)
    tables["grid"] = f"{prefix}_grid"
    store(gold.grid_of(dataset, {n: spark.table(t).drop("block") for n, t in tables.items() if n in sources}), tables["grid"], f"{root}/grid", buckets)
    return tables


def build(spark: SparkSession, dataset: str, tables: dict[str, str]) -> DataFrame:
    """The Gold table of stored sources; ``tables`` as ``store_sources`` gives them.

    The buckets' columns are only a part of what the joins are on.  Spark takes that for good enough where it is told to, which is done in
    a session of its own, to which the frame belongs: other joins might get skewed by it, these are cut in blocks.  A bucket is one sorted file,
    so the session lets scans keep that order: the joins are on the columns in the order of the files, and sort nothing.
    """
    required, _ = gold.GOLD[dataset]
    if lacking := [s for s in (*required, "grid") if s not in tables]:
        raise KeyError(f"{dataset} needs {lacking}")
    own = spark.newSession()
    own.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    own.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    for name in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions", "spark.sql.ansi.enabled"):
        own.conf.set(name, spark.conf.get(name))
    ready = {n: own.table(t) for n, t in tables.items()}
    return gold.chained(dataset, ready.pop("grid"), ready, [*PLACE, gold.KEYS[2]], "merge").drop("block")
