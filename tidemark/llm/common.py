"""Helpers that the training-data operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a maximal run of characters other than space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"

#: A table is broadcast only when a count has shown it to hold no more rows.
BROADCAST_ROWS = 200_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share.

    The cluster names it in ``spark.checkpoint.dir``.  Where that is unset and
    all executors are threads of the driver, as in tests, a temporary folder is
    made and kept for the session; on a cluster that is an error, for executors
    would write where nobody reads.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "tidemark.shared.dir", None
    )
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("on a cluster, spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("tidemark.shared.dir", root)
    path = f"{root.rstrip('/')}/tidemark-{name}-{uuid.uuid4().hex}"
    for made in _MADE:
        made.append(path)
    return path


#: Of the open blocks of ``intermediates_removed``: the paths that were given out in each.
_MADE: list[list[str]] = []


@contextmanager
def intermediates_removed(spark: SparkSession):
    """Remove the shared folders that are made within this block when it ends: what was computed must be written by then."""
    _MADE.append([])
    try:
        yield
    finally:
        for path in _MADE.pop():
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stable(docs: DataFrame) -> DataFrame:
    """``docs`` if it is a scan of files, with columns and filters at most; anything else is saved first, so that its rows can be numbered."""
    plans = [docs._jdf.queryExecution().analyzed()]
    for plan in plans:
        if plan.nodeName() not in ("Project", "Filter", "SubqueryAlias", "View", "LogicalRelation"):
            return save(docs, "rows")
        children = plan.children()
        plans += [children.apply(i) for i in range(children.size())]
    return docs


def fresh(docs: DataFrame, name: str) -> str:
    """``name`` with so many underscores before it that no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def without_rows(docs: DataFrame, lost: DataFrame) -> DataFrame:
    """``docs`` without the rows whose numbers are in ``lost`` (row); the same columns.  Texts are shuffled only if many rows go."""
    row = fresh(docs, "__row")
    lost = save(lost.select(F.col("row").alias(row)), "lost-rows")
    return docs.withColumn(row, row_of(docs)).join(broadcast_small(lost), row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def row_of(docs: DataFrame) -> Column:
    """A row number that every scan of ``docs`` gives alike; it must be ``stable``.

    Files are split by size and by the cores at hand; a lost executor would change the latter between two scans,
    so the number of splits is pinned for the session where it isn't set.
    """
    spark, name = docs.sparkSession, "spark.sql.files.minPartitionNum"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(max(1, spark.sparkContext.defaultParallelism)))
    return F.monotonically_increasing_id()


def text_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand texts to Python in smaller batches than rows of numbers, unless the session sets a size of its own.

    The default of 10,000 rows would hold tens of megabytes of text in each task, on both sides.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(rows))


def parts(texts: pa.Array, rows: int = 128, most: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Bounds of runs of so many rows and bytes at most; a text beyond that is a run of its own."""
    low = held = 0
    for i, size in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if i > low and (i - low >= rows or held + size > most):
            yield low, i
            low, held = i, 0
        held += size
    if len(texts):
        yield low, len(texts)


def broadcast_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if a count shows at most ``limit`` rows.

    Beyond the limit Spark joins by shuffle, and adaptive execution splits
    skewed keys.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does just that on pure ASCII, and faster."""
    return F.when(F.length(col) == F.octet_length(col), F.lower(col)).otherwise(
        F.translate(col, _UPPER, _UPPER.lower())
    )


def word_count(col: Column) -> Column:
    return F.regexp_count(F.coalesce(col, F.lit("")), F.lit(WORD)).cast("long")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
