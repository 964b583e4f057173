"""Exact deduplication by a stateful stream with disk-backed keyed state.

Every row becomes a fingerprint (digest, doc_id, row locator).  A stream reads
the fingerprints in micro-batches into RocksDB state keyed by digest, which
never expires: each entry holds the largest doc_id, the locator of its row and
the number of rows.  When the stream has ended, the state is the answer; for
every digest hit more than once, the full bytes are compared, and texts that
only share a digest become groups of their own.

Edge cases: a null text counts as empty; a null doc_id is smaller than any
other; of repeated rows with the same doc_id exactly one is kept; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, broadcast_small, documents, row_of, shared_dir, stable, without_rows

_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    # Many small stores share an executor: small buffers, and stores of ended streams go soon.
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "2",
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
    # State is dealt over many partitions; none needs disk set aside for it.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _normalised(docs: DataFrame) -> Column:
    return ascii_lower(F.coalesce(docs["text"].cast("string"), F.lit("")))


def _stream_state(fingerprints: DataFrame, path: str, batch_bytes: int) -> DataFrame:
    """One row per digest: keep (doc_id, locator) and n, from the stream's state."""
    spark = fingerprints.sparkSession
    before = {k: spark.conf.get(k, None) for k in _STATE_CONF}
    for k, v in _STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        keyed = (
            spark.readStream.schema(fingerprints.schema)
            .option("maxBytesPerTrigger", batch_bytes)
            .parquet(path)
            .groupBy("digest")
            .agg(
                F.max(F.struct("doc_id", "locator")).alias("keep"),
                F.count(F.lit(1)).alias("n"),
            )
        )
        state_at = shared_dir(spark, "exact-state")
        run = (
            keyed.writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", state_at)
            .trigger(availableNow=True)
            .start()
        )
        run.awaitTermination()
        state = spark.read.format("statestore").load(state_at)
        value = state.schema["value"].dataType.names
        return state.select(
            F.col("key.digest").alias("digest"),
            F.col(f"value.`{value[0]}`").alias("keep"),
            F.col(f"value.`{value[1]}`").alias("n"),
        )
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def exact_dedup(
    docs: DataFrame,
    batch_bytes: int = 4 << 30,
    digest: Callable[[Column], Column] = sha256_digest,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, locator, digest, keep_id, group_size, kept.

    ``batch_bytes`` bounds the fingerprints of a micro-batch.  ``digest`` may be
    weak: groups are told apart by their full bytes.
    """
    spark, docs = docs.sparkSession, stable(docs)
    text = _normalised(docs)
    path = shared_dir(spark, "exact-fingerprints")
    docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        row_of(docs).alias("locator"),
        digest(text).alias("digest"),
    ).write.parquet(path)
    prints = spark.read.parquet(path)
    if prints.isEmpty():
        return prints.select(
            "doc_id", "locator", "digest", F.col("doc_id").alias("keep_id"),
            F.lit(0).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        )
    state_at = shared_dir(spark, "exact-groups")
    _stream_state(prints, path, batch_bytes).write.parquet(state_at)
    state = spark.read.parquet(state_at)

    # Full bytes on hits: the least and the greatest text of a digest must be equal.
    hits = broadcast_small(state.where("n > 1").select("digest"))
    body = docs.select(digest(text).alias("digest"), text.alias("body"))
    collided = (
        body.join(hits, "digest")
        .groupBy("digest")
        .agg(F.min("body").alias("least"), F.max("body").alias("most"))
        .where("least <> most")
        .select("digest")
    )
    collided_at = shared_dir(spark, "exact-collided")
    collided.write.parquet(collided_at)
    collided = spark.read.schema(collided.schema).parquet(collided_at)

    shown = lambda df: df.select(
        "doc_id", "locator", "digest",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("locator") == F.col("keep.locator")).alias("kept"),
    )
    if collided.isEmpty():
        return shown(prints.join(state, "digest"))
    told = (
        docs.select(
            docs["doc_id"].cast("long").alias("doc_id"),
            row_of(docs).alias("locator"),
            digest(text).alias("digest"),
            text.alias("body"),
        )
        .join(collided, "digest", "left_semi")
    )
    own = told.groupBy("digest", "body").agg(
        F.max(F.struct("doc_id", "locator")).alias("keep"), F.count(F.lit(1)).alias("n")
    )
    return shown(prints.join(state.join(collided, "digest", "left_anti"), "digest")).unionByName(
        shown(told.join(own, ["digest", "body"]))
    )


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with its own columns.  Rows go by their locators, so texts need not meet."""
    docs = stable(docs)
    return without_rows(docs, exact_dedup(docs, **options).where("NOT kept").select(F.col("locator").alias("row")))


def op7_exact_dedup(spark, sf_dir):
    return exact_dedup(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


OP7_SQL = """
WITH n AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, CAST(count(*) OVER g AS BIGINT) AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM n WINDOW g AS (PARTITION BY text_sha256)
"""
