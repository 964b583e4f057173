"""Mixing sources to target weights by a low-discrepancy schedule.

Targets: sources in code point order (null last) have the cyclic weights; the
mix holds ``share`` times all words.  A target stops at ``epochs`` times its
source's size, and what it can't take is reshared by weight: target = min(cap,
level * weight) at the one level where the targets add up.

Schedule: slot t holds the golden-ratio point frac((t + 1/2) * phi), which the
cumulative targets map to a source; a slot's rank among its source's slots is
the number of the block of ``block`` words that it takes.  Blocks that the
schedule leaves out (a small source may meet no point) follow at its end, so
each source has a slot for every block.  The documents of a
source lie shuffled (by MD5 of seed and doc_id, without which the text's own MD5
tells rows apart) in a stream, again for each epoch, and the stream is cut in
blocks of equal words.  A source's last block
ends at its target; later slots of that source are void.

Edge cases: a null source is a source; a null or wordless text has size 0 and
takes 0; repeated rows count each for itself; an empty table gives an empty
result; other columns are ignored.  The order, and so the result, depends on
nothing but the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, broadcast_small, documents, fresh, row_of, save, stable, word_count

PHI = 0.6180339887498949

#: Slots of a chunk are ranked together, chunks by prefix sums.
CHUNK = 1 << 14

#: A bucket of the shuffled order holds about so many documents of the largest source, or their square root if more.
BUCKET_DOCS = 1 << 8

#: Cells of [0, 1) by which slots meet the sources.
CELLS = 1 << 12


def sized_rows(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, a row number and the text's digest where doc_id is null, saved: the text is read once."""
    text = docs["text"].cast("string")
    return save(
        docs.select(
            row_of(docs).alias("row"),  # of a stable table
            docs["doc_id"].alias("doc_id"),
            docs["source"].cast("string").alias("source"),
            word_count(text).alias("size"),
            F.when(docs["doc_id"].isNull(), F.md5(F.coalesce(text, F.lit("")).cast("binary"))).alias("digest"),
        ),
        "mix-sizes",
    )


def targets(sized: DataFrame, weights=(3, 1, 2), share: float = 1.5, epochs: int = 2) -> DataFrame:
    """source_no, source, n, source_size, target, take: one row per source."""
    by_source = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")
    )
    ranked = by_source.withColumn(
        "source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ).withColumn(
        "weight",
        F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") - 1) % len(weights) + 1).cast("double"),
    )
    cap = (F.col("source_size") * epochs).cast("double")
    every = Window.partitionBy()
    before = Window.orderBy("ratio", "source_no").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0.0)
    levelled = (
        ranked.withColumn("cap", cap)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("left", F.sum("source_size").over(every) * share - F.coalesce(F.sum("cap").over(before), none))
        .withColumn("rest", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), none))
        .withColumn("level", F.col("left") / F.col("rest"))
        .withColumn("level", F.first(F.when(F.col("level") <= F.col("ratio"), F.col("level")), True).over(
            Window.orderBy("ratio", "source_no").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    target = F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return save(
        levelled.withColumn("target", target).select(
            "source_no", "source", "n", "source_size", "target",
            F.least(F.round("target"), F.col("cap")).cast("long").alias("take"),
        ),
        "mix-targets",
    )


def _positions(sized: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """row, source_no, size and the place of the words in its source's shuffled stream, of each row that has words."""
    largest = sources.agg(F.max("n")).first()[0] or 0
    buckets = max(1, -(-largest // max(BUCKET_DOCS, math.isqrt(largest))))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("digest")).cast("binary"))  # nulls are skipped
    bucket = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / float(1 << 32) * buckets)
    rows = (
        sized.where("size > 0")  # the others take no place
        .withColumn("source", F.struct("source"))
        .join(broadcast_small(sources.select(F.struct("source").alias("source"), "source_no")), "source")
        .select("row", "doc_id", "source_no", "size", key.alias("key"))
        .withColumn("bucket", bucket)
    )
    sums = rows.groupBy("source_no", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source_no", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    inside = (
        Window.partitionBy("source_no", "bucket")
        .orderBy("key", "doc_id", "size", "row")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = rows.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return placed.join(starts, ["source_no", "bucket"]).select(
        "row", "source_no", "size", (F.col("base") + F.col("before")).alias("start")
    )


def schedule(spark: SparkSession, sources: DataFrame, block: int) -> DataFrame:
    """slot, source_no, block_no: which block of which source fills each slot."""
    total, least = sources.where("take > 0").agg(F.sum("take"), F.min("take")).first()
    if not total:
        return spark.range(0).select(
            F.col("id").alias("slot"), F.lit(0).alias("source_no"), F.col("id").alias("block_no")
        )
    slots = -(-total // block)
    # Discrepancy may delay a source by a few of its turns; slots beyond its need are void.
    slots += min(slots, 8 * -(-total // least)) + 8
    before = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    shares = (
        sources.where("take > 0")
        .withColumn("low", F.coalesce(F.sum("take").over(before), F.lit(0)) / F.lit(float(total)))
        .withColumn("high", F.sum("take").over(Window.orderBy("source_no")) / F.lit(float(total)))
        .select(
            "source_no", "take", "low", "high",
            F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.floor(F.col("high") * CELLS))).alias("cell"),
        )
    )
    point = (F.col("id") + 0.5) * PHI
    points = spark.range(slots).select(F.col("id").alias("slot"), (point - F.floor(point)).alias("u"))
    drawn = (
        points.withColumn("cell", F.floor(F.col("u") * CELLS))
        .join(broadcast_small(shares), "cell")
        .where("u >= low AND u < high")
        .select("slot", "source_no", "take", F.floor(F.col("slot") / CHUNK).alias("chunk"))
    )
    counts = drawn.groupBy("source_no", "chunk").agg(F.count(F.lit(1)).alias("c"))
    earlier = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("source_no", "chunk", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source_no", "chunk").orderBy("slot")
    ranked = (
        drawn.withColumn("nth", F.row_number().over(inside))
        .join(base, ["source_no", "chunk"])
        .withColumn("block_no", F.col("base") + F.col("nth") - 1)
        .where(F.col("block_no") * block < F.col("take"))
        .select("slot", "source_no", "block_no")
    )
    # A source's drawn blocks are its first ones, so those it still needs are the rest.
    missed = (
        sources.where("take > 0")
        .select("source_no", F.ceil(F.col("take") / block).alias("need"))
        .join(counts.groupBy("source_no").agg(F.sum("c").alias("have")), "source_no", "left")
        .withColumn("have", F.coalesce("have", F.lit(0)))
        .withColumn("missed", F.greatest(F.col("need") - F.col("have"), F.lit(0)))
        .withColumn("slot", slots + F.coalesce(F.sum("missed").over(before), F.lit(0)))
        .where("missed > 0")
        .select("slot", "source_no", "have", F.posexplode(F.sequence(F.col("have"), F.col("need") - 1)))
    )
    return ranked.unionByName(
        missed.select((F.col("slot") + F.col("pos")).alias("slot"), "source_no", F.col("col").alias("block_no"))
    )


def mix(sized: DataFrame, sources: DataFrame, block: int = 128, epochs: int = 2, seed: int = 42) -> DataFrame:
    """The mix: slot, row, epoch, first (word of the document), words, at (word of the slot)."""
    placed = _positions(sized, sources, seed).join(
        broadcast_small(sources.select("source_no", "source_size", "take")), "source_no"
    )
    epoch = F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))
    spans = (
        placed.select("*", epoch.alias("epoch"))
        .withColumn("low", F.col("epoch") * F.col("source_size") + F.col("start"))
        .withColumn("high", F.least(F.col("low") + F.col("size"), F.col("take")))
        .where("low < high")
    )
    pieces = spans.select(
        "source_no", "row", "epoch", "low", "high",
        F.explode(F.sequence(F.floor(F.col("low") / block), F.floor((F.col("high") - 1) / block))).alias("block_no"),
    )
    first = F.greatest("low", F.col("block_no") * block)
    return pieces.join(schedule(sized.sparkSession, sources, block), ["source_no", "block_no"]).select(
        "slot", "row", "epoch",
        (first - F.col("low")).alias("first"),
        (F.least("high", (F.col("block_no") + 1) * block) - first).alias("words"),
        (first - F.col("block_no") * block).alias("at"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows with the columns of ``docs``, in the order of the schedule.

    The pieces of a document in one epoch follow its first slot.  A document
    taken whole keeps its text; of one cut by its source's target the taken
    words stay, joined by one space.
    """
    docs = stable(docs)
    sized = sized_rows(docs)
    pieces = mix(sized, targets(sized), **options).join(sized.select("row", "size"), "row")
    taken = pieces.groupBy("row", "epoch", "size").agg(
        F.sum("words").alias("words"), F.min("slot").alias("slot"), F.min_by("at", "slot").alias("at")
    )
    row, words, size, slot, at, chunk = (fresh(docs, f"__{c}") for c in ("row", "words", "size", "slot", "at", "chunk"))
    slim = taken.select(*[F.col(c).alias(own) for c, own in (("row", row), ("words", words), ("size", size), ("slot", slot), ("at", at))])
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), F.col(words).cast("int")), " ")
    out = docs.withColumn(row, row_of(docs)).join(slim, row).withColumn("text", F.when(F.col(words) < F.col(size), cut).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return (
        out.withColumn(chunk, F.floor(F.col(slot) / CHUNK))
        .repartition(chunk)
        .sortWithinPartitions(slot, at, row)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = sized_rows(documents(spark, sf_dir))
    sources = targets(sized)
    taken = mix(sized, sources).groupBy("row").agg(F.sum("words").alias("taken"))
    named = broadcast_small(sources.select(F.struct("source").alias("key"), "source_size", "target"))
    return (
        sized.withColumn("key", F.struct("source"))
        .join(named, "key")
        .join(taken, "row", "left")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5(coalesce(text, '')) AS digest
  FROM documents),
s AS (
  SELECT source, sum(size) AS source_size,
         [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM d GROUP BY source),
l AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
         ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(2.0::DOUBLE * source_size) OVER b, 0))
         / ((sum(weight) OVER ())::DOUBLE - coalesce(sum(weight) OVER b, 0)::DOUBLE) AS level
  FROM s WINDOW b AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT min_by(level, cap / weight) AS level FROM l WHERE level <= cap / weight),
t AS (SELECT source, source_size, least(cap, v.level * weight) AS target FROM l, v),
p AS (
  SELECT d.*, t.source_size, t.target, least(round(target), 2 * t.source_size)::BIGINT AS take,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5('42:' || coalesce(doc_id::VARCHAR, 'null:' || digest)), doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
       (greatest(0, least(start + size, take) - start)
        + greatest(0, least(source_size + start + size, take) - source_size - start))::BIGINT AS taken
FROM p
"""
