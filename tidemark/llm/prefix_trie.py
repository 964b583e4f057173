"""Prefix trie of conversations by time-forward processing.

Every conversation is rebuilt with the first turns of its base; each distinct
sequence of first turns is a node.  Totals of subtrees go from nodes to their
parents as messages: in a shard the nodes come sorted by reverse level order
(Spark's external sort), a node takes what its children have sent from a
priority queue, which spills, adds its own and sends the sum on.

Shards are whole subtrees of at most ``shard_rows`` rows, whose roots' totals are
summed by parent, and bands of ``levels`` levels of the nodes above them.  Where those
nodes reach deeper than one band, the roots of the bands are a tree of their own,
which is gone through likewise before their totals go into the bands, so that
a very long conversation is dealt out too.

Nodes are known by sums of SHA-256 lanes of (depth, turn): such sums are added up in blocks, so
no task needs a whole conversation, and a parent's is had by subtraction.  All
members of a node are checked to share parent and last turn, which makes nodes
exact by induction, SHA-256 given; a mismatch is an error.

Edge cases: turns are ordered by turn (null first), then by the SHA-256 of role
and text; a null role or text is empty; equal rows are turns of their own; rows without a conv_id
belong to no conversation; a conversation whose turns all go is turnless and a
member of the root alone; an empty table gives an empty result, without a root;
texts of any length are taken whole, once, for their digests; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import save, word_count

BASE, HEADS = 20, 4
#: Turns of a block, in which the sums of a conversation are made; levels of a band.
BLOCK, LEVELS = 1024, 1024
#: Decimal ids that are put together before the ends of a node meet.
CHUNK = 4096
LANES = 4
#: Messages that a queue holds in memory.
HELD = 100_000


def hex_lanes(digest: Column, count: int = LANES) -> list[Column]:
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(count)]


def slim_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest of role and text, words of the text."""
    role, text = (F.coalesce(conversations[c].cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    return conversations.where(conversations["conv_id"].isNotNull()).select(
        conversations["conv_id"].cast("long").alias("conv_id"), conversations["turn"].cast("long").alias("turn"), digest.alias("digest"), word_count(text).alias("words"))


def numbered(turns: DataFrame) -> DataFrame:
    """conv_id, pos, digest, words.  Turns are sorted by ranges, so that a long conversation fills several tasks; these count what came before."""
    order = ["conv_id", F.col("turn").asc_nulls_first(), "digest"]
    placed = save(turns.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", "digest", "words", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "trie-turns")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    parts = placed.groupBy("conv_id", "part").agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("rows"))
    starts = parts.select("conv_id", "part", (F.col("low") - F.coalesce(F.sum("rows").over(before), F.lit(0))).alias("start"))
    return placed.join(starts, ["conv_id", "part"]).select("conv_id", (F.col("at") - F.col("start")).alias("pos"), "digest", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, total turns) and their rebuilt turns (conv_id, depth from 1, digest, words, left: the turns after it)."""
    lengths = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    convs = lengths.select("conv_id", "own", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % BASE).alias("base"))
    convs = convs.join(lengths.select(F.col("conv_id").alias("base"), F.col("own").alias("there")), "base", "left")
    convs = convs.withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    convs = save(convs.withColumn("total", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "trie-conversations")
    heads = turns.where(F.col("pos") < HEADS - 1).select(F.col("conv_id").alias("base"), "pos", "digest", "words")
    first = convs.where("taken > 0").select("base", "conv_id", "taken", "total").join(heads, "base").where("pos < taken")
    rest = turns.join(convs.select("conv_id", "h", "taken", "total"), "conv_id").where("pos >= h")
    shown = lambda df, depth: df.select("conv_id", depth.alias("depth"), "digest", "words", (F.col("total") - depth).alias("left"))
    pos = F.col("pos")
    return convs.select("conv_id", "total"), shown(first, pos + 1).unionByName(shown(rest, pos - F.col("h") + F.col("taken") + 1))


def _key(depth: Column, sums: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", depth.cast("string"), *[s.cast("string") for s in sums]).cast("binary")))


def paths(convs: DataFrame, turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for each conversation and depth, 0 included: key of the node, of its parent, the last turn, and the turns left."""
    lanes = [f"x{i}" for i in range(LANES)]
    mixed = F.sha2(F.concat(F.col("digest"), F.col("depth").cast("string").cast("binary")), 256)
    rows = turns.withColumn("mixed", mixed).withColumns(dict(zip(lanes, hex_lanes(F.col("mixed"))))).drop("mixed")
    rows = rows.withColumn("block", F.floor((F.col("depth") - 1) / block))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each block
    bases = rows.groupBy("conv_id", "block").agg(*[F.sum(x).alias(x) for x in lanes])
    bases = bases.select("conv_id", "block", *[F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"b{x}") for x in lanes])
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"s{x}": F.sum(x).over(inside) for x in lanes}).join(bases, ["conv_id", "block"])
    sums = [F.col(f"b{x}") + F.col(f"s{x}") for x in lanes]
    depth = F.col("depth")
    made = rows.select("conv_id", "depth", _key(depth, sums).alias("key"),
                       _key(depth - 1, [s - F.col(x) for s, x in zip(sums, lanes)]).alias("parent"), "digest", "words", "left")
    none = lambda kind: F.lit(None).cast(kind)
    zero = F.lit(0).cast("long")
    roots = convs.select("conv_id", zero.alias("depth"), _key(zero, [zero] * LANES).alias("key"), none("binary").alias("parent"),
                         none("binary").alias("digest"), zero.alias("words"), F.col("total").alias("left"))
    return roots.unionByName(made)


class SpillingQueue:
    """Smallest first; beyond ``held`` items sorted runs go to files of the task, which vanish with it."""

    def __init__(self, held: int = HELD):
        self.held = held
        self.heap: list[tuple] = []
        self.runs: list[tuple] = []  # first item, number, the rest
        self.spilled = 0

    def put(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.held:
            self.heap.sort()
            file = tempfile.TemporaryFile()
            for low in range(0, len(self.heap), 1024):
                pickle.dump(self.heap[low : low + 1024], file)
            file.seek(0)
            self.heap = []
            self.spilled += 1
            self._ahead(self.spilled, self._run(file))

    @staticmethod
    def _run(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    some = pickle.load(file)
                except EOFError:
                    return
                yield from some

    def _ahead(self, number: int, run: Iterator[tuple]) -> None:
        if item := next(run, None):
            heapq.heappush(self.runs, (item, number, run))

    def first(self) -> tuple | None:
        tops = self.heap[:1] + [r[0] for r in self.runs[:1]]
        return min(tops, default=None)

    def pop(self) -> tuple:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            item, number, run = heapq.heappop(self.runs)
            self._ahead(number, run)
            return item
        return heapq.heappop(self.heap)


def _passing_up(held: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, queue = None, SpillingQueue(held)
        for batch in batches:
            leaves, saved = [], []
            for s, level, key, parent, n, v in zip(*(batch.column(c).to_pylist() for c in ("shard", "level", "key", "up", "leaves", "saved"))):
                if s != shard:
                    if queue.first():
                        raise ValueError("a message has no receiver")
                    shard = s
                while (top := queue.first()) and top[:2] == (-level, key):
                    n, v = n + top[2], v + top[3]
                    queue.pop()
                leaves.append(n)
                saved.append(v)
                if key != s:
                    queue.put((1 - level, parent, n, v))
            for name, values in (("leaves", leaves), ("saved", saved)):
                batch = batch.set_column(batch.schema.get_field_index(name), name, pa.array(values, pa.int64()))
            yield batch
        if queue.first():
            raise ValueError("a message has no receiver")

    return run


def time_forward(nodes: DataFrame, held: int = HELD) -> DataFrame:
    """``nodes`` with leaves and saved summed over their subtrees in their shard.  A shard is connected, and named by its root's key;
    ``up`` is the key of the parent, one level above."""
    ordered = nodes.repartition("shard").sortWithinPartitions("shard", F.col("level").desc(), "key")
    return ordered.mapInArrow(_passing_up(held), nodes.schema)


def _with_messages(nodes: DataFrame, sent: DataFrame) -> DataFrame:
    """Add what other shards' roots, of ``sent``, have to say to their parents among ``nodes``."""
    sums = sent.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    got = nodes.join(sums, "key", "left")
    return got.withColumns({c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in ("leaves", "saved")}).drop("more_leaves", "more_saved")


def subtree_totals(nodes: DataFrame, path: DataFrame, shard_rows: int, levels: int = LEVELS, held: int = HELD) -> DataFrame:
    """``nodes`` (conv_id, depth, key, parent, below, parent_below, leaves, saved of their own ...) with the totals of their subtrees."""
    low = F.col("below") <= shard_rows
    roots = nodes.where(low & (F.col("parent").isNull() | (F.col("parent_below") > shard_rows))).select("key")
    # A conversation passes one root of a shard at most.
    shard_of = path.select("conv_id", "key").join(roots, "key").select("conv_id", F.col("key").alias("shard"))
    small = nodes.where(low).join(shard_of, "conv_id").withColumns({"level": F.col("depth"), "up": F.col("parent")})
    small = save(time_forward(small, held), "trie-shards")

    anchors = path.where(F.col("depth") % levels == 0).select("conv_id", F.col("depth").alias("anchor"), F.col("key").alias("shard"))
    above = nodes.where(~low).withColumn("anchor", F.col("depth") - F.col("depth") % levels).join(anchors, ["conv_id", "anchor"])
    above = above.withColumns({"level": F.col("depth"), "up": F.col("parent")})
    above = save(_with_messages(above, small.where("key = shard")), "trie-above")
    totals = save(time_forward(above, held), "trie-bands")
    tops = totals.where("key = shard")
    if not tops.where("depth > 0").isEmpty():
        # Across the roots of bands: their tree, with the band above as parent and the number of bands as level.
        upper = anchors.select("conv_id", (F.col("anchor") + levels).alias("depth"), F.col("shard").alias("over"))
        tree = tops.join(upper, ["conv_id", "depth"], "left").withColumns({"level": F.floor(F.col("depth") / levels), "up": F.col("over")})
        whole = _key(F.lit(0).cast("long"), [F.lit(0).cast("long")] * LANES)
        full = time_forward(tree.withColumn("shard", whole), held)
        totals = time_forward(_with_messages(above, full), held)
    names = [c for c in nodes.columns]
    return small.select(*names).unionByName(totals.select(*names))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one key's ascending ids as decimal text."""
    key, ids = None, []

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"key": pa.array([key], pa.binary()), "first": pa.array([ids[0]], pa.int64()), "ids": [",".join(map(str, ids))]})

    for batch in batches:
        for k, c in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (k != key or len(ids) == CHUNK):
                yield made()
                ids = []
            key = k
            ids.append(c)
    if ids:
        yield made()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, digest = None, None
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if k != key:
                if digest:
                    done.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield _digest_rows(done)
    if digest:
        yield _digest_rows([(key, digest.hexdigest())])


def _digest_rows(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=["key", "ends_sha256"])


def ends(path: DataFrame) -> DataFrame:
    """key, ends_sha256 of the nodes where conversations end: ids are sorted by ranges and put together in chunks, a node's chunks stream into its digest."""
    ended = path.where("left = 0").select("key", "conv_id")
    chunks = ended.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(_chunks, "key binary, first long, ids string")
    return chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digests, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, shard_rows: int | None = None, levels: int = LEVELS, block: int = BLOCK, held: int = HELD) -> DataFrame:
    """One row per node; see the module's text.  ``shard_rows``: of a whole subtree in a shard, else the root of the number of nodes, 1,024 at least."""
    turns = numbered(save(slim_turns(conversations), "trie-slim"))
    convs, turns = rebuilt(turns)
    path = save(paths(convs, turns, block), "trie-paths")
    one = lambda c: F.when(F.min(c).eqNullSafe(F.max(c)), F.min(c)).otherwise(F.raise_error(F.lit("two prefixes share a key")))
    nodes = save(path.groupBy("depth", "key").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), one("parent").alias("parent"), one("digest").alias("digest"),
        F.max("words").alias("words"), (F.sum("left") + 1).alias("below")), "trie-nodes")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("below").alias("parent_below"))
    known = nodes.drop("digest").join(children, "key", "left").join(parents, "parent", "left")
    known = save(known.withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)), "leaves": F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long"),
        "saved": (F.col("n_convs") - 1) * F.col("words")}), "trie-known")
    rows = shard_rows or max(1024, math.isqrt(known.count()))
    totals = subtree_totals(known, path, rows, levels, held).join(ends(path), "key", "left")
    return totals.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP13_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
           lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END)), 4294967295) % 4 AS h,
         list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS own
  FROM t GROUP BY conv_id),
r AS (
  SELECT c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) AS s FROM c LEFT JOIN c AS b ON b.conv_id = c.base),
m AS (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS depth FROM r),
g AS (
  SELECT depth, s[1:depth] AS q, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(s) = depth), '')) AS ends_sha256
  FROM m GROUP BY ALL),
k AS (SELECT depth - 1 AS depth, q[1:depth - 1] AS q, count(*) AS n_children FROM g WHERE depth > 0 GROUP BY ALL),
f AS (
  SELECT g.*, coalesce(n_children, 0) AS n_children,
         CASE WHEN g.depth = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(g.q[-1].text, '[^\x20\x09-\x0D]+')) END AS own
  FROM g LEFT JOIN k ON k.depth = g.depth AND k.q = g.q),
u AS (SELECT q, own, n_children, unnest(range(0, depth + 1)) AS above FROM f),
v AS (SELECT above AS depth, q[1:above] AS q, sum(own) AS saved, count(*) FILTER (n_children = 0) AS leaves FROM u GROUP BY ALL)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, v.leaves AS n_leaves, CAST(v.saved AS BIGINT) AS saved_tokens, f.ends_sha256
FROM f JOIN v ON v.depth = f.depth AND v.q = f.q LEFT JOIN f AS p ON p.depth = f.depth - 1 AND p.q = f.q[1:f.depth - 1]
"""
