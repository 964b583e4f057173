"""SimHash near-deduplication by BK-trees over shards of fingerprints.

A fingerprint bit is set if it is set in over half of the XXH64 values of a
text's word shingles.  A BK-tree keys children by their Hamming distance to the
parent; a search within radius r follows only edges within r of the distance to
the node.  One tree over the corpus could not be broadcast, for it grows with
the corpus; instead, each task builds the trees of its own shards and searches
them for the shard's members.

Links by distance (``fingerprint_components``) are exact.  Two fingerprints that
differ in at most 3 bits agree in one of four 16-bit blocks, so shards are keyed
by block and value; a shard of over ``SHARD`` members is dealt again by four
12-bit blocks of the remaining bits, by the same argument.  Only links of a
spanning forest leave a shard, so a group of copies gives as many rows as it has
members, not as pairs.

Links by similarity (``similar_components``) serve texts whose fingerprints
differ in more bits than blocks can cover: shards are keyed by bands, each of
three minima of rehashed shingles.  Copies of similarity 0.8 share one of fourteen
bands with probability 0.99996; texts that only share a passage, such as a licence
header, seldom have all three minima of a band in it.  Bands that no other row has
go before anything else is dealt out.  Trees are searched within a wide radius, and a one-permutation sketch
of the shingle sets rules out pairs well below the similarity.  What is left,
groups of candidates, is searched again with the shingle sets at hand, and only
pairs of that exact similarity are linked.  Here fingerprints, like sketches,
are of distinct shingles.  A shard of over ``SHARD`` members is dealt out by
salts, and one member, its pivot, goes to all of them: a large group of near
copies is linked through it in one step.  Members that this leaves apart from the
pivot then meet all salts, so that no pair of the shard is left out.

Edge cases: a null or wordless text has fingerprint 0, linked like any other
(and has no shingles to be similar by); fewer words than a shingle make one
shingle; repeated rows share their component; a null doc_id never becomes a
component's id unless all its rows have none; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_small, documents, row_of, save, stable, text_batches, without_rows
from tidemark.llm.components import components

SEED = 42
BITS = 64
#: A shard of more members is dealt again, by further bits or in pairs of salts.
SHARD = 4096
#: Shingles are hashed so many at a time.
STEP = 1 << 15
#: Shard keys (bands), the minima in each, and sketch bins of links by similarity.
KEYS, MINIMA, BINS = 14, 3, 256
#: Sketches may be so far below the similarity, four standard errors, before the sets are asked.
SLACK = 0.1


def shingle_hashes(text: str, words: int) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of A-Z lower-cased text, in order, in steps."""
    found = text.encode("utf-8", "replace").lower().split()  # both only see ASCII in bytes
    if not found:
        return
    joined = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(found) - words + 1)
    last = ends[words - 1 :] if len(found) >= words else ends[-1:]
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, STEP):
        spans = zip(starts[i : min(n, i + STEP)].tolist(), last[i : i + STEP].tolist())
        yield np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)


def distinct_shingles(text: str, words: int) -> np.ndarray:
    """The set of a text's shingle hashes, in order of value."""
    return np.unique(np.concatenate([np.empty(0, np.uint64), *shingle_hashes(text, words)]))


_ODD = np.array([xxhash.xxh64_intdigest(b"odd%d" % i, SEED) | 1 for i in range(KEYS * MINIMA)], np.uint64)
_FLIP = np.array([xxhash.xxh64_intdigest(b"flip%d" % i, SEED) for i in range(KEYS * MINIMA)], np.uint64)


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A key for each band, from the least of the hashes under the band's permutations."""
    least = np.full(KEYS * MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 512):
        least = np.minimum(least, ((hashes[i : i + 512, None] ^ _FLIP) * _ODD).min(0))
    least = (least ^ (least >> np.uint64(32))) * _ODD
    return np.bitwise_xor.reduce((least ^ (least >> np.uint64(29))).reshape(KEYS, MINIMA), axis=1).view(np.int64)


class _Print:
    """Gathers a text's fingerprint, and its sketch where asked for."""

    def __init__(self, sketch: bool):
        self.n, self.votes, self.sketch = 0, np.zeros(BITS, np.int64), sketch
        self.least = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)

    def add(self, hashes: np.ndarray) -> None:
        if not len(hashes):
            return
        self.n += len(hashes)
        self.votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
        if self.sketch:
            own = np.sort(hashes)
            bins, first = np.unique(own >> np.uint64(56), return_index=True)
            bins = bins.astype(np.int64)
            self.least[bins] = np.minimum(self.least[bins], own[first])

    def fingerprint(self) -> int:
        return int(np.packbits(self.votes * 2 > self.n, bitorder="little").view(np.int64)[0]) if self.n else 0

    def sketch_bytes(self) -> bytes:
        """A byte for each bin: 0 for an empty one, else 1 to 255 from its least hash."""
        byte = (self.least % np.uint64(255) + np.uint64(1)).astype(np.uint8)
        return np.where(self.least == np.iinfo(np.uint64).max, 0, byte).astype(np.uint8).tobytes()


def fingerprints(docs: DataFrame, words: int, sketch: bool = False) -> DataFrame:
    """row, doc_id, fingerprint, saved; with ``sketch`` of distinct shingles, and also keys and sketch (null without words)."""
    schema = "row long, doc_id long, fingerprint long" + ", keys array<long>, sketch binary" * sketch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, keys, sketches = [], [], []
            for scalar in batch.column(2):
                own = _Print(sketch)
                if sketch:
                    hashes = distinct_shingles(scalar.as_py(), words)
                    own.add(hashes)
                    keys.append(band_keys(hashes).tolist() if own.n else None)
                    sketches.append(own.sketch_bytes() if own.n else None)
                else:
                    for hashes in shingle_hashes(scalar.as_py(), words):
                        own.add(hashes)
                prints.append(own.fingerprint())
            columns = [batch.column(0), batch.column(1), pa.array(prints, pa.int64())]
            if sketch:
                columns += [pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

    text_batches(docs.sparkSession)
    docs = stable(docs)
    slim = docs.select(
        row_of(docs).alias("row"),
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    )
    return save(slim.mapInArrow(run, schema), "fingerprints")


class BKTree:
    """A BK-tree over distinct 64-bit fingerprints, searched for many at once."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        own, children = prints.tolist(), [{} for _ in range(len(prints))]
        for i in range(1, len(own)):
            node, x = 0, own[i]
            while True:
                below = children[node]
                d = (x ^ own[node]).bit_count()
                if d not in below:
                    below[d] = i
                    break
                node = below[d]
        self.count = np.array([len(c) for c in children])
        self.first = np.cumsum(self.count) - self.count
        self.child = np.array([x for c in children for x in c.values()], np.int64)
        self.edge = np.array([x for c in children for x in c], np.int64)

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query number, node) at a distance of at most ``radius``."""
        q, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        hits = []
        while len(q):
            d = np.bitwise_count(queries[q] ^ self.prints[node]).astype(np.int64)
            near = d <= radius
            hits.append((q[near], node[near]))
            n = self.count[node]
            at = np.repeat(self.first[node] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            d, q = np.repeat(d, n), np.repeat(q, n)
            follow = np.abs(self.edge[at] - d) <= radius
            q, node = q[follow], self.child[at[follow]]
        return np.concatenate([h[0] for h in hits]), np.concatenate([h[1] for h in hits])


def spanning_links(
    prints: np.ndarray, radius: int, agree: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None, most: int = 1 << 15
) -> np.ndarray:
    """For each member of a shard the least member that it is linked to, over any number of links.

    ``prints``: unsigned fingerprints, which may repeat.  ``agree`` confirms pairs of members, ``most`` at a time.
    """
    root = np.arange(len(prints))
    distinct, which = np.unique(prints, return_inverse=True)
    by_print = np.argsort(which, kind="stable")
    held = np.bincount(which)
    start = np.cumsum(held) - held
    tree = BKTree(distinct)
    step = max(1, (1 << 18) // max(1, len(distinct)))
    for at in range(0, len(prints), step):
        mine, node = tree.within(prints[at : at + step], radius)
        n = held[node]
        other = by_print[np.repeat(start[node] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        mine = np.repeat(mine + at, n)
        open_ = root[mine] != root[other]
        mine, other = mine[open_], other[open_]
        for i in range(0, len(mine), most):
            a, b = mine[i : i + most], other[i : i + most]
            a, b = (x[root[a] != root[b]] for x in (a, b))
            if agree is not None and len(a):
                a, b = (x[agree(a, b)] for x in (a, b))
            while len(a):
                low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
                np.minimum.at(root, high, low)
                while True:
                    up = root[root]
                    if (up == root).all():
                        break
                    root = up
                apart = root[a] != root[b]
                a, b = a[apart], b[apart]
        if not root.any():  # all are linked to the first
            break
    return root


def _likely(sketches: list, similarity: float) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Whether the sketches of pairs allow for the similarity."""
    table = np.frombuffer(b"".join(sketches), np.uint8).reshape(-1, BINS)

    def agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x, y = table[a], table[b]
        either = ((x > 0) | (y > 0)).sum(1)
        chance = 1 / 255
        same = ((x == y) & (x > 0)).sum(1) / np.maximum(either, 1)
        return (same - chance) / (1 - chance) >= similarity - SLACK

    return agree


def _prints_of(shard: pa.Table) -> np.ndarray:
    return shard.column("fingerprint").to_numpy().view(np.uint64)


def _linked(shard: pa.Table, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ids, moved = shard.column("id").to_numpy(), root != np.arange(len(root))
    return ids[moved], ids[root[moved]]


def _candidates(radius: int, similarity: float):
    """Search of a shard for groups (group, id) of members that may be similar; equal groups of other shards have equal numbers."""

    def search(shard: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        root = spanning_links(_prints_of(shard), radius, _likely(shard.column("sketch").to_pylist(), similarity))
        order = np.argsort(root, kind="stable")
        ids = shard.column("id").to_numpy()[order]
        held = np.unique(root, return_counts=True)[1]
        number = [xxhash.xxh64_intdigest(x.tobytes(), SEED) for x in np.split(ids, np.cumsum(held)[:-1])]
        group = np.repeat(np.array(number, np.uint64).view(np.int64), held)
        several = np.repeat(held > 1, held)
        return group[several], ids[several]

    return search


def _confirmed(radius: int, similarity: float):
    """Search of a group of candidates for links (a, b) of the exact Jaccard similarity."""

    def search(shard: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in shard.column("shingles")]
        likely = _likely(shard.column("sketch").to_pylist(), similarity)

        def agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            ok = likely(a, b)
            for i in np.flatnonzero(ok):
                x, y = sets[a[i]], sets[b[i]]
                shared = len(np.intersect1d(x, y, assume_unique=True))
                ok[i] = shared / (len(x) + len(y) - shared) >= similarity
            return ok

        return _linked(shard, spanning_links(_prints_of(shard), radius, agree, 1 << 9))

    return search


def _by_shard(dealt: DataFrame, search: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]], names: tuple[str, str] = ("a", "b")) -> DataFrame:
    """What ``search`` finds in each shard of two members and more.  dealt: key..., id, fingerprint, ...."""
    keys = [c for c in dealt.columns if c.startswith("key")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def groups(table: pa.Table, last: bool):
            """Findings of the whole shards; the shard at the end may go on in the next batch."""
            key = np.stack([table.column(k).to_numpy() for k in keys], 1)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            bounds = np.concatenate([[0], cuts, [len(key)]])
            whole = bounds if last else bounds[:-1]
            found = [(np.empty(0, np.int64),) * 2]
            for i in np.flatnonzero(np.diff(whole) > 1):
                found.append(search(table.slice(int(whole[i]), int(whole[i + 1] - whole[i])).combine_chunks()))
            links = [np.concatenate([f[j] for f in found]) for j in (0, 1)]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in links], names=list(names)), table.slice(int(whole[-1]))

        for batch in batches:
            own = pa.Table.from_batches([batch])
            table = own if rest is None else pa.concat_tables([rest, own])
            if table.num_rows:
                links, rest = groups(table, False)
                yield links
        if rest is not None and rest.num_rows:
            yield groups(rest.combine_chunks(), True)[0]

    # A given number keeps adaptive execution from merging partitions that are small in bytes but not in work.
    n = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ready = dealt.repartition(n, *keys).sortWithinPartitions(*keys, "id")
    return ready.mapInArrow(run, ", ".join(f"{x} long" for x in names))


def _bits(col: Column, low: int, n: int) -> Column:
    return F.shiftrightunsigned(col, low).bitwiseAND(F.lit((1 << n) - 1))


def fingerprint_components(prints: DataFrame, radius: int = 3) -> DataFrame:
    """fingerprint, component_id: the least doc_id reachable over links of at most ``radius`` (up to 3) bits."""
    if not 0 <= radius <= 3:
        raise ValueError("four blocks cover a radius of up to 3")
    distinct = save(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct")
    fp = F.col("fingerprint")
    blocks = []
    for b in range(4):
        above = F.shiftleft(F.shiftrightunsigned(fp, 16 * b + 16), 16 * b) if b < 3 else F.lit(0).cast("long")
        rest = above.bitwiseOR(fp.bitwiseAND(F.lit((1 << 16 * b) - 1)))
        key = F.lit(b << 16).cast("long") + _bits(fp, 16 * b, 16)
        blocks.append(F.struct(key.alias("key"), rest.alias("rest")))
    dealt = distinct.select(fp.alias("id"), "fingerprint", F.explode(F.array(*blocks)).alias("s")).select(
        "s.key", "s.rest", "id", "fingerprint"
    )
    # At most 4 x 65536 keys: a bounded table.
    large = F.broadcast(dealt.groupBy("key").count().where(F.col("count") > SHARD).select("key", F.lit(True).alias("large")))
    dealt = dealt.join(large, "key", "left")
    none = F.lit(-1).cast("long")
    small = dealt.where("large IS NULL").select("key", none.alias("key2"), "id", "fingerprint")
    again = (
        dealt.where("large")
        .select("key", "id", "fingerprint", F.explode(F.array(*[
            F.lit(k * 4096).cast("long") + _bits(F.col("rest"), 12 * k, 12) for k in range(4)
        ])).alias("key2"))
        .select("key", "key2", "id", "fingerprint")
    )
    links = _by_shard(small.unionByName(again), lambda shard: _linked(shard, spanning_links(_prints_of(shard), radius)))
    linked = components(links)
    named = distinct.join(linked.withColumnRenamed("id", "fingerprint"), "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.join(least, "root").select("fingerprint", "component_id")


def shingle_sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """id (a row of ``docs``), fingerprint, sketch, shingles of the rows in ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, sketches, sets = [], [], []
            for scalar in batch.column(1):
                own, hashes = _Print(True), distinct_shingles(scalar.as_py(), words)
                own.add(hashes)
                prints.append(own.fingerprint())
                sketches.append(own.sketch_bytes())
                sets.append(hashes.tobytes())
            columns = [batch.column(0), pa.array(prints, pa.int64()), pa.array(sketches, pa.binary()), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "fingerprint", "sketch", "shingles"])

    texts = docs.select(row_of(docs).alias("id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    return texts.join(broadcast_small(ids), "id", "left_semi").mapInArrow(
        run, "id long, fingerprint long, sketch binary, shingles binary"
    )


def similar_components(
    prints: DataFrame, docs: DataFrame, words: int = 5, radius: int = 20, similarity: float = 0.8
) -> DataFrame:
    """id (a row of ``prints``), root: rows linked by exact similarity of shingle sets.  Rows without links are absent."""
    known = prints.where("keys IS NOT NULL").select(F.col("row").alias("id"), "fingerprint", "keys", "sketch")
    keyed = known.select("id", F.posexplode("keys").alias("k", "value")).select(F.xxhash64("k", "value").alias("key"), "id")
    counts = save(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared-keys")
    shared = save(keyed.join(broadcast_small(counts), "key").select("key", "id", "n"), "keyed")
    dealt = shared.join(known.select("id", "fingerprint", "sketch"), "id")

    def links(shards: DataFrame) -> DataFrame:
        """Links of the exact similarity in shards (key, key2, key3), saved."""
        groups = save(_by_shard(shards, _candidates(radius, similarity), ("key", "id")).distinct(), "candidates")
        sets = shingle_sets(docs, groups.select("id").distinct(), words)
        joined = groups.join(sets, "id").select("key", "id", "fingerprint", "sketch", "shingles")
        return save(_by_shard(joined, _confirmed(radius, similarity)), "near-links")

    def shards(df: DataFrame, salt: Column | str | None = None, other: Column | str | None = None) -> DataFrame:
        none = F.lit(-1).cast("long")
        return df.select("key", (none if salt is None else F.col(salt)).alias("key2"), (none if other is None else F.col(other)).alias("key3"), "id", "fingerprint", "sketch")

    many = lambda n: F.ceil(n * 2 / SHARD).cast("long")
    salt_of = lambda n: F.pmod(F.xxhash64("id"), n)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    if counts.where(F.col("n") > SHARD).isEmpty():
        return components(links(shards(dealt)))
    hot = dealt.where(F.col("n") > SHARD).withColumn("salts", many(F.col("n"))).withColumn("salt", salt_of(F.col("salts")))
    member = F.struct("id", "fingerprint", "sketch")
    pivots = save(hot.groupBy("key", "salts").agg(F.min_by(member, F.struct(F.xxhash64("id"), "id")).alias("m")).select("key", "salts", "m.*"), "pivots")
    visits = pivots.withColumn("salt", every("salts")).where(F.col("salt") != salt_of(F.col("salts")))
    near = links(shards(dealt.where(F.col("n") <= SHARD)).unionByName(shards(hot, "salt")).unionByName(shards(visits, "salt")))
    linked = save(components(near), "near-groups")
    home = pivots.join(linked, "id", "left").select("key", F.coalesce("root", "id").alias("home"))
    apart = save(
        hot.join(linked, "id", "left").join(broadcast_small(home), "key").where(F.coalesce("root", "id") != F.col("home")).select("key", "id", "fingerprint", "sketch", "salts"),
        "apart",
    )
    if apart.isEmpty():
        return linked
    sizes = broadcast_small(save(apart.groupBy("key").agg(many(F.count(F.lit(1))).alias("others")), "apart-sizes"))
    members = hot.join(sizes, "key").withColumn("other", every("others"))
    callers = apart.join(sizes, "key").withColumn("salt", every("salts")).withColumn("other", salt_of(F.col("others")))
    both = shards(members, "salt", "other").unionByName(shards(callers, "salt", "other")).dropDuplicates(["key", "key2", "key3", "id"])
    return components(near.unionByName(links(both)))


def keep_one_of_each(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` without near copies: of each group the row with the least doc_id stays."""
    docs = stable(docs)
    prints = fingerprints(docs, words, sketch=True)
    groups = similar_components(prints, docs, words, similarity=similarity)
    members = prints.select(F.col("row").alias("id"), "doc_id").join(groups, "id")
    first = members.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "id")).alias("first"))
    return without_rows(docs, members.join(first, "root").where("id <> first.id").select(F.col("id").alias("row")))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = fingerprints(documents(spark, sf_dir), 3)
    named = fingerprint_components(prints.select("doc_id", "fingerprint"), 3)
    return prints.join(named, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
