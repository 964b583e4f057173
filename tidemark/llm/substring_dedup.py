"""Substring deduplication by prefix-partitioned suffix trees.

A repeat of ``WINDOW`` words is an internal node of the corpus's suffix tree at
that depth or deeper.  The tree is never built as one:

* Prefixes.  The suffixes of a text are its window starts.  A suffix's prefix
  code is its minimiser, the word k-gram with the least hash within the first
  ``WINDOW`` words: equal windows have equal codes, and neighbours mostly share
  theirs, so the suffixes of a text fall into a few segments, each with one code.
* Counting.  Codes are counted first, by sums that combine before the shuffle; one that a single segment has leads to no
  internal node.  Equal segments of a batch are one path of a tree: the first in
  order stands for them, the others are repeats as wholes.
* Partition.  Segments, with their words, are dealt out by code: a code is a
  group that fits into memory.  A frequent code (over ``GROUP`` segments) has a
  longer key: its groups hold a share (salt) of its segments each, and the nodes'
  least leaves of all shares meet again by the whole window.
* Subtrees.  In a task a group's suffixes are sorted by their words (prefix
  doubling), neighbours' common prefixes give the internal nodes, and a topmost
  node of depth ``WINDOW`` or more is a repeat: its least leaf (doc_id, then
  place) is the first occurrence, the other leaves go.

Counts meet per batch and not per segment, and frequent codes are shared out, so
a passage in a third of all documents fills no single task.

Trees compare words.  Hashes decide only which segments meet (codes of 44 bits or
more), which segments of a batch are equal (64 bits more), and which nodes of a
frequent code's shares are the same (128 bits).

Edge cases: a null text has no words; texts shorter than a window keep all; a
null doc_id comes before all others; of repeated rows with the same doc_id the
earlier row comes first; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_small, documents, parts, row_of, save, stable, text_batches

WINDOW = 20
#: Words of a prefix code; each window of WINDOW words holds SPAN of them (a power of two).
CODE = 5
SPAN = WINDOW - CODE + 1
#: Segments of a group; a code with more is shared out.
GROUP = 1 << 13
#: Distinct words that a task remembers.
KNOWN = 1 << 18

_BASE = 0x9E3779B97F4A7C15
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashes:
    """Hashes of words, and of runs of words by differences of prefix sums."""

    def __init__(self):
        self.words: dict[bytes, int] = {}
        self.powers = np.ones((2, 1), np.uint64)

    def _word(self, word: bytes) -> int:
        found = self.words.get(word)
        if found is None:
            if len(self.words) > KNOWN:
                self.words.clear()
            found = self.words[word] = xxhash.xxh64_intdigest(word, 1)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self._word, words), np.uint64, len(words))

    def sums(self, hashes: np.ndarray) -> np.ndarray:
        """Prefix sums of hash times power of its place; takes the powers along as far as needed."""
        n = len(hashes) + 1
        if self.powers.shape[1] < n:
            rows = np.full((2, max(n, 1 << 16)), 1, np.uint64)
            rows[0, 1:], rows[1, 1:] = _BASE, pow(_BASE, -1, 1 << 64)
            self.powers = np.multiply.accumulate(rows, axis=1)
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * self.powers[0, : n - 1])])

    def runs(self, sums: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hashes of the words from ``first`` to before ``last``."""
        return _mix((sums[last] - sums[first]) * self.powers[1, first])


def code_places(codes: np.ndarray) -> np.ndarray:
    """For each window, the place of its prefix code: the first least k-gram in it."""
    least, at, step = codes, np.arange(len(codes)), 1
    while step < SPAN:
        n = len(least) - step
        if n < 1:
            return np.empty(0, np.int64)
        left = least[:n] <= least[step:]
        least, at = np.where(left, least[:n], least[step:]), np.where(left, at[:n], at[step:])
        step *= 2
    return at


def spans(known: Hashes, texts: list[list[bytes]]) -> tuple[np.ndarray, ...]:
    """Of all windows with one code place: number of text, code, hash of the whole span, first and last start, place."""
    counts = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(counts)
    sums = known.sums(known.of([w for t in texts for w in t]))
    n = int(ends[-1]) if len(ends) else 0
    empty = np.empty(0, np.int64)
    if n < WINDOW:
        return empty, empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, empty
    start = np.arange(n - CODE + 1)
    text = np.repeat(np.arange(len(texts)), counts)
    codes = known.runs(sums, start, start + CODE)
    codes[start + CODE > ends[text[start]]] = _TOP  # crosses into the next text
    at = code_places(codes)
    s = np.arange(len(at))
    s = s[s + WINDOW <= ends[text[s]]]
    at = at[s]
    new = np.ones(len(s), bool)
    new[1:] = (at[1:] != at[:-1]) | (text[s[1:]] != text[s[:-1]])
    low = s[new]
    high = s[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(s) - 1]])] if len(s) else low
    place = at[new]
    shape = ((place - low) * 64 + (high - low)).astype(np.uint64)
    whole = _mix(known.runs(sums, low, high + WINDOW) ^ _mix(shape))
    base = (ends - counts)[text[low]]
    return text[low], codes[place], whole, low - base, high - base, place - base


def _pack(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        row_of(docs).alias("row"),
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    )


def coded_spans(rows: DataFrame) -> DataFrame:
    """code, row, at, segments: a row per span; at = first start << 8 | number of further starts.

    ``segments``: of the first span with a code in its batch, how many different spans the batch has; of the others -1,
    and 0 of a copy of an earlier span.
    """
    names = ["code", "row", "at", "segments"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Hashes()
        for batch in batches:
            found = []
            order, row_no = batch.column(1).fill_null(-(1 << 63)).to_numpy(), batch.column(0).to_numpy()
            for low, high in parts(batch.column(2)):
                texts = [t.as_py().encode("utf-8", "replace").split() for t in batch.column(2).slice(low, high - low)]
                text, *more = spans(known, texts)
                found.append((text + low, *more))
            if not found:
                continue
            text, code, whole, low, high, _ = (np.concatenate(c) for c in zip(*found))
            code = code >> np.uint64(20)
            by = np.lexsort((low, row_no[text], order[text], whole, code))
            text, code, whole, low, high = (x[by] for x in (text, code, whole, low, high))
            first, copy = np.ones(len(code), bool), np.zeros(len(code), bool)
            first[1:] = code[1:] != code[:-1]
            copy[1:] = ~first[1:] & (whole[1:] == whole[:-1])
            at = np.flatnonzero(first)
            segments = np.where(copy, 0, -1)
            segments[at] = np.add.reduceat(~copy, at) if len(at) else 0
            columns = [code.view(np.int64), row_no[text], low << 8 | (high - low), segments.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return rows.mapInArrow(run, "code long, row long, at long, segments int")


def repeated_codes(coded: DataFrame) -> DataFrame:
    """row, at, code, copy, total of the spans that are copies or whose code other spans have too; total: of a code's spans, in its first ones.

    Sums of a code combine before they are shuffled.  Spans beside the first of their batch are told without meeting others.
    ``coded`` is read twice and should be saved.
    """
    first = coded.where("segments > 0")
    totals = first.groupBy("code").agg(F.sum("segments").alias("total")).where("total > 1")
    met = first.join(totals, "code").select("row", "at", "code", F.lit(False).alias("copy"), "total")
    told = coded.where("segments <= 0")
    return met.unionByName(told.select("row", "at", "code", (F.col("segments") == 0).alias("copy"), F.lit(None).cast("long").alias("total")))


def _packed(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [_pack(t.as_py().encode("utf-8", "replace")) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["row", "doc_id", "packed"]
            )

    return rows.mapInArrow(run, "row long, doc_id long, packed binary")


def _kept(words: list[bytes], change: np.ndarray | None = None) -> tuple[int, int, str]:
    """n_words, n_removed, digest; ``change``: how many more windows cover each word than the one before."""
    kept = words if change is None else [w for w, k in zip(words, (np.cumsum(change)[:-1] == 0).tolist()) if k]
    return len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def _cover(n: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Changes in cover by windows that start from ``low`` to ``high``."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, low, 1)
    np.add.at(change, high + WINDOW, -1)
    return change


def segments_of(texts: DataFrame) -> DataFrame:
    """code, row, doc_id, at, words of the spans that need a subtree.  texts: row, doc_id, packed, at, code, copy (lists)."""
    names = ["code", "row", "doc_id", "at", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                out: list[list] = [[] for _ in names]
                for row, doc_id, packed, at, code, copy in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), *part.columns[2:]):
                    wanted = [x for x in zip(at.as_py() or (), code.as_py() or (), copy.as_py() or ()) if not x[2]]
                    if not wanted:
                        continue
                    words = _unpack(packed.as_py()).split()
                    for a, c, _ in wanted:
                        values = c, row, doc_id, a, b" ".join(words[a >> 8 : (a >> 8) + (a & 255) + WINDOW])
                        for column, value in zip(out, values):
                            column.append(value)
                types = [pa.int64()] * 4 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)

    return texts.mapInArrow(run, "code long, row long, doc_id long, at long, words binary")


def suffix_tree(group: np.ndarray, segments: list[bytes], starts: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffix trees of groups of segments, as sorted leaves and the depths at which neighbours part.

    ``starts``: how many suffixes each segment has; ``widths``: its words.  Gives the leaves' segments, their places in
    these, and for each leaf how many words it shares with the leaf before (0 across groups): the internal nodes are the
    runs of leaves that share as many words.  Leaves are sorted by prefix doubling, in any order of words.
    """
    table: dict[bytes, int] = {}
    number = table.setdefault
    ids = np.fromiter((number(w, len(table)) for w in b" ".join(segments).split()), np.int64, int(widths.sum()))
    n = len(ids)
    ends = np.repeat(np.cumsum(widths), widths)
    here = np.arange(n)
    rank = np.unique(np.repeat(group, widths) * len(table) + ids, return_inverse=True)[1]
    ranks, h = [rank], 1
    while h < widths.max():
        after = np.where(here + h < ends, ranks[-1][np.minimum(here + h, n - 1)] + 1, 0)
        ranks.append(np.unique(ranks[-1] * (n + 1) + after, return_inverse=True)[1])
        h *= 2
    base = np.cumsum(widths) - widths
    segment = np.repeat(np.arange(len(segments)), starts)
    place = np.arange(len(segment)) - np.repeat(np.cumsum(starts) - starts, starts)
    leaf = base[segment] + place
    order = np.argsort(ranks[-1][leaf], kind="stable")
    segment, place, leaf = segment[order], place[order], leaf[order]
    a, b = leaf[:-1], leaf[1:]
    shared = np.zeros(len(a), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        x, y = a + shared, b + shared
        same = (x < ends[a]) & (y < ends[b])
        same &= ranks[k][np.minimum(x, n - 1)] == ranks[k][np.minimum(y, n - 1)]
        shared += np.where(same, 1 << k, 0)
    shared = np.minimum(shared, np.minimum(ends[a] - a, ends[b] - b))
    return segment, place, np.concatenate([np.zeros(min(1, len(leaf)), np.int64), shared])


def deep_nodes(depths: np.ndarray, depth: int = WINDOW) -> np.ndarray:
    """For each leaf the number of the topmost internal node at ``depth`` or deeper above it; a leaf without one has a number of its own."""
    return np.cumsum(depths < depth) - 1


_FOUND = ["row", "doc_id", "at", "node", "least"]


def _repeats(group: np.ndarray, shared_out: np.ndarray, table: pa.Table) -> pa.RecordBatch:
    """Of a table of whole groups: runs of suffixes that are repeats, and the least leaves of groups that are shared out.

    ``node``: of the latter a digest of the window, of the others a value of their own.
    """
    row, at = table.column("row").to_numpy(), table.column("at").to_numpy()
    doc_id = table.column("doc_id").fill_null(-(1 << 63)).to_numpy()
    segments = table.column("words").to_pylist()
    starts = (at & 255) + 1
    segment, place, depths = suffix_tree(group, segments, starts, starts + WINDOW - 1)
    node = deep_nodes(depths)
    order = np.empty(len(row), np.int64)  # of the segments' texts
    by = np.lexsort((row, doc_id))
    order[by] = np.cumsum(np.concatenate([[0], (row[by][1:] != row[by][:-1]) | (doc_id[by][1:] != doc_id[by][:-1])]))
    start = (at >> 8)[segment] + place
    rank = order[segment] << 32 | start
    first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    least = rank == np.minimum.reduceat(rank, first)[node]
    # Runs of repeats in a segment.
    gone = np.flatnonzero(~least)
    gone = gone[np.lexsort((place[gone], segment[gone]))]
    s, p = segment[gone], place[gone]
    new = np.concatenate([[True], (s[1:] != s[:-1]) | (p[1:] != p[:-1] + 1)])[: len(gone)]
    low = np.flatnonzero(new)
    more = np.diff(np.append(low, len(gone))) - 1
    rows, docs, spans_ = row[s[low]], s[low], start[gone][low] << 8 | more
    digests = [struct.pack("<qq", r, x) for r, x in zip(rows.tolist(), spans_.tolist())]
    # Least leaves that meet those of other shares.
    kept = np.flatnonzero(least & shared_out[segment])
    for i in kept.tolist():
        words = segments[segment[i]].split()[place[i] : place[i] + WINDOW]
        digests.append(xxhash.xxh3_128_digest(b" ".join(words)))
    columns = [
        pa.array(np.concatenate([rows, row[segment[kept]]])),
        table.column("doc_id").combine_chunks().take(pa.array(np.concatenate([docs, segment[kept]]))),
        pa.array(np.concatenate([spans_, start[kept] << 8])),
        pa.array(digests, pa.binary()),
        pa.array(np.arange(len(digests)) >= len(rows)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=_FOUND)


def subtrees(segments: DataFrame) -> DataFrame:
    """row, doc_id, at, node, least: of the groups by (code, salt) the repeats, and where salt >= 0 the nodes' least leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def found(table: pa.Table, last: bool) -> tuple[pa.RecordBatch | None, pa.Table]:
            """Of the whole groups; the one at the end may go on in the next batch."""
            code, salt = table.column("code").to_numpy(), table.column("salt").to_numpy()
            new = np.concatenate([[True], (code[1:] != code[:-1]) | (salt[1:] != salt[:-1])])
            whole = len(code) if last else int(np.flatnonzero(new)[-1])
            if not whole:
                return None, table
            return _repeats((np.cumsum(new) - 1)[:whole], salt[:whole] >= 0, table.slice(0, whole)), table.slice(whole)

        for batch in batches:
            own = pa.Table.from_batches([batch])
            table = own if rest is None else pa.concat_tables([rest, own])
            if table.num_rows:
                out, rest = found(table, False)
                if out is not None:
                    yield out
        if rest is not None and rest.num_rows:
            yield found(rest, True)[0]

    ready = segments.repartition("code", "salt").sortWithinPartitions("code", "salt")
    return ready.mapInArrow(run, "row long, doc_id long, at long, node binary, least boolean")


def salted(segments: DataFrame, frequent: DataFrame) -> DataFrame:
    """``segments`` with the share of its code's segments that each falls to, -1 where one group holds them all.  frequent: code, total.

    Segments of one text are shared out like those of many.
    """
    salt = F.pmod(F.xxhash64("row", "at"), F.ceil(F.col("total") / GROUP))
    return segments.join(broadcast_small(frequent), "code", "left").select(
        "code", F.coalesce(salt, F.lit(-1)).cast("long").alias("salt"), "row", "doc_id", "at", "words"
    )


def repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts (row, doc_id, packed, and lists at, code, copy of spans), and the repeats beside the copies (row, at)."""
    rows = _rows(docs)
    marks = save(repeated_codes(save(coded_spans(rows), "coded-spans")), "repeated-codes")
    by_row = marks.groupBy("row").agg(F.collect_list(F.struct("at", "code", "copy")).alias("marks"))
    texts = _packed(rows).join(by_row, "row", "left").select(
        "row", "doc_id", "packed", *[F.col(f"marks.{c}").alias(c) for c in ("at", "code", "copy")]
    )
    frequent = marks.where(F.col("total") > GROUP).groupBy("code").agg(F.max("total").alias("total"))
    found = subtrees(salted(segments_of(texts), frequent))
    if not frequent.isEmpty():
        leaves = Window.partitionBy("node").orderBy(F.col("doc_id").asc_nulls_first(), "row", "at")
        found = found.withColumn("nth", F.row_number().over(leaves)).where("NOT least OR nth > 1")
    return texts, found.select("row", "at")


def _removed(texts: DataFrame) -> DataFrame:
    """Results of documents.  texts: doc_id, packed, at and copy (spans), repeats (spans)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, packed, at, copy, repeats in zip(batch.column(0).to_pylist(), *batch.columns[1:]):
                words = _unpack(packed.as_py()).split()
                spans_ = [a for a, c in zip(at.as_py() or (), copy.as_py() or ()) if c] + (repeats.as_py() or [])
                gone = np.array(spans_, np.int64)
                rows.append((doc_id, *_kept(words, _cover(len(words), gone >> 8, (gone >> 8) + (gone & 255)) if spans_ else None)))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            columns = [pa.array([r[j] for r in rows], t) for j, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return texts.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def substring_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256."""
    text_batches(docs.sparkSession)
    texts, found = repeats(stable(docs))
    by_row = found.groupBy("row").agg(F.collect_list("at").alias("repeats"))
    return _removed(texts.join(by_row, "row", "left").select("doc_id", "packed", "at", "copy", "repeats"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir))


OP2_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
p AS (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM w),
h AS (SELECT doc_id, i, array_to_string(words[i : i + 19], ' ') AS t FROM p),
r AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY t ORDER BY doc_id, i) AS k FROM h) WHERE k > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM r),
g AS (SELECT doc_id, list(j) AS gone FROM c GROUP BY doc_id),
u AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS j FROM w),
k AS (
  SELECT u.doc_id, string_agg(u.words[u.j], ' ' ORDER BY u.j) AS kept
  FROM u ANTI JOIN c ON u.doc_id = c.doc_id AND u.j = c.j GROUP BY u.doc_id)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN g USING (doc_id) LEFT JOIN k USING (doc_id)
"""
