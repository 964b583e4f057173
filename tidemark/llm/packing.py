"""Packing documents into sequences by order-preserving dynamic programming.

A shard is an input partition: its documents, in order, make one stream of
tokens, each document's ids followed by the end id.  Windows of at most ``size``
tokens are cut from the stream at ends of documents (free), at ends of sentences
(a small penalty) or inside long sentences (a larger one), so that padding plus
penalties are least.  With g = cost + position, the best cut before a candidate
is the least g within the window, which a monotone queue keeps.  The rest of a
shard may fall into windows with lengths of powers of two, which need no
padding.  Shards never meet in a task, and a task holds a few windows at a time.

Edge cases: a null or empty text is just the end id; a document of any length is
cut into as many windows as it takes; a null doc_id is carried along; repeated
rows are packed each for itself; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import functools
import re
import string
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, parts, text_batches

SIZE = 4096
END = 2
#: Cost of a cut at the end of a sentence and elsewhere, in tokens of padding.
SENTENCE, INSIDE = 2, 12
#: Tokens between candidates at most.
GAP = 64
#: Windows that a task plans at a time.
AHEAD = 64
#: Distinct words whose ids a task remembers before it starts anew.
CACHE = 500_000

_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_ODD_SPACE = re.compile(r"[\x1c-\x1f]")
#: The vocabulary's own pattern of pieces, for lower-case ASCII.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x20\x09-\x0Da-z0-9]+")
_PLAIN_END = frozenset(string.punctuation) - {"'", "<", "|", ">"}
#: The vocabulary's names of bytes: printable ones stand for themselves, others follow U+0100 in order.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_NAMES = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in set(_PRINTABLE))}


class ChunkEncoder:
    """Ids of texts, exactly as the tokenizer gives them, with caches of words and their pieces.

    Neither the tokenizer's normalisation nor its pieces cross white space, so a
    text's ids are the ids of its words, in order, and the ids of a plain word
    are those of its pieces.  Other words go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.model = self.full.model
        names = [""] * self.full.get_vocab_size()
        for name, i in self.full.get_vocab().items():
            names[i] = name
        self.stop = np.array([n.removesuffix("</w>")[-1:] in set(".!?") for n in names])
        self.clear()

    def clear(self) -> None:
        self.pieces: dict[str, bytes] = {}  # little-endian 16-bit ids
        self.index: dict[str | None, int] = {None: 0}
        self.table, self.starts, self.lengths = np.array([END], np.uint16), np.zeros(1, np.int64), np.ones(1, np.int64)

    def _parts(self, word: str) -> list[str] | None:
        """The pieces of a word in normal form; None where that isn't plain."""
        ascii_ = word.isascii()
        text = word.lower() if ascii_ else unicodedata.normalize("NFC", word).lower()
        if text.isalpha():
            parts = [text]
        elif text[-1] in _PLAIN_END and text[:-1].isalpha():
            parts = [text[:-1], text[-1]]
        else:
            return _PIECES.findall(text) if ascii_ and "<|" not in word else None
        # Capitals whose lower case depends on context or isn't a letter.
        return None if not ascii_ and ("\u03a3" in word or "\u0130" in word) else parts

    def _word(self, word: str) -> bytes:
        parts = self._parts(word)
        if parts is None:
            return array("H", self.full.encode(word, add_special_tokens=False).ids).tobytes()
        found = []
        for part in parts:
            own = self.pieces.get(part)
            if own is None:
                spelt = part if part.isascii() and part.isprintable() else part.encode().decode("latin-1").translate(_BYTE_NAMES)
                own = self.pieces[part] = array("H", [t.id for t in self.model.tokenize(spelt)]).tobytes()
            found.append(own)
        return found[0] if len(found) == 1 else b"".join(found)

    def _learn(self, new: list[str]) -> None:
        found = [self._word(w) for w in new]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 2
        at = len(self.table)
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
        self.table = np.concatenate([self.table, np.frombuffer(b"".join(found), np.uint16)])
        self.starts = np.concatenate([self.starts, at + np.cumsum(sizes) - sizes])
        self.lengths = np.concatenate([self.lengths, sizes])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by the end id, and the number of each text's."""
        chunks: list[str | None] = []
        counts = []
        for text in texts:
            own = [c for c in _SPACE.split(text) if c] if _ODD_SPACE.search(text) else text.split()
            chunks += own
            chunks.append(None)
            counts.append(len(own) + 1)
        if len(self.index) > CACHE:
            self.clear()
        if len(self.pieces) > CACHE // 2:
            self.pieces.clear()
        new = set(chunks).difference(self.index)
        if new:
            self._learn(list(new))
        which = np.fromiter(map(self.index.__getitem__, chunks), np.int64, len(chunks))
        n = self.lengths[which]
        ends = np.cumsum(n)
        ids = self.table[np.repeat(self.starts[which] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.cumsum(counts) - 1
        return ids, np.diff(ends[bounds], prepend=0)


@functools.cache
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def tail_parts(n: int) -> list[int]:
    """The powers of two that add up to n, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def tail_cost(n: int, size: int = SIZE) -> tuple[int, bool]:
    """Least cost of a shard's last n tokens, and whether it is that of splitting them into powers of two."""
    split = (n.bit_count() - 1) * INSIDE
    return (split, True) if n and split < size - n else (size - n, False)


def cut_windows(positions: list[int], penalties: list[int], size: int, final: bool) -> list[int]:
    """Cuts from positions[0] to positions[-1] with the least padding plus penalties.

    positions: candidates in order, at most ``size`` apart.  ``final``: the last
    window is a shard's rest, which costs ``tail_cost``.
    """
    n = len(positions)
    g, back = [0] * n, [0] * n  # g: cost so far plus position
    g[0] = positions[0]
    queue, head = [0], 0
    last = n - 1 if final else n
    for j in range(1, last):
        low = positions[j] - size
        while positions[queue[head]] < low:
            head += 1
        i = queue[head]
        back[j] = i
        gj = g[j] = g[i] + size + penalties[j]
        while len(queue) > head and g[queue[-1]] >= gj:
            queue.pop()
        queue.append(j)
    if final and n > 1:
        end, best = positions[-1], None
        for i in range(n - 2, -1, -1):
            if end - positions[i] > size:
                break
            cost = g[i] - positions[i] + tail_cost(end - positions[i], size)[0]
            if best is None or cost < best:
                best, back[-1] = cost, i
    cuts, j = [], n - 1
    while j > 0:
        cuts.append(positions[j])
        j = back[j]
    return [positions[0], *reversed(cuts)] if n > 1 else [positions[0]]


def candidates(ids: np.ndarray, doc_ends: np.ndarray, stop: np.ndarray) -> tuple[list[int], list[int]]:
    """Positions where a window may end, with their penalties, from 0 to the end of ``ids``."""
    penalty = np.full(len(ids) + 1, -1, np.int16)
    penalty[1:][stop[ids]] = SENTENCE
    inner = doc_ends[doc_ends <= len(ids)]
    penalty[inner] = 0
    penalty[0] = 0
    if penalty[-1] < 0:
        penalty[-1] = INSIDE
    at = np.flatnonzero(penalty >= 0)
    gaps = np.diff(at)
    wide = np.flatnonzero(gaps > GAP)
    for i in wide:
        penalty[at[i] + GAP : at[i + 1] : GAP] = INSIDE
    at = np.flatnonzero(penalty >= 0) if len(wide) else at
    return at.tolist(), penalty[at].tolist()


class _Shard:
    """The stream of one shard: takes documents, gives finished pieces."""

    def __init__(self, stop: np.ndarray, base: int):
        self.stop, self.sequence = stop, base
        self.ids = np.empty(0, np.uint16)
        self.doc_ids: list[int | None] = []  # of documents that end after the stream's start
        self.ends = np.empty(0, np.int64)  # where they end in the stream
        self.totals = np.empty(0, np.int64)

    def add(self, doc_ids: list, ids: np.ndarray, counts: np.ndarray) -> None:
        self.ends = np.concatenate([self.ends, len(self.ids) + np.cumsum(counts)])
        self.totals = np.concatenate([self.totals, counts])
        self.ids = np.concatenate([self.ids, ids])
        self.doc_ids += doc_ids

    def pieces(self, final: bool) -> pa.RecordBatch | None:
        if not len(self.ids):
            return None
        cuts = cut_windows(*candidates(self.ids, self.ends, self.stop), SIZE, final)
        if not final:
            cuts = cuts[:-2]  # the last windows may get better with what follows
        elif tail_cost(cuts[-1] - cuts[-2])[1]:
            cuts = [*cuts[:-1], *(cuts[-2] + np.cumsum(tail_parts(cuts[-1] - cuts[-2]))).tolist()]
        stop_at = cuts[-1]
        windows = np.array(cuts)
        bounds = np.union1d(windows, self.ends[self.ends < stop_at])
        first, last = bounds[:-1], bounds[1:]
        doc = np.searchsorted(self.ends, first, "right")
        window = np.searchsorted(windows, first, "right") - 1
        wide = memoryview(self.ids[:stop_at].astype("<u4")).cast("B")
        columns = [
            pa.array([self.doc_ids[i] for i in doc], pa.int64()),
            pa.array(first - (self.ends - self.totals)[doc]),
            pa.array(last - first),
            pa.array([zlib.crc32(wide[4 * a : 4 * b]) for a, b in zip(first.tolist(), last.tolist())], pa.int64()),
            pa.array(self.totals[doc]),
            pa.array(self.sequence + window),
            pa.array(first - windows[window]),
        ]
        self.sequence += len(cuts) - 1
        done = int(np.searchsorted(self.ends, stop_at, "right"))
        self.ids, self.doc_ids = self.ids[stop_at:], self.doc_ids[done:]
        self.ends, self.totals = self.ends[done:] - stop_at, self.totals[done:]
        return pa.RecordBatch.from_arrays(columns, names=NAMES)


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
NAMES = [x.split()[0] for x in SCHEMA.split(", ")]


def pack(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per piece.  ``vocabulary``: path of the tokenizer's file on every executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, shard = encoder(vocabulary), None
        for batch in batches:
            for low, high in parts(batch.column(2)):
                part = batch.slice(low, high - low)
                if shard is None:
                    shard = _Shard(known.stop, part.column(0)[0].as_py() << 36)
                shard.add(part.column(1).to_pylist(), *known.encode(part.column(2).to_pylist()))
                if len(shard.ids) >= AHEAD * SIZE:
                    yield shard.pieces(False)
        if shard is not None and (rest := shard.pieces(True)):
            yield rest
        known.clear()  # the worker may serve other stages next

    text_batches(docs.sparkSession)
    return docs.select(
        F.spark_partition_id().cast("long").alias("shard"),
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    ).mapInArrow(run, SCHEMA)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), default_vocabulary())
