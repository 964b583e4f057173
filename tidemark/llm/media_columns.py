"""Media columns: texts as samples of an ISO base media file, and its facts as columns.

``store`` wraps a payload losslessly in an ISO media file: the bytes are 8-bit
PCM samples in ``mdat``, in chunks, under a full sample table.  ``probe`` walks
the nested boxes of such bytes, decodes each track's sample tables (stsd, stts,
stsc, stsz or stz2, stco or co64, stss) and gives codec, duration and the byte
ranges of the sync samples, decoding no payload.  ``payload_of`` follows the same
tables to the stored bytes.

Edge cases: a null or empty text has a payload of 64 bytes 0; texts of any
length are taken whole; damaged boxes, files without a track and movie fragments
raise ``ValueError`` in ``probe``; without stss all samples of a track are sync
samples; of several tracks the first is the file's own; repeated rows are handled each for itself; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, text_batches

UNIT = 64
RATE = 8000
#: Bytes of a chunk.
CHUNK = 4096

#: Fixed values of the format: boxes that hold boxes, with the bytes before these.
CONTAINERS = {b"moov": 0, b"trak": 0, b"mdia": 0, b"minf": 0, b"stbl": 0, b"dinf": 0, b"edts": 0, b"udta": 0, b"mvex": 0}


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", 8 + len(body), kind) + body


def _full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", version << 24 | flags), *parts)


_MATRIX = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def store(payload: bytes) -> bytes:
    """An ISO media file with ``payload`` (a multiple of 64 bytes) as unsigned 8-bit samples."""
    n = len(payload)
    chunks = -(-n // CHUNK)
    ftyp = _box(b"ftyp", b"isom", struct.pack(">I", 0x200), b"isomiso2")
    entry = _box(b"raw ", bytes(6), struct.pack(">H8xHHHHI", 1, 1, 8, 0, 0, RATE << 16))
    first_runs = [(1, min(n, CHUNK), 1)]
    if chunks > 1 and n % CHUNK:
        first_runs.append((chunks, n % CHUNK, 1))

    def moov(base: int) -> bytes:
        offsets = struct.pack(f">{chunks}Q", *range(base, base + n, CHUNK))
        stbl = _box(
            b"stbl",
            _full(b"stsd", struct.pack(">I", 1), entry),
            _full(b"stts", struct.pack(">3I", 1, n, 1)),
            _full(b"stsc", struct.pack(">I", len(first_runs)), *(struct.pack(">3I", *r) for r in first_runs)),
            _full(b"stsz", struct.pack(">2I", 1, n)),
            _full(b"co64", struct.pack(">I", chunks), offsets),
        )
        dinf = _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1)))
        minf = _box(b"minf", _full(b"smhd", bytes(4)), dinf, stbl)
        mdhd = _full(b"mdhd", struct.pack(">4I2H", 0, 0, RATE, n, 0x55C4, 0))
        hdlr = _full(b"hdlr", bytes(4), b"soun", bytes(12), b"text\0")
        tkhd = _full(b"tkhd", struct.pack(">5I8x4H", 0, 0, 1, 0, n, 0, 0, 0x100, 0), _MATRIX, bytes(8), flags=3)
        mvhd = _full(b"mvhd", struct.pack(">4IIH10x", 0, 0, RATE, n, 0x10000, 0x100), _MATRIX, bytes(24), struct.pack(">I", 2))
        return _box(b"moov", mvhd, _box(b"trak", tkhd, _box(b"mdia", mdhd, hdlr, minf)))

    head = 16  # mdat has a 64-bit size
    base = len(ftyp) + len(moov(0)) + head
    return b"".join((ftyp, moov(base), struct.pack(">I4sQ", 1, b"mdat", head + n), payload))


def boxes(data: memoryview, low: int = 0, high: int | None = None) -> Iterator[tuple[bytes, int, int]]:
    """(path, start of the body, end) of each box, nested ones after their parent."""
    stack = [(b"", low, len(data) if high is None else high)]
    while stack:
        path, at, end = stack.pop()
        if at + 8 > end:
            continue
        size, kind = struct.unpack_from(">I4s", data, at)
        body = at + 8
        if size == 1:
            size = struct.unpack_from(">Q", data, body)[0]
            body += 8
        elif size == 0:
            size = end - at
        if size < body - at or at + size > end:
            raise ValueError(f"box {kind!r} at {at} has size {size}")
        here = path + b"/" + kind
        yield here, body, at + size
        stack.append((path, at + size, end))
        if kind in CONTAINERS:
            stack.append((here, body + CONTAINERS[kind], at + size))


def _table(view: memoryview, box: tuple[int, int], form: str, skip: int = 4) -> np.ndarray:
    """The entries of a box after its version, ``skip`` bytes and their number: one row each."""
    a, b = box
    (count,) = struct.unpack_from(">I", view, a + skip)
    low = a + skip + 4
    if low + count * struct.calcsize(">" + form) > b:
        raise ValueError("a sample table is cut off")
    kind = np.dtype(">u8" if form == "Q" else ">u4")
    width = struct.calcsize(">" + form) // kind.itemsize
    return np.frombuffer(view, kind, count * width, low).astype(np.int64).reshape(count, width)


def _sizes(view: memoryview, boxes_: dict) -> tuple[int, np.ndarray | None, int]:
    """Bytes of every sample (0 if they differ), of each one, and the number of samples."""
    if b"stsz" in boxes_:
        each, count = struct.unpack_from(">2I", view, boxes_[b"stsz"][0] + 4)
        return each, None if each else _table(view, boxes_[b"stsz"], "I", 8)[:, 0], count
    a, b = boxes_[b"stz2"]
    bits, count = struct.unpack_from(">3xBI", view, a + 4)
    if bits not in (4, 8, 16) or a + 12 + (count * bits + 7) // 8 > b:
        raise ValueError("a sample table is cut off")
    raw = np.frombuffer(view, ">u2" if bits == 16 else np.uint8, count if bits > 4 else (count + 1) // 2, a + 12).astype(np.int64)
    return 0, raw if bits > 4 else np.stack([raw >> 4, raw & 15], 1).reshape(-1)[:count], count


def _track(view: memoryview, found: dict[bytes, tuple[int, int]]) -> dict:
    if lacking := {b"stsd", b"mdhd", b"stsc", b"stts"} - set(found) or ({b"stco"} if not {b"stco", b"co64"} & set(found) else set()) or ({b"stsz"} if not {b"stsz", b"stz2"} & set(found) else set()):
        raise ValueError(f"a track lacks {sorted(lacking)}")
    a, _ = found[b"stsd"]
    codec = bytes(view[a + 12 : a + 16]).decode("latin-1")
    a, _ = found[b"mdhd"]
    timescale, duration = struct.unpack_from(">IQ", view, a + 20) if view[a] == 1 else struct.unpack_from(">2I", view, a + 12)
    each, sizes, samples = _sizes(view, found)
    offsets = _table(view, found[b"co64"], "Q")[:, 0] if b"co64" in found else _table(view, found[b"stco"], "I")[:, 0]
    runs = _table(view, found[b"stsc"], "3I")
    per = np.repeat(runs[:, 1], np.diff(np.append(runs[:, 0], len(offsets) + 1)))
    first = np.cumsum(per) - per
    before = (lambda s: s * each) if each else (lambda s, sums=np.concatenate([[0], np.cumsum(sizes)]): sums[s])
    if per.sum() != samples or len(per) != len(offsets):
        raise ValueError("the sample tables disagree")
    ends = offsets + before(first + per) - before(first)
    if len(ends) and ends.max() > len(view):
        raise ValueError("samples lie beyond the file's end")
    if b"stss" in found:
        sync = _table(view, found[b"stss"], "I")[:, 0] - 1
        chunk = np.searchsorted(first, sync, "right") - 1
        low = offsets[chunk] + before(sync) - before(first[chunk])
        high = low + before(sync + 1) - before(sync)
        new = np.concatenate([[True], (low[1:] != high[:-1]) | (chunk[1:] != chunk[:-1])])[: len(sync)]
        low, high = low[new], high[np.append(np.flatnonzero(new)[1:] - 1, len(sync) - 1)] if len(sync) else high
    else:
        low, high = offsets, ends
    ticks = _table(view, found[b"stts"], "2I")
    pairs = lambda x, y: list(zip(x.tolist(), y.tolist()))
    return {"codec": codec, "timescale": timescale, "duration": duration, "ticks": int((ticks[:, 0] * ticks[:, 1]).sum()),
            "samples": samples, "ranges": pairs(offsets, ends), "keyframes": pairs(low, high)}


def probe(data: bytes) -> dict:
    """Of the first track codec, timescale, duration, samples, ranges (start, end) of chunks, and of runs of sync samples as ``keyframes``.

    ``tracks``: the same of all tracks.
    """
    view = memoryview(data)
    tracks: list[dict[bytes, tuple[int, int]]] = []
    for path, a, b in boxes(view):
        kind = path.rpartition(b"/")[2]
        if kind == b"moof":
            raise ValueError("movie fragments aren't read")
        if kind == b"trak":
            tracks.append({})
        elif path.startswith(b"/moov/trak/"):
            tracks[-1][kind] = a, b
    if not tracks:
        raise ValueError("the file has no track")
    found = [_track(view, t) for t in tracks]
    return found[0] | {"tracks": found}


def payload_of(data: bytes, facts: dict) -> bytes:
    return b"".join(data[a:b] for a, b in facts["ranges"])


def feature_of(facts: dict) -> str:
    keys = facts["keyframes"]
    marks = zlib.crc32(struct.pack(f">{2 * len(keys)}Q", *(x for r in keys for x in r)))
    return (
        f"codec={facts['codec'].strip()};timescale={facts['timescale']};duration={facts['duration']};"
        f"samples={facts['samples']};keyframes={len(keys)};first={keys[0][0]}-{keys[0][1]};"
        f"last={keys[-1][0]}-{keys[-1][1]};ranges_crc32={marks}"
    )


SCHEMA = (
    "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long,"
    " media_bytes long, media_sha256 string, feature string, codec string, timescale long, duration long,"
    " key_starts array<long>, key_ends array<long>"
)


def _columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in SCHEMA.split(",")]
    types = [pa.string() if " string" in x else pa.list_(pa.int64()) if "array" in x else pa.int64() for x in SCHEMA.split(",")]
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = (text.as_py() or "").encode()
            media = store(raw + bytes(max(UNIT, -(-len(raw) // UNIT) * UNIT) - len(raw)))
            facts = probe(media)
            back = payload_of(media, facts)
            rows.append((
                doc_id, len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-UNIT:]),
                len(media), hashlib.sha256(media).hexdigest(), feature_of(facts),
                facts["codec"].strip(), facts["timescale"], facts["duration"], *([r[i] for r in facts["keyframes"]] for i in (0, 1)),
            ))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(names), types)], names=names
        )


def media_columns(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` with the facts of its stored form."""
    text_batches(docs.sparkSession)
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text")
    ).mapInArrow(_columns, SCHEMA)


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(documents(spark, sf_dir))
