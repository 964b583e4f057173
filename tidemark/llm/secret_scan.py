"""Secret scanning: patterns, and a token-efficiency test for random strings.

The base patterns find assignments, access keys and runs of hex digits.  Beside
them, every maximal run of key characters is measured: text that a BPE
vocabulary knows takes few tokens, random strings take many, so a low ratio of
characters per token exposes them.  Known digests (hex of MD5, SHA-1, SHA-2
lengths, UUIDs) and identifiers (letters only, snake or camel case, numbers,
dates) are excluded first, unless they hold letters alone in a part as long as
a measured run whose own ratio is low.

Edge cases: a null text is empty and has no spans; ties in start are in the
order of the kinds; texts of any length are scanned whole; repeated rows are
scanned each for itself; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, text_batches

KINDS = ("assign", "access", "hex", "token")

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
#: Failing matches of these two are prefixes of no passing one, so the length can be asked for at once.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

#: Key characters; the other patterns' matches lie within maximal runs of these.
KEY_CHARACTER = np.zeros(256, bool)
KEY_CHARACTER[[ord(c) for c in string.ascii_letters + string.digits + "+/_=-"]] = True
#: An assignment holds one of these, in either case.
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
#: A run of fewer characters is not measured.
LEAST = 20
#: Known digests by length in hex digits (MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512), and UUIDs.
DIGEST = re.compile(
    r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128}"
    r"|[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12})"
)
#: Identifiers: parts of letters in one case pattern, or digits, joined by separators.  Each text has one way to match.
IDENTIFIER = re.compile(r"[_/=+-]*(?:(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+)[_/=+-]+)*(?:[A-Z]?[a-z]{2,}(?:[A-Z][a-z]{2,})*[0-9]*|[A-Z]+|[0-9]+)[_/=+-]*")
#: Letters alone, longer than words are: measured also in an identifier.
LETTERS = re.compile(r"[A-Za-z]{%d,}" % LEAST)

#: A run with fewer characters per token than this is taken for random.
RATIO = 2.0


@functools.cache
def _encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def key_runs(raw: bytes) -> Iterator[tuple[int, str]]:
    """(code point offset, characters) of the maximal runs of key characters that may hold a span."""
    data = np.frombuffer(raw, np.uint8)
    edges = np.flatnonzero(np.diff(KEY_CHARACTER[data], prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    counted = further = 0  # bytes so far that begin no character
    for i in np.flatnonzero(ends - starts >= 16):
        a, b = int(starts[i]), int(ends[i])
        further += int(np.count_nonzero((data[counted:a] & 0xC0) == 0x80))
        counted = a
        yield a - further, raw[a:b].decode("ascii")


def is_random(run: str, encoding, ratio: float) -> bool:
    """Whether a run that is no known digest takes many tokens; of an identifier, one of its long parts."""
    parts = LETTERS.findall(run) if IDENTIFIER.fullmatch(run) else [run]
    return any(len(x) < ratio * len(encoding.encode_ordinary(x)) for x in parts)


def scan_text(text: str, encoding, ratio: float = RATIO) -> tuple[list, list]:
    """Base spans and added ones, each (start, kind number, end), in order."""
    raw = text.encode("utf-8", "replace")
    base, more = [], []
    low = raw.lower()  # of bytes, so of A-Z only
    if any(word in low for word in KEYWORDS):
        base += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    for at, run in key_runs(raw):
        base += [(at + m.start(), 1, at + m.end()) for m in ACCESS.finditer(run)]
        base += [(at + m.start(), 2, at + m.end()) for m in HEX.finditer(run)]
        if len(run) >= LEAST and not DIGEST.fullmatch(run) and is_random(run, encoding, ratio):
            more.append((at, 3, at + len(run)))
    return sorted(base), more


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_token long"


def secret_scan(docs: DataFrame, vocabulary: str, ratio: float = RATIO) -> DataFrame:
    """One row per row of ``docs``.  ``vocabulary``: path of a .tiktoken file on every executor."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(vocabulary)
        for batch in batches:
            ids, counts, digests, spans = batch.column(0), [], [], []
            for scalar in batch.column(1):
                text = scalar.as_py()
                base, more = scan_text(text, encoding, ratio)
                kinds = [k for _, k, _ in base]
                counts.append((kinds.count(0), kinds.count(1), kinds.count(2), len(more)))
                digests.append(hashlib.sha256(shown(base).encode()).hexdigest())
                spans.append(shown(sorted(base + more)))
            n = [pa.array([c[i] for c in counts], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays(
                [ids, n[0], n[1], n[2], pa.array(digests, pa.string()), pa.array(spans, pa.string()), n[3]],
                names=[x.split()[0] for x in SCHEMA.split(",")],
            )

    text_batches(docs.sparkSession)
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text")
    ).mapInArrow(scan, SCHEMA)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(documents(spark, sf_dir), default_vocabulary())
