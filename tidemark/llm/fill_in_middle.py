"""Fill-in-the-middle transformation: texts cut into prefix, middle and suffix, and put together in another order.

A pyarrow.compute pipeline a batch: texts are split into lists of units, the
lists are flattened with the indices of their parents, each unit gets its
ordinal in its text and from that a role; the units of a role are filtered out,
rebuilt to lists and joined, and the pieces are joined element by element.
Nothing loops over rows or units in Python.

A unit is a word with the white space before it, or the white space at the end.
All is done on bytes: white space is ASCII, and the byte that marks a cut, 0xFF,
is in no UTF-8 text.

Edge cases: a null text counts as empty, and an empty text is plain with 0
units; so is a text with one of the marks (``<P>``, ``<S>``, ``<M>``); a null
doc_id is hashed as no digits; repeated rows come out alike; texts of any length
are taken whole (batches are worked off in runs of 4 MB, a longer text is a run
of its own); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, parts, text_batches

SEED = 42
#: Out of 100 texts so many are transformed, and out of 100 of these so many suffix first.
RATE, SUFFIX_FIRST = 50, 80
MARKS = ("<P>", "<S>", "<M>")
_CUT = b"\xff"

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, restored string"


def draws(doc_id: Column, seed: int = SEED, count: int = 4) -> list[Column]:
    """The first 8-digit groups of the hex SHA-256 of ``seed:doc_id``, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(count)]


def units(texts: pa.Array) -> pa.ListArray:
    """The units of each text (binary): their lists, of length 0 for an empty text."""
    cut = pc.replace_substring_regex(texts, r"([^ \t\n\v\f\r])([ \t\n\v\f\r])", rb"\1" + _CUT + rb"\2")
    # An empty text would be a list of one empty unit: as a null it has none.
    return pc.split_pattern(pc.if_else(pc.equal(pc.binary_length(texts), 0), pa.scalar(None, texts.type), cut), _CUT)


def _lists(values: pa.Array, lengths: pa.Array) -> pa.Array:
    ends = pc.cumulative_sum(lengths)
    return pa.ListArray.from_arrays(pc.cast(pa.concat_arrays([pa.array([0], pa.int64()), ends]), pa.int32()), values)


def cut_in_three(texts: pa.Array, first: pa.Array, second: pa.Array) -> tuple[pa.Array, list[pa.Array]]:
    """The number of units of each text, and prefix, middle and suffix: cut after the smaller and the larger of the draws modulo (n + 1)."""
    split = units(texts)
    n = pc.fill_null(pc.cast(pc.list_value_length(split), pa.int64()), 0)
    modulo = lambda h: pc.subtract(h, pc.multiply(pc.divide(h, pc.add(n, 1)), pc.add(n, 1)))
    a, b = modulo(first), modulo(second)
    low, high = pc.min_element_wise(a, b), pc.max_element_wise(a, b)
    parent = pc.list_parent_indices(split)
    flat = pc.list_flatten(split)
    starts = pc.subtract(pc.cumulative_sum(n), n)
    ordinal = pc.subtract(_numbers(len(flat)), pc.take(starts, parent))
    role = pc.add(
        pc.cast(pc.greater_equal(ordinal, pc.take(low, parent)), pa.int8()), pc.cast(pc.greater_equal(ordinal, pc.take(high, parent)), pa.int8()))
    sizes = [low, pc.subtract(high, low), pc.subtract(n, high)]
    return n, [pc.binary_join(_lists(pc.filter(flat, pc.equal(role, r)), sizes[r]), b"") for r in range(3)]


def _numbers(n: int) -> pa.Array:
    """0 to n - 1."""
    return pc.subtract(pc.cumulative_sum(pa.repeat(pa.scalar(1, pa.int64()), n)), 1)


def arranged(texts: pa.Array, form: pa.Array, pieces: list[pa.Array]) -> pa.Array:
    """psm: prefix, suffix, middle; spm: suffix, prefix, middle, each after its mark; plain: the text."""
    prefix, middle, suffix = pieces
    p, s, m = (pa.scalar(x.encode(), texts.type) for x in MARKS)
    none = pa.scalar(b"", texts.type)
    psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, none)
    spm = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, none)
    return pc.if_else(pc.equal(form, "plain"), texts, pc.if_else(pc.equal(form, "psm"), psm, spm))


def restored(output: pa.Array, form: pa.Array) -> pa.Array:
    """The texts, from what was put out and its form alone."""
    p, s, m = (x.encode() for x in MARKS)
    none = pa.scalar(b"", output.type)

    def both(x: pa.Array, mark: bytes) -> tuple[pa.Array, pa.Array]:
        # Texts in another form lack the mark; a mark at their end gives every list two parts.
        halves = pc.split_pattern(pc.binary_join_element_wise(x, pa.scalar(mark, x.type), none), mark, max_splits=1)
        return pc.list_element(halves, 0), pc.list_element(halves, 1)

    def without_end(x: pa.Array, mark: bytes) -> pa.Array:
        return pc.binary_replace_slice(x, -len(mark), 1 << 62, b"")

    head, rest = both(output, m)
    middle = without_end(rest, m)
    one, two = both(head, s)
    psm = pc.binary_join_element_wise(pc.binary_replace_slice(one, 0, len(p), b""), middle, without_end(two, s), none)
    one, two = both(head, p)
    spm = pc.binary_join_element_wise(without_end(two, p), middle, pc.binary_replace_slice(one, 0, len(s), b""), none)
    return pc.if_else(pc.equal(form, "plain"), output, pc.if_else(pc.equal(form, "psm"), psm, spm))


def _transformed(rate: int, suffix_first: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in parts(batch.column("text")):
                yield _piece(batch.slice(low, high - low), rate, suffix_first)

    return run


def _piece(batch: pa.RecordBatch, rate: int, suffix_first: int) -> pa.RecordBatch:
    texts = pc.cast(batch.column("text"), pa.binary())
    h1, h2, h3, h4 = (batch.column(f"h{i}") for i in range(1, 5))
    hundredth = lambda h: pc.subtract(h, pc.multiply(pc.divide(h, 100), 100))
    n, pieces = cut_in_three(texts, h1, h2)
    plain = pc.or_(pc.greater_equal(hundredth(h3), rate), pc.equal(n, 0))
    for mark in MARKS:
        plain = pc.or_(plain, pc.match_substring(texts, mark))
    form = pc.if_else(plain, "plain", pc.if_else(pc.less(hundredth(h4), suffix_first), "spm", "psm"))
    output = arranged(texts, form, pieces)
    chars = [pc.if_else(plain, pa.scalar(None, pa.int64()), pc.cast(pc.utf8_length(pc.cast(x, pa.string())), pa.int64())) for x in pieces[:2]]
    columns = [batch.column("doc_id"), n, form, *chars, *(pc.cast(x, pa.string()) for x in (output, restored(output, form)))]
    return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in SCHEMA.split(", ")])


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """One row per row of ``docs``: doc_id, n units, form, prefix_chars, middle_chars, output, and the text restored from it."""
    text_batches(docs.sparkSession)
    doc_id = docs["doc_id"].cast("long")
    return docs.select(
        doc_id.alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
        *[h.alias(f"h{i + 1}") for i, h in enumerate(draws(doc_id, seed))],
    ).mapInArrow(_transformed(rate, suffix_first), SCHEMA)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return fill_in_middle(documents(spark, sf_dir)).select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))


OP12_SQL = r"""
WITH a AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
b AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || d[1:8] AS BIGINT) AS h1, CAST('0x' || d[9:16] AS BIGINT) AS h2,
         CAST('0x' || d[17:24] AS BIGINT) AS h3, CAST('0x' || d[25:32] AS BIGINT) AS h4 FROM a),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM b),
d AS (
  SELECT *, coalesce(array_to_string(u[1:low], ''), '') AS p, coalesce(array_to_string(u[low + 1:high], ''), '') AS m,
         coalesce(array_to_string(u[high + 1:], ''), '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN text ELSE p || m || s END) AS restored_sha256
FROM d
"""
