"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

Features are the hashed n-grams of a lower-cased text with single spaces, by
presence.  Partition
sums of their counts in toxic and other texts give each a smoothed log-count
ratio r; the features with the most significant ratios are kept.  A logistic
regression on presence times r is fitted by iterative parameter mixing: each
partition improves the weights on its rows, and rounds average them.

Bound: the fit takes at most about ``SAMPLE`` labelled texts, chosen by a hash of
doc_id, of repeated ones the least text, in ``FIT_PARTITIONS`` partitions; from each the driver gets two count
vectors of ``BUCKETS`` and, a round, a weight vector of ``KEPT``.

Edge cases: a null text counts as empty; an empty text has the score of the
intercept; rows with null or disagreeing labels count by their mean label (toxic
from 0.5); without labels of both values every score is the mean label, or 0
without any; a null doc_id is never learnt from; repeated rows get equal scores;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, save, text_batches
from tidemark.llm.quality import fold_of, label_sample, sampled_texts

SAMPLE = 20_000
FIT_PARTITIONS = 8
BUCKETS = 1 << 20
KEPT = 4096
GRAMS = (4, 5, 6, 7)
FOLDS, OUT = 3, 1
CUT = 0.7
ROUNDS, EPOCHS = 3, 15

_MIX = [np.uint64((0x9E3779B97F4A7C15 * (2 * i + 1) ** 3) & 0xFFFFFFFFFFFFFFFF | 1) for i in range(max(GRAMS))]
#: Characters of a very long text are taken about so many at a time.
STEP = 1 << 18
_SPACE = re.compile(r"\s")


def pieces(text: str) -> Iterator[str]:
    """The lower-cased words, each with one space on both sides, in pieces that follow on each other.

    A piece ends with a word; only a word longer than ``STEP`` is cut.
    """
    at, space = 0, " "
    while at < len(text):
        end = min(len(text), at + STEP)
        if end < len(text):
            found = _SPACE.search(text, end, end + STEP)
            end = found.start() if found else min(len(text), end + STEP)
        words = text[at:end].lower().split()
        if words:
            yield space + " ".join(words)
        at, space = end, " " if text[end : end + 1].isspace() or not words else ""
    yield " "


def grams(text: str) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of the lower-cased words, each with one space on both sides; some come more than once."""
    part = np.empty(0, np.uint64)
    for piece in pieces(text):
        own = np.frombuffer(piece.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
        part = np.concatenate([part[-(max(GRAMS) - 1) :], own])
        total = np.zeros(len(part), np.uint64)
        for i in range(max(GRAMS)):
            if len(part) <= i:
                break
            total = total[: len(part) - i] + part[i:] * _MIX[i]
            if i + 1 in GRAMS:
                mixed = (total ^ (total >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(i)
                yield (mixed >> np.uint64(44)).astype(np.int64)


def present(text: str, wanted: np.ndarray | None = None) -> np.ndarray:
    """The distinct buckets of a text; with ``wanted`` (a mask) only those."""
    if len(text) > STEP:
        seen = np.zeros(BUCKETS, bool)
        for b in grams(text):
            seen[b] = True
        return np.flatnonzero(seen if wanted is None else seen & wanted)
    return np.unique(np.concatenate([np.empty(0, np.int64), *(b if wanted is None else b[wanted[b]] for b in grams(text))]))


def ratios(toxic: np.ndarray, other: np.ndarray, n_toxic: int, n_other: int) -> tuple[np.ndarray, np.ndarray]:
    """Log-count ratios, and how many standard errors each is from no difference."""
    p, q = (toxic + 1) / (n_toxic + 2), (other + 1) / (n_other + 2)
    r = np.log(p / q)
    error = np.sqrt(1 / (toxic + 1) - 1 / (n_toxic + 2) + 1 / (other + 1) - 1 / (n_other + 2))
    return r, np.abs(r) / error


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float] | float:
    """Weight of each bucket (0 for those not kept) and the intercept; without both labels the mean label."""
    sample = label_sample(labels, "toxic", fold_of(F.col("doc_id"), FOLDS) != OUT, SAMPLE)
    rows = save(
        sampled_texts(docs, sample).select("text", (F.col("y") >= 0.5).alias("toxic")).coalesce(FIT_PARTITIONS), "toxic-fit"
    ).coalesce(FIT_PARTITIONS)
    n, n_toxic = rows.agg(F.count(F.lit(1)), F.count_if("toxic")).first()
    if not n or n_toxic in (0, n):
        return n_toxic / n if n else 0.0

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((2, BUCKETS), np.uint32)
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                table[int(toxic), present(text.as_py())] += 1
        yield pa.RecordBatch.from_arrays([pa.array([table.tobytes()])], names=["counts"])

    total = np.zeros((2, BUCKETS))
    for row in rows.mapInArrow(counts, "counts binary").toLocalIterator():
        total += np.frombuffer(row[0], np.uint32).reshape(2, BUCKETS)
    r, strength = ratios(total[1], total[0], n_toxic, n - n_toxic)
    strength[total.sum(0) < 3] = 0
    kept = np.sort(np.argsort(-strength, kind="stable")[:KEPT])
    wanted, number = np.zeros(BUCKETS, bool), np.zeros(BUCKETS, np.int64)
    wanted[kept], number[kept] = True, np.arange(len(kept))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [number[present(t.as_py(), wanted)].tolist() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int64())), batch.column(1)], names=["x", "toxic"])

    table = save(rows.mapInArrow(features, "x array<long>, toxic boolean"), "toxic-features").coalesce(FIT_PARTITIONS)
    scale = r[kept]
    weights = np.zeros(len(kept) + 1)
    weights[-1] = np.log(n_toxic / (n - n_toxic))
    for _ in range(ROUNDS):
        start = weights

        def improve(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            xs: list[np.ndarray] = []
            ys: list[bool] = []
            for batch in batches:
                xs += [np.array(x.as_py(), np.int64) for x in batch.column(0)]
                ys += batch.column(1).to_pylist()
            w, squares = start.copy(), np.full(len(start), 1e-8)
            order = np.random.default_rng(len(xs))
            for _ in range(EPOCHS):
                for i in order.permutation(len(xs)):
                    x = xs[i]
                    margin = w[-1] + w[x] @ scale[x]
                    slip = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - ys[i]
                    g = slip * scale[x] + 1e-4 * w[x]
                    squares[x] += g * g
                    w[x] -= 0.1 * g / np.sqrt(squares[x])
                    squares[-1] += slip * slip
                    w[-1] -= 0.1 * slip / np.sqrt(squares[-1])
            yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()]), pa.array([len(xs)])], names=["w", "n"])

        found = table.mapInArrow(improve, "w binary, n long").collect()
        weights = sum(np.frombuffer(f[0]) * f[1] for f in found) / sum(f[1] for f in found)
    dense = np.zeros(BUCKETS, np.float32)
    dense[kept] = weights[:-1] * scale
    return dense, float(weights[-1])


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score of every row of ``docs``."""
    spark = docs.sparkSession
    text_batches(spark)
    model = fit(docs, labels)
    shipped = spark.sparkContext.broadcast(model)  # a vector of BUCKETS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        wanted = model[0] != 0 if isinstance(model, tuple) else None
        for batch in batches:
            if wanted is None:
                scores = np.full(batch.num_rows, model)
            else:
                margin = np.array([float(model[0][present(t.as_py(), wanted)].sum()) for t in batch.column(1)]) + model[1]
                scores = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text")
    ).mapInArrow(run, "doc_id long, score double")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = toxicity_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scores.select(
        "doc_id", (fold_of(F.col("doc_id"), FOLDS) == OUT).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
