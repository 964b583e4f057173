"""Quality classifier: random Fourier features of document statistics, ridge, isotonic calibration.

Statistics of a whole text (shares of kinds of characters, lengths, repetition)
are standardised and mapped to cosines of random projections, whose products
approximate a Gaussian kernel.  The cosines and an intercept are all that is
fitted: each partition sums its part of the normal equations; their solution is
a ridge score.  Pool-adjacent-violators on training
rows that the ridge fit has not seen turns scores into probabilities.

Bound: the fit takes at most about ``SAMPLE`` labelled documents, chosen by a hash
of doc_id, of repeated ones the least text; only theirs are the statistics that
are computed before scoring.  What reaches the driver is one matrix from each of ``FIT_PARTITIONS``
partitions and one row for each of at most ``GRID`` x 3 score bins.

Edge cases: a null text counts as empty and has a score like any other; rows
with null or disagreeing labels count by their mean label; without labels of
both values every score is the mean label, or 0.5 without any; a null doc_id is
held out; repeated rows get equal scores; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, save, text_batches

SAMPLE = 60_000
FIT_PARTITIONS = 16
FEATURES = 256
GRID = 1000
SEED = 7
FOLDS = 5
CUT = 0.3

_SETS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "|", "!", "%$#*&@^~+=<>", ".,;:?'\"()-", "\n", " ")
_KINDS = np.zeros((len(_SETS) + 1, 256))
for _i, _set in enumerate(_SETS):
    _KINDS[_i, [ord(c) for c in _set]] = 1
_KINDS[-1, 128:] = 1
N_STATS = len(_SETS) + 1 + 11


def statistics(text: str) -> list[float]:
    """The statistics of one text."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x]
    n, w = max(1, len(raw)), max(1, len(words))
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = counts[counts > 0] / n
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    kinds: dict[bytes, int] = {}
    for x in words:
        kinds[x] = kinds.get(x, 0) + 1
    same = sum(map(bytes.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:])))
    return [
        *(_KINDS @ counts / n).tolist(),
        np.log1p(len(raw)), np.log1p(len(words)), float(lengths.mean()), float(lengths.std()),
        len(kinds) / w, max(kinds.values(), default=0) / w, same / w, 1 - pairs / max(1, len(words) - 1),
        1 - len(set(lines)) / max(1, len(lines)), float(-(share * np.log(share)).sum()),
        sum(map(bytes.isupper, words)) / w,
    ]


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of doc_id as text, modulo ``folds``; 0 for a null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)) % folds


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    project: np.ndarray
    shift: np.ndarray
    weights: np.ndarray
    at: np.ndarray  # scores of the calibration's steps
    value: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        cosines = np.cos(z @ self.project + self.shift) * np.sqrt(2 / self.project.shape[1])
        return np.hstack([cosines, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.at, self.value) if len(stats) else np.zeros(0)


def isotonic(at: np.ndarray, ones: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: block centres and values, both in ascending order."""
    blocks: list[list[float]] = []
    for x, s, c in zip(at, ones, n):
        blocks.append([x * c, s, c])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    table = np.array(blocks)
    return table[:, 0] / table[:, 2], table[:, 1] / table[:, 2]


def _stats_table(batch: pa.RecordBatch, column: str = "stats") -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATS)


def with_statistics(texts: DataFrame) -> DataFrame:
    """stats, and the other columns, of texts (text, ...)."""
    other = [f for f in texts.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([statistics(t.as_py()) for t in batch.column("text")], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([found, *[batch.column(f.name) for f in other]], names=["stats", *[f.name for f in other]])

    return texts.mapInArrow(run, ", ".join(["stats array<double>", *[f"{f.name} {f.dataType.simpleString()}" for f in other]]))


def label_sample(labels: DataFrame, label: str, where: Column, bound: int) -> DataFrame:
    """doc_id, y of at most about ``bound`` labelled documents that ``where`` admits."""
    known = (
        labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label].cast("double").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & where)
        .groupBy("doc_id")
        .agg(F.avg("y").alias("y"))
    )
    share = min(1.0, bound / max(1, known.count()))
    return known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))


def sampled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """doc_id, y, text of the sampled documents, in ``FIT_PARTITIONS`` partitions.  The sample has a proven bound, so it is broadcast."""
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).repartition(FIT_PARTITIONS, "doc_id")


def fit(docs: DataFrame, labels: DataFrame, ridge: float = 1e-3) -> Model | float:
    """The model; without both labels the mean label."""
    sample = label_sample(labels, "quality", fold_of(F.col("doc_id"), FOLDS) != 0, SAMPLE)
    rows = save(
        with_statistics(sampled_texts(docs, sample).withColumn("calibrate", F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(4)) == 0)),
        "quality-fit",
    )
    n, mean_y, some, most = rows.agg(F.count(F.lit(1)), F.avg("y"), F.min("y"), F.max("y")).first()
    if not n or some == most:
        return float(mean_y) if n else 0.5
    moments = rows.agg(
        *[F.avg(F.col("stats")[i]) for i in range(N_STATS)], *[F.stddev_pop(F.col("stats")[i]) for i in range(N_STATS)]
    ).first()
    rng = np.random.default_rng(SEED)
    model = Model(
        mean=np.array(moments[:N_STATS]), scale=np.maximum(np.array(moments[N_STATS:]), 1e-6),
        project=rng.normal(size=(N_STATS, FEATURES)) / np.sqrt(N_STATS),
        shift=rng.uniform(0, 2 * np.pi, FEATURES),
        weights=np.zeros(FEATURES + 1), at=np.zeros(1), value=np.zeros(1),
    )
    width = len(model.weights)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, moment = np.zeros((width, width)), np.zeros(width)
        for batch in batches:
            x, y = model.features(_stats_table(batch)), batch.column("y").to_numpy()
            gram += x.T @ x
            moment += x.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([np.vstack([gram, moment]).tobytes()])], names=["sums"])

    fitting = rows.where("NOT calibrate").select("stats", "y").coalesce(FIT_PARTITIONS)
    total = sum(np.frombuffer(r[0]).reshape(width + 1, width) for r in fitting.mapInArrow(sums, "sums binary").collect())
    gram = total[:width] + ridge * max(1.0, total[width - 1, width - 1]) * np.diag(np.r_[np.ones(width - 1), 0])
    model.weights = np.linalg.solve(gram + 1e-9 * np.eye(width), total[width])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.round(np.clip(model.raw(_stats_table(batch)), -1, 2) * GRID).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column("y")], names=["bin", "y"])

    bins = (
        rows.where("calibrate").select("stats", "y").mapInArrow(scored, "bin long, y double")
        .groupBy("bin").agg(F.sum("y"), F.count(F.lit(1))).collect()
    )
    if bins:
        table = np.array(sorted(map(tuple, bins)), float)
        model.at, model.value = isotonic(table[:, 0] / GRID, table[:, 1], table[:, 2])
    else:
        model.at, model.value = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def _scores(model: Model | float, stats: np.ndarray) -> np.ndarray:
    return model.score(stats) if isinstance(model, Model) else np.full(len(stats), model)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score of every row of ``docs``."""
    text_batches(docs.sparkSession)
    model = fit(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = np.array([statistics(t.as_py()) for t in batch.column(1)]).reshape(-1, N_STATS)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_scores(model, stats))], names=["doc_id", "score"])

    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text")
    ).mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``cut``."""
    text_batches(docs.sparkSession)
    model = fit(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = np.array([statistics(t.as_py() or "") for t in batch.column("text")]).reshape(-1, N_STATS)
            yield batch.filter(pa.array(_scores(model, stats) >= cut))

    return docs.mapInArrow(run, docs.schema)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scores.select(
        "doc_id", (fold_of(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
