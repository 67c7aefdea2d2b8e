"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

    score(x) = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)

The pairwise sum is 1/2 * sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2), so a text is scored in time linear in its
distinct words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rimstone.llm.common import per_slice

BUCKETS = 1 << 13  # hashed words
RANK = 6
SAMPLE_ROWS = 6_000  # labelled rows that are learned from, at most: those with the smallest hashes of their ids
WORD = re.compile(r"\w+")
STATS = (
    "letters upper digits space symbols bang pipe mean_word distinct top_word short_lines line_repeat length "
    "sentences long_word bias"
).split()


def statistics(text: str, words: list[str], counts: Counter, n_chars: int) -> np.ndarray:
    """Structure of a text and its length as metadata, each value about 0 to 1."""
    n = max(len(text), 1)
    n_words = max(len(words), 1)
    lines = text.split("\n")
    letters = sum(map(len, words))
    lower = sum(map(str.islower, words))
    marks = Counter({c: text.count(c) for c in "!|.,#$%&*{}<>=/\\_@;:"})
    top = max(counts.values(), default=0)
    longest = max(map(len, counts), default=0)
    return np.array(
        [
            letters / n, 1 - lower / n_words, sum(map(str.isdigit, words)) / n_words, text.count(" ") / n,
            (sum(marks.values()) - marks["."] - marks[","]) / n_words, marks["!"] / n_words, marks["|"] / n_words,
            min(letters / n_words / 10, 2), len(counts) / n_words, top / n_words,
            sum(len(x) < 30 for x in lines) / len(lines), 1 - len(set(lines)) / len(lines),
            np.log1p(n_chars) / 12, marks["."] / n_words * 5, min(longest / 40, 2), 1.0,
        ],
        np.float32,
    )


def features(text: str, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of a whole text: word buckets weighted by log counts to unit length, statistics."""
    words = WORD.findall(text)
    counts = Counter(words)
    stats = statistics(text, words, counts, len(text) if n_chars is None else n_chars)
    numbers = np.fromiter((crc32(w.lower().encode()) for w in counts), np.uint32, len(counts)) % BUCKETS
    values = np.log1p(np.fromiter(counts.values(), np.float32, len(counts)))
    if len(values):
        values /= np.sqrt((values**2).sum())
    return (
        np.concatenate([numbers.astype(np.int64), BUCKETS + np.arange(len(STATS))]),
        np.concatenate([values, stats]).astype(np.float32),
    )


@dataclass
class FactorisationMachine:
    """Weights of fixed size: BUCKETS + statistics features, RANK factors each."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margin(self, numbers: np.ndarray, values: np.ndarray) -> float:
        scaled = self.factors[numbers] * values[:, None]
        pairs = 0.5 * float((scaled.sum(axis=0) ** 2).sum() - (scaled**2).sum())
        return self.bias + float(self.weights[numbers] @ values) + pairs

    def score(self, numbers: np.ndarray, values: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(numbers, values), -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 6, rate: float = 0.05) -> FactorisationMachine:
    """Logistic loss, both classes of equal weight, adaptive steps, in a fixed order of rows.

    Without rows of both labels the machine knows nothing and gives the share of label 1 (one half without rows).
    """
    size = BUCKETS + len(STATS)
    draw = np.random.default_rng(7)
    factors = draw.normal(0, 0.01, (size, RANK)).astype(np.float32)
    machine = FactorisationMachine(0.0, np.zeros(size, np.float32), factors)
    labels = np.array([y for _, _, y in rows])
    good = labels.mean() if len(labels) else 0.5
    if good in (0.0, 1.0) or not len(labels):
        machine.bias = float(np.log((good + 0.01) / (1.01 - good)))
        machine.factors[:] = 0
        return machine
    # Half weight to each class moves the margin by the log odds; added back, so that scores are probabilities.
    weight = {0: 0.5 / (1 - good), 1: 0.5 / good}
    step_w, step_v = np.full(size, 1e-2, np.float32), np.full((size, RANK), 1e-2, np.float32)
    for _ in range(epochs):
        for k in draw.permutation(len(rows)):
            numbers, values, label = rows[k]
            numbers, at = np.unique(numbers, return_inverse=True)
            values = np.bincount(at, values).astype(np.float32)
            slope = weight[label] * (machine.score(numbers, values) - label)
            v = machine.factors[numbers]
            total = (v * values[:, None]).sum(axis=0)
            grad_w = slope * values + 1e-5 * machine.weights[numbers]
            grad_v = slope * values[:, None] * (total - v * values[:, None]) + 1e-4 * v
            step_w[numbers] += grad_w**2
            step_v[numbers] += grad_v**2
            machine.weights[numbers] -= rate * grad_w / np.sqrt(step_w[numbers])
            machine.factors[numbers] -= rate * grad_v / np.sqrt(step_v[numbers])
            machine.bias -= rate * slope * 0.1
    machine.bias += float(np.log(good / (1 - good)))
    return machine


def remainder():
    """crc32 of the id as text, modulo 5: rows with remainder 0 are held out."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(5))


def with_text(docs: DataFrame) -> DataFrame:
    n_chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), n_chars.alias("n_chars"))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> FactorisationMachine:
    """Learns from at most `sample_rows` labelled rows that are not held out, those with the smallest id hashes.

    The sample's ids and features are bounded by that number and are all that reaches the driver. Labels that are
    null, or contradict each other for one id, are left out.
    """
    usable = labels.where(remainder() != 0).where("doc_id is not null and quality in (0, 1)")
    one_each = usable.groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    chosen = one_each.where("low = high").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    picked = with_text(docs).join(F.broadcast(chosen.select("doc_id", F.col("low").alias("quality"))), "doc_id")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        made = [features(t, n) for t, n in zip(batch["text"].to_pylist(), batch["n_chars"].to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"], pa.array([n.astype(np.int32) for n, _ in made], pa.list_(pa.int32())),
                pa.array([v for _, v in made], pa.list_(pa.float32())), batch["quality"].cast(pa.int32()),
            ],
            ["doc_id", "numbers", "features", "quality"],
        )

    schema = "doc_id long, numbers array<int>, features array<float>, quality int"
    rows = picked.mapInArrow(per_slice(run), schema).collect()
    rows.sort(key=lambda r: (crc32(str(r["doc_id"]).encode()), r["doc_id"], r["numbers"]))
    return fit([(np.array(r[1], np.int64), np.array(r[2], np.float32), r[3]) for r in rows])


def score_quality(docs: DataFrame, machine: FactorisationMachine, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of `docs`; whole texts, null read as empty.

    Other columns than text and n_chars (computed where it is null or absent) do not count. The machine has a fixed
    size and is sent to the executors once.
    """
    shared = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.weights, machine.factors))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        machine = FactorisationMachine(*shared.value)
        texts, lengths = batch["text"].to_pylist(), batch["n_chars"].to_pylist()
        scores = [machine.score(*features(t, n)) for t, n in zip(texts, lengths, strict=True)]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = with_text(docs).mapInArrow(per_slice(run), "doc_id long, score double")
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0)
    return scored.select("doc_id", (remainder() == 0).alias("held_out"), "score", predicted.alias("predicted"))


def keep_good(docs: DataFrame, machine: FactorisationMachine, threshold: float = 0.3) -> DataFrame:
    """Rows of `docs`, all columns, that score at least `threshold`; no row is moved between tasks."""
    shared = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.weights, machine.factors))

    def run(batches) -> Iterator[pa.RecordBatch]:
        machine = FactorisationMachine(*shared.value)
        for batch in batches:
            texts = batch["text"].to_pylist()
            lengths = batch["n_chars"].to_pylist() if "n_chars" in batch.schema.names else [None] * len(texts)
            kept = [machine.score(*features(t or "", n)) >= threshold for t, n in zip(texts, lengths, strict=True)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
