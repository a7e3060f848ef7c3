"""Toxicity by multiple-instance learning.

Only documents have labels, yet what offends is a sentence. Each sentence with some feature gets a
probability by a logistic model; a document's score is the noisy-or of its sentences, 1 - prod(1 -
p). The weights are fitted to the document labels through the noisy-or, and the sentence
probabilities then locate what offends. Features are words and the first bytes of words, for
languages that build words from stems; which of them tell anything is learned from the labels.

The fit uses at most `sample` labelled documents (a documented bound, those of least id hash) and
`features` features. Their counts are made on the executors; the driver sees the chosen features
and, for each sampled document, the chosen features of its sentences. Every document is scored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from errata.llm.common import crc_mod, mapped, written

SAMPLE = 20_000
FEATURES = 3000
LEAST_DOCUMENTS = 4
THRESHOLD = 0.7
PREFIXES = (4, 5, 6)
#: A-Z to a-z, ends of sentences to line feeds, what is in no word to spaces.
BYTES = bytes(c + 32 if 65 <= c <= 90 else 10 if c in b".!?\n" else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def features_of(word: bytes) -> list[bytes]:
    """The word, and as prefixes (marked with a star) its first bytes."""
    return [word, *(word[:n] + b"*" for n in PREFIXES if len(word) >= n)]


def sentences_of(text: str | None) -> list[list[bytes]]:
    return [s.split() for s in text.encode().translate(BYTES).split(b"\n")] if text else []


@dataclass
class Model:
    weights: dict[bytes, float]
    bias: float

    def __post_init__(self):
        #: A word can only have a chosen feature if its first bytes are among these.
        self.starts = {f.rstrip(b"*")[: PREFIXES[0]] for f in self.weights}

    def found(self, words: list[bytes]) -> set[bytes]:
        starts, n = self.starts, PREFIXES[0]
        return {f for w in words if w[:n] in starts for f in features_of(w) if f in self.weights}

    def sentences(self, text: str | None) -> Iterator[tuple[int, float]]:
        """(number, logit) of the sentences that have a feature."""
        for i, words in enumerate(sentences_of(text)):
            if found := self.found(words):
                yield i, self.bias + sum(self.weights[f] for f in found)

    def score(self, text: str | None) -> float:
        return float(-np.expm1(-sum(np.logaddexp(0, z) for _, z in self.sentences(text))))


def training_rows(documents: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(text, toxic) of the sampled labelled ids: crc32(doc_id) mod 3 is not 1, the label is 0 or 1 (the
    larger of several). Of an id that repeats with other texts, the least text counts, so that the
    sample bounds the rows."""
    usable = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (crc_mod("doc_id", 3) != 1))
    chosen = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    once = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most `sample` pairs of numbers
    return once.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).select("text", "toxic")


def _choose(rows: DataFrame, most: int) -> list[bytes]:
    """The features that tell most of a toxic document, by the lower bound of their log odds ratio."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                counts[toxic].update({f for words in sentences_of(text) for w in set(words) for f in features_of(w)})
            names = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), *(pa.array([c[x] for x in names], pa.int64()) for c in counts)], ["feature", "clean", "toxic"])

    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not totals.get(0) or not totals.get(1):
        return []
    counted = mapped(rows, count, "feature binary, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    rest_a, rest_b = totals[1] - F.col("toxic") + 0.5, totals[0] - F.col("clean") + 0.5
    odds = F.log(a) - F.log(rest_a) - F.log(b) + F.log(rest_b)
    bound = odds - 2 * F.sqrt(1 / a + 1 / rest_a + 1 / b + 1 / rest_b)
    best = counted.filter(F.col("toxic") >= LEAST_DOCUMENTS).withColumn("bound", bound).filter("bound > 0")
    return [bytes(r["feature"]) for r in best.orderBy(F.desc("bound"), "feature").limit(most).select("feature").collect()]


def fit(documents: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, features: int = FEATURES, steps: int = 300, rate: float = 0.1, ridge: float = 1e-4) -> Model:
    """A model of the labels. Without both kinds of labels it has no features and scores all 0."""
    rows = written(training_rows(documents, labels, sample), "toxicity")
    names = _choose(rows, features)
    if not names:
        return Model({}, 0.0)
    number = {f: i for i, f in enumerate(names)}
    blank = Model(dict.fromkeys(names, 0.0), 0.0)

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[sorted(number[f] for f in x) for words in sentences_of(t) if (x := blank.found(words))] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic").cast(pa.int32()), pa.array(found, pa.list_(pa.list_(pa.int32())))], ["toxic", "bag"])

    sampled = mapped(rows, bags, "toxic int, bag array<array<int>>").groupBy("toxic", "bag").agg(F.count("*").alias("n")).collect()
    sampled.sort(key=lambda r: (r["toxic"], r["bag"]))
    return _descend(names, [(r["toxic"], r["bag"], r["n"]) for r in sampled if r["bag"]], steps, rate, ridge)


def _descend(names: list[bytes], bags: list[tuple[int, list[list[int]], int]], steps: int, rate: float, ridge: float) -> Model:
    """Adam on the log likelihood of the bags; bags without features have score 0 whatever the weights."""
    toxic = np.array([b[0] for b in bags], bool)
    weight = np.array([b[2] for b in bags], float)
    bag_of = np.repeat(np.arange(len(bags)), [len(b[1]) for b in bags])
    sentences = [s for b in bags for s in b[1]]
    sentence_of = np.repeat(np.arange(len(sentences)), [len(s) for s in sentences])
    feature = np.array([f for s in sentences for f in s], np.int64)
    theta = np.zeros(len(names) + 1)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        z = theta[-1] + np.bincount(sentence_of, theta[feature], len(sentences))
        total = np.bincount(bag_of, np.logaddexp(0, z), len(bags))
        pull = np.where(toxic, -1 / np.expm1(np.maximum(total, 1e-9)), 1.0) * weight
        slope = pull[bag_of] / (1 + np.exp(-z))
        gradient = np.append(np.bincount(feature, slope[sentence_of], len(names)), slope.sum()) / weight.sum() + ridge * theta
        first += 0.1 * (gradient - first)
        second += 0.01 * (gradient**2 - second)
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return Model({f: float(w) for f, w in zip(names, theta, strict=False)}, float(theta[-1]))


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """documents, all columns, with `errata_score`; null, empty and featureless texts score 0."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, "errata_score"])

    return mapped(documents, score, T.StructType([*documents.schema.fields, T.StructField("errata_score", T.DoubleType())]))


def report(documents: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, **options) -> DataFrame:
    """Per document row: doc_id, held_out, score, predicted. Repeated rows give repeated results."""
    model = fit(documents, labels, **options)
    found = scored(documents.select("doc_id", "text"), model)
    return found.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), F.col("errata_score").alias("score"), (F.col("errata_score") >= threshold).cast("int").alias("predicted"))


def offending(documents: DataFrame, model: Model, *, least: float = 0.5) -> DataFrame:
    """doc_id, sentence (its number), probability of each sentence at or above `least`. Null and empty
    texts, and sentences without a feature, give no rows."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    key = documents.schema["doc_id"].dataType.simpleString()

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, n, float(1 / (1 + np.exp(-z)))) for i, t in enumerate(batch.column("text").to_pylist()) for n, z in shared.value.sentences(t)]
            rows = [r for r in rows if r[2] >= least]
            ids = batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int32()))
            yield pa.RecordBatch.from_arrays([ids, pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.float64())], ["doc_id", "sentence", "probability"])

    return mapped(documents.select("doc_id", "text"), locate, f"doc_id {key}, sentence int, probability double")


def reject(documents: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, **options) -> DataFrame:
    """Documents, all columns, whose score is below the threshold. Null and empty texts score 0 and
    stay; repeated rows stay or go together; without both kinds of labels all stay."""
    return scored(documents, fit(documents, labels, **options)).filter(F.col("errata_score") < threshold).drop("errata_score")
